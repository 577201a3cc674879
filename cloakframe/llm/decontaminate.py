"""Benchmark decontamination over a positional inverted index.

A *window* is ``window`` consecutive words of a test item; an item of fewer words is one window. Finding them:

1. The frequency of every test term is counted over all documents.
2. For every window the positions of its rarest terms are chosen; a window with a term that no document holds is
   out. Only the postings (term, document, position) of chosen terms are stored.
3. A posting, less the position of its term in the item, is an *alignment* of the item with the document. The
   offset-adjusted lists are intersected: an alignment stays if all the chosen terms of some window gave it.
4. Alignments that stay are compared with the document's words, which gives the windows that occur.

Documents are known by two hashes of their text, so ids may be null or repeat and copies share their alignments.
Postings meet terms in a broadcast join while the test set is small, else in a shuffled one. Texts meet their
alignments in a broadcast join, too, while these are few; beyond that a bitmap of the hashes, of fixed size, tells in the
scan which texts may have any: only those are shuffled, all others pass. No step gathers a term's or an item's
postings in one task.

Results in odd cases: a null or empty text has no words, so it is never hit and matches no item; items without
words match nothing; equal items give the same windows and each of their ids is listed; a null item id is left out
of the lists; rows that share an id, or have none, are judged each by their own text, however many; an empty table on either side
gives no hits; other columns are ignored, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cloakframe.llm.common import let, stored, tokens
from cloakframe.operators.hot_keys import left_lookup

WINDOW = 13
LISTS = 2
# Test terms, items and alignments up to this many rows and bytes are broadcast; beyond, the joins are shuffled.
MAX_BROADCAST_ROWS, MAX_BROADCAST_BYTES = 200_000, 48 << 20
BITMAP = 1 << 26  # bits, that is 8 MB


def _is_small(df: DataFrame, size: Column | None = None) -> bool:
    """Whether the rows, and the bytes that ``size`` gives for each, are few enough to be sent to all tasks."""
    rows, held = df.agg(F.count("*"), F.coalesce(F.sum(size if size is not None else F.lit(0)), F.lit(0))).first()
    return rows <= MAX_BROADCAST_ROWS and held <= MAX_BROADCAST_BYTES


def _small(df: DataFrame, size: Column | None = None) -> DataFrame:
    """The frame, marked for a broadcast if a count shows that it is small."""
    return F.broadcast(df) if _is_small(df, size) else df


def _bytes(words: Column) -> Column:
    """About what an array of words takes in memory."""
    return F.octet_length(F.array_join(words, "        "))


def text_key(text: Column) -> Column:
    return F.struct(F.xxhash64(text).alias("h1"), F.xxhash64(F.lit("second"), text).alias("h2"))


def _with_alignments(texts: DataFrame, aligned: DataFrame) -> DataFrame:
    """Rows with a ``key`` with the alignments (``found``) of theirs, or null."""
    held = F.aggregate("found", F.lit(0), lambda a, x: a + 64 + _bytes(x["words"]) + F.size(x["items"]) * 32)
    if _is_small(aligned, held):
        return texts.join(F.broadcast(aligned), F.col("key") == F.col("doc"), "left").drop("doc")

    def spot(key: Column) -> Column:
        return F.pmod(key["h1"], F.lit(BITMAP))

    marks = aligned.groupBy(F.bitmap_bucket_number(spot(F.col("doc"))).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(spot(F.col("doc")))).alias("bits")
    )
    place = F.bitmap_bit_position(spot(F.col("key")))
    byte = F.conv(F.hex(F.substring("bits", (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    bit = F.pmod(F.floor(byte / F.pow(F.lit(2), F.pmod(place, F.lit(8)))), F.lit(2)) == 1
    columns = texts.columns
    marked = texts.join(F.broadcast(marks), F.bitmap_bucket_number(spot(F.col("key"))) == F.col("bucket"), "left").select(
        *columns, F.coalesce(bit, F.lit(False)).alias("maybe")
    )
    some = left_lookup(marked.where("maybe").drop("maybe"), aligned, "key", "doc")
    return some.unionByName(marked.where("NOT maybe").drop("maybe"), allowMissingColumns=True)


def phrases(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """One row per different sequence of words: key, words and the ids of the items that have it."""
    listed = items.select(F.col(id_col).cast("string").alias("item"), tokens(F.col(text_col)).alias("words"))
    listed = listed.where(F.size("words") > 0).withColumn("phrase", F.md5(F.array_join("words", " ")))
    return listed.groupBy("phrase", "words").agg(F.array_sort(F.collect_set("item")).alias("items"))


def postings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(term, doc, pos) of every word of every document."""
    return docs.select(F.col(id_col).alias("doc"), F.posexplode(tokens(F.col(text_col))).alias("pos", "term"))


def term_counts(index: DataFrame, items: DataFrame) -> DataFrame:
    """How often the documents hold each term of the items; terms they lack are not listed."""
    vocabulary = items.select(F.explode("words").alias("term")).distinct()
    return index.join(_small(vocabulary), "term").groupBy("term").agg(F.count("*").alias("n"))


def probes(items: DataFrame, counts: DataFrame, window: int = WINDOW, lists: int = LISTS) -> DataFrame:
    """The phrases with ``probes``: for each window the positions of its rarest terms."""
    terms = items.select("phrase", F.posexplode("words").alias("at", "term"))
    rated = (
        terms.join(counts, "term", "left")
        .groupBy("phrase")
        .agg(F.sort_array(F.collect_list(F.struct("at", F.coalesce("n", F.lit(0)).alias("n")))).alias("rated"))
    )

    def of_window(start: Column) -> Column:
        held = F.transform(F.slice("rated", start + 1, window), lambda x: F.struct(x["n"].alias("n"), x["at"].alias("at")))
        return let(F.slice(F.sort_array(held), 1, lists), lambda rarest: F.when(rarest[0]["n"] > 0, rarest["at"]))

    starts = F.sequence(F.lit(0), F.greatest(F.size("rated") - window, F.lit(0)))
    chosen = F.array_distinct(F.array_compact(F.transform(starts, of_window)))
    return items.join(rated.select("phrase", chosen.alias("probes")), "phrase").where(F.size("probes") > 0)


def alignments(index: DataFrame, probed: DataFrame) -> DataFrame:
    """(doc, phrase, shift, words, items) for each shift of a phrase at which all the lists of some window meet."""
    anchors = probed.select("phrase", "words", F.explode(F.array_distinct(F.flatten("probes"))).alias("at")).select(
        "phrase", "at", F.get("words", F.col("at")).alias("term")
    )
    wanted = _small(anchors.select("term").distinct())
    kept = stored(index.join(wanted, "term"), "postings")
    met = (
        kept.join(_small(anchors), "term")
        .select("doc", "phrase", (F.col("pos") - F.col("at")).alias("shift"), "at")
        .groupBy("doc", "phrase", "shift")
        .agg(F.collect_set("at").alias("met"))
    )
    whole = F.exists("probes", lambda p: F.size(F.array_except(p, F.col("met"))) == 0)
    return met.join(_small(probed, _bytes(F.col("words"))), "phrase").where(whole).drop("met", "probes")


def _occurrences(doc_words: Column, found: Column, window: int) -> Column:
    """For one alignment the windows that the document holds there: (start, end) in words."""
    equal = F.transform(found["words"], lambda x, i: F.get(doc_words, found["shift"] + i).eqNullSafe(x))
    length = F.least(F.size(found["words"]), F.lit(window))

    def held(e: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(e) - length)
        return F.transform(
            F.filter(starts, lambda s: F.forall(F.slice(e, s + 1, length), lambda x: x)),
            lambda s: F.struct((found["shift"] + s).alias("start"), (found["shift"] + s + length).alias("end")),
        )

    return let(equal, held)


def covered(spans: Column) -> Column:
    """How many positions lie in at least one of the (start, end) spans."""
    swept = F.aggregate(
        F.sort_array(spans),
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, s: F.struct(
            (a["n"] + F.greatest(s["end"] - F.greatest(a["end"], s["start"]), F.lit(0))).alias("n"),
            F.greatest(a["end"], s["end"]).alias("end"),
        ),
    )
    return swept["n"]


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    lists: int = LISTS,
) -> DataFrame:
    """One row per document: id, n_words, n_hit, items (ids of those with occurring windows, sorted as text),
    spans (the occurrences) and contaminated (a twentieth of the words or more is hit)."""
    judged = _judged(docs, items, id_col, text_col, item_col, item_text_col, window, lists)
    return judged.withColumnRenamed("id", id_col).drop("row")


def _judged(docs, items, id_col, text_col, item_col, item_text_col, window, lists) -> DataFrame:
    """As ``decontaminate``, with the whole input row in ``row``, which costs nothing unless it is used."""
    listed = phrases(items, item_col, item_text_col)
    keyed = docs.select(text_key(F.col(text_col)).alias("key"), F.col(text_col).alias("text"))
    index = postings(keyed, "key", "text")
    probed = stored(probes(listed, term_counts(index, listed), window, lists), "probes")
    aligned = stored(
        alignments(index, probed).groupBy("doc").agg(F.collect_list(F.struct("shift", "words", "items")).alias("found")), "alignments"
    )
    texts = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.struct("*").alias("row"), text_key(F.col(text_col)).alias("key")
    )
    joined = _with_alignments(texts, aligned)
    matches = let(
        F.col("__words"),
        lambda w: F.filter(
            F.transform(
                "found", lambda x: F.struct(x["items"].alias("items"), _occurrences(w, x, window).alias("spans"))
            ),
            lambda x: F.size(x["spans"]) > 0,
        ),
    )
    none = F.array().cast("array<struct<items:array<string>,spans:array<struct<start:int,end:int>>>>")
    return (
        joined.select("id", "row", "found", tokens(F.col("text")).alias("__words"))
        .select(
            "id",
            "row",
            F.size("__words").cast("long").alias("n_words"),
            F.when(F.col("found").isNull(), none).otherwise(matches).alias("matches"),
        )
        .select(
            "id",
            "row",
            "n_words",
            covered(F.flatten("matches.spans")).cast("long").alias("n_hit"),
            F.array_sort(F.array_distinct(F.flatten("matches.items"))).alias("items"),
            F.array_sort(F.array_distinct(F.flatten("matches.spans"))).alias("spans"),
            # Keeps a filter on the verdict above this projection, so that nothing below is worked out twice.
            F.monotonically_increasing_id().alias("__row"),
        )
        .withColumn(
            "contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")) & (F.col("__row") >= 0)
        )
        .drop("__row")
    )


def near_matches(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    terms: int = 3,
    within: int = 20,
) -> DataFrame:
    """Proximity matches: (id, items, start) where the rarest ``terms`` different terms of an item lie within so
    many words of each other, in any order. The lists of those terms are merged per document and item and swept
    with a range window; items with a term that no document holds have no match."""
    listed = phrases(items, item_col, item_text_col)
    index = postings(docs, id_col, text_col)
    counts = term_counts(index, listed)
    rated = (
        listed.select("phrase", F.explode(F.array_distinct("words")).alias("term"))
        .join(counts, "term", "left")
        .groupBy("phrase")
        .agg(F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "term"))).alias("rated"))
        .select("phrase", F.slice("rated", 1, terms).alias("rarest"))
        .where(F.col("rarest")[0]["n"] > 0)
        .select("phrase", F.size("rarest").alias("needed"), F.explode("rarest.term").alias("term"))
    )
    span = Window.partitionBy("doc", "phrase").orderBy("pos").rangeBetween(0, within - 1)
    near = (
        index.join(_small(rated), "term")
        .withColumn("seen", F.size(F.collect_set("term").over(span)))
        .where(F.col("seen") == F.col("needed"))
        .groupBy("doc", "phrase")
        .agg(F.min("pos").alias("start"))
    )
    return near.join(listed, "phrase").select(F.col("doc").alias(id_col), "items", "start")


def keep_uncontaminated(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", window: int = WINDOW, lists: int = LISTS,
) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    judged = _judged(docs, items, id_col, text_col, item_col, item_text_col, window, lists)
    return judged.where(~F.col("contaminated")).select("row.*")
