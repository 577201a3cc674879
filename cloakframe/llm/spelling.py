"""Spelling variants, grouped by a join over variable-length grams.

Words that differ by one inserted, deleted or replaced code point are near. They are found with a gram dictionary that
is pruned by frequency: a gram is extended by the next code point as long as it is frequent, up to ``LONGEST``, so
common beginnings become long grams and rare ones stay short, and the list of words of a gram that is not of the full
length has at most as many entries as the pruning threshold. A word, padded on both sides, is decomposed into the
grams that start at each place, less those that lie inside an earlier one.

One edit changes only some of them. A gram can be lost if it covers the edit, or if it starts right behind it and a
new gram swallows it; a new gram reaches no further than the gram that starts behind the edit, as grams inside a
frequent gram are frequent. The most grams of a set that any single edit can affect is the set's bound, and near words
share at least as many grams of a set as it has more than its bound. So a word asks with the least set that has one
more: two grams with a bound of one, those of which the shortest lists are expected, or in words beyond ``WORDY`` code
points those in the middle. All words are listed by all grams that others can ask for.

The edit is either behind a shared gram, and then the words agree up to the gram's end, or in front of it, and then they
agree from its start on. So a list holds the words of one length that have a gram and all in front of it, or it and all
behind it, in common. Lists of words as long and of words longer by one are merged, and each pair that meets is verified.

The dictionary holds at most ``total / threshold`` frequent grams of each length, and the threshold grows with the
vocabulary once that is more than ``MOST_GRAMS``, so it can be broadcast. Nothing else is bounded; no list is cut.

Results in odd cases: a null or empty text has no words; equal rows each count; an empty table gives no rows; a null id
counts as the empty string where ids matter; very long words are words; other columns are ignored, so their names
cannot clash.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cloakframe.llm.common import ascii_lower, let, stored

RUN = "[A-Za-zÀ-ÿ]"
SHORTEST, LONGEST = 3, 5  # code points of a gram
FREQUENT, MOST_GRAMS = 16, 100_000
START, END = "\x01", "\x02"
RATIO = 10
SHARE = 0.3  # of the words with a gram, those expected to agree in a given code point beside it
BASE, MODULUS = 0x1B873593CC9E2D51, (1 << 61) - 1
WORDY = 64  # code points from which on words are compared in another way


def vocabulary(
    docs: DataFrame,
    min_length: int = 7,
    min_count: int = 2,
    drop_one_in: int | None = None,
    key_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The words, in lower case as far as A-Z goes, and how often each occurs (n).

    ``drop_one_in`` takes a code point out of about one occurrence in so many, chosen by a checksum of id and word: noise
    like that of scanned texts, with which variants can be tried out.
    """
    key = F.coalesce(F.col(key_col).cast("string"), F.lit(""))
    runs = F.regexp_extract_all(ascii_lower(F.col(text_col)), F.lit(f"{RUN}{{{min_length},}}"), F.lit(0))
    found = docs.select(key.alias("key"), F.explode(runs).alias("word"))
    if drop_one_in:
        checksum = F.crc32(F.concat("key", F.lit(":"), "word").cast("binary"))
        place = F.pmod(F.col("checksum"), F.length("word")).cast("int")
        without = F.concat(F.substr("word", F.lit(1), place), F.substr("word", place + 2))
        found = found.withColumn("checksum", checksum).select(
            F.when(F.pmod("checksum", F.lit(drop_one_in)) == 0, without).otherwise(F.col("word")).alias("word")
        ).where(F.length("word") >= min_length)
    return found.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def padded(word: str, longest: int = LONGEST) -> str:
    return START * (longest - 1) + word + END * (longest - 1)


def decompose(text: str, frequent: dict[str, int], shortest: int = SHORTEST, longest: int = LONGEST) -> list[tuple[int, int]]:
    """(start, end) of the grams of a padded word that lie in no earlier one; both only ever rise."""
    grams, covered = [], 0
    for start in range(len(text) - longest + 1):
        end = start + shortest
        while end - start < longest and text[start:end] in frequent:
            end += 1
        if end > covered:
            grams.append((start, end))
            covered = end
    return grams


def affected_bound(grams: list[tuple[int, int]], length: int, longest: int = LONGEST) -> int:
    """The most of these grams that one edit of a word of that length can affect."""
    spans = np.array(grams)
    places = np.arange(longest - 1, longest - 1 + length)
    started = np.searchsorted(spans[:, 0], places + 1, side="right")
    ended = np.searchsorted(spans[:, 1], places, side="right")
    return int((started - ended).max())


def asked_pair(
    text: str, grams: list[tuple[int, int]], frequent: dict[str, int], longest: int = LONGEST
) -> tuple[tuple[int, int], tuple[int, int]]:
    """Of the grams of a padded word two that no edit can both affect, a front and a back one: those for which the fewest
    words are expected to share the one and all in front of it, or the other and all behind it."""

    def expected(start: int, end: int, further: int) -> float:
        return frequent.get(text[start:end], 1) * SHARE ** max(0, further)

    edge = longest - 1
    best, pair, i, front = math.inf, None, 0, (math.inf, None)
    for start, end in grams:
        while grams[i][1] < start:  # an edit right in front of a gram can affect it, too
            a, b = grams[i]
            if b > edge:  # not only of padding
                front = min(front, (expected(a, b, a - edge), (a, b)))
            i += 1
        if front[1] is not None:
            cost = front[0] + expected(start, end, len(text) - edge - end)
            if cost < best:
                best, pair = cost, (front[1], (start, end))
    return pair


def middle_pair(grams: list[tuple[int, int]], size: int, longest: int = LONGEST) -> tuple[tuple[int, int], tuple[int, int]]:
    """Such a pair in the middle of a long word, which leaves only a few lists by which others could ask for it."""
    front = max(g for g in grams if g[1] - longest + 1 <= size // 2)
    return front, min(g for g in grams if g[0] > front[1])


def gram_dictionary(
    words: DataFrame, shortest: int = SHORTEST, longest: int = LONGEST, least: int = FREQUENT, most_grams: int = MOST_GRAMS
) -> dict[str, int]:
    """The frequent grams of all words and how often they occur; at most ``most_grams`` of each length."""
    total = words.agg(F.coalesce(F.sum(F.length("word") + 2 * longest), F.lit(0))).first()[0]
    threshold = max(least, -(-total // most_grams))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts: Counter[str] = Counter()
            for text in map(lambda w: padded(w, longest), batch["word"]):
                for size in range(shortest, longest + 1):
                    counts.update([text[i : i + size] for i in range(len(text) - size + 1)])
            yield pd.DataFrame({"gram": list(counts), "n": list(counts.values())})

    counted = words.select("word").mapInPandas(count, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    return dict(counted.where(F.col("n") > threshold).toPandas().itertuples(index=False))


def near_pairs(
    words: DataFrame, shortest: int = SHORTEST, longest: int = LONGEST, least: int = FREQUENT, most_grams: int = MOST_GRAMS
) -> DataFrame:
    """Each pair of words that differ by one edit, once: a, b and their n. ``words`` has each word (of at least
    ``2 * (longest - shortest) + 3`` code points) once, with its n."""
    if shortest < 2 or longest < shortest:
        raise ValueError("grams have at least two code points")
    frequent = words.sparkSession.sparkContext.broadcast(gram_dictionary(words, shortest, longest, least, most_grams))

    edge = longest - 1

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for word, n in zip(batch["word"], batch["n"], strict=True):
                text, size = padded(word, longest), len(word)
                grams = decompose(text, frequent.value, shortest, longest)
                up_to, back = running(word), running(word[::-1])
                ends, starts = ([x - edge for x in some if 0 < x - edge < size] for some in zip(*((e, s) for s, e in grams), strict=True))
                if size > WORDY:
                    low, high = size // 2 - longest - 1, size // 2 + longest + 2
                    ends, starts = ([x for x in some if low <= x <= high] for some in (ends, starts))
                held = [list_name(0, up_to[e], size) for e in ends] + [list_name(1, back[size - s], size) for s in starts]
                asked = []
                for longer in (size, size + 1):
                    chosen = asked_pair(text, grams, frequent.value, longest) if longer <= WORDY else middle_pair(grams, size, longest)
                    asked += [list_name(0, up_to[chosen[0][1] - edge], longer), list_name(1, back[size - chosen[1][0] + edge], longer)]
                rows.append((word, n, held, asked, parities(word)))
            yield pd.DataFrame(rows, columns=["word", "n", "held", "asked", "odd"])

    few = f"length(word) < {2 * (longest - shortest) + 3}"  # others have two such grams
    checked = words.select(
        F.when(F.expr(few), F.raise_error(F.lit("a word is too short for grams of these lengths"))).otherwise(F.col("word")).alias("word"), "n"
    )
    lists = stored(checked.mapInPandas(listed, "word string, n long, held array<long>, asked array<long>, odd long"), "lists")
    held = lists.select(F.explode("held").alias("list"), F.col("word").alias("b"), F.col("n").alias("b_n"), F.col("odd").alias("b_odd"))
    asked = lists.select(F.explode("asked").alias("list"), F.col("word").alias("a"), F.col("n").alias("a_n"), F.col("odd").alias("a_odd"))
    lengths = (F.length("b") == F.length("a") + 1) | (F.length("b") == F.length("a")) & (F.col("a") < F.col("b"))
    met = asked.join(held, "list").where(lengths & (F.bit_count(F.col("a_odd").bitwiseXOR(F.col("b_odd"))) <= 2))
    # The number keeps the comparison of words, which is not compiled, out of the join, where it would see all pairs.
    numbered = met.withColumn("row", F.monotonically_increasing_id())
    return numbered.where((F.col("row") >= 0) & one_edit(F.col("a"), F.col("b"))).select("a", "b", "a_n", "b_n").distinct()


def running(word: str) -> list[int]:
    """Hashes of the beginnings of a word: of none of it, of its first code point, and so on."""
    hashes, h = [0], 0
    for c in word:
        h = (h * BASE + ord(c)) % MODULUS
        hashes.append(h)
    return hashes


def list_name(side: int, hashed: int, size: int) -> int:
    """The number of a list; should two lists have the same, their words only meet in vain."""
    return ((hashed * 2 + side) * BASE + size) * BASE % (1 << 63)


def parities(word: str) -> int:
    """A bit per letter, set if the word has an odd number of it; one edit changes at most two."""
    bits = 0
    for c in word:
        bits ^= 1 << ord(c) % 62
    return bits


def one_edit(a: Column, b: Column) -> Column:
    """Whether ``b``, which is as long as ``a`` or one longer, differs from it by one edit.

    Spark's edit distance takes time in the square of the length; words beyond ``WORDY`` are compared behind the first
    place at which they differ instead.
    """
    same = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: x.eqNullSafe(y))
    compared = let(
        F.array_position(same, False).cast("int"),
        lambda i: F.substring(b, i + 1, F.length(b)) == F.substring(a, i + F.when(F.length(a) == F.length(b), 1).otherwise(0), F.length(a)),
    )
    return F.when(F.length(a) <= WORDY, F.levenshtein(a, b, 1) == 1).otherwise((a != b) & compared)


def spelling_variants(words: DataFrame, ratio: int = RATIO, **grams: int) -> DataFrame:
    """Every word with n, the number of its near words (n_near), its form and that form's n (form_n), and its root.

    The form is the most frequent near word (of ties the first in code point order) if it is at least ``ratio`` times as
    frequent; the root is where following the forms ends.
    """
    words = stored(words, "words")
    pairs = near_pairs(words, **grams)
    both = F.array(
        F.struct(F.col("a").alias("word"), F.struct((-F.col("b_n")).alias("less"), F.col("b").alias("near")).alias("best")),
        F.struct(F.col("b").alias("word"), F.struct((-F.col("a_n")).alias("less"), F.col("a").alias("near")).alias("best")),
    )
    ranked = pairs.select(F.explode(both).alias("p")).groupBy("p.word").agg(
        F.count("*").alias("n_near"), F.min("p.best").alias("best")
    )
    is_form = -F.col("best.less") >= ratio * F.col("n")
    formed = stored(
        words.join(ranked, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    # Each step multiplies n by the ratio, so paths are short; each round doubles the length that is followed.
    most = formed.agg(F.max("n"), F.min("n")).first()
    steps = int(math.log(most[0] / most[1], ratio)) + 1 if most[0] else 1
    roots = formed.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for i in range(math.ceil(math.log2(steps + 1))):
        onward = roots.select(F.col("word").alias("at"), F.col("root").alias("further"))
        roots = stored(
            roots.join(onward, F.col("root") == F.col("at"), "left").select("word", F.coalesce("further", "root").alias("root")),
            f"roots-{i}",
        )
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
