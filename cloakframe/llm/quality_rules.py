"""Line-first cleaning: rules decide on lines, the failures go, and a document that loses too much goes too.

A line (between ``\\n``) without a word decides nothing and stays. Any other line fails as

- *navigation*: at least three of ``| › » ·``, and one for every forty characters,
- *symbols*: at least three of ``# * $ % & | < >``, and one for every twelve characters,
- *boilerplate*: at most 300 characters, with one of the phrases in ``BOILERPLATE``,
- *punctuation*: no sentence ends in it, and it is not a line of hard-wrapped prose, and there are other lines with words.
  A line is wrapped prose if the next line goes on with it (it starts in lower case, or the line has ``WRAPPED`` characters
  or more and is at least 0.6 times as long as the next) and a later line of its paragraph (lines with words, none
  without between) ends a sentence. Lines in Thai or Lao, which mark no ends, pass.

Results in odd cases: a null or empty text has no words, fails the base rules and its cleaned text is null or
empty; a text of one line is never judged by its punctuation; every row is judged alone, so repeated rows and
repeated ids get equal verdicts; no input row is dropped, and input columns other than the id and the text are
ignored, so their names cannot clash.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cloakframe.llm.common import let, words

# Phrases of legal, consent and navigation lines, in lower case.
BOILERPLATE = (
    "all rights reserved", "this work is licensed under", "terms of use", "terms of service", "privacy policy",
    "cookie policy", "use cookies", "enable javascript", "subscribe to our newsletter", "powered by", "skip to content",
)
HAS_WORDS = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
SEPARATORS = r"[|›»·]"
MARKS = r"[#*$%&|<>›»·]"
SENTENCE_END = r"[.!?…。！？:;](?:[\s\"'»”’)\]]|$)"
# Ends of other scripts, which no space need follow, and letters of scripts without any.
OTHER_END = r"[।॥؟۔؛።፧։។៕။།༎｡．。！？]"
NO_ENDS = r"[\u0E01-\u0E4E\u0E81-\u0ECE]"
CHARS_PER_SEPARATOR, CHARS_PER_SYMBOL, MAX_BOILERPLATE = 40, 12, 300
GOES_ON = r"^[\x20\x09-\x0D]*[\"'(\[]?\p{Ll}"
WRAPPED, NEARLY_AS_LONG = 25, 0.6
MIN_WORDS = 50
MAX_LOST = 0.4


def unfinished_lines(lines: Column) -> Column:
    """A letter per line: ``w`` if it has words, ends no sentence and is no wrapped prose."""
    ends = lambda x: x.rlike(f"{SENTENCE_END}|{OTHER_END}|{NO_ENDS}")

    def goes_on(x: Column, following: Column) -> Column:
        near = (F.length(x) >= WRAPPED) & (F.length(x) >= NEARLY_AS_LONG * F.length(following))
        return following.rlike(HAS_WORDS) & (near | following.rlike(GOES_ON))

    letters = F.transform(
        lines,
        lambda x, i: F.when(~x.rlike(HAS_WORDS), "b").when(ends(x), "e").when(goes_on(x, F.get(lines, i + 1)), "c").otherwise("w"),
    )
    # Up to each end of a sentence or of a paragraph: what goes on is finished only if an end comes.
    pieces = F.split(F.array_join(letters, ""), "(?<=[eb])")
    settled = F.transform(pieces, lambda x: F.when(x.endswith("e"), F.translate(x, "c", "e")).otherwise(F.translate(x, "c", "w")))
    return F.split(F.array_join(settled, ""), "")


def line_fails(line: Column, unfinished: Column, marked: Column, boilerplate: tuple[str, ...] = BOILERPLATE) -> Column:
    """Whether a line with words fails; ``unfinished`` says that it does so by its punctuation, and ``marked`` that the
    text has enough symbols or separators for the rules on them."""
    length = F.length(line)
    separators, symbols = F.regexp_count(line, F.lit(SEPARATORS)), F.regexp_count(line, F.lit(SYMBOLS))
    return (
        unfinished
        | ((length <= MAX_BOILERPLATE) & F.lower(line).rlike("|".join(map(re.escape, boilerplate))))
        | (marked & (symbols >= 3) & (symbols * CHARS_PER_SYMBOL >= length))
        | (marked & (separators >= 3) & (separators * CHARS_PER_SEPARATOR >= length))
    )


def repeated_words(word_list: Column) -> Column:
    """How many words lie in a window of three that the list holds twice or more, the first one included.

    Short hashes of the windows, packed with their positions into one number each, are sorted first: a window whose
    hash has no equal neighbour occurs once. The few others are compared as texts, again by sorting, and the
    positions of those with an equal neighbour are swept once, each adding the words not covered before it.
    """

    def beside(s: Column, key: Callable[[Column], Column]) -> Column:
        """The elements of a sorted array that have the key of a neighbour."""
        return F.filter(
            s, lambda x, k: (key(F.get(s, k + 1)) == key(x)) | ((k > 0) & (key(F.get(s, k - 1)) == key(x)))
        )

    def count(w: Column) -> Column:
        packed = F.transform(
            F.slice(w, 1, F.size(w) - 2),
            lambda x, i: F.shiftleft(F.hash(x, w[i + 1], w[i + 2]).cast("long"), 32).bitwiseOR(i.cast("long")),
        )
        suspects = F.transform(
            let(F.sort_array(packed), lambda s: beside(s, lambda x: F.shiftright(x, 32))),
            lambda x: x.bitwiseAND(F.lit(0x7FFFFFFF).cast("long")).cast("int"),
        )
        windows = F.transform(
            suspects, lambda i: F.struct(F.concat_ws(" ", w[i], w[i + 1], w[i + 2]).alias("s"), i.alias("i"))
        )
        equal = let(F.sort_array(windows), lambda s: beside(s, lambda x: x["s"]))
        swept = F.aggregate(
            F.sort_array(equal["i"]),
            F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
            lambda a, i: F.struct((a["n"] + i + 3 - F.greatest(a["end"], i)).alias("n"), (i + 3).alias("end")),
        )
        return F.when(F.size(w) < 4, F.lit(0)).otherwise(swept["n"])

    return let(word_list, count)


def quality_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = MIN_WORDS,
    max_lost: float = MAX_LOST,
    boilerplate: tuple[str, ...] = BOILERPLATE,
) -> DataFrame:
    """One row per document: counts, verdicts and the text without the lines that fail.

    Columns: the id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_failed_lines, line_chars
    and lost_chars (characters of lines with words, and of those that fail), cleaned, base_failed, kept. One narrow
    pass, no shuffle.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))

    def judge(lines: Column) -> Column:
        with_words = F.filter(lines, lambda x: x.rlike(HAS_WORDS))

        def verdict(x: Column, unfinished: Column) -> Column:
            return let(
                x.rlike(HAS_WORDS),
                lambda some: F.struct(
                    x.alias("line"), some.alias("has_words"), (some & line_fails(x, unfinished, F.col("__marks") >= 3, boilerplate)).alias("fails")
                ),
            )

        def verdicts(single: Column) -> Column:
            return let(
                unfinished_lines(lines),
                lambda letters: F.transform(lines, lambda x, i: verdict(x, ~single & (F.get(letters, i) == "w"))),
            )

        return let(F.size(with_words) == 1, verdicts)

    def characters(lines: Column) -> Column:
        return F.aggregate(lines, F.lit(0).cast("long"), lambda a, x: a + F.length(x["line"]))

    split = docs.select(
        F.col(id_col).alias("__id"),
        F.col(text_col).alias("__text"),
        words(F.col(text_col)).alias("__words"),
        F.regexp_count(text, F.lit(MARKS)).alias("__marks"),
    ).withColumn("__lines", let(F.split(F.coalesce("__text", F.lit("")), "\n"), judge))
    with_words = F.filter("__lines", lambda x: x["has_words"])
    failed = F.filter("__lines", lambda x: x["fails"])
    stay = F.filter("__lines", lambda x: ~x["fails"])
    counted = split.select(
        F.col("__id").alias(id_col),
        F.size("__words").cast("long").alias("n_words"),
        F.length(F.array_join("__words", "")).cast("long").alias("word_chars"),
        F.when(F.col("__marks") > 0, F.regexp_count("__text", F.lit(SYMBOLS))).otherwise(F.lit(0)).cast("long").alias("n_symbols"),
        let(with_words["line"], lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("__words")).cast("long").alias("n_repeat_words"),
        F.size(with_words).cast("long").alias("n_lines"),
        F.size(failed).cast("long").alias("n_failed_lines"),
        characters(with_words).alias("line_chars"),
        characters(failed).alias("lost_chars"),
        F.when(F.size(failed) == 0, F.col("__text")).otherwise(F.array_join(stay["line"], "\n")).alias("cleaned"),
        # A number that the verdict refers to: without it a filter on the verdict would be moved below this
        # projection, and every count in it worked out anew for each place that names it.
        F.monotonically_increasing_id().alias("__row"),
    )
    base = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    # Compared in whole numbers, so that no rounding decides.
    little = F.col("lost_chars") * 1000 <= round(max_lost * 1000) * F.col("line_chars")
    judged = counted.withColumns({"base_failed": base, "kept": ~base & little & (F.col("__row") >= 0)})
    return judged.drop("__row")


def keep_clean(docs: DataFrame, text_col: str = "text", **rules) -> DataFrame:
    """The documents that are kept, with all their columns; texts stay as they are."""
    packed = docs.select(F.struct("*").alias("row"), F.col(text_col).alias("text"))
    return quality_rules(packed, "row", "text", **rules).where("kept").select("row.*")
