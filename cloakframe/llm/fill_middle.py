"""Fill-in-the-middle documents, cut at token boundaries that a wavelet matrix finds.

Every code point of a text has a class: inside a word, start of a word, white space, anything else. A wavelet matrix over
the classes answers how many code points of a class lie before a place. The sum of these ranks over the classes that
start a unit is the number of units begun there, so the place where a given unit starts comes from bisection on that
sum. The matrix is built over many texts at once and both cuts of all of them are bisected together.

The units are tokens (a run of ASCII letters, or one other code point), words with what follows them, or lines. The
two cuts, whether a text is rearranged, and in which order come from a hash of seed and id, so that a retry, another
partitioning or another engine gives the same output.

Results in odd cases: a null or empty text is ``plain`` with an empty output; a text that holds one of the marks is
``plain``, so the output can always be taken apart; prefix, middle or suffix may be empty; a null id hashes as the empty
string; equal rows get equal results; an empty table gives no rows; a column of the input whose name is that of a result
raises.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = MARKS = ("<P>", "<S>", "<M>")
PLAIN, PSM, SPM = "plain", "psm", "spm"
INSIDE, WORD_START, SPACE, OTHER, LINE_START = range(5)
# The classes of code points that start a unit.
UNITS = {"token": (WORD_START, SPACE, OTHER), "word": (WORD_START,), "line": (LINE_START,)}
RESULT = "units long, form string, prefix_chars long, middle_chars long, output string"
CHUNK = 4_000_000  # code points of texts that share a matrix; a longer text has one of its own


class WaveletMatrix:
    """Ranks of small numbers: how many of the first ``i`` values equal ``value``."""

    def __init__(self, values: np.ndarray, bits: int):
        self.levels = []
        for bit in range(bits - 1, -1, -1):
            ones = (values >> bit & 1).astype(bool)
            packed = np.packbits(ones, bitorder="little")
            blocks = np.zeros(len(values) // 64 + 1, "<u8")
            blocks.view(np.uint8)[: len(packed)] = packed
            before = np.concatenate(([0], np.cumsum(np.bitwise_count(blocks), dtype=np.int64)))
            zeros = len(values) - int(before[-1])
            self.levels.append((bit, blocks, before, zeros))
            values = np.concatenate((values[~ones], values[ones]))

    @staticmethod
    def _ones(blocks: np.ndarray, before: np.ndarray, i: np.ndarray) -> np.ndarray:
        block, rest = i >> 6, (i & 63).astype(np.uint64)
        return before[block] + np.bitwise_count(blocks[block] & ((np.uint64(1) << rest) - np.uint64(1)))

    def rank(self, value: int, i: np.ndarray) -> np.ndarray:
        first, last = np.zeros_like(i), i
        for bit, blocks, before, zeros in self.levels:
            low, high = self._ones(blocks, before, first), self._ones(blocks, before, last)
            first, last = (zeros + low, zeros + high) if value >> bit & 1 else (first - low, last - high)
        return last - first


class Boundaries:
    """The units of some texts: how many each has, and where each of them starts."""

    def __init__(self, texts: list[str], unit: str = "token"):
        self.length = np.fromiter(map(len, texts), np.int64, len(texts))
        self.first = np.concatenate(([0], np.cumsum(self.length)))[:-1]
        self.classes = UNITS[unit]
        code = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
        starts = np.zeros(len(code) + 1, bool)
        starts[self.first] = True
        starts = starts[:-1]
        if unit == "line":
            kind = np.zeros(len(code), np.uint8)
            kind[1:][code[:-1] == 10] = LINE_START
            kind[starts] = LINE_START
        else:
            letter = ((code | 32) - np.uint32(97)) < 26
            space = (code == 32) | ((code - np.uint32(9)) < 5)
            kind = np.where(letter, WORD_START, np.where(space, SPACE, OTHER)).astype(np.uint8)
            kind[1:][letter[1:] & letter[:-1]] = INSIDE
            kind[starts & letter] = WORD_START
        self.matrix = WaveletMatrix(kind, 3 if unit == "line" else 2)
        self.before = self._begun(self.first)
        self.count = self._begun(self.first + self.length) - self.before

    def _begun(self, place: np.ndarray) -> np.ndarray:
        return sum(self.matrix.rank(c, place) for c in self.classes)

    def cut(self, n: np.ndarray) -> np.ndarray:
        """Of each text the place behind its first ``n`` units: where the next one starts, or the end. What stands before
        the first unit (words only) belongs to it."""
        low, high = np.zeros_like(n), self.length.copy()
        while (open_ := low < high).any():
            middle = (low + high) >> 1
            reached = self._begun(self.first + np.minimum(middle + 1, self.length)) - self.before > n
            high = np.where(open_ & reached, middle, high)
            low = np.where(open_ & ~reached, middle + 1, low)
        return np.where(n <= 0, 0, low)


def rearrange(texts: list[str], draws: np.ndarray, plain_from: int, spm_below: int, unit: str, marks: tuple[str, str, str]) -> list[tuple]:
    """(units, form, code points of prefix and middle, output) of each text; ``draws`` has four numbers per text."""
    p, s, m = marks
    bounds = Boundaries(texts, unit)
    places = draws[:, :2] % (bounds.count + 1)[:, None]
    low, high = bounds.cut(places.min(axis=1)), bounds.cut(places.max(axis=1))
    rows = []
    for text, n, a, b, d in zip(texts, bounds.count.tolist(), low.tolist(), high.tolist(), draws.tolist(), strict=True):
        if not text or d[2] % 100 >= plain_from or any(mark in text for mark in marks):
            rows.append((n, PLAIN, None, None, text))
        elif d[3] % 100 < spm_below:
            rows.append((n, SPM, a, b - a, f"{s}{text[b:]}{p}{text[:a]}{m}{text[a:b]}"))
        else:
            rows.append((n, PSM, a, b - a, f"{p}{text[:a]}{s}{text[b:]}{m}{text[a:b]}"))
    return rows


def draw(key: Column, seed: int, number: int) -> Column:
    """The given eight hex digits (from 0) of the hash of seed and id, as a number."""
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(hashed, 8 * number + 1, 8), 16, 10).cast("long")


def fill_in_middle(
    docs: DataFrame,
    seed: int = 1,
    plain_percent: int = 10,
    spm_percent: int = 20,
    unit: str = "token",
    marks: tuple[str, str, str] = MARKS,
    key_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """All rows with units, form, prefix_chars, middle_chars and output.

    ``plain_percent`` of the texts stay as they are; of the others ``spm_percent`` have the suffix before the prefix.
    """
    clash = {c.lower() for c in docs.columns} & {c.split()[0] for c in RESULT.split(", ")}
    if clash:
        raise ValueError(f"input columns would be hidden: {sorted(clash)}")
    if unit not in UNITS or not all(marks) or len(set(marks)) < 3:
        raise ValueError("an unknown unit, or marks that cannot be told apart")
    within = any(a != b and a in b for a in marks for b in marks)
    if within or any(b.startswith(a[i:]) for a in marks for b in marks for i in range(1, len(a))):
        raise ValueError("marks may not overlap each other or themselves")

    @F.pandas_udf(RESULT)
    def of(text: pd.Series, a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.DataFrame:
        texts = [t if isinstance(t, str) else "" for t in text]
        draws = np.stack([x.to_numpy(np.int64) for x in (a, b, c, d)], axis=1)
        rows, done = [], 0
        while done < len(texts):
            n, size = done, 0
            while n < len(texts) and (n == done or size + len(texts[n]) <= CHUNK):
                size += len(texts[n])
                n += 1
            rows += rearrange(texts[done:n], draws[done:n], 100 - plain_percent, spm_percent, unit, marks)
            done = n
        frame = pd.DataFrame(rows, columns=[x.split()[0] for x in RESULT.split(", ")])
        return frame.astype({"prefix_chars": "Int64", "middle_chars": "Int64"})

    made = of(F.col(text_col), *[draw(F.col(key_col), seed, i) for i in range(4)])
    return docs.select(F.struct("*").alias("row"), made.alias("made")).select("row.*", "made.*")


def restore(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text an output was made from. A mark cannot stand in the text of a rearranged output."""
    parts = F.split(output, "|".join(map(re.escape, marks)))
    first, second, last = (F.element_at(parts, i) for i in (2, 3, 4))
    return (
        F.when(form == PSM, F.concat(first, last, second)).when(form == SPM, F.concat(second, last, first)).otherwise(output)
    )
