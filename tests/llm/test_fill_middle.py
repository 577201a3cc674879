from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from cloakframe.llm import fill_middle as fim

UNITS = {"token": "[A-Za-z]+|[^A-Za-z]", "line": "[^\n]*\n|[^\n]+"}


def test_ranks_against_counting():
    draws = np.random.default_rng(1)
    for n in (0, 1, 63, 64, 65, 700):
        values = draws.integers(0, 5, n).astype(np.uint8)
        matrix = fim.WaveletMatrix(values, 3)
        places = np.arange(n + 1)
        for v in range(5):
            assert matrix.rank(v, places).tolist() == [int((values[:i] == v).sum()) for i in range(n + 1)]


@pytest.mark.parametrize("unit", ["token", "line"])
def test_cuts_against_a_pattern(unit):
    chance = random.Random(2)
    texts = ["", "a", "\n", "\n\n", "ab", " a", "né", "😀b", "é"]
    texts += ["".join(chance.choices("abC é😀\n1-", k=chance.randrange(80))) for _ in range(300)]
    bounds = fim.Boundaries(texts, unit)
    units = [re.findall(UNITS[unit], t) for t in texts]
    assert bounds.count.tolist() == [len(u) for u in units]
    for _ in range(10):
        n = np.array([chance.randint(0, len(u)) for u in units])
        assert bounds.cut(n).tolist() == [len("".join(u[:k])) for u, k in zip(units, n, strict=True)]


def test_words_keep_what_follows():
    bounds = fim.Boundaries(["  one, two 3 four"], "word")
    assert bounds.count.tolist() == [3]
    assert [int(bounds.cut(np.array([k]))[0]) for k in range(4)] == [0, 7, 13, 17]


def test_long_text_is_cut_alike():
    text = "word and " * 700_000
    a = fim.rearrange([text], np.array([[5, 1_000_001, 0, 50]]), 90, 20, "token", fim.MARKS)[0]
    assert a[:2] == (2_800_000, "psm") and len(a[4]) == len(text) + 9 and a[4].startswith("<P>word and word<S>")


def test_odd_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (None, "some text here", "x"), (4, "has <M> inside", "x"), (5, "tie", "x"), (5, "tie", "x"),
            (6, "< S > <", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string")
    made = fim.fill_in_middle(docs, plain_percent=0)
    got = made.withColumn("back", fim.restore(F.col("output"), F.col("form"))).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in got) == sorted((i or 0, t or "") for i, t, _ in rows)
    for r in got:
        assert r.back == (r.text or "") and r.row == "x"
        assert (r.form == "plain") == (not r.text or "<M>" in r.text)
        assert (r.prefix_chars is None) == (r.form == "plain")
    assert len({(r.form, r.output) for r in got if r.doc_id == 5}) == 1
    assert fim.fill_in_middle(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        fim.fill_in_middle(docs.withColumn("Form", F.lit(1)))


def test_shares_and_seeds(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("a few words to cut").alias("text"))
    forms = {r.form: r["count"] for r in fim.fill_in_middle(docs, plain_percent=40, spm_percent=50).groupBy("form").count().collect()}
    assert abs(forms["plain"] - 1600) < 150 and abs(forms["spm"] - 1200) < 150
    first, second = (fim.fill_in_middle(docs, seed=s).select("doc_id", "output") for s in (1, 2))
    assert first.exceptAll(second).count() > 2000


def test_marks_that_overlap_are_refused(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    for marks in (("<P>", "<P>", "<M>"), ("ab", "bc", "x"), ("aa", "b", "c"), ("abc", "b", "d"), ("", "b", "c")):
        with pytest.raises(ValueError):
            fim.fill_in_middle(docs, marks=marks)
