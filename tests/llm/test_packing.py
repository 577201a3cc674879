from __future__ import annotations

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cloakframe.llm import packing
from cloakframe.llm.queries import QUERIES
from cloakframe.sources.tables import load_table

CAPACITIES = (8, 12, 20)


def naive(lengths, capacities, overhead):
    """The same rules, each by scanning everything."""
    bins, place = [], {}
    order = sorted(range(len(lengths)), key=lambda k: (-lengths[k], k))
    for step, i in enumerate(order):
        n = lengths[i]
        open_ = [(room - n, b) for b, (room, _) in enumerate(bins) if room >= n]
        if open_:
            b = min(open_)[1]
        else:
            def cost(c):
                room = c - n
                for k in order[step + 1 :]:
                    if lengths[k] <= room:
                        room -= lengths[k]
                return (c + overhead) / (c - room)

            c = min((c for c in sorted(capacities) if c >= n), key=lambda c: (cost(c), c))
            b = len(bins)
            bins.append([c, 0])
        place[i] = (b, bins[b][1])
        bins[b][0] -= n
        bins[b][1] += n
    return [(b, min(c for c in capacities if c >= bins[b][1]), at) for b, at in (place[i] for i in range(len(lengths)))]


def test_against_naive():
    random.seed(1)
    for _ in range(200):
        lengths = [random.randint(1, 20) for _ in range(random.randint(0, 40))]
        overhead = random.choice([0, 1, 5])
        assert packing.pack(lengths, CAPACITIES, overhead) == naive(lengths, CAPACITIES, overhead)


def test_several_capacities_waste_less_than_one():
    random.seed(2)
    lengths = [random.randint(1, 8192) for _ in range(5000)]

    def capacity(sizes):
        return sum(c for _, c in {(b, c) for b, c, _ in packing.pack(lengths, sizes)})

    assert sum(lengths) <= capacity(packing.CAPACITIES) <= capacity((8192,))
    assert capacity(packing.CAPACITIES) < 1.02 * sum(lengths)


def check_bins(rows, capacities):
    bins = defaultdict(list)
    for r in rows:
        bins[r.bin_id, r.bin_capacity].append((r.bin_offset, r.n_tokens))
    assert len(bins) == len({b for b, _ in bins})
    for (_, capacity), held in bins.items():
        at = 0
        for offset, n in sorted(held):
            assert offset == at
            at += n
        assert capacity == min(c for c in capacities if c >= at)


def test_query(spark, data_dir):
    rows = QUERIES["op10_packing"](spark, data_dir).collect()
    words = {d.doc_id: len((d.text or "").encode().split()) + 1 for d in load_table(spark, data_dir, "documents").collect()}
    cut = defaultdict(dict)
    for r in rows:
        assert r.piece not in cut[r.doc_id]
        cut[r.doc_id][r.piece] = r.n_tokens
    assert {k: sum(v.values()) for k, v in cut.items()} == words
    assert all(n == 8192 for v in cut.values() for p, n in v.items() if p < len(v) - 1)
    check_bins(rows, packing.CAPACITIES)


def test_query_groups_equal_naive(spark):
    random.seed(7)
    docs = [(i, random.randint(1, 60)) for i in range(700)]
    df = spark.createDataFrame(docs, "doc_id long, n int")
    rows = packing.best_fit(df, F.col("n"), capacities=CAPACITIES, overhead=2, group=10**6).collect()
    ordered = sorted(((r.n_tokens, str(r.doc_id), r.piece) for r in rows), key=lambda x: (-x[0], x[1], x[2]))
    want = naive([x[0] for x in ordered], CAPACITIES, 2)
    got = {(str(r.doc_id), r.piece): (r.bin_id, r.bin_capacity, r.bin_offset) for r in rows}
    assert [got[x[1], x[2]] for x in ordered] == want


def test_odd_rows(spark):
    docs = [(1, None), (2, 0), (3, -4), (4, 5), (4, 5), (None, 45), (None, 7)] + [(9, 3)] * 500
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, n int, bin_id int")
    rows = packing.best_fit(df, F.col("n"), capacities=CAPACITIES, group=50).collect()
    assert sum(r.n_tokens for r in rows) == sum(max(n or 0, 0) for _, n in docs)
    assert {r.doc_id for r in rows if r.bin_id is None} == {1, 2, 3}
    assert sorted(r.n_tokens for r in rows if r.doc_id is None) == [5, 7, 20, 20]
    check_bins([r for r in rows if r.bin_id is not None], CAPACITIES)


@pytest.mark.parametrize("lengths", [[], [0]])
def test_empty(spark, lengths):
    df = spark.createDataFrame([(1, n) for n in lengths], "doc_id long, n int")
    assert [r.bin_id for r in packing.best_fit(df, F.col("n")).collect()] == [None] * len(lengths)
