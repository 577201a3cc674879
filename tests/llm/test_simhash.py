from __future__ import annotations

import random

import pytest
import xxhash

from cloakframe.llm import simhash
from cloakframe.llm.queries import QUERIES
from cloakframe.sources.tables import load_table


def plain(text):
    w = (text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()
    shingles = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def roots(prints: dict):
    parent = {i: i for i in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(prints)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: find(i) for i in ids}


def test_fingerprints():
    for text in (None, "", " \n", "a", "A b", "a b c", "ÄÖ x Y z z z", "x " * 200_000, "a\x1cb c d e"):
        assert simhash.text_fingerprint(text) == plain(text)


def test_query_against_brute_force(spark, data_dir):
    rows = QUERIES["op6_simhash"](spark, data_dir).collect()
    prints = {d.doc_id: plain(d.text) for d in load_table(spark, data_dir, "documents").collect()}
    want = roots(prints)
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {i: (f"{prints[i]:016x}", want[i]) for i in prints}


@pytest.mark.parametrize("bucket", [64, 4])
def test_links_of_a_dense_cluster(spark, bucket):
    random.seed(5)
    centre, values = random.getrandbits(64), set()
    while len(values) < 300:
        x = centre
        for b in random.sample(range(64), random.randint(0, 4)):
            x ^= 1 << b
        values.add(x)
    values |= {random.getrandbits(64) for _ in range(100)} | {0, 7, (1 << 64) - 1}
    nodes = spark.createDataFrame([(simhash._signed(x),) for x in values], "fp long")
    got = {frozenset(r) for r in simhash.links(nodes, bucket).collect()}
    listed = sorted(values)
    want = {
        frozenset((simhash._signed(a), simhash._signed(b)))
        for i, a in enumerate(listed) for b in listed[i + 1 :] if (a ^ b).bit_count() <= 3
    }
    assert got == want


def test_components_of_a_path(spark):
    random.seed(8)
    names = random.sample(range(-500, 500), 60)
    edges = [tuple(sorted(p)) for p in zip(names[:40], names[1:40])] + [tuple(sorted(p)) for p in zip(names[40:], names[41:])]
    got = {r.node: r.root for r in simhash.components(spark.createDataFrame(edges, "fp long, other long")).collect()}
    want = {n: min(names[:40]) for n in names[:40]} | {n: min(names[40:]) for n in names[40:]}
    assert got == {n: r for n, r in want.items() if n != r}


def test_odd_rows_and_keep(spark):
    same = "one two three four five six seven"
    rows = [(4, same), (2, same), (None, same), (2, same), (7, None), (6, ""), (9, "other words here entirely"), (None, "lonely text of none")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, fp int")
    got = sorted(((r.doc_id, r.component_id) for r in simhash.near_duplicates(df).collect()), key=repr)
    assert got == sorted([(4, 2), (2, 2), (None, 2), (2, 2), (7, 6), (6, 6), (9, 9), (None, None)], key=repr)
    kept = simhash.keep_one_of_each(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted([2, 6, 9, None, None], key=repr)
    assert simhash.near_duplicates(df.limit(0)).collect() == []
