from __future__ import annotations

import random
import re

import pytest

from cloakframe.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(docs, items, window):
    listed = [(i, WORD.findall((t or "").translate(LOWER))) for i, t in items]
    out = []
    for doc_id, text in docs:
        w = WORD.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for item, words in listed:
            size = min(window, len(words))
            for s in range(len(words) - size + 1 if size else 0):
                for p in range(len(w) - size + 1):
                    if w[p : p + size] == words[s : s + size]:
                        hit |= set(range(p, p + size))
                        found |= {str(item)} - {"None"}
        out.append((doc_id, len(w), len(hit), sorted(found), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def run(spark, docs, items, window=13, lists=2):
    d = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, n_words int")
    i = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, term int")
    rows = decontaminate.decontaminate(d, i, window=window, lists=lists).collect()
    return sorted(((r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in rows), key=repr)


@pytest.mark.parametrize("broadcast", [True, False])
@pytest.mark.parametrize("lists", [1, 2, 3])
def test_random_texts(spark, monkeypatch, broadcast, lists):
    if not broadcast:
        monkeypatch.setattr(decontaminate, "_is_small", lambda df, size=None: False)
    random.seed(lists)
    word = lambda: random.choice(["a", "b", "c", "the", "Ä", "ä", "x1"])
    items = [(i, " ".join(word() for _ in range(random.randint(1, 7)))) for i in range(8)]
    docs = [(i, ", ".join(word() for _ in range(random.randint(0, 25)))) for i in range(40)]
    docs += [(50 + i, f"{word()} {t.upper().replace('Ä', 'ä')}! {word()}") for i, t in items]
    assert run(spark, docs, items, 4, lists) == brute(docs, items, 4)


def test_odd_rows(spark):
    long = " ".join(f"w{i % 700}" for i in range(30_000))
    items = [(1, "one two three"), (2, "ONE two, three"), (None, "one two three"), (3, None), (4, "..."), (5, ""), (5, "w1 w2"),
             (6, "absent one two"), (7, " ".join(f"w{i}" for i in range(20)))]
    docs = [(1, "so One-two\nthree!"), (1, "nothing"), (None, "one two three"), (None, "w1 w2"), (2, None), (3, ""), (4, long), (4, long)]
    assert run(spark, docs, items) == brute(docs, items, 13)


@pytest.mark.parametrize("bits", [1 << 15, 1 << 26, None])
def test_table_without_ids(spark, monkeypatch, bits):
    """Many texts, no ids, many items; the bitmap may let others through, but loses none."""
    if bits:
        monkeypatch.setattr(decontaminate, "_is_small", lambda df, size=None: False)
        monkeypatch.setattr(decontaminate, "BITMAP", bits)
    chance = random.Random(9)
    items = [(i, " ".join(f"t{i}x{k}" for k in range(6))) for i in range(60)]
    docs = [(None, f"lead {chance.choice(items)[1] if k % 3 else 'no item'} tail w{k % 150}") for k in range(400)]
    assert run(spark, docs, items, 5) == brute(docs, items, 5)


def test_texts_are_not_shuffled(spark, data_dir):
    from cloakframe.llm.queries import QUERIES

    plan = QUERIES["op1_decontaminate"](spark, data_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a b")]) == []
    assert run(spark, [(1, "a b")], []) == [(1, 2, 0, [], False)]


def test_keep(spark):
    docs = [(1, "a b c d"), (2, "x " * 100 + "a b c"), (3, None), (None, "a b c"), (1, "clean")]
    d = spark.createDataFrame([(i, t, t) for i, t in docs], "doc_id long, text string, contaminated string")
    kept = decontaminate.keep_uncontaminated(d, spark.createDataFrame([(1, "a b c")], "item_id long, text string"))
    assert kept.columns == d.columns
    assert sorted((r.doc_id, (r.text or "")[:5]) for r in kept.collect()) == [(1, "clean"), (2, "x x x"), (3, "")]


def test_near_matches(spark):
    d = spark.createDataFrame(
        [(1, "gamma x alpha y beta"), (2, "alpha " + "x " * 30 + "beta gamma"), (3, None)], "doc_id long, text string"
    )
    i = spark.createDataFrame([(9, "alpha beta gamma"), (8, "alpha beta absent gamma")], "item_id long, text string")
    got = decontaminate.near_matches(d, i, within=6).collect()
    assert [(r.doc_id, r["items"], r.start) for r in got] == [(1, ["9"], 0)]
