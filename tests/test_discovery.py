from __future__ import annotations

import random
from itertools import combinations

from pyspark.sql import functions as F

from cloakframe.operators import discovery
from cloakframe.plans.registry import FOREIGN_KEYS
from cloakframe.sources.tables import load_tables


def test_declared_relationships_are_found(spark, data_dir):
    frames = load_tables(spark, data_dir, ("region", "nation", "customer", "supplier", "orders", "lineitem", "documents", "labels"))
    found = {tuple(r)[:4] for r in discovery.find_relationships(frames).collect()}
    parents = {t: f for t, f in frames.items()}
    for child, column, parent, parent_column in FOREIGN_KEYS:
        if child in frames and parent in frames:
            own = {r[0] for r in frames[child].select(column).collect()} - {None}
            theirs = [r[0] for r in parents[parent].select(parent_column).collect()]
            holds = own <= set(theirs) and len(theirs) == len(set(theirs))
            assert ((child, column, parent, parent_column) in found) == holds


def test_against_subsets(spark):
    """Columns of several widths and kinds, with nulls, repeats, and a value that all of them hold."""
    chance = random.Random(1)
    tables = {}
    for t in ("x", "y", "z"):
        n = chance.randint(30, 60)
        tables[t] = [
            (chance.choice([None, *range(6)]), chance.randint(0, 9), k, chance.choice("abc"), chance.choice([None, "a", "b", "1"]))
            for k in range(n)
        ] + [(0, 0, 10_000, "a", "a")] * 2
    kinds = ("n", "n", "n", "s", "s")
    columns = {(t, f"c{i}"): (kinds[i], [r[i] for r in rows if r[i] is not None]) for t, rows in tables.items() for i in range(5)}
    frames = {t: spark.createDataFrame(rows, "c0 int, c1 long, c2 int, c3 string, c4 string").repartition(4) for t, rows in tables.items()}
    for keys_only in (True, False):
        wanted = {
            (*a, *b, len(set(va)))
            for a, (ka, va) in columns.items()
            for b, (kb, vb) in columns.items()
            if a != b and ka == kb and va and set(va) <= set(vb) and not (keys_only and len(vb) > len(set(vb)))
        }
        got = [tuple(r) for r in discovery.find_relationships(frames, keys_only).collect()]
        assert len(got) == len(set(got)) and set(got) == wanted
    assert wanted


def brute(rows, names, size):
    keys = []
    for n in range(1, size + 1):
        for s in combinations(range(len(names)), n):
            values = [tuple(r[i] for i in s) for r in rows]
            unique = len(set(values)) == len(rows) and not any(None in v for v in values)
            if rows and unique and not any(set(k) <= set(s) for k in keys):
                keys.append(s)
    return sorted(tuple(names[i] for i in k) for k in keys)


def test_keys_against_brute_force(spark):
    chance = random.Random(2)
    names = ["a", "b", "c", "d", "e"]
    for spread in (3, 6, 12):
        rows = [(i // 10, i % 10, chance.randrange(spread), chance.choice([None, 1, 2]) if spread == 3 else i % 7, chance.randrange(40)) for i in range(100)]
        keys, scans = discovery.find_keys(spark.createDataFrame(rows, "a int, b int, c int, d int, e int").repartition(3), 3)
        assert sorted(keys) == brute(rows, names, 3)
        assert scans <= 6
    assert discovery.find_keys(spark.createDataFrame([], "a int, b string"))[0] == []
    assert discovery.find_keys(spark.createDataFrame([(1, None)], "a int, b string"))[0] == [("a",)]


def test_repeats_show_in_a_part_of_a_large_table(spark, monkeypatch):
    """Only what shows no repeat in a part is checked over all rows, and the answer is exact: a single repeat counts."""
    checked, unique = [], discovery._unique

    def recorded(df, sets):
        checked.extend(sets)
        return unique(df, sets)

    monkeypatch.setattr(discovery, "_unique", recorded)
    monkeypatch.setattr(discovery, "SHARED_ROWS", 1000)
    # near repeats one value in twenty, hot one value in one of twelve rows, once two rows of all.
    df = spark.range(0, 40_000, numPartitions=4).selectExpr(
        "id AS key", "IF(id % 20 = 0, id + 1, id) AS near", "IF(id % 12 = 0, 0, id) AS hot", "IF(id = 77, 78, id) AS once", "id % 3 AS few"
    )
    assert discovery.find_keys(df, 1)[0] == [("key",)]
    assert ("near",) not in checked and ("hot",) not in checked and {("key",), ("once",)} <= set(checked)
    others = df.drop("key")
    assert sorted(discovery.find_keys(others, 2)[0]) == brute([tuple(r) for r in others.collect()], others.columns, 2)


def test_values_of_one_hash_are_no_repeat(spark, monkeypatch):
    hashed = discovery._hash
    monkeypatch.setattr(discovery, "SHARED_ROWS", 10)
    monkeypatch.setattr(discovery, "_hash", lambda *columns: F.pmod(hashed(*columns), F.lit(64)))
    assert discovery.find_keys(spark.range(500).selectExpr("id AS a", "id % 499 AS b", "id % 9 AS c"), 1)[0] == [("a",)]
