"""Keys and relationships that the rows show, where nobody declared them.

*Relationships* are inclusion dependencies: every value of a column is a value of another one. All columns of all tables
become rows (value, column), counted in the tasks first; one shuffle brings the columns of a value together, whatever
their number, as one set. Sets are few, so how often two columns share a set is counted over sets: a column lies in
another if they share all its values. A value that every column holds is one row.

*Keys* are minimal sets of columns without nulls whose values never repeat. They are searched by size: sets that hold a
smaller key are left out, as are those whose distinct counts, from sketches, multiply to less than the rows. One scan
sketches all sets of a size. Of those that may be unique most show a repeat within a small part of the values or rows,
which is looked at first where a table is large: a repeat there is a repeat. Whatever is left is checked over all rows by
one hash of 64 bits; if none of these repeats, no value does. Where one repeats, rows with it are compared by 128 bits.

Values are compared by 128 bits of hashes of their texts; integers of all widths compare with each other, texts with
texts. Nulls are no values.
"""

from __future__ import annotations

from collections.abc import Collection
from functools import reduce
from itertools import combinations
from math import prod

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MARGIN = 0.9  # of a sketch's estimate; its error is a fraction of that
PRECISION = 12
SHARES, SHARED_ROWS = (64, 8), 200_000  # parts of the values looked at before all of them, and rows from which it pays


def _name(column: str) -> Column:
    return F.col("`" + column.replace("`", "``") + "`")


def _hash(*columns: Column) -> Column:
    return F.xxhash64(*columns)


def _hashes(*columns: Column) -> tuple[Column, Column]:
    return _hash(*columns), F.xxhash64(F.lit("second"), *columns)


def _kind(data_type: T.DataType) -> str | None:
    if isinstance(data_type, T.IntegralType):
        return "number"
    return "text" if isinstance(data_type, T.StringType) else None


def column_values(frames: dict[str, DataFrame]) -> DataFrame:
    """(column number, kind, two hashes, rows) of the different values of all whole-number and text columns."""
    parts, number = [], 0
    for df in frames.values():
        items = []
        for f in df.schema:
            kind = _kind(f.dataType)
            if kind:
                value = _name(f.name).cast("long") if kind == "number" else _name(f.name)
                first, second = _hashes(value)
                # The hash of a null is taken for no value.
                items.append(F.when(value.isNotNull(), F.struct(F.lit(number).alias("column"), F.lit(kind).alias("kind"), first.alias("h1"), second.alias("h2"))))
            number += 1
        if items:
            parts.append(df.select(F.explode(F.filter(F.array(*items), lambda x: x.isNotNull())).alias("v")).select("v.*"))
    return reduce(DataFrame.union, parts).groupBy("column", "kind", "h1", "h2").agg(F.count("*").alias("rows"))


def find_relationships(frames: dict[str, DataFrame], keys_only: bool = True) -> DataFrame:
    """Columns all of whose values are values of another column: child, parent, and the child's different values.

    ``keys_only`` keeps parents in which no value repeats, which is what a foreign key can refer to.
    """
    names = [(i, t, f.name) for i, (t, f) in enumerate((t, f) for t, df in frames.items() for f in df.schema)]
    session = next(iter(frames.values())).sparkSession
    listed = F.broadcast(session.createDataFrame(names, "column int, of_table string, of_column string"))
    per_value = column_values(frames).groupBy("kind", "h1", "h2").agg(
        F.sort_array(F.collect_list(F.struct("column", (F.col("rows") > 1).alias("repeats")))).alias("held")
    )
    sets = per_value.groupBy("held").agg(F.count("*").alias("n"))
    child = sets.select("n", "held", F.explode("held.column").alias("child"))
    shared = child.select("n", "child", F.explode("held").alias("p")).groupBy("child", F.col("p.column").alias("parent")).agg(
        F.sum("n").alias("shared"), F.max("p.repeats").alias("repeats")
    )
    own = shared.where("child = parent").select(F.col("child").alias("own"), F.col("shared").alias("n_values"))
    whole = shared.join(F.broadcast(own), (F.col("child") == F.col("own")) & (F.col("shared") == F.col("n_values")))
    # Whether a parent repeats is seen over all its values, not only the shared ones.
    twice = shared.where("child = parent").select(F.col("child").alias("of"), F.col("repeats").alias("parent_repeats"))
    found = whole.where("child <> parent").join(F.broadcast(twice), F.col("parent") == F.col("of"))
    if keys_only:
        found = found.where(~F.col("parent_repeats"))
    a = listed.select(F.col("column").alias("child"), F.col("of_table").alias("child_table"), F.col("of_column").alias("child_column"))
    b = listed.select(F.col("column").alias("parent"), F.col("of_table").alias("parent_table"), F.col("of_column").alias("parent_column"))
    return found.join(a, "child").join(b, "parent").select(
        "child_table", "child_column", "parent_table", "parent_column", "n_values"
    )


def _without(sets: list[tuple[str, ...]], numbers: Collection[int]) -> list[tuple[str, ...]]:
    return [s for i, s in enumerate(sets) if i not in numbers]


def _part(value: Column, share: int) -> Column:
    """A part of the values, and of all rows, where a value that is frequent shows."""
    return (F.pmod(value, F.lit(share)) == 0) | (F.rand(1) < 1 / share)


def _repeated(df: DataFrame, sets: list[tuple[str, ...]], where: list[Column] | None = None) -> set[int]:
    """Numbers of the sets of which some values repeat, among the rows that a condition per set names or among all."""
    items = []
    for i, s in enumerate(sets):
        h1, h2 = _hashes(*map(_name, s))
        item = F.struct(F.lit(i).alias("set"), h1.alias("h1"), h2.alias("h2"))
        items.append(item if where is None else F.when(where[i], item))
    listed = F.array(*items) if where is None else F.array_compact(F.array(*items))
    counted = df.select(F.explode(listed).alias("v")).groupBy("v").agg(F.count("*").alias("n"))
    return {r[0] for r in counted.where("n > 1").select("v.set").distinct().collect()}


def _unique(df: DataFrame, sets: list[tuple[str, ...]]) -> tuple[list[tuple[str, ...]], int]:
    """The sets whose values never repeat, and the number of scans.

    Rows are shuffled as they are: nearly all hashes differ, and to look for equal ones in the tasks first would fill memory.
    """
    items = [F.struct(F.lit(i).alias("set"), _hash(*map(_name, s)).alias("h")) for i, s in enumerate(sets)]
    rows = df.select(F.explode(F.array(*items)).alias("v")).select("v.*").repartition("set", "h")
    twice = rows.groupBy("set", "h").agg(F.count("*").alias("n")).where("n > 1")
    seen = {r[0]: r[1] for r in twice.groupBy("set").agg(F.min("h")).collect()}
    if not seen:
        return sets, 1
    unsure, scans = [s for i, s in enumerate(sets) if i in seen], 2
    hashes = [seen[i] for i in sorted(seen)]
    repeats = _repeated(df, unsure, [_hash(*map(_name, s)) == h for s, h in zip(unsure, hashes, strict=True)])
    unsure = _without(unsure, repeats)
    if unsure:  # two values of one hash
        unsure, scans = _without(unsure, _repeated(df, unsure)), 3
    return [s for i, s in enumerate(sets) if i not in seen or s in unsure], scans


def find_keys(df: DataFrame, max_columns: int = 3) -> tuple[list[tuple[str, ...]], int]:
    """The minimal keys of at most so many columns, and the number of scans it took. An empty table has none."""
    usable = [f.name for f in df.schema if not isinstance(f.dataType, (T.MapType, T.ArrayType, T.StructType))]

    def sketch(columns: tuple[str, ...]) -> Column:
        return F.hll_sketch_estimate(F.hll_sketch_agg(F.xxhash64(*map(_name, columns)), PRECISION))

    if not usable:
        return [], 0
    first = df.agg(F.count("*"), *[F.count(_name(c)) for c in usable], *[sketch((c,)) for c in usable]).first()
    rows, scans = first[0], 1
    whole = [c for i, c in enumerate(usable) if first[1 + i] == rows]
    distinct = {c: first[1 + len(usable) + i] for i, c in enumerate(usable)}
    keys: list[tuple[str, ...]] = []
    for size in range(1, max_columns + 1):
        sets = [
            s for s in combinations(whole, size)
            if not any(set(k) <= set(s) for k in keys) and prod(distinct[c] for c in s) >= MARGIN**size * rows
        ]
        if size > 1 and sets:
            estimates = df.agg(*[sketch(s) for s in sets]).first()
            scans += 1
            sets = [s for s, n in zip(sets, estimates, strict=True) if n >= MARGIN * rows]
        if not sets or not rows:
            continue
        if rows < SHARED_ROWS:
            keys += _without(sets, _repeated(df, sets))
            scans += 1
            continue
        for share in SHARES:
            if sets:
                sets = _without(sets, _repeated(df, sets, [_part(_hash(*map(_name, s)), share) for s in sets]))
                scans += 1
        if sets:
            found, more = _unique(df, sets)
            keys += found
            scans += more
    return keys, scans


def found_keys(frames: dict[str, DataFrame], max_columns: int = 2) -> DataFrame:
    """(table_name, key_columns) of the minimal keys of tables."""
    rows = [(t, ",".join(k)) for t, df in frames.items() for k in find_keys(df, max_columns)[0]]
    return next(iter(frames.values())).sparkSession.createDataFrame(rows, "table_name string, key_columns string")
