"""Keys that hold a large share of all rows, and a lookup join that does not send them to one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is hot above one row in this many. There are fewer hot keys than this, whatever the data, so they can
# always be broadcast.
HOT_ONE_IN = 10_000


def all_present(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def key_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows per key, without null keys; a hot key crosses the shuffle as one row per task."""
    return df.where(all_present(keys)).groupBy(*keys).agg(F.count("*").alias("__rows"))


def hot_among(counts: DataFrame, more_than: int = 0, one_in: int | None = None) -> DataFrame:
    """The hot keys of ``key_counts`` that have more than so many rows.

    A key is hot if it has more than one row in ``one_in`` (``HOT_ONE_IN`` by default); so there are fewer than that
    many. The number decides how rows travel, never which rows there are.
    """
    one_in = HOT_ONE_IN if one_in is None else one_in
    total = counts.agg(F.sum("__rows")).scalar()
    rows = F.col("__rows")
    return counts.where((rows > more_than) & (rows * one_in > total)).drop("__rows")


def hot_values(df: DataFrame, key: str) -> DataFrame:
    """The hot values of a column, as ``__key``."""
    return hot_among(key_counts(df.select(F.col(key).alias("__key")), ["__key"]))


def left_lookup(
    df: DataFrame, lookup: DataFrame, own_key: str, lookup_key: str, unique: bool = False, hot: DataFrame | None = None
) -> DataFrame:
    """Left join of ``df`` to a lookup of one row per key; adds the other columns of the lookup.

    Rows of hot keys find their match in a broadcast of the matches of hot keys. The other rows are joined by
    shuffle, with hot and null keys spread over the tasks by a salt that matches nothing. The salt is the input
    partition: a task that is run again gives the same rows the same salt. ``unique=True`` says that no own key
    repeats, which spares the search for hot keys; ``hot`` gives them where ``hot_values`` has been asked before.
    """
    values = [c for c in lookup.columns if c != lookup_key]
    keyed = lookup.select(F.col(lookup_key).alias("__key"), *[F.col(c).alias(f"__{i}") for i, c in enumerate(values)])
    if unique:
        found = [F.col(f"__{i}").alias(c) for i, c in enumerate(values)]
        return df.join(keyed, df[own_key] == keyed["__key"], "left").select(*[df[c] for c in df.columns], *found)
    hot = hot_values(df, own_key) if hot is None else hot
    hot_matches = keyed.join(F.broadcast(hot), "__key", "left_semi")
    offered = hot.join(F.broadcast(hot_matches), "__key", "left").select(
        F.col("__key").alias("__hot_key"), *[F.col(f"__{i}").alias(f"__hot_{i}") for i in range(len(values))]
    )
    first = df.join(F.broadcast(offered), F.col(own_key) == F.col("__hot_key"), "left")
    aside = F.col("__hot_key").isNotNull() | F.col(own_key).isNull()
    salted = first.withColumns(
        {
            "__own": F.when(~aside, F.col(own_key)),
            "__salt": F.when(aside, F.spark_partition_id() + 1).otherwise(0),
        }
    )
    # Salt 0 for every key, but not as a literal: Catalyst would fold that into the join condition and shuffle by
    # the key alone.
    cold = keyed.withColumn("__zero", F.pmod(F.xxhash64("__key"), F.lit(1)).cast("int"))
    joined = salted.join(cold, (F.col("__own") == F.col("__key")) & (F.col("__salt") == F.col("__zero")), "left")
    found = [F.coalesce(F.col(f"__hot_{i}"), F.col(f"__{i}")).alias(c) for i, c in enumerate(values)]
    return joined.select(*df.columns, *found)
