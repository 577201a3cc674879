"""INSERT, UPDATE, DELETE and MERGE as rewrites: each returns the new table and a one-row count of
affected rows. Nothing is written or counted until the caller does so.

The count is a query of its own. A caller who writes the new table anyway passes an ``Observation`` and reads
``affected_rows`` from it after the write, without a second pass.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from cloakframe.operators.hot_keys import all_present, hot_among, key_counts

AFFECTED = "affected_rows"
_FLAG = "__affected"


def _holds(predicate: Column) -> Column:
    """A predicate that is NULL does not hold."""
    return F.coalesce(predicate, F.lit(False))


def _count(flagged: DataFrame) -> DataFrame:
    return flagged.agg(F.count_if(F.col(_FLAG)).alias(AFFECTED))


def _observed(flagged: DataFrame, observation: Observation | None) -> DataFrame:
    if observation is None:
        return flagged
    return flagged.observe(observation, F.count_if(F.col(_FLAG)).alias(AFFECTED))


def insert_rows(
    target: DataFrame, source: DataFrame, observation: Observation | None = None
) -> tuple[DataFrame, DataFrame]:
    rows = source.select(*target.columns, F.lit(True).alias(_FLAG))
    return target.unionByName(_observed(rows, observation).drop(_FLAG)), _count(rows)


def update_rows(
    target: DataFrame, predicate: Column, sets: Mapping[str, Column], observation: Observation | None = None
) -> tuple[DataFrame, DataFrame]:
    """All new values are computed from the old row."""
    hit = _holds(predicate)
    changed = [
        F.when(hit, sets[c]).otherwise(F.col(c)).cast(target.schema[c].dataType).alias(c) if c in sets else F.col(c)
        for c in target.columns
    ]
    flagged = target.select(*changed, hit.alias(_FLAG))
    return _observed(flagged, observation).drop(_FLAG), _count(flagged)


def delete_rows(
    target: DataFrame, predicate: Column, observation: Observation | None = None
) -> tuple[DataFrame, DataFrame]:
    flagged = target.withColumn(_FLAG, _holds(predicate))
    return _observed(flagged, observation).where(~F.col(_FLAG)).drop(_FLAG), _count(flagged)


def merge_rows(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    update: Mapping[str, str] | None = None,
    insert: bool = True,
    delete_matched: Column | None = None,
    observation: Observation | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Update (or delete) target rows that match a source row on ``keys``; insert source rows that match none.

    ``update`` maps target columns to source columns; by default every column that is no key is taken from
    the source. Null keys match nothing. A target row with more than one match raises.

    Built from a left and an anti join rather than a full outer one, so that no hot key meets in one task:
    a hot target key is split by adaptive execution in the left join and is a single row in the anti join; a hot
    source key repeats, so in a merge that is not refused it matches nothing and its rows are inserted without a
    join, as are rows with null keys.
    """
    columns = target.columns
    taken = dict(update) if update is not None else {c: c for c in columns if c not in keys}
    present = all_present(keys)
    own, keyless = target.where(present), target.where(~present)
    own_keys = own.select(*keys).distinct()

    # Source keys seen twice that some target row holds: the whole merge is refused.
    counts = key_counts(source, keys)
    repeated = counts.where(F.col("__rows") > 1)
    refused = repeated.join(own_keys, keys, "left_semi").agg(F.count("*")).scalar()
    checked = F.assert_true(refused == 0, F.lit("a target row matches more than one source row")).isNull()
    hot = F.broadcast(hot_among(counts, more_than=1))

    incoming = source.where(present).join(hot, keys, "left_anti").select(*source.columns)
    alone = source.where(~present).unionByName(source.where(present).join(hot, keys, "left_semi").select(*source.columns))

    offered = incoming.select(
        *[F.col(k).alias(f"__k_{k}") for k in keys],
        *[F.col(s).alias(f"__s_{t}") for t, s in taken.items()],
        F.lit(True).alias("__matched"),
    )
    same_key = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"__k_{k}") for k in keys])
    paired = own.where(checked).join(offered, same_key, "left")
    matched = F.col("__matched").isNotNull()
    removed = matched & _holds(delete_matched) if delete_matched is not None else F.lit(False)
    rewritten = [
        F.when(matched, F.col(f"__s_{c}")).otherwise(F.col(c)).cast(target.schema[c].dataType).alias(c)
        if c in taken
        else F.col(c)
        for c in columns
    ]
    flagged = paired.select(*rewritten, removed.alias("__removed"), matched.alias(_FLAG)).unionByName(
        keyless.withColumns({"__removed": F.lit(False), _FLAG: F.lit(False)})
    )
    if insert:
        new = incoming.join(own_keys, keys, "left_anti").select(*columns)
        added = new.unionByName(alone.select(*columns))
        flagged = flagged.unionByName(added.withColumns({"__removed": F.lit(False), _FLAG: F.lit(True)}))
    result = _observed(flagged, observation).where(~F.col("__removed")).drop("__removed", _FLAG)
    return result, _count(flagged)
