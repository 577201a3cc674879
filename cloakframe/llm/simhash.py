"""SimHash near-duplicates, with candidates found by the pigeonring principle.

The 64 bits are a ring of four segments. If two fingerprints differ in at most three bits, there is a segment from
which every chain of 1, 2, 3 or 4 consecutive segments keeps to its share of the budget: 0, 1, 2 and 3 differing
bits. So candidates agree in some whole segment and, as the next segment may differ in one bit only, in one half of
that one too: 24 bits that serve as bucket key. The chain is then checked on each pair before its full distance.

A bucket of more than ``BUCKET`` fingerprints is split: the bits outside its key are cut into four parts, of which
three differing bits leave one equal, so each fingerprint goes on under four longer keys. The last keys leave eight
bits open, so no bucket ever holds more than 256 different fingerprints, and no pair is lost on the way.

Equal fingerprints are one node, whatever number of documents has them. Components come from alternating star
steps, each written to the shared folder.

Results in odd cases: a null or empty text has the fingerprint zero and is linked like any other; rows that share an
id are linked each by their own text; a null id is never a component's name unless all its ids are null; an empty
table gives no rows; other columns are ignored, so their names cannot clash.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cloakframe.llm.common import stored
from cloakframe.operators.hot_keys import left_lookup

SHINGLE, SEED, DISTANCE = 3, 42, 3
SEGMENTS, BITS = 4, 16
BUCKET = 64
ALL = (1 << 64) - 1
OPEN_BITS = 8
SLICE = 1 << 16  # shingles whose bits are counted at once


def text_fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """The SimHash of the word shingles of a text, repeats included: a bit is 1 if over half the hashes have it."""
    words = (text or "").encode().lower().split()  # bytes: only A-Z change, only ASCII white space splits
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_digest
    if len(words) <= size:
        hashes = digest(joined, SEED)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        first, last = np.concatenate(([0], ends[:-size] + 1)).tolist(), ends[size - 1 :].tolist()
        hashes = b"".join([digest(joined[a:b], SEED) for a, b in zip(first, last, strict=True)])
    rows = np.frombuffer(hashes, np.uint8).reshape(-1, 8)
    set_bits = np.zeros(64, np.int64)
    for i in range(0, len(rows), SLICE):
        set_bits += np.unpackbits(rows[i : i + SLICE], axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(set_bits * 2 > len(rows)).tobytes(), "big")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp): the fingerprint as a signed long."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([_signed(text_fingerprint(t)) for t in texts], dtype="int64")

    return docs.select(F.col(id_col).alias("id"), of(F.col(text_col)).alias("fp"))


def _parts(mask: int, n: int) -> list[int]:
    """The bits outside a mask, cut into n masks of nearly equal size."""
    rest = [b for b in range(64) if not mask >> b & 1]
    return [sum(1 << int(b) for b in part) for part in np.array_split(rest, n) if len(part)]


def _first_masks() -> list[tuple[int, int]]:
    """(start segment, mask): a whole segment and one half of the next."""
    segment = (1 << BITS) - 1
    half = (1 << BITS // 2) - 1
    return [
        (i, segment << BITS * i | half << (BITS * ((i + 1) % SEGMENTS) + BITS // 2 * h))
        for i in range(SEGMENTS)
        for h in range(2)
    ]


def _rows(spark, values: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame([tuple(_signed(v) for v in row) for row in values], schema)


def _chain_holds(x: Column, start: Column) -> Column:
    """Whether all chains of segments from ``start`` on keep to their share of the budget."""
    segment = (1 << BITS) - 1
    differing = [
        F.bit_count(F.shiftrightunsigned(x, BITS * i).bitwiseAND(F.lit(segment).cast("long"))) for i in range(SEGMENTS)
    ]
    holds = F.lit(False)
    for i in range(SEGMENTS):
        ring = [differing[(i + k) % SEGMENTS] for k in range(SEGMENTS)]
        sums = [reduce(lambda a, b: a + b, ring[: k + 1]) for k in range(SEGMENTS)]
        chain = reduce(lambda a, b: a & b, [s <= DISTANCE * (k + 1) // SEGMENTS for k, s in enumerate(sums)])
        holds = F.when(start == i, chain).otherwise(holds)
    return holds


def _pairs(rows: DataFrame) -> DataFrame:
    """The linked pairs of rows (start, mask, key, fp) of one bucket."""
    other = rows.select("start", "mask", "key", F.col("fp").alias("other"))
    x = F.col("fp").bitwiseXOR(F.col("other"))
    near = rows.join(other, ["start", "mask", "key"]).where(F.col("fp") < F.col("other"))
    return near.where(_chain_holds(x, F.col("start")) & (F.bit_count(x) <= DISTANCE)).select("fp", "other")


def links(nodes: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Pairs (fp, other) of different fingerprints that differ in at most ``DISTANCE`` bits; ``nodes`` has one row
    (fp) for each."""
    spark = nodes.sparkSession
    masks = _first_masks()
    first = F.array(*[F.struct(F.lit(i).alias("start"), F.lit(_signed(m)).alias("mask")) for i, m in masks])
    rows = nodes.select("fp", F.explode(first).alias("m")).select("fp", "m.*")
    rows = rows.withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))
    found, here = [], {m for _, m in masks}
    while True:
        large = rows.groupBy("start", "mask", "key").agg(F.count("*").alias("n")).where(F.col("n") > bucket).drop("n")
        large = stored(large, "large")
        last = all(64 - m.bit_count() <= OPEN_BITS for m in here)
        if last or large.isEmpty():
            return reduce(DataFrame.unionByName, [*found, _pairs(rows)]).distinct()
        found.append(_pairs(rows.join(large, ["start", "mask", "key"], "left_anti")))
        # A mask with no bits to cut stays as it is.
        cuts = {m: [m | p for p in _parts(m, 4)] if 64 - m.bit_count() > OPEN_BITS else [m] for m in here}
        children = _rows(spark, [(m, c) for m, longer in cuts.items() for c in longer], "mask long, longer long")
        split = rows.join(large, ["start", "mask", "key"], "left_semi").join(F.broadcast(children), "mask")
        split = split.select("fp", "start", F.col("longer").alias("mask"))
        rows = stored(split.withColumn("key", F.col("fp").bitwiseAND(F.col("mask"))), "split")
        here = {c for longer in cuts.values() for c in longer}


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (fp, other) but the roots; a root is the least node that can be reached.

    Large-star hangs each node's larger neighbours on its least one, small-star its smaller ones; after a number of
    rounds that grows with the logarithm of the nodes, every node hangs on its root.
    """
    now, state = stored(edges.select(F.col("other").alias("u"), F.col("fp").alias("v")), "edges"), None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()  # each pair has its larger node first
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = stored(moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "stars")
        was, state = state, now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.hash("u", "v"))).first()
        if state == was:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket: int = BUCKET) -> DataFrame:
    """One row per document: id, fingerprint (16 hex digits), component_id, the least id that links reach."""
    prints = stored(fingerprints(docs, id_col, text_col), "prints")
    nodes = stored(prints.groupBy("fp").agg(F.min("id").alias("least")), "nodes")
    roots = components(links(nodes.select("fp"), bucket))
    named = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    names = named.groupBy("root").agg(F.min("least").alias("component_id"))
    looked_up = stored(named.join(names, "root").select("fp", "component_id"), "names")
    return left_lookup(prints, looked_up, "fp", "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents whose id is the least of their component, with all their columns. Of several rows with that id
    the first by text and then by a hash of the row stays. Rows without an id cannot be told apart and all stay."""
    verdict = near_duplicates(docs, id_col, text_col)
    chosen = verdict.where(F.col(id_col) == F.col("component_id")).select(F.col(id_col).alias("id")).distinct()
    packed = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    first = Window.partitionBy("id").orderBy("text", F.xxhash64("row"))
    named = packed.where(F.col("id").isNotNull()).withColumn("nth", F.row_number().over(first)).where("nth = 1")
    kept = named.join(chosen, "id", "left_semi").unionByName(packed.where(F.col("id").isNull()), allowMissingColumns=True)
    return kept.select("row.*")
