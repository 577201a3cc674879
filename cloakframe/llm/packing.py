"""Best-fit packing into bins of several permitted capacities.

Documents are cut into pieces of at most the largest capacity. Pieces are dealt at random into groups of about
``GROUP`` pieces, and each group is packed by itself, the largest pieces first:

1. A piece goes into the open bin that it leaves with the least room.
2. If none has room, a bin is opened. For each capacity that holds the piece, it is worked out how full the pieces
   still to come could make it, the largest that fits each time; the capacity with the least cost per token is opened.
   A bin costs its capacity and ``overhead``.
3. In the end every bin shrinks to the least permitted capacity that holds its contents.

Only ids and lengths are shuffled, and a group's size does not grow with the data.

Results in odd cases: a document of null, zero or negative length needs no room and has one row without a bin; equal
ids are separate documents; an empty table has no rows; other columns are ignored, so their names cannot clash.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cloakframe.llm.common import stored

CAPACITIES = (512, 1024, 2048, 4096, 8192)
OVERHEAD = 16
GROUP = 8192


class _Left:
    """How many pieces of each length are still to come, and the largest length that fits into some room."""

    def __init__(self, lengths: list[int], largest: int):
        self.count = np.bincount(lengths, minlength=largest + 1).tolist()
        self.down = [i if n else i - 1 for i, n in enumerate(self.count)]

    def find(self, room: int) -> int:
        """The largest length up to ``room`` of which a piece is left, or 0 or less."""
        at = room
        while at > 0 and self.down[at] != at:
            at = self.down[at]
        while room > 0 and self.down[room] != at:
            self.down[room], room = at, self.down[room]
        return at

    def take(self, length: int) -> None:
        self.count[length] -= 1
        if not self.count[length]:
            self.down[length] = length - 1

    def fill(self, room: int) -> int:
        """How much of the room the pieces left can take, the largest that fits each time."""
        filled, at = 0, min(room, len(self.count) - 1)
        while (at := self.find(min(at, room - filled))) > 0:
            filled += at * min(self.count[at], (room - filled) // at)
            at -= 1
        return filled


def pack(lengths: list[int], capacities: tuple[int, ...] = CAPACITIES, overhead: int = OVERHEAD) -> list[tuple[int, int, int]]:
    """(bin, its final capacity, offset) of each length; lengths are from 1 to the largest capacity."""
    sizes = sorted(set(capacities))
    left = _Left(lengths, sizes[-1])
    rooms: list[int] = []  # the different amounts of room that open bins have
    with_room: dict[int, list[int]] = {}
    used: list[int] = []
    place: list[tuple[int, int]] = [(0, 0)] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
        length = lengths[i]
        left.take(length)
        at = bisect_left(rooms, length)
        if at < len(rooms):
            room = rooms[at]
            number = heapq.heappop(with_room[room])
            if not with_room[room]:
                del with_room[room], rooms[at]
        else:
            fitting = sizes[bisect_left(sizes, length) :]
            # Least cost per token; the smaller capacity on a tie.
            room = min(fitting, key=lambda c: ((c + overhead) / (length + left.fill(c - length)), c))
            number = len(used)
            used.append(0)
        place[i] = (number, used[number])
        used[number] += length
        if room > length:
            if room - length not in with_room:
                insort(rooms, room - length)
            heapq.heappush(with_room.setdefault(room - length, []), number)
    return [(number, sizes[bisect_left(sizes, used[number])], offset) for number, offset in place]


def pieces(docs: DataFrame, length: Column, id_col: str, largest: int) -> DataFrame:
    """(id, piece, n): documents cut into pieces of at most ``largest``."""
    sized = docs.select(F.col(id_col).alias("id"), F.greatest(F.coalesce(length, F.lit(0)), F.lit(0)).cast("long").alias("whole"))
    last = F.greatest(F.ceil(F.col("whole") / largest) - 1, F.lit(0))
    cut = sized.select("id", "whole", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("piece"))
    return cut.select("id", "piece", F.least(F.col("whole") - F.col("piece") * largest, F.lit(largest)).cast("int").alias("n"))


def best_fit(
    docs: DataFrame,
    length: Column,
    id_col: str = "doc_id",
    capacities: tuple[int, ...] = CAPACITIES,
    overhead: int = OVERHEAD,
    group: int = GROUP,
) -> DataFrame:
    """One row per piece: id, piece, n_tokens, bin_id, bin_capacity, bin_offset."""
    # Written first, so that the row numbers that deal pieces into groups are the same whenever a task runs again.
    cut = stored(pieces(docs, length, id_col, max(capacities)), "pieces")
    groups = max(1, -(-cut.count() // group))
    dealt = cut.withColumn("part", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)).cast("int"))

    def packed(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["n", "id", "piece"], ascending=[False, True, True], kind="stable")
        placed = pack(rows["n"].tolist(), capacities, overhead)
        bins, sizes, offsets = (np.array(x, dtype="int64") for x in zip(*placed, strict=True))
        return pd.DataFrame(
            {
                "id": rows["id"].to_numpy(), "piece": rows["piece"].to_numpy(), "n_tokens": rows["n"].to_numpy(),
                "bin_id": rows["part"].to_numpy().astype("int64") * 2**32 + bins,
                "bin_capacity": sizes, "bin_offset": offsets,
            }
        )

    # Ids go through as text, which keeps a null from turning whole numbers into floating-point ones.
    kind = cut.schema["id"].dataType
    schema = "id string, piece long, n_tokens int, bin_id long, bin_capacity int, bin_offset int"
    full = dealt.where("n > 0").withColumn("id", F.col("id").cast("string"))
    placed = full.groupBy("part").applyInPandas(packed, schema)
    empty = cut.where("n = 0").select(
        F.col("id").cast("string").alias("id"), "piece", F.col("n").alias("n_tokens"),
        *[F.lit(None).cast(t).alias(c) for c, t in (("bin_id", "long"), ("bin_capacity", "int"), ("bin_offset", "int"))],
    )
    return placed.unionByName(empty).withColumn("id", F.col("id").cast(kind)).withColumnRenamed("id", id_col)
