"""Resharding by minimum-cost flow.

Documents lie in old shards. Every old shard is cut into *blocks* by a hash of the text, so equal texts share a block;
a block larger than a new shard is cut again by a hash of the id. Only the blocks' sizes come to the driver: their
number is fixed by the parameters, not by the data.

New shards have capacities, equal ones or as given, and each is filled in proportion to its own within ``slack``. A flow
from old shards, with their sizes, to new shards, with these bounds, costs nothing where the shard stays the same and one
per byte elsewhere; its minimum says how many bytes each shard gives and takes. All moves cost the same, so they pass
through one node in the middle, and the network has a few edges per shard, not one per pair. Blocks are then chosen to
carry those amounts; what rounding to whole blocks leaves uneven is mended with blocks that move anyway, as far as there
are any. Only shards that gain or lose a block are rewritten.

Results in odd cases: a null text has no bytes and counts one; rows with equal ids and texts travel together; null
ids are hashed like any other; an empty table is spread over no files and has no rows; other columns travel along, and
clashing names are refused.
"""

from __future__ import annotations

import heapq
import math
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cloakframe.llm.common import stored

BLOCKS = 256  # blocks of an old shard
CUTS = 16  # parts of a block that is larger than a new shard
SLACK = 0.0025
FILE_BYTES = 128 << 20


def min_cost_flow(edges: list[tuple[int, int, int, int]], nodes: int, source: int, sink: int) -> tuple[int, list[int]]:
    """Edges are (from, to, capacity, cost). Returns the flow and what each edge carries in a maximum flow of least
    cost. Shortest distances become potentials; then all paths of that length are filled before distances are sought
    again, so there are as many rounds as different path costs. Edges may cost less than nothing, cycles may not."""
    to, left, cost, out = [], [], [], [[] for _ in range(nodes)]
    for a, b, capacity, price in edges:
        for x, y, c, p in ((a, b, capacity, price), (b, a, 0, -price)):
            out[x].append(len(to))
            to.append(y)
            left.append(c)
            cost.append(p)
    far = float("inf")
    potential, total = [far] * nodes, 0
    potential[source] = 0
    changed = True
    while changed:  # Bellman-Ford, as costs may be negative at the start
        changed = False
        for x in range(nodes):
            for e in out[x] if potential[x] < far else ():
                if left[e] and potential[x] + cost[e] < potential[to[e]]:
                    potential[to[e]] = potential[x] + cost[e]
                    changed = True
    potential = [p if p < far else 0 for p in potential]

    def fill() -> int:
        """Sends what goes along edges of no reduced cost."""
        sent, used = 0, [0] * nodes
        while True:
            path, x, on = [], source, {source}
            while x != sink:
                for i in range(used[x], len(out[x])):
                    e = out[x][i]
                    if left[e] and to[e] not in on and potential[x] + cost[e] == potential[to[e]]:
                        used[x] = i
                        path.append(e)
                        x = to[e]
                        on.add(x)
                        break
                else:
                    if not path:
                        return sent
                    used[x] = len(out[x])
                    x = to[path.pop() ^ 1]
                    used[x] += 1
            amount = min(left[e] for e in path)
            for e in path:
                left[e] -= amount
                left[e ^ 1] += amount
            sent += amount

    while True:
        while sent := fill():
            total += sent
        distance, heap = [far] * nodes, [(0, source)]
        distance[source] = 0
        while heap:
            d, x = heapq.heappop(heap)
            if d > distance[x]:
                continue
            for e in out[x]:
                y = to[e]
                if left[e] and (reached := d + cost[e] + potential[x] - potential[y]) < distance[y]:
                    distance[y] = reached
                    heapq.heappush(heap, (reached, y))
        if distance[sink] == far:
            return total, [left[i + 1] for i in range(0, len(to), 2)]
        most = max(d for d in distance if d < far)
        potential = [p + min(d, most) for p, d in zip(potential, distance, strict=True)]


def bounds(total: int, capacities: Sequence[float], slack: float = SLACK) -> list[tuple[int, int]]:
    """The least and the most bytes of each new shard, in proportion to the capacities."""
    whole = sum(capacities)
    means = [total * c / whole for c in capacities]
    return [(int(m * (1 - slack)), math.ceil(m * (1 + slack))) for m in means]


def transfers(old: dict[int, int], capacities: Sequence[float], slack: float = SLACK) -> tuple[dict[tuple[int, int], int], int]:
    """Bytes that go from each old to each new shard, and how many of them move: as few as the bounds allow."""
    names, shards = sorted(old), len(capacities)
    limits = bounds(sum(old.values()), capacities, slack)
    source, sink, middle, first, last = 0, 1, 2, 3, 3 + len(names)
    edges = []
    for i, a in enumerate(names):
        edges += [(source, first + i, old[a], 0), (first + i, middle, old[a], 1)]
        if 0 <= a < shards:
            edges.append((first + i, last + a, old[a], 0))
    for j, (low, high) in enumerate(limits):
        # Filling every shard to its lower bound is worth more than any move costs.
        edges += [(middle, last + j, high, 0), (last + j, sink, low, -2), (last + j, sink, high - low, 0)]
    _, flow = min_cost_flow(edges, last + shards, source, sink)
    found: dict[tuple[int, int], int] = {}
    gives, takes = [], []
    for (x, y, _, _), amount in zip(edges, flow, strict=True):
        if amount and y == middle:
            gives.append([names[x - first], amount])
        elif amount and x == middle:
            takes.append([y - last, amount])
        elif amount and first <= x < last <= y:
            found[names[x - first], y - last] = amount
    moved = sum(n for _, n in gives)
    while gives:  # whoever gives is matched with whoever takes; a shard does not take from itself at the least cost
        (a, n), (j, m) = gives[-1], takes[-1]
        sent = min(n, m)
        found[a, j] = found.get((a, j), 0) + sent
        gives[-1][1] -= sent
        takes[-1][1] -= sent
        if not gives[-1][1]:
            gives.pop()
        if not takes[-1][1]:
            takes.pop()
    return found, moved


def assign_blocks(blocks: dict[tuple, int], capacities: Sequence[float], slack: float = SLACK) -> tuple[dict[tuple, int], int]:
    """The new shard of each block (old shard, ...) of so many bytes, and the least number of bytes that a flow moves.
    From the largest block on, each takes the largest amount that its old shard still has to send, staying where it is
    on a tie."""
    old: dict[int, int] = defaultdict(int)
    for key, size in blocks.items():
        old[key[0]] += size
    due: dict[int, dict[int, int]] = defaultdict(dict)
    sent, least = transfers(old, capacities, slack)
    for (a, j), amount in sent.items():
        due[a][j] = amount
    chosen = {}
    for key in sorted(blocks, key=lambda k: (-blocks[k], k)):
        open_ = due[key[0]] or {key[0] % len(capacities): 0}
        j = max(open_, key=lambda x: (open_[x], x == key[0], -x))
        open_[j] -= blocks[key]
        chosen[key] = j
    return _evened(blocks, chosen, capacities, slack), least


def _evened(blocks: dict[tuple, int], chosen: dict[tuple, int], capacities: Sequence[float], slack: float) -> dict[tuple, int]:
    """Moves blocks from the relatively fullest to the emptiest shard while that narrows the gap between the two; blocks
    that have left their old shard first, as they cost nothing more."""
    shards, whole = len(capacities), sum(capacities)
    total = sum(blocks.values())
    means = [total * c / whole for c in capacities]
    over, held = [-m for m in means], [[] for _ in range(shards)]
    for key, j in chosen.items():
        over[j] += blocks[key]
        held[j].append((blocks[key], key))
    for _ in range(len(blocks)):
        a, b = max(range(shards), key=over.__getitem__), min(range(shards), key=over.__getitem__)
        gap = over[a] - over[b]
        if gap <= 2 * slack * min(means):
            break
        fits = [x for x in held[a] if 0 < x[0] < gap]
        if not fits:
            break
        size, key = min(fits, key=lambda x: (x[1][0] == a, x[1][0] != b, abs(gap / 2 - x[0]), x[1]))
        held[a].remove((size, key))
        held[b].append((size, key))
        over[a], over[b], chosen[key] = over[a] - size, over[b] + size, b
    return chosen


@dataclass
class Plan:
    """``placed`` is the input with ``shard``; ``changed`` names the new shards that gain or lose a block; ``moved`` bytes
    change their shard, of which a flow that could split blocks would move the ``least``."""

    placed: DataFrame
    shards: int
    total: int
    moved: int
    least: int
    changed: list[int]


def _size(text_col: str) -> Column:
    return (F.coalesce(F.octet_length(text_col), F.lit(0)) + 1).cast("long")


def plan_reshard(
    docs: DataFrame,
    old_shard: Column,
    shards: int | Sequence[float],
    id_col: str = "doc_id",
    text_col: str = "text",
    blocks: int = BLOCKS,
    slack: float = SLACK,
) -> Plan:
    """Where every document goes, moving as few bytes as the bounds allow. ``old_shard`` is a number of each row;
    ``shards`` is the number of new shards, or the capacity of each, in bytes or in any other unit."""
    capacities = [1.0] * shards if isinstance(shards, int) else list(shards)
    if not capacities or min(capacities) <= 0:
        raise ValueError("shards need capacities above 0")
    clash = {c.lower() for c in docs.columns} & {"old_shard", "block", "cut", "shard"}
    if clash:
        raise ValueError(f"input columns would be hidden: {sorted(clash)}")
    spark = docs.sparkSession
    marked = docs.withColumns(
        {
            "old_shard": old_shard.cast("int"),
            "block": F.pmod(F.xxhash64(F.coalesce(text_col, F.lit("")), F.lit("block")), F.lit(blocks)).cast("int"),
            "cut": F.pmod(F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit("cut")), F.lit(CUTS)).cast("int"),
        }
    )
    # At most old shards x blocks x cuts rows.
    sums = marked.groupBy("old_shard", "block", "cut").agg(F.sum(_size(text_col)).alias("n")).collect()
    total = sum(r.n for r in sums)
    of_block: dict[tuple, int] = defaultdict(int)
    for r in sums:
        of_block[r.old_shard, r.block] += r.n
    large = {k for k, n in of_block.items() if n > total * min(capacities) / sum(capacities)}
    units: dict[tuple, int] = defaultdict(int)
    for r in sums:
        key = (r.old_shard, r.block)
        units[(*key, r.cut) if key in large else (*key, -1)] += r.n
    chosen, least = assign_blocks(dict(units), capacities, slack)
    changed = {x for key, j in chosen.items() if j != key[0] for x in (j, key[0])}
    listed = [(*k, c, j) for (*k, cut), j in chosen.items() for c in (range(CUTS) if cut < 0 else [cut])]
    table = spark.createDataFrame(listed, "old_shard int, block int, cut int, shard int")
    placed = marked.join(F.broadcast(table), ["old_shard", "block", "cut"], "left").select(
        *docs.columns, "old_shard", "block", "cut", "shard"
    )
    moved = sum(n for key, n in units.items() if chosen[key] != key[0])
    return Plan(placed, len(capacities), total, moved, least, sorted(x for x in changed if x < len(capacities)))


def rewrite(plan: Plan, folder: str, only_changed: bool = True) -> DataFrame:
    """Writes the changed shards, or all, as ``shard=N`` folders of Parquet files of moderate size, and reads them."""
    files = max(1, -(-plan.total // plan.shards // FILE_BYTES))
    rows = plan.placed.where(F.col("shard").isin(plan.changed)) if only_changed else plan.placed
    spread = rows.repartition("shard", F.pmod(F.col("block") * CUTS + F.col("cut"), F.lit(files)))
    spread.write.partitionBy("shard").parquet(folder)
    spark = plan.placed.sparkSession
    return spark.read.schema(plan.placed.schema).option("basePath", folder).parquet(folder)


def with_slots(written: DataFrame) -> DataFrame:
    """The rows of written shards with ``slot``: the place in the shard, without gaps from 0. A row's place in its
    file is known from the file; only files are numbered against each other."""
    placed = written.select(
        "*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row")
    )
    files = stored(
        placed.groupBy("shard", "__file").agg(F.count("*").alias("n")), "files"
    )
    before = Window.partitionBy("shard").orderBy("__file").rowsBetween(Window.unboundedPreceding, -1)
    based = files.select("__file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__base"))
    joined = placed.join(F.broadcast(based) if based.count() <= 100_000 else based, "__file")
    return joined.withColumn("slot", F.col("__base") + F.col("__row")).drop("__file", "__row", "__base")
