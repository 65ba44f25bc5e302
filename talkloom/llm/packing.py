"""Filling containers of a fixed capacity with items, by local search on swaps and moves."""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkloom.session import checkpointed

CAPACITY = 2048
#: Items that one task packs at a time. The search runs inside such a shard, so its cost per item is fixed.
SHARD_ITEMS = 8192
#: Numbers kept for the bins of a shard; a shard has no more bins than items.
BINS = 1 << 20
#: Bins with more than this share of free room after the first round are packed again with those of other shards.
OPEN_SHARE = 0.01
#: Tasks of a round, at most.
TASKS = 200_000
#: Sweeps of the local search over the bins of a shard, at most.
SWEEPS = 30


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Start of the search: largest items first, each into the fullest bin that takes it. Gives positions by bin."""
    bins: list[list[int]] = []
    room: list[tuple[int, int]] = []  # free room and bin, sorted
    for i in sorted(range(len(sizes)), key=lambda j: (-sizes[j], j)):
        at = bisect_left(room, (sizes[i], -1))
        if at < len(room):
            free, b = room.pop(at)
            bins[b].append(i)
        else:
            free, b = capacity, len(bins)
            bins.append([i])
        if free > sizes[i]:
            insort(room, (free - sizes[i], b))
    return bins


def _step(sizes: list[int], a: list[int], b: list[int], free: int) -> tuple[list[int], list[int]] | None:
    """The best move from the emptier bin a to the fuller bin b, which has ``free`` room.

    Moves one item, exchanges one for one, or two of a for one of b; what b gains is at most its room and at
    least 1, so the sum of squared fills grows with each step.
    """
    best, found = 0, None
    for x in a:
        if best < sizes[x] <= free:
            best, found = sizes[x], ([x], [])
    if best == free:
        return found
    for y in b:
        limit = free + sizes[y]
        for i, x in enumerate(a):
            gain = sizes[x] - sizes[y]
            if best < gain <= free:
                best, found = gain, ([x], [y])
            rest = limit - sizes[x]
            if rest > 0:
                for z in a[i + 1 :]:
                    if best < (gain + sizes[z]) and sizes[z] <= rest:
                        best, found = gain + sizes[z], ([x, z], [y])
        if best == free:
            break
    return found


def local_search(sizes: list[int], bins: list[list[int]], capacity: int, sweeps: int = SWEEPS) -> list[list[int]]:
    """Empties bins by steps between bins with room, from the emptiest into the fullest, until none is left to take.

    It ends when the number of bins is the least possible (all items by capacity, rounded up), when a sweep
    changes nothing, or after ``sweeps`` sweeps.
    """
    least = -(-sum(sizes) // capacity)
    fill = [sum(sizes[i] for i in b) for b in bins]
    for _ in range(sweeps):
        alive = [k for k, b in enumerate(bins) if b]
        if len(alive) <= max(least, 1):
            break
        changed = False
        open_ = sorted((k for k in alive if fill[k] < capacity), key=lambda k: fill[k])
        for pos, d in enumerate(open_):
            for r in reversed(open_[pos + 1 :]):
                while bins[d] and fill[r] < capacity and fill[d] <= fill[r]:
                    step = _step(sizes, bins[d], bins[r], capacity - fill[r])
                    if step is None:
                        break
                    out, back = step
                    bins[d] = [i for i in bins[d] if i not in out] + back
                    bins[r] = [i for i in bins[r] if i not in back] + out
                    moved = sum(sizes[i] for i in out) - sum(sizes[i] for i in back)
                    fill[d] -= moved
                    fill[r] += moved
                    changed = True
                if not bins[d]:
                    break
            if not bins[d]:
                break  # the order of fills is another now
        if not changed:
            break
    return [b for b in bins if b]


def pack_items(sizes: list[int], capacity: int) -> list[list[int]]:
    """Positions of ``sizes`` by bin; items of size 0 go to the first bin."""
    solid = [i for i, s in enumerate(sizes) if s > 0]
    part = [sizes[i] for i in solid]
    bins = [[solid[i] for i in b] for b in local_search(part, best_fit(part, capacity), capacity)]
    none = [i for i, s in enumerate(sizes) if s <= 0]
    if none:
        bins = [bins[0] + none, *bins[1:]] if bins else [none]
    return bins


def _pack_shard(capacity: int, level: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["id", "item_tokens", "piece", "copy"], kind="stable").reset_index(drop=True)
        sizes = pdf["tokens"].tolist()
        number, offset, place, free = [0] * len(sizes), [0] * len(sizes), [0] * len(sizes), [0] * len(sizes)
        for k, b in enumerate(pack_items(sizes, capacity)):
            at = 0
            left = capacity - sum(sizes[i] for i in b)
            for p, i in enumerate(b):
                number[i], offset[i], place[i], free[i] = k, at, p, left
                at += sizes[i]
        pdf["item_no"] = (pdf["shard"] * BINS + pd.Series(number, dtype="int64")) * 2 + level
        pdf["place"], pdf["start_token"], pdf["free"] = place, offset, free
        return pdf[["id", "item_tokens", "copy", "piece", "first_token", "tokens", "item_no", "place", "start_token", "free"]]

    return run


_OUT = "id {t}, item_tokens bigint, copy bigint, piece bigint, first_token bigint, tokens bigint, item_no bigint, place bigint, start_token bigint, free bigint"


def pack(sizes: DataFrame, id_col: str, tokens_col: str, capacity: int = CAPACITY, shard_items: int = SHARD_ITEMS) -> DataFrame:
    """Assigns every item, or every piece of an item larger than ``capacity``, to a container.

    ``sizes`` has one row per item. The result has id, item_tokens (the item's size), copy (rows with equal id
    and size are counted 1, 2, ...), piece (0, 1, ...), first_token (of the piece in its item), tokens, item_no (the container; unique, not
    dense), place (order in the container) and start_token (where it begins there). An item is split only if
    it exceeds the capacity: into pieces of the capacity, which fill a container each, and a rest. Sizes of
    null or 0 take no room but get a place. Further columns are ignored; an empty table gives no rows.

    Items are dealt to shards of about ``shard_items`` by a hash of the id, each shard is packed by local
    search, and bins that stay open are packed once more with those of other shards.
    """
    kind = sizes.schema[id_col].dataType.simpleString()
    n = F.greatest(F.coalesce(F.col(tokens_col), F.lit(0)), F.lit(0)).cast("bigint")
    items = (
        sizes.select(F.col(id_col).alias("id"), n.alias("n"))
        .groupBy("id", "n")
        .agg(F.count(F.lit(1)).alias("copies"))
        .select("id", "n", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))).alias("copy"))
        .select("id", "n", "copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(F.floor((F.col("n") - 1) / capacity), F.lit(0)))).alias("piece"))
        .select("id", F.col("n").alias("item_tokens"), "copy", "piece", (F.col("piece") * capacity).alias("first_token"), F.least(F.col("n") - F.col("piece") * capacity, F.lit(capacity)).alias("tokens"))
    )
    items = checkpointed(items)  # counted, then dealt to that many shards

    def dealt(df: DataFrame, level: int) -> DataFrame:
        shards = max(1, -(-df.count() // shard_items))
        h = F.xxhash64("id", "item_tokens", "copy", "piece", F.lit(level))
        dealt_ = df.withColumn("shard", F.pmod(h, F.lit(shards))).repartition(min(shards, TASKS), "shard")  # a task per shard
        return dealt_.groupBy("shard").applyInPandas(_pack_shard(capacity, level), _OUT.format(t=kind))

    first = checkpointed(dealt(items, 0))
    still = F.col("free") > capacity * OPEN_SHARE
    again = dealt(first.where(still).select("id", "item_tokens", "copy", "piece", "first_token", "tokens"), 1)
    return first.where(~still).unionByName(again).drop("free")
