"""Scans along a key that may hold any share of all rows.

A window over one key runs in one task. Here the key's rows are cut into blocks (for instance of ten
minutes), each block is worked on alone, and only what a block must know of the blocks before or after
it is carried over. Carrying runs on one summary row per block, in two levels of ``FANOUT`` blocks, so no
task ever sees more than ``FANOUT`` rows of a key at a time in the first level.

Keys may be null. A key that is a struct around the nullable columns (``F.struct("dialogue_id")``) is never null
itself; then rows that are already together by (key, block) aren't shuffled again for the joins.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Blocks that one task of the first carrying level may see of a key.
FANOUT = 4096


@dataclass(frozen=True)
class Carry:
    """``out``: what ``func`` (max, min, sum, last, first) gives over ``col`` of all blocks before (or after) a block.

    Nulls are passed over; ``last`` and ``first`` take the nearest block that has a value. Without such a
    block the result is null, for sum 0.
    """

    out: str
    func: str
    col: str
    after: bool = False


@dataclass(frozen=True)
class Scan:
    """``out``: what ``func`` (max, min, sum, last) gives over ``col`` of the rows before a row, or after it.

    ``last`` is the value of the nearest row that has one, in either direction. The row itself counts if ``own``.
    """

    out: str
    func: str
    col: str
    after: bool = False
    own: bool = True


def _same(df: DataFrame, keys: Sequence[str], other: str = "__k") -> Column:
    """Equality of the keys with columns ``other`` + number; null equals null."""
    on = None
    for j, k in enumerate(keys):
        one = F.col(k).eqNullSafe(F.col(f"{other}{j}")) if df.schema[k].nullable else F.col(k) == F.col(f"{other}{j}")
        on = one if on is None else on & one
    return F.lit(True) if on is None else on


def _renamed(keys: Sequence[str]) -> list[Column]:
    return [F.col(k).alias(f"__k{j}") for j, k in enumerate(keys)]


def _agg(c: Carry, order: Column) -> Column:
    x = F.col(c.col)
    if c.func in ("last", "first"):
        pick = F.max_by if c.func == "last" else F.min_by
        return pick(x, F.when(x.isNotNull(), order))
    return {"max": F.max, "min": F.min, "sum": F.sum}[c.func](x)


def _over(c: Carry, keys: Sequence[str], order: str, src: str) -> Column:
    # Rows after a row are rows before it in the turned order, over which a running frame costs one step a row.
    w = Window.partitionBy(*keys).orderBy(F.col(order).desc() if c.after else F.col(order)).rowsBetween(Window.unboundedPreceding, -1)
    x = F.col(src)
    if c.func in ("last", "first"):
        near = (c.func == "first") == c.after
        return (F.last if near else F.first)(x, True).over(w)
    return {"max": F.max, "min": F.min, "sum": F.sum}[c.func](x).over(w)


def _both(c: Carry, near: Column, far: Column) -> Column:
    if c.func == "sum":
        return F.coalesce(near, F.lit(0)) + F.coalesce(far, F.lit(0))
    if c.func in ("last", "first"):
        return F.coalesce(near, far)
    return (F.greatest if c.func == "max" else F.least)(near, far)


def carry(blocks: DataFrame, keys: list[str], block: str, carries: list[Carry], fanout: int = FANOUT) -> DataFrame:
    """Adds the columns of ``carries`` to ``blocks``, which has one row per (keys, block); keys may be null."""
    sup = "__sup"
    b = blocks.withColumn(sup, F.floor(F.col(block) / fanout))
    near = b.select("*", *[_over(c, [*keys, sup], block, c.col).alias(f"__n{i}") for i, c in enumerate(carries)])
    tops = b.groupBy(*keys, sup).agg(*[_agg(c, F.col(block)).alias(f"__s{i}") for i, c in enumerate(carries)])
    tops = tops.select(*_renamed(keys), F.col(sup).alias("__ksup"), *[_over(c, keys, sup, f"__s{i}").alias(f"__f{i}") for i, c in enumerate(carries)])
    out = near.join(tops, (F.col(sup) == F.col("__ksup")) & _same(blocks, keys), "left")
    return out.select(*blocks.columns, *[_both(c, F.col(f"__n{i}"), F.col(f"__f{i}")).alias(c.out) for i, c in enumerate(carries)])


def join_blocks(rows: DataFrame, blocks: DataFrame, keys: list[str], block: str, how: str = "left") -> DataFrame:
    """``rows`` with the further columns of ``blocks`` (one row per keys and block); null keys match null keys."""
    cols = [c for c in blocks.columns if c not in (*keys, block)]
    right = blocks.select(*_renamed(keys), F.col(block).alias("__b"), *cols)
    return rows.join(right, _same(rows, keys) & (F.col(block) == F.col("__b")), how).select(*rows.columns, *cols)


def scan(rows: DataFrame, keys: list[str], block: str, order: Sequence[str], scans: Sequence[Scan]) -> DataFrame:
    """Adds the columns of ``scans``, in the order of (block, ``order``), in one pass over the blocks.

    The order must be total inside a key where ``last`` is asked for, and ``block`` must grow with it.
    """
    at = F.struct(*order)
    carries, sums, near = [], [], []
    for i, s in enumerate(scans):
        x = F.col(s.col)
        if s.func == "last":
            pick = F.min_by if s.after else F.max_by
            sums.append(pick(x, F.when(x.isNotNull(), at)).alias(f"__v{i}"))
        else:
            sums.append({"max": F.max, "min": F.min, "sum": F.sum}[s.func](x).alias(f"__v{i}"))
        carries.append(Carry(f"__far{i}", ("first" if s.after else "last") if s.func == "last" else s.func, f"__v{i}", s.after))
        w = Window.partitionBy(*keys, block).orderBy(*[F.col(c).desc() if s.after else F.col(c) for c in order])
        w = w.rowsBetween(Window.unboundedPreceding, 0 if s.own else -1)
        f = F.last(x, True) if s.func == "last" else {"max": F.max, "min": F.min, "sum": F.sum}[s.func](x)
        near.append(f.over(w).alias(f"__near{i}"))
    blocks = carry(rows.groupBy(*keys, block).agg(*sums), keys, block, carries).drop(*[f"__v{i}" for i in range(len(scans))])
    out = join_blocks(rows.select("*", *near), blocks, keys, block)
    return out.select(*rows.columns, *[_both(c, F.col(f"__near{i}"), F.col(f"__far{i}")).alias(s.out) for i, (c, s) in enumerate(zip(carries, scans))])


def neighbour(rows: DataFrame, keys: list[str], block: str, order: list[str], cols: list[str], after: bool = False, prefix: str = "prev_") -> DataFrame:
    """Adds ``cols`` of the row before (or after) each row of its key, in the order of (block, ``order``), as prefix + name.

    The order must be total inside a key; ``block`` must grow with it.
    """
    out = scan(rows.withColumn("__own", F.struct(*cols)), keys, block, order, [Scan("__at", "last", "__own", after, own=False)])
    return out.select(*rows.columns, *[F.col(f"__at.{c}").alias(prefix + c) for c in cols])


def running(rows: DataFrame, keys: list[str], block: str, order: list[str], func: str, col: str, out: str, inclusive: bool = True) -> DataFrame:
    """Adds the running sum, max or min of ``col`` over the rows of a key up to each row (or before it)."""
    return scan(rows, keys, block, order, [Scan(out, func, col, own=inclusive)])


def numbered(rows: DataFrame, keys: list[str], block: str, order: list[str], out: str) -> DataFrame:
    """Adds the number, from 1, of each row in its key."""
    return running(rows.withColumn("__one", F.lit(1).cast("bigint")), keys, block, order, "sum", "__one", out).drop("__one")


def tails(rows: DataFrame, keys: list[str], block: str, order: list[str], col: str, k: int, out: str, fanout: int = FANOUT) -> DataFrame:
    """Adds ``out`` to the blocks of ``rows``: (keys, block, out), the last ``k`` values of ``col`` (not null) before the block, in order.

    Each block has a row at least, so the rows wanted lie in the ``k`` blocks before it.
    """
    sup = "__sup"

    def last_k(df: DataFrame, by: list[str], at: list[str]) -> DataFrame:
        """The last k values of each group, as an array in order."""
        w = Window.partitionBy(*by).orderBy(*[F.col(c).desc() for c in at])
        few = df.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= k)
        return few.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("__r")).alias("__r"), F.col("__x")))), lambda e: e["__x"]).alias("__t"))

    def joined(df: DataFrame, w) -> Column:
        """The last k values of the up to k rows before a row."""
        parts = [F.coalesce(F.lag("__t", i).over(w), F.array().cast(df.schema["__t"].dataType)) for i in range(k, 0, -1)]
        return F.concat(*parts)

    own = last_k(rows.select(*keys, block, *order, F.col(col).alias("__x")), [*keys, block], list(order)).withColumn(sup, F.floor(F.col(block) / fanout))
    near = own.withColumn("__near", joined(own, Window.partitionBy(*keys, sup).orderBy(block)))
    tops = last_k(own.select(*keys, sup, block, F.posexplode("__t").alias("__i", "__x")), [*keys, sup], [block, "__i"])
    tops = tops.select(*_renamed(keys), F.col(sup).alias("__ksup"), joined(tops, Window.partitionBy(*keys).orderBy(sup)).alias("__far"))
    both = near.join(tops, (F.col(sup) == F.col("__ksup")) & _same(near, keys), "left")
    every = F.concat(F.coalesce("__far", F.array().cast(own.schema["__t"].dataType)), "__near")
    return both.select(*keys, block, F.slice(every, F.greatest(F.size(every) - k + 1, F.lit(1)), k).alias(out))
