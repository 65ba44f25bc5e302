"""Overlapping, nested and gapped time intervals: continuous periods and the pauses between them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkloom.operators.blocks import Carry, carry, join_blocks

#: Intervals are merged inside blocks of this length before anything is carried from block to block.
BLOCK_MS = 600_000


def to_ms(seconds: Column) -> Column:
    """Seconds as whole milliseconds, rounded half away from zero."""
    return F.round(seconds * 1000).cast("bigint")


#: Seconds from here on have no place in whole milliseconds of 64 bits with room to reckon; only such times, infinite ones too, are taken for missing.
FAR_S = 2.0**52


def usable(start: Column, end: Column) -> Column:
    """Start and end present, not NaN, and end >= start."""
    return start.isNotNull() & end.isNotNull() & ~F.isnan(start) & ~F.isnan(end) & (end >= start) & (start > -FAR_S) & (end < FAR_S)


def merged_blocks(df: DataFrame, keys: list[str], start: str = "start_ms", end: str = "end_ms", block_ms: int = BLOCK_MS) -> DataFrame:
    """Disjoint intervals ``(keys, block, s, e)`` per block, from session windows with a duration of its own for every row.

    An interval [s, e] becomes a session that ends one microsecond after e, so that intervals which touch in
    a millisecond merge, points (s = e) stay, and a pause of one millisecond is kept.
    """
    k = [F.col(c).alias(f"__k{i}") for i, c in enumerate(keys)]
    rows = df.where(F.col(start).isNotNull() & (F.col(end) >= F.col(start))).select(
        *k,
        F.floor(F.col(start) / block_ms).alias("block"),
        F.timestamp_micros(F.col(start) * 1000).alias("__at"),
        ((F.col(end) - F.col(start)) * 1000 + 1).alias("__us"),
    )
    length = F.expr("make_interval(0, 0, 0, 0, 0, 0, cast(cast(__us as decimal(18,0)) / 1000000 as decimal(18,6)))")
    names = [f"__k{i}" for i in range(len(keys))]
    merged = rows.groupBy(*names, "block", F.session_window("__at", length).alias("__w")).agg(F.count(F.lit(1)).alias("__n"))
    return merged.select(
        *[F.col(n).alias(c) for n, c in zip(names, keys)],
        "block",
        (F.unix_micros("__w.start") / 1000).cast("bigint").alias("s"),
        ((F.unix_micros("__w.end") - 1) / 1000).cast("bigint").alias("e"),
    )


def _with_neighbours(df: DataFrame, keys: list[str], start: str, end: str, block_ms: int) -> DataFrame:
    """Merged intervals with ``before`` (latest end so far) and ``next_start`` over the borders of blocks."""
    parts = merged_blocks(df, keys, start, end, block_ms)
    sums = parts.groupBy(*keys, "block").agg(F.max("e").alias("__e"), F.min("s").alias("__s"))
    sums = carry(sums, keys, "block", [Carry("__c", "max", "__e"), Carry("__next", "first", "__s", after=True)]).drop("__e", "__s")
    w = Window.partitionBy(*keys, "block").orderBy("s")
    rows = join_blocks(parts, sums, keys, "block")
    return rows.select(
        *keys,
        "block",
        "s",
        "e",
        F.greatest("e", "__c").alias("reach"),
        (F.col("__c").isNull() & F.lag("s").over(w).isNull()).alias("first"),
        F.greatest(F.lag("e").over(w), F.col("__c")).alias("before"),
        F.coalesce(F.lead("s").over(w), F.col("__next")).alias("next_start"),
    )


def gaps(df: DataFrame, keys: list[str], start: str = "start_ms", end: str = "end_ms", block_ms: int = BLOCK_MS) -> DataFrame:
    """Every pause ``(keys, gap_start_ms, gap_end_ms)`` between neighbouring periods of the union of a key's intervals.

    Intervals overlap, nest, repeat or touch in any way; touching ones leave no pause. Rows with null, or with
    an end before the start, are passed over; a null key is a key of its own; an empty table gives no rows;
    further columns are ignored. A key may hold any share of the rows: it is cut into blocks of time.
    """
    rows = _with_neighbours(df, keys, start, end, block_ms)
    return rows.where(F.col("next_start") > F.col("reach")).select(
        *keys, F.col("reach").alias("gap_start_ms"), F.col("next_start").alias("gap_end_ms")
    )


def periods(df: DataFrame, keys: list[str], start: str = "start_ms", end: str = "end_ms", max_gap_ms: int = 0, block_ms: int = BLOCK_MS) -> DataFrame:
    """Continuous periods ``(keys, period_start_ms, period_end_ms)`` of each key's intervals.

    Pauses of up to ``max_gap_ms`` are bridged. Cases as for ``gaps``.
    """
    rows = _with_neighbours(df, keys, start, end, block_ms)
    rows = rows.withColumn("opens", F.col("first") | (F.col("s") - F.col("before") > max_gap_ms)).withColumn(
        "closes", F.when(F.col("next_start").isNull() | (F.col("next_start") - F.col("reach") > max_gap_ms), F.col("reach"))
    )
    sums = rows.groupBy(*keys, "block").agg(F.min("closes").alias("__closes"))
    sums = carry(sums, keys, "block", [Carry("__later", "first", "__closes", after=True)]).drop("__closes")
    w = Window.partitionBy(*keys, "block").orderBy("s").rowsBetween(0, Window.unboundedFollowing)
    rows = join_blocks(rows.withColumn("__here", F.min("closes").over(w)), sums, keys, "block")
    return rows.where("opens").select(
        *keys, F.col("s").alias("period_start_ms"), F.coalesce("__here", "__later").alias("period_end_ms")
    )


def usable_speech(words: DataFrame) -> DataFrame:
    """Rows of a word table of speakers A and B with a possible time, in milliseconds."""
    ok = F.col("speaker").isin("A", "B") & usable(F.col("start"), F.col("end"))
    return words.where(ok).select("dialogue_id", "speaker", to_ms(F.col("start")).alias("start_ms"), to_ms(F.col("end")).alias("end_ms"))
