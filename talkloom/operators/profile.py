"""Column-level data quality profile by load, with changes against a baseline and between loads."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Value classes per column; a value in none of them falls into one more class.
CLASSES = 4


@dataclass(frozen=True)
class Rule:
    """What is known of a column.

    ``pattern``: regular expression that a text must match as a whole, if it is neither null nor empty.
    ``classes``: up to four conditions; a value belongs to the first that holds.
    """

    name: str
    pattern: str | None = None
    classes: Sequence[Column] = field(default_factory=tuple)


def _is_text(t: T.DataType) -> bool:
    return isinstance(t, (T.StringType, T.CharType, T.VarcharType))


def _measure(c: Column, t: T.DataType) -> Column:
    """The number that stands for a value: itself, the length of a text, the microseconds of a time."""
    if _is_text(t):
        return F.length(c).cast("double")
    if isinstance(t, T.TimestampType):
        return F.unix_micros(c).cast("double")
    if isinstance(t, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(t, (T.NumericType, T.BooleanType)):
        return c.cast("double")
    return F.lit(None).cast("double")


def value_counts(df: DataFrame, load: str, rules: Sequence[Rule]) -> DataFrame:
    """One row per load, column and distinct value (as 128 bits of hash): count and what follows from the value.

    Rows are combined before the shuffle, which is by load, column and value, so that neither a load nor a
    value that holds most rows makes a large task.
    """
    entries = []
    for r in rules:
        c, t = F.col(f"`{r.name}`"), df.schema[r.name].dataType
        x = _measure(c, t)
        empty = (c == "") if _is_text(t) else F.lit(False)
        bad = F.coalesce(~empty & ~c.rlike(rf"\A(?:{r.pattern})\z"), F.lit(False)) if r.pattern else F.lit(False)
        cls = F.lit(CLASSES + 1)
        for i, cond in reversed(list(enumerate(r.classes, 1))):
            cls = F.when(F.coalesce(cond, F.lit(False)), i).otherwise(cls)
        seeds = (c, F.lit(r.name)) if not isinstance(t, T.MapType) else (F.map_entries(c), F.lit(r.name))
        entries.append(
            F.struct(
                F.lit(r.name).alias("column_name"),
                c.isNull().alias("is_null"),
                F.coalesce(empty, F.lit(False)).alias("is_empty"),
                F.xxhash64(*seeds).alias("h1"),
                F.xxhash64(F.lit(7919), *seeds).alias("h2"),
                F.when(~F.isnan(x), x).alias("x"),
                F.coalesce(F.isnan(x), F.lit(False)).alias("nan"),
                bad.alias("bad"),
                cls.alias("cls"),
            )
        )
    long = df.select(F.col(load).alias("load_id"), F.explode(F.array(*entries)).alias("v")).select("load_id", "v.*")
    return long.groupBy("load_id", "column_name", "is_null", "is_empty", "h1", "h2").agg(
        F.count(F.lit(1)).alias("n"), F.min("x").alias("x"), F.max("nan").alias("nan"), F.max("bad").alias("bad"), F.min("cls").alias("cls")
    )


#: Numbers are summed as whole multiples of this share of their range.
STEPS = 1 << 40


def profile(df: DataFrame, load: str, rules: Sequence[Rule]) -> DataFrame:
    """Exact profile per load and column.

    Columns: n_rows, n_null, n_empty, n_nan, n_distinct (null aside), n_distinct_filled (null and empty aside),
    min_value and max_value (of texts the length; NaN aside), n_bad (pattern violations), the power sums
    sum_1 and sum_2, mean, stddev (of all values, not of a sample), and n_class_1 to n_class_5. A null load is a
    load of its own; an empty table has no rows.

    The power sums are taken about the middle of the column's range in the load and in units of its width (a
    power of two, so that the scaling itself loses nothing): numbers of any size, large or small, far from zero
    or near it, become numbers of at most one half. These are rounded to multiples of 2^-40 and summed as whole
    numbers in decimals of 38 digits, so that the sums don't depend on the order of the rows and can be
    merged; what the rounding loses is at most 2^-41 of the width per value, and no value is left out. With an infinite
    value the sums, mean and stddev are null, never a value from which rows are missing.
    """
    v = value_counts(df, load, rules)
    edges = v.groupBy("load_id", "column_name").agg(F.min("x").alias("__lo"), F.max("x").alias("__hi"))
    v = v.join(
        edges.withColumnsRenamed({"load_id": "__load", "column_name": "__col"}),
        F.col("load_id").eqNullSafe(F.col("__load")) & (F.col("column_name") == F.col("__col")), "left",
    )
    filled = ~F.col("is_null")
    finite = (F.abs("__lo") < float("inf")) & (F.abs("__hi") < float("inf"))
    # Middle and width of the range; halves first, so that nothing overflows.
    mid = F.when(finite, F.col("__lo") / 2 + F.col("__hi") / 2)
    half = F.greatest(F.col("__hi") / 2 - F.col("__lo") / 2, F.lit(2.0**-1000))
    unit = F.pow(F.lit(2.0), F.ceil(F.log2(half)) - 1)  # a quarter of the width that everything fits in
    u = F.round((F.col("x") / 4 - mid / 4) / unit * float(STEPS)).cast("decimal(13,0)")
    n = F.col("n").cast("decimal(11,0)")
    if_ = lambda cond, val=F.col("n"): F.coalesce(F.sum(F.when(cond, val)), F.lit(0)).cast("bigint")
    one = F.lit(1)
    out = v.groupBy("load_id", "column_name").agg(
        F.sum("n").alias("n_rows"),
        if_(F.col("is_null")).alias("n_null"),
        if_(F.col("is_empty")).alias("n_empty"),
        if_(F.col("nan")).alias("n_nan"),
        if_(filled, one).alias("n_distinct"),
        if_(filled & ~F.col("is_empty"), one).alias("n_distinct_filled"),
        F.min("x").alias("min_value"),
        F.max("x").alias("max_value"),
        if_(F.col("bad")).alias("n_bad"),
        F.coalesce(F.sum(F.when(F.col("x").isNotNull(), F.col("n"))), F.lit(0)).cast("bigint").alias("n_numbers"),
        F.first(mid, True).alias("__mid"), F.first(F.when(finite, unit), True).alias("__unit"),
        F.sum((u * n).cast("decimal(38,0)")).alias("__p1"),
        F.sum((u * u * n).cast("decimal(38,0)")).alias("__p2"),
        *[if_(filled & (F.col("cls") == i)).alias(f"n_class_{i}") for i in range(1, CLASSES + 2)],
    )
    k = F.when(F.col("n_numbers") > 0, F.col("n_numbers").cast("double"))
    m1 = F.col("__p1").cast("double") / k / float(STEPS)
    m2 = F.col("__p2").cast("double") / k / float(STEPS) / float(STEPS)
    mean = F.col("__mid") + F.col("__unit") * (4 * m1)
    dev = F.col("__unit") * (4 * F.sqrt(F.greatest(m2 - m1 * m1, F.lit(0.0))))
    out = out.withColumns({"mean": mean, "stddev": F.when(F.col("min_value") == F.col("max_value"), 0.0 * m1).otherwise(dev)})
    sum_2 = k * (F.col("mean") * F.col("mean") + F.col("stddev") * F.col("stddev"))
    return out.withColumns({"sum_1": k * F.col("mean"), "sum_2": sum_2}).drop("__mid", "__unit", "__p1", "__p2")


def changes(prof: DataFrame, baseline: DataFrame) -> DataFrame:
    """The profile with shares, the change against the baseline, and that against the load before.

    change_baseline and change_previous are half the sum of absolute differences between the shares of the
    value classes. shift_previous is the standardised difference of the numbers, that of the means over the pooled
    standard deviation. moved_baseline and moved_previous are the largest standardised difference of a value
    class, whose members count 1 and all others 0 (so its share is its mean, and its two power sums are its
    count); infinite if all were inside before and none is now, or the reverse. They are null where one side is
    missing (no baseline, no value, first load).
    """
    base = baseline.select(
        F.col("column_name").alias("__c"),
        *[F.col(c).alias(f"base_{c}") for c in ("null_share", "min_value", "max_value", "distinct_share")],
        *[F.col(f"share_{i}").alias(f"base_{i}") for i in range(1, CLASSES + 1)],
    )
    p = prof.join(base, F.col("column_name") == F.col("__c"), "left").drop("__c")
    full = F.col("n_rows") - F.col("n_null")
    p = p.withColumns(
        {"null_share": F.col("n_null") / F.col("n_rows")}
        | {"distinct_share": F.when(full > F.col("n_empty"), F.col("n_distinct_filled") / (full - F.col("n_empty")))}
        | {f"share_{i}": F.when(full > 0, F.col(f"n_class_{i}") / full) for i in range(1, CLASSES + 2)}
    )
    w = Window.partitionBy("column_name").orderBy("load_id")
    diff, prev, moved, moved_prev = F.lit(0.0), F.lit(0.0), [], []
    for i in range(1, CLASSES + 2):
        b = F.coalesce(F.nanvl(F.col(f"base_{i}"), F.lit(0.0)), F.lit(0.0)) if i <= CLASSES else F.lit(0.0)
        own, was = F.col(f"share_{i}"), F.lag(f"share_{i}").over(w)
        diff, prev = diff + F.abs(own - b), prev + F.abs(own - was)
        moved.append(_standardised(own, b))
        moved_prev.append(_standardised(own, was))
    pooled = F.sqrt((F.col("stddev") ** 2 + F.lag("stddev").over(w) ** 2) / 2)
    known = F.col("base_null_share").isNotNull()
    return p.withColumns(
        {
            "change_baseline": F.when(known, diff / 2),
            "change_previous": prev / 2,
            "shift_previous": F.when(pooled > 0, (F.col("mean") - F.lag("mean").over(w)) / pooled),
            "moved_baseline": F.when(known & F.col("share_1").isNotNull(), F.greatest(*moved)),
            "moved_previous": F.when(F.col("share_1").isNotNull() & F.lag("share_1").over(w).isNotNull(), F.greatest(*moved_prev)),
        }
    )


def _standardised(p: Column, q: Column) -> Column:
    """Difference of two shares over their pooled standard deviation."""
    pooled = F.sqrt((p * (1 - p) + q * (1 - q)) / 2)
    return F.when(p == q, 0.0).when(pooled > 0, F.abs(p - q) / pooled).otherwise(F.lit(float("inf")))


def issues(changed: DataFrame, null_margin: float = 0.05, change_limit: float = 0.25, distinct_factor: float = 3.0) -> DataFrame:
    """One row (load_id, column_name, issue) per finding: nulls, range, pattern, distribution or distinct.

    A distribution that may have changed is found by its standardised difference: shares that differ by more than
    ``change_limit`` in all differ by more than 2 / (CLASSES + 1) of it in some class, whose deviation is a half at
    most, so that no change is missed. Whether it has is then decided by the shares.
    """
    least = change_limit * 2 / (CLASSES + 1) / 0.5 * 0.999
    num = lambda c: F.when(~F.isnan(c), F.col(c))  # noqa: E731  a baseline without a value may hold NaN
    found = F.array(
        F.when(F.col("null_share") > F.col("base_null_share") + null_margin, "nulls"),
        F.when((num("base_min_value").isNotNull() | num("base_max_value").isNotNull()) & ((F.col("min_value") < num("base_min_value")) | (F.col("max_value") > num("base_max_value")) | (F.col("n_nan") > 0)), "range"),
        F.when(F.col("n_bad") > 0, "pattern"),
        F.when((F.col("moved_baseline") >= least) & (F.col("change_baseline") > change_limit), "distribution"),
        F.when(F.col("distinct_share") < num("base_distinct_share") / distinct_factor, "distinct"),
    )
    return changed.select("load_id", "column_name", F.explode(F.array_compact(found)).alias("issue"))


def event_rules() -> list[Rule]:
    """The watched columns of prediction events."""
    r, c, h = F.col("current_spoken_ratio"), F.col("channel"), F.col("hint")
    pieces = F.size(F.split(h, " "))
    return [
        Rule("current_spoken_ratio", classes=((r >= 0) & (r <= 0.25), (r > 0.25) & (r <= 0.5), (r > 0.5) & (r <= 0.75), (r > 0.75) & (r <= 1))),
        Rule("channel", classes=(c == 0, c == 1)),
        Rule("hint", pattern=r"[\p{Ll}\p{Nd}'’-]+( [\p{Ll}\p{Nd}'’-]+)*", classes=(h == "", pieces <= 5, pieces > 5)),
    ]
