"""Aggregates for corpus reports that stay exact and spread over tasks however rows fall on keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkloom.functions import arrays

#: Rows that a top-k keeps per key come from so many buckets first.
BUCKETS = 64


def order_stat(df: DataFrame, keys: Sequence[str], value: str, at: Column) -> DataFrame:
    """(keys, n, stat): the value at the 0-based place ``at`` (an expression of ``n``) of each key's sorted values.

    Counts per distinct value come first, so a key costs as many rows as it has distinct values. Nulls are
    passed over.
    """
    h = df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("v")).agg(F.count(F.lit(1)).alias("c"))
    w = Window.partitionBy(*keys)
    h = h.withColumn("n", F.sum("c").over(w)).withColumn("upto", F.sum("c").over(w.orderBy("v").rowsBetween(Window.unboundedPreceding, 0)))
    return h.where(F.col("upto") > at).groupBy(*keys).agg(F.max("n").alias("n"), F.min("v").alias("stat"))


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, spread: Column) -> DataFrame:
    """The first ``k`` rows of every key: first in buckets of ``spread`` (a hash that differs inside a key), then of what these leave."""
    b = df.withColumn("__b", F.pmod(spread, F.lit(BUCKETS)))
    for by in ([*keys, "__b"], list(keys)):
        b = b.withColumn("__r", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("__r") <= k)
    return b.drop("__b").withColumnRenamed("__r", "rank")


def breakdown(df: DataFrame, keys: dict[str, Column], measures: dict[str, Column]) -> DataFrame:
    """(key, value, total, measures...): the same counts by several keys in one pass; null values count as '?'."""
    each = F.array(*[F.struct(F.lit(k).alias("key"), F.coalesce(c.cast("string"), F.lit("?")).alias("value")) for k, c in keys.items()])
    d = df.select(*[m.alias(n) for n, m in measures.items()], F.explode(each).alias("x"))
    return d.groupBy("x.key", "x.value").agg(F.count(F.lit(1)).alias("total"), *[F.count_if(n).alias(n) for n in measures])


def medoids(vectors: DataFrame, key: str, id_col: str, vector: str) -> DataFrame:
    """(key, id, vector) of the member of each key that is most similar to all members on average; ties to the lowest id.

    The average of the similarities is the similarity with the sum of all vectors, so no pairs are formed.
    """
    v = vectors.where(F.col(vector).isNotNull())
    d = v.select(key, F.posexplode(vector).alias("i", "x")).groupBy(key, "i").agg(F.sum(F.col("x").cast("double")).alias("s"))
    sums = d.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "s"))), lambda e: e["s"]).alias("__sum"))
    s = v.join(sums, key).withColumn("__dot", arrays.dot(F.col(vector), F.col("__sum")))
    best = F.max_by(F.struct(id_col, vector), F.struct("__dot", (-F.col(id_col)).alias("i")))
    return s.groupBy(key).agg(best.alias("b")).select(key, F.col(f"b.{id_col}").alias(id_col), F.col(f"b.{vector}").alias(vector))


def first_match(df: DataFrame, key: str, tables: dict[str, DataFrame], otherwise: str) -> DataFrame:
    """``df`` with ``status``: the name of the first table that has the row's key. Each table is one column of keys; null keys match nothing."""
    out, status = df, F.lit(otherwise)
    for i, (name, ids) in enumerate(tables.items()):
        out = out.join(ids.select(F.col(ids.columns[0]).alias(f"__k{i}")).distinct(), F.col(key) == F.col(f"__k{i}"), "left")
    for i, name in reversed(list(enumerate(tables))):
        status = F.when(F.col(f"__k{i}").isNotNull(), name).otherwise(status)
    return out.select(*df.columns, status.alias("status"))


def funnel(df: DataFrame, status: str, order: Sequence[str]) -> DataFrame:
    """(place, status, n, share): every status of ``order``, with the rounded percentage of all rows, '-' for an empty table."""
    spark = df.sparkSession
    names = spark.createDataFrame(list(enumerate(order)), "place int, status string")
    n = df.groupBy(F.col(status).alias("__s")).agg(F.count(F.lit(1)).alias("c"))
    j = names.join(n, F.col("status") == F.col("__s"), "left").select("place", "status", F.coalesce("c", F.lit(0)).alias("n"))
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))  # one row per status
    return j.select("place", "status", "n", F.when(total > 0, F.concat(F.bround(F.col("n") * 100 / total).cast("int").cast("string"), F.lit("%"))).otherwise("-").alias("share"))


def missing_values(df: DataFrame, key: str, col: str, wanted: Sequence[str]) -> DataFrame:
    """(key, missing): each wanted value of ``col`` that no row of a key has. Values are combined per key before the shuffle."""
    has = df.groupBy(key).agg(*[F.max(F.when(F.col(col) == v, 1)).alias(f"__h{i}") for i, v in enumerate(wanted)])
    gone = F.array_compact(F.array(*[F.when(F.col(f"__h{i}").isNull(), v) for i, v in enumerate(wanted)]))
    return has.select(key, F.explode(gone).alias("missing"))


def required(df: DataFrame, key: str, col: str, wanted: Sequence[str], skip: bool = False) -> DataFrame:
    """Rows of the keys that have all wanted values; a key that lacks one is an error when run, or is left out with ``skip``."""
    gone = missing_values(df, key, col, wanted).groupBy(F.col(key).alias("__k")).agg(F.array_join(F.array_sort(F.collect_set("missing")), ", ").alias("__m"))
    if skip:
        return df.join(gone, F.col(key).eqNullSafe(F.col("__k")), "left_anti")
    j = df.join(gone, F.col(key).eqNullSafe(F.col("__k")), "left")
    fail = F.raise_error(F.concat(F.lit(f"missing {col} "), F.col("__m"), F.lit(" in "), F.coalesce(F.col(key).cast("string"), F.lit("?"))))
    return j.where(F.when(F.col("__m").isNotNull(), fail.cast("boolean")).otherwise(F.lit(True))).drop("__k", "__m")


def require_matching(text: DataFrame, audio: DataFrame, events: DataFrame | None, key: str) -> DataFrame:
    """Keys of rows to be joined. Text and audio must have the same keys, and with ``events`` each of these must have events; events without text are ignored.

    What is missing is counted, and raises an error before anything is written.
    """
    ids = {n: d.select(key).distinct() for n, d in (("text", text), ("audio", audio), ("events", events)) if d is not None}
    pairs = [("text", "audio"), ("audio", "text")] + ([("text", "events")] if events is not None else [])
    lacks = {f"{a} without {b}": ids[a].join(ids[b], key, "left_anti").count() for a, b in pairs}
    if any(lacks.values()):
        raise ValueError(", ".join(f"{n} {what}" for what, n in lacks.items() if n))
    return ids["text"]


def quotas(sizes: DataFrame, key: str, n: int) -> DataFrame:
    """(key, quota): shares of ``n`` for groups (key, size): at least one each, rounded half to even, then fitted to the sum.

    What is too much is taken one by one from the largest quota, what is missing goes one by one to the group with
    most rows that aren't picked (ties to the first key). That is levelling: the largest quotas, or the largest
    rests, are brought down to a common height, found from sums over the groups in falling order. Quotas
    never fall below one, so more groups than ``n`` keep one each. Groups of size null or 0 have none.
    """
    s = sizes.where(F.col("size") > 0)
    every = Window.partitionBy(F.lit(0))  # one row per group
    total, groups = F.sum("size").over(every), F.count(F.lit(1)).over(every)
    s = s.select(key, "size", F.greatest(F.lit(1), F.bround(F.lit(n) * F.col("size") / total).cast("bigint")).alias("q"), F.greatest(F.least(F.lit(n), total), groups).alias("want"))
    s = s.withColumn("off", F.col("want") - F.sum("q").over(every))  # above 0: to be added, below 0: to be taken
    s = s.withColumn("height", F.when(F.col("off") < 0, F.col("q")).otherwise(F.col("size") - F.col("q")))
    falling = Window.partitionBy(F.lit(0)).orderBy(F.col("height").desc(), key).rowsBetween(Window.unboundedPreceding, 0)
    s = s.withColumns({"k": F.row_number().over(falling), "upto": F.sum("height").over(falling)})
    # With the k highest groups levelled, the common height is (their sum less what goes) / k; k is the last whose height is above it.
    level = (F.col("upto") - F.abs("off")) / F.col("k")
    s = s.withColumn("in_", F.col("height") > level)
    s = s.withColumns({"m": F.count_if("in_").over(every), "sum_m": F.sum(F.when(F.col("in_"), F.col("height"))).over(every)})
    low = F.floor((F.col("sum_m") - F.abs("off")) / F.greatest(F.col("m"), F.lit(1)))
    s = s.withColumn("left_", F.when(F.col("in_"), F.col("height") - low).otherwise(0))
    # The last round isn't whole: of the levelled groups, those last in order keep one more.
    spare = F.sum("left_").over(every) - F.abs("off")
    last = F.row_number().over(Window.partitionBy(F.lit(0), "in_").orderBy(F.desc(key)))
    goes = F.col("left_") - F.when(F.col("in_") & (last <= spare), 1).otherwise(0)
    return s.select(key, (F.col("q") + F.when(F.col("off") < 0, -goes).otherwise(goes)).cast("bigint").alias("quota"))
