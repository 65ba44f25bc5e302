"""Mixing sources to target weights by fitting a subset sum of text lengths to each source's budget."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: The knapsack is solved exactly for what is left of a budget below this many tokens.
EXACT_BELOW = 32_768
#: Bits of the hash that deal the texts of one source and length to buckets, so that a rank is taken in one bucket only.
BUCKET_BITS = 12
SEED = 20_240_601


def fit_counts(lengths: Sequence[int], counts: Sequence[int], budget: int, exact_below: int = EXACT_BELOW) -> list[int]:
    """How many texts of each length to take, so that their total is as close to ``budget`` as can be, not above it.

    First every length gives its share of the budget, rounded down; then the longest are added until less than
    ``exact_below`` is left; the rest is a bounded knapsack, solved by dynamic programming on bit sets.
    """
    total = sum(a * c for a, c in zip(lengths, counts))
    if total <= budget:
        return list(counts)
    if budget <= 0:
        return [0] * len(lengths)
    take = [c * budget // total for c in counts]
    left = budget - sum(a * k for a, k in zip(lengths, take))
    for i in sorted(range(len(lengths)), key=lambda j: -lengths[j]):
        if left < exact_below:
            break
        more = min(counts[i] - take[i], (left - exact_below) // lengths[i] + 1 if lengths[i] <= left else 0)
        more = max(0, min(more, left // lengths[i]))
        take[i] += more
        left -= more * lengths[i]
    if left <= 0:
        return take
    mask = (1 << (left + 1)) - 1
    reach, steps = 1, []  # bit s: the sum s can be made
    for i, a in enumerate(lengths):
        rest, size = min(counts[i] - take[i], left // a if a > 0 else 0), 1
        while rest > 0:
            n = min(size, rest)
            steps.append((i, n, reach))
            reach |= (reach << (n * a)) & mask
            rest -= n
            size *= 2
        if reach >> left & 1:
            break
    at = reach.bit_length() - 1
    for i, n, before in reversed(steps):
        if not before >> at & 1:
            at -= n * lengths[i]
            take[i] += n
    return take


def _fit_source(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("n_tokens").reset_index(drop=True)
    budget, cap = int(pdf["budget"].iloc[0]), int(pdf["max_repeats"].iloc[0])
    lengths, counts = [int(x) for x in pdf["n_tokens"]], [int(x) for x in pdf["n_docs"]]
    have = sum(a * c for a, c in zip(lengths, counts))
    passes = min(cap, budget // have) if have else 0
    extra = fit_counts(lengths, counts, budget - passes * have) if passes < cap and have else [0] * len(lengths)
    pdf["passes"], pdf["extra"] = passes, extra
    return pdf[["source", "n_tokens", "n_docs", "passes", "extra"]]


def budgets(docs: DataFrame, targets: DataFrame, source: str, tokens: str) -> tuple[DataFrame, DataFrame]:
    """Per target source its budget and size, and per source and length the number of texts with the fitted plan.

    Both follow from one count of texts by source and exact length, which is far smaller than the table.
    """
    hist = docs.groupBy(F.col(source).alias("source"), F.coalesce(F.col(tokens), F.lit(0)).alias("n_tokens")).agg(F.count(F.lit(1)).alias("n_docs"))
    total = hist.groupBy(F.lit(0).alias("__one")).agg(F.sum(F.col("n_tokens") * F.col("n_docs")).alias("corpus_tokens"))
    size = hist.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("n_docs")).alias("source_tokens"), F.sum("n_docs").alias("source_docs"))
    per = (
        targets.select("source", "target_share", F.coalesce("max_repeats", F.lit(0)).alias("max_repeats"))
        .join(size, "source", "left")
        .withColumn("__one", F.lit(0))
        .join(total, "__one", "left")  # one row, or none for an empty table
        .withColumn("corpus_tokens", F.coalesce("corpus_tokens", F.lit(0)))
        .select(
            "source", "target_share", "max_repeats", "corpus_tokens",
            F.coalesce("source_tokens", F.lit(0)).alias("source_tokens"),
            F.coalesce("source_docs", F.lit(0)).alias("source_docs"),
            F.floor(F.coalesce("target_share", F.lit(0.0)) * F.col("corpus_tokens")).alias("budget"),
        )
    )
    fit = hist.where("n_tokens > 0").join(per.select("source", "budget", "max_repeats"), "source")
    plan = fit.groupBy("source").applyInPandas(_fit_source, "source string, n_tokens bigint, n_docs bigint, passes bigint, extra bigint")
    return per, plan


def report(per: DataFrame, plan: DataFrame) -> DataFrame:
    """Per target source: budget, what the plan uses, the share of the corpus size reached, and whether it falls short.

    ``exhausted``: the plan uses every text of the source as often as it may be (so nothing is left that could be added).
    ``short``: even that many tokens are less than the target share asks for.
    """
    used = plan.groupBy("source").agg(
        F.sum(F.col("n_tokens") * (F.col("passes") * F.col("n_docs") + F.col("extra"))).alias("used_tokens"),
        F.sum(F.col("passes") * F.col("n_docs") + F.col("extra")).alias("used_docs"),
    )
    u = F.coalesce("used_tokens", F.lit(0))
    most = F.col("max_repeats") * F.col("source_tokens")
    return per.join(used, "source", "left").select(
        "source", "target_share", "max_repeats", "source_docs", "source_tokens", "corpus_tokens", "budget",
        u.alias("used_tokens"), F.coalesce("used_docs", F.lit(0)).alias("used_docs"),
        F.when(F.col("corpus_tokens") > 0, u / F.col("corpus_tokens")).alias("share_reached"),
        (u == most).alias("exhausted"), (most < F.col("target_share") * F.col("corpus_tokens")).alias("short"),
    )


def uses(docs: DataFrame, plan: DataFrame, id_col: str, source: str, tokens: str, seed: int = SEED) -> DataFrame:
    """``docs`` as (id, source, n_tokens, uses): how often the mix takes each text.

    All texts of a source are used ``passes`` times; of each length, the ``extra`` first in the order of a seeded
    hash are used once more. Ranks are taken inside buckets of the hash, so that many texts of one source
    and length make no large task. Texts of other sources, or without tokens, are used 0 times.
    """
    d = docs.select(F.col(id_col).alias("id"), F.col(source).alias("source"), F.coalesce(F.col(tokens), F.lit(0)).alias("n_tokens"))
    d = d.withColumn("__h", F.xxhash64("id", F.lit(seed))).withColumn("__b", F.shiftrightunsigned("__h", 64 - BUCKET_BITS))
    key = ["source", "n_tokens"]
    counts = d.where("n_tokens > 0").groupBy(*key, "__b").agg(F.count(F.lit(1)).alias("__c"))
    before = F.sum("__c").over(Window.partitionBy(*key).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1))
    cuts = counts.join(plan.select(*key, "passes", "extra"), key).select(
        *key, "__b", "passes", (F.col("extra") - F.coalesce(before, F.lit(0))).alias("__quota")
    )
    rank = F.row_number().over(Window.partitionBy(*key, "__b").orderBy("__h", "id"))
    d = d.join(cuts, [*key, "__b"], "left").withColumn("__r", rank)
    n = F.coalesce("passes", F.lit(0)) + F.when(F.col("__r") <= F.col("__quota"), 1).otherwise(0)
    return d.select("id", "source", "n_tokens", n.alias("uses"))
