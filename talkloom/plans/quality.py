"""Queries on speech intervals (p1) and on column profiles (p4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkloom.operators import intervals, profile
from talkloom.sources.tables import table

#: Pauses above the first and up to the second bound (ms) are reported; longer ones are breaks of the recording.
PAUSE_MS = (300, 60_000)


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """Pauses of one speaker between neighbouring speech periods."""
    g = intervals.gaps(intervals.usable_speech(table(spark, folder, "words")), ["dialogue_id", "speaker"])
    length = F.col("gap_end_ms") - F.col("gap_start_ms")
    return g.where((length > PAUSE_MS[0]) & (length <= PAUSE_MS[1]))


def p1_periods(spark: SparkSession, folder: str) -> DataFrame:
    """Continuous speech periods per dialogue and speaker."""
    return intervals.periods(intervals.usable_speech(table(spark, folder, "words")), ["dialogue_id", "speaker"])


def _changes(spark: SparkSession, folder: str) -> DataFrame:
    prof = profile.profile(table(spark, folder, "oracle_raw"), "load_id", profile.event_rules())
    return profile.changes(prof, table(spark, folder, "column_baseline"))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """Findings per load and column against the accepted profile."""
    return profile.issues(_changes(spark, folder))


def p4_profile(spark: SparkSession, folder: str) -> DataFrame:
    """Exact profile per load of every column of the events, with the changes against the baseline and the load before.

    Means and deviations of times are in seconds.
    """
    o = table(spark, folder, "oracle_raw")
    known = {r.name: r for r in profile.event_rules()}
    rules = [known.get(c, profile.Rule(c)) for c in o.columns if c != "load_id"]
    p = profile.changes(profile.profile(o, "load_id", rules), table(spark, folder, "column_baseline"))
    unit = F.when(F.col("column_name") == "loaded_at", 1e6).otherwise(1.0)
    digits = F.when(F.col("column_name") == "loaded_at", 0).otherwise(1)
    part = lambda c, n: F.round(F.col(c) / unit, n)
    coarse = lambda c: F.when(digits == 0, part(c, 0)).otherwise(part(c, 3))
    return p.select(
        "load_id", "column_name", "n_rows", "n_null", "n_empty", "n_nan", "n_distinct", "n_bad", "min_value", "max_value", coarse("mean").alias("mean_value"), F.when(digits == 1, part("stddev", 2)).alias("stddev"),
        F.when(F.col("column_name").isin(*known), F.round("change_baseline", 6)).alias("change_baseline"), F.when(F.col("column_name").isin(*known), F.round("change_previous", 6)).alias("change_previous"),
        F.when(F.col("column_name").isin("total_word_count", "channel"), F.round("shift_previous", 6)).alias("shift_previous"),
    )


QUERIES = {"p1_found": p1_found, "p1_periods": p1_periods, "p4_found": p4_found, "p4_profile": p4_profile}

_USABLE = """
u AS (
  SELECT dialogue_id, speaker, CAST(round("start" * 1000) AS BIGINT) AS s, CAST(round("end" * 1000) AS BIGINT) AS e
  FROM words
  WHERE speaker IN ('A', 'B') AND "start" IS NOT NULL AND "end" IS NOT NULL AND NOT isnan("start") AND NOT isnan("end") AND "end" >= "start"
), g AS (
  SELECT *, max(e) OVER (PARTITION BY dialogue_id, speaker ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM u
)"""

_PROFILE_COLUMNS = {
    "dialogue_id": "t", "event_idx": "n", "timestamp_ms": "n", "conversation_context": "t", "prediction": "t", "total_word_count": "n",
    "trigger_word": "t", "recent_words": "t", "current_spoken_ratio": "n", "channel": "n", "hint": "t", "loaded_at": "at",
}
_HINT_BAD = "NOT regexp_full_match(hint, '[\\p{Ll}\\p{Nd}''’-]+( [\\p{Ll}\\p{Nd}''’-]+)*')"


_CLASS_SQL = {
    "current_spoken_ratio": ["current_spoken_ratio >= 0 AND current_spoken_ratio <= 0.25", "current_spoken_ratio > 0.25 AND current_spoken_ratio <= 0.5", "current_spoken_ratio > 0.5 AND current_spoken_ratio <= 0.75", "current_spoken_ratio > 0.75 AND current_spoken_ratio <= 1"],
    "channel": ["channel = 0", "channel = 1"],
    "hint": ["hint = ''", "hint <> '' AND len(string_split(hint, ' ')) <= 5", "hint <> '' AND len(string_split(hint, ' ')) > 5"],
}


def _profile_sql() -> str:
    parts = []
    for c, kind in _PROFILE_COLUMNS.items():
        x = {"t": f"CAST(length({c}) AS DOUBLE)", "n": f"CASE WHEN NOT isnan(CAST({c} AS DOUBLE)) THEN CAST({c} AS DOUBLE) END", "at": f"CAST(epoch_us({c}) AS DOUBLE)"}[kind]
        nan = f"isnan(CAST({c} AS DOUBLE))" if kind == "n" else "false"
        empty = f"{c} = ''" if kind == "t" else "false"
        bad = f"{c} <> '' AND {_HINT_BAD}" if c == "hint" else "false"
        mean = f"round(CAST(sum(CAST({x} AS DECIMAL(38,6))) AS DOUBLE) / count({x}), 3)" if kind != "at" else f"round(CAST(sum(epoch_us({c})) AS DOUBLE) / count({c}) / 1e6)"
        dev = f"round(stddev_pop({x}), 2)" if kind != "at" else "NULL"
        shares = [f"count(*) FILTER (WHERE {w}) / nullif(count({c}), 0)" for w in _CLASS_SQL[c]] if c in _CLASS_SQL else ["NULL"]
        shares = [f"CAST({w} AS DOUBLE)" for w in (shares + ["0"] * 4)[:4]] if c in _CLASS_SQL else ["NULL"] * 4
        moved = f"avg({x}) AS m_, var_pop({x}) AS v_" if c in ("total_word_count", "channel") else "NULL AS m_, NULL AS v_"
        parts.append(
            f"SELECT load_id, '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_null, count(*) FILTER (WHERE {empty}) AS n_empty, "
            f"count(*) FILTER (WHERE {nan}) AS n_nan, count(DISTINCT {c}) AS n_distinct, count(*) FILTER (WHERE {bad}) AS n_bad, "
            f"min({x}) AS min_value, max({x}) AS max_value, {mean} AS mean_value, {dev} AS stddev, {', '.join(f'{w} AS s{i}' for i, w in enumerate(shares, 1))}, {moved} FROM oracle_raw GROUP BY load_id"
        )
    rest = lambda t: f"(1 - {t}s1 - {t}s2 - {t}s3 - {t}s4)"
    base = " + ".join(f"abs(r.s{i} - coalesce(share_{i}, 0))" for i in range(1, 5))
    prev = " + ".join(f"abs(r.s{i} - p.s{i})" for i in range(1, 5))
    return f"""WITH r AS ({" UNION ALL ".join(parts)}), o AS (SELECT *, lag(load_id) OVER (PARTITION BY column_name ORDER BY load_id) AS before FROM r)
SELECT r.load_id, r.column_name, r.n_rows, r.n_null, r.n_empty, r.n_nan, r.n_distinct, r.n_bad, r.min_value, r.max_value, r.mean_value, r.stddev,
  CASE WHEN b.column_name IS NOT NULL THEN round(({base} + {rest("r.")}) / 2, 6) END AS change_baseline, round(({prev} + abs({rest("r.")} - {rest("p.")})) / 2, 6) AS change_previous,
  CASE WHEN (r.v_ + p.v_) > 0 THEN round((r.m_ - p.m_) / sqrt((r.v_ + p.v_) / 2), 6) END AS shift_previous
FROM o r LEFT JOIN r p ON p.column_name = r.column_name AND p.load_id = r.before LEFT JOIN column_baseline b ON b.column_name = r.column_name"""


SQL = {
    "p1_found": f"WITH {_USABLE} SELECT dialogue_id, speaker, p AS gap_start_ms, s AS gap_end_ms FROM g WHERE s - p > 300 AND s - p <= 60000",
    "p1_periods": f"""WITH {_USABLE},
i AS (SELECT *, sum(CASE WHEN p IS NULL OR s > p THEN 1 ELSE 0 END) OVER (PARTITION BY dialogue_id, speaker ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT dialogue_id, speaker, min(s) AS period_start_ms, max(e) AS period_end_ms FROM i GROUP BY dialogue_id, speaker, k""",
    "p4_found": f"""
WITH r AS (
  SELECT load_id, 'current_spoken_ratio' AS column_name, count(*) AS n, count(*) - count(current_spoken_ratio) AS nulls,
    count(*) FILTER (WHERE isnan(current_spoken_ratio) OR current_spoken_ratio < 0 OR current_spoken_ratio > 1) AS outside, 0 AS bad,
    count(*) FILTER (WHERE current_spoken_ratio >= 0 AND current_spoken_ratio <= 0.25) AS c1,
    count(*) FILTER (WHERE current_spoken_ratio > 0.25 AND current_spoken_ratio <= 0.5) AS c2,
    count(*) FILTER (WHERE current_spoken_ratio > 0.5 AND current_spoken_ratio <= 0.75) AS c3,
    count(*) FILTER (WHERE current_spoken_ratio > 0.75 AND current_spoken_ratio <= 1) AS c4,
    CAST(NULL AS DOUBLE) AS ds
  FROM oracle_raw GROUP BY load_id
  UNION ALL
  SELECT load_id, 'channel', count(*), count(*) - count(channel), count(*) FILTER (WHERE channel NOT BETWEEN 0 AND 1), 0,
    count(*) FILTER (WHERE channel = 0), count(*) FILTER (WHERE channel = 1), 0, 0, NULL
  FROM oracle_raw GROUP BY load_id
  UNION ALL
  SELECT load_id, 'hint', count(*), count(*) - count(hint), 0, count(*) FILTER (WHERE hint <> '' AND {_HINT_BAD}),
    count(*) FILTER (WHERE hint = ''), count(*) FILTER (WHERE hint <> '' AND len(string_split(hint, ' ')) <= 5),
    count(*) FILTER (WHERE hint <> '' AND len(string_split(hint, ' ')) > 5), 0,
    count(DISTINCT nullif(hint, '')) / nullif(count(nullif(hint, '')), 0)
  FROM oracle_raw GROUP BY load_id
), s AS (
  SELECT r.*, b.*, nulls / n AS ns, n - nulls AS f,
    (abs(c1 / f - coalesce(share_1, 0)) + abs(c2 / f - coalesce(share_2, 0)) + abs(c3 / f - coalesce(share_3, 0)) + abs(c4 / f - coalesce(share_4, 0))
      + (f - c1 - c2 - c3 - c4) / f) / 2 AS change
  FROM r JOIN column_baseline b USING (column_name)
)
SELECT load_id, column_name, 'nulls' AS issue FROM s WHERE ns > null_share + 0.05
UNION ALL SELECT load_id, column_name, 'range' FROM s WHERE outside > 0
UNION ALL SELECT load_id, column_name, 'pattern' FROM s WHERE bad > 0
UNION ALL SELECT load_id, column_name, 'distribution' FROM s WHERE f > 0 AND change > 0.25
UNION ALL SELECT load_id, column_name, 'distinct' FROM s WHERE ds < distinct_share / 3""",
    "p4_profile": _profile_sql(),
}
