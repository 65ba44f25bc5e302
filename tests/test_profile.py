import math

from pyspark.sql import functions as F

from talkloom.operators.profile import Rule, changes, event_rules, issues, profile

BASE = "column_name string, null_share double, min_value double, max_value double, distinct_share double, share_1 double, share_2 double, share_3 double, share_4 double"
EVENTS = "current_spoken_ratio double, channel int, hint string, load_id int, n_rows int"


def test_profile_counts(spark):
    rows = [(0.1, 0, "a b", 1, 0), (0.1, 0, "a b", 1, 0), (float("nan"), 7, "A b", 1, 0), (None, None, None, 1, 0), (1.5, 1, "", None, 0), (0.2, 1, "a  b", 2, 0), (0.2, 1, "x\n", 2, 0)]
    p = profile(spark.createDataFrame(rows, EVENTS), "load_id", event_rules())
    got = {(r.load_id, r.column_name): r for r in p.collect()}
    r = got[1, "current_spoken_ratio"]
    assert (r.n_rows, r.n_null, r.n_nan, r.n_distinct, r.min_value, r.max_value, r.n_class_1, r.n_class_5) == (4, 1, 1, 2, 0.1, 0.1, 2, 1)
    assert abs(r.sum_1 - 0.2) < 1e-12 and abs(r.mean - 0.1) < 1e-12 and r.stddev == 0
    h = got[1, "hint"]
    assert (h.n_bad, h.n_null, h.n_distinct, h.n_class_2) == (1, 1, 2, 3)
    assert got[2, "hint"].n_bad == 2 and got[None, "hint"].n_empty == 1 and got[None, "hint"].n_distinct_filled == 0
    assert profile(spark.createDataFrame([], EVENTS), "load_id", event_rules()).count() == 0


def test_issues(spark):
    base = spark.createDataFrame([("current_spoken_ratio", 0.0, 0.0, 1.0, None, 0.5, 0.5, 0.0, 0.0), ("hint", 0.0, None, float("nan"), 0.9, 0.0, 1.0, 0.0, None)], BASE)
    rows = [(0.1, 0, "a", 1, 0), (0.4, 0, "b", 1, 0)] + [(0.1, 0, "a", 2, 0)] * 4 + [(float("nan"), 0, None, 3, 0), (0.4, 0, "C", 3, 0), (0.1, 0, "b", 3, 0)]
    p = changes(profile(spark.createDataFrame(rows, EVENTS), "load_id", event_rules()), base)
    got = sorted(map(tuple, issues(p).collect()))
    assert got == [(2, "current_spoken_ratio", "distribution"), (2, "hint", "distinct"), (3, "current_spoken_ratio", "distribution"), (3, "current_spoken_ratio", "range"), (3, "hint", "nulls"), (3, "hint", "pattern")]
    shift = {r.load_id: r.change_previous for r in p.where(F.col("column_name") == "current_spoken_ratio").collect()}
    assert shift[1] is None and abs(shift[2] - 0.5) < 1e-9


def test_any_type_of_column(spark):
    df = spark.sql("select 1 load_id, map('a', 1) m, array(1, 2) a, true b, date'2024-01-01' d, timestamp'2024-01-01' t, cast(1.5 as decimal(9,2)) x, 'é' s, null v")
    rules = [Rule(c) for c in df.columns if c != "load_id"]
    got = {r.column_name: r for r in profile(df, "load_id", rules).collect()}
    assert got["m"].n_distinct == 1 and got["v"].n_null == 1 and got["s"].max_value == 1 and got["x"].max_value == 1.5


def test_sums_of_large_and_small_numbers(spark):
    cases = {"large": [1e13, 1.0, 3.0], "small": [1e-7, 2e-7, 3e-7], "far": [1e15 + 1, 1e15 + 2, 1e15 + 3], "huge": [1e308, -1e308, 0.0], "one": [5.0] * 3, "tiny": [1e-300, 2e-300, 3e-300]}
    df = spark.createDataFrame([(1, *[cases[c][i] for c in cases]) for i in range(3)], "load_id int, " + ", ".join(f"{c} double" for c in cases))
    got = {r.column_name: r for r in profile(df.repartition(3), "load_id", [Rule(c) for c in cases]).collect()}
    for c, xs in cases.items():
        mean = sum(x / 3 for x in xs)
        dev = math.sqrt(sum(((x - mean) / max(abs(x - mean) for x in xs)) ** 2 for x in xs) / 3) * max(abs(x - mean) for x in xs) if len(set(xs)) > 1 else 0.0
        width = max(xs) / 2 - min(xs) / 2
        assert math.isclose(got[c].mean, mean, rel_tol=1e-9, abs_tol=width * 1e-9), (c, got[c].mean, mean)
        assert math.isclose(got[c].stddev, dev, rel_tol=1e-9), (c, got[c].stddev, dev)
    inf = profile(spark.createDataFrame([(1, float("inf")), (1, 2.0)], "load_id int, x double"), "load_id", [Rule("x")]).first()
    assert inf.mean is None and inf.stddev is None and inf.max_value == float("inf") and inf.n_numbers == 2


def test_shifts_between_loads(spark):
    base = spark.createDataFrame([("channel", 0.0, 0.0, 1.0, None, 0.5, 0.5, None, None)], BASE)
    rows = [(0.1, c, "a", 1, 0) for c in (0, 1, 0, 1)] + [(0.1, c, "a", 2, 0) for c in (0, 0, 0, 1)] + [(0.1, 1, "a", 3, 0)] * 2
    got = {r.load_id: r for r in changes(profile(spark.createDataFrame(rows, EVENTS), "load_id", event_rules()), base).where("column_name = 'channel'").collect()}
    assert got[1].shift_previous is None and got[1].moved_baseline == 0 and got[1].change_baseline == 0
    pooled = math.sqrt((0.25 + 0.1875) / 2)
    assert math.isclose(got[2].shift_previous, -0.25 / pooled) and math.isclose(got[2].moved_previous, 0.25 / pooled) and math.isclose(got[2].change_previous, 0.25)
    assert math.isclose(got[3].shift_previous, 0.75 / math.sqrt(0.1875 / 2)) and math.isclose(got[3].change_baseline, 0.5)
