import random

import pytest
from pyspark.sql import functions as F

from talkloom.operators import reports
from talkloom.plans import reports as plans


def test_order_stat(spark):
    rng = random.Random(1)
    rows = [(rng.choice("ab"), rng.choice([None, *range(9)])) for _ in range(200)]
    df = spark.createDataFrame(rows, "k string, v int")
    for r in reports.order_stat(df, ["k"], "v", F.floor(F.col("n") / 10)).collect():
        vs = sorted(v for k, v in rows if k == r.k and v is not None)
        assert (r.n, r.stat) == (len(vs), vs[len(vs) // 10])


def test_top_per_key(spark):
    rows = [("hot", i % 50, i) for i in range(500)] + [("cold", 1, 1000)]
    df = spark.createDataFrame(rows, "k string, v int, id int")
    got = sorted((r.k, r["rank"], r.v, r.id) for r in reports.top_per_key(df, ["k"], [F.col("v"), F.col("id")], 3, F.hash("id")).collect())
    assert got == [("cold", 1, 1, 1000), ("hot", 1, 0, 0), ("hot", 2, 0, 50), ("hot", 3, 0, 100)]


def test_breakdown_and_medoids(spark):
    df = spark.createDataFrame([("x", None, 1), ("x", "q", 2), ("y", "q", 3)], "a string, b string, n int")
    got = {tuple(r) for r in reports.breakdown(df, {"a": F.col("a"), "b": F.col("b")}, {"odd": F.col("n") % 2 == 1}).collect()}
    assert got == {("a", "x", 2, 1), ("a", "y", 1, 1), ("b", "?", 1, 1), ("b", "q", 2, 1)}
    v = spark.createDataFrame([(1, "k", [1.0, 0.0]), (2, "k", [0.8, 0.6]), (3, "k", [0.0, 1.0]), (4, "k", None), (5, "z", [0.0, 0.0]), (6, "z", [0.0, 0.0])], "id long, k string, e array<double>")
    assert {r.k: r.id for r in reports.medoids(v, "k", "id", "e").collect()} == {"k": 2, "z": 5}


def one_by_one(sizes, n):
    total = sum(sizes.values())
    q = {g: max(1, round(n * s / total)) for g, s in sizes.items()}
    want = max(min(n, total), len(sizes))
    while sum(q.values()) != want:
        if sum(q.values()) > want:
            q[max(sorted(q), key=lambda x: q[x])] -= 1
        else:
            q[max(sorted(q), key=lambda x: sizes[x] - q[x])] += 1
    return q


def test_quotas(spark):
    rng = random.Random(4)
    cases = [({"a": 50, "b": 30, "c": 20}, 10), ({"a": 97, "b": 1, "c": 1, "d": 1}, 10), ({"a": 2}, 10), ({"a": 5, "b": 5, "c": 5}, 4), ({x: 1 for x in "abcdef"}, 3)]
    cases += [({x: rng.randrange(1, 30) for x in "abcdefgh"[: rng.randrange(1, 8)]}, rng.randrange(1, 60)) for _ in range(8)]
    for sizes, n in cases:
        df = spark.createDataFrame(list(sizes.items()), "g string, size long")
        assert {r.g: r.quota for r in reports.quotas(df, "g", n).collect()} == one_by_one(sizes, n), (sizes, n)
    assert reports.quotas(spark.createDataFrame([], "g string, size long"), "g", 5).count() == 0


def test_nearest_of_all_vectors(spark, tmp_path):
    dense = [(i, "x") for i in range(10, 40)]
    sparse = [(102, "y"), (106, "y"), (206, "y"), (107, "y")]
    spark.createDataFrame(dense + sparse, "vec_id long, label string").write.parquet(str(tmp_path / "embeddings.parquet"))
    got = {(r.label, r.wanted): r.vec_id for r in plans.j10_nearest(spark, str(tmp_path)).collect()}
    assert [got["x", d] for d in range(10)] == list(range(10, 20))
    assert [got["y", d] for d in range(10)] == [102] * 5 + [106, 106] + [107] * 3


def test_required_values(spark):
    df = spark.createDataFrame([("d", "A", 1), ("d", "B", 2), ("e", "A", 3), (None, "B", 4)], "k string, s string, v int")
    assert sorted(map(tuple, reports.missing_values(df, "k", "s", ["A", "B"]).collect()), key=repr) == [("e", "B"), (None, "A")]
    assert sorted(r.v for r in reports.required(df, "k", "s", ["A", "B"], skip=True).collect()) == [1, 2]
    assert reports.required(df.where("k = 'd'"), "k", "s", ["A", "B"]).count() == 2
    with pytest.raises(Exception, match="missing s B in e"):
        reports.required(df.where("k is not null"), "k", "s", ["A", "B"]).collect()


def test_fail_fast_join(spark):
    ids = lambda *xs: spark.createDataFrame([(x,) for x in xs], "id string")
    assert sorted(r.id for r in reports.require_matching(ids("a", "b"), ids("b", "a"), ids("a", "b", "more"), "id").collect()) == ["a", "b"]
    with pytest.raises(ValueError, match="1 text without audio, 1 audio without text"):
        reports.require_matching(ids("a"), ids("b"), None, "id")
    with pytest.raises(ValueError, match="1 text without events"):
        reports.require_matching(ids("a", "b"), ids("b", "a"), ids("a"), "id")


def test_status_and_funnel(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "id string")
    one = lambda *xs: spark.createDataFrame([(x,) for x in xs], "id string")
    s = reports.first_match(df, "id", {"first": one("a", "a"), "second": one("a", "b", None)}, "none")
    assert {r.id: r.status for r in s.collect()} == {"a": "first", "b": "second", "c": "none", None: "none"}
    assert [tuple(r) for r in reports.funnel(s, "status", ["first", "second", "third", "none"]).orderBy("place").collect()] == [(0, "first", 1, "25%"), (1, "second", 1, "25%"), (2, "third", 0, "0%"), (3, "none", 2, "50%")]
    assert [r.share for r in reports.funnel(s.limit(0), "status", ["x"]).collect()] == ["-"]
