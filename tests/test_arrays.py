import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from talkloom.functions import arrays


def run(spark, expr, **cols):
    kinds = {"lists": "array<array<int>>", "row": "array<int>", "n": "int", "events": "array<struct<pos:int,tokens:array<int>>>"}
    df = spark.createDataFrame([tuple(cols.values())], ", ".join(f"{c} {kinds[c]}" for c in cols))
    return df.select(expr.alias("x")).first().x


def test_pack(spark):
    for lists in ([], [[1, 2], [], [3]], [[]]):
        p = run(spark, arrays.pack(F.col("lists")), lists=lists)
        assert list(p["values"]) == [x for y in lists for x in y] and len(p["offsets"]) == len(lists) + 1
        df = spark.createDataFrame([(lists,)], "lists array<array<int>>").select(arrays.pack(F.col("lists")).alias("p"))
        assert df.select(arrays.unpack(F.col("p.values"), F.col("p.offsets")).alias("x")).first().x == lists
    df = spark.createDataFrame([([[1, 2], [], [3]],)], "lists array<array<int>>").select(arrays.pack(F.col("lists")).alias("p"))
    s = df.select(arrays.packed_subset(F.col("p.values"), F.col("p.offsets"), F.array(F.lit(2), F.lit(0))).alias("x")).first().x
    assert (list(s["values"]), list(s["offsets"])) == ([3, 1, 2], [0, 1, 3])
    assert df.select(arrays.packed_item(F.col("p.values"), F.col("p.offsets"), 5).alias("x")).first().x is None


def test_chunks(spark):
    cases = [(n, most) for n in (0, 1, 5, 63, 64, 65, 199) for most in (1, 7, 64)]
    df = spark.createDataFrame(cases, "n int, most int")
    for most in (1, 7, 64):
        for r in df.where(F.col("most") == most).select("n", arrays.chunk_bounds(F.col("n"), most).alias("b")).collect():
            sizes = [x["size"] for x in r.b]
            assert sum(sizes) == r.n and all(s <= most for s in sizes) and len(sizes) == -(-r.n // most)
            assert [x["start"] for x in r.b] == [sum(sizes[:i]) for i in range(len(sizes))] and sizes == sorted(sizes, reverse=True) and (not sizes or sizes[0] - sizes[-1] <= 1)


def test_delays(spark):
    rows = [[1, 2, 3], [4, 5, 6]]
    d = run(spark, arrays.delayed(F.col("lists"), [0, 2], [90, 91], [7, 8]), lists=rows)
    assert d == [[90, 1, 2, 3, 7, 7], [91, 91, 91, 4, 5, 6]]
    assert run(spark, arrays.undelayed(F.col("lists"), [0, 2]), lists=[x[1:] for x in d]) == rows
    assert run(spark, arrays.undelayed(F.col("lists"), [0, 2]), lists=[[1, 2], [3, 4]]) is None
    assert run(spark, arrays.labels(F.col("lists"), [90, 91], -1), lists=d) == [[-1, 1, 2, 3, 7, 7], [-1, -1, -1, 4, 5, 6]]
    assert run(spark, arrays.masked_prompt(F.col("lists"), [0, 2], 1, -1), lists=d) == [[-1, -1, 2, 3, 7, 7], [-1, -1, -1, -1, 5, 6]]


def test_event_stream(spark):
    ev = [(0, [11]), (3, [12])]
    assert run(spark, arrays.frames_of_events(F.col("events"), 6, 0, 99), events=ev) == [99, 11, 0, 99, 12, 0]
    assert run(spark, arrays.frames_of_events(F.col("events"), 7, 0, 99), events=[(0, [1, 2, 3, 4, 5]), (2, [7]), (9, [1])]) == [99, 1, 99, 7, 4, 5, 0]
    assert run(spark, arrays.frames_of_events(F.col("events"), 3, 0, 99), events=[(1, [5, 6, 7])]) == [0, 99, 5]


def test_shift_merge_prompt(spark):
    assert run(spark, arrays.shifted(F.col("row"), 2, 0), row=[1, 2, 3]) == [0, 0, 1] and run(spark, arrays.shifted(F.col("row"), -5, 0), row=[1, 2]) == [0, 0]
    assert run(spark, arrays.merged(F.col("row"), F.col("lists"), 3), row=[1], lists=[[5, 6, 7]]) == [[1, 3, 3], [5, 6, 7]]
    assert run(spark, arrays.merged(F.col("row"), F.col("lists"), 3), row=[1, 2, 4, 8], lists=[[5, 6]]) == [[1, 2], [5, 6]]
    voice = [[k, k + 1, k + 2] for k in range(8)]
    own, other = arrays.prompt_prefix(F.col("lists"), F.array(F.lit(50)), 3)
    a, b = run(spark, own, lists=voice), run(spark, other, lists=voice)
    assert len(a) == len(b) == 9 and {len(x) for x in a + b} == {2 + 6 + 1 + 6} and a[0] == [3] * 8 + [50] + [3] * 6 and a[1][:3] == [1, 2, 948]
    assert run(spark, arrays.last_phrase(F.col("row"), F.array(F.lit(1), F.lit(2))), row=[1, 2, 3, 1, 2]) == 3
    assert run(spark, arrays.last_phrase(F.col("row"), F.array(F.lit(9))), row=[1]) is None


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(st.integers(0, 9), max_size=4), max_size=5))
def test_round_trip(lists):
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    df = spark.createDataFrame([(lists,)], "lists array<array<int>>").select("lists", arrays.pack(F.col("lists")).alias("p"))
    assert df.select(arrays.unpack(F.col("p.values"), F.col("p.offsets")).alias("x")).first().x == lists


def test_unit_vectors(spark):
    rng = random.Random(1)
    v = [rng.random() for _ in range(8)]
    df = spark.createDataFrame([(v,), ([0.0] * 8,)], "v array<double>").select(arrays.unit(F.col("v")).alias("u"))
    n = [r.n for r in df.select(arrays.dot(F.col("u"), F.col("u")).alias("n")).collect()]
    assert abs(n[0] - 1) < 1e-12 and n[1] == 0


EV = "events array<struct<pos:int,ratio:double,skip_forbid:int,pred:array<int>,hint:array<int>>>"


def test_chosen_events(spark):
    ev = [(5, 1.0, 1, [1], [2]), (0, 0.5, 0, [3], [4]), (5, 1.0, 1, [9], []), (2, 1.0, 1, [], []), (-1, 1.0, 1, [7], [7]), (9, 1.0, 1, [8], [])]
    df = spark.createDataFrame([(ev,), ([],)], EV)
    run_ = lambda **kw: [[(x["pos"], list(x["tokens"])) for x in r.x] for r in df.select(arrays.chosen_events(F.col("events"), 9, **kw).alias("x")).collect()]
    assert run_() == [[(0, [3]), (5, [2]), (5, [9])], []]
    assert run_(hint_only=True) == [[(0, [4]), (5, [2])], []]
    assert run_(skip=1.0) == [[(5, [2]), (5, [9])], []]  # those that must not be skipped stay
    moved = run_(jitter=2, seed=3)[0]
    assert moved == run_(jitter=2, seed=3)[0] and all(0 <= a - b[0] <= 2 for (a, _), b in zip(moved, [(0,), (5,), (5,)]))


def test_event_share_skipped(spark):
    ev = [(i, 0.0, 0, [1], []) for i in range(4000)]
    n = spark.createDataFrame([(ev,)], EV).select(F.size(arrays.chosen_events(F.col("events"), 4000, skip=0.3, seed=1)).alias("n")).first().n
    assert 2650 < n < 2950


def test_prompt_and_shift_bounds(spark):
    assert run(spark, arrays.shift_within(F.col("row"), 9, 0), row=[1, 2, 3]) == [0, 0, 1] and run(spark, arrays.shift_within(F.col("row"), 0, 0), row=[1, 2, 3]) == [0, 1, 2]
    assert run(spark, arrays.shift_within(F.col("row"), -9, 0), row=[1, 2, 3]) == [3, 0, 0] and run(spark, arrays.shift_within(F.col("row"), -9, 0), row=[1]) == [1]
    e = run(spark, arrays.prompted_events(F.col("events"), 2, 5, 10, ["pos", "tokens"]), events=[(1, [1]), (2, [2]), (4, [3]), (5, [4])])
    assert [(x["pos"], x["tokens"]) for x in e] == [(12, [2]), (14, [3])]
    assert [x["tokens"] for x in run(spark, arrays.sorted_events(F.col("events")), events=[(3, [1]), (0, [2]), (3, [3])])] == [[2], [1], [3]]
    assert run(spark, arrays.whole_if_prompted(F.col("n"), 5), n=1) is True and run(spark, arrays.whole_if_prompted(F.col("n"), 0), n=3) is True
    with pytest.raises(Exception, match="must not be split"):
        run(spark, arrays.whole_if_prompted(F.col("n"), 5), n=2)
