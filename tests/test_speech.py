import random
from datetime import datetime

from pyspark.sql import functions as F

from talkloom.operators import blocks, speech

RAW = "dialogue_id string, word_idx int, speaker string, word string, start double, end double, loaded_at timestamp, block int, turn_no int"
W = "dialogue_id string, word_idx int, speaker string, word string, start_ms long, end_ms long"


def words(spark, rows):
    return spark.createDataFrame([("d", i, s, w, a, b) for i, (s, w, a, b) in enumerate(rows)], W)


def test_clean_words(spark):
    t0, t1 = datetime(2025, 1, 1), datetime(2025, 1, 2)
    rows = [("d", 0, "A", "x", 0.0, 0.5, t0, 1, 1), ("d", 0, "A", "y", 0.0, 0.6, t1, 1, 1), ("d", 1, "C", "x", 0.0, 0.5, t0, 1, 1), ("d", 2, "B", None, 1.0, 1.0, t0, 1, 1), ("d", 3, "B", "z", 1.0, 0.5, t0, 1, 1), ("d", 4, "B", "z", float("nan"), 2.0, t0, 1, 1)]
    got = sorted(tuple(r) for r in speech.clean_words(spark.createDataFrame(rows, RAW)).collect())
    assert got == [("d", 0, "A", "y", 0, 600), ("d", 2, "B", "", 1000, 1000)]
    assert speech.clean_words(spark.createDataFrame([], RAW)).count() == 0


def test_overlap(spark):
    w = words(spark, [("A", "a", 0, 1000), ("A", "b", 1200, 2000), ("B", "c", 1500, 2500), ("A", "d", 3000, 3500)])
    r = speech.overlap_report(w).first()
    assert (r.n_words, r.n_switches, r.a_ms, r.b_ms, r.both_ms, r.flag) == (4, 2, 2500, 1000, 500, True)
    assert speech.overlap_report(w.limit(0)).count() == 0


def test_turns_and_timeline(spark):
    w = words(spark, [("A", "a", 0, 500), ("A", "b", 500, 2000), ("B", "c", 1500, 1800), ("A", "d", 1900, 2500)])
    got = [tuple(r)[1:] for r in speech.timeline(speech.turns(w)).orderBy("turn_no").collect()]
    assert got == [(0, "A", 0, 2, 0, 2000, None, 0), (1, "B", 2, 1, 1500, 1800, 2000, 500), (2, "A", 3, 1, 1900, 2500, 2000, 100)]


def test_pause(spark):
    w = words(spark, [("A", "a", 0, 900), ("A", "b", 1000, 1900), ("A", "c", 2000, 2100), ("A", "d", 2500, 3000), ("B", "x", 9000, 9100)])
    assert [tuple(r) for r in speech.pauses_in_turns(w).collect()] == [("d", 0, 2100, 400)]


def greedy(slots, size):
    grid, out = {}, []
    for s in slots:
        while s in grid:
            s += 1
        grid[s] = True
        out.append(s if s < size else None)
    return out


def test_frames_against_greedy(spark):
    rng = random.Random(1)
    starts = sorted(rng.choice([0, 0, 80, 240, 800, 1000]) + rng.randrange(0, 900) for _ in range(40))
    w = words(spark, [("A", "x", s, s + 30) for s in starts])
    got = speech.placed(w).orderBy("word_idx").collect()
    size = int(((starts[-1] + 30) / 1000 + 1) * 12.5)
    want = greedy([int(s / 1000 // (1 / 12.5)) for s in starts], size)
    assert [None if r.dropped else r.frame for r in got] == want
    frames = [r.frame for r in got]
    assert all(r.end_pad == (r.frame > 0 and r.frame - 1 not in frames) for r in got)
    # thirteen words at 0 have twelve frames
    got = speech.placed(words(spark, [("A", "x", 0, 0)] * 13)).collect()
    assert sorted(r.frame for r in got if not r.dropped) == list(range(12))


def test_frame_of(spark):
    got = spark.range(0, 20000).select((F.col("id") / 1000).alias("s"), speech.frame_of(F.col("id") / 1000).alias("f")).collect()
    assert all(r.f == int(r.s // (1 / 12.5)) for r in got)


def test_blocks(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["a", None]), i, rng.choice([None, 1, 5, 9]), i // 3) for i in range(60)]
    df = spark.createDataFrame(rows, "k string, i int, v int, b int")
    for func, f in (("sum", lambda x: sum(x)), ("max", lambda x: max(x, default=None)), ("min", lambda x: min(x, default=None))):
        for r in blocks.running(df, ["k"], "b", ["i"], func, "v", "out").collect():
            want = f([v for k, i, v, _ in rows if k == r.k and i <= r.i and v is not None])
            assert r.out == want
    for after in (False, True):
        for r in blocks.neighbour(df, ["k"], "b", ["i"], ["i"], after=after, prefix="n_").collect():
            near = [i for k, i, _, _ in rows if k == r.k and (i > r.i if after else i < r.i)]
            assert r.n_i == ((min(near) if after else max(near)) if near else None)
    two = blocks.carry(df.groupBy("k", "b").agg(F.max("v").alias("m")), ["k"], "b", [blocks.Carry("last", "last", "m"), blocks.Carry("sum", "sum", "m")], fanout=2)
    for r in two.collect():
        m = {b: max((v for k, _, v, c in rows if k == r.k and c == b and v is not None), default=None) for b in {c for k, _, _, c in rows if k == r.k and c < r.b}}
        known = [m[b] for b in sorted(m) if m[b] is not None]
        assert r["last"] == (known[-1] if known else None) and r["sum"] == sum(known)
