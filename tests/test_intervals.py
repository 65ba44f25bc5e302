import random

import pytest

from talkloom.operators import intervals

SCHEMA = "k string, start_ms long, end_ms long, s string, e int, block int"


def brute(rows, gap=0):
    out = []
    for k in {r[0] for r in rows}:
        cur = None
        for a, b in sorted((a, b) for x, a, b in rows if x == k and a is not None and b is not None and b >= a):
            if cur and a - cur[1] <= gap:
                cur[1] = max(cur[1], b)
            else:
                if cur:
                    out.append((k, *cur))
                cur = [a, b]
        if cur:
            out.append((k, *cur))
    return sorted(out, key=lambda r: (str(r[0]), *r[1:]))


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("block", [7, 600_000])
def test_periods_and_gaps_against_brute_force(spark, seed, block):
    rng = random.Random(seed)
    rows = [(rng.choice(["a", "b", None]), a := rng.randrange(300), a + rng.choice([-3, 0, 0, 1, 2, 5, 9, 80])) for _ in range(60)]
    rows += rows[:10] + [("a", None, 5), ("a", 5, None), ("hot", 0, 299)]
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)
    for gap in (0, 4):
        got = sorted(map(tuple, intervals.periods(df, ["k"], max_gap_ms=gap, block_ms=block).collect()), key=lambda r: (str(r[0]), *r[1:]))
        assert got == brute(rows, gap)
    want = [(p[0], p[2], q[1]) for p, q in zip(brute(rows), brute(rows)[1:]) if p[0] == q[0]]
    assert sorted(map(tuple, intervals.gaps(df, ["k"], block_ms=block).collect()), key=repr) == sorted(want, key=repr)


def test_empty_table_and_usable_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert intervals.gaps(empty, ["k"]).count() == 0 and intervals.periods(empty, ["k"]).count() == 0
    rows = [("d", "A", 0.0, 1.0), ("d", "A", 1.0005, 2.0), ("d", "X", 0.0, 9.0), ("d", "A", float("nan"), 3.0), ("d", "A", 5.0, 4.0), ("d", None, 0.0, 1.0), ("d", "A", None, 1.0), ("d", "A", 0.0, float("inf"))]
    w = spark.createDataFrame(rows, "dialogue_id string, speaker string, start double, end double")
    assert [tuple(r) for r in intervals.usable_speech(w).collect()] == [("d", "A", 0, 1000), ("d", "A", 1001, 2000)]
