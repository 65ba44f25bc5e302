import random

from talkloom.llm import packing, tokens
from pyspark.sql import functions as F


def check(rows, sizes, capacity):
    fill, pieces = {}, {}
    for r in rows:
        fill[r.item_no] = fill.get(r.item_no, 0) + r.tokens
        pieces.setdefault((r.id, r.item_tokens, r.copy), []).append((r.first_token, r.tokens))
    assert all(v <= capacity for v in fill.values())
    want = sorted((i, s or 0) for i, s in sizes)
    assert sorted((k[0], sum(n for _, n in v)) for k, v in pieces.items()) == want
    for v in pieces.values():
        v.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(v, v[1:])) and (len(v) == 1 or all(n == capacity for _, n in v[:-1]))
    return len([v for v in fill.values() if v])


def test_search_reaches_the_bound():
    rng = random.Random(3)
    for capacity, n in ((100, 200), (2048, 400)):
        sizes = [rng.randrange(1, capacity // 2) for _ in range(n)]
        bins = packing.pack_items(sizes, capacity)
        assert sorted(i for b in bins for i in b) == list(range(n)) and max(sum(sizes[i] for i in b) for b in bins) <= capacity
        assert len(bins) <= -(-sum(sizes) // capacity) + 1


def test_search_improves_a_bad_start():
    sizes = [60, 40, 50, 50, 35, 35, 30]
    start = [[i] for i in range(len(sizes))]
    done = packing.local_search(sizes, start, 100)
    assert len(done) == 3 and all(sum(sizes[i] for i in b) <= 100 for b in done)
    # 45 has to take the place of 40 first
    sizes = [55, 52, 40, 8, 45]
    assert len(packing.local_search(sizes, [[0, 2], [1, 3], [4]], 100)) == 2


def test_pack(spark):
    rng = random.Random(1)
    sizes = [(i, rng.choice([0, None, 5, 17, 33, 64, 65, 200])) for i in range(150)] + [(0, 64), (0, 64), (7, 500)]
    df = spark.createDataFrame([(i, s, "x", 1) for i, s in sizes], "id long, n long, item_no string, place int")
    rows = packing.pack(df, "id", "n", 64, shard_items=40).collect()
    used = check(rows, sizes, 64)
    total = sum(s or 0 for _, s in sizes)
    assert used <= total / 64 * 1.1 + 2
    places = {}
    for r in rows:
        places.setdefault(r.item_no, []).append((r.place, r.start_token, r.tokens))
    for v in places.values():
        v.sort()
        assert [p for p, _, _ in v] == list(range(len(v))) and all(a + n == b for (_, a, n), (_, b, _) in zip(v, v[1:]))
    assert packing.pack(df.limit(0), "id", "n", 64).count() == 0


def test_tokens(spark):
    texts = [("It's 3,5  é_x \n", 9), ("", 0), (None, 0), ("a" * 100_000, 1), ("ab12 " * 3000, 3000), ("¿qué?", 3)]
    df = spark.createDataFrame(texts, "text string, n int")
    assert all(r.n == r.t for r in df.select("n", tokens.n_tokens(F.col("text")).alias("t")).collect())
