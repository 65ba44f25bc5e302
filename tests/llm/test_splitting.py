import random

from pyspark.sql import functions as F

from talkloom.llm import splitting as sp

WORDS = "dialogue_id string, word_idx int, speaker string, word string, start double, end double, at_ms int"
EVENTS = "dialogue_id string, event_idx int, timestamp_ms long, block int"


def talk(d, seconds, rng, pause=0.5, vocabulary=40, t=0.0):
    rows, i = [], 0
    while t < seconds:
        for _ in range(rng.randrange(3, 12)):
            n = rng.uniform(0.2, 0.5)
            rows.append((d, i, rng.choice("AB"), f"w{rng.randrange(vocabulary)}", round(t, 3), round(t + n, 3), 0))
            t, i = t + n, i + 1
        t += pause
    return rows


def pieces_of(spark, words, events=()):
    w = spark.createDataFrame(words, WORDS)
    e = spark.createDataFrame(list(events), EVENTS)
    got = {}
    for r in sp.split(w, e, block_ms=100_000).collect():
        got.setdefault(r.dialogue_id, []).append(r)
    for v in got.values():
        v.sort(key=lambda r: r.piece_no)
    return got


def check(v):
    assert [r.piece_no for r in v] == list(range(len(v))) and v[-1].end_kind == "end"
    assert all(r.to_ms - r.from_ms <= sp.LIMIT_MS for r in v)
    assert all(b.from_ms == a.to_ms - sp.OVERLAP_MS for a, b in zip(v, v[1:]))


def test_pieces(spark):
    rng = random.Random(1)
    words = talk("long", 700, rng) + talk("short", 100, rng) + talk("solid", 450, rng, pause=0.0)
    words += words[:20] + [("long", 9000, "A", None, None, 2.0, 0), ("long", 9001, "X", "x", 0.0, 9000.0, 0), ("nobody", 0, None, "x", 0.0, 1.0, 0)]
    events = [("short", 0, 400_000, 0), ("short", 0, 400_000, 0), ("long", 0, None, 0), ("ghost", 0, 5, 0)]
    got = pieces_of(spark, words, events)
    assert set(got) == {"long", "short", "solid"}
    for v in got.values():
        check(v)
    assert all(r.end_kind == "natural" for r in got["long"][:-1])
    assert all(r.end_kind == "forced" for r in got["solid"][:-1])
    assert len(got["short"]) > 1 and got["short"][-1].to_ms == 400_000
    # natural cuts lie in silences
    busy = [(r[4] * 1000, r[5] * 1000) for r in words if r[0] == "long" and r[4] is not None and r[2] in "AB"]
    for r in got["long"][:-1]:
        assert not any(a < r.to_ms < b for a, b in busy)
    assert kinds(spark, words, events) == {"long": "natural", "short": "natural", "solid": "forced"}


def kinds(spark, words, events=()):
    w, e = spark.createDataFrame(words, WORDS), spark.createDataFrame(list(events), EVENTS)
    return {r.dialogue_id: r.cut_kind for r in sp.cut_kinds(sp.cuts(w, e, block_ms=100_000)[1]).collect()}


def test_kinds_agree_with_stretches(spark):
    """A stretch of 188 to 192 s is cut only because of the overlap, which doesn't make the dialogue forced."""
    words = []
    for k, solid in enumerate((150, 186, 189, 191.9, 192.1, 300)):
        d, t, i = f"d{k}", 0.0, 0
        for n in (90, solid, 90):
            for j in range(int(n)):
                words.append((d, i, "A", f"w{i * (k + 1) % 37}", t + j * n / int(n), t + (j + 1) * n / int(n), 0))
                i += 1
            t += n + 0.5
    assert kinds(spark, words) == {"d0": "natural", "d1": "natural", "d2": "natural", "d3": "natural", "d4": "forced", "d5": "forced"}
    got = pieces_of(spark, words)
    for v in got.values():
        check(v)


def test_far_times_and_long_silences(spark):
    words = [("far", 0, "A", "x", 0.0, 1.0, 0), ("far", 1, "A", "y", 3e6, 3e6 + 1, 0), ("drone", 0, "A", "x", 0.0, 1e5, 0)]
    assert kinds(spark, words) == {"far": "natural", "drone": "forced"}
    assert kinds(spark, [("far", 0, "A", "x", 0.0, 1.0, 0), ("far", 1, "A", "y", 1e11, 1e11 + 1, 0)]) == {"far": "natural"}
    got = pieces_of(spark, words)
    for v in got.values():
        check(v)
    assert len(got["drone"]) == -(-100_000_000 // 187_000)


def content(spark, words, block_ms=100_000):
    """What the pieces hold, as tuples of words."""
    w = spark.createDataFrame(words, WORDS)
    p = sp.split(w, spark.createDataFrame([], EVENTS), block_ms=block_ms)
    rows = sp.members(p, w.selectExpr("dialogue_id", "word_idx", "word", "bigint(round(start * 1000)) at"), "at").collect()
    by = {}
    for r in sorted(rows, key=lambda r: r.at):
        by.setdefault(r.piece_no, []).append(r.word)
    return [tuple(v) for _, v in sorted(by.items())]


def test_an_edit_alters_neighbouring_pieces_only(spark):
    rng = random.Random(2)
    words = talk("d", 3000, rng)
    edited = [(*r[:3], "edited", *r[4:]) if 1500 < r[4] < 1505 else r for r in words]
    a = {r.to_ms for r in pieces_of(spark, words)["d"]}
    b = {r.to_ms for r in pieces_of(spark, edited)["d"]}
    assert all(abs(t - 1_500_000) < 2 * sp.LIMIT_MS for t in a ^ b) and len(a & b) > len(a) * 0.6


def test_an_insertion_leaves_later_pieces_as_they_were(spark):
    rng = random.Random(5)
    words = [(*r[:3], r[3], round(r[4], 3), round(r[5], 3), 0) for r in talk("d", 2400, rng)]
    base = content(spark, words)
    for more in (13.0, 57.5, 333.25):
        new = [("d", 0, "A", "new", 0.0, 2.0, 0), *[(d, i + 1, s, w, a + more, b + more, 0) for d, i, s, w, a, b, _ in words]]
        got = content(spark, new)
        same = len(set(got) & set(base))
        assert same >= len(base) - 4 and got[-3:] == base[-3:], (more, same, len(base))
    assert content(spark, words, 37_000) == base and content(spark, words, 900_000) == base


def test_cuts_of_one_phrase_said_again_and_again(spark):
    """Without content to tell places apart there are no strong cuts; cells bound what is gathered."""
    rows, t = [], 0.0
    for i in range(9000):
        rows.append(("d", i, "A", "no", t, t + 0.3, 0))
        t += 0.8 if i % 5 == 4 else 0.3
    v = pieces_of(spark, rows)["d"]
    check(v)
    assert all(r.end_kind == "natural" for r in v[:-1])


def test_members(spark):
    rng = random.Random(3)
    words = talk("d", 500, rng)
    w, e = spark.createDataFrame(words, WORDS), spark.createDataFrame([("d", 0, 0, 0), ("d", 1, 200_000, 0)], EVENTS)
    p = sp.split(w, e)
    rows = sp.members(p, sp.speech_of(w).select("dialogue_id", "word_idx", "start_ms"), "start_ms").collect()
    by = {}
    for r in rows:
        by.setdefault(r.word_idx, []).append(r.piece_no)
    assert set(by) == {r[1] for r in words} and all(len(v) <= 2 for v in by.values()) and any(len(v) == 2 for v in by.values())
    assert {r.event_idx for r in sp.members(p, e, "timestamp_ms").collect()} == {0, 1}


def test_inner_cuts():
    assert sp.inner_cuts(0, 100, [], 187, 60) == []
    assert sp.inner_cuts(0, 400, [], 187, 60) == [(187, "forced", 2, 400)]
    got = sp.inner_cuts(0, 300, [(10, 20, False), (100, 110, True), (150, 160, False)], 187, 60)
    assert got[0][:3] == (105, "natural", 1)
    assert sp.inner_cuts(0, 1000, [(5, 995, False)], 187, 60)[0][1] == "natural"


def test_empty(spark):
    assert sp.split(spark.createDataFrame([], WORDS), spark.createDataFrame([], EVENTS)).count() == 0


def test_null_dialogue_is_cut_like_others(spark):
    rows = talk("d", 500, random.Random(3))
    got = pieces_of(spark, rows + [(None, *r[1:]) for r in rows])
    assert len(got["d"]) > 1 and [r[1:] for r in got[None]] == [r[1:] for r in got["d"]]
