import random
from datetime import datetime

import pytest

from talkloom.operators import scripts
from talkloom.plans import scripts as plans

T = "script_id string, turn_no long, speaker string, text string, emotion string, intensity int, backchannel boolean, interrupts boolean, floor string"


def turn(speaker, text, **kw):
    return {"speaker": speaker, "text": text, "dur": 2.0} | kw


def test_errors(spark):
    rows = [
        ("s", 0, "passenger", "hello", "neutral", 0, True, None, "x"), ("s", 1, "crew", "seat 3 (here)", None, None, None, None, "x"), ("s", 2, "pilot", "", None, None, True, True, "x"),
        ("s", 3, "crew", " ", None, None, True, True, "x"), ("s", 4, "passenger", "ok", "bored", 4, None, None, "x"), ("t", 0, "crew", "hi", None, None, None, None, "x"),
    ]
    got = sorted(tuple(r) for r in scripts.turn_errors(spark.createDataFrame(rows, T)).collect())
    assert got == sorted([
        ("s", 0, "begins with backchannel or interrupt"), ("s", 1, "digits in text"), ("s", 1, "brackets in text"), ("s", 2, "bad speaker"), ("s", 3, "empty text"),
        ("s", 3, "both backchannel and interrupt"), ("s", 3, "backchannel or interrupt by the floor"), ("s", 4, "unknown emotion"), ("s", 4, "intensity not 0 to 3"), ("t", -1, "fewer than 4 turns"),
    ])


def frame(spark, scripts):
    """Scripts as lists of turns into one row per turn, with columns that clash with those of the operators."""
    fields = {"speaker": "string", "text": "string", "gap_s": "double", "emotion": "string", "intensity": "int", "backchannel": "boolean", "at": "string", "interrupts": "boolean", "dur": "double"}
    rows = [(k, i, *[t.get(f) for f in fields], 1, "x") for k, ts in scripts.items() for i, t in enumerate(ts)]
    return spark.createDataFrame(rows, "script_id string, turn_no long, " + ", ".join(f"{k} {v}" for k, v in fields.items()) + ", block int, floor string")


def ordered(df):
    return df.orderBy("script_id", "turn_no").collect()


def test_overlaps(spark):
    long = "this is a rather long turn with many words..."
    t = [turn("crew", long), turn("passenger", "mhm", backchannel=True, at="not there"), turn("crew", "yes", backchannel=True), turn("passenger", "wait", interrupts=True), turn("crew", "no", interrupts=True)]
    got = ordered(scripts.overlaps_fixed(frame(spark, {"s": t})))
    assert [x.text for x in got] == [long, "mhm", "wait", "no"]
    assert got[1]["at"] is None and got[2].interrupts is True and got[3].interrupts is None and got[3].gap_s == 0.1
    first = [turn("crew", "hm", backchannel=True), turn(None, None, interrupts=True)]
    assert [(x.text, x.interrupts) for x in ordered(scripts.overlaps_fixed(frame(spark, {None: first})))] == [(None, None)]


def test_repairs_feed_forward(spark):
    t = [turn("passenger", "row 12", emotion="Furious", intensity=3), turn("passenger", "x", emotion="calm", intensity=0), turn("passenger", "y", emotion=None, intensity=None), turn("passenger", "z", emotion="neutral", intensity=9)]
    got = [(x.text, x.emotion, x.intensity) for x in ordered(scripts.repaired(frame(spark, {"s": t})))]
    assert got == [("row twelve", "angry", 3), ("x", "neutral", 2), ("y", "neutral", 2), ("z", "neutral", 3)]


def walk_emotions(turns):
    """Turn by turn: what emotion and intensity the passenger's turns get."""
    out, name, level = [], "neutral", 0
    for t in turns:
        if t["speaker"] != "passenger":
            out.append((t["emotion"], t["intensity"]))
            continue
        own = t["emotion"].strip().lower() if t["emotion"] is not None else name
        own = scripts.SYNONYMS.get(own, own)
        now = level if t["intensity"] is None else min(3, max(0, t["intensity"]))
        if not t["backchannel"]:
            now = max(now, level - 1) if own in scripts.EMOTIONS else now
            name, level = own, now
        out.append((own, now))
    return out


def walk_places(turns):
    """Turn by turn: start and end with the middle of every range, in milliseconds."""
    out, free, floor = [], {True: 0, False: 0}, None
    for i, t in enumerate(turns):
        me, dur, cut = t["speaker"] == "passenger", round((t["dur"] or 0) * 1000), None
        if floor is None:
            at = 400
        else:
            f, (a, b), long = turns[floor], out[floor], round((turns[floor]["dur"] or 0) * 1000)
            broken, same = (f["text"] or "").endswith(("...", "-")), (f["speaker"] == "passenger") == me
            if t["backchannel"]:
                at = a + long * 0.55
            elif t["interrupts"] and not same and long >= 1200:
                behind = long - 275 if broken else max(600, 0.625 * long)
                at, cut = a + behind, a + min(long, behind + (140 if broken else 375))
            else:
                gap = 500 if t["gap_s"] is None else t["gap_s"] * 1000
                at = b + (max(gap, 150) if same else gap)
        if cut is not None:
            out[floor] = (out[floor][0], round(cut))
            free[not me] = round(cut)
        start = max(round(at), free[me] + 50)
        free[me] = start + dur
        out.append((start, start + dur))
        if not t["backchannel"]:
            floor = i
    return out


@pytest.mark.parametrize("block", [4, 1000])
def test_long_scripts_against_a_walk(spark, monkeypatch, block):
    monkeypatch.setattr(scripts, "BLOCK", block)
    rng = random.Random(block)
    pick = lambda *xs: rng.choice(xs)
    many = {
        f"s{k}": [turn(pick("passenger", "crew"), pick("yes", "now...", None), gap_s=pick(None, 0.1, 1.25), emotion=pick(None, "calm", " Furious", "bored"), intensity=pick(None, -1, 0, 2, 9), backchannel=pick(None, False, True), interrupts=pick(None, True), dur=pick(None, 0.5, 1.2, 3.2)) for _ in range(rng.randrange(1, 40))]
        for k in range(12)
    }
    df = frame(spark, many)
    want = [x for k in sorted(many) for x in walk_emotions(many[k])]
    assert [(r.emotion, r.intensity) for r in ordered(scripts.repaired(df))] == want
    assert [(r.start_ms, r.end_ms) for r in ordered(scripts.placed(df))] == [x for k in sorted(many) for x in walk_places(many[k])]


def test_placement(spark):
    t = [turn("crew", "a"), turn("passenger", "b", gap_s=0.5), turn("crew", "m", backchannel=True, dur=0.3), turn("crew", "now...", interrupts=True)]
    df = frame(spark, {"s": t})
    got = [(r.start_ms, r.end_ms, r.cut) for r in ordered(scripts.placed(df))]
    assert got[0] == (400, 2400, False) and got[1] == (2900, 4525, True) and got[2][0] == 4000 and got[3][0] == 4350
    assert [r.start_ms for r in ordered(scripts.placed(frame(spark, {"s": [turn("crew", "a"), turn("crew", "b", gap_s=0.0)]})))] == [400, 2550]
    once, again = (ordered(scripts.placed(df.repartition(n), scripts.seeded(3))) for n in (1, 5))
    assert once == again and once != ordered(scripts.placed(df, scripts.seeded(4)))
    assert scripts.placed(df.limit(0)).count() == 0


def test_anchors_and_words(spark):
    t = [turn("crew", "we will take off soon", dur=3.0), turn("passenger", "ok", backchannel=True, at="Take off,"), turn("passenger", "hm", backchannel=True, at="nowhere"), turn("passenger", "wait", interrupts=True)]
    df = frame(spark, {"s": t})
    said = [("we", 0.0, 0.4), ("will", 0.5, 0.8), ("take", 1.0, 1.2), ("off", 1.3, 1.5), ("soon", 2.0, 2.9)]
    words = spark.createDataFrame([("s", 0, i, "B", *w) for i, w in enumerate(said)] + [("s", 3, 0, "A", "wait", 0.0, 1.0)], "script_id string, turn_no long, idx int, speaker string, word string, start_s double, end_s double")
    a = scripts.anchors(df, words)
    assert [(r.turn_no, r.anchor_s) for r in ordered(a)] == [(1, 1.5), (2, 1.5)]
    p = scripts.placed(df.join(a, ["script_id", "turn_no"], "left"))
    assert [r.start_ms for r in ordered(p)][1] == 400 + 1500 + 150
    got = [(r.turn_no, r.word, r.start_ms) for r in scripts.spoken_words(words, p).orderBy("start_ms").collect()]
    assert got[:4] == [(0, "we", 400), (0, "will", 900), (0, "take", 1400), (0, "off", 1700)] and "soon" not in [x[1] for x in got]


def test_emotion_changes(spark):
    rows = [("s", 0, "passenger", "sad", 1, None), ("s", 1, "crew", None, None, None), ("s", 2, "passenger", "sad", 2, " "), ("s", 3, "passenger", "angry", 2, "news"), ("s", 4, "passenger", "angry", None, None)]
    df = spark.createDataFrame(rows, "script_id string, turn_no long, speaker string, emotion string, intensity int, trigger string")
    assert [r.turn_no for r in ordered(scripts.emotion_changes(df))] == [2, 4]


def test_turn_across_blocks(spark, tmp_path):
    who = lambda i: "A" if i < 990 else "B" if i < 3010 else "A"
    rows = [("d", i, who(i), "7" if i == 2500 else f"w{chr(97 + i % 26)}", i * 0.3, i * 0.3 + 0.2, datetime(2025, 1, 1)) for i in range(3020)]
    w = spark.createDataFrame(rows, "dialogue_id string, word_idx int, speaker string, word string, start double, end double, loaded_at timestamp")
    w.write.parquet(str(tmp_path / "words.parquet"))
    got = {r.turn_no: r.text.split(" ") for r in plans._turns(plans._turn_words(spark, str(tmp_path))).collect()}
    assert got == {n: [r[3] for r in rows[a:b]] for n, (a, b) in enumerate([(0, 990), (990, 3010), (3010, 3020)])}
    assert ("d", "digits in text", 1) in {tuple(r) for r in plans.pred_turn_errors(spark, str(tmp_path)).collect()}
    assert {r.problem: r.n for r in plans.pred_clips(spark, str(tmp_path)).collect()}.get("too long") is None
