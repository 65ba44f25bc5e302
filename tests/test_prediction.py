import json
import os
import random
from pathlib import Path

import pytest

from talkloom.operators import prediction

W = "dialogue_id string, word_idx int, speaker string, word string, start_ms long, end_ms long"
GOLDEN = [("A", "hello", 0, 400), ("A", "there", 400, 800), ("A", "how", 800, 1200), ("A", "today", 1200, 1600), ("B", "fine", 1700, 2100), ("B", "thanks", 2100, 2500)]


def run(spark, rows, **kw):
    w = spark.createDataFrame([("d", i, *r) for i, r in enumerate(rows)], W)
    return sorted(prediction.events(w, **kw).collect(), key=lambda r: r.timestamp_ms)


def test_golden_case(spark):
    got = run(spark, GOLDEN, predict=lambda r: "ok")
    assert [(r.channel, r.current_spoken_ratio, r.hint) for r in got] == [(1, 0.5, ""), (1, 0.75, "fine thanks"), (1, 1.0, "fine thanks")]
    assert got[0].conversation_context == "A: hello there" and got[0].timestamp_ms == 1000
    assert [r.prediction for r in run(spark, GOLDEN)] == ["fine thanks", "fine thanks"]
    assert run(spark, GOLDEN, predict=lambda r: "ok", channel=0) == []
    assert run(spark, []) == []


def brute(words, step, lines=10):
    """The ten steps over plain lists."""
    out, t, last = [], step, max((w[3] for w in words), default=0)
    while t < last:
        sofar = [i for i, w in enumerate(words) if w[3] <= t]
        if len(sofar) >= 2:
            at = sofar[-1]
            me, ke = words[at][0], words[at][3]
            hint = []
            for s, x, _, e in words:
                if s == me and hint and e > ke:
                    break
                if s != me and e > ke:
                    hint.append(x)
            if not hint:
                break
            n = 0
            while n < len(sofar) and words[sofar[-1 - n]][0] == me:
                n += 1
            more = 0
            while at + more + 1 < len(words) and words[at + more + 1][0] == me and words[at + more + 1][3] - words[at + more][3] < 1000:
                more += 1
            said = []
            for i in sofar:
                if said and said[-1][0] == words[i][0]:
                    said[-1][1].append(words[i][1])
                else:
                    said.append((words[i][0], [words[i][1]]))
            context = "\n".join(f"{s}: {' '.join(x)}" for s, x in said[-lines:])
            ratio = n / (n + more)
            out.append((t, len(sofar), words[at][1], " ".join(words[i][1] for i in sofar[-5:]), ratio, 1 if me == "A" else 0, " ".join(hint) if ratio > 0.5 else "", context))
        t += step
    return out


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, seed):
    rng = random.Random(seed)
    rows, t, who = [], 0, "A"
    for _ in range(260):
        if rng.random() < 0.15:
            who, t = "AB"[who == "A"], t + rng.choice([0, 300, 1500, 9000])
        n = rng.randrange(100, 600)
        e = t + n + (rng.randrange(5_000, 60_000) if rng.random() < 0.01 else 0)
        rows.append((who, f"w{len(rows)}", t, e))
        t += n
    for _ in range(25):
        i = rng.randrange(len(rows) - 4)
        j = i + rng.randrange(4)
        rows[i], rows[j] = rows[j], rows[i]
    got = run(spark, rows, step_ms=700, predict=prediction.verbatim, chunk=50, halo=80)
    have = [(r.timestamp_ms, r.total_word_count, r.trigger_word, r.recent_words, r.current_spoken_ratio, r.channel, r.hint) for r in got]
    assert have == [x[:7] for x in brute(rows, 700)]
    assert [r.conversation_context.split("\n")[-1] for r in got] == [x[7].split("\n")[-1] for x in brute(rows, 700)]


@pytest.mark.parametrize("swaps", [0, 30])
def test_monologue_longer_than_halo(spark, swaps):
    rng = random.Random(5)
    rows, t = [], 0
    for who, n in [("A", 3), ("B", 12), ("A", 260), ("B", 4), ("A", 2), ("B", 170), ("A", 5), ("B", 3), ("A", 150)]:
        for _ in range(n):
            e = rng.randrange(150, 500) + (1500 if rng.random() < 0.02 else 0)
            rows.append((who, f"w{len(rows)}", t, t + e))
            t += e
    for _ in range(swaps):
        i = rng.randrange(len(rows) - 4)
        rows[i], rows[i + 3] = rows[i + 3], rows[i]
    if swaps:
        rows.insert(330, rows.pop(90))
    got = run(spark, rows, step_ms=2000, predict=prediction.verbatim, chunk=40, halo=20)
    have = [(r.timestamp_ms, r.total_word_count, r.trigger_word, r.recent_words, r.current_spoken_ratio, r.channel, r.hint, r.conversation_context) for r in got]
    assert have == brute(rows, 2000)


#: A folder with text/*.json and oracle_raw/*.json of the same dialogues, at five seconds between events.
SAMPLE = Path(os.environ["DIALOGUE_PAIRS"]) if "DIALOGUE_PAIRS" in os.environ else next((p.parent for p in Path("/root").glob("*/data/*/oracle_raw")), Path("none"))


@pytest.mark.skipif(not (SAMPLE / "oracle_raw").is_dir(), reason="no folder of pairs")
def test_given_pairs(spark):
    words, want = [], []
    for p in sorted((SAMPLE / "oracle_raw").glob("*.json")):
        for i, w in enumerate(json.loads((SAMPLE / "text" / p.name).read_text())):
            words.append((p.stem, i, w["speaker"], w["word"], round(w["start"] * 1000), round(w["end"] * 1000)))
        for e in json.loads(p.read_text()):
            want.append((p.stem, e["timestamp_ms"], e["total_word_count"], e["trigger_word"], e["recent_words"], round(e["current_spoken_ratio"], 9), e["channel"], e["hint"], e["conversation_context"]))
    got = prediction.events(spark.createDataFrame(words, W), 5000, prediction.verbatim, lines=10_000).collect()
    have = [(r.dialogue_id, r.timestamp_ms, r.total_word_count, r.trigger_word, r.recent_words, round(r.current_spoken_ratio, 9), r.channel, r.hint, r.conversation_context) for r in got]
    assert sorted(have) == sorted(want)


def test_bad_speaker_raises(spark):
    with pytest.raises(Exception, match="unexpected speaker"):
        run(spark, [("A", "x", 0, 1000), ("C", "y", 1000, 3000)])


def test_frames(spark):
    rows = [("d", 0, 1000, 1, 0.2, "a b", None), ("d", 1, 2000, 1, 0.9, "", "h"), ("d", 2, 3040, 0, None, "c", "h i"), ("d", 3, 99_000, 0, 1.0, "d", "")]
    e = spark.createDataFrame(rows, "dialogue_id string, event_idx int, timestamp_ms long, channel int, current_spoken_ratio double, prediction string, hint string")
    got = [(r.event_idx, r.frame, r.skip_forbid, len(r.pred), len(r.hint)) for r in prediction.on_frames(e, 100).orderBy("event_idx").collect()]
    assert got == [(0, 12, False, 2, 0), (2, 38, False, 1, 2)]
