from datetime import datetime

from talkloom.llm import turns

RAW = "dialogue_id string, word_idx int, speaker string, word string, start double, end double, loaded_at timestamp, block int"
T0, T1 = datetime(2025, 1, 1), datetime(2025, 1, 2)
ALIASES = {"steward": "B", "pax": "A", "hôtesse": "B"}


def found(spark, rows, lang="en"):
    raw = spark.createDataFrame([(*r, T0, 1) if len(r) == 6 else (*r, 1) for r in rows], RAW)
    d = spark.createDataFrame([("d", lang)], "dialogue_id string, lang string")
    a = spark.createDataFrame([*ALIASES.items(), (None, "A"), ("x", "C"), ("PAX", "A")], "alias string, speaker string")
    s = turns.spoken_words(raw, a, d)
    return sorted((r.turn_no, r.first_word_idx, r.speaker, r.n_words) for r in turns.turns(s).collect()), s


def texts(s):
    return [r.text for r in turns.turns(s, texts=True).orderBy("turn_no").collect()]


def row(i, speaker, word, start=None):
    return ("d", i, speaker, word, float(i if start is None else start), float(i) + 0.5)


def test_labels_notes_and_hums(spark):
    words = [
        row(0, None, ">> Steward:"), row(1, None, "Good"), row(2, "SPEAKER_01", "uhm..."), row(3, "ch1", "evening[coughs]"), row(4, None, "(seat"), row(5, None, "belt"), row(6, None, "chime)"),
        row(7, "Pax:", "u-um"), row(8, None, "the-"), row(9, "channel 0", "[00:08]"), row(10, " a ", "00:00:22.403"), row(11, "spk_0", "—"), row(12, "speaker_A", "order"), row(13, "B", "[laughs]."),
        row(14, None, "okay"), row(15, "hôtesse", None), row(16, "A", "(B)"), row(17, None, "mm-hmm"), row(18, None, "yes"), row(19, "A", "12:30"), row(20, "A", "<t=2.76>"), ("d", 21, "A", "late", None, None),
    ]
    got, _ = found(spark, words)
    assert got == [(0, 1, "B", 2), (1, 8, "A", 2), (2, 14, "B", 2), (3, 19, "A", 1)]


def test_language_decides_on_hums(spark):
    words = [row(0, "A", "um"), row(1, "A", "acht"), row(2, "A", "äh"), row(3, "A", "ich")]
    assert found(spark, words, "de")[0] == [(0, 0, "A", 3)]
    assert found(spark, words, "en")[0] == [(0, 1, "A", 3)]
    german = [row(i, "A", w) for i, w in enumerate("um ich die das der und mir".split())]
    assert found(spark, german, None)[0] == [(0, 0, "A", 7)]


def test_order_redelivery_and_missing_labels(spark):
    words = [row(0, None, "lost"), row(5, "A", "two", 1.0), row(3, "A", "one", 1.0), row(7, "B", "three", 2.0), ("d", 7, "B", "changed", 2.0, 2.5, T1), row(8, None, "four", 3.0), row(9, "A", "five", float("nan"))]
    got, s = found(spark, words)
    assert got == [(0, 3, "A", 2), (1, 7, "B", 2)]
    assert texts(s) == ["one two", "changed four"]


def test_turns_over_blocks(spark):
    rows = [("d", i, "A" if i < 40 or i >= 90 else "B", f"w{i}", i * 60.0, i * 60.0 + 1) for i in range(120)]
    rows = [(*r[:2], None if i % 7 else r[2], *r[3:]) if i not in (0, 40, 90) else r for i, r in enumerate(rows)]
    got, s = found(spark, rows)
    assert got == [(0, 0, "A", 40), (1, 40, "B", 50), (2, 90, "A", 30)]
    assert [len(t.split()) for t in texts(s)] == [40, 50, 30]


def test_note_over_a_block_border(spark):
    rows = [("d", 0, "A", "well", 598.0, 598.2), ("d", 1, "A", "*door", 599.5, 600.0), ("d", 2, "A", "slams*", 600.1, 600.4), ("d", 3, "A", "yes", 601.0, 601.2), ("d", 4, "A", "[seat", 700.0, 700.1), ("d", 5, "A", "belt", 701.0, 701.1)]
    assert found(spark, rows)[0] == [(0, 0, "A", 3)]


def test_long_note_over_blocks(spark):
    rows = [("d", 0, "A", "well", 0.0, 0.2), ("d", 1, "A", "[someone", 1.0, 1.1), *[("d", i, None, f"reads{i}", i * 5.0, i * 5.0 + 1) for i in range(2, 400)], ("d", 400, None, "aloud]", 2000.0, 2001.0), ("d", 401, "B", "yes", 2002.0, 2003.0)]
    assert found(spark, rows)[0] == [(0, 0, "A", 1), (1, 401, "B", 1)]
    broken = [r if r[1] != 200 else (*r[:3], "(reads", *r[4:]) for r in rows]  # another mark between: no note
    assert found(spark, broken)[0] == [(0, 0, "A", 398), (1, 401, "B", 1)]


def test_null_dialogue_and_ties(spark):
    rows = [(None, i, "A" if i < 3 else "B", "same", 1.0, 1.0) for i in range(5)] * 2
    got, s = found(spark, rows)
    assert got == [(0, 0, "A", 3), (1, 3, "B", 2)] and turns.turns(s).first().dialogue_id is None


def test_empty(spark):
    assert found(spark, [])[0] == []
