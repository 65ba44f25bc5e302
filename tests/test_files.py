import json
import struct

import pytest

from talkloom.sources import files


def test_transcripts_and_events(spark, tmp_path):
    d = tmp_path / "text"
    d.mkdir()
    (d / "a.json").write_text(json.dumps([{"speaker": "A", "word": "hi", "start": 0.0, "end": 0.4}, {"speaker": "B", "word": "yes", "start": 0.1, "end": 0.2}]))
    (d / "bad.json").write_text("{nothing")
    (d / "none.json").write_text("[]")
    got = sorted(map(tuple, files.read_transcripts(spark, str(d)).collect()))
    assert got == [("a", 0, "A", "hi", 0.0, 0.4), ("a", 1, "B", "yes", 0.1, 0.2)]
    status = {r.dialogue_id: r.readable for r in files.read_json_arrays(spark, str(d), "struct<x:int>").collect()}
    assert status["bad"] is False and status["none"] is True
    assert sorted(r.id for r in files.file_ids(spark, str(d), ".json").collect()) == ["a", "bad", "none"]
    done = spark.createDataFrame([("a",)], "id string")
    assert sorted(r.id for r in files.pending(files.file_ids(spark, str(d), ".json"), done).collect()) == ["bad", "none"]


def test_logs(spark, tmp_path):
    (tmp_path / "1.log").write_text("[1/2] x: failed (3s)\nCUDA Out of Memory\n[2/2] y: ok\n")
    (tmp_path / "2.log").write_text("noise\n[1/1] x: ok (12s)\n")
    assert {r.id: r.status for r in files.log_status(spark, str(tmp_path)).collect()} == {"x": "ok", "y": "ok"}
    assert files.log_count(spark, str(tmp_path)).collect()[0].n == 1


def test_wav(spark, tmp_path):
    data = b"\0" * 8000
    head = b"RIFF" + struct.pack("<I", 36 + len(data)) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, 8000, 16000, 2, 16) + b"data" + struct.pack("<I", len(data))
    (tmp_path / "a.wav").write_bytes(head + data)
    (tmp_path / "b.wav").write_bytes(b"nothing")
    got = {r.id: r.seconds for r in files.wav_durations(spark, str(tmp_path)).collect()}
    assert got["a"] == 0.5 and got["b"] is None


def test_shards(spark, tmp_path):
    df = spark.createDataFrame([(f"d{i:03}", i) for i in range(25)], "dialogue_id string, v int")
    files.write_shards(df, str(tmp_path / "s"), per_file=10)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert sorted((r.dialogue_id, r.shard) for r in back.collect()) == [(f"d{i:03}", i // 10) for i in range(25)]
    both = files.read_shards(spark, [str(tmp_path / "s/shard=0"), str(tmp_path / "s/shard=1")], [lambda d: d, lambda d: d.withColumn("extra", d.v)])
    assert both.count() == 20 and "extra" in both.columns
    with pytest.raises(KeyError):
        files.require(both, ["A_audio"])


def test_reports_and_specs(spark, tmp_path):
    df = spark.createDataFrame([("a", 1)], "id string, n int")
    for kind in ("csv", "json"):
        files.write_report(df, str(tmp_path / kind), kind)
    files.write_report(df.select("id"), str(tmp_path / "text"), "text")
    files.append_lines(df, str(tmp_path / "lines"))
    files.append_lines(df, str(tmp_path / "lines"))
    assert spark.read.json(str(tmp_path / "lines")).count() == 2
    assert files.parse_speakers("B, A") == ["B", "A"] and files.parse_thresholds("1,2,3", ["v=4,5,6"])["v"] == (4, 5, 6)
    for bad in ("C", "A,A", ""):
        with pytest.raises(ValueError):
            files.parse_speakers(bad)
    assert files.prompt_parts("a {{x}}\n---\nb\n---\nc") == ["a {{x}}", "b", "c"]
    with pytest.raises(ValueError):
        files.prompt_parts("a\n---\nb {{x}}\n---\nc")


def test_alignments_and_records(spark):
    a = spark.sql("select 'd' dialogue_id, array(named_struct('text', 'hi', 'span', named_struct('start', 0.5D, 'end', 0.75D), 'tag', 'x')) items")
    assert tuple(files.words_of_alignments(a, "B").first()) == ("d", 0, "B", "hi", 0.5, 0.75)
    e = spark.sql("select 'd' dialogue_id, 0 event_idx, 5L timestamp_ms, 'c' conversation_context, 'p' prediction, 2 total_word_count, 't' trigger_word, 'r' recent_words, 0.5D current_spoken_ratio, 1 channel, cast(null as string) hint")
    assert files.event_records(e).first().record.startswith('{"timestamp_ms":5,"conversation_context":"c"') and '"hint":null' in files.event_records(e).first().record


def test_ranks_of_any_ids(spark):
    ids = [f"same_prefix_{i:05}" for i in range(300)] + ["é", "ü-7", "", "z" * 500, "same_prefix_00001"]
    df = spark.createDataFrame([(x, i, "shard") for i, x in enumerate(ids)] + [(None, -1, "x")], "id string, v int, place string").drop("place")
    got = {r.v: r.place for r in files.ranked(df, "id", 7).collect()}
    order = sorted(range(len(ids)), key=lambda i: (ids[i].encode(), 0))
    assert got[-1] == 0 and sorted(got.values()) == list(range(len(ids) + 1))
    assert [ids[v] for v in sorted((v for v in got if v >= 0), key=got.get)] == [ids[i] for i in order]
    assert files.ranked(df.limit(0), "id").count() == 0 and [r.id for r in files.listed(df, "id", 2).collect()] == [None, ""]


def test_valid_packed_rows(spark):
    cols = [f"{s}_oracle_{c}" for s in "AB" for c in ("event_frame_pos", "event_ratio", "event_skip_forbid", "pred_values", "pred_offsets", "hint_values", "hint_offsets")]
    good = [[0, 3], [0.5, 1.0], [1, 1], [21, 22], [0, 1, 2], [], [0, 0, 0]]
    none = [[], [], [], [], [0], [], [0]]
    rows = [("ok", *good, *none), ("short", *good[:4], [0, 1], *good[5:], *none), ("falls", *good[:4], [0, 3, 2], *good[5:], *none), ("null", None, *good[1:], *none)]
    kinds = ["array<int>", "array<float>", "array<int>", "array<int>", "array<int>", "array<int>", "array<int>"] * 2
    df = spark.createDataFrame(rows, "id string, " + ", ".join(f"{c} {k}" for c, k in zip(cols, kinds)))
    assert {r.id: r.valid for r in files.valid_packed(df).collect()} == {"ok": True, "short": False, "falls": False, "null": False}
    with pytest.raises(KeyError):
        files.valid_packed(df.drop(cols[3]))
