from pathlib import Path

import pytest
from pyspark.sql import functions as F

from talkloom.functions import tokenize, training
from talkloom.operators import speech

PATH = Path("/opt/tokenizers/byte_bpe_50k.json")


@pytest.mark.skipif(not PATH.exists(), reason="no vocabulary file")
def test_token_ids(spark):
    df = spark.createDataFrame([(0, "hello there\nyou"), (1, None), (2, "")], "i int, t string")
    got = {r.i: r.x for r in df.select("i", tokenize.token_ids(F.col("t"), str(PATH), newline=198, begin=50256).alias("x")).collect()}
    encode = tokenize.encoder(str(PATH))
    assert got[0] == [50256, *encode(["hello there"])[0], 198, *encode(["you"])[0]] and got[1] is None and got[2] == [50256]


def test_pieces(spark):
    w = spark.createDataFrame([("d", 0, "A", "abcd", 0, 400), ("d", 1, "A", "", 400, 500)], "dialogue_id string, word_idx int, speaker string, word string, start_ms long, end_ms long")
    got = [tuple(r)[3:] for r in speech.pieces(w).orderBy("word_idx", "piece_idx").collect()]
    assert got == [(0, "a", 0.0, 100.0), (1, "b", 100.0, 200.0), (2, "c", 200.0, 300.0), (3, "d", 300.0, 400.0), (0, "", 400.0, 400.0)]
    two = speech.pieces(w, F.array(F.substring("word", 1, 3), F.substring("word", 4, 9))).where("word_idx = 0").orderBy("piece_idx").collect()
    assert [(r.piece, r.start_ms, r.end_ms) for r in two] == [("abc", 0.0, 300.0), ("d", 300.0, 400.0)]


def test_training(spark):
    assert training.steps_per_epoch(10, 4) == 3 and training.resume_batch(7, 4, 10) == 8
    with pytest.raises(ValueError):
        training.steps_per_epoch(0, 1)
    df = spark.createDataFrame([(0, 1.0, 1), (15, float("nan"), 2), (30, 3.0, 0)], "step int, loss double, label int")
    r = df.select(F.collect_list(training.hint_only_share(F.col("step"), 10, 20)).alias("s"), training.mean_without_nan(F.col("loss")).alias("m"), training.masked_mean(F.col("loss"), F.col("label"), 0).alias("k")).first()
    assert r.s == [1.0, 0.5, 0.0] and r.m == 2.0


def test_byte_pieces_are_merged():
    m = tokenize.merged_pieces
    assert m(["▁a", "<0xF0>", "<0x9F>", "<0x99>", "<0x82>", "b"]) == ["▁a", "🙂", "b"] and m([]) == []
    assert m(["<0xC3>", "x", "<0x41>"]) == ["<0xC3>", "x", "A"]


@pytest.mark.skipif(not Path("/opt/tokenizers/piece_bpe_32k.model").exists(), reason="no vocabulary file")
def test_pieces_by_model(spark):
    df = spark.createDataFrame([("hello 🙂 𒀀 there",), (None,), ("",)], "t string")
    got = [r.p for r in df.select(tokenize.token_pieces(F.col("t"), "/opt/tokenizers/piece_bpe_32k.model").alias("p")).collect()]
    assert "".join(got[0]).replace("▁", " ").strip() == "hello 🙂 𒀀 there" and got[1] is None and not got[2]
