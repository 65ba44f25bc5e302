"""Overlap, turns, pauses and frame placement of word-aligned speech."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkloom.operators.blocks import neighbour, numbered, running
from talkloom.operators.intervals import BLOCK_MS, periods, to_ms, usable
from talkloom.session import checkpointed

#: Frames a second, and the length of a frame in seconds.
FRAME_RATE, FRAME_S = 12.5, 0.08
#: Speech of one speaker with pauses up to this is one stretch.
MERGE_MS = 300
#: Above these a dialogue counts as crosstalk: speaker switches per 100 words, and the share of speech that overlaps.
MOST_SWITCHES, MOST_OVERLAP = 25.0, 0.20
#: Positions of a list that are worked on together.
LIST_BLOCK = 5000


def clean_words(words: DataFrame) -> DataFrame:
    """Usable words once per (dialogue_id, word_idx), in the latest delivery: speaker, word, start_ms, end_ms."""
    w = words.where(F.col("speaker").isin("A", "B") & usable(F.col("start"), F.col("end")))
    v = F.max(F.struct("loaded_at", to_ms(F.col("start")).alias("start_ms"), to_ms(F.col("end")).alias("end_ms"), "speaker", F.coalesce("word", F.lit("")).alias("word"))).alias("v")
    return w.groupBy("dialogue_id", "word_idx").agg(v).select("dialogue_id", "word_idx", "v.speaker", "v.word", "v.start_ms", "v.end_ms")


def switches(w: DataFrame) -> DataFrame:
    """(dialogue_id, n_words, n_switches): changes of speaker in the order of start, speaker, list position."""
    rows = w.withColumn("block", F.floor(F.col("start_ms") / BLOCK_MS))
    rows = neighbour(rows, ["dialogue_id"], "block", ["start_ms", "speaker", "word_idx"], ["speaker"])
    return rows.groupBy("dialogue_id").agg(F.count(F.lit(1)).alias("n_words"), F.count_if(F.col("prev_speaker") != F.col("speaker")).alias("n_switches"))


def stretches(w: DataFrame) -> DataFrame:
    """Stretches of speech of each speaker, pauses up to 300 ms bridged."""
    return periods(w, ["dialogue_id", "speaker"], max_gap_ms=MERGE_MS)


def overlap_report(w: DataFrame) -> DataFrame:
    """Per dialogue: switches per 100 words, milliseconds of A, B and both at once, and whether it is crosstalk.

    Stretches of one speaker don't overlap, so the time of both at once is what the two sums have more than
    their union; no join of stretches with stretches is needed.
    """
    s = checkpointed(stretches(w))
    n = F.col("period_end_ms") - F.col("period_start_ms")
    own = s.groupBy("dialogue_id").agg(*[F.coalesce(F.sum(F.when(F.col("speaker") == x, n)), F.lit(0)).alias(f"{x.lower()}_ms") for x in "AB"])
    union = periods(s.select("dialogue_id", F.col("period_start_ms").alias("start_ms"), F.col("period_end_ms").alias("end_ms")), ["dialogue_id"])
    union = union.groupBy("dialogue_id").agg(F.sum(n).alias("union_ms"))
    r = switches(w).join(own, "dialogue_id").join(union, "dialogue_id")
    both = F.col("a_ms") + F.col("b_ms") - F.col("union_ms")
    return r.select("dialogue_id", "n_words", "n_switches", "a_ms", "b_ms", both.alias("both_ms"), crosstalk(F.col("n_switches"), F.col("n_words"), both, F.col("union_ms")).alias("flag"))


def crosstalk(n_switches: Column, n_words: Column, both: Column, union: Column) -> Column:
    return (n_switches * 100 > n_words * MOST_SWITCHES) | (both > union * MOST_OVERLAP)


def turns(w: DataFrame) -> DataFrame:
    """Runs of one speaker in list order: (dialogue_id, turn_no, speaker, first_idx, n_words, start_ms, end_ms)."""
    return turns_of(in_turns(w))


def turns_of(numbered_words: DataFrame) -> DataFrame:
    """``turns`` of words that have the number of their turn already."""
    t = numbered_words.groupBy("dialogue_id", "turn_no", "speaker", "block").agg(F.min("word_idx").alias("i"), F.count(F.lit(1)).alias("n"), F.min("start_ms").alias("s"), F.max("end_ms").alias("e"))
    return t.groupBy("dialogue_id", "turn_no", "speaker").agg(F.min("i").alias("first_idx"), F.sum("n").alias("n_words"), F.min("s").alias("start_ms"), F.max("e").alias("end_ms"))


def in_turns(w: DataFrame) -> DataFrame:
    """Words with the number of their turn, from 0."""
    rows = w.withColumn("block", F.floor(F.col("word_idx") / LIST_BLOCK))
    rows = neighbour(rows, ["dialogue_id"], "block", ["word_idx"], ["speaker"])
    rows = rows.withColumn("__new", F.when(F.col("prev_speaker") != F.col("speaker"), 1).otherwise(0).cast("bigint")).drop("prev_speaker")
    return running(rows, ["dialogue_id"], "block", ["word_idx"], "sum", "__new", "turn_no").drop("__new")


def timeline(t: DataFrame) -> DataFrame:
    """Turns with the latest end so far and by how much they begin before it."""
    rows = t.withColumn("block", F.floor(F.col("turn_no") / LIST_BLOCK))
    rows = running(rows, ["dialogue_id"], "block", ["turn_no"], "max", "end_ms", "reach_ms", inclusive=False)
    return rows.drop("block").withColumn("early_ms", F.greatest(F.col("reach_ms") - F.col("start_ms"), F.lit(0)))


def pauses_in_turns(w: DataFrame) -> DataFrame:
    """Per turn with one, the end of the word before its longest pause (over 80 ms, its middle at 30 to 85 % of the turn; the first of equals)."""
    rows = neighbour(in_turns(w), ["dialogue_id"], "block", ["word_idx"], ["start_ms", "turn_no"], after=True, prefix="next_")
    t = turns(w).select("dialogue_id", "turn_no", F.col("start_ms").alias("ts"), F.col("end_ms").alias("te"))
    gap = F.col("next_start_ms") - F.col("end_ms")
    rows = rows.where((F.col("next_turn_no") == F.col("turn_no")) & (gap > 80)).join(t, ["dialogue_id", "turn_no"])
    place = (F.col("end_ms") + F.col("next_start_ms")) / 2 - F.col("ts")
    rows = rows.where((place >= 0.30 * (F.col("te") - F.col("ts"))) & (place <= 0.85 * (F.col("te") - F.col("ts"))))
    best = F.max(F.struct(gap.alias("gap"), (-F.col("word_idx")).alias("i"), F.col("end_ms"))).alias("b")
    return rows.groupBy("dialogue_id", "turn_no").agg(best).select("dialogue_id", "turn_no", F.col("b.end_ms").alias("pause_ms"), F.col("b.gap").alias("gap_ms"))


def frame_of(seconds: Column) -> Column:
    """Frame of a time, by the floor division of doubles (0.24 s is in frame 2, not 3)."""
    return F.round((seconds - seconds % F.lit(FRAME_S)) / F.lit(FRAME_S)).cast("bigint")


def placed(w: DataFrame, order: tuple[str, ...] = ("word_idx",)) -> DataFrame:
    """Words, or pieces of words, on the frame grid of their speaker: each in the first free frame at or after its own, in order of start.

    Columns dialogue_id, speaker, ``order``, frame, dropped (beyond the last frame, as the row is one second
    longer than the last word), end_pad (whether the frame before is free). Slots don't fall in this order, so
    the first free frame is rn + running max(slot - rn). ``order`` tells rows of one start apart.
    """
    keys, by = ["dialogue_id", "speaker"], ["start_ms", *order]
    rows = w.withColumn("slot", frame_of(F.col("start_ms") / 1000)).withColumn("block", F.floor(F.col("start_ms") / BLOCK_MS))
    rows = numbered(rows, keys, "block", by, "rn").withColumn("lead", F.col("slot") - F.col("rn"))
    rows = running(rows, keys, "block", by, "max", "lead", "m").withColumn("frame", F.col("rn") + F.col("m"))
    rows = neighbour(rows, keys, "block", by, ["frame"])
    last = w.groupBy(*keys).agg(F.max_by("end_ms", F.struct(*by)).alias("last_ms"))
    size = F.floor((F.col("last_ms") / 1000 + 1) * FRAME_RATE)
    free = (F.col("frame") > 0) & (F.coalesce("prev_frame", F.lit(-1)) < F.col("frame") - 1)
    return rows.join(last, keys).select(*keys, *order, "frame", (F.col("frame") >= size).alias("dropped"), free.alias("end_pad"))


def pieces(w: DataFrame, cut: Column | None = None) -> DataFrame:
    """Pieces of words with times: (dialogue_id, speaker, word_idx, piece_idx, piece, start_ms, end_ms).

    ``cut`` gives the pieces of ``word`` (an array of texts that make up the word; by default its characters, at
    least one). A piece starts and ends where its characters do, if the word's characters share its time evenly.
    """
    c = cut if cut is not None else F.when(F.length("word") > 0, F.split("word", "")).otherwise(F.array(F.lit("")))
    at = F.aggregate(F.slice("ps", 1, F.col("piece_idx")), F.lit(0), lambda a, x: a + F.length(x))
    n = F.greatest(F.length("word"), F.lit(1))
    x = w.withColumn("ps", c).select("*", F.posexplode("ps").alias("piece_idx", "piece")).withColumn("at", at)
    span = F.col("end_ms") - F.col("start_ms")
    return x.select(
        "dialogue_id", "speaker", "word_idx", "piece_idx", "piece",
        (F.col("start_ms") + span * F.col("at") / n).alias("start_ms"), (F.col("start_ms") + span * (F.col("at") + F.length("piece")) / n).alias("end_ms"),
    )
