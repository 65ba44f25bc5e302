"""Prediction events on a fixed time grid, derived from word-aligned dialogues."""

from __future__ import annotations

from bisect import insort
from collections.abc import Callable
from itertools import chain

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkloom.operators.blocks import Carry, carry, neighbour, numbered, running
from talkloom.operators.speech import LIST_BLOCK
from talkloom.session import checkpointed

#: Words of a chunk, and words before and after it (in the order of their ends) that a chunk sees.
CHUNK, HALO = 2000, 400
#: A speaker who pauses this long, from end to end of words, has ended the utterance.
BREAK_MS = 1000
#: A word whose place in the list and place in the order of ends differ by more than this is looked at in every tick between.
DISORDER = 64
#: Lines of context that an event keeps.
CONTEXT_LINES = 10
RECENT = 5
#: The hint is kept above this ratio.
HINT_ABOVE = 0.5

_OUT = (
    "dialogue_id string, chunk bigint, timestamp_ms bigint, conversation_context string, prediction string, total_word_count int, "
    "trigger_word string, recent_words string, current_spoken_ratio double, channel int, hint string, stop boolean"
)

Predict = Callable[[dict], str]


def fallback(request: dict) -> str:
    """Without a model: the hint, in the second half of a turn."""
    return request["hint"] if request["ratio"] > HINT_ABOVE else ""


def verbatim(request: dict) -> str:
    return request["hint"]


def _chunk(step_ms: int, predict: Predict, channel: int | None, chunk: int, lines: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rank")
        dialogue, number = pdf["dialogue_id"].iloc[0], int(pdf["chunk"].iloc[0])
        by_end = list(zip(pdf["rank"].astype(int), pdf["end_ms"].astype(int), pdf["word_idx"].astype(int)))
        listed = pdf.sort_values("word_idx")
        idx, sp = listed["word_idx"].astype(int).tolist(), listed["speaker"].tolist()
        text, end = listed["word"].tolist(), listed["end_ms"].astype(int).tolist()
        place = {i: p for p, i in enumerate(idx)}
        more = listed["ahead"].astype(int).tolist()
        astray = [p for p, (r, n) in enumerate(zip(listed["rank"], listed["list_rank"])) if abs(r - n) > DISORDER]
        strays = set(astray)
        own = [(r, e) for r, e, _ in by_end if (r - 1) // chunk == number]
        if not own:
            return pd.DataFrame(columns=_COLS)
        later = [e for r, e, _ in by_end if r == own[-1][0] + 1]
        t = -(-own[0][1] // step_ms) * step_ms
        until = later[0] if later else own[-1][1]
        t = max(t, step_ms)
        rows, sofar, k = [], [], 0
        while t < until:
            while k < len(by_end) and by_end[k][1] <= t:
                insort(sofar, place[by_end[k][2]])
                k += 1
            total = by_end[k - 1][0] if k else 0
            if total < 2:
                t += step_ms
                continue
            at = sofar[-1]
            me = sp[at]
            ch = 1 if me == "A" else 0
            if channel is not None and ch != channel:
                t += step_ms
                continue
            hint = []
            near = 0 if at in strays else max(0, at - 2 * DISORDER)
            for p in chain((p for p in astray if p < near), range(near, len(idx))):
                if sp[p] == me:
                    if hint and end[p] > end[at]:
                        break
                elif end[p] > end[at]:
                    hint.append(text[p])
            hint_text = " ".join(hint)
            if not hint_text:
                rows.append((dialogue, number, t, None, None, total, None, None, None, ch, None, True))
                break
            run_ = 0
            while run_ < len(sofar) and sp[sofar[-1 - run_]] == me:
                run_ += 1
            ratio = run_ / (run_ + more[at])
            said: list[list[str]] = []
            whose = None
            for q in reversed(sofar):
                if sp[q] != whose:
                    if len(said) == lines:
                        break
                    whose = sp[q]
                    said.append([whose + ":"])
                said[-1].append(text[q])
            context = "\n".join(" ".join([x[0], *reversed(x[1:])]) for x in reversed(said))
            recent = " ".join(text[q] for q in sofar[-RECENT:])
            line = predict({"context": context, "hint": hint_text, "ratio": ratio, "speaker": me, "channel": ch}).strip()
            if line:
                rows.append((dialogue, number, t, context, line, total, text[at], recent, ratio, ch, hint_text if ratio > HINT_ABOVE else "", False))
            t += step_ms
        return pd.DataFrame(rows, columns=_COLS)

    return run


_COLS = [c.split()[0] for c in _OUT.split(", ")]


def _with_ahead(w: DataFrame) -> DataFrame:
    """Adds ``ahead``: how many words of the same speaker follow in the list without a break."""
    w = neighbour(w, ["dialogue_id"], "block", ["word_idx"], ["speaker", "end_ms"], after=True, prefix="next_")
    goes_on = F.coalesce((F.col("next_speaker") == F.col("speaker")) & (F.col("next_end_ms") - F.col("end_ms") < BREAK_MS), F.lit(False))
    w = w.withColumn("__stop", F.when(~goes_on, F.col("list_rank"))).withColumn("__block", -F.col("block")).withColumn("__from", -F.col("list_rank"))
    w = running(w, ["dialogue_id"], "__block", ["__from"], "min", "__stop", "__last")
    return w.withColumn("ahead", F.col("__last") - F.col("list_rank")).drop("next_speaker", "next_end_ms", "__stop", "__block", "__from", "__last")


def _fold(chunk: int, halo: int, lines: int):
    """From the chunks of a dialogue, the ranges of list places and of ranks that a chunk must see beyond its halo."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("chunk")
        dialogue, cs = pdf["dialogue_id"].iloc[0], list(pdf.itertuples(index=False))
        n = int(pdf["n"].sum())
        last = {x: max([0, *(int(v) for v in pdf[f"last_{x}"] if v == v and v is not None)]) for x in "AB"}
        # Words before a chunk have ended in all of its ticks, words after it in none. Leaving words out of a list
        # never adds a line to it, so what the edges of runs show as separate lines are at least as many.
        until, tail = {}, []
        for c in reversed(cs):
            until[c.chunk] = tail[2][0] if len(tail) == 3 else n
            tail = _runs(sorted([*tail, *((int(x["place"]), x["speaker"]) for x in c.starts)]))[:3]
        rows, head, at = [], [], None
        for c in cs:
            low, high, number = int(c.chunk) * chunk + 1 - halo, (int(c.chunk) + 1) * chunk + halo, int(c.chunk)
            first = head[-1 - lines][0] if len(head) > lines else 1
            since = min(at[1], number * chunk) if at else number * chunk
            who = {x["speaker"] for x in c.starts} | ({at[2]} if at else set())
            over = len(who) == 1 and last["B" if who == {"A"} else "A"] <= since - 1
            if not over:  # else nobody else speaks after any of its words, and all of its ticks stop
                rows += [(dialogue, number, by, a, b) for by, a, b in (("list_rank", first, low - 1), ("list_rank", high + 1, until[c.chunk]), ("rank", since, low - 1)) if a <= b]
            head = _runs(sorted([*head, *((int(x["place"]), x["speaker"]) for x in c.ends)]), True)[-1 - lines :]
            own = (int(c.at["place"]), int(c.at["rank"]), c.at["speaker"])
            at = max(at, own) if at else own
        return pd.DataFrame(rows, columns=["dialogue_id", "chunk", "by", "low", "high"])

    return run


def _runs(places: list[tuple[int, str]], ends: bool = False) -> list[tuple[int, str]]:
    """The first (or last) place of each run of one speaker."""
    out: list[tuple[int, str]] = []
    for x in places:
        if not out or out[-1][1] != x[1]:
            out.append(x)
        elif ends:
            out[-1] = x
    return out


def _wider(w: DataFrame, chunk: int, halo: int, lines: int) -> DataFrame:
    """Words that a chunk needs although they are not in its halo, as (columns of ``w``, chunk)."""
    own = w.withColumn("chunk", F.floor((F.col("rank") - 1) / chunk))
    by = Window.partitionBy("dialogue_id", "chunk").orderBy("list_rank")
    spot = F.struct(F.col("list_rank").alias("place"), "speaker")
    own = own.withColumn("__s", F.coalesce(F.lag("speaker").over(by) != F.col("speaker"), F.lit(True))).withColumn("__e", F.coalesce(F.lead("speaker").over(by) != F.col("speaker"), F.lit(True)))
    sums = own.groupBy("dialogue_id", "chunk").agg(
        F.count(F.lit(1)).alias("n"), F.slice(F.sort_array(F.collect_list(F.when(F.col("__s"), spot))), 1, 3).alias("starts"), F.slice(F.sort_array(F.collect_list(F.when(F.col("__e"), spot)), False), 1, lines + 1).alias("ends"),
        F.max(F.struct(F.col("list_rank").alias("place"), "rank", "speaker")).alias("at"), *[F.max(F.when(F.col("speaker") == x, F.col("rank"))).alias(f"last_{x}") for x in "AB"],
    )
    ranges = sums.groupBy("dialogue_id").applyInPandas(_fold(chunk, halo, lines), "dialogue_id string, chunk bigint, by string, low bigint, high bigint")
    part = lambda c: F.floor((F.col(c) - 1) / chunk)
    ranges = checkpointed(ranges.select(F.col("dialogue_id").alias("__d"), "chunk", "by", "low", "high", F.explode(F.sequence(part("low"), part("high"))).alias("__p")))
    out = None
    for c in ("list_rank", "rank"):
        r = ranges.where(F.col("by") == c)
        on = F.col("dialogue_id").eqNullSafe(F.col("__d")) & (part(c) == F.col("__p")) & F.col(c).between(F.col("low"), F.col("high"))
        one = w.join(r, on).where(~F.array_contains("chunks", F.col("chunk"))).select(*w.columns, "chunk")
        out = one if out is None else out.unionByName(one)
    return out.dropDuplicates(["dialogue_id", "word_idx", "chunk"])


def events(words: DataFrame, step_ms: int = 500, predict: Predict = fallback, channel: int | None = None, lines: int = CONTEXT_LINES, chunk: int = CHUNK, halo: int = HALO) -> DataFrame:
    """Prediction events of dialogues (words: dialogue_id, word_idx, speaker, word, start_ms, end_ms).

    At every tick of ``step_ms`` before the last word's end, the words that have ended, in list order, form the
    conversation so far; its last word's speaker is speaking and the other one is predicted. There is no event
    with fewer than two words, or if ``channel`` is given and the predicted speaker's is another (A 0, B 1); the
    first tick without a further line of the other speaker ends the dialogue's events; an empty prediction
    drops its event. ``predict`` gets context, hint, ratio, speaker and channel.

    A dialogue of any length is cut into chunks of words in the order of their ends; a chunk sees ``halo`` words
    more on either side, every word that lies astray between its place in the list and that in the order of
    ends, and, where utterances or lines are longer than that, all words back to the last ``lines`` lines and on to
    the end of the other speaker's next utterance. Results don't depend on ``chunk`` and ``halo``. Null speakers or
    speakers other than A and B raise an error when run. An empty table gives no events.
    """
    bad = F.coalesce(~F.col("speaker").isin("A", "B"), F.lit(True))
    w = words.withColumn("speaker", F.when(bad, F.raise_error(F.concat(F.lit("unexpected speaker in "), F.coalesce("dialogue_id", F.lit("?"))))).otherwise(F.col("speaker")))
    w = w.withColumn("block", F.floor(F.col("end_ms") / 600_000))
    w = numbered(w, ["dialogue_id"], "block", ["end_ms", "word_idx"], "rank")
    w = numbered(w.withColumn("block", F.floor(F.col("word_idx") / LIST_BLOCK)), ["dialogue_id"], "block", ["word_idx"], "list_rank")
    low, high = F.least("rank", "list_rank"), F.greatest("rank", "list_rank")
    w = _with_ahead(w)
    chunks = F.sequence(F.greatest(F.floor((low - 1 - halo) / chunk), F.lit(0)), F.floor((high - 1 + halo) / chunk))
    w = checkpointed(w.select("dialogue_id", "word_idx", "speaker", "word", "end_ms", "rank", "list_rank", "ahead", chunks.alias("chunks")))
    w = w.select("*", F.explode("chunks").alias("chunk")).unionByName(_wider(w, chunk, halo, max(lines, 1))).drop("chunks")
    e = w.groupBy("dialogue_id", "chunk").applyInPandas(_chunk(step_ms, predict, channel, chunk, lines), _OUT)
    # The first chunk that stops ends the dialogue: later chunks are dropped.
    stops = e.groupBy("dialogue_id", "chunk").agg(F.max(F.when(F.col("stop"), 1)).alias("__s"))
    stops = carry(stops, ["dialogue_id"], "chunk", [Carry("__stopped", "max", "__s")]).where("__stopped is null").select(F.col("dialogue_id").alias("__d"), F.col("chunk").alias("__c"))
    return e.where("not stop").join(stops, F.col("dialogue_id").eqNullSafe(F.col("__d")) & (F.col("chunk") == F.col("__c")), "left_semi").drop("stop", "chunk")


def line_words(text: Column) -> Column:
    return F.filter(F.split(text, r"\s+"), lambda x: x != "")


def on_frames(e: DataFrame, n_frames: int | None = None) -> DataFrame:
    """Events on the frame grid: frame, whether they end a run of their channel, and the tokens of prediction and hint.

    A token is a word here; a tokenizer's ids can take its place. The end of a run is found before any event is
    dropped; events without tokens of a prediction, or outside the frames, are dropped.
    """
    e = e.withColumn("block", F.floor(F.col("event_idx") / LIST_BLOCK))
    e = neighbour(e, ["dialogue_id"], "block", ["event_idx"], ["channel"], after=True, prefix="next_")
    frame = F.expr("cast(timestamp_ms / 1000D * 12.5D as int)")
    out = e.select(
        "dialogue_id", "event_idx", "channel", frame.alias("frame"), F.coalesce(F.nanvl("current_spoken_ratio", F.lit(0.0)), F.lit(0.0)).alias("ratio"),
        F.coalesce(F.col("next_channel") != F.col("channel"), F.lit(True)).alias("skip_forbid"),
        line_words(F.coalesce("prediction", F.lit(""))).alias("pred"), line_words(F.coalesce("hint", F.lit(""))).alias("hint"),
    )
    out = out.where((F.size("pred") > 0) & (F.col("frame") >= 0))
    return out.where(F.col("frame") < n_frames) if n_frames else out
