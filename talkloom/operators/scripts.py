"""Turns of scripts: validation, repairs and placement, on one row per turn and scripts of any length.

What a turn must know of turns before it comes from scans over blocks of turns: the floor is the last turn
that isn't a backchannel; the calming of emotions is a running maximum; placement in time is a product of
max-plus matrices, of which each block has one.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkloom.functions import arrays
from talkloom.functions.numbers import spoken_numbers
from talkloom.functions.text import letters_only, n_words, plain_words
from talkloom.operators.blocks import Scan, join_blocks, scan

# The emotions, and other words for them.
EMOTIONS = "neutral irritated angry anxious distressed sad sulking embarrassed relieved grateful".split()
SYNONYMS = {
    "frustrated": "irritated", "annoyed": "irritated", "impatient": "irritated", "upset": "distressed", "furious": "angry", "mad": "angry", "livid": "angry",
    "scared": "anxious", "nervous": "anxious", "worried": "anxious", "afraid": "anxious", "tearful": "sad", "grieving": "sad", "ashamed": "embarrassed",
    "sheepish": "embarrassed", "thankful": "grateful", "calm": "neutral",
}
#: A turn that is broken off ends so.
BROKEN = r"(?:[.]{3}|…|-)\s*$"
#: Turns of a script that are worked on together.
BLOCK = 1000


def _floor(turns: DataFrame, cols: list[str]) -> DataFrame:
    """Adds ``__block`` and ``__floor``: a struct of ``cols`` of the last turn before that isn't a backchannel; null without one."""
    holds = F.when(~F.coalesce("backchannel", F.lit(False)), F.struct(*cols))
    rows = turns.withColumn("__block", F.floor(F.col("turn_no") / BLOCK)).withColumn("__holds", holds)
    return scan(rows, ["script_id"], "__block", ["turn_no"], [Scan("__floor", "last", "__holds", own=False)]).drop("__holds")


def turn_errors(turns: DataFrame) -> DataFrame:
    """Errors (script_id, turn_no, error) of turns (script_id, turn_no, speaker, text, emotion, intensity, backchannel, interrupts).

    The floor is with the last speaker before who didn't just say a backchannel. A turn of no valid speaker has
    that error only and leaves the floor. Scripts of any length: the floor is carried over blocks of turns.
    """
    bc, it = F.coalesce("backchannel", F.lit(False)), F.coalesce("interrupts", F.lit(False))
    known = F.coalesce(F.col("speaker").isin("passenger", "crew"), F.lit(False))
    rows = turns.withColumn("__block", F.floor(F.col("turn_no") / BLOCK)).withColumn("__takes", F.when(known & ~bc, F.col("speaker")))
    rows = scan(rows, ["script_id"], "__block", ["turn_no"], [Scan("__floor", "last", "__takes", own=False)])
    text = F.trim(F.coalesce("text", F.lit("")))
    person = F.col("speaker") == "passenger"
    errors = F.array(
        F.when(text == "", "empty text"),
        F.when(text.rlike("[0-9]"), "digits in text"),
        F.when(text.rlike(r"[\[\]()*]"), "brackets in text"),
        F.when(bc & it, "both backchannel and interrupt"),
        F.when((F.col("turn_no") == 0) & (bc | it), "begins with backchannel or interrupt"),
        F.when((bc | it) & (F.col("speaker") == F.col("__floor")), "backchannel or interrupt by the floor"),
        F.when(person & ~F.coalesce(F.col("emotion").isin(*EMOTIONS), F.lit(False)), "unknown emotion"),
        F.when(person & ~F.coalesce(F.col("intensity").between(0, 3), F.lit(False)), "intensity not 0 to 3"),
    )
    errors = F.when(known, F.array_compact(errors)).otherwise(F.array(F.lit("bad speaker")))
    per = rows.select("script_id", "turn_no", F.explode(errors).alias("error"))
    few = turns.groupBy("script_id").agg(F.count(F.lit(1)).alias("n")).where("n < 4").select("script_id", F.lit(-1).cast(turns.schema["turn_no"].dataType).alias("turn_no"), F.lit("fewer than 4 turns").alias("error"))
    return per.unionByName(few)


def clip_problem(text: Column, n_aligned: Column, seconds: Column, score: Column, backchannel: Column) -> Column:
    """The first thing wrong with a rendered turn, or null: no words, words missing, too long, low score."""
    n = n_words(text)
    return (
        F.when(n == 0, "no words").when(n_aligned < 0.9 * n, "words missing").when(seconds > 1.2 + n, "too long").when(backchannel, None).when(F.coalesce(score, F.lit(0.0)) < 0.35, "low score")
    )


def overlaps_fixed(turns: DataFrame) -> DataFrame:
    """Turns (script_id, turn_no, speaker, text, gap_s, backchannel, at, interrupts, ...) whose overlaps are possible.

    A backchannel needs a floor of the other speaker with at least eight words, else it is dropped; its ``at``
    is kept if these words stand in the floor's text. An interrupt needs a floor of the other speaker that is
    broken off after at least six words, else it becomes a quick reply. Backchannels never hold the floor, so
    dropping one changes no other turn. Null flags are false; further columns stay; an empty table gives no rows.
    """
    rows = _floor(turns, ["speaker", "text"])
    said = F.coalesce("__floor.text", F.lit(""))
    n = F.size(plain_words(said))
    other = F.col("__floor").isNotNull() & ~F.col("__floor.speaker").eqNullSafe(F.col("speaker"))
    bc, cuts = F.coalesce("backchannel", F.lit(False)), F.coalesce("interrupts", F.lit(False))
    lost = cuts & ~bc & ~(other & said.rlike(BROKEN) & (n >= 6))
    found = F.contains(F.array_join(plain_words(said), " "), F.array_join(plain_words(F.col("at")), " "))
    return rows.where(~bc | (other & (n >= 8))).withColumns({
        "at": F.when(~bc | found, F.col("at")), "interrupts": F.when(~lost, F.col("interrupts")), "gap_s": F.when(lost, 0.1).otherwise(F.col("gap_s")),
    }).select(*turns.columns)


def _emotion(name: Column) -> Column:
    """The usual name of an emotion; others in lower case without blanks around."""
    low = F.lower(F.trim(name))
    names = F.create_map(*[F.lit(x) for kv in sorted(SYNONYMS.items()) for x in kv])
    return F.coalesce(F.try_element_at(names, low), low)


def repaired(turns: DataFrame, emotion: str = "neutral", intensity: int = 0) -> DataFrame:
    """Turns (script_id, turn_no, speaker, text, emotion, intensity, backchannel, ...) with what a model gets wrong mended.

    Digits are put in words. The passenger's emotions get their usual names, missing ones that of the passenger's turn
    before (at first ``emotion``); the intensity is 0 to 3, missing ones that of the turn before, and of a known
    emotion at most one step below it. Backchannels take the state but don't change it.

    With x the intensity of a turn and c the number of turns so far that have one, the calmed intensity is the
    running maximum of x + c, less c: every step down takes a turn. An unknown emotion begins anew.
    """
    bc, person = F.coalesce("backchannel", F.lit(False)), F.coalesce(F.col("speaker") == "passenger", F.lit(False))
    level = F.when(F.col("intensity").isNotNull(), F.greatest(F.lit(0), F.least(F.lit(3), F.col("intensity").cast("int"))))
    keeps = person & ~bc
    rows = turns.withColumns({"__block": F.floor(F.col("turn_no") / BLOCK), "__own": F.when(person, _emotion(F.col("emotion"))), "__x": F.when(person, level)})
    rows = rows.withColumn("__named", F.when(keeps, F.col("__own")))
    order = ["turn_no"]
    rows = scan(rows, ["script_id"], "__block", order, [Scan("__before", "last", "__named", own=False)])
    name = F.coalesce("__own", "__before", F.lit(emotion))
    known = name.isin(*EMOTIONS)
    has = keeps & F.col("__x").isNotNull()
    rows = rows.withColumns({"__name": name, "__step": F.when(has & known, 1).otherwise(0).cast("bigint"), "__reset": F.when(has & ~known, 1).otherwise(0).cast("bigint")})
    rows = scan(rows, ["script_id"], "__block", order, [Scan("__c", "sum", "__step"), Scan("__part", "sum", "__reset")])
    rows = rows.withColumn("__top", F.when(has, F.struct("__part", (F.col("__x") + F.col("__c")).alias("v"))))
    rows = scan(rows, ["script_id"], "__block", order, [Scan("__best", "max", "__top")])
    first = F.when(F.col("__part") == 0, intensity)
    calm = (F.greatest(F.when(F.col("__best.__part") == F.col("__part"), F.col("__best.v")), first) - F.col("__c")).cast("int")
    new = F.when(keeps, calm).otherwise(F.coalesce("__x", calm))
    return rows.withColumns({
        "text": F.when(F.col("text").rlike("[0-9]"), spoken_numbers(F.col("text"))).otherwise(F.col("text")),
        "emotion": F.when(person, F.col("__name")).otherwise(F.col("emotion")), "intensity": F.when(person, new).otherwise(F.col("intensity")),
    }).select(*turns.columns)


Pick = Callable[[float, float, str], Column]


def middle(low: float, high: float, what: str) -> Column:
    return F.lit((low + high) / 2)


def seeded(seed: int) -> Pick:
    """Choices by a hash of the turn: the same for every run, whatever the order of the work."""
    return lambda low, high, what: F.lit(low) + (high - low) * F.pmod(F.xxhash64("script_id", "turn_no", F.lit(what), F.lit(seed)), F.lit(1 << 20)) / float(1 << 20)


#: Time before the first turn, and between two turns of one speaker.
LEAD_IN_MS, APART_MS = 400, 50
#: Turns shorter than this can't be cut off.
CUT_FROM_MS = 1200
#: No way from one value to another, in max-plus.
NEVER = -(1 << 52)
#: What is known between two turns: the time 0, start and end of the floor, and when each of two speakers is free.
ZERO, START, END, FREE = 0, 1, 2, 3
STATE = 5


def _moved(state: list[int], kind: str, who: int, at: int, cut: int | None, dur: int, holds: bool) -> int:
    """Places a turn behind a state, which is changed; gives its start.

    ``kind`` names the value that ``at`` counts from; a cut counts from the floor's start. Only sums with fixed numbers and maxima
    are used, so states may be scaled and joined before or after.
    """
    base = state[{"open": ZERO, "in": START, "cut": START, "after": END}[kind]] + at
    if cut is not None:
        state[FREE + 1 - who] = state[START] + cut
    start = max(base, state[FREE + who] + APART_MS)
    state[FREE + who] = start + dur
    if holds:
        state[START], state[END] = start, start + dur
    return start


_STEP = ["kind", "who", "at_ms", "cut_ms", "dur_ms", "holds"]


def _steps(pdf: pd.DataFrame):
    cut = [None if c != c or c is None else int(c) for c in pdf["cut_ms"]]
    return zip(pdf["kind"], pdf["who"].astype(int), pdf["at_ms"].astype("int64"), cut, pdf["dur_ms"].astype("int64"), pdf["holds"].astype(bool))


def _block_matrix(pdf: pd.DataFrame) -> pd.DataFrame:
    """The matrix of a block of turns: from each value before the block, the way to each behind it."""
    states = [[0 if i == j else NEVER for i in range(STATE)] for j in range(STATE)]
    for step in _steps(pdf.sort_values("turn_no")):
        for s in states:
            _moved(s, *step)
            for i in range(STATE):
                s[i] = max(s[i], NEVER)
    return pd.DataFrame({"script_id": [pdf["script_id"].iloc[0]], "block": [pdf["block"].iloc[0]], "matrix": [[x for s in states for x in s]]})


def _block_states(pdf: pd.DataFrame) -> pd.DataFrame:
    """The state before each block of a script, from the blocks' matrices."""
    pdf = pdf.sort_values("block")
    state, out = [0, NEVER, NEVER, 0, 0], []
    for m in pdf["matrix"]:
        out.append(state)
        state = [max(NEVER, *(state[j] + int(m[j * STATE + i]) for j in range(STATE))) for i in range(STATE)]
    return pd.DataFrame({"script_id": pdf["script_id"], "block": pdf["block"], "state": out})


def _placed_block(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("turn_no")
    state = [int(x) for x in pdf["state"].iloc[0]]
    starts, cuts = [], []
    for kind, who, at, cut, dur, holds in _steps(pdf):
        cuts.append(None if cut is None else state[START] + cut)
        starts.append(_moved(state, kind, who, at, cut, dur, holds))
    return pd.DataFrame({"script_id": pdf["script_id"], "turn_no": pdf["turn_no"], "start_ms": starts, "cuts_at": pd.Series(cuts, dtype="Int64", index=pdf.index)})


def placed(turns: DataFrame, pick: Pick = middle) -> DataFrame:
    """(script_id, turn_no, start_ms, end_ms, cut) of turns (script_id, turn_no, speaker, text, dur, gap_s, backchannel, interrupts) on two channels.

    A backchannel lies in the floor's turn (with a column ``anchor_s``, a bit behind that time of the floor's turn), an
    interrupt cuts off the other speaker's floor if that is at least 1.2 s long, other turns follow the floor by
    their gap; nobody overlaps themselves. ``pick`` chooses inside a range, by default its middle. A turn without
    duration has none; passenger is one speaker, all others are the other one. Times are whole milliseconds.
    An empty table gives no rows.

    The state between turns is five numbers, and each turn a max-plus matrix on them: a block of turns is one
    matrix, the states before the blocks follow from these, and all blocks are placed at once.
    """
    whole = lambda c: F.round(c).cast("bigint")
    ms = lambda c: whole(F.nanvl(F.col(c), F.lit(None).cast("double")) * 1000)
    at_ms = lambda low, high, what: pick(low, high, what) * 1000
    anchor = ms("anchor_s") if "anchor_s" in turns.columns else F.lit(None).cast("bigint")
    t = turns.select(
        "script_id", "turn_no", F.when(F.col("speaker") == "passenger", 0).otherwise(1).alias("who"), F.coalesce("text", F.lit("")).rlike(BROKEN).alias("broken"), F.coalesce(ms("dur"), F.lit(0)).alias("dur_ms"), ms("gap_s").alias("gap"),
        F.coalesce("backchannel", F.lit(False)).alias("backchannel"), F.coalesce("interrupts", F.lit(False)).alias("interrupts"), anchor.alias("anchor"),
    )
    t = _floor(t, ["turn_no", "who", "dur_ms", "broken"])
    length, same = F.col("__floor.dur_ms"), F.col("__floor.who") == F.col("who")
    cuts = F.coalesce(F.col("interrupts") & ~F.col("backchannel") & ~same & (length >= CUT_FROM_MS), F.lit(False))
    kind = F.when(F.col("__floor").isNull(), "open").when(F.col("backchannel"), "in").when(cuts, "cut").otherwise("after")
    inside = F.coalesce(F.col("anchor") + at_ms(0.05, 0.25, "anchor"), length * pick(0.35, 0.75, "inside"))
    breaks = F.when(F.col("__floor.broken"), length - at_ms(0.15, 0.4, "broken")).otherwise(F.greatest(F.lit(600.0), length * pick(0.45, 0.8, "cut")))
    gap = F.coalesce("gap", at_ms(0.2, 0.8, "gap"))
    at = F.when(kind == "open", F.lit(LEAD_IN_MS)).when(kind == "in", inside).when(kind == "cut", breaks).otherwise(F.when(same, F.greatest(gap, F.lit(150.0))).otherwise(gap))
    until = F.least(length, breaks + F.when(F.col("__floor.broken"), at_ms(0.08, 0.2, "until")).otherwise(at_ms(0.25, 0.5, "until")))
    steps = t.select("script_id", "turn_no", F.col("__block").alias("block"), kind.alias("kind"), "who", whole(at).alias("at_ms"), F.when(kind == "cut", whole(until)).alias("cut_ms"), "dur_ms", (~F.col("backchannel")).alias("holds"), F.col("__floor.turn_no").alias("floor_no"))
    key = "script_id string, block bigint"
    matrices = steps.groupBy("script_id", "block").applyInPandas(_block_matrix, f"{key}, matrix array<bigint>")
    states = matrices.groupBy("script_id").applyInPandas(_block_states, f"{key}, state array<bigint>")
    number = turns.schema["turn_no"].dataType.simpleString()
    found = join_blocks(steps, states, ["script_id"], "block").groupBy("script_id", "block").applyInPandas(_placed_block, f"script_id string, turn_no {number}, start_ms bigint, cuts_at bigint")
    both = steps.select("script_id", "turn_no", "block", "dur_ms", "floor_no").join(found.withColumnsRenamed({"script_id": "__s", "turn_no": "__t"}), F.col("script_id").eqNullSafe(F.col("__s")) & (F.col("turn_no") == F.col("__t")))
    # A floor that was cut off ends at the cut: the turn that cut it is the next one that holds the floor.
    cut = both.where("cuts_at is not null").select(F.col("script_id").alias("__cs"), F.col("floor_no").alias("__ct"), F.col("cuts_at").alias("__cut"))
    both = both.join(cut, F.col("script_id").eqNullSafe(F.col("__cs")) & (F.col("turn_no") == F.col("__ct")), "left")
    return both.select("script_id", "turn_no", "start_ms", F.coalesce("__cut", F.col("start_ms") + F.col("dur_ms")).alias("end_ms"), F.col("__cut").isNotNull().alias("cut"))


def anchors(turns: DataFrame, words: DataFrame) -> DataFrame:
    """(script_id, turn_no, anchor_s) of backchannels: where in the floor's turn they react.

    ``words`` has the words (script_id, turn_no, idx, word, start_s, end_s) of turns, with times inside the turn. A
    backchannel with ``at`` reacts at the end of the last place where the floor says these words; else, and
    without such a place, at the beginning of the longest pause between words (over 80 ms, its middle at 30 to 85 % of the turn; the first of equals). Without either the
    anchor is null. A turn is one row, so its words are held together.
    """
    t = _floor(turns.select("script_id", "turn_no", "speaker", "backchannel", "at"), ["turn_no"])
    bc = t.where(F.coalesce("backchannel", F.lit(False)) & F.col("__floor").isNotNull()).select("script_id", "turn_no", "at", F.col("__floor.turn_no").alias("__f"))
    one = F.struct("idx", letters_only(F.coalesce("word", F.lit(""))).alias("w"), F.col("start_s").alias("s"), F.col("end_s").alias("e"))
    lists = words.groupBy(F.col("script_id").alias("__s"), F.col("turn_no").alias("__t")).agg(F.array_sort(F.collect_list(one)).alias("ws"), (F.max("end_s")).alias("dur"))
    j = bc.join(lists, F.col("script_id").eqNullSafe(F.col("__s")) & (F.col("__f") == F.col("__t")), "left")
    want = F.filter(F.transform(F.split(F.coalesce("at", F.lit("")), r"\s+"), letters_only), lambda x: x != "")
    place = arrays.last_phrase(F.transform("ws", lambda x: x["w"]), want)
    phrase = F.get(F.col("ws"), place + F.size(want) - 1)["e"]
    n = F.size("ws")
    pauses = F.transform(F.sequence(F.lit(0), F.greatest(n - 2, F.lit(0))), lambda i: F.struct((F.get("ws", i + 1)["s"] - F.get("ws", i)["e"]).alias("gap"), (-i).alias("i"), F.get("ws", i)["e"].alias("e"), ((F.get("ws", i + 1)["s"] + F.get("ws", i)["e"]) / 2).alias("mid")))
    best = F.array_max(F.filter(pauses, lambda p: (p["gap"] > 0.08) & (p["mid"] >= 0.30 * F.col("dur")) & (p["mid"] <= 0.85 * F.col("dur"))))
    return j.select("script_id", "turn_no", F.coalesce(phrase, best["e"]).alias("anchor_s"))


def spoken_words(words: DataFrame, places: DataFrame) -> DataFrame:
    """Words (script_id, turn_no, idx, speaker, word, start_ms, end_ms) at absolute times; those that end behind the cut of their turn are left out.

    ``words`` has times inside the turn (start_s, end_s), ``places`` is what ``placed`` gives.
    """
    p = places.select(F.col("script_id").alias("__s"), F.col("turn_no").alias("__t"), "start_ms", "end_ms", "cut")
    at = lambda c: F.col("start_ms") + F.round(F.col(c) * 1000).cast("bigint")
    j = words.join(p, F.col("script_id").eqNullSafe(F.col("__s")) & (F.col("turn_no") == F.col("__t")))
    j = j.where(~F.col("cut") | (at("end_s") <= F.col("end_ms")))
    return j.select("script_id", "turn_no", "idx", "speaker", "word", at("start_s").alias("start_ms"), at("end_s").alias("end_ms"))


def calm(emotion: Column, intensity: Column) -> Column:
    """Whether a turn is calm: neutral or without emotion, or without intensity."""
    return emotion.isNull() | (emotion == "neutral") | (F.coalesce(intensity, F.lit(0)) == 0)


def unlabelled(turns: DataFrame) -> DataFrame:
    """Turns without the labels (emotion, intensity, trigger) that only the passenger's turns may have."""
    crew = F.coalesce(F.col("speaker") == "crew", F.lit(False))
    return turns.withColumns({c: F.when(~crew, F.col(c)) for c in ("emotion", "intensity", "trigger") if c in turns.columns})


def emotion_changes(turns: DataFrame) -> DataFrame:
    """(script_id, turn_no) of the passenger's turns whose emotion or intensity is another than in the passenger's turn before, although no trigger is given."""
    rows = turns.where(F.col("speaker") == "passenger").withColumn("__block", F.floor(F.col("turn_no") / BLOCK)).withColumn("__now", F.struct("emotion", "intensity"))
    rows = scan(rows, ["script_id"], "__block", ["turn_no"], [Scan("__was", "last", "__now", own=False)])
    blank = F.trim(F.coalesce("trigger", F.lit(""))) == ""
    changed = ~F.col("__was.emotion").eqNullSafe(F.col("emotion")) | ~F.col("__was.intensity").eqNullSafe(F.col("intensity"))
    return rows.where(F.col("__was").isNotNull() & changed & blank).select("script_id", "turn_no")
