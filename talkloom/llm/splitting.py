"""Cutting long dialogues into pieces of bounded length, at content-defined places where nobody speaks."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkloom.operators.blocks import Carry, Scan, carry, join_blocks, scan, tails
from talkloom.operators.intervals import BLOCK_MS, to_ms, usable
from talkloom.session import checkpointed

#: Longest piece, what it repeats of the piece before, and the least length that cuts aim at.
LIMIT_MS, OVERLAP_MS, LEAST_MS = 192_000, 5_000, 60_000
#: A silence is a pause of all speakers of more than this.
SILENCE_MS = 300
#: The rolling hash runs over so many words, and one of so many words is a landmark.
ROLL, EVERY = 5, 16
#: Between two strong cuts that are further apart than twice this, silences are gathered in cells of this length.
CELL_MS = 600_000

GAP = ["gap_start_ms", "gap_end_ms", "mid_ms"]


def speech_of(words: DataFrame) -> DataFrame:
    """Usable words (dialogue_id, word_idx, start_ms, end_ms, h), h being the hash of word and speaker."""
    ok = F.col("speaker").isin("A", "B") & usable(F.col("start"), F.col("end"))
    h = F.xxhash64(F.lower(F.col("word")), F.col("speaker"))
    return words.where(ok).select("dialogue_id", "word_idx", to_ms(F.col("start")).alias("start_ms"), to_ms(F.col("end")).alias("end_ms"), h.alias("h"))


def _spans(blocks: DataFrame, events: DataFrame) -> DataFrame:
    """(k, first_ms, last_word_ms, last_ms, first_event_ms) of every dialogue, from its blocks of words."""
    w = blocks.groupBy("k").agg(F.min("s").alias("first_ms"), F.max("e").alias("last_word_ms"))
    e = events.groupBy(F.struct("dialogue_id").alias("__k")).agg(F.max("timestamp_ms").alias("__t"), F.min("timestamp_ms").alias("first_event_ms"))
    return w.join(e, F.col("k") == F.col("__k"), "left").select("k", "first_ms", "last_word_ms", F.greatest("last_word_ms", "__t").alias("last_ms"), "first_event_ms")


def _marked(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    """Of the words (k, block, start_ms, end_ms, word_idx, h): those with a silence before them or a landmark at their end, as (k, at_ms, gap_start_ms, roll).

    ``blocks`` has the blocks (k, block, s, e) that count. The hash rolls over the word and the four before it, in
    the order of start, and the silence is what no word before reaches into; both look over the borders of blocks.
    """
    order = ["start_ms", "word_idx", "end_ms", "h"]
    w = Window.partitionBy("k", "block").orderBy(*order)
    reach = carry(blocks.select("k", "block", "e"), ["k"], "block", [Carry("before", "max", "e")]).drop("e")
    rows = join_blocks(rows, reach, ["k"], "block", "inner").withColumn("__last", F.lag(F.struct(*order)).over(w))
    rows = rows.where(F.col("__last").isNull() | (F.col("__last") != F.struct(*order))).drop("__last")  # delivered again
    far = tails(rows, ["k"], "block", order, "h", ROLL - 1, "tail")
    near = [F.lag("h", i).over(w).alias(f"h{i}") for i in range(1, ROLL)]
    quiet = F.greatest(F.max("end_ms").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.col("before"))
    rows = join_blocks(rows.select("*", *near, quiet.alias("reach"), F.row_number().over(w).alias("pos")), far, ["k"], "block")
    missing = lambda i: F.when(F.col("pos") <= i, F.try_element_at("tail", (F.col("pos") - i - 1).cast("int")))
    roll = F.xxhash64("h", *[F.coalesce(f"h{i}", missing(i)) for i in range(1, ROLL)])
    out = rows.select("k", "start_ms", "end_ms", F.when(F.col("start_ms") - F.col("reach") > SILENCE_MS, F.col("reach")).alias("gap_start_ms"), F.when(F.pmod(roll, F.lit(EVERY)) == 0, roll).alias("roll"))
    return out.where(F.col("gap_start_ms").isNotNull() | F.col("roll").isNotNull())


def snapped(marks: DataFrame, silences: DataFrame, block_ms: int = BLOCK_MS) -> DataFrame:
    """Silences (k, gap_start_ms, gap_end_ms, mid_ms) that are the nearest boundary of a landmark (k, at_ms, roll), with the least of their hashes as ``prio``."""
    gap = F.struct(*GAP)
    both = silences.select("k", F.col("mid_ms").alias("t"), gap.alias("gap"), F.lit(0).alias("m"), F.lit(None).cast("bigint").alias("roll")).unionByName(marks.select("k", F.col("at_ms").alias("t"), F.lit(1).alias("m"), "roll"), True)
    both = both.withColumn("block", F.floor(F.col("t") / block_ms))
    near = scan(both, ["k"], "block", ["t", "m", "roll"], [Scan("l", "last", "gap"), Scan("r", "last", "gap", after=True)]).where("m = 1")
    left = F.col("r").isNull() | (F.col("t") - F.col("l.gap_start_ms") <= F.col("r.gap_start_ms") - F.col("t"))
    near = near.withColumn("gap", F.coalesce(F.when(left, F.col("l")), F.col("r"))).where(F.col("gap").isNotNull())
    return near.groupBy("k", "gap").agg(F.min("roll").alias("prio")).select("k", "gap.*", "prio")


def strong_cuts(candidates: DataFrame, least_ms: int = LEAST_MS, block_ms: int = BLOCK_MS) -> DataFrame:
    """Of snapped silences, those with the least hash within ``least_ms`` before and after; of equal ones the first: (k, gap_start_ms, gap_end_ms, mid_ms).

    A strong cut depends on what is said around it only, neither on its time nor on where blocks end, so an edit
    of the text alters neighbouring pieces only, and no dialogue has to be walked through from its start.
    """
    rank = F.struct("prio", "mid_ms")
    b = lambda x: F.floor((F.col("mid_ms") + x) / block_ms)
    rows = candidates.withColumns({"rank": rank, "block": F.explode(F.sequence(b(-least_ms), b(least_ms)))}).withColumn("own", F.col("block") == b(0))
    w = Window.partitionBy("k", "block").orderBy("mid_ms").rangeBetween(-least_ms, least_ms)
    return rows.withColumn("best", F.min("rank").over(w)).where("own and rank = best").select("k", *GAP)


def inner_cuts(a: int, b: int, silences: list[tuple[int, int, bool]], most: int, least: int, open_ms: int | None = None, close_ms: int | None = None) -> list[tuple[int, str, int, int]]:
    """Cuts between a and b so that no part is longer than ``most``: (ms, 'natural' or 'forced', times, stretch).

    In the allowed range the last silence of a landmark is taken, else the last silence, else the last silence
    below the least length; without any, the cut is forced at the end of the range. Cuts in a row that are
    forced, or that lie in one long silence, are one entry: ``times`` cuts, each ``most`` after the one before. ``stretch`` is the
    length of the speech without silence that a forced cut lies in (``open_ms`` and ``close_ms``: where speech begins after a and
    ends before b), else 0.
    """
    silences = sorted(silences)
    cuts, last, k, since = [], a, 0, a if open_ms is None else open_ms
    while b - last > most:
        end = last + most
        while k < len(silences) and silences[k][1] <= last:
            since = max(since, silences[k][1])
            k += 1
        best, i, until = None, k, b if close_ms is None else close_ms
        while i < len(silences) and silences[i][0] < end:
            s, e, mark = silences[i]
            i += 1
            t = (s + e) // 2 if last < (s + e) // 2 <= end else end if e > end else e
            if last < t < b:
                best = max(best or (False, False, 0, 0), (t - last >= least and mark, t - last >= least, t, e))
        if best:
            t, until = best[2], best[3]
            times = 1 + max(0, (min(until, b) - 1 - t) // most) if t == end else 1
            cuts.append((t, "natural", times, 0))
        else:
            until = min(silences[i][0], until) if i < len(silences) else until
            times = 1 + max(0, (min(until, b) - 1 - end) // most)
            cuts.append((end, "forced", times, until - since))
        last = cuts[-1][0] + (times - 1) * most
    return cuts


def joined(rows: DataFrame, facts: DataFrame, keys: list[str], how: str) -> DataFrame:
    """``rows`` joined with ``facts`` by ``keys``; null keys match null keys."""
    right = facts.withColumnsRenamed({k: f"__k{j}" for j, k in enumerate(keys)})
    on = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"__k{j}")) for j, k in enumerate(keys)])
    return rows.join(right, on, how).drop(*[f"__k{j}" for j in range(len(keys))])




def _between(bounds: DataFrame, silences: DataFrame, most: int, least: int, block_ms: int, cell_ms: int = CELL_MS) -> DataFrame:
    """Cuts (k, at_ms, kind, times, stretch) inside the stretches between neighbouring ``bounds`` that are longer than ``most``.

    ``bounds`` has the starts and ends of dialogues and the strong cuts, as silences; ``silences`` has all, with ``mark`` where a
    landmark snapped to one. A stretch of more than two cells is cut further by the last silence of each cell, counted from its begin, so
    that no more than the silences of two cells are ever gathered.
    """
    gap = F.struct(*GAP, "kind")
    every = silences.withColumn("kind", F.lit(None).cast("string")).unionByName(bounds.withColumn("mark", F.lit(True))).withColumn("block", F.floor(F.col("mid_ms") / block_ms)).withColumn("at", F.when(F.col("kind").isNotNull(), gap))
    order = ["mid_ms", "gap_start_ms", "gap_end_ms", "kind"]
    every = scan(every, ["k"], "block", order, [Scan("a", "last", "at"), Scan("b", "last", "at", after=True, own=False)]).where(F.col("a").isNotNull() & F.col("b").isNotNull())
    length = F.col("b.mid_ms") - F.col("a.mid_ms")
    cell = F.when(length > 2 * cell_ms, F.floor((F.col("mid_ms") - F.col("a.mid_ms")) / cell_ms)).otherwise(0)
    inside = F.col("kind").isNull() & (F.col("mid_ms") > F.col("a.mid_ms")) & (F.col("mid_ms") < F.col("b.mid_ms"))
    entry = F.struct(F.col("gap_start_ms").alias("s"), F.col("gap_end_ms").alias("e"), F.col("mark").alias("m"))
    cells = every.where(length > most).groupBy("k", "a", "b", cell.alias("cell")).agg(F.collect_list(F.when(inside, entry)).alias("gs"), F.max(F.when(inside, F.struct("mid_ms", "gap_start_ms", "gap_end_ms"))).alias("cut"))
    w = Window.partitionBy("k", "a").orderBy("cell")
    none = F.count("cut").over(Window.partitionBy("k", "a")) == 0  # no silence at all: one cell stands for the stretch
    cells = cells.withColumn("none", none).where(F.col("cut").isNotNull() | (F.col("none") & (F.col("cell") == 0))).withColumns({"before": F.last("cut", True).over(w.rowsBetween(Window.unboundedPreceding, -1)), "more": F.lead("cell").over(w).isNotNull() & F.col("cut").isNotNull()})
    first, last = F.coalesce(F.col("before.mid_ms"), F.col("a.mid_ms")), F.when(F.col("more"), F.col("cut.mid_ms")).otherwise(F.col("b.mid_ms"))
    cells = cells.select("k", first.alias("x"), last.alias("y"), F.coalesce(F.col("before.gap_end_ms"), F.col("a.gap_end_ms")).alias("opens"), F.when(F.col("more"), F.col("cut.gap_start_ms")).otherwise(F.col("b.gap_start_ms")).alias("closes"), "gs", "more")

    @F.pandas_udf("array<struct<at_ms: bigint, kind: string, times: bigint, stretch: bigint>>")
    def cut(x: pd.Series, y: pd.Series, opens: pd.Series, closes: pd.Series, gs: pd.Series, more: pd.Series) -> pd.Series:
        out = []
        for a, b, o, c, g, m in zip(x, y, opens, closes, gs, more):
            got = inner_cuts(int(a), int(b), [(int(q["s"]), int(q["e"]), bool(q["m"])) for q in g], most, least, int(o), int(c))
            out.append([dict(zip(("at_ms", "kind", "times", "stretch"), q)) for q in [*got, *([(int(b), "natural", 1, 0)] if m else [])]])
        return pd.Series(out)

    return cells.select("k", F.explode(cut("x", "y", "opens", "closes", "gs", "more")).alias("c")).select("k", "c.*")


def cuts(words: DataFrame, events: DataFrame, limit_ms: int = LIMIT_MS, overlap_ms: int = OVERLAP_MS, least_ms: int = LEAST_MS, block_ms: int = BLOCK_MS) -> tuple[DataFrame, DataFrame]:
    """The spans (k, first_ms, last_word_ms, last_ms, first_event_ms) of all dialogues, and the cuts (k, at_ms, kind, times, stretch) of those over the limit.

    ``k`` is a struct of dialogue_id. An entry stands for ``times`` cuts, each ``limit_ms`` - ``overlap_ms`` after the one before. ``kind`` is natural
    or forced; ``stretch`` is the length of speech without silence around a forced cut, else 0. Cases as for ``split``.
    """
    most = limit_ms - overlap_ms
    block = F.floor(F.col("start_ms") / block_ms)
    rows = speech_of(words).select(F.struct("dialogue_id").alias("k"), block.alias("block"), "word_idx", "start_ms", "end_ms", "h").repartition("k", "block")
    blocks = checkpointed(rows.groupBy("k", "block").agg(F.min("start_ms").alias("s"), F.max("end_ms").alias("e"), F.max("word_idx").alias("__w"), F.max("h").alias("__h")).drop("__w", "__h"))
    span = checkpointed(_spans(blocks, events))
    long_ = span.where(F.col("last_ms") - F.col("first_ms") > limit_ms)
    # Only words of long dialogues go on; of these, only the silences and landmarks.
    wanted = blocks.join(long_.select(F.col("k").alias("__k")), F.col("k") == F.col("__k"), "left_semi")
    found = checkpointed(_marked(rows, wanted))
    tail = long_.where(F.col("last_ms") - F.col("last_word_ms") > SILENCE_MS).select("k", F.col("last_word_ms").alias("gap_start_ms"), F.col("last_ms").alias("gap_end_ms"))
    mid = F.floor((F.col("gap_start_ms") + F.col("gap_end_ms")) / 2)
    silences = found.where("gap_start_ms is not null").select("k", "gap_start_ms", F.col("start_ms").alias("gap_end_ms")).unionByName(tail).withColumn("mid_ms", mid)
    candidates = snapped(found.where("roll is not null").select("k", F.col("end_ms").alias("at_ms"), "roll"), silences, block_ms)
    silences = checkpointed(silences.join(candidates.select(F.col("k").alias("__k"), F.col("gap_start_ms").alias("__g"), "prio"), (F.col("k") == F.col("__k")) & (F.col("gap_start_ms") == F.col("__g")), "left").select("k", *GAP, "prio"))
    strong = strong_cuts(silences.where("prio is not null"), least_ms, block_ms)
    inside = long_.select(F.col("k").alias("__k"), "first_ms", "last_ms")
    strong = strong.join(inside, F.col("k") == F.col("__k")).where((F.col("mid_ms") >= F.col("first_ms") + least_ms) & (F.col("mid_ms") <= F.col("last_ms") - least_ms)).select("k", *GAP)
    ends = long_.select("k", F.explode(F.array(
        F.struct(F.col("first_ms").alias("gap_start_ms"), F.col("first_ms").alias("gap_end_ms"), F.col("first_ms").alias("mid_ms"), F.lit("start").alias("kind")),
        F.struct(F.col("last_word_ms").alias("gap_start_ms"), F.col("last_ms").alias("gap_end_ms"), F.col("last_ms").alias("mid_ms"), F.lit("end").alias("kind")),
    )).alias("x")).select("k", "x.*")
    strong = checkpointed(strong)
    inner = _between(ends.unionByName(strong.withColumn("kind", F.lit("natural"))), silences.select("k", *GAP, F.col("prio").isNotNull().alias("mark")), most, least_ms, block_ms)
    one = strong.select("k", F.col("mid_ms").alias("at_ms"), F.lit("natural").alias("kind"), F.lit(1).cast("bigint").alias("times"), F.lit(0).cast("bigint").alias("stretch"))
    return span, one.unionByName(inner)


def cut_kinds(found: DataFrame, limit_ms: int = LIMIT_MS) -> DataFrame:
    """(dialogue_id, cut_kind) of the dialogues that were cut: 'forced' if a cut had to be made in speech without silence that is itself over the limit, else 'natural'.

    Every such stretch has a cut in it, as pieces are no longer than the limit. A forced cut in a shorter
    stretch, which only the overlap makes too long, doesn't count.
    """
    forced = F.max(F.when((F.col("kind") == "forced") & (F.col("stretch") > limit_ms), 1).otherwise(0))
    return found.groupBy("k").agg(forced.alias("f")).select("k.dialogue_id", F.when(F.col("f") == 1, "forced").otherwise("natural").alias("cut_kind"))


def split(words: DataFrame, events: DataFrame, limit_ms: int = LIMIT_MS, overlap_ms: int = OVERLAP_MS, least_ms: int = LEAST_MS, block_ms: int = BLOCK_MS) -> DataFrame:
    """Pieces (dialogue_id, piece_no, from_ms, to_ms, end_kind, member_from_ms, member_to_ms).

    A dialogue whose span (first usable start to last usable end or event) exceeds ``limit_ms`` is cut; others
    are one piece. A piece ends in a silence ('natural'), where nothing else is possible in speech
    ('forced'), or with the dialogue ('end'), and begins ``overlap_ms`` before the end of the piece before;
    with that it is at most ``limit_ms`` long. Words and events belong to a piece if they start in
    [member_from_ms, member_to_ms). Rows without usable times, and events without time, are passed over; dialogues
    without usable words have no piece; a null dialogue_id is a dialogue; empty tables give no rows; further columns are ignored.
    """
    most = limit_ms - overlap_ms
    span, found = cuts(words, events, limit_ms, overlap_ms, least_ms, block_ms)
    long_ = F.col("last_ms") - F.col("first_ms") > limit_ms
    one = lambda c, kind: span.where(long_).select("k", F.col(c).alias("at_ms"), F.lit(kind).alias("kind"), F.lit(1).cast("bigint").alias("times"))
    every = one("first_ms", "start").unionByName(found.drop("stretch")).unionByName(one("last_ms", "end"))
    every = every.withColumns({"block": F.floor(F.col("at_ms") / block_ms), "own": F.struct("at_ms", "kind")})
    every = scan(every, ["k"], "block", ["at_ms"], [Scan("next", "last", "own", after=True, own=False), Scan("before", "sum", "times", own=False)]).where("next is not null")
    # An entry of several cuts begins as many pieces.
    every = every.select("k", "at_ms", "kind", "times", "next", F.coalesce("before", F.lit(0)).alias("before"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("times") - 1)).alias("i"))
    final = F.col("i") == F.col("times") - 1
    start = F.col("at_ms") + F.col("i") * most
    parts = every.select("k", (F.col("before") + F.col("i")).alias("piece_no"), start.alias("x"), F.when(final, F.col("next.at_ms")).otherwise(start + most).alias("to_ms"), F.when(final, F.col("next.kind")).otherwise(F.col("kind")).alias("end_kind"))
    first = F.col("piece_no") == 0
    early = F.least("first_ms", "first_event_ms")
    info = span.where(long_).select(F.col("k").alias("__k"), "first_ms", "first_event_ms")
    cutted = parts.join(info, F.col("k") == F.col("__k")).select(
        "k.dialogue_id", "piece_no", F.when(first, F.col("x")).otherwise(F.col("x") - overlap_ms).alias("from_ms"), "to_ms", "end_kind",
        F.when(first, early).otherwise(F.col("x") - overlap_ms).alias("member_from_ms"),
        F.when(F.col("end_kind") == "end", F.col("to_ms") + 1).otherwise(F.col("to_ms")).alias("member_to_ms"),
    )
    whole = span.where(~long_).select(
        "k.dialogue_id", F.lit(0).cast("bigint").alias("piece_no"), F.col("first_ms").alias("from_ms"), F.col("last_ms").alias("to_ms"), F.lit("end").alias("end_kind"),
        early.alias("member_from_ms"), (F.col("last_ms") + 1).alias("member_to_ms"),
    )
    return cutted.unionByName(whole)


def members(pieces: DataFrame, rows: DataFrame, at: str, block_ms: int = LIMIT_MS) -> DataFrame:
    """``rows`` (dialogue_id, ``at``, ...) with the piece_no of every piece they belong to; joined by dialogue and block of time."""
    p = pieces.select(
        F.col("dialogue_id").alias("__d"), "piece_no", "member_from_ms", "member_to_ms",
        F.explode(F.sequence(F.floor(F.col("member_from_ms") / block_ms), F.floor((F.col("member_to_ms") - 1) / block_ms))).alias("__b"),
    )
    on = F.col("dialogue_id").eqNullSafe(F.col("__d")) & (F.floor(F.col(at) / block_ms) == F.col("__b")) & (F.col(at) >= F.col("member_from_ms")) & (F.col(at) < F.col("member_to_ms"))
    return rows.join(p, on).select(*rows.columns, "piece_no")
