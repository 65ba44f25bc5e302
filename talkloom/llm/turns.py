"""Raw recogniser output into clean, ordered speaker turns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkloom.operators.blocks import Carry, Scan, carry, join_blocks, scan
from talkloom.operators.intervals import FAR_S
from talkloom.session import checkpointed

#: Length of the blocks that a dialogue is cut into, in seconds, and in places of its list.
BLOCK_S, BLOCK_ROWS = 600, 5000

# Forms of hesitations and hums per language; letters may be drawn out, halves repeated.
HUM_UNITS = {
    "en": "uh+m*|um+|er+m*|hm+|mh+m+|mm+|huh+",
    "de": "äh+m*|öh+m*|eh+m+|hm+|mh+m+|mm+",
    "fr": "eu+h+m*|heu+|hum+|hm+|mh+m+|mm+",
    "es": "e+h+m*|em+|hm+|mh+m+|mm+",
}
# Frequent words by which a dialogue without language is told.
FREQUENT = {
    "en": ["the", "a", "i", "you", "to", "of", "is", "for", "my", "we"],
    "de": ["ich", "die", "das", "der", "eine", "sie", "und", "mir", "wir", "aber"],
    "fr": ["le", "la", "je", "une", "du", "et", "vous", "mon", "nous", "il"],
    "es": ["el", "la", "un", "una", "y", "mi", "los", "del", "por", "voy"],
}
#: Sound and recording notes inside one token.
NOTE = r"\[[^\[\]]*\]|\([^()]*\)|\{[^{}]*\}|<[^<>]*>|\*[^*]*\*"
#: A label inside the text: with an arrow, in brackets or before a colon.
LABEL_TOKEN = r"^\s*(?:>+\s*)?[\[(]*\s*([^\[\]():>]+?)\s*[\])]*\s*:?\s*$"
LABEL_SIGN = r"^\s*>|^\s*[\[(].*[\])]\s*:?\s*$|:\s*$"
#: Time marks: with seconds, in brackets, or as t=...
TIME_MARK = r"^[\[(<{]*\s*(?:t\s*=\s*\d+(?:[.,]\d+)?|\d{1,2}:\d{2}:\d{2}(?:[.,]\d+)?)\s*[\])>}]*[.,;]?$|^[\[(<{]+\s*\d{1,2}:\d{2}(?:[.,]\d+)?\s*[\])>}]+[.,;]?$"
OPENS, CLOSES = "[({<*", "])}>*"
EDGE = r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$"


def hum_pattern(units: str) -> str:
    """Whole-token pattern: units joined by hyphens, with stuttered first letters before them."""
    return rf"^(?:\p{{L}}-)*(?:{units})(?:-(?:{units}))*$"


def plain_label(label: Column) -> Column:
    """A label in lower case, without brackets, arrows and colon around it, single blanks inside."""
    return F.lower(F.regexp_replace(F.regexp_replace(label, r"^[\s\[(>]+|[\s\]):]+$", ""), r"\s+", " "))


def channel_of(plain: Column) -> Column:
    """A or B for A/B or the channel number, either after speaker, spk, channel or ch; else null."""
    key = F.regexp_replace(plain, r"^(?:speaker|spk|channel|ch)[ _-]*", "")
    return F.when(key.rlike("^(?:a|0+)$"), "A").when(key.rlike("^(?:b|0*1)$"), "B")


def bare(word: Column) -> Column:
    """A token without notes attached to it."""
    return F.regexp_replace(F.regexp_replace(word, NOTE, ""), NOTE, "")


def _newest(rows: DataFrame) -> DataFrame:
    """The newest delivery of every (dialogue_id, word_idx) that has a start."""
    r = rows.select(F.struct("dialogue_id").alias("k"), "word_idx", "speaker", "word", F.when(F.abs("start") < FAR_S, F.col("start")).alias("start"), "end", "loaded_at", F.floor(F.col("word_idx") / BLOCK_ROWS).alias("__b"))
    down = [F.col(c).desc_nulls_last() for c in ("loaded_at", "start", "end", "speaker", "word")]
    r = r.withColumn("__r", F.row_number().over(Window.partitionBy("k", "__b").orderBy("word_idx", *down)))
    same = F.lag("word_idx").over(Window.partitionBy("k", "__b").orderBy("word_idx", *down))
    r = r.withColumn("__again", (F.col("__r") > 1) & same.eqNullSafe(F.col("word_idx")))
    return r.where(~F.col("__again") & F.col("start").isNotNull()).select("k", "word_idx", "speaker", "word", "start", "end")


def _bits(core: Column, by: dict[str, Column]) -> Column:
    """One bit for each language whose condition holds."""
    out = F.lit(0)
    for i, cond in enumerate(by.values()):
        out = out + F.when(cond, 1 << i).otherwise(0)
    return out


def _parsed(rows: DataFrame, aliases: DataFrame) -> DataFrame:
    """What follows from each row alone: label, text, whether it can be spoken, marks of notes, and languages of hums and frequent words."""
    word = F.coalesce("word", F.lit(""))
    token = F.when(word.rlike(LABEL_SIGN), plain_label(F.regexp_extract(word, LABEL_TOKEN, 1)))
    r = _newest(rows).withColumns({"__t": token, "__s": plain_label(F.col("speaker"))})
    # Names of roles come from the table of aliases; Spark sends it to all tasks if it is small and joins by name if not.
    names = aliases.where(F.col("alias").isNotNull() & F.col("speaker").isin("A", "B")).groupBy(F.lower("alias").alias("__a")).agg(F.max("speaker").alias("__n"))
    for c in ("__t", "__s"):
        r = r.join(names.withColumnsRenamed({"__a": f"{c}a", "__n": f"{c}n"}), F.col(c) == F.col(f"{c}a"), "left")
    token_label = F.coalesce(channel_of(F.col("__t")), F.col("__tn"))
    r = r.withColumns({"__tl": token_label, "__sl": F.coalesce(channel_of(F.col("__s")), F.col("__sn")), "__rest": bare(word)})
    r = r.withColumn("__core", F.regexp_replace(F.lower("__rest"), EDGE, ""))
    core, rest = F.col("__core"), F.col("__rest")
    open_ = F.when(rest != "", F.instr(F.lit(OPENS), F.substring(rest, 1, 1))).otherwise(0)
    tail = F.regexp_extract(rest, r"([^.,;:!?])[.,;:!?]*$", 1)
    close = F.when(tail != "", F.instr(F.lit(CLOSES), tail)).otherwise(0)
    part = F.col("__tl").isNull() & (core != "")
    marked = part & ((open_ > 0) | (close > 0))
    any_hum = core.rlike("|".join(hum_pattern(u) for u in HUM_UNITS.values()))
    hums = F.when(any_hum, _bits(core, {g: core.rlike(hum_pattern(u)) for g, u in HUM_UNITS.items()})).otherwise(0)
    known = core.isin(*sorted({w for ws in FREQUENT.values() for w in ws}))
    return r.select(
        "k", F.floor(F.col("start") / BLOCK_S).alias("block"), "start", "word_idx", "end", F.trim(rest).alias("text"),
        F.coalesce("__tl", "__sl").alias("label"), (part & ~word.rlike(TIME_MARK) & ~marked).alias("sayable"),
        F.when(marked, F.struct(open_.alias("opens"), close.alias("closes"))).alias("mark"),
        hums.alias("hums"), F.when(known, _bits(core, {g: core.isin(*ws) for g, ws in FREQUENT.items()})).otherwise(0).alias("usual"),
    )


def languages(blocks: DataFrame, dialogues: DataFrame) -> DataFrame:
    """(k, lang) of blocks (k, f_en, f_de, ...): the place of the table's language, else of that of most frequent words."""
    sums = blocks.groupBy("k").agg(*[F.sum(f"f_{g}").alias(f"s_{g}") for g in FREQUENT])
    d = dialogues.groupBy(F.struct("dialogue_id").alias("__k")).agg(F.max(F.regexp_extract(F.lower(F.trim("lang")), "^([a-z]{2})(?:[-_].*)?$", 1)).alias("__l"))
    place = F.array_position(F.array(*[F.lit(g) for g in FREQUENT]), F.col("__l")) - 1
    told = F.array_max(F.array(*[F.struct(F.col(f"s_{g}").alias("n"), F.lit(-i).alias("i")) for i, g in enumerate(FREQUENT)]))["i"]
    return sums.join(d, F.col("k") == F.col("__k"), "left").select("k", F.when(place >= 0, place).otherwise(-told).cast("int").alias("lang"))


def spoken_words(rows: DataFrame, aliases: DataFrame, dialogues: DataFrame) -> DataFrame:
    """Spoken words (k, block, start, word_idx, end, text, speaker); ``k`` is a struct of dialogue_id.

    Every word_idx counts once, in its newest delivery; rows without start, hesitations and hums of the
    dialogue's language, notes of sounds or of the recording (in one token, or from a token that opens to one that
    closes, with no other mark between, over any number of rows), time
    marks, labels and tokens without letter or digit are left out. A row without label has the label of the
    nearest row before it, spoken or not; words before the first label of a dialogue belong to nobody and are
    left out. Order is by start, then word_idx. ``aliases`` has alias and speaker. Dialogues may be of any length: they are worked on in
    blocks of ten minutes, which know the last label and mark before them and the next mark after them. An empty
    table gives no rows; further columns are ignored.
    """
    r = checkpointed(_parsed(rows, aliases)).repartition("k", "block")  # two passes go over the parsed rows
    at = lambda c: F.when(F.col(c).isNotNull(), F.struct("start", "word_idx"))
    counts = [F.sum(F.shiftright("usual", i).bitwiseAND(1)).alias(f"f_{g}") for i, g in enumerate(FREQUENT)]
    blocks = checkpointed(r.groupBy("k", "block").agg(F.max_by("label", at("label")).alias("__label"), F.max_by("mark", at("mark")).alias("__last"), F.min_by("mark", at("mark")).alias("__first"), *counts))
    known = carry(blocks, ["k"], "block", [Carry("label0", "last", "__label"), Carry("mark0", "last", "__last"), Carry("mark1", "first", "__first", after=True)])
    lang = languages(blocks, dialogues).withColumnRenamed("k", "__kk")
    known = known.join(lang, F.col("k") == F.col("__kk"), "left").select("k", "block", "label0", "mark0", "mark1", "lang")
    r = join_blocks(r, known, ["k"], "block")
    w = Window.partitionBy("k", "block").orderBy("start", "word_idx")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    following = F.expr("lead(mark, 1) ignore nulls over (partition by k, block order by start, word_idx)")
    r = r.withColumns({
        "speaker": F.coalesce(F.last("label", True).over(w.rowsBetween(Window.unboundedPreceding, 0)), F.col("label0")),
        "__m0": F.coalesce(F.last("mark", True).over(before), F.col("mark0")), "__m1": F.coalesce(following, F.col("mark1")),
    })
    noted = F.coalesce((F.col("__m0.opens") > 0) & (F.col("__m0.opens") == F.col("__m1.closes")), F.lit(False))
    hum = F.expr("shiftright(hums, lang) & 1") == 1
    return r.where(F.col("sayable") & ~noted & ~hum & F.col("speaker").isNotNull()).select("k", "block", "start", "word_idx", "end", "text", "speaker")


def turns(spoken: DataFrame, texts: bool = False) -> DataFrame:
    """(dialogue_id, turn_no, speaker, first_word_idx, n_words, start) of every turn, and with ``texts`` the latest end of its words and the words as ``text``.

    Words become runs of one speaker inside their block; from there on only runs are moved. A turn is one row, whatever
    blocks it crosses.
    """
    w = Window.partitionBy("k", "block").orderBy("start", "word_idx")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    new = F.when(F.lag("speaker").over(w) == F.col("speaker"), 0).otherwise(1)
    at = F.struct("start", "word_idx")
    if texts:
        s = spoken.withColumn("__new", new).withColumn("run", F.sum("__new").over(upto))
        said = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "word_idx", "text"))), lambda x: x["text"]), " ")
        runs = s.groupBy("k", "block", "run", "speaker").agg(F.min(at).alias("at"), F.count(F.lit(1)).alias("n"), F.max(F.when(~F.isnan("end"), F.col("end"))).alias("end"), said.alias("text"))
    else:  # a run is as long as the next one of the block, or the block's end, is away
        s = spoken.withColumns({"__new": new, "run": F.row_number().over(w), "__left": F.count(F.lit(1)).over(Window.partitionBy("k", "block"))})
        s = s.where("__new = 1").withColumn("n", F.coalesce(F.lead("run").over(w), F.col("__left") + 1) - F.col("run"))
        runs = s.select("k", "block", "run", "speaker", at.alias("at"), F.col("n").cast("bigint").alias("n"))
    runs = checkpointed(runs)  # far fewer than words, and gone over several times
    runs = scan(runs, ["k"], "block", ["run"], [Scan("__was", "last", "speaker", own=False)])
    runs = runs.withColumn("__turn", F.when(F.col("__was") == F.col("speaker"), 0).otherwise(1).cast("bigint"))
    # Only the first run of a block may go on with a turn of the block before, so places in the block follow from a sum.
    runs = scan(runs, ["k"], "block", ["run"], [Scan("turn_no", "sum", "__turn")])
    more = [F.max("end").alias("end"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "text"))), lambda x: x["text"]), " ").alias("text")] if texts else []
    t = runs.groupBy("k", "turn_no", "speaker").agg(F.min("at").alias("at"), F.sum("n").alias("n_words"), *more)
    cols = ["k.dialogue_id", (F.col("turn_no") - 1).alias("turn_no"), "speaker", F.col("at.word_idx").alias("first_word_idx"), "n_words", F.col("at.start").alias("start")]
    return t.select(*cols, *(["end", "text"] if texts else []))
