"""Queries on scripts, made of the turns of the word tables, and on the cleaner."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkloom.operators import scripts, speech
from talkloom.plans.speech import _TURNS, WORDS_SQL
from talkloom.session import checkpointed
from talkloom.sources.tables import table
from talkloom.streaming import cleaner

#: Emotions that the turns of the word tables are given.
MOODS = ("neutral", "annoyed", "angry", "calm", "bored")


def _turn_words(spark: SparkSession, folder: str) -> DataFrame:
    """Words with the number of their turn, written once."""
    return checkpointed(speech.in_turns(checkpointed(speech.clean_words(table(spark, folder, "words")))))


def _turns(w: DataFrame) -> DataFrame:
    """Turns as a script has them: one-word turns are backchannels, turns that begin before the one before ends interrupt."""
    said = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("word_idx", "word"))), lambda x: x["word"]), " ")
    t = speech.timeline(speech.turns_of(w))
    text = w.groupBy("dialogue_id", "turn_no", F.floor(F.col("word_idx") / 1000)).agg(said.alias("text"), F.min("word_idx").alias("i"))
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "text"))), lambda x: x["text"]), " ")
    t = t.join(text.groupBy("dialogue_id", "turn_no").agg(whole.alias("text")), ["dialogue_id", "turn_no"])
    who = F.when(F.col("speaker") == "A", "passenger").otherwise("crew")
    mood = F.get(F.array(*[F.lit(e) for e in MOODS]), F.col("first_idx") % 5)
    return checkpointed(t.select(
        F.col("dialogue_id").alias("script_id"), F.col("turn_no"), who.alias("speaker"), "text",
        F.when(F.col("first_idx") % 3 > 0, (F.col("turn_no") % 4) / 10).alias("gap_s"), mood.alias("emotion"), F.when(F.col("first_idx") % 7 > 0, F.col("first_idx") % 5).cast("int").alias("intensity"),
        (F.col("n_words") == 1).alias("backchannel"), F.when(F.col("turn_no") % 2 == 0, "the").alias("at"), ((F.col("early_ms") > 0) & (F.col("n_words") > 1)).alias("interrupts"),
        ((F.col("end_ms") - F.col("start_ms")) / 1000).alias("dur"), F.when(F.col("first_idx") % 2 == 0, "news").alias("trigger"), F.col("start_ms").alias("real_ms"),
    ))


def pred_turn_errors(spark: SparkSession, folder: str) -> DataFrame:
    """Errors of turns, counted by script."""
    e = scripts.turn_errors(_turns(_turn_words(spark, folder)))
    return e.groupBy("script_id", "error").agg(F.count(F.lit(1)).alias("n"))


def pred_clips(spark: SparkSession, folder: str) -> DataFrame:
    """What is wrong with turns as clips, counted; the score is made of the turn's number."""
    t = _turns(_turn_words(spark, folder))
    p = scripts.clip_problem(F.col("text"), F.size(F.split("text", " ")), F.col("dur"), (F.col("turn_no") % 10) / 10, F.col("backchannel"))
    return t.groupBy(F.coalesce(p, F.lit("none")).alias("problem")).agg(F.count(F.lit(1)).alias("n"))


def f29_repaired(spark: SparkSession, folder: str) -> DataFrame:
    """Scripts after repairs: number of turns, digits left, and sums of intensities."""
    t = scripts.repaired(_turns(_turn_words(spark, folder)))
    return t.groupBy("script_id").agg(
        F.count(F.lit(1)).alias("n_turns"), F.count_if(F.col("text").rlike("[0-9]")).alias("n_digits"), F.sum("intensity").alias("intensities"),
        F.sum(F.col("intensity") * F.col("turn_no")).alias("weighted"), F.count_if(F.col("emotion") == "irritated").alias("n_irritated"),
    )


def f30_overlaps(spark: SparkSession, folder: str) -> DataFrame:
    """Scripts with possible overlaps only: number of turns, backchannels, interrupts and anchors."""
    t = scripts.overlaps_fixed(_turns(_turn_words(spark, folder)))
    return t.groupBy("script_id").agg(F.count(F.lit(1)).alias("n_turns"), F.count_if("backchannel").alias("n_backchannels"), F.count_if("interrupts").alias("n_interrupts"), F.count("at").alias("n_anchors"))


def n11_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Turns of the passenger in which the emotion changes without a trigger, by script."""
    return scripts.emotion_changes(_turns(_turn_words(spark, folder))).groupBy("script_id").agg(F.count(F.lit(1)).alias("n"), F.sum("turn_no").alias("places"))


def a20_scripts(spark: SparkSession, folder: str) -> DataFrame:
    """Value counts of the passenger's turns by emotion and intensity, backchannels aside, with words per turn in hundredths."""
    t = _turns(_turn_words(spark, folder)).where("speaker = 'passenger' and not backchannel")
    words = F.size(F.split(F.trim("text"), r"\s+"))
    return t.groupBy(F.concat_ws("_", "emotion", F.coalesce(F.col("intensity").cast("string"), F.lit("None"))).alias("value")).agg(F.count(F.lit(1)).alias("n"), F.floor(F.sum(words) * 100 / F.count(F.lit(1))).alias("words_100"))


def a21_peaks(spark: SparkSession, folder: str) -> DataFrame:
    """The passenger's peak intensity in every script, 0 without one, and the number of calm turns: neutral, or without emotion or intensity."""
    t, person = _turns(_turn_words(spark, folder)), F.col("speaker") == "passenger"
    level = F.coalesce("intensity", F.lit(0))
    return t.groupBy("script_id").agg(F.coalesce(F.max(F.when(person, level)), F.lit(0)).alias("peak"), F.count_if(person & scripts.calm(F.col("emotion"), F.col("intensity"))).alias("n_calm"))


def f31_assembled(spark: SparkSession, folder: str) -> DataFrame:
    """Turns as records of a script: labels of emotion only for the passenger; number of records by what they hold."""
    t = scripts.unlabelled(_turns(_turn_words(spark, folder)))
    has = lambda c: F.when(F.col(c).isNotNull(), c)
    return t.groupBy("speaker", F.concat_ws(",", has("emotion"), has("intensity"), has("trigger")).alias("fields")).agg(F.count(F.lit(1)).alias("n"))


def o4_placed(spark: SparkSession, folder: str) -> DataFrame:
    """Scripts placed on two channels: number of turns and cuts, the latest end, and the sums of starts and ends."""
    p = scripts.placed(_turns(_turn_words(spark, folder)))
    return p.groupBy("script_id").agg(F.count(F.lit(1)).alias("n_turns"), F.count_if("cut").alias("n_cut"), F.max("end_ms").alias("last_ms"), F.sum("start_ms").alias("starts"), F.sum("end_ms").alias("ends"))


def o5_words(spark: SparkSession, folder: str) -> DataFrame:
    """Words of the placed turns, those behind a cut left out, with backchannels at their anchors: number and sum of times by script."""
    w = _turn_words(spark, folder)
    t = _turns(w)
    inner = w.join(t.select(F.col("script_id").alias("dialogue_id"), "turn_no", "real_ms"), ["dialogue_id", "turn_no"])
    at = lambda c: ((F.col(c) - F.col("real_ms")) / 1000)
    inner = inner.select(F.col("dialogue_id").alias("script_id"), "turn_no", F.col("word_idx").alias("idx"), "speaker", "word", at("start_ms").alias("start_s"), at("end_ms").alias("end_s"))
    anchored = t.join(scripts.anchors(t, inner), ["script_id", "turn_no"], "left")
    out = scripts.spoken_words(inner, scripts.placed(anchored))
    return out.groupBy("script_id", "speaker").agg(F.count(F.lit(1)).alias("n_words"), F.sum("start_ms").alias("starts"), F.max("end_ms").alias("last_ms"))


def f15_cleaned(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct predictions as the cleaner leaves them."""
    return table(spark, folder, "oracle_raw").select("prediction").distinct().select("prediction", cleaner.cleaned(F.col("prediction")).alias("clean"))


def f12_conversations(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations built from words: every line of every dialogue."""
    w = speech.clean_words(table(spark, folder, "words"))
    c = w.select(F.col("dialogue_id").alias("conversation"), F.col("word_idx").alias("seq"), "speaker", F.col("word").alias("chunk"), (F.col("word_idx") % 10 == 9).alias("glue"))
    return cleaner.conversation_lines(c)


QUERIES = {f.__name__: f for f in (pred_turn_errors, pred_clips, f29_repaired, f30_overlaps, n11_changes, a20_scripts, a21_peaks, f31_assembled, o4_placed, o5_words, f15_cleaned, f12_conversations)}

_SCRIPT = f"""{WORDS_SQL}, {_TURNS},
tl AS (SELECT *, max(end_ms) OVER (PARTITION BY dialogue_id ORDER BY turn_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM t),
t1 AS (SELECT dialogue_id, turn_no, string_agg(word, ' ' ORDER BY word_idx) AS text FROM tw GROUP BY ALL),
s AS (SELECT tl.dialogue_id AS script_id, CASE WHEN speaker = 'A' THEN 'passenger' ELSE 'crew' END AS speaker, text, (['neutral', 'annoyed', 'angry', 'calm', 'bored'])[first_idx % 5 + 1] AS emotion,
  CASE WHEN first_idx % 7 > 0 THEN first_idx % 5 END AS intensity, n_words = 1 AS bc, reach > start_ms AND n_words > 1 AS it, (end_ms - start_ms) / 1000 AS dur, end_ms - start_ms AS ms,
  CASE WHEN first_idx % 3 > 0 THEN (turn_no % 4) * 100 END AS gap, CASE WHEN turn_no % 2 = 0 THEN 'the' END AS phrase, first_idx % 2 <> 0 AS quiet, turn_no FROM tl JOIN t1 USING (dialogue_id, turn_no)),
fl AS (SELECT *, coalesce(it, false) AS i2, last_value(CASE WHEN NOT bc THEN speaker END IGNORE NULLS) OVER (PARTITION BY script_id ORDER BY turn_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS floor FROM s)"""

# Turns numbered from 0 without gaps, with the floor: the last turn before that isn't a backchannel.
_ORDERED = """od AS (
  SELECT s.*, coalesce(it, false) AS i2, row_number() OVER o - 1 AS n, f.text AS ftext, f.ms AS fms, f.no AS fn, coalesce(f.sp <> s.speaker, false) AS other,
    len(regexp_extract_all(lower(f.text), '[a-z'']+')) AS nw, array_to_string(regexp_extract_all(lower(f.text), '[a-z'']+'), ' ') AS fwords
  FROM (SELECT *, last_value(CASE WHEN NOT bc THEN struct_pack(text := text, ms := ms, sp := speaker, no := turn_no) END IGNORE NULLS) OVER (PARTITION BY script_id ORDER BY turn_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS f FROM s) s
  WINDOW o AS (PARTITION BY script_id ORDER BY turn_no)
)"""

SQL = {
    "pred_turn_errors": f"""WITH {_SCRIPT},
e AS (SELECT script_id, unnest(list_filter([CASE WHEN trim(text) = '' THEN 'empty text' END, CASE WHEN regexp_matches(text, '[0-9]') THEN 'digits in text' END, CASE WHEN regexp_matches(text, '[\\[\\]()*]') THEN 'brackets in text' END,
  CASE WHEN bc AND i2 THEN 'both backchannel and interrupt' END, CASE WHEN turn_no = 0 AND (bc OR i2) THEN 'begins with backchannel or interrupt' END, CASE WHEN (bc OR i2) AND speaker = floor THEN 'backchannel or interrupt by the floor' END,
  CASE WHEN speaker = 'passenger' AND emotion NOT IN ('neutral', 'angry') THEN 'unknown emotion' END, CASE WHEN speaker = 'passenger' AND coalesce(intensity, 9) > 3 THEN 'intensity not 0 to 3' END], lambda x: x IS NOT NULL)) AS error FROM fl
  UNION ALL SELECT script_id, 'fewer than 4 turns' FROM s GROUP BY script_id HAVING count(*) < 4)
SELECT script_id, error, count(*) AS n FROM e GROUP BY ALL""",
    "pred_clips": f"""WITH {_SCRIPT}, q AS (SELECT *, len(regexp_extract_all(text, '[^\\s]*\\p{{L}}[^\\s]*')) AS n, len(string_split(text, ' ')) AS al FROM s)
SELECT CASE WHEN n = 0 THEN 'no words' WHEN al < 0.9 * n THEN 'words missing' WHEN dur > 1.2::DOUBLE + n THEN 'too long' WHEN bc THEN 'none' WHEN (turn_no % 10) / 10 < 0.35 THEN 'low score' ELSE 'none' END AS problem, count(*) AS n FROM q GROUP BY 1""",
    "a20_scripts": f"""WITH {_SCRIPT} SELECT emotion || '_' || coalesce(CAST(intensity AS VARCHAR), 'None') AS value, count(*) AS n, CAST(floor(sum(len(regexp_split_to_array(trim(text), '\\s+'))) * 100 / count(*)) AS BIGINT) AS words_100
FROM s WHERE speaker = 'passenger' AND NOT bc GROUP BY 1""",
    "a21_peaks": f"""WITH {_SCRIPT} SELECT script_id, CAST(coalesce(max(coalesce(intensity, 0)) FILTER (WHERE speaker = 'passenger'), 0) AS INT) AS peak,
  count(*) FILTER (WHERE speaker = 'passenger' AND (emotion = 'neutral' OR coalesce(intensity, 0) = 0)) AS n_calm FROM s GROUP BY 1""",
    "f31_assembled": f"""WITH {_SCRIPT} SELECT speaker, CASE WHEN speaker = 'crew' THEN '' ELSE concat_ws(',', 'emotion', CASE WHEN intensity IS NOT NULL THEN 'intensity' END, CASE WHEN NOT quiet THEN 'trigger' END) END AS fields, count(*) AS n FROM s GROUP BY ALL""",
    "n11_changes": f"""WITH {_SCRIPT}, p AS (SELECT *, lag(struct_pack(e := emotion, i := intensity)) OVER (PARTITION BY script_id ORDER BY turn_no) AS was FROM s WHERE speaker = 'passenger')
SELECT script_id, count(*) AS n, CAST(sum(turn_no) AS BIGINT) AS places FROM p WHERE was IS NOT NULL AND (was.e IS DISTINCT FROM emotion OR was.i IS DISTINCT FROM intensity) AND quiet GROUP BY 1""",
    "f29_repaired": f"""WITH RECURSIVE {_SCRIPT}, {_ORDERED},
fd AS (
  SELECT script_id, CAST(-1 AS BIGINT) AS n, CAST(0 AS BIGINT) AS level, CAST(NULL AS BIGINT) AS given, CAST('neutral' AS VARCHAR) AS name, CAST(NULL AS VARCHAR) AS said FROM (SELECT DISTINCT script_id FROM od)
  UNION ALL
  SELECT fd.script_id, fd.n + 1,
    CASE WHEN speaker <> 'passenger' OR bc THEN level WHEN intensity IS NULL THEN level WHEN mood = 'bored' THEN least(3, intensity) ELSE greatest(least(3, intensity), level - 1) END,
    CASE WHEN speaker = 'passenger' THEN CASE WHEN intensity IS NULL THEN level WHEN mood = 'bored' OR bc THEN least(3, intensity) ELSE greatest(least(3, intensity), level - 1) END ELSE intensity END,
    CASE WHEN speaker <> 'passenger' OR bc THEN name ELSE mood END, CASE WHEN speaker = 'passenger' THEN mood ELSE emotion END
  FROM fd JOIN (SELECT *, CASE emotion WHEN 'annoyed' THEN 'irritated' WHEN 'calm' THEN 'neutral' ELSE emotion END AS mood FROM od) o ON o.script_id = fd.script_id AND o.n = fd.n + 1
)
SELECT fd.script_id, count(*) AS n_turns, count(*) FILTER (WHERE false) AS n_digits, CAST(sum(given) AS BIGINT) AS intensities, CAST(sum(given * turn_no) AS BIGINT) AS weighted, count(*) FILTER (WHERE said = 'irritated') AS n_irritated
FROM fd JOIN od ON od.script_id = fd.script_id AND od.n = fd.n GROUP BY 1""",
    "f30_overlaps": f"""WITH {_SCRIPT}, {_ORDERED}, k AS (SELECT *, other AND nw >= 8 AS bc_ok, other AND nw >= 6 AND regexp_matches(ftext, '([.]{{3}}|…|-)\\s*$') AS it_ok FROM od)
SELECT script_id, count(*) AS n_turns, count(*) FILTER (WHERE bc) AS n_backchannels, count(*) FILTER (WHERE i2 AND (bc OR it_ok)) AS n_interrupts,
  count(*) FILTER (WHERE phrase IS NOT NULL AND (NOT bc OR contains(fwords, 'the'))) AS n_anchors FROM k WHERE NOT bc OR bc_ok GROUP BY script_id""",
    "o4_placed": f"""WITH RECURSIVE {_SCRIPT}, {_ORDERED},
st AS (
  SELECT *, CASE WHEN ftext IS NULL THEN 'open' WHEN bc THEN 'in' WHEN i2 AND other AND fms >= 1200 THEN 'cut' ELSE 'after' END AS kind, regexp_matches(coalesce(ftext, ''), '([.]{{3}}|…|-)\\s*$') AS broken FROM od
), tm AS (
  SELECT *, CAST(CASE kind WHEN 'open' THEN 400 WHEN 'in' THEN round(fms * 0.55::DOUBLE) WHEN 'cut' THEN CASE WHEN broken THEN fms - 275 ELSE greatest(600, round(fms * 0.625::DOUBLE)) END
    ELSE CASE WHEN other THEN coalesce(gap, 500) ELSE greatest(coalesce(gap, 500), 150) END END AS BIGINT) AS off,
    CASE WHEN kind = 'cut' THEN CAST(round(least(fms, CASE WHEN broken THEN fms - 275 + 140 ELSE greatest(600, fms * 0.625::DOUBLE) + 375 END)) AS BIGINT) END AS until, speaker = 'passenger' AS me FROM st
), fd AS (
  SELECT script_id, CAST(-1 AS BIGINT) AS n, CAST(0 AS BIGINT) AS fs, CAST(0 AS BIGINT) AS fe, CAST(0 AS BIGINT) AS pf, CAST(0 AS BIGINT) AS cf, CAST(NULL AS BIGINT) AS at_, CAST(NULL AS BIGINT) AS en, CAST(NULL AS BIGINT) AS cut_, CAST(NULL AS BIGINT) AS fl FROM (SELECT DISTINCT script_id FROM od)
  UNION ALL
  SELECT script_id, n, CASE WHEN bc THEN fs ELSE at_ END, CASE WHEN bc THEN fe ELSE at_ + ms END,
    CASE WHEN me THEN at_ + ms ELSE CASE WHEN until IS NOT NULL THEN fs + until ELSE pf END END, CASE WHEN NOT me THEN at_ + ms ELSE CASE WHEN until IS NOT NULL THEN fs + until ELSE cf END END,
    at_, at_ + ms, CASE WHEN until IS NOT NULL THEN fs + until END, fn
  FROM (SELECT tm.*, fs, fe, pf, cf, greatest(CASE kind WHEN 'open' THEN 0 WHEN 'after' THEN fe ELSE fs END + off, CASE WHEN me THEN pf ELSE cf END + 50) AS at_ FROM fd JOIN tm ON tm.script_id = fd.script_id AND tm.n = fd.n + 1)
), c AS (SELECT a.script_id, a.at_, coalesce(b.cut_, a.en) AS en, b.cut_ IS NOT NULL AS cut FROM fd a LEFT JOIN fd b ON b.script_id = a.script_id AND b.fl = a.n AND b.cut_ IS NOT NULL WHERE a.n >= 0)
SELECT script_id, count(*) AS n_turns, count(*) FILTER (WHERE cut) AS n_cut, max(en) AS last_ms, CAST(sum(at_) AS BIGINT) AS starts, CAST(sum(en) AS BIGINT) AS ends FROM c GROUP BY 1""",
    "f12_conversations": f"""WITH {WORDS_SQL},
c AS (SELECT *, trim(word) AS t FROM w WHERE trim(word) <> ''),
d AS (SELECT *, CASE WHEN lag(speaker) OVER (PARTITION BY dialogue_id ORDER BY word_idx) = speaker THEN 0 ELSE 1 END AS new FROM c),
l AS (SELECT *, sum(new) OVER (PARTITION BY dialogue_id ORDER BY word_idx ROWS UNBOUNDED PRECEDING) - 1 AS line_no FROM d)
SELECT dialogue_id AS conversation, CAST(line_no AS BIGINT) AS line_no, speaker || ': ' || string_agg(CASE WHEN new = 1 OR word_idx % 10 = 9 THEN '' ELSE ' ' END || t, '' ORDER BY word_idx) || ' ' AS line
FROM l GROUP BY dialogue_id, line_no, speaker""",
}
