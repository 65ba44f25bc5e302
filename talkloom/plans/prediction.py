"""Queries on prediction events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkloom.functions import text
from talkloom.operators import prediction, speech
from talkloom.plans.speech import WORDS_SQL
from talkloom.plans.text import EVENTS_SQL, _events
from talkloom.sources.tables import table

STEP_MS = 5000


def o1_events(spark: SparkSession, folder: str) -> DataFrame:
    """Prediction events every five seconds, with the hint in place of a model's line."""
    e = prediction.events(speech.clean_words(table(spark, folder, "words")), STEP_MS, prediction.verbatim)
    return e.select("dialogue_id", "timestamp_ms", "total_word_count", "trigger_word", "recent_words", "current_spoken_ratio", "channel", "hint", "prediction", F.element_at(F.split("conversation_context", "\n"), -1).alias("last_line"))


def o2_fallback(spark: SparkSession, folder: str) -> DataFrame:
    """A predictor's line checked: verbatim hint near the end of the turn, else the line unless it is too short or sounds like crew, else the fallback."""
    r, h, p = F.coalesce(F.nanvl("current_spoken_ratio", F.lit(0.0)), F.lit(0.0)), F.coalesce("hint", F.lit("")), F.coalesce("prediction", F.lit(""))
    line = F.when((r >= 0.95) & (h != ""), h).when((text.n_words(p) >= 2) & ~text.sounds_like_crew(p), p).otherwise(F.when(r > 0.5, h).otherwise(""))
    return _events(spark, folder).select("dialogue_id", "event_idx", line.alias("line"))


def r21_on_frames(spark: SparkSession, folder: str) -> DataFrame:
    """Events on the frame grid, with the number of tokens of prediction and hint."""
    e = prediction.on_frames(_events(spark, folder).where("channel is not null"))
    return e.select("dialogue_id", "event_idx", "channel", "frame", "skip_forbid", F.size("pred").alias("n_pred"), F.size("hint").alias("n_hint"))


def a17_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of the events per dialogue, with the reasons to look at it."""
    e = _events(spark, folder)
    p, h = F.coalesce("prediction", F.lit("")), F.coalesce("hint", F.lit(""))
    e = e.select("dialogue_id", "event_idx", p.alias("p"), h.alias("h"), ((h == "") | (F.trim(p) != F.trim(h))).alias("own"), ((F.coalesce(F.nanvl("current_spoken_ratio", F.lit(0.0)), F.lit(0.0)) > 0.5) != (h != "")).alias("bad"))
    hints = e.where("h <> ''").groupBy("dialogue_id", "h").agg(F.lit(1)).groupBy("dialogue_id").agg(F.count(F.lit(1)).alias("n_hints"), F.count_if(F.size(text.tokens(F.col("h"))) <= 2).alias("n_fragments"))
    q = e.groupBy("dialogue_id").agg(
        F.count(F.lit(1)).alias("n_events"), F.count_if("own").alias("n_own"), F.count_if(F.col("own") & text.shouts(F.col("p"))).alias("n_caps"),
        F.count_if(F.col("own") & text.sounds_like_crew(F.col("p"))).alias("n_crew"), F.count_if(F.col("own") & F.col("p").rlike(r"^\p{Ll}")).alias("n_low"), F.count_if("bad").alias("n_bad_hint"),
    ).join(hints, "dialogue_id", "left")
    n, f = F.coalesce("n_hints", F.lit(0)), F.coalesce("n_fragments", F.lit(0))
    why = F.concat_ws("|", F.when(F.col("n_caps") * 20 > F.col("n_own"), "all-caps"), F.when(F.col("n_crew") * 100 > F.col("n_own") * 15, "crew-voice"), F.when((f * 2 > n) & (n >= 4), "fragment hints"))
    return q.select("dialogue_id", "n_events", "n_own", "n_caps", "n_crew", "n_low", "n_bad_hint", n.alias("n_hints"), f.alias("n_fragments"), why.alias("why"))


QUERIES = {f.__name__: f for f in (o1_events, o2_fallback, r21_on_frames, a17_quality)}

_CREW = text.CREW_CUES.replace("'", "''")
_R = "coalesce(CASE WHEN isnan(current_spoken_ratio) THEN 0 ELSE current_spoken_ratio END, 0)"
_NW = f"len(regexp_extract_all(p, '[^{text.SPACE}]*\\p{{L}}[^{text.SPACE}]*'))"
_WS = "len(list_filter(regexp_split_to_array({0}, '\\s+'), lambda x: x <> ''))"

SQL = {
    "o1_events": f"""
WITH {WORDS_SQL},
m AS (SELECT dialogue_id, max(e) AS last FROM w GROUP BY 1),
t AS (SELECT dialogue_id, unnest(generate_series({STEP_MS}, last - 1, {STEP_MS})) AS t FROM m),
sf AS (SELECT t.dialogue_id, t, count(*) AS n, max(word_idx) AS k, max(word_idx) FILTER (WHERE speaker = 'A') AS ka, max(word_idx) FILTER (WHERE speaker = 'B') AS kb
  FROM t JOIN w ON w.dialogue_id = t.dialogue_id AND w.e <= t GROUP BY ALL HAVING count(*) >= 2),
k AS (SELECT sf.dialogue_id, t, n, k, w.speaker AS sp, w.e AS ke, w.word AS trigger_word, coalesce(CASE WHEN w.speaker = 'A' THEN kb ELSE ka END, -1) AS ko FROM sf JOIN w ON w.dialogue_id = sf.dialogue_id AND w.word_idx = sf.k),
h1 AS (SELECT k.dialogue_id, t, min(w.word_idx) FILTER (WHERE w.speaker <> sp) AS p1 FROM k JOIN w ON w.dialogue_id = k.dialogue_id AND w.e > ke GROUP BY ALL),
h2 AS (SELECT k.dialogue_id, k.t, p1, min(w.word_idx) AS p2 FROM k JOIN h1 ON h1.dialogue_id = k.dialogue_id AND h1.t = k.t LEFT JOIN w ON w.dialogue_id = k.dialogue_id AND w.e > ke AND w.speaker = sp AND w.word_idx > p1 WHERE p1 IS NOT NULL GROUP BY ALL),
h AS (SELECT k.dialogue_id, k.t, string_agg(w.word, ' ' ORDER BY w.word_idx) AS hint FROM k JOIN h2 ON h2.dialogue_id = k.dialogue_id AND h2.t = k.t
  JOIN w ON w.dialogue_id = k.dialogue_id AND w.e > ke AND w.speaker <> sp AND w.word_idx >= p1 AND (p2 IS NULL OR w.word_idx < p2) GROUP BY ALL),
stop AS (SELECT k.dialogue_id, min(k.t) AS st FROM k LEFT JOIN h ON h.dialogue_id = k.dialogue_id AND h.t = k.t WHERE coalesce(hint, '') = '' GROUP BY 1),
isl AS (SELECT *, sum(c) OVER (PARTITION BY dialogue_id ORDER BY word_idx ROWS UNBOUNDED PRECEDING) AS g FROM (
  SELECT *, CASE WHEN lag(speaker) OVER o = speaker AND e - lag(e) OVER o < 1000 THEN 0 ELSE 1 END AS c FROM w WINDOW o AS (PARTITION BY dialogue_id ORDER BY word_idx))),
fw AS (SELECT dialogue_id, word_idx, count(*) OVER (PARTITION BY dialogue_id, g ORDER BY word_idx ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS ahead FROM isl),
r AS (SELECT k.dialogue_id, k.t, count(*) AS run, string_agg(w.word, ' ' ORDER BY w.word_idx) AS said FROM k JOIN w ON w.dialogue_id = k.dialogue_id AND w.e <= k.t AND w.word_idx > ko GROUP BY ALL),
rc AS (SELECT k.dialogue_id, k.t, array_to_string(list_reverse((list(w.word ORDER BY w.word_idx DESC))[1:5]), ' ') AS recent_words FROM k JOIN w ON w.dialogue_id = k.dialogue_id AND w.e <= k.t GROUP BY ALL),
x AS (SELECT k.*, run, run / (run + ahead) AS ratio, hint, said, recent_words FROM k JOIN r USING (dialogue_id, t) JOIN h USING (dialogue_id, t) JOIN rc USING (dialogue_id, t)
  JOIN fw ON fw.dialogue_id = k.dialogue_id AND fw.word_idx = k.k LEFT JOIN stop ON stop.dialogue_id = k.dialogue_id WHERE st IS NULL OR k.t < st)
SELECT dialogue_id, CAST(t AS BIGINT) AS timestamp_ms, CAST(n AS INT) AS total_word_count, trigger_word, recent_words, ratio AS current_spoken_ratio, CASE WHEN sp = 'A' THEN 1 ELSE 0 END AS channel,
  CASE WHEN ratio > 0.5 THEN hint ELSE '' END AS hint, trim(hint) AS prediction, sp || ': ' || said AS last_line
FROM x WHERE trim(hint) <> ''""",
    "o2_fallback": f"""WITH {EVENTS_SQL}, l AS (SELECT dialogue_id, event_idx, {_R} AS r, coalesce(hint, '') AS h, coalesce(prediction, '') AS p FROM e)
SELECT dialogue_id, event_idx, CASE WHEN r >= 0.95 AND h <> '' THEN h WHEN {_NW} >= 2 AND NOT regexp_matches(p, '{_CREW}') THEN p WHEN r > 0.5 THEN h ELSE '' END AS line FROM l""",
    "r21_on_frames": f"""WITH {EVENTS_SQL}, n AS (SELECT *, coalesce(lead(channel) OVER (PARTITION BY dialogue_id ORDER BY event_idx) <> channel, true) AS skip_forbid FROM e WHERE channel IS NOT NULL)
SELECT dialogue_id, event_idx, channel, CAST(floor(timestamp_ms / 1000 * 12.5) AS INT) AS frame, skip_forbid, {_WS.format("coalesce(prediction, '')")} AS n_pred, {_WS.format("coalesce(hint, '')")} AS n_hint
FROM n WHERE {_WS.format("coalesce(prediction, '')")} > 0 AND timestamp_ms >= 0""",
    "a17_quality": f"""WITH {EVENTS_SQL},
l AS (SELECT dialogue_id, coalesce(prediction, '') AS p, coalesce(hint, '') AS h, coalesce(hint, '') = '' OR trim(coalesce(prediction, '')) <> trim(coalesce(hint, '')) AS own, ({_R} > 0.5) <> (coalesce(hint, '') <> '') AS bad FROM e),
hs AS (SELECT dialogue_id, count(*) AS n_hints, count(*) FILTER (WHERE len(list_filter(regexp_split_to_array(h, '[{text.SPACE}]+'), lambda x: x <> '')) <= 2) AS n_fragments FROM (SELECT DISTINCT dialogue_id, h FROM l WHERE h <> '') GROUP BY 1),
q AS (SELECT dialogue_id, count(*) AS n_events, count(*) FILTER (WHERE own) AS n_own,
  count(*) FILTER (WHERE own AND len(regexp_extract_all(p, '\\p{{L}}')) >= 8 AND len(regexp_extract_all(p, '\\p{{Lu}}')) / len(regexp_extract_all(p, '\\p{{L}}')) > 0.8) AS n_caps,
  count(*) FILTER (WHERE own AND regexp_matches(p, '{_CREW}')) AS n_crew, count(*) FILTER (WHERE own AND regexp_matches(p, '^\\p{{Ll}}')) AS n_low, count(*) FILTER (WHERE bad) AS n_bad_hint FROM l GROUP BY 1)
SELECT q.*, coalesce(n_hints, 0) AS n_hints, coalesce(n_fragments, 0) AS n_fragments,
  concat_ws('|', CASE WHEN n_caps * 20 > n_own THEN 'all-caps' END, CASE WHEN n_crew * 100 > n_own * 15 THEN 'crew-voice' END, CASE WHEN coalesce(n_fragments, 0) * 2 > n_hints AND n_hints >= 4 THEN 'fragment hints' END) AS why
FROM q LEFT JOIN hs USING (dialogue_id)""",
}
