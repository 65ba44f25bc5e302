"""Queries on word-aligned speech."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkloom.operators import speech
from talkloom.operators.blocks import neighbour, numbered
from talkloom.plans.text import EVENTS_SQL, _events
from talkloom.session import checkpointed
from talkloom.sources.tables import table


def _words(spark: SparkSession, folder: str) -> DataFrame:
    """Clean words, written once, as most queries go over them several times."""
    return checkpointed(speech.clean_words(table(spark, folder, "words")))


def n1_switches(spark: SparkSession, folder: str) -> DataFrame:
    """Words and speaker switches per dialogue."""
    return speech.switches(_words(spark, folder))


def n2_stretches(spark: SparkSession, folder: str) -> DataFrame:
    """Stretches of speech per speaker."""
    return speech.stretches(_words(spark, folder))


def n3_overlap(spark: SparkSession, folder: str) -> DataFrame:
    """Overlap report per dialogue."""
    return speech.overlap_report(_words(spark, folder))


def n4_timeline(spark: SparkSession, folder: str) -> DataFrame:
    """Turns with the latest end before them."""
    return speech.timeline(speech.turns(_words(spark, folder)))


def n5_end_of_run(spark: SparkSession, folder: str) -> DataFrame:
    """Per event, whether the next event is on another channel or there is none."""
    e = _events(spark, folder).select("dialogue_id", "event_idx", "channel").withColumn("block", F.floor(F.col("event_idx") / speech.LIST_BLOCK))
    e = e.withColumn("ch", F.coalesce("channel", F.lit(-1)))
    e = neighbour(e, ["dialogue_id"], "block", ["event_idx"], ["ch"], after=True, prefix="next_")
    return e.select("dialogue_id", "event_idx", F.coalesce(F.col("next_ch") != F.col("ch"), F.lit(True)).alias("end_of_run"))


def n12_pauses(spark: SparkSession, folder: str) -> DataFrame:
    """Where a turn could be cut: the end of the word before its longest pause."""
    return speech.pauses_in_turns(_words(spark, folder))


def n13_frames(spark: SparkSession, folder: str) -> DataFrame:
    """Placement of words on the frame grid, summed up per speaker."""
    p = speech.placed(_words(spark, folder))
    kept = ~F.col("dropped")
    return p.groupBy("dialogue_id", "speaker").agg(
        F.count(F.lit(1)).alias("n_words"), F.count_if("dropped").alias("n_dropped"), F.count_if(kept & F.col("end_pad")).alias("n_end_pads"),
        F.max(F.when(kept, F.col("frame"))).alias("last_frame"), F.sum(F.when(kept, F.col("frame"))).alias("sum_frames"),
    )


def o3_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """Characters of words on the frame grid, summed up per speaker."""
    p = speech.placed(speech.pieces(_words(spark, folder)), ("word_idx", "piece_idx"))
    kept = ~F.col("dropped")
    return p.groupBy("dialogue_id", "speaker").agg(F.count(F.lit(1)).alias("n_pieces"), F.count_if("dropped").alias("n_dropped"), F.count_if(kept & F.col("end_pad")).alias("n_end_pads"), F.sum(F.when(kept, F.col("frame"))).alias("sum_frames"))


def n15_rotation(spark: SparkSession, folder: str) -> DataFrame:
    """Dialogues in rotation of voices inside a category: the round each is in."""
    d = table(spark, folder, "dialogues").select("dialogue_id", F.coalesce("category", F.lit("?")).alias("category"), F.coalesce("passenger_voice_id", F.lit("?")).alias("voice"))
    # Blocks in the order of the ids: their first seven bytes as a number.
    d = d.withColumn("block", F.conv(F.hex(F.rpad(F.substring("dialogue_id", 1, 7), 7, " ")), 16, 10).cast("bigint"))
    return numbered(d, ["category", "voice"], "block", ["dialogue_id"], "round").drop("block")


def a18_histogram(spark: SparkSession, folder: str) -> DataFrame:
    """Histogram of switches per 100 words in steps of five up to 60, with the share of crosstalk."""
    r = n3_overlap(spark, folder)
    step = F.least(F.floor(F.col("n_switches") * 100 / F.col("n_words") / 5) * 5, F.lit(60)).cast("bigint")
    return r.groupBy(step.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.count_if("flag").alias("n_flagged"))


def a19_short_turns(spark: SparkSession, folder: str) -> DataFrame:
    """Share of crosstalk by the number of one-word turns (20 and more together)."""
    t = speech.turns(_words(spark, folder)).groupBy("dialogue_id").agg(F.least(F.count_if(F.col("n_words") == 1), F.lit(20)).alias("n_short"))
    return t.join(n3_overlap(spark, folder), "dialogue_id").groupBy("n_short").agg(F.count(F.lit(1)).alias("n"), F.count_if("flag").alias("n_flagged"))


def k2_worst(spark: SparkSession, folder: str) -> DataFrame:
    """The ten dialogues with most switches per word."""
    r = n1_switches(spark, folder)
    return r.orderBy((F.col("n_switches") / F.col("n_words")).desc(), "dialogue_id").limit(10)


def u1_streams(spark: SparkSession, folder: str) -> DataFrame:
    """Both speakers' words merged into one stream by end, A first where they end together."""
    w = _words(spark, folder).withColumn("block", F.floor(F.col("end_ms") / speech.BLOCK_MS))
    return numbered(w, ["dialogue_id"], "block", ["end_ms", "speaker", "word_idx"], "place").select("dialogue_id", "word_idx", "place")


QUERIES = {
    f.__name__: f
    for f in (n1_switches, n2_stretches, n3_overlap, n4_timeline, n5_end_of_run, n12_pauses, n13_frames, o3_pieces, n15_rotation, a18_histogram, a19_short_turns, k2_worst, u1_streams)
}

WORDS_SQL = """
w AS (
  SELECT dialogue_id, word_idx, speaker, coalesce(word, '') AS word, CAST(round("start" * 1000) AS BIGINT) AS s, CAST(round("end" * 1000) AS BIGINT) AS e
  FROM words WHERE speaker IN ('A', 'B') AND "start" IS NOT NULL AND "end" IS NOT NULL AND NOT isnan("start") AND NOT isnan("end") AND "end" >= "start"
  QUALIFY row_number() OVER (PARTITION BY dialogue_id, word_idx ORDER BY loaded_at DESC, "start" DESC, "end" DESC, speaker DESC, word DESC) = 1
)"""
_SWITCH = """
sw AS (
  SELECT dialogue_id, count(*) AS n_words, count(*) FILTER (WHERE p <> speaker) AS n_switches
  FROM (SELECT *, lag(speaker) OVER (PARTITION BY dialogue_id ORDER BY s, speaker, word_idx) AS p FROM w) GROUP BY dialogue_id
)"""
_STRETCH = """
g AS (SELECT *, max(e) OVER (PARTITION BY dialogue_id, speaker ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM w),
i AS (SELECT *, sum(CASE WHEN s - p <= 300 THEN 0 ELSE 1 END) OVER (PARTITION BY dialogue_id, speaker ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS k FROM g),
st AS (SELECT dialogue_id, speaker, min(s) AS s, max(e) AS e FROM i GROUP BY dialogue_id, speaker, k)"""
_REPORT = f"""{_SWITCH}, {_STRETCH},
ov AS (SELECT a.dialogue_id, sum(least(a.e, b.e) - greatest(a.s, b.s)) AS both_ms FROM st a JOIN st b ON a.dialogue_id = b.dialogue_id AND a.speaker = 'A' AND b.speaker = 'B' AND a.s < b.e AND b.s < a.e GROUP BY 1),
tot AS (SELECT dialogue_id, coalesce(sum(e - s) FILTER (WHERE speaker = 'A'), 0) AS a_ms, coalesce(sum(e - s) FILTER (WHERE speaker = 'B'), 0) AS b_ms FROM st GROUP BY 1),
rep AS (
  SELECT sw.*, a_ms, b_ms, coalesce(both_ms, 0) AS both_ms, n_switches * 100 > n_words * 25.0::DOUBLE OR coalesce(both_ms, 0) > (a_ms + b_ms - coalesce(both_ms, 0)) * 0.2::DOUBLE AS flag
  FROM sw JOIN tot USING (dialogue_id) LEFT JOIN ov USING (dialogue_id)
)"""
_TURNS = """
tw AS (SELECT *, sum(c) OVER (PARTITION BY dialogue_id ORDER BY word_idx ROWS UNBOUNDED PRECEDING) AS turn_no
  FROM (SELECT *, CASE WHEN lag(speaker) OVER (PARTITION BY dialogue_id ORDER BY word_idx) <> speaker THEN 1 ELSE 0 END AS c FROM w)),
t AS (SELECT dialogue_id, turn_no, speaker, min(word_idx) AS first_idx, count(*) AS n_words, min(s) AS start_ms, max(e) AS end_ms FROM tw GROUP BY dialogue_id, turn_no, speaker)"""

SQL = {
    "n1_switches": f"WITH {WORDS_SQL}, {_SWITCH} SELECT * FROM sw",
    "n2_stretches": f"WITH {WORDS_SQL}, {_STRETCH} SELECT dialogue_id, speaker, s AS period_start_ms, e AS period_end_ms FROM st",
    "n3_overlap": f"WITH {WORDS_SQL}, {_REPORT} SELECT * FROM rep",
    "n4_timeline": f"""WITH {WORDS_SQL}, {_TURNS}, r AS (SELECT *, max(end_ms) OVER (PARTITION BY dialogue_id ORDER BY turn_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach_ms FROM t)
SELECT dialogue_id, CAST(turn_no AS BIGINT) AS turn_no, speaker, first_idx, n_words, start_ms, end_ms, reach_ms, greatest(coalesce(reach_ms - start_ms, 0), 0) AS early_ms FROM r""",
    "n5_end_of_run": f"""WITH {EVENTS_SQL} SELECT dialogue_id, event_idx,
coalesce(lead(coalesce(channel, -1)) OVER (PARTITION BY dialogue_id ORDER BY event_idx) <> coalesce(channel, -1), true) AS end_of_run FROM e""",
    "n12_pauses": f"""WITH {WORDS_SQL}, {_TURNS},
g AS (SELECT tw.*, lead(s) OVER (PARTITION BY dialogue_id, turn_no ORDER BY word_idx) AS ns FROM tw),
c AS (SELECT g.dialogue_id, g.turn_no, g.word_idx, g.e, ns - g.e AS gap, (g.e + ns) / 2 - t.start_ms AS place, t.end_ms - t.start_ms AS n FROM g JOIN t USING (dialogue_id, turn_no) WHERE ns - g.e > 80)
SELECT dialogue_id, CAST(turn_no AS BIGINT) AS turn_no, e AS pause_ms, gap AS gap_ms FROM c WHERE place >= 0.30::DOUBLE * n AND place <= 0.85::DOUBLE * n
QUALIFY row_number() OVER (PARTITION BY dialogue_id, turn_no ORDER BY gap DESC, word_idx) = 1""",
    "n13_frames": f"""WITH {WORDS_SQL},
a AS (SELECT *, CAST(round((s / 1000 - (s / 1000) % 0.08::DOUBLE) / 0.08::DOUBLE) AS BIGINT) AS slot, row_number() OVER o AS rn, last_value(e) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_ms
  FROM w WINDOW o AS (PARTITION BY dialogue_id, speaker ORDER BY s, word_idx)),
b AS (SELECT *, rn + max(slot - rn) OVER (PARTITION BY dialogue_id, speaker ORDER BY s, word_idx ROWS UNBOUNDED PRECEDING) AS frame, floor((last_ms / 1000 + 1) * 12.5) AS size FROM a),
c AS (SELECT *, frame >= size AS dropped, frame > 0 AND coalesce(lag(frame) OVER (PARTITION BY dialogue_id, speaker ORDER BY s, word_idx), -1) < frame - 1 AS end_pad FROM b)
SELECT dialogue_id, speaker, count(*) AS n_words, count(*) FILTER (WHERE dropped) AS n_dropped, count(*) FILTER (WHERE NOT dropped AND end_pad) AS n_end_pads,
  max(frame) FILTER (WHERE NOT dropped) AS last_frame, CAST(sum(frame) FILTER (WHERE NOT dropped) AS BIGINT) AS sum_frames FROM c GROUP BY dialogue_id, speaker""",
    "o3_pieces": f"""WITH {WORDS_SQL},
pc AS (SELECT *, unnest(range(greatest(length(word), 1))) AS k, greatest(length(word), 1) AS n FROM w),
pt AS (SELECT dialogue_id, speaker, word_idx, k, s + (e - s) * k / n AS ps, s + (e - s) * (k + least(length(word), 1)) / n AS pe FROM pc),
a AS (SELECT *, CAST(round((ps / 1000 - (ps / 1000) % 0.08::DOUBLE) / 0.08::DOUBLE) AS BIGINT) AS slot, row_number() OVER o AS rn, last_value(pe) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_ms
  FROM pt WINDOW o AS (PARTITION BY dialogue_id, speaker ORDER BY ps, word_idx, k)),
b AS (SELECT *, rn + max(slot - rn) OVER (PARTITION BY dialogue_id, speaker ORDER BY ps, word_idx, k ROWS UNBOUNDED PRECEDING) AS frame, floor((last_ms / 1000 + 1) * 12.5) AS size FROM a),
c AS (SELECT *, frame >= size AS dropped, frame > 0 AND coalesce(lag(frame) OVER (PARTITION BY dialogue_id, speaker ORDER BY ps, word_idx, k), -1) < frame - 1 AS end_pad FROM b)
SELECT dialogue_id, speaker, count(*) AS n_pieces, count(*) FILTER (WHERE dropped) AS n_dropped, count(*) FILTER (WHERE NOT dropped AND end_pad) AS n_end_pads,
  CAST(sum(frame) FILTER (WHERE NOT dropped) AS BIGINT) AS sum_frames FROM c GROUP BY dialogue_id, speaker""",
    "n15_rotation": """SELECT dialogue_id, coalesce(category, '?') AS category, coalesce(passenger_voice_id, '?') AS voice,
row_number() OVER (PARTITION BY coalesce(category, '?'), coalesce(passenger_voice_id, '?') ORDER BY dialogue_id) AS round FROM dialogues""",
    "a18_histogram": f"WITH {WORDS_SQL}, {_REPORT} SELECT CAST(least(floor(n_switches * 100 / n_words / 5) * 5, 60) AS BIGINT) AS bin, count(*) AS n, count(*) FILTER (WHERE flag) AS n_flagged FROM rep GROUP BY 1",
    "a19_short_turns": f"""WITH {WORDS_SQL}, {_REPORT}, {_TURNS}, n AS (SELECT dialogue_id, least(count(*) FILTER (WHERE n_words = 1), 20) AS n_short FROM t GROUP BY 1)
SELECT n_short, count(*) AS n, count(*) FILTER (WHERE flag) AS n_flagged FROM n JOIN rep USING (dialogue_id) GROUP BY 1""",
    "k2_worst": f"WITH {WORDS_SQL}, {_SWITCH} SELECT * FROM sw ORDER BY n_switches / n_words DESC, dialogue_id LIMIT 10",
    "u1_streams": f"WITH {WORDS_SQL} SELECT dialogue_id, word_idx, row_number() OVER (PARTITION BY dialogue_id ORDER BY e, speaker, word_idx) AS place FROM w",
}
