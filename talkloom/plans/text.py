"""Queries on text expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkloom.functions import numbers, text
from talkloom.sources.tables import table

KEY = ["dialogue_id", "event_idx"]


def _events(spark: SparkSession, folder: str) -> DataFrame:
    """Events once per key, in the latest delivery; combined before the shuffle."""
    cols = ["prediction", "hint", "current_spoken_ratio", "conversation_context", "channel", "timestamp_ms"]
    v = F.max_by(F.struct(*cols), F.struct("loaded_at", "load_id", F.coalesce("hint", F.lit("")), *[F.coalesce(c, F.lit(z)) for c, z in (("current_spoken_ratio", -1.0), ("channel", -1), ("prediction", ""), ("timestamp_ms", -1))]))
    return table(spark, folder, "oracle_raw").groupBy(*KEY).agg(v.alias("v")).select(*KEY, "v.*")


EVENTS_SQL = """
e AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY dialogue_id, event_idx ORDER BY loaded_at DESC, load_id DESC, coalesce(hint, '') DESC, coalesce(current_spoken_ratio, -1) DESC, coalesce(channel, -1) DESC, coalesce(prediction, '') DESC, coalesce(timestamp_ms, -1) DESC) AS rn FROM oracle_raw) WHERE rn = 1
)"""
_SPACE = text.SPACE
_CREW = f"trim(regexp_replace(regexp_replace(lower({{0}}), '[^\\p{{{{L}}}}\\p{{{{N}}}}_''{_SPACE.replace('{', '{{').replace('}', '}}')}]', ' ', 'g'), '[{_SPACE.replace('{', '{{').replace('}', '}}')}]+', ' ', 'g'))"


def f1_word_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Words with a letter, and a-z words, of every document."""
    return table(spark, folder, "documents").select("doc_id", text.n_words(F.col("text")).alias("n_words"), F.coalesce(F.size(text.plain_words(F.col("text"))), F.lit(0)).alias("n_plain"))


def f3_normal_forms(spark: SparkSession, folder: str) -> DataFrame:
    """Normal forms of the distinct predictions."""
    p = F.col("prediction")
    d = table(spark, folder, "oracle_raw").select("prediction").where(p.isNotNull()).distinct()
    return d.select("prediction", text.crew_form(p).alias("crew_form"), text.letters_only(p).alias("letters_only"), text.aligner_form(p).alias("aligner_form"))


def f6_reasons(spark: SparkSession, folder: str) -> DataFrame:
    """The ten most frequent forms of what a hint says, digits aside (ties by form)."""
    d = table(spark, folder, "oracle_raw").where(F.col("hint") != "").select(text.reason_form(F.col("hint")).alias("form"))
    return d.groupBy("form").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "form").limit(10)


def f7_contexts(spark: SparkSession, folder: str) -> DataFrame:
    """The last line of every relabelled context, and the length of the whole message with its hint block."""
    e = _events(spark, folder).where("conversation_context is not null")
    c = text.relabelled(F.col("conversation_context"))
    r = F.nanvl(F.col("current_spoken_ratio"), F.lit(None).cast("double"))
    h = F.coalesce(F.when(r.isNotNull(), text.hint_block(r, F.coalesce("hint", F.lit("")))), F.lit(""))
    e = e.withColumn("c", c).withColumn("m", text.user_message(F.col("c"), h))
    return e.select(*KEY, F.element_at(F.split("c", "\n"), -1).alias("last_line"), F.length("m").alias("message_length"), F.md5("m").alias("message_md5"))


def f10_prompt_levels(spark: SparkSession, folder: str) -> DataFrame:
    """Wording level of the prompt and fallback line, counted by level and channel."""
    r = F.col("current_spoken_ratio")
    e = _events(spark, folder).where(r.isNotNull() & ~F.isnan(r)).select("channel", text.prompt_level(r).alias("level"), (text.fallback_line(r, F.col("hint")) == "").alias("silent"))
    return e.groupBy("channel", "level").agg(F.count(F.lit(1)).alias("n"), F.count_if("silent").alias("n_silent"))


def f16_spoken(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct predictions with digits, in words."""
    d = table(spark, folder, "oracle_raw").where(F.col("prediction").rlike("[0-9]")).select("prediction").distinct()
    return d.select("prediction", numbers.spoken_numbers(F.col("prediction")).alias("spoken"))


def f17_numbers(spark: SparkSession, folder: str) -> DataFrame:
    """Numbers in documents, and their products with 1,009 below a million, in words and digit by digit, with their frequency."""
    d = table(spark, folder, "documents").select(F.explode(F.regexp_extract_all("text", F.lit(r"\b[0-9]{1,5}\b"), F.lit(0))).alias("number"))
    d = d.groupBy("number").agg(F.count(F.lit(1)).alias("n")).withColumn("k", F.col("number").cast("int"))
    return d.select("number", "n", text.number_words(F.col("k")).alias("cardinal"), text.number_words(F.col("k") * 1009 % 1_000_000).alias("large"), text.digit_words(F.col("number")).alias("digits"))


def f21_voices(spark: SparkSession, folder: str) -> DataFrame:
    """Voices with gender, origin and tier told from a description, which is made of id and role."""
    v = table(spark, folder, "voices")
    n = F.regexp_extract("voice_id", "([0-9]+)", 1).cast("int")
    d = F.concat(F.when(n % 2 == 0, "Female, ").otherwise("Man, "), F.get(F.array(*[F.lit(x) for x in ("British", "Canadian American", "French", "Australian")]), n % 4), F.lit(" "), F.col("voice_role"))
    return v.select("voice_id", text.voice_fields(d, F.when(n % 3 > 0, F.col("tier"))).alias("f")).select("voice_id", "f.*")


def f18_embedded(spark: SparkSession, folder: str) -> DataFrame:
    """A model's reply, made of an event, taken apart again; with templates, tags and token limits."""
    e = _events(spark, folder)
    reply = F.concat(F.lit("<think>{no}</think> Sure: "), F.to_json(F.struct(F.col("event_idx").alias("i"), F.col("prediction").alias("p"))), F.lit(" done"))
    j = F.from_json(text.embedded_json(reply), "i int, p string")
    t = text.filled("{{who}} says {{n}} words", {"who": F.when(F.col("channel") == 0, "passenger").otherwise("crew"), "n": text.n_words(F.col("prediction"))})
    return e.select(*KEY, j["i"].alias("i"), j["p"].alias("p"), text.tagged(t).alias("brief"), text.most_tokens(text.n_words(F.col("prediction"))).alias("most_tokens"))


def pred_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Per event: shouting, crew cues, and the rule that a hint goes with a ratio above a half."""
    p, r = F.col("prediction"), F.col("current_spoken_ratio")
    gate = (F.coalesce(F.nanvl(r, F.lit(0.0)), F.lit(0.0)) > 0.5) != (F.coalesce("hint", F.lit("")) != "")
    return _events(spark, folder).select(*KEY, text.shouts(p).alias("shouts"), text.sounds_like_crew(p).alias("crew_cue"), gate.alias("bad_hint"))


QUERIES = {
    "f1_word_counts": f1_word_counts, "f3_normal_forms": f3_normal_forms, "f6_reasons": f6_reasons, "f7_contexts": f7_contexts, "f10_prompt_levels": f10_prompt_levels,
    "f16_spoken": f16_spoken, "f17_numbers": f17_numbers, "f21_voices": f21_voices, "f18_embedded": f18_embedded, "pred_lines": pred_lines,
}

_Q = lambda s: s.replace("'", "''")
_LIST = lambda xs: "[" + ", ".join(f"'{x}'" for x in xs) + "]"
_NWORDS = f"len(regexp_extract_all(coalesce({{0}}, ''), '[^{_SPACE}]*\\p{{{{L}}}}[^{_SPACE}]*'))".replace("\\p{Z}", "\\p{{Z}}")
_LEVEL = "CASE WHEN r <= 0.5 THEN 0 WHEN r <= 0.65 THEN 1 WHEN r <= 0.8 THEN 2 WHEN r <= 0.95 THEN 3 WHEN r <= 0.99 THEN 4 ELSE 5 END"
_CARD = f"CASE WHEN k < 20 THEN ({_LIST(text.ONES)})[k + 1] ELSE ({_LIST(text.TENS)})[k // 10 - 1] || CASE WHEN k % 10 > 0 THEN '-' || ({_LIST(text.ONES)})[k % 10 + 1] ELSE '' END END"

SQL = {
    "f1_word_counts": f"SELECT doc_id, {_NWORDS.format('text')} AS n_words, len(regexp_extract_all(lower(coalesce(text, '')), '[a-z'']+')) AS n_plain FROM documents",
    "f3_normal_forms": f"""SELECT DISTINCT prediction, {_CREW.format('prediction')} AS crew_form, regexp_replace(lower(prediction), '[^\\p{{L}}\\p{{N}}'']', '', 'g') AS letters_only,
regexp_replace(replace(lower(prediction), '’', ''''), '[^a-z'']', '', 'g') AS aligner_form FROM oracle_raw WHERE prediction IS NOT NULL""",
    "f6_reasons": """SELECT left(regexp_replace(regexp_replace(hint, '\\[[^\\]]*\\]', '[..]', 'g'), '[0-9]+(\\.[0-9]+)?', '#', 'g'), 90) AS form, count(*) AS n
FROM oracle_raw WHERE hint <> '' GROUP BY 1 ORDER BY n DESC, form LIMIT 10""",
    "f7_contexts": f"""
WITH {EVENTS_SQL}, c AS (
  SELECT dialogue_id, event_idx, hint, CASE WHEN NOT isnan(current_spoken_ratio) THEN current_spoken_ratio END AS r,
    list_transform(string_split(conversation_context, chr(10)), lambda x: CASE WHEN NOT contains(x, ':') THEN x
      WHEN trim(split_part(x, ':', 1)) = 'B' THEN 'crew: ' || {_CREW.format("substr(x, instr(x, ':') + 1)")}
      WHEN trim(split_part(x, ':', 1)) = 'A' THEN 'passenger:' || substr(x, instr(x, ':') + 1)
      ELSE trim(split_part(x, ':', 1)) || ':' || substr(x, instr(x, ':') + 1) END) AS ls
  FROM e WHERE conversation_context IS NOT NULL
), m AS (
  SELECT dialogue_id, event_idx, ls[-1] AS last_line,
    array_to_string(list_filter(list_transform(ls, lambda x: regexp_replace(x, '[{_SPACE}]+$', '')), lambda x: x <> ''), chr(10))
    || CASE WHEN r IS NULL OR r <= 0.5 THEN '' ELSE chr(10) || chr(10) || '(Hidden hint, never mention it: the passenger''s next words will be similar to: "' || coalesce(hint, '') || '". '
      || CASE WHEN r <= 0.65 THEN '{_Q(text.HINT_LEVELS[0][1])}' WHEN r <= 0.8 THEN '{_Q(text.HINT_LEVELS[1][1])}' ELSE '{_Q(text.HINT_LEVELS[2][1])}' END || ')' END
    || '{_Q(text.TAIL)}' AS m
  FROM c
)
SELECT dialogue_id, event_idx, last_line, length(m) AS message_length, md5(m) AS message_md5 FROM m""",
    "f10_prompt_levels": f"""WITH {EVENTS_SQL}, l AS (SELECT channel, {_LEVEL.replace('r <=', 'current_spoken_ratio <=')} AS level, current_spoken_ratio <= 0.5 OR hint = '' AS silent
FROM e WHERE current_spoken_ratio IS NOT NULL AND NOT isnan(current_spoken_ratio))
SELECT channel, level, count(*) AS n, count(*) FILTER (WHERE silent) AS n_silent FROM l GROUP BY channel, level""",
    "f17_numbers": f"""
WITH n AS (SELECT unnest(regexp_extract_all(text, '\\b[0-9]{{1,5}}\\b')) AS number FROM documents), c AS (SELECT number, CAST(number AS INT) AS v, count(*) AS n FROM n GROUP BY ALL),
w AS (SELECT k, {_CARD} AS w FROM (SELECT unnest(range(100)) AS k)),
h AS (SELECT x.k, CASE WHEN x.k = 0 THEN '' ELSE trim(CASE WHEN x.k >= 100 THEN ({_LIST(text.ONES)})[x.k // 100 + 1] || ' hundred ' ELSE '' END || CASE WHEN x.k % 100 > 0 THEN w.w ELSE '' END) END AS t FROM (SELECT unnest(range(1000)) AS k) x JOIN w ON w.k = x.k % 100)
SELECT number, n, CASE WHEN v = 0 THEN 'zero' ELSE trim(CASE WHEN v >= 1000 THEN a.t || ' thousand ' ELSE '' END || b.t) END AS cardinal,
  CASE WHEN v * 1009 % 1000000 = 0 THEN 'zero' ELSE trim(CASE WHEN v * 1009 % 1000000 >= 1000 THEN y.t || ' thousand ' ELSE '' END || z.t) END AS large,
  array_to_string(list_transform(string_split(number, ''), lambda q: ({_LIST(text.ONES)})[CAST(q AS INT) + 1]), ' ') AS digits
FROM c JOIN h a ON a.k = v // 1000 JOIN h b ON b.k = v % 1000 JOIN h y ON y.k = v * 1009 % 1000000 // 1000 JOIN h z ON z.k = v * 1009 % 1000""",
    "f21_voices": """WITH v AS (SELECT *, CAST(regexp_extract(voice_id, '([0-9]+)', 1) AS INT) AS n FROM voices)
SELECT voice_id, CASE WHEN n % 2 = 0 THEN 'female' ELSE 'male' END AS gender, (['gb', 'us', 'intl', 'au'])[n % 4 + 1] AS origin, coalesce(CASE WHEN n % 3 > 0 THEN tier END, 'pool') AS tier FROM v""",
    "f18_embedded": f"""
WITH {EVENTS_SQL}, w AS (SELECT *, {_NWORDS.format('prediction')} AS nw FROM e)
SELECT dialogue_id, event_idx, event_idx AS i, prediction AS p,
  '<system> ' || CASE WHEN channel = 0 THEN 'passenger' ELSE 'crew' END || ' says ' || nw || ' words <system>' AS brief, CAST(floor(12.5 * (nw + 3)) AS INT) AS most_tokens FROM w""",
    "pred_lines": f"""
WITH {EVENTS_SQL}, l AS (SELECT *, len(regexp_extract_all(coalesce(prediction, ''), '\\p{{L}}')) AS nl, len(regexp_extract_all(coalesce(prediction, ''), '\\p{{Lu}}')) AS nu FROM e)
SELECT dialogue_id, event_idx, nl >= 8 AND nu / nl > 0.8 AS shouts, coalesce(regexp_matches(prediction, '{_Q(text.CREW_CUES)}'), false) AS crew_cue,
  (coalesce(CASE WHEN isnan(current_spoken_ratio) THEN 0 ELSE current_spoken_ratio END, 0) > 0.5) <> (coalesce(hint, '') <> '') AS bad_hint FROM l""",
}
