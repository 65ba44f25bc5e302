"""Queries of the corpus reports: breakdowns, order statistics, joins of tables, samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talkloom.functions import arrays
from talkloom.operators import intervals, reports
from talkloom.plans.text import EVENTS_SQL, _events
from talkloom.sources import files
from talkloom.sources.tables import table

#: What-if grid: least similarity, largest spread, largest drop (in thousandths).
GRID = [(780, 120, 60), (720, 180, 100), (650, 250, 150), (500, 500, 300), (0, 2000, 2000)]
SAMPLE = 3
SEED = "7"
WEIGHTS = [("none", 5), ("mild", 3), ("strong", 2), ("never", 0)]


def _dialogues(spark: SparkSession, folder: str) -> DataFrame:
    d = table(spark, folder, "dialogues")
    return d.withColumn("seconds", F.when((F.col("duration_s") > 0) & ~F.isnan("duration_s"), F.col("duration_s")))


def a2_corpus(spark: SparkSession, folder: str) -> DataFrame:
    """Number, length and extremes of the dialogues with a duration."""
    d = _dialogues(spark, folder).withColumn("ms", F.round(F.col("seconds") * 1000).cast("bigint"))
    return d.agg(F.count("ms").alias("n"), F.sum("ms").alias("total_ms"), F.min("ms").alias("least_ms"), F.max("ms").alias("most_ms"), F.count_if(F.col("ms") < 20_000).alias("n_short"), F.count_if(F.col("ms") > 180_000).alias("n_long"))


def a3_crosstab(spark: SparkSession, folder: str) -> DataFrame:
    """Dialogues by category and language, those with words and all."""
    d = _dialogues(spark, folder).withColumn("category", F.coalesce("category", F.lit("?")))
    one = lambda g: [F.count_if(F.col("lang") == g).alias(g), F.count_if((F.col("lang") == g) & (F.col("stage") == "aligned")).alias(f"{g}_aligned")]
    return d.groupBy("category").agg(*[c for g in ("en", "de", "fr", "es") for c in one(g)])


def a4_breakdown(spark: SparkSession, folder: str) -> DataFrame:
    """Dialogues by every key in one pass."""
    d = _dialogues(spark, folder)
    keys = {c: F.col(c) for c in ("lang", "stage", "category", "passenger_voice_id", "crew_voice_id")}
    return reports.breakdown(d, keys, {"n_aligned": F.col("stage") == "aligned", "n_long": F.coalesce(F.col("seconds") > 180, F.lit(False))})


def a22_languages(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct languages of each category in order, as one text."""
    d = _dialogues(spark, folder).select(F.coalesce("category", F.lit("?")).alias("category"), F.coalesce("lang", F.lit("None")).alias("lang")).distinct()
    return d.groupBy("category").agg(F.array_join(F.array_sort(F.collect_list("lang")), "|").alias("langs"))


def a24_means(spark: SparkSession, folder: str) -> DataFrame:
    """Mean ratio per load without NaN, in millionths."""
    r = F.nanvl(F.col("current_spoken_ratio"), F.lit(None).cast("double"))
    return table(spark, folder, "oracle_raw").groupBy("load_id").agg(F.round(F.avg(r.cast("decimal(18,6)")), 6).cast("double").alias("mean_ratio"), F.count(r).alias("n"))


def _sims(spark: SparkSession, folder: str) -> DataFrame:
    """Similarity (in thousandths) of each vector with the medoid of its label; bucket and dialogue from the id."""
    v = table(spark, folder, "embeddings")
    m = reports.medoids(v, "label", "vec_id", "embedding").select("label", F.col("embedding").alias("m"))
    sim = F.floor(arrays.dot(F.col("embedding"), F.col("m")) * 1000).cast("bigint")
    return v.join(m, "label").select("vec_id", "label", (F.col("vec_id") % 4).alias("bucket"), (F.col("vec_id") % 50).alias("dialogue"), sim.alias("sim"))


def j13_medoids(spark: SparkSession, folder: str) -> DataFrame:
    """The most central vector of each label."""
    return reports.medoids(table(spark, folder, "embeddings"), "label", "vec_id", "embedding").select("label", "vec_id")


def a5_voices(spark: SparkSession, folder: str) -> DataFrame:
    """Per label: sums of similarity of calm and other rows."""
    s, calm = _sims(spark, folder), F.col("bucket") == 0
    return s.groupBy("label").agg(F.count_if(calm).alias("n_calm"), F.sum(F.when(calm, F.col("sim"))).alias("calm_sum"), F.count_if(~calm).alias("n_other"), F.sum(F.when(~calm, F.col("sim"))).alias("other_sum"))


def a6_worst(spark: SparkSession, folder: str) -> DataFrame:
    """The three least similar vectors of each label."""
    s = reports.top_per_key(_sims(spark, folder), ["label"], [F.col("sim"), F.col("vec_id")], 3, F.xxhash64("vec_id"))
    return s.select("label", "rank", "vec_id", "sim")


def a7_p10(spark: SparkSession, folder: str) -> DataFrame:
    """Per label the similarity at place max(0, n // 10 - 1)."""
    return reports.order_stat(_sims(spark, folder), ["label"], "sim", F.greatest(F.lit(0), F.floor(F.col("n") / 10) - 1))


def a8_p10(spark: SparkSession, folder: str) -> DataFrame:
    """Per bucket the similarity at place n // 10, and how many are below 0.78."""
    s = _sims(spark, folder)
    low = s.groupBy("bucket").agg(F.count_if(F.col("sim") < 780).alias("n_below"))
    return reports.order_stat(s, ["bucket"], "sim", F.floor(F.col("n") / 10)).join(low, "bucket")


def a9_median(spark: SparkSession, folder: str) -> DataFrame:
    """Per label the upper median."""
    return reports.order_stat(_sims(spark, folder), ["label"], "sim", F.floor(F.col("n") / 2))


def _metrics(spark: SparkSession, folder: str) -> DataFrame:
    s, calm = _sims(spark, folder), F.col("bucket") == 0
    mean = lambda c: F.floor(F.sum(F.when(c, F.col("sim"))) / F.count_if(c))
    return s.groupBy("dialogue").agg(
        F.count(F.lit(1)).alias("n"), F.min("sim").alias("least"), (F.max("sim") - F.min("sim")).alias("spread"),
        F.coalesce(mean(calm) - mean(~calm), F.lit(0)).cast("bigint").alias("drop"), F.min_by("vec_id", F.struct("sim", "vec_id")).alias("worst"),
    )


def a12_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Per dialogue: number, least, spread and drop of similarity, and the vector with the least."""
    return _metrics(spark, folder)


def a13_violations(spark: SparkSession, folder: str) -> DataFrame:
    """Dialogues by the first rule of the strict thresholds that they break."""
    a, b, c = GRID[0]
    rule = F.when(F.col("least") < a, "least").when(F.col("spread") > b, "spread").when(F.col("drop") > c, "drop").otherwise("none")
    return _metrics(spark, folder).groupBy(rule.alias("rule")).agg(F.count(F.lit(1)).alias("n"))


def a16_thresholds(spark: SparkSession, folder: str) -> DataFrame:
    """Per label, how many dialogues pass under the strict and under the loose thresholds."""
    m = _sims(spark, folder).groupBy("label", "dialogue").agg(F.min("sim").alias("least"), (F.max("sim") - F.min("sim")).alias("spread"))
    ok = lambda g: (F.col("least") >= GRID[g][0]) & (F.col("spread") <= GRID[g][1])
    return m.groupBy("label").agg(F.count_if(ok(0)).alias("strict"), F.count_if(ok(2)).alias("loose"), F.count(F.lit(1)).alias("n"))


def pred_drops(spark: SparkSession, folder: str) -> DataFrame:
    """Why a dialogue is dropped, the first rule that applies: no language, a listed voice, no duration."""
    d = _dialogues(spark, folder)
    why = F.when(F.col("lang").isNull(), "language").when(F.col("passenger_voice_id").isin("pax_01", "pax_02"), "voice").when(F.col("seconds").isNull(), "duration")
    return d.select("dialogue_id", why.alias("why")).where("why is not null")


def j12_what_if(spark: SparkSession, folder: str) -> DataFrame:
    """How many dialogues would pass under each row of a grid of thresholds; the grid is an array in each row, no join."""
    grid = F.array(*[F.struct(F.lit(i).alias("row"), F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(c).alias("c")) for i, (a, b, c) in enumerate(GRID)])
    m = _metrics(spark, folder).select("*", F.explode(grid).alias("g"))
    ok = (F.col("least") >= F.col("g.a")) & (F.col("spread") <= F.col("g.b")) & (F.col("drop") <= F.col("g.c"))
    return m.groupBy(F.col("g.row").alias("grid_row")).agg(F.count_if(ok).alias("n_passed"), F.count(F.lit(1)).alias("n"))


def j10_nearest(spark: SparkSession, folder: str) -> DataFrame:
    """For every label and wanted value 0 to 9, the vector whose id's last digit is nearest (ties to the smaller digit, then id)."""
    v = table(spark, folder, "embeddings").groupBy("label", (F.col("vec_id") % 10).alias("digit")).agg(F.min("vec_id").alias("vec_id"))
    v = v.select("*", F.explode(F.sequence(F.lit(0), F.lit(9))).alias("wanted"))
    return v.groupBy("label", "wanted").agg(F.min_by("vec_id", F.struct(F.abs(F.col("digit") - F.col("wanted")), F.col("digit"))).alias("vec_id"))


def _ids(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return table(spark, folder, name).select("dialogue_id").where("dialogue_id is not null").distinct()


def j1_complete(spark: SparkSession, folder: str) -> DataFrame:
    """Dialogues that have words, events and a document."""
    d = table(spark, folder, "dialogues").select("dialogue_id", "lang")
    for t in ("words", "oracle_raw", "documents"):
        d = d.join(_ids(spark, folder, t), "dialogue_id", "left_semi")
    return d


def j2_missing(spark: SparkSession, folder: str) -> DataFrame:
    """Dialogues without words, without events and without documents, and the other way round ids that no dialogue has."""
    d = _ids(spark, folder, "dialogues")
    out = None
    for t in ("words", "oracle_raw", "documents", "raw_words"):
        for left, right, what in ((d, _ids(spark, folder, t), f"no {t}"), (_ids(spark, folder, t), d, f"only {t}")):
            one = left.join(right, "dialogue_id", "left_anti").select("dialogue_id", F.lit(what).alias("missing"))
            out = one if out is None else out.unionByName(one)
    return out


def _status(spark: SparkSession, folder: str) -> DataFrame:
    d = table(spark, folder, "dialogues").select("dialogue_id", "category")
    return reports.first_match(d, "dialogue_id", {n: _ids(spark, folder, t) for n, t in (("evented", "oracle_raw"), ("aligned", "words"), ("raw", "raw_words"), ("text only", "documents"))}, "nothing")


def j4_status(spark: SparkSession, folder: str) -> DataFrame:
    """The status of every dialogue: the first of four tables that has it."""
    return _status(spark, folder).select("dialogue_id", "status")


def a1_funnel(spark: SparkSession, folder: str) -> DataFrame:
    """Number and percentage of dialogues by status, all statuses in their order, '-' without dialogues."""
    return reports.funnel(_status(spark, folder), "status", ["evented", "aligned", "raw", "text only", "nothing"])


def a14_lenient(spark: SparkSession, folder: str) -> DataFrame:
    """The first strict threshold that a dialogue breaks, where dialogues without scores pass; of 60 dialogues, ten without."""
    a, b, c = GRID[0]
    m = spark.range(60).select(F.col("id").alias("dialogue")).join(_metrics(spark, folder), "dialogue", "left")
    rule = F.when(F.col("n").isNull(), "passes").when(F.col("least") < a, "least").when(F.col("spread") > b, "spread").when(F.col("drop") > c, "drop").otherwise("passes")
    return m.select("dialogue", rule.alias("rule"))


def a15_skipping(spark: SparkSession, folder: str) -> DataFrame:
    """How many dialogues pass under each row of the grid if rows of bucket 3 (short turns) are skipped, or not; dialogues without rows left pass."""
    s, calm = _sims(spark, folder), F.col("bucket") == 0
    s = s.select("*", F.explode(F.array(F.lit(False), F.lit(True))).alias("skipping"))
    kept = lambda x: F.when(~F.col("skipping") | (F.col("bucket") != 3), x)
    mean = lambda c: F.floor(F.sum(kept(F.when(c, F.col("sim")))) / F.count(kept(F.when(c, F.col("sim")))))
    sim = kept(F.col("sim"))
    m = s.groupBy("dialogue", "skipping").agg(F.min(sim).alias("least"), (F.max(sim) - F.min(sim)).alias("spread"), F.coalesce(mean(calm) - mean(~calm), F.lit(0)).alias("drop"))
    grid = F.array(*[F.struct(F.lit(i).alias("row"), F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(c).alias("c")) for i, (a, b, c) in enumerate(GRID)])
    m = m.select("*", F.explode(grid).alias("g"))
    ok = F.col("least").isNull() | ((F.col("least") >= F.col("g.a")) & (F.col("spread") <= F.col("g.b")) & (F.col("drop") <= F.col("g.c")))
    return m.groupBy(F.col("g.row").alias("grid_row"), "skipping").agg(F.count_if(ok).alias("n_passed"), F.count(F.lit(1)).alias("n"))


def pred_speakers(spark: SparkSession, folder: str) -> DataFrame:
    """Dialogues in which a speaker has no usable word, or a channel no event."""
    w = intervals.usable_speech(table(spark, folder, "words")).select("dialogue_id", "speaker")
    e = _events(spark, folder).where(F.col("channel").isin(0, 1)).select("dialogue_id", F.col("channel").cast("string").alias("speaker"))
    one = lambda d, both, kind: reports.missing_values(d, "dialogue_id", "speaker", both).withColumn("kind", F.lit(kind))
    return one(w, ["A", "B"], "words").unionByName(one(e, ["0", "1"], "events"))


def pred_index(spark: SparkSession, folder: str) -> DataFrame:
    """Dialogues in the order of their ids dealt to seven workers by place."""
    r = files.ranked(table(spark, folder, "dialogues").select("dialogue_id"))
    return r.select("dialogue_id", (F.col("place") % 7).alias("worker"))


def j5_tiers(spark: SparkSession, folder: str) -> DataFrame:
    """Dialogues by tier and role of their voices, '?' where the voice isn't known."""
    d = table(spark, folder, "dialogues").select(F.explode(F.array("passenger_voice_id", "crew_voice_id")).alias("voice_id"))
    v = table(spark, folder, "voices")
    j = d.groupBy("voice_id").agg(F.count(F.lit(1)).alias("c")).join(v, "voice_id", "left")
    return j.groupBy(F.coalesce("tier", F.lit("?")).alias("tier"), F.coalesce("voice_role", F.lit("?")).alias("role")).agg(F.sum("c").alias("n"))


def j6_map_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Channel of every tenth event by lookup in a map from event number, as text, of 64 events each."""
    e = _events(spark, folder).where("channel is not null").withColumn("part", F.floor(F.col("event_idx") / 64))
    m = e.groupBy("dialogue_id", "part").agg(F.map_from_entries(F.collect_list(F.struct(F.col("event_idx").cast("string"), "channel"))).alias("m"))
    k = F.explode(F.sequence(F.lit(0), F.lit(60), F.lit(10))).alias("k")
    return m.select("dialogue_id", "part", "m", k).select("dialogue_id", "part", "k", F.try_element_at("m", (F.col("part") * 64 + F.col("k")).cast("string")).alias("channel"))


def j14_differences(spark: SparkSession, folder: str) -> DataFrame:
    """Ids that only words or only raw words have, counted, and those of both."""
    a, b = _ids(spark, folder, "words").withColumn("w", F.lit(1)), _ids(spark, folder, "raw_words").withColumn("r", F.lit(1))
    side = F.when(F.col("w").isNull(), "raw only").when(F.col("r").isNull(), "words only").otherwise("both")
    return a.join(b, "dialogue_id", "full_outer").groupBy(side.alias("side")).agg(F.count(F.lit(1)).alias("n"))


def u2_sets(spark: SparkSession, folder: str) -> DataFrame:
    """Sizes of union, intersection and difference of the ids in words and in documents."""
    a, b = _ids(spark, folder, "words"), _ids(spark, folder, "documents")
    sets = {"union": a.union(b).distinct(), "intersect": a.intersect(b), "except": a.exceptAll(b)}
    out = None
    for name, d in sets.items():
        one = d.agg(F.lit(name).alias("operation"), F.count(F.lit(1)).alias("n"))
        out = one if out is None else out.unionByName(one)
    return out


def _hash(c: str) -> Column:
    return F.md5(F.concat(F.col(c), F.lit(SEED)))


def k5_quota(spark: SparkSession, folder: str) -> DataFrame:
    """Quotas of a hold-out of 20 dialogues by category."""
    sizes = _dialogues(spark, folder).groupBy(F.coalesce("category", F.lit("?")).alias("category")).agg(F.count(F.lit(1)).alias("size"))
    return reports.quotas(sizes, "category", 20)


def k6_sample(spark: SparkSession, folder: str) -> DataFrame:
    """Three dialogues of each category, the first in the order of a seeded hash."""
    d = _dialogues(spark, folder).select(F.coalesce("category", F.lit("?")).alias("category"), "dialogue_id").withColumn("h", _hash("dialogue_id"))
    return reports.top_per_key(d, ["category"], [F.col("h")], SAMPLE, F.xxhash64("dialogue_id")).drop("h")


def k7_choice(spark: SparkSession, folder: str) -> DataFrame:
    """A weighted choice per dialogue from a seeded hash; weights of zero are never chosen."""
    total = sum(w for _, w in WEIGHTS)
    u = F.conv(F.substring(_hash("dialogue_id"), 1, 8), 16, 10).cast("bigint") % total
    pick, upto = F.lit(None).cast("string"), total
    for name, w in reversed(WEIGHTS):
        upto -= w
        if w:
            pick = F.coalesce(pick, F.when(u >= upto, name))
    return table(spark, folder, "dialogues").select("dialogue_id", pick.alias("choice"))


def io10_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Shard of each dialogue: sorted ids, 100 to a shard."""
    return files.sharded(table(spark, folder, "dialogues").select("dialogue_id"), per_file=100)


def ev_breakdown(spark: SparkSession, folder: str) -> DataFrame:
    """Stream events by user group and type: number, and sum of values in hundredths."""
    e = table(spark, folder, "events")
    return e.groupBy((F.col("user_id") % 10).alias("user_group"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(F.round(F.col("value") * 100).cast("bigint")).alias("cents"))


QUERIES = {
    f.__name__: f
    for f in (
        a2_corpus, a3_crosstab, a4_breakdown, a5_voices, a6_worst, a7_p10, a8_p10, a9_median, a12_metrics, a13_violations, a16_thresholds, a22_languages, a24_means, ev_breakdown, io10_shards,
        j1_complete, j2_missing, j5_tiers, j6_map_lookup, j10_nearest, j12_what_if, j13_medoids, j14_differences, k5_quota, k6_sample, k7_choice, pred_drops, u2_sets, j4_status, a1_funnel, a14_lenient, a15_skipping, pred_speakers, pred_index,
    )
}

_D = "d AS (SELECT *, CASE WHEN duration_s > 0 AND NOT isnan(duration_s) THEN duration_s END AS seconds FROM dialogues)"
_SIMS = """
pr AS (SELECT a.label, a.vec_id, sum(list_sum(list_transform(range(1, len(a.embedding) + 1), lambda i: a.embedding[i]::DOUBLE * b.embedding[i]::DOUBLE))) AS s FROM embeddings a JOIN embeddings b ON a.label = b.label GROUP BY ALL),
md AS (SELECT label, arg_max(vec_id, s) AS vec_id FROM pr GROUP BY label),
si AS (SELECT e.vec_id, e.label, e.vec_id % 4 AS bucket, e.vec_id % 50 AS dialogue, CAST(floor(list_sum(list_transform(range(1, len(e.embedding) + 1), lambda i: e.embedding[i]::DOUBLE * m.embedding[i]::DOUBLE)) * 1000) AS BIGINT) AS sim
  FROM embeddings e JOIN md USING (label) JOIN embeddings m ON m.vec_id = md.vec_id)"""
_MET = f"""{_SIMS},
mt AS (SELECT dialogue, count(*) AS n, min(sim) AS least, max(sim) - min(sim) AS spread,
  CAST(coalesce(floor(sum(sim) FILTER (WHERE bucket = 0) / count(*) FILTER (WHERE bucket = 0)) - floor(sum(sim) FILTER (WHERE bucket <> 0) / count(*) FILTER (WHERE bucket <> 0)), 0) AS BIGINT) AS drop,
  arg_min(vec_id, (sim, vec_id)) AS worst FROM si GROUP BY dialogue)"""
_STAT = "WITH {s}, o AS (SELECT {k}, sim, row_number() OVER (PARTITION BY {k} ORDER BY sim) AS r, count(*) OVER (PARTITION BY {k}) AS n FROM si) SELECT {k}, n, sim AS stat FROM o WHERE r = {at} + 1"
_IN = "dialogue_id IN (SELECT dialogue_id FROM {} WHERE dialogue_id IS NOT NULL)"
_STATUS = f"CASE WHEN {_IN.format('oracle_raw')} THEN 'evented' WHEN {_IN.format('words')} THEN 'aligned' WHEN {_IN.format('raw_words')} THEN 'raw' WHEN {_IN.format('documents')} THEN 'text only' ELSE 'nothing' END"
_KEYS = ("lang", "stage", "category", "passenger_voice_id", "crew_voice_id")

SQL = {
    "a2_corpus": f"WITH {_D}, m AS (SELECT CAST(round(seconds * 1000) AS BIGINT) AS ms FROM d) SELECT count(ms) AS n, CAST(sum(ms) AS BIGINT) AS total_ms, min(ms) AS least_ms, max(ms) AS most_ms, count(*) FILTER (WHERE ms < 20000) AS n_short, count(*) FILTER (WHERE ms > 180000) AS n_long FROM m",
    "a3_crosstab": "SELECT coalesce(category, '?') AS category, " + ", ".join(f"count(*) FILTER (WHERE lang = '{g}') AS {g}, count(*) FILTER (WHERE lang = '{g}' AND stage = 'aligned') AS {g}_aligned" for g in ("en", "de", "fr", "es")) + " FROM dialogues GROUP BY 1",
    "a4_breakdown": f"WITH {_D} " + " UNION ALL ".join(f"SELECT '{k}' AS key, coalesce({k}, '?') AS value, count(*) AS total, count(*) FILTER (WHERE stage = 'aligned') AS n_aligned, count(*) FILTER (WHERE seconds > 180) AS n_long FROM d GROUP BY 2" for k in _KEYS),
    "a5_voices": f"WITH {_SIMS} SELECT label, count(*) FILTER (WHERE bucket = 0) AS n_calm, CAST(sum(sim) FILTER (WHERE bucket = 0) AS BIGINT) AS calm_sum, count(*) FILTER (WHERE bucket <> 0) AS n_other, CAST(sum(sim) FILTER (WHERE bucket <> 0) AS BIGINT) AS other_sum FROM si GROUP BY label",
    "a6_worst": f"WITH {_SIMS}, o AS (SELECT label, row_number() OVER (PARTITION BY label ORDER BY sim, vec_id) AS rank, vec_id, sim FROM si) SELECT * FROM o WHERE rank <= 3",
    "a7_p10": _STAT.format(s=_SIMS, k="label", at="greatest(0, n // 10 - 1)"),
    "a8_p10": f"SELECT p.*, n_below FROM ({_STAT.format(s=_SIMS, k='bucket', at='n // 10')}) p JOIN (WITH {_SIMS} SELECT bucket, count(*) FILTER (WHERE sim < 780) AS n_below FROM si GROUP BY 1) b USING (bucket)",
    "a9_median": _STAT.format(s=_SIMS, k="label", at="n // 2"),
    "a12_metrics": f"WITH {_MET} SELECT * FROM mt",
    "a13_violations": f"WITH {_MET} SELECT CASE WHEN least < 780 THEN 'least' WHEN spread > 120 THEN 'spread' WHEN drop > 60 THEN 'drop' ELSE 'none' END AS rule, count(*) AS n FROM mt GROUP BY 1",
    "a16_thresholds": f"""WITH {_SIMS}, m AS (SELECT label, dialogue, min(sim) AS least, max(sim) - min(sim) AS spread FROM si GROUP BY ALL)
SELECT label, count(*) FILTER (WHERE least >= 780 AND spread <= 120) AS strict, count(*) FILTER (WHERE least >= 650 AND spread <= 250) AS loose, count(*) AS n FROM m GROUP BY label""",
    "pred_drops": f"WITH {_D}, w AS (SELECT dialogue_id, CASE WHEN lang IS NULL THEN 'language' WHEN passenger_voice_id IN ('pax_01', 'pax_02') THEN 'voice' WHEN seconds IS NULL THEN 'duration' END AS why FROM d) SELECT * FROM w WHERE why IS NOT NULL",
    "a22_languages": "SELECT coalesce(category, '?') AS category, string_agg(DISTINCT coalesce(lang, 'None'), '|' ORDER BY coalesce(lang, 'None')) AS langs FROM dialogues GROUP BY 1",
    "a24_means": "SELECT load_id, round(CAST(sum(CAST(r AS DECIMAL(18,6))) AS DOUBLE) / count(r), 6) AS mean_ratio, count(r) AS n FROM (SELECT load_id, CASE WHEN NOT isnan(current_spoken_ratio) THEN current_spoken_ratio END AS r FROM oracle_raw) GROUP BY 1",
    "ev_breakdown": "SELECT user_id % 10 AS user_group, event_type, count(*) AS n, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents FROM events GROUP BY ALL",
    "io10_shards": "SELECT dialogue_id, (row_number() OVER (ORDER BY dialogue_id) - 1) // 100 AS shard FROM dialogues",
    "j1_complete": "SELECT dialogue_id, lang FROM dialogues WHERE dialogue_id IN (SELECT dialogue_id FROM words) AND dialogue_id IN (SELECT dialogue_id FROM oracle_raw) AND dialogue_id IN (SELECT dialogue_id FROM documents)",
    "j2_missing": " UNION ALL ".join(f"SELECT DISTINCT dialogue_id, 'no {t}' AS missing FROM dialogues WHERE dialogue_id NOT IN (SELECT dialogue_id FROM {t} WHERE dialogue_id IS NOT NULL) UNION ALL SELECT DISTINCT dialogue_id, 'only {t}' FROM {t} WHERE dialogue_id IS NOT NULL AND dialogue_id NOT IN (SELECT dialogue_id FROM dialogues)" for t in ("words", "oracle_raw", "documents", "raw_words")),
    "j4_status": f"SELECT dialogue_id, {_STATUS} AS status FROM dialogues",
    "a1_funnel": f"""WITH s AS (SELECT {_STATUS} AS status FROM dialogues), l AS (SELECT unnest(['evented', 'aligned', 'raw', 'text only', 'nothing']) AS status, unnest(range(5)) AS place)
SELECT CAST(place AS INT) AS place, l.status, count(s.status) AS n, CASE WHEN (SELECT count(*) FROM s) = 0 THEN '-' ELSE CAST(CAST(round_even(100 * count(s.status) / (SELECT count(*) FROM s), 0) AS INT) AS VARCHAR) || '%' END AS share FROM l LEFT JOIN s USING (status) GROUP BY ALL""",
    "a14_lenient": f"WITH {_MET}, d AS (SELECT unnest(range(60)) AS dialogue) SELECT dialogue, CASE WHEN n IS NULL THEN 'passes' WHEN least < 780 THEN 'least' WHEN spread > 120 THEN 'spread' WHEN drop > 60 THEN 'drop' ELSE 'passes' END AS rule FROM d LEFT JOIN mt USING (dialogue)",
    "a15_skipping": " UNION ALL ".join(f"""SELECT {i} AS grid_row, {k} AS skipping, count(*) FILTER (WHERE least IS NULL OR (least >= {a} AND spread <= {b} AND drop <= {c})) AS n_passed, count(*) AS n FROM (WITH {_SIMS} SELECT dialogue, min(sim) FILTER (WHERE {w}) AS least, max(sim) FILTER (WHERE {w}) - min(sim) FILTER (WHERE {w}) AS spread,
  coalesce(floor(sum(sim) FILTER (WHERE bucket = 0) / count(*) FILTER (WHERE bucket = 0)) - floor(sum(sim) FILTER (WHERE bucket <> 0 AND {w}) / nullif(count(*) FILTER (WHERE bucket <> 0 AND {w}), 0)), 0) AS drop FROM si GROUP BY dialogue)""" for i, (a, b, c) in enumerate(GRID) for k, w in (("false", "true"), ("true", "bucket <> 3"))),
    "pred_speakers": f"""WITH {EVENTS_SQL}, w AS (SELECT dialogue_id, speaker FROM words WHERE speaker IN ('A', 'B') AND "start" IS NOT NULL AND "end" IS NOT NULL AND NOT isnan("start") AND NOT isnan("end") AND "end" >= "start"),
x AS (SELECT 'words' AS kind, dialogue_id, speaker FROM w UNION ALL SELECT 'events', dialogue_id, CAST(channel AS VARCHAR) FROM e WHERE channel IN (0, 1))
SELECT kind, dialogue_id, CASE min(speaker) WHEN 'A' THEN 'B' WHEN 'B' THEN 'A' WHEN '0' THEN '1' ELSE '0' END AS missing FROM x GROUP BY ALL HAVING count(DISTINCT speaker) = 1""",
    "pred_index": "SELECT dialogue_id, (row_number() OVER (ORDER BY dialogue_id) - 1) % 7 AS worker FROM dialogues",
    "j5_tiers": "WITH d AS (SELECT unnest([passenger_voice_id, crew_voice_id]) AS voice_id FROM dialogues) SELECT coalesce(tier, '?') AS tier, coalesce(voice_role, '?') AS role, count(*) AS n FROM d LEFT JOIN voices USING (voice_id) GROUP BY ALL",
    "j6_map_lookup": f"""WITH {EVENTS_SQL}, p AS (SELECT DISTINCT dialogue_id, CAST(event_idx // 64 AS BIGINT) AS part FROM e WHERE channel IS NOT NULL), k AS (SELECT *, CAST(unnest(range(0, 61, 10)) AS INT) AS k FROM p)
SELECT k.dialogue_id, part, k, channel FROM k LEFT JOIN e ON e.dialogue_id = k.dialogue_id AND e.event_idx = part * 64 + k AND channel IS NOT NULL""",
    "j10_nearest": """WITH v AS (SELECT label, vec_id % 10 AS digit, min(vec_id) AS vec_id FROM embeddings GROUP BY ALL), w AS (SELECT *, CAST(unnest(range(0, 10)) AS INT) AS wanted FROM v)
SELECT label, wanted, arg_min(vec_id, (abs(digit - wanted), digit)) AS vec_id FROM w GROUP BY ALL""",
    "j12_what_if": f"WITH {_MET} " + " UNION ALL ".join(f"SELECT {i} AS grid_row, count(*) FILTER (WHERE least >= {a} AND spread <= {b} AND drop <= {c}) AS n_passed, count(*) AS n FROM mt" for i, (a, b, c) in enumerate(GRID)),
    "j13_medoids": f"WITH {_SIMS} SELECT * FROM md",
    "j14_differences": """WITH a AS (SELECT DISTINCT dialogue_id FROM words), b AS (SELECT DISTINCT dialogue_id FROM raw_words)
SELECT CASE WHEN a.dialogue_id IS NULL THEN 'raw only' WHEN b.dialogue_id IS NULL THEN 'words only' ELSE 'both' END AS side, count(*) AS n FROM a FULL JOIN b ON a.dialogue_id = b.dialogue_id GROUP BY 1""",
    "k6_sample": f"SELECT coalesce(category, '?') AS category, dialogue_id, row_number() OVER (PARTITION BY coalesce(category, '?') ORDER BY md5(dialogue_id || '{SEED}')) AS rank FROM dialogues QUALIFY rank <= {SAMPLE}",
    "k7_choice": f"SELECT dialogue_id, CASE WHEN u < 5 THEN 'none' WHEN u < 8 THEN 'mild' ELSE 'strong' END AS choice FROM (SELECT dialogue_id, CAST('0x' || left(md5(dialogue_id || '{SEED}'), 8) AS BIGINT) % 10 AS u FROM dialogues)",
    "u2_sets": """WITH a AS (SELECT DISTINCT dialogue_id FROM words), b AS (SELECT DISTINCT dialogue_id FROM documents WHERE dialogue_id IS NOT NULL)
SELECT 'union' AS operation, count(*) AS n FROM (SELECT * FROM a UNION SELECT * FROM b) UNION ALL SELECT 'intersect', count(*) FROM (SELECT * FROM a INTERSECT SELECT * FROM b) UNION ALL SELECT 'except', count(*) FROM (SELECT * FROM a EXCEPT SELECT * FROM b)""",
}
