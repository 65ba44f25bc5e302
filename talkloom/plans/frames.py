"""Queries on ragged lists and frame streams, over rows of up to 200 words of a dialogue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talkloom.functions import arrays
from talkloom.operators import speech
from talkloom.plans.speech import WORDS_SQL
from talkloom.sources.tables import table

ROW_WORDS = 200
DELAYS = [0, 0, 1, 1, 1, 1, 1, 1, 1]
INITIAL = [90] * 9
PAD = [3] * 9
ZERO = -1


def _joined(a: Column) -> Column:
    return F.array_join(F.transform(a, lambda x: x.cast("string")), ",")


def _flat(a: Column) -> Column:
    return _joined(F.flatten(a))


def _rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows (dialogue_id, part) with tok (word lengths), lists of five of them, two sets of streams, and events."""
    w = speech.clean_words(table(spark, folder, "words"))
    g = w.groupBy("dialogue_id", F.floor(F.col("word_idx") / ROW_WORDS).alias("part")).agg(F.array_sort(F.collect_list(F.struct("word_idx", F.length("word").alias("n")))).alias("x"))
    r = g.select("dialogue_id", "part", F.transform("x", lambda x: x["n"]).alias("tok"))
    k = F.ceil(F.size("tok") / 5).cast("int")
    audio = lambda first: F.transform(F.sequence(F.lit(first), F.lit(first + 7)), lambda c: F.transform("tok", lambda v, j: (v * c + j) % 100))
    return r.select(
        "dialogue_id", "part", "tok",
        F.transform(F.sequence(F.lit(0), k - 1), lambda i: arrays.part(F.col("tok"), i * 5, 5)).alias("lists"),
        arrays.merged(F.col("tok"), audio(1), 3).alias("own"), arrays.merged(F.col("tok"), audio(9), 3).alias("other"),
        F.transform(F.filter(F.sequence(F.lit(0), F.size("tok") - 1), lambda j: j % 7 == 3), lambda j: F.struct(j.alias("pos"), arrays.part(F.col("tok"), j, 3).alias("tokens"))).alias("events"),
    )


def r1_pack(spark: SparkSession, folder: str) -> DataFrame:
    """Lists packed, one taken out again, and every second one packed anew."""
    r = _rows(spark, folder).withColumn("p", arrays.pack(F.col("lists")))
    keep = F.filter(F.sequence(F.lit(0), F.size("lists") - 1), lambda i: i % 2 == 0)
    r = r.withColumn("s", arrays.packed_subset(F.col("p.values"), F.col("p.offsets"), keep))
    same = arrays.unpack(F.col("p.values"), F.col("p.offsets")) == F.col("lists")
    return r.select("dialogue_id", "part", _joined(F.col("p.values")).alias("packed"), _joined(F.col("p.offsets")).alias("offsets"), _joined(arrays.packed_item(F.col("p.values"), F.col("p.offsets"), 1)).alias("second"), _joined(F.col("s.values")).alias("subset"), _joined(F.col("s.offsets")).alias("subset_offsets"), same.alias("same"))


def r4_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events moved to the delayed timeline and cut at 100 frames."""
    e = arrays.shifted_events(F.col("events"), 1 + DELAYS[0], F.lit(100), ["pos", "tokens"])
    r = _rows(spark, folder).withColumn("e", e)
    return r.select("dialogue_id", "part", _joined(F.transform("e", lambda x: x["pos"])).alias("pos"), _flat(F.transform("e", lambda x: x["tokens"])).alias("tokens"))


def r8_delayed(spark: SparkSession, folder: str) -> DataFrame:
    """Streams behind their delays, and whether taking the delays back gives them again."""
    r = _rows(spark, folder).withColumn("d", arrays.delayed(F.col("own"), DELAYS, INITIAL, PAD))
    back = arrays.undelayed(F.transform("d", lambda s: arrays.part(s, 1, F.size(s) - 1)), DELAYS) == F.col("own")
    return r.select("dialogue_id", "part", F.size(F.get("d", F.lit(0))).alias("n_frames"), F.md5(_flat(F.col("d"))).alias("md5"), back.alias("same"))


def r10_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """Chunks of at most 64 frames with their events."""
    r = _rows(spark, folder).select("*", F.posexplode(arrays.chunk_bounds(F.size("tok"), 64)).alias("chunk", "b"))
    e = arrays.chunk_events(F.col("events"), F.col("b"), ["pos", "tokens"])
    return r.select("dialogue_id", "part", "chunk", F.col("b.start").alias("first"), F.col("b.size").alias("n_frames"), _joined(arrays.part(F.col("tok"), F.col("b.start"), F.col("b.size"))).alias("text"), _joined(F.transform(e, lambda x: x["pos"])).alias("event_frames"))


def r14_features(spark: SparkSession, folder: str) -> DataFrame:
    """Training rows: main streams, delays, chunks, least length, labels, the prompt's mask in the first chunk, and the events on the delayed timeline of each chunk."""
    d = arrays.delayed(arrays.main_streams(F.col("own"), F.col("other")), DELAYS + DELAYS[1:], INITIAL + INITIAL[1:], PAD + PAD[1:])
    r = _rows(spark, folder).select("dialogue_id", "part", d.alias("d"), "events")
    n = F.size(F.get("d", F.lit(0)))
    r = r.withColumn("events", arrays.sorted_events(arrays.shifted_events(F.col("events"), 1 + DELAYS[0], n, ["pos", "tokens"])))
    r = r.select("dialogue_id", "part", "d", "events", F.posexplode(arrays.chunk_bounds(n, 100)).alias("chunk", "b")).where(F.col("b.size") >= 20)
    r = r.withColumn("x", arrays.stream_chunk(F.col("d"), F.col("b")))
    y = arrays.masked_prompt(arrays.labels(F.col("x"), INITIAL + INITIAL[1:], ZERO), DELAYS + DELAYS[1:], 4, ZERO)
    e = arrays.chunk_events(F.col("events"), F.col("b"), ["pos", "tokens"])
    return r.select("dialogue_id", "part", "chunk", F.col("b.size").alias("n_frames"), F.md5(_flat(F.col("x"))).alias("inputs"), F.md5(_flat(y)).alias("targets"), _joined(F.transform(e, lambda x: x["pos"])).alias("event_frames"), _flat(F.transform(e, lambda x: x["tokens"])).alias("event_tokens"))


def r15_prompted(spark: SparkSession, folder: str) -> DataFrame:
    """Rows behind a prompt of a voice and three text ids, at most 120 frames, at least 20 of them the row's own."""
    r = _rows(spark, folder)
    voice = F.transform(F.slice("own", 2, 8), lambda s: arrays.part(s, 0, 11))
    own, other = arrays.prompt_prefix(voice, F.array(F.lit(5), F.lit(6), F.lit(7)), 3)
    r = r.withColumn("p", own).withColumn("q", other)
    r = r.withColumn("a", arrays.prompted(F.col("own"), F.col("p"), 120, 20)).withColumn("b", arrays.prompted(F.col("other"), F.col("q"), 120, 20)).where("a is not null")
    p, n = F.size(F.get("p", F.lit(0))), F.size(F.get("a", F.lit(0)))
    e = arrays.prompted_events(F.col("events"), 16, n - p, p, ["pos", "tokens"])
    return r.select("dialogue_id", "part", p.alias("prompt_frames"), n.alias("n_frames"), F.md5(_flat(F.col("a"))).alias("own_md5"), F.md5(_flat(F.col("b"))).alias("other_md5"), _joined(F.transform(e, lambda x: x["pos"])).alias("event_frames"))


def r18_shifted(spark: SparkSession, folder: str) -> DataFrame:
    """A stream moved right by three and left by two frames, and left by up to 150, but not out of itself."""
    return _rows(spark, folder).select("dialogue_id", "part", _joined(arrays.shifted(F.col("tok"), 3, 0)).alias("right_3"), _joined(arrays.shifted(F.col("tok"), -2, 0)).alias("left_2"), _joined(arrays.shift_within(F.col("tok"), -150, 0)).alias("left_most"))


def r17_event_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Events written onto one stream, later ones over earlier ones: predictions, or the hint where it is complete; and hints only."""
    hint = F.transform(F.col("events"), lambda e: F.struct(e["pos"].alias("pos"), F.when(e["pos"] % 2 == 0, 1.0).otherwise(0.5).alias("ratio"), F.lit(0).alias("skip_forbid"), e["tokens"].alias("pred"), F.filter(e["tokens"], lambda x: x > 3).alias("hint")))
    r = _rows(spark, folder).withColumn("ev", hint)
    stream = lambda only: _joined(arrays.frames_of_events(arrays.chosen_events(F.col("ev"), F.size("tok"), only), F.size("tok"), 0, 99))
    return r.select("dialogue_id", "part", stream(False).alias("stream"), stream(True).alias("hints"))


def r20_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Streams padded to the longest of their batch of four rows, with the share of real frames."""
    from pyspark.sql import Window

    r = _rows(spark, folder).withColumn("batch", F.floor(F.col("part") / 4))
    r = r.withColumn("longest", F.max(F.size("tok")).over(Window.partitionBy("dialogue_id", "batch")))
    return r.select("dialogue_id", "part", "batch", "longest", F.size("tok").alias("n_frames"), F.md5(_flat(arrays.padded(F.col("own"), F.col("longest"), 0))).alias("md5"))


def j11_phrases(spark: SparkSession, folder: str) -> DataFrame:
    """Last occurrence of the row's first two tokens in the row."""
    return _rows(spark, folder).select("dialogue_id", "part", arrays.last_phrase(F.col("tok"), arrays.part(F.col("tok"), 0, 2)).alias("place"))


QUERIES = {f.__name__: f for f in (r1_pack, r4_events, r8_delayed, r10_chunks, r14_features, r15_prompted, r17_event_stream, r18_shifted, r20_batches, j11_phrases)}

_ROWS = f"""{WORDS_SQL},
r0 AS (SELECT dialogue_id, CAST(word_idx // {ROW_WORDS} AS BIGINT) AS part, list(CAST(length(word) AS INT) ORDER BY word_idx) AS tok FROM w GROUP BY ALL),
r AS (SELECT *, len(tok) AS n,
  list_transform(range((len(tok) + 4) // 5), lambda i: tok[i * 5 + 1:i * 5 + 5]) AS lists,
  list_concat([tok], list_transform(range(1, 9), lambda c: list_transform(tok, lambda v, j: (v * c + j - 1) % 100))) AS own,
  list_concat([tok], list_transform(range(9, 17), lambda c: list_transform(tok, lambda v, j: (v * c + j - 1) % 100))) AS other,
  list_filter(range(len(tok)), lambda j: j % 7 = 3) AS ev
  FROM r0)"""
_J = "array_to_string({0}, ',')"
_DELAY = "list_transform({0}, lambda s, k: list_concat(list_transform(range(1 + {1}[k]), lambda i: 90), s, list_transform(range(1 - {1}[k]), lambda i: 3)))"
_D9, _D17 = str(DELAYS), str(DELAYS + DELAYS[1:])
_CHUNKS = """unnest(list_transform(range(CAST(ceil({n} / {m}) AS BIGINT)), lambda c: {{'chunk': c, 'first': c * ({n} // CAST(ceil({n} / {m}) AS BIGINT)) + least(c, {n} % CAST(ceil({n} / {m}) AS BIGINT)),
  'size': {n} // CAST(ceil({n} / {m}) AS BIGINT) + CASE WHEN c < {n} % CAST(ceil({n} / {m}) AS BIGINT) THEN 1 ELSE 0 END}}))"""

_HT = "list_filter(tok[j + 1:j + 3], lambda v: v > 3)"
_TK = f"CASE WHEN j % 2 = 0 AND len({_HT}) > 0 THEN {_HT} ELSE tok[j + 1:j + 3] END"
_STREAM = "list_transform(range(n), lambda f: coalesce(list_transform(list_filter({ev}, lambda j: j <= f AND f <= j + len({tk})), lambda j: CASE WHEN f = j THEN 99 ELSE ({tk})[f - j] END)[-1], 0))"

SQL = {
    "r1_pack": f"""WITH {_ROWS}
SELECT dialogue_id, part, {_J.format('tok')} AS packed, {_J.format('list_transform(range(len(lists) + 1), lambda i: least(i * 5, n))')} AS offsets, {_J.format('lists[2]')} AS second,
  {_J.format('flatten(list_filter(lists, lambda x, i: i % 2 = 1))')} AS subset,
  {_J.format('list_concat([0], list_transform(range(1, (len(lists) + 1) // 2 + 1), lambda i: list_sum(list_transform(list_filter(lists, lambda x, j: j % 2 = 1)[1:i], lambda y: len(y)))))')} AS subset_offsets, true AS same FROM r""",
    "r4_events": f"""WITH {_ROWS}, e AS (SELECT *, list_filter(ev, lambda j: j + 1 < 100) AS k FROM r)
SELECT dialogue_id, part, {_J.format('list_transform(k, lambda j: j + 1)')} AS pos, {_J.format('flatten(list_transform(k, lambda j: tok[j + 1:j + 3]))')} AS tokens FROM e""",
    "r8_delayed": f"WITH {_ROWS} SELECT dialogue_id, part, CAST(n + 2 AS INT) AS n_frames, md5({_J.format('flatten(' + _DELAY.format('own', _D9) + ')')}) AS md5, true AS same FROM r",
    "r10_chunks": f"""WITH {_ROWS}, c AS (SELECT *, {_CHUNKS.format(n='n', m=64)} AS b FROM r)
SELECT dialogue_id, part, CAST(b.chunk AS INT) AS chunk, CAST(b.first AS INT) AS first, CAST(b.size AS INT) AS n_frames, {_J.format('tok[b.first + 1:b.first + b.size]')} AS text,
  {_J.format('list_transform(list_filter(ev, lambda j: j >= b.first AND j < b.first + b.size), lambda j: j - b.first)')} AS event_frames FROM c""",
    "r14_features": f"""WITH {_ROWS}, d AS (SELECT dialogue_id, part, ev, tok, n + 2 AS t, {_DELAY.format('list_concat(own, other[2:9])', _D17)} AS d FROM r), c AS (SELECT *, {_CHUNKS.format(n='t', m=100)} AS b FROM d),
x AS (SELECT dialogue_id, part, b, list_transform(d, lambda s: s[b.first + 1:b.first + b.size]) AS x, list_filter(ev, lambda j: j + 1 >= b.first AND j + 1 < b.first + b.size) AS je, tok FROM c WHERE b.size >= 20)
SELECT dialogue_id, part, {_J.format('list_transform(je, lambda j: j + 1 - b.first)')} AS event_frames, {_J.format('flatten(list_transform(je, lambda j: tok[j + 1:j + 3]))')} AS event_tokens, CAST(b.chunk AS INT) AS chunk, CAST(b.size AS INT) AS n_frames, md5({_J.format('flatten(x)')}) AS inputs,
  md5({_J.format('flatten(list_transform(x, lambda s, k: list_transform(s, lambda v, j: CASE WHEN j - 1 < 5 + ' + _D17 + '[k] OR v >= 90 THEN -1 ELSE v END)))')}) AS targets FROM x""",
    "r15_prompted": f"""WITH {_ROWS},
v AS (SELECT *, list_transform(own[2:9], lambda s: s[2:11]) AS voice, least(n, 11) - 1 AS nv FROM r),
p AS (SELECT *, nv + 15 AS np, least(n, 120 - nv - 15) AS keep,
  list_concat([list_concat(list_transform(range(nv + 6), lambda i: 3), [5, 6, 7], list_transform(range(6), lambda i: 3))],
    list_transform(voice, lambda s, k: list_concat(s, list_transform(range(15), lambda i: ({arrays.SILENCE})[k])))) AS p,
  list_concat([list_transform(range(nv + 15), lambda i: 3)], list_transform({arrays.SINE}, lambda c: list_transform(range(nv + 15), lambda i: c))) AS q FROM v)
SELECT dialogue_id, part, CAST(np AS INT) AS prompt_frames, CAST(np + keep AS INT) AS n_frames,
  md5({_J.format('flatten(list_transform(own, lambda s, k: list_concat(p[k], s[1:keep])))')}) AS own_md5, md5({_J.format('flatten(list_transform(other, lambda s, k: list_concat(q[k], s[1:keep])))')}) AS other_md5,
  {_J.format('list_transform(list_filter(ev, lambda j: j >= 16 AND j < keep), lambda j: j + np)')} AS event_frames FROM p WHERE keep >= 20""",
    "r17_event_stream": f"""WITH {_ROWS} SELECT dialogue_id, part, {_J.format(_STREAM.format(ev="list_filter(ev, lambda j: len(" + _TK + ") > 0)", tk=_TK))} AS stream, {_J.format(_STREAM.format(ev="list_filter(ev, lambda j: len(" + _HT + ") > 0)", tk=_HT))} AS hints FROM r""",
    "r18_shifted": f"""WITH {_ROWS} SELECT dialogue_id, part, {_J.format('list_concat(list_transform(range(least(3, n)), lambda i: 0), tok[1:greatest(n - 3, 0)])')} AS right_3, {_J.format('CASE WHEN n <= 1 THEN tok ELSE list_concat(tok[least(150, n - 1) + 1:], list_transform(range(least(150, n - 1)), lambda i: 0)) END')} AS left_most,
  {_J.format('list_concat(tok[3:], list_transform(range(least(2, n)), lambda i: 0))')} AS left_2 FROM r""",
    "r20_batches": f"""WITH {_ROWS}, b AS (SELECT *, CAST(part // 4 AS BIGINT) AS batch, max(n) OVER (PARTITION BY dialogue_id, part // 4) AS longest FROM r)
SELECT dialogue_id, part, batch, CAST(longest AS INT) AS longest, CAST(n AS INT) AS n_frames, md5({_J.format('flatten(list_transform(own, lambda s: list_concat(s, list_transform(range(longest - n), lambda i: 0))))')}) AS md5 FROM b""",
    "j11_phrases": f"""WITH {_ROWS} SELECT dialogue_id, part, CAST(CASE WHEN n >= 2 THEN list_max(list_filter(range(n - 1), lambda i: tok[i + 1] = tok[1] AND tok[i + 2] = tok[2])) WHEN n = 1 THEN 0 END AS INT) AS place FROM r""",
}
