"""Sources and sinks of the dialogue files: JSON transcripts and events, logs, WAV headers, shards, reports."""

from __future__ import annotations

import struct
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkloom import schemas
from talkloom.session import checkpointed


def _id(suffix: str) -> Column:
    return F.regexp_extract(F.col("_metadata.file_name"), rf"^(.*){suffix.replace('.', '[.]')}$", 1)


def read_json_arrays(spark: SparkSession, folder: str, item: str, suffix: str = ".json") -> DataFrame:
    """(dialogue_id, items, readable): one row per file of a JSON array; an unreadable file has null items."""
    t = spark.read.option("wholetext", True).option("pathGlobFilter", f"*{suffix}").text(folder)
    items = F.from_json("value", f"array<{item}>", {"mode": "PERMISSIVE"})
    good = F.col("value").rlike(r"(?s)^\s*\[.*\]\s*$") & F.col("items").isNotNull()
    return t.select(_id(suffix).alias("dialogue_id"), "value", items.alias("items")).select("dialogue_id", F.when(good, F.col("items")).alias("items"), good.alias("readable"))


def _exploded(files: DataFrame, position: str) -> DataFrame:
    return files.select("dialogue_id", F.posexplode("items").alias(position, "x")).select("dialogue_id", position, "x.*")


def read_transcripts(spark: SparkSession, folder: str) -> DataFrame:
    """Words (dialogue_id, word_idx, speaker, word, start, end) of a folder of transcripts; word_idx is the place in the list."""
    return _exploded(read_json_arrays(spark, folder, schemas.WORD), "word_idx")


def read_events(spark: SparkSession, folder: str) -> DataFrame:
    """Prediction events of a folder; event_idx is the place in the list."""
    return _exploded(read_json_arrays(spark, folder, schemas.EVENT), "event_idx")


def event_records(events: DataFrame) -> DataFrame:
    """Events as JSON records with their keys in the fixed order."""
    return events.select("dialogue_id", "event_idx", F.to_json(F.struct(*schemas.EVENT_KEYS), {"ignoreNullFields": "false"}).alias("record"))


def words_of_alignments(alignments: DataFrame, speaker: str) -> DataFrame:
    """Words from alignments (dialogue_id, items: array<struct<text, span: struct<start, end>, tag>>) of one speaker."""
    x = alignments.select("dialogue_id", F.posexplode("items").alias("word_idx", "x"))
    return x.select("dialogue_id", "word_idx", F.lit(speaker).alias("speaker"), F.col("x.text").alias("word"), F.col("x.span.start").alias("start"), F.col("x.span.end").alias("end"))


def file_ids(spark: SparkSession, folder: str, suffix: str) -> DataFrame:
    """Ids of the files of a folder, by suffix, without reading them."""
    f = spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").load(folder)
    return f.select(F.regexp_extract("path", rf"([^/]*){suffix.replace('.', '[.]')}$", 1).alias("id"))


def pending(ids: DataFrame, done: DataFrame, key: str = "id") -> DataFrame:
    """Ids that aren't done yet: a job that is started again goes on with these."""
    return ids.join(done.select(key).distinct(), key, "left_anti")


def log_status(spark: SparkSession, folder: str) -> DataFrame:
    """(id, status): the status in the last line that names an id, over logs in the order of their names."""
    t = spark.read.option("wholetext", True).text(folder).select(F.col("_metadata.file_name").alias("file"), F.posexplode(F.split("value", r"\r?\n")).alias("line_no", "line"))
    pattern = r"^\[\d+/\d+\] (\S+): (.*?)(?: \(\d+s\))?$"
    line = F.trim("line")
    t = t.where(line.rlike(pattern)).select(F.regexp_extract(line, pattern, 1).alias("id"), F.regexp_extract(line, pattern, 2).alias("status"), F.struct("file", "line_no").alias("at"))
    return t.groupBy("id").agg(F.max_by("status", "at").alias("status"))


def log_count(spark: SparkSession, folder: str, text: str = "out of memory") -> DataFrame:
    """(n): lines of the logs that contain a text, whatever the case."""
    return spark.read.text(folder).agg(F.count_if(F.contains(F.lower("value"), F.lit(text))).alias("n"))


def wav_seconds(content: bytes | None) -> float | None:
    """Length of a WAV file from its header; None if it can't be read."""
    try:
        if content is None or content[:4] != b"RIFF" or content[8:12] != b"WAVE":
            return None
        at, rate = 12, 0
        while at + 8 <= len(content):
            name, size = content[at : at + 4], struct.unpack("<I", content[at + 4 : at + 8])[0]
            if name == b"fmt ":
                rate = struct.unpack("<I", content[at + 16 : at + 20])[0]
            if name == b"data":
                return size / rate if rate else None
            at += 8 + size + size % 2
    except struct.error:
        pass
    return None


def wav_durations(spark: SparkSession, folder: str) -> DataFrame:
    """(id, seconds) of the WAV files of a folder."""

    @F.pandas_udf(T.DoubleType())
    def seconds(content: pd.Series) -> pd.Series:
        return content.map(lambda b: wav_seconds(bytes(b)) if b is not None else None).astype("float64")

    f = spark.read.format("binaryFile").option("pathGlobFilter", "*.wav").load(folder)
    return f.select(F.regexp_extract("path", r"([^/]*)[.]wav$", 1).alias("id"), seconds("content").alias("seconds"))


def ranked(df: DataFrame, key: str = "dialogue_id", tasks: int | None = None) -> DataFrame:
    """``df`` with ``place``, from 0: rows in the order of ``key`` (nulls first, then of the whole row).

    Rows are dealt to ranges of the key with sampled bounds, each range is sorted and counted, and the counts
    of the ranges before it are added; no task sees more than its range. The ranges are written once, so that
    numbers and counts come of the same split.
    """
    rest = [c for c in df.columns if c != key]
    order = [F.col(key).asc_nulls_first(), F.xxhash64(*[F.col(c) for c in rest]) if rest else F.lit(0)]
    ranged = df.repartitionByRange(tasks, *order) if tasks else df.repartitionByRange(*order)
    ranged = checkpointed(ranged.withColumn("__range", F.spark_partition_id()))
    counts = ranged.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))
    # One row per task: as many as there are partitions, whatever the number of rows.
    before = counts.select(F.col("__range").alias("__r"), (F.sum("__n").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1))).alias("__before"))
    place = F.row_number().over(Window.partitionBy("__range").orderBy(*order)) - 1 + F.coalesce("__before", F.lit(0))
    return ranged.join(before, F.col("__range") == F.col("__r")).withColumn("place", place.cast("bigint")).drop("__range", "__r", "__before")


def sharded(df: DataFrame, key: str = "dialogue_id", per_file: int = 100_000, tasks: int | None = None) -> DataFrame:
    """``df`` with ``shard``: ``per_file`` rows in the order of ``key`` to a shard."""
    return ranked(df, key, tasks).withColumn("shard", F.floor(F.col("place") / per_file)).drop("place")


def listed(df: DataFrame, key: str, most: int | None = None) -> DataFrame:
    """A listing in the order of ``key``; with ``most`` its first rows only, as a caller who asks for a limited run wants."""
    out = df.orderBy(key)
    return out.limit(most) if most is not None else out


def write_shards(df: DataFrame, path: str, key: str = "dialogue_id", per_file: int = 100_000) -> None:
    """Parquet in shards of ``per_file`` rows in the order of the key, a folder shard=N each. A failed write leaves nothing readable behind."""
    n = sharded(df, key, per_file)
    n.repartition("shard").sortWithinPartitions("shard", key).write.mode("overwrite").partitionBy("shard").parquet(path)


def read_shards(spark: SparkSession, paths: Sequence[str], changes: Sequence[Callable[[DataFrame], DataFrame]] | None = None) -> DataFrame:
    """Parquet files or globs as one table, each changed in its own way first."""
    parts = [spark.read.parquet(p) for p in paths]
    parts = [f(d) for f, d in zip(changes, parts)] if changes else parts
    out = parts[0]
    for d in parts[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def valid_packed(packed: DataFrame, speakers: Sequence[str] = ("A", "B")) -> DataFrame:
    """``packed`` rows with ``valid``: all lists of each speaker are there, as long as each other, and offsets begin at 0, never fall and end with the values.

    A job that is started again counts only valid rows as done.
    """
    require(packed, [f"{s}_oracle_{c}" for s in speakers for c in schemas.PACKED])
    ok = F.lit(True)
    for s in speakers:
        c = lambda name: F.col(f"{s}_oracle_{name}")  # noqa: B023, E731
        n = F.size(c("event_frame_pos"))
        ok = ok & (F.size(c("event_ratio")) == n) & (F.size(c("event_skip_forbid")) == n)
        for kind in ("pred", "hint"):
            o = c(f"{kind}_offsets")
            rises = F.forall(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: (i > n) | (F.get(o, i) >= F.get(o, i - 1)))  # noqa: B023
            ok = ok & (F.size(o) == n + 1) & (F.get(o, F.lit(0)) == 0) & (F.element_at(o, -1) == F.size(c(f"{kind}_values"))) & rises
    return packed.withColumn("valid", F.coalesce(ok, F.lit(False)))


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The table, if it has the columns; else an error when the plan is made."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"missing columns: {missing}")
    return df


def write_report(df: DataFrame, path: str, kind: str = "csv") -> None:
    """A small report in one file: csv, json (a line per row) or text (one column). For results of reports, not of tables."""
    w = df.coalesce(1).write.mode("overwrite")
    {"csv": lambda: w.option("header", True).csv(path), "json": lambda: w.json(path), "text": lambda: w.text(path)}[kind]()


def append_lines(df: DataFrame, path: str) -> None:
    """JSON lines, appended."""
    df.write.mode("append").json(path)


def parse_speakers(spec: str) -> list[str]:
    """'A', 'B' or 'A,B'."""
    out = [x.strip() for x in spec.split(",")]
    if not out or any(x not in ("A", "B") for x in out) or len(set(out)) != len(out):
        raise ValueError(f"bad speakers: {spec!r}")
    return out


def parse_thresholds(default: str, overrides: Sequence[str] = ()) -> dict[str | None, tuple[float, float, float]]:
    """Three thresholds 'a,b,c' by default (None) and by voice ('VOICE=a,b,c')."""

    def three(s: str) -> tuple[float, float, float]:
        v = [float(x) for x in s.split(",")]
        if len(v) != 3:
            raise ValueError(f"three numbers expected: {s!r}")
        return v[0], v[1], v[2]

    return {None: three(default)} | {k: three(v) for k, _, v in (o.partition("=") for o in overrides)}


def prompt_parts(text: str) -> list[str]:
    """The three parts of a prompt file, split at lines of ---; the second has no placeholders."""
    parts = [p.strip() for p in text.split("\n---\n")]
    if len(parts) != 3 or "{{" in parts[1]:
        raise ValueError("a prompt has three parts, the second without placeholders")
    return parts
