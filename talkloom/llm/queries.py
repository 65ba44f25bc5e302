"""Queries p2, p3 and p5 to p8."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkloom.llm import mixing, packing, pairs, repetition, splitting, tokens, turns
from talkloom.llm.sql import SQL
from talkloom.session import checkpointed
from talkloom.sources.tables import table

#: Texts in which more than this share of the words is repeated are reported.
REPEATED_ABOVE = 0.4


def p2_defects(spark: SparkSession, folder: str) -> DataFrame:
    """Every defect of every event, with its posterior."""
    return pairs.defects(table(spark, folder, "oracle_raw")).withColumn("posterior", F.round("posterior", 6))


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """Every defective event with its first defect."""
    return pairs.first_defect(pairs.defects(table(spark, folder, "oracle_raw")))


def _pieces(spark: SparkSession, folder: str) -> DataFrame:
    return splitting.split(table(spark, folder, "words"), table(spark, folder, "oracle_raw"))


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """Dialogues that had to be cut, and whether a stretch of speech leaves no silence to cut in, by the cuts made."""
    _, found = splitting.cuts(table(spark, folder, "words"), table(spark, folder, "oracle_raw"))
    return splitting.cut_kinds(found)


def p3_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """Every piece with its time, the kind of its end, and the number of its words and events."""
    p = checkpointed(_pieces(spark, folder))
    w = splitting.speech_of(table(spark, folder, "words")).select("dialogue_id", "word_idx", F.col("start_ms").alias("at")).distinct()
    e = table(spark, folder, "oracle_raw").select("dialogue_id", "event_idx", F.col("timestamp_ms").alias("at")).distinct()
    n = [splitting.members(p, x, "at").groupBy("dialogue_id", "piece_no").agg(F.count(F.lit(1)).alias(c)) for x, c in ((w, "n_words"), (e, "n_events"))]
    keys = ["dialogue_id", "piece_no"]
    out = splitting.joined(splitting.joined(p, n[0], keys, "left"), n[1], keys, "left")
    return out.select("dialogue_id", "piece_no", "from_ms", "to_ms", "end_kind", F.coalesce("n_words", F.lit(0)).alias("n_words"), F.coalesce("n_events", F.lit(0)).alias("n_events"))


def _spoken(spark: SparkSession, folder: str) -> DataFrame:
    return turns.spoken_words(table(spark, folder, "raw_words"), table(spark, folder, "speaker_aliases"), table(spark, folder, "dialogues"))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """Every turn with its speaker, first word and number of words."""
    return turns.turns(_spoken(spark, folder)).select("dialogue_id", "first_word_idx", "speaker", "n_words")


def p5_turns(spark: SparkSession, folder: str) -> DataFrame:
    """Every turn in order, with time and words."""
    return turns.turns(_spoken(spark, folder), texts=True)


def p6_items(spark: SparkSession, folder: str) -> DataFrame:
    """A training item and a place in it for every text or piece."""
    docs = table(spark, folder, "documents").select("doc_id", tokens.n_tokens(F.col("text")).alias("n_tokens"))
    return packing.pack(docs, "doc_id", "n_tokens").withColumnRenamed("id", "doc_id")


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    """Texts that the packing had to split."""
    return p6_items(spark, folder).where("piece = 1").select("doc_id").distinct()


def p6_fill(spark: SparkSession, folder: str) -> DataFrame:
    """Number of items, tokens, and the share of room left over."""
    items = p6_items(spark, folder).where("tokens > 0").groupBy("item_no").agg(F.sum("tokens").alias("t"))
    n, t = F.count(F.lit(1)), F.sum("t")
    return items.agg(
        n.alias("n_items"), t.alias("n_tokens"), F.ceil(t / packing.CAPACITY).alias("least_items"),
        F.round(1 - t / (n * packing.CAPACITY), 6).alias("room_left"), F.max("t").alias("largest"),
    )


def _mix_tables(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    d = table(spark, folder, "documents")
    docs = d.select("doc_id", tokens.plain_source(F.col("source")).alias("source"), tokens.n_tokens(F.col("text")).alias("n_tokens"))
    targets = table(spark, folder, "mix_targets")
    return docs, targets.withColumn("source", tokens.plain_source(F.col("source")))


def p7_report(spark: SparkSession, folder: str) -> DataFrame:
    """Budget, use and share reached of every source."""
    return mixing.report(*mixing.budgets(*_mix_tables(spark, folder), "source", "n_tokens"))


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    """Sources that the fitted plan leaves below their budget although it uses each text as often as it may be; the shares decide exactly."""
    return p7_report(spark, folder).where("exhausted and short").select("source")


def p7_uses(spark: SparkSession, folder: str) -> DataFrame:
    """Number of uses of every text."""
    docs, targets = _mix_tables(spark, folder)
    _, plan = mixing.budgets(docs, targets, "source", "n_tokens")
    return mixing.uses(docs, plan, "doc_id", "source", "n_tokens").withColumnRenamed("id", "doc_id")


def p8_share(spark: SparkSession, folder: str) -> DataFrame:
    """The repeated share of every text."""
    d = repetition.repeated_share(table(spark, folder, "documents"))
    return d.select(F.col("id").alias("doc_id"), "n_words", "n_repeated")


def p8_divergence(spark: SparkSession, folder: str) -> DataFrame:
    """Divergence of every text from its language's histograms."""
    docs = table(spark, folder, "documents")
    return repetition.divergence(docs, repetition.references(docs)).withColumnRenamed("id", "doc_id")


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    """Texts in which more than two fifths of the words are repeated."""
    return p8_share(spark, folder).where(F.col("n_repeated") * 5 > F.col("n_words") * 2).select("doc_id")


QUERIES = {
    "p2_found": p2_found, "p2_defects": p2_defects,
    "p3_found": p3_found, "p3_pieces": p3_pieces,
    "p5_found": p5_found, "p5_turns": p5_turns,
    "p6_found": p6_found, "p6_items": p6_items, "p6_fill": p6_fill,
    "p7_found": p7_found, "p7_report": p7_report, "p7_uses": p7_uses,
    "p8_found": p8_found, "p8_share": p8_share, "p8_divergence": p8_divergence,
}
