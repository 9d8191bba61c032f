"""Queries of the training-data problems, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from minutesmith.llm import abuse, canonical, encoding, glossary, lookalikes, mixing, names, nearcopies, packing, sentences, tokens, turns
from minutesmith.llm.sql import SQL
from minutesmith.runtime import keep, table


def _typed(spark: SparkSession, root: str) -> DataFrame:
    """(field, record_id, value) of the freely typed values; redelivered rows once."""
    committees = table(spark, root, "meetings").select(F.lit("committee").alias("field"), F.col("meeting_id").alias("record_id"), F.col("committee").alias("value"))
    roles = table(spark, root, "speaker_index").select(F.lit("role").alias("field"), F.col("entry_id").alias("record_id"), F.col("role").alias("value"))
    return committees.unionByName(roles).where("value is not null").distinct()


def p1_found(spark: SparkSession, root: str) -> DataFrame:
    typed, reference = _typed(spark, root), table(spark, root, "canon_values")
    mapped = canonical.map_values(typed, reference, "field", "value", "canon_id", "name", glossary.READINGS, glossary.OTHER_READINGS, glossary.ENGLISH)
    other = typed.join(reference.select("field", F.col("name").alias("value")), ["field", "value"], "left_anti")
    return other.join(mapped, ["field", "value"]).select("field", "record_id", "canon_id").distinct()


def p2_found(spark: SparkSession, root: str) -> DataFrame:
    speeches = table(spark, root, "speeches").select("meeting_id", "speech_id", "speech_order", "text")
    # Only records of meetings.
    docs = nearcopies.assemble(speeches, "meeting_id", "speech_id", "speech_order", "text", known=table(spark, root, "meetings"))
    return nearcopies.similar_pairs(docs).select(F.col("a").alias("meeting_a"), F.col("b").alias("meeting_b"))


def p2_classes(spark: SparkSession, root: str) -> DataFrame:
    """Every document in its class, so that copies need not be listed as pairs."""
    speeches = table(spark, root, "speeches").select("meeting_id", "speech_id", "speech_order", "text")
    docs = nearcopies.assemble(speeches, "meeting_id", "speech_id", "speech_order", "text")
    return nearcopies.classes(docs).select(F.col("doc").alias("meeting_id"), F.col("head").alias("same_text_as"), "class", "links")


def p3_found(spark: SparkSession, root: str) -> DataFrame:
    targets = table(spark, root, "sentence_targets").select("speech_id").where("speech_id is not null")
    wanted = table(spark, root, "speeches").select("speech_id", "text").join(targets, "speech_id", "left_semi")
    once = wanted.groupBy("speech_id").agg(F.max("text").alias("text"))
    return sentences.sentences(once, "speech_id", "text").select("speech_id", "end_char")


def p4_found(spark: SparkSession, root: str) -> DataFrame:
    linked = names.link(table(spark, root, "speaker_index"), "entry_id", "council_id", "speaker", "kana", "role", glossary.ENDINGS)
    return names.pairs(linked, "entry_id")


def p4_entities(spark: SparkSession, root: str) -> DataFrame:
    """Every entry with the least entry of its entity and how many entries name it, so that large entities need not be listed as pairs."""
    linked = keep(names.link(table(spark, root, "speaker_index"), "entry_id", "council_id", "speaker", "kana", "role", glossary.ENDINGS), "entities")
    return linked.join(linked.groupBy("entity").agg(F.count("*").alias("entries")), "entity").select("entry_id", "council_id", "entity", "entries")


def p5_found(spark: SparkSession, root: str) -> DataFrame:
    speeches = table(spark, root, "speeches")
    values = (
        speeches.select(F.lit("text").alias("field"), F.col("speech_id").alias("record_id"), F.col("text").alias("value"))
        .unionByName(speeches.select(F.lit("speaker").alias("field"), F.col("speech_id").alias("record_id"), F.col("speaker").alias("value")))
        .unionByName(table(spark, root, "meetings").select(F.lit("session").alias("field"), F.col("meeting_id").alias("record_id"), F.col("session").alias("value")))
    )

    def case(v: pd.Series) -> pd.Series:
        texts = v.tolist()
        damaged = encoding.examine(texts)
        return pd.Series([lookalikes.usual(t) != t and not d for t, (d, _) in zip(texts, damaged, strict=True)], dtype=bool)

    suspicious = values.where(F.col("value").rlike(lookalikes.SUSPECT))
    return suspicious.where(F.pandas_udf(case, "boolean")("value")).select("field", "record_id").distinct()


def p6_found(spark: SparkSession, root: str) -> DataFrame:
    raw = table(spark, root, "raw_transcripts").select("raw_id", "attendees", "body")
    # Parsing costs far more than moving the rows, and a few files would mean a few tasks.
    spread = raw.repartition(spark.sparkContext.defaultParallelism * 4, "raw_id")
    return turns.speaker_turns(spread).select("raw_id", "turn_no", "speaker")


def p7_found(spark: SparkSession, root: str) -> DataFrame:
    texts = table(spark, root, "speeches").select(F.lit("text").alias("field"), F.col("speech_id").alias("record_id"), F.col("text").alias("value"))
    titles = table(spark, root, "meetings").select(F.lit("title").alias("field"), F.col("meeting_id").alias("record_id"), F.col("title").alias("value"))
    checked = texts.unionByName(titles).where("value is not null").withColumn("c", encoding.check_encoding(F.col("value")))
    return checked.where("c.damaged").select("field", "record_id").distinct()


def _sized(spark: SparkSession, root: str) -> DataFrame:
    """(doc_id, source, tokens) of every document; counted once and kept, for it is used several times."""
    docs = table(spark, root, "documents").select("doc_id", "source", "text")
    return keep(docs.select("doc_id", "source", tokens.count_tokens(F.col("text")).alias("tokens")), "sizes")


def p8_packed(spark: SparkSession, root: str) -> DataFrame:
    packed = packing.pack_items(_sized(spark, root), "doc_id", "tokens", table(spark, root, "pack_capacities"))
    return packed.withColumnRenamed("item", "doc_id")


def p8_report(spark: SparkSession, root: str) -> DataFrame:
    return packing.report(packing.pack_items(_sized(spark, root), "doc_id", "tokens", table(spark, root, "pack_capacities")))


def p9_mixed(spark: SparkSession, root: str) -> DataFrame:
    return mixing.mix(_sized(spark, root), table(spark, root, "mix_targets"))


def p9_report(spark: SparkSession, root: str) -> DataFrame:
    targets = table(spark, root, "mix_targets")
    return mixing.report(mixing.mix(_sized(spark, root), targets), targets)


def _learnt(spark: SparkSession, root: str) -> tuple[tuple[str, str, float], ...]:
    """Phrases of the reviewed documents."""
    labels = table(spark, root, "review_labels").groupBy("doc_id").agg(F.max_by(F.struct("flagged", "category"), "labelled_at").alias("l")).select("doc_id", "l.*")
    texts = table(spark, root, "documents").select("doc_id", "text").join(labels, "doc_id").groupBy("doc_id").agg(F.max("text").alias("text"), F.max("flagged").alias("flagged"), F.max("category").alias("category"))
    return abuse.learn(texts, "doc_id", "text", "flagged", "category")


def p10_found(spark: SparkSession, root: str) -> DataFrame:
    texts = table(spark, root, "documents").select("doc_id", "text")
    return texts.where(abuse.scored(F.col("text"), _learnt(spark, root))["score"] >= abuse.FLAG).select("doc_id").distinct()


def p10_rates(spark: SparkSession, root: str) -> DataFrame:
    return abuse.rates(table(spark, root, "documents"), "source", "text", _learnt(spark, root))


def p10_scores(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "documents").select("doc_id", "source", abuse.scored(F.col("text"), _learnt(spark, root)).alias("r")).select("doc_id", "source", "r.score", "r.category", "r.sentence")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"p1_found": p1_found, "p2_found": p2_found, "p2_classes": p2_classes, "p3_found": p3_found, "p4_found": p4_found, "p4_entities": p4_entities, "p5_found": p5_found, "p6_found": p6_found, "p7_found": p7_found, "p8_packed": p8_packed, "p8_report": p8_report, "p9_mixed": p9_mixed, "p9_report": p9_report, "p10_found": p10_found, "p10_rates": p10_rates, "p10_scores": p10_scores}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
