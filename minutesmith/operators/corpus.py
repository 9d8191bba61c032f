"""Meetings and speeches: nesting, flattening, derived kind, statistics, routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from minutesmith.functions.text import record_key, slug


def latest(df: DataFrame, key: str, at: str) -> DataFrame:
    """One row per key: the one delivered last. Aggregation rather than a window, so hot keys combine before the shuffle."""
    others = [c for c in df.columns if c != key]
    packed = df.groupBy(key).agg(F.max_by(F.struct(*others), F.struct(at, *[c for c in others if c != at])).alias("_r"))
    return packed.select(key, *(F.col(f"_r.{c}").alias(c) for c in others)).select(*df.columns)


def nest(meetings: DataFrame, speeches: DataFrame, key: str, order: str, fields: list[str]) -> DataFrame:
    """meetings with `speeches`, the array of their rows in order; an empty array where there are none."""
    rows = speeches.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("order"), *[f for f in fields if f != order]))).alias("speeches"))
    empty = F.array().cast(rows.schema["speeches"].dataType)
    return meetings.join(rows, key, "left").withColumn("speeches", F.coalesce("speeches", empty))


def flatten(nested: DataFrame, order_name: str = "speech_order") -> DataFrame:
    """One row per speech, meeting columns repeated; one row with NULL speech columns for a meeting without speeches."""
    others = [c for c in nested.columns if c != "speeches"]
    flat = nested.select(*others, F.inline_outer("speeches"))
    return flat.withColumnRenamed("order", order_name)


def meeting_kind(speeches: Column) -> Column:
    """summary if there are passages and all are of a summary, else verbatim."""
    return F.when((F.size(speeches) > 0) & F.forall(speeches, lambda s: s["kind"] == "summary"), "summary").otherwise("verbatim")


def full_text(speeches: Column) -> Column:
    return F.array_join(F.transform(speeches, lambda s: s["text"]), "\n\n")


def stats(meetings: DataFrame, speeches: DataFrame, by: list[str], key: str = "meeting_id", size: Column | None = None) -> DataFrame:
    """Counts of meetings, speeches, characters and dates. Both inputs are aggregated before they meet, so nothing is joined at the
    grain of speeches. size: characters of a speech, for speeches that no longer carry their text."""
    size = F.length("text") if size is None else size
    per_meeting = speeches.groupBy(key).agg(
        F.count("*").alias("n"), F.count_if(F.col("kind") == "verbatim").alias("verbatim"), F.sum(F.when(F.col("kind") == "verbatim", size).otherwise(0)).alias("chars"),
        F.count_if(F.col("kind") == "summary").alias("summary"), F.sum(F.when(F.col("kind") == "summary", size).otherwise(0)).alias("summary_chars"),
    )
    joined = meetings.join(per_meeting, key, "left").fillna(0, ["n", "verbatim", "chars", "summary", "summary_chars"])
    only_summary = (F.col("n") > 0) & (F.col("summary") == F.col("n"))
    return joined.groupBy(*by).agg(
        F.count_if(~only_summary).alias("meetings"), F.count_if(only_summary).alias("summary_records"), F.sum("verbatim").alias("speeches"), F.sum("chars").alias("characters"),
        F.sum("summary").alias("summary_passages"), F.sum("summary_chars").alias("summary_characters"), F.min("meeting_date").alias("first_date"), F.max("meeting_date").alias("last_date"),
        F.count_if(F.col("n") == 0).alias("without_speeches"),
    )


def with_key(df: DataFrame) -> DataFrame:
    """df with record_key; a record without address and file is an error when the plan runs."""
    key = record_key(F.col("url"), F.col("source_file"))
    return df.withColumn("record_key", F.when(key.isNull(), F.raise_error(F.lit("a record has neither url nor source_file")).cast("string")).otherwise(key))


def routed_path(prefecture: Column, kind: Column) -> Column:
    """The file a record belongs to: summaries apart from transcripts."""
    name = F.concat(slug(prefecture), F.lit(".jsonl"))
    return F.when(kind == "summary", F.concat(F.lit("summary/"), name)).otherwise(name)


def top_counts(df: DataFrame, column: str, n: int | None = None, name: str = "n") -> DataFrame:
    """Values by frequency, ties by value; the n first of them."""
    counts = df.groupBy(column).agg(F.count("*").alias(name)).orderBy(F.desc(name), F.asc_nulls_first(column))
    return counts if n is None else counts.limit(n)


def pooled_offices(speeches: DataFrame, least: int = 2) -> DataFrame:
    """Distinct offices of at least so many characters."""
    return speeches.where(F.length("role") >= least).select("role").distinct()


def examples(df: DataFrame, group: str, order: list[str], n: int) -> DataFrame:
    """The first n rows of each group."""
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")
