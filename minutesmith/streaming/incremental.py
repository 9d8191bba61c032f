"""Incremental import and event-time windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def append_once(batch: DataFrame, store: str, key: str, compared: list[str], report: str | None = None, batch_id: int | None = None) -> None:
    """Append the rows of batch whose key the store lacks: the first delivery wins, within a batch by its rows' digests.

    What was delivered again goes to `report` as (key, same): whether it equals what is stored; it never replaces it. The durable rule is
    the anti-join with the store, so no state expires. With batch_id the report of a batch has its own folder, which a batch that is run again
    replaces."""
    spark = batch.sparkSession
    rows = batch.withColumn("_digest", F.sha2(F.to_json(F.struct(*compared)), 256))
    others = [c for c in rows.columns if c != key]
    first = rows.groupBy(key).agg(F.min_by(F.struct(*others), "_digest").alias("_r")).select(key, *(F.col(f"_r.{c}").alias(c) for c in others))
    stored = spark.read.schema(rows.schema).parquet(store) if _exists(spark, store) else None
    new = first if stored is None else first.join(stored.select(key), key, "left_anti")
    if report is not None:
        base = new if stored is None else new.select(key, "_digest").unionByName(stored.select(key, "_digest"))
        again = rows.select(key, "_digest").join(base.select(key, F.col("_digest").alias("_old")), key)
        known = again.where("_digest <> _old") if stored is None else again.join(stored.select(key), key, "left_semi")
        known.select(key, (F.col("_digest") == F.col("_old")).alias("same")).write.mode("append" if batch_id is None else "overwrite").parquet(report if batch_id is None else f"{report}/batch={batch_id}")
    new.write.mode("append").parquet(store)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def import_stream(spark: SparkSession, folder: str, ddl: str, store: str, checkpoint: str, key: str, compared: list[str]) -> StreamingQuery:
    """Import what has newly arrived in a folder of parquet files, then stop; a second run adds nothing that is stored."""
    incoming = spark.readStream.schema(ddl).parquet(folder)
    return incoming.writeStream.foreachBatch(lambda df, _: append_once(df, store, key, compared)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, ts: str, kind: str, value: str, width: str = "1 hour", late: str | None = None) -> DataFrame:
    """(start, kind, n, total) by tumbling window; with `late`, as a stream that waits so long for late rows."""
    rows = events.withWatermark(ts, late) if late else events
    grouped = rows.groupBy(F.window(ts, width), kind).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
    return grouped.select(F.col("window.start").alias("start"), kind, "n", "total")


def sessions(events: DataFrame, user: str, ts: str, gap: str = "30 minutes") -> DataFrame:
    """(user, start, n) of stretches without a gap."""
    grouped = events.groupBy(user, F.session_window(ts, gap)).agg(F.count("*").alias("n"))
    return grouped.select(user, F.col("session_window.start").alias("start"), "n")

