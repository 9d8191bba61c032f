"""Session helpers shared by every operator."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Where lineage is cut when the session names no folder (tests and local runs only).
LOCAL_CHECKPOINTS = "/tmp/minutesmith-checkpoints"
_KEPT: list[str] = []


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A parquet table of the corpus."""
    return spark.read.parquet(f"{root}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster. Only a local session that names none gets one of this machine; on a cluster that is an error, for
    executors would write where others cannot read."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        if shared is None:
            if not context.master.startswith("local[") and context.master != "local":
                raise ValueError("spark.checkpoint.dir names no shared folder")
            os.makedirs(LOCAL_CHECKPOINTS, exist_ok=True)
            shared = LOCAL_CHECKPOINTS
        context.setCheckpointDir(shared)
    return context._jsc.sc().getCheckpointDir().get()


def keep(df: DataFrame, name: str, **options: str) -> DataFrame:
    """df, written once to the shared folder and read from there: for what is used several times, so that a lost executor costs a re-read.
    release() removes what is kept."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    _KEPT.append(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> int:
    """Remove what this process has kept, once its results are written; the number of folders removed."""
    removed = 0
    while _KEPT:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_KEPT.pop())
        removed += bool(folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True))
    return removed


def small(df: DataFrame, limit: int) -> bool:
    """Whether df has at most limit rows; looks at no more than limit + 1 of them."""
    return df.limit(limit + 1).count() <= limit


def broadcast_if_small(df: DataFrame, limit: int) -> DataFrame:
    """df with a broadcast hint if its row count is at most limit; else as it is, for a shuffled join."""
    return F.broadcast(df) if small(df, limit) else df
