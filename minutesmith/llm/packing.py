"""Containers of fixed capacity filled with items of varying length.

Method: sum-of-squares online packing. Items come in the order of their ids; each goes to the fill level at which the sum of
the squared counts of partly filled containers grows least (or a new container is opened), tracked in an array of counts by level. An item
longer than the capacity is split into full containers and a rest that is packed like any other; nothing else is split.

Scale: items are dealt by a hash of their id to shards of about SHARD tokens, each packed by itself in one task with an array
of one counter per level, so no task grows with the data; a shard leaves only its last containers unfilled.

Results that are defined: items of NULL size, of size zero or below lie in no container; repeated rows of an id are one item each;
a capacity below one is an error; equal inputs give equal containers; no items give no containers.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHARD = 1 << 22
PROFILES = 1000  # capacities at most: a table of settings, read by the driver


def pack(sizes: list[int], capacity: int) -> list[list[tuple[int, int]]]:
    """For each item its parts as (container, tokens); containers from 0."""
    if capacity < 1:
        raise ValueError(f"capacity {capacity} is below one")
    counts = np.zeros(capacity + 1, np.int64)  # containers by level; levels 0 and capacity do not count
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    made = 0
    out: list[list[tuple[int, int]]] = []
    for size in sizes:
        parts = []
        while size > capacity:
            parts.append((made, capacity))
            made += 1
            size -= capacity
        if size > 0:
            # Moving a container from level h to h + size changes the sum of squares by 2 (N[h + size] - N[h]) + 2,
            # less where h + size is full; a new one by 2 N[size] + 1.
            levels = np.flatnonzero(counts[1 : capacity - size + 1]) + 1
            after = np.where(levels + size == capacity, 0, 2 * counts[np.minimum(levels + size, capacity)] + 1)
            change = after - 2 * counts[levels] + 1
            fresh = 2 * counts[size] + 1 if size < capacity else 0
            if len(levels) and change.min() <= fresh:
                best = levels[change == change.min()].max()  # of equal changes the fullest container
                container = open_at[best].pop()
                counts[best] -= 1
                level = int(best) + size
            else:
                container, level = made, size
                made += 1
            if level < capacity:
                counts[level] += 1
                open_at[level].append(container)
            parts.append((container, size))
        out.append(parts)
    return out


def pack_items(items: DataFrame, item: str, size: str, profiles: DataFrame, shard_tokens: int = SHARD) -> DataFrame:
    """(profile, capacity, container, item, part, start, tokens) of every part of every item, for each row of profiles
    (profile, capacity_tokens). start is the place of the part in its item."""
    settings = [(r[0], int(r[1])) for r in profiles.select("profile", "capacity_tokens").where("profile is not null and capacity_tokens is not null").distinct().orderBy("profile").limit(PROFILES + 1).collect()]
    if len(settings) > PROFILES:
        raise ValueError(f"more than {PROFILES} capacities")
    if any(c < 1 for _, c in settings):
        raise ValueError("a capacity is below one")
    kind = items.schema[item].dataType.simpleString()
    schema = f"profile string, capacity int, container bigint, item {kind}, part int, start bigint, tokens int"
    if not settings:
        return items.sparkSession.createDataFrame([], schema)
    own = items.select(F.col(item).alias("item"), F.col(size).cast("bigint").alias("size")).where("size > 0")
    total = own.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("t")).first()["t"]
    shards = max(1, round(total / shard_tokens))
    options = F.array(*(F.struct(F.lit(p).alias("profile"), F.lit(c).alias("capacity")) for p, c in settings))
    dealt = own.withColumn("shard", F.pmod(F.xxhash64("item"), F.lit(shards))).select("*", F.explode(options).alias("o")).select("shard", "item", "size", "o.profile", "o.capacity")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["item", "size"], kind="stable")
        capacity, base = int(pdf["capacity"].iloc[0]), int(pdf["shard"].iloc[0]) << 32
        rows = []
        for i, parts in zip(pdf["item"], pack(pdf["size"].tolist(), capacity), strict=True):
            start = 0
            for n, (container, tokens) in enumerate(parts):
                rows.append((pdf["profile"].iloc[0], capacity, base + container, i, n, start, tokens))
                start += tokens
        return pd.DataFrame(rows, columns=["profile", "capacity", "container", "item", "part", "start", "tokens"])

    return dealt.groupBy("profile", "shard").applyInPandas(run, schema)


def report(packed: DataFrame) -> DataFrame:
    """(profile, capacity, containers, least_containers, tokens, fill) of each profile."""
    by = packed.groupBy("profile", "capacity", "container").agg(F.sum("tokens").alias("t"))
    out = by.groupBy("profile", "capacity").agg(F.count("*").alias("containers"), F.sum("t").alias("tokens"))
    return out.select("profile", "capacity", "containers", F.ceil(F.col("tokens") / F.col("capacity")).cast("bigint").alias("least_containers"), "tokens", (F.col("tokens") / (F.col("containers") * F.col("capacity"))).alias("fill"))
