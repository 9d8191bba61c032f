"""Walks over pages linked to each other: breadth first, each page once, at its least depth."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from minutesmith.runtime import checkpoint_dir, keep


def reach(start: DataFrame, links: DataFrame, depth: int) -> DataFrame:
    """(url, depth) of the pages within so many links of start (url). links has source and target.

    One join per level against pages not seen before; each level is written to the shared folder, so a level is never computed twice."""
    spark = start.sparkSession
    base = f"{checkpoint_dir(spark)}/walk-{uuid.uuid4().hex}"

    def stored(df: DataFrame, level: int) -> DataFrame:
        df.write.parquet(f"{base}/{level}")
        return spark.read.schema("url string, depth int").parquet(f"{base}/{level}")

    seen = level = stored(start.select("url").where("url is not null").distinct().withColumn("depth", F.lit(0)), 0)
    for d in range(1, depth + 1):
        next_ = level.select(F.col("url").alias("source")).join(links.select("source", "target"), "source").select(F.col("target").alias("url")).where("url is not null").distinct()
        level = stored(next_.join(seen.select("url"), "url", "left_anti").withColumn("depth", F.lit(d)), d)
        if level.limit(1).count() == 0:
            break
        seen = seen.unionByName(level)
    return seen


def accepted(links: DataFrame, label: str, url: str, include: str | None, exclude: str | None) -> DataFrame:
    """Links that a rule wants, each address once with its last label; filtered before they are made distinct, so a rejected mention does not hide an accepted one."""
    from minutesmith.functions.text import wanted

    kept = links.where(wanted(F.col(label), F.col(url), include, exclude))
    return kept.groupBy(url).agg(F.max_by(label, "position").alias(label), F.min("position").alias("position"))


def levels(pages: DataFrame, links: DataFrame, rules: list[str], excluded: str | None = None) -> DataFrame:
    """Pages reached by following, from pages (url), one link per rule whose label matches it: (url, path of labels)."""
    level = pages.select("url", F.array().cast("array<string>").alias("path"))
    for rule in rules:
        own = links.where(F.col("label").rlike(rule) & (F.lit(True) if excluded is None else ~F.col("label").rlike(excluded)))
        level = level.join(own.select(F.col("source").alias("url"), "target", "label"), "url").select(F.col("target").alias("url"), F.concat("path", F.array("label")).alias("path"))
        level = level.groupBy("url").agg(F.min("path").alias("path"))
    return level


def signposts(pages: DataFrame, links: DataFrame, hints: str, host: str) -> DataFrame:
    """Links within a host whose label or address hints at minutes, each address with its last label."""
    from minutesmith.functions.text import url_host

    own = links.join(pages.select(F.col("url").alias("source")), "source", "left_semi")
    hinted = own.where((url_host(F.col("target")) == host) & (F.col("label").rlike(hints) | F.col("target").rlike(hints)))
    return hinted.groupBy("target").agg(F.max_by("label", "position").alias("label"))


def pages_differ(first: DataFrame, second: DataFrame, item: str) -> bool:
    """Whether a second page of a list shows anything the first does not: else paging does not work."""
    return second.select(item).exceptAll(first.select(item)).limit(1).count() > 0


def missing_nodes(offered: DataFrame, wanted: DataFrame, node: str) -> DataFrame:
    """Nodes (years, sessions) asked for that a site does not offer."""
    return wanted.select(node).distinct().join(offered.select(node).distinct(), node, "left_anti")


def survey(start: DataFrame, links: DataFrame, rules: list[str], focus: str, budget: int, cached: DataFrame) -> DataFrame:
    """(site, url, depth, place) of the pages a first look at sites fetches, in its order: from start (url), by one link per rule whose label matches
    it, with the frames of a page at the page's own depth.

    links: source, target, kind (frame or link), label, position. Within a depth come frames, then what focus names, then the order of the
    pages. A site may ask for `budget` pages that are not in cached (url)."""
    rows = links.select("source", "target", (F.col("kind") == "frame").alias("frame"), F.coalesce("label", F.lit("")).alias("label"), "position")
    level = start.select(F.col("url").alias("site"), "url").distinct().withColumn("depth", F.lit(0)).withColumn("rank", F.struct(F.lit(0).alias("a"), F.lit(0).alias("b"), F.lit(0).cast("bigint").alias("c")))
    seen = keep(level, "survey")
    level = seen
    for depth in range(len(rules) + 1):
        met = level.join(rows, F.col("url") == F.col("source"))
        rank = lambda first: F.struct(first.alias("a"), F.when(F.col("label").rlike(focus), 0).otherwise(1).alias("b"), F.col("position").cast("bigint").alias("c"))
        frames = met.where("frame").groupBy("site", F.col("target").alias("url")).agg(F.min(rank(F.lit(0))).alias("rank")).withColumn("depth", F.lit(depth))
        fresh = keep(frames.select("site", "url", "depth", "rank").join(seen.select("site", "url"), ["site", "url"], "left_anti"), "survey")
        seen = seen.unionByName(fresh)
        if depth == len(rules):
            break
        named = level.unionByName(fresh).join(rows, F.col("url") == F.col("source")).where(~F.col("frame") & F.col("label").rlike(rules[depth]))
        found = named.groupBy("site", F.col("target").alias("url")).agg(F.min(rank(F.lit(1))).alias("rank")).withColumn("depth", F.lit(depth + 1))
        level = keep(found.select("site", "url", "depth", "rank").join(seen.select("site", "url"), ["site", "url"], "left_anti"), "survey")
        seen = seen.unionByName(level)
    order = Window.partitionBy("site").orderBy("depth", "rank", "url")
    asked = seen.join(cached.select("url").distinct().withColumn("stored", F.lit(True)), "url", "left").withColumn("cost", F.when(F.col("stored"), 0).otherwise(1))
    spent = asked.withColumn("spent", F.sum("cost").over(order.rowsBetween(Window.unboundedPreceding, 0))).withColumn("place", F.row_number().over(order))
    return spent.where(F.col("spent") <= budget).select("site", "url", "depth", "place")
