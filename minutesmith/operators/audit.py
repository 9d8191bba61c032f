"""What is there against what should be: resumption, completeness, routing, reconciliation, checks of quality."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from minutesmith.functions.text import nfkc, normal_speaker

LENGTHS = 5000  # different lengths of prefixes


def unseen(listing: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Rows of a listing whose key is not in seen: NULL keys are unseen."""
    return listing.join(seen.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")


def missing(listing: DataFrame, corpus: DataFrame, key: str, order: str) -> DataFrame:
    """Listed but not collected: one row per key, as last listed."""
    others = [c for c in listing.columns if c != key]
    last = listing.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*others), F.struct(order, *[c for c in others if c != order])).alias("_r"))
    rows = last.select(key, *(F.col(f"_r.{c}").alias(c) for c in others))
    return unseen(rows, corpus, key).select(*listing.columns)


def presence(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of either side and whether each has them: 'both', 'left only' or 'right only'."""
    a, b = left.select(*keys).distinct().withColumn("_a", F.lit(1)), right.select(*keys).distinct().withColumn("_b", F.lit(1))
    where = F.when(F.col("_a").isNull(), "right only").when(F.col("_b").isNull(), "left only").otherwise("both")
    return a.join(b, keys, "full_outer").select(*keys, where.alias("found"))


def longest_prefix(df: DataFrame, url: str, routes: DataFrame, prefix: str, route: str) -> DataFrame:
    """df with the route of the longest prefix its address begins with; NULL if none does.

    Every address is cut at the lengths that prefixes have (at most LENGTHS of them) and what is cut off is joined to the prefixes: equal strings
    meet, so no host, however hot, is compared with itself in one task."""
    keyed = routes.where(F.length(prefix) > 0).groupBy(F.col(prefix).alias("_p")).agg(F.max(route).alias("_to"))
    lengths = [r[0] for r in keyed.select(F.length("_p").alias("n")).distinct().orderBy("n").limit(LENGTHS + 1).collect()]
    if len(lengths) > LENGTHS:
        raise ValueError(f"prefixes of more than {LENGTHS} lengths")
    rows = df.select(url).where(F.col(url).isNotNull()).distinct()
    cut = rows.withColumn("_n", F.explode(F.filter(F.array(*map(F.lit, lengths)).cast("array<int>"), lambda n: n <= F.length(url)))).withColumn("_p", F.col(url).substr(F.lit(1), F.col("_n")))
    best = cut.join(keyed, "_p").groupBy(url).agg(F.max_by("_to", "_n").alias(route))
    return df.join(best, url, "left")


def unrouted(routed: DataFrame, route: str) -> int:
    """Rows without a route; a writer must stop if there are any."""
    return routed.where(F.col(route).isNull()).count()


def preferred_edition(df: DataFrame, group: list[str], edition: str, best: str, second: str) -> DataFrame:
    """df without rows of the second edition of a label that also has the best one."""
    ready = df.where(F.col(edition) == best).select(*group).distinct()
    kept = df.where(F.col(edition) == second).join(ready, group, "left_anti")
    return df.where(~F.col(edition).eqNullSafe(F.lit(second))).unionByName(kept.select(*df.columns))


def name_differences(index: DataFrame, corpus: DataFrame, group: list[str], name: str, normal: Callable[[Column], Column] = normal_speaker) -> DataFrame:
    """Names of an index that do not speak in the corpus, by group. A join of distinct names, not of collected sets. normal: one spelling of a name."""
    listed = index.select(*group, normal(F.col(name)).alias(name)).where(F.col(name) != "").distinct()
    spoken = corpus.select(*group, normal(F.col(name)).alias(name)).distinct()
    return listed.join(spoken, [*group, name], "left_anti")


def stated_against_found(df: DataFrame, group: str, stated: str, item: str) -> DataFrame:
    """Groups whose stated number differs from the distinct items found."""
    found = df.groupBy(group).agg(F.max(stated).cast("bigint").alias("stated"), F.count_distinct(item).alias("found"))
    return found.where("stated <> found")


def gaps(df: DataFrame, group: str, number: str, first: int = 0) -> DataFrame:
    """Groups whose numbers are not first, first + 1, ...: how many are missing below the greatest.

    Counting needs no list of numbers, so a group of any size is two aggregates."""
    found = df.groupBy(group).agg(F.max(number).alias("last"), F.min(number).alias("least"), F.count_distinct(number).alias("distinct_numbers"), F.count(number).alias("numbers"))
    lacking = (F.col("last") - F.lit(first) + 1 - F.col("distinct_numbers")).cast("bigint")
    return found.select(group, lacking.alias("missing"), (F.col("numbers") - F.col("distinct_numbers")).cast("bigint").alias("repeated")).where("missing > 0 or repeated > 0")


def rewritten(before: DataFrame, after: DataFrame, key: str, order: str, compared: list[str]) -> DataFrame:
    """What a rewrite changed: one row per kind of change with its count, by digest of the compared columns."""
    digest = lambda df, name: df.select(key, order, F.sha2(F.to_json(F.struct(*compared)), 256).alias(name))
    both = digest(before, "_old").join(digest(after, "_new"), [key, order], "full_outer")
    change = F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "removed").when(F.col("_old") != F.col("_new"), "changed").otherwise("same")
    return both.groupBy(change.alias("change")).agg(F.count("*").alias("n"))


def swallowed_markers(speeches: DataFrame, text: str = "text") -> DataFrame:
    """Speeches with a line that begins with a circle: a marker that was not split at."""
    return speeches.where(F.col(text).rlike("(?dm)^[○◯〇◎◆●]"))


def name_collisions(df: DataFrame, name: str) -> DataFrame:
    """Normalised names that are spelled in several ways, with the number of spellings."""
    spelled = df.where(F.col(name) != "").groupBy(name).agg(F.count("*").alias("n"))
    return spelled.groupBy(normal_speaker(F.col(name)).alias("normal")).agg(F.count("*").alias("spellings"), F.sum("n").alias("n")).where("spellings > 1")


def private_use(text: Column) -> Column:
    return text.rlike("[\\x{E000}-\\x{F8FF}]")


def with_and_without_office(df: DataFrame, name: str, offices: DataFrame, office: str) -> DataFrame:
    """Names that also occur with an office behind them: every name is cut at each place and the end joined to the offices."""
    names = df.select(name).where(F.length(name) > 1).distinct()
    cut = names.select(F.col(name).alias("titled"), F.explode(F.sequence(F.lit(1), F.length(name) - 1)).alias("i"))
    parts = cut.select("titled", F.expr("substring(titled, 1, i)").alias("bare"), F.expr("substring(titled, i + 1)").alias("_o"))
    return parts.join(offices.select(F.col(office).alias("_o")).distinct(), "_o").join(names.select(F.col(name).alias("bare")), "bare", "left_semi").select("bare", "titled", F.col("_o").alias("office"))


def edition_label(text: Column) -> Column:
    """A label for pairing editions: NFKC without spaces."""
    return F.regexp_replace(nfkc(text), r"(?U)\s+", "")
