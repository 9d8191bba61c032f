"""Titles that run name and office together: split by a roster, or by names and offices of the whole corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from minutesmith.functions.text import strip


def _longest(found: Column) -> Column:
    """The longest string of an array; NULL if it is empty."""
    return F.aggregate(found, F.lit(None).cast("string"), lambda a, x: F.when(a.isNull() | (F.length(x) > F.length(a)), x).otherwise(a))


def roster_split(title: Column, names: Column, offices: Column) -> Column:
    """struct<speaker, role> of a title and the roster of its sitting: bracketed name; else the longest name it begins with; else the
    longest office it ends with if what is left begins a name; else the title as it is."""
    bracketed = r"(?U)^\s*(.+?)[（(]\s*(.+?)\s*(?:君|さん|氏)?\s*[）)]\s*$"
    in_brackets = title.rlike(bracketed)
    bare = F.regexp_replace(title, r"(?U)\s+", "")
    name = _longest(F.filter(names, lambda n: (n != "") & F.startswith(bare, n)))
    rest_of_name = F.nullif(F.substring(bare, F.length(name) + 1, F.length(bare)), F.lit(""))
    left = lambda o: F.substring(bare, F.lit(1), F.length(bare) - F.length(o))
    office = _longest(F.filter(offices, lambda o: (o != "") & F.endswith(bare, o) & (F.length(bare) - F.length(o) >= 2) & F.exists(names, lambda n: F.startswith(n, left(o)))))
    return (
        F.when(in_brackets, F.struct(F.regexp_replace(F.regexp_extract(title, bracketed, 2), r"(?U)\s+", "").alias("speaker"), strip(F.regexp_extract(title, bracketed, 1)).alias("role")))
        .when(name.isNotNull(), F.struct(name.alias("speaker"), rest_of_name.alias("role")))
        .when(office.isNotNull(), F.struct(left(office).alias("speaker"), office.alias("role")))
        .otherwise(F.struct(title.alias("speaker"), F.lit(None).cast("string").alias("role")))
    )


def decide_titles(titles: DataFrame, names: DataFrame, held: DataFrame, offices: DataFrame, group: str) -> DataFrame:
    """(group, title, speaker, role, outcome) of each distinct title without office.

    titles: group, title. names: group, name. held: group, name, office. offices: office, pooled over all groups.
    Outcomes: name (a known name, kept), office (an office alone), split, surname (split, one name begins with the rest),
    holder (several begin so, one of them held the office), ambiguous, uncorroborated, unknown. Offices are tried longest first; the
    first outcome decides, an office whose rest nobody bears leaves the choice to shorter ones.

    Every title is cut at each place and its end joined to the offices, its beginning to the names and to the names' beginnings:
    equi-joins throughout, on distinct titles."""
    distinct = titles.select(group, "title").where(F.length("title") > 0).distinct()
    pool = offices.select("office").where(F.length("office") >= 2).distinct()
    people = names.select(group, "name").where(F.length("name") > 0).distinct()
    ends = distinct.withColumn("k", F.explode(F.sequence(F.lit(0), F.length("title") - 1)))
    cut = ends.select(group, "title", "k", strip(F.expr("substring(title, 1, k)")).alias("rest"), F.expr("substring(title, k + 1)").alias("office")).join(pool, "office")
    # What the rest could be: a name, the beginning of names, or something that itself ends in an office.
    begins = people.withColumn("i", F.explode(F.sequence(F.lit(1), F.length("name")))).select(group, F.expr("substring(name, 1, i)").alias("rest"), "name").where(F.length("rest") >= 2)
    exact = people.select(group, F.col("name").alias("rest"), F.lit(True).alias("is_name"))
    candidates = begins.groupBy(group, "rest").agg(F.count("*").alias("bearers"), F.max("name").alias("bearer"))
    holders = begins.join(held.select(group, "name", "office").distinct(), [group, "name"]).groupBy(group, "rest", "office").agg(F.count("*").alias("holders"), F.max("name").alias("holder"))
    rests = cut.select(group, "rest").where(F.length("rest") >= 2).distinct()
    tails = rests.withColumn("k", F.explode(F.sequence(F.lit(0), F.length("rest") - 1))).select(group, "rest", F.expr("substring(rest, k + 1)").alias("office")).join(pool, "office", "left_semi").select(group, "rest").distinct().withColumn("ends_in_office", F.lit(True))
    seen = cut.join(exact, [group, "rest"], "left").join(candidates, [group, "rest"], "left").join(holders, [group, "rest", "office"], "left").join(tails, [group, "rest"], "left")
    outcome = (
        F.when(F.col("rest") == "", "office")
        .when(F.length("rest") < 2, F.lit(None))
        .when(F.col("is_name"), "split")
        .when(F.col("bearers") == 1, "surname")
        .when(F.col("holders") == 1, "holder")
        .when(F.col("bearers") > 1, "ambiguous")
    )
    speaker = F.when(outcome == "holder", F.col("holder")).when(outcome.isin("split", "surname"), F.col("rest"))
    decided = seen.withColumn("outcome", outcome).withColumn("speaker", speaker)
    first = decided.where("outcome is not null").groupBy(group, "title").agg(F.min_by(F.struct("outcome", "speaker", "office"), "k").alias("d"))
    alone = decided.where((F.length("rest") >= 2) & F.col("ends_in_office").isNull()).groupBy(group, "title").agg(F.min_by(F.struct("rest", "office"), "k").alias("u"))
    known = people.select(group, F.col("name").alias("title"), F.lit(True).alias("is_known"))
    out = distinct.join(known, [group, "title"], "left").join(first, [group, "title"], "left").join(alone, [group, "title"], "left")
    final = F.when(F.col("is_known"), "name").when(F.col("d").isNotNull(), F.col("d.outcome")).when(F.col("u").isNotNull(), "uncorroborated").otherwise("unknown")
    kept = F.col("outcome").isin("name", "ambiguous", "unknown")
    return (
        out.withColumn("outcome", final)
        .withColumn("speaker", F.when(kept, F.col("title")).when(F.col("outcome") == "office", "").when(F.col("outcome") == "uncorroborated", F.col("u.rest")).otherwise(F.col("d.speaker")))
        .withColumn("role", F.when(kept, F.lit(None)).when(F.col("outcome") == "uncorroborated", F.col("u.office")).otherwise(F.col("d.office")))
        .select(group, "title", "speaker", "role", "outcome")
    )
