"""Operators on order: first per group, spans, forward fill, gaps, samples, greedy packing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHOICES = 200_000  # strata times options of a rotating sample


def first_per_group(df: DataFrame, group: list[str], order: list[Column | str]) -> DataFrame:
    """The first row of each group; NULL keys form one group. An aggregate of minima, so that a hot group combines before the shuffle."""
    named = [(o if isinstance(o, str) else None, F.col(o) if isinstance(o, str) else o) for o in order]
    rank = F.struct(*(c.alias(f"_o{i}") for i, (_, c) in enumerate(named)))
    rest = [c for c in df.columns if c not in group]
    best = df.groupBy(*group).agg(F.min_by(F.struct(*rest), rank).alias("_r"))
    return best.select(*group, *(F.col(f"_r.{c}").alias(c) for c in rest)).select(*df.columns)


def repeated_deliveries(df: DataFrame, group: list[str], order: list[str], text: str) -> DataFrame:
    """Rows that are not the first of their group, and whether their text is that of the first."""
    w = Window.partitionBy(*group).orderBy(*order)
    digest = F.sha2(F.coalesce(text, F.lit("")), 256)
    ranked = df.withColumn("_n", F.row_number().over(w)).withColumn("same_text", digest == F.first(digest).over(w))
    return ranked.where("_n > 1").drop("_n")


def breaks(df: DataFrame, group: list[str], order: list[str], first: str, last: str) -> DataFrame:
    """Per group, the number of neighbours that do not continue each other: last + 1 <> next first."""
    follow = F.lead(first).over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("_next", follow).groupBy(*group).agg(F.count_if(F.col("_next").isNotNull() & (F.col(last) + 1 != F.col("_next"))).alias("breaks"))


def fill_forward(df: DataFrame, group: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """df with the latest value that is not NULL; NULL before the first."""
    w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.last(value, ignorenulls=True).over(w))


def even_sample(df: DataFrame, group: list[str], order: list[str], k: int) -> DataFrame:
    """Up to k evenly spaced rows of each group, first and last among them: those at round(i * (n - 1) / (k - 1)), halves to even."""
    w = Window.partitionBy(*group).orderBy(*order)
    n = F.count("*").over(Window.partitionBy(*group))
    ranked = df.withColumn("_i", F.row_number().over(w) - 1).withColumn("_n", n)
    chosen = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.bround(i * (F.col("_n") - 1) / F.lit(max(1, k - 1))).cast("int"))
    return ranked.where((F.col("_n") <= k) | F.array_contains(chosen, F.col("_i"))).drop("_i", "_n")


def rotating_sample(df: DataFrame, stratum: str, option: str, order: str, rounds: int = 1) -> DataFrame:
    """One row per stratum, in strata order each time from the option used least so far: its middle row.

    The choice depends on all choices before, so it is folded over the strata on the driver; only one row per stratum and option takes
    part, and more than CHOICES of them are an error."""
    w = Window.partitionBy(stratum, option).orderBy(order)
    middle = df.withColumn("_i", F.row_number().over(w) - 1).withColumn("_n", F.count("*").over(Window.partitionBy(stratum, option))).where("_i = cast(floor(_n / 2) as int)").drop("_i", "_n")
    chosen: list[tuple] = []
    used: dict = {}
    options: dict = {}
    rows = middle.select(stratum, option).where(f"{stratum} is not null and {option} is not null").orderBy(stratum, option).limit(CHOICES + 1).collect()
    if len(rows) > CHOICES:
        raise ValueError(f"more than {CHOICES} strata and options")
    for row in rows:
        options.setdefault(row[0], []).append(row[1])
    for s in sorted(options):
        pick = min(options[s], key=lambda o: (used.get(o, 0), o))
        used[pick] = used.get(pick, 0) + rounds
        chosen.append((s, pick))
    kept = df.sparkSession.createDataFrame(chosen, middle.select(stratum, option).schema)
    return middle.join(kept, [stratum, option], "left_semi")


def ordered_unique(df: DataFrame, keys: list[str], position: str, value: str | None = None) -> DataFrame:
    """One row per key at its first position; with value, that of its last position."""
    aggregates = [F.min(position).alias(position)]
    if value is not None:
        aggregates.append(F.max_by(value, position).alias(value))
    return df.groupBy(*keys).agg(*aggregates)


def turns_in_lines(df: DataFrame, group: list[str], position: str, line: str, opens: Column) -> DataFrame:
    """Lines of a block as turns: a line for which `opens` holds begins one; lines before the first are turn 0."""
    running = F.sum(F.when(opens, 1).otherwise(0)).over(Window.partitionBy(*group).orderBy(position).rowsBetween(Window.unboundedPreceding, 0))
    rows = df.withColumn("turn", running)
    lines = F.array_sort(F.collect_list(F.struct(position, line)))
    return rows.groupBy(*group, "turn").agg(F.array_join(F.transform(lines, lambda x: x[line]), "\n").alias("text"))


def packed_positions(positions: Column, cost: Column, limit: int) -> Column:
    """array<array<bigint>>: positions put greedily into chunks whose costs stay within the limit; a chunk holds at least one."""
    pairs = F.arrays_zip(positions.alias("p"), cost.alias("c"))
    zero = F.struct(F.array().cast("array<array<bigint>>").alias("done"), F.array().cast("array<bigint>").alias("open"), F.lit(0).cast("bigint").alias("used"))

    def step(a: Column, x: Column) -> Column:
        fits = (F.size(a["open"]) == 0) | (a["used"] + x["c"] <= limit)
        return F.struct(
            F.when(fits, a["done"]).otherwise(F.concat(a["done"], F.array(a["open"]))).alias("done"),
            F.when(fits, F.concat(a["open"], F.array(x["p"].cast("bigint")))).otherwise(F.array(x["p"].cast("bigint"))).alias("open"),
            (F.when(fits, a["used"]).otherwise(F.lit(0)) + x["c"]).cast("bigint").alias("used"),
        )

    return F.aggregate(pairs, zero, step, lambda a: F.when(F.size(a["open"]) > 0, F.concat(a["done"], F.array(a["open"]))).otherwise(a["done"]))


def page_numbers(count: Column, per_page: int = 10) -> Column:
    """Numbers of the pages after the first of a list of so many items."""
    last = F.ceil(count / per_page).cast("int")
    return F.when(last >= 2, F.sequence(F.lit(2), last)).otherwise(F.array().cast("array<int>"))
