"""Sources combined to target shares of all tokens.

Method: low-discrepancy source schedule. Slot i of the mix takes the source in whose stretch of the cumulative weights the
fractional part of i times the golden ratio falls, so that every stretch of the mix, however short, is near the targets. The
documents of each source are shuffled by a hash, anew for every repetition, and cut into blocks of equal tokens; the k-th slot
of a source is joined to its k-th block.

Total: as many tokens as can be had with every share met, that is the least of (tokens of a source) x (its most repetitions) /
(its share); a `total` may be given, and then sources that run out stay below their share.

Scale: running sums are taken in two steps, within buckets of the hash and over the bucket sums, so no source is ever in one
task; the driver sees only the settings and one row of sums per source (at most SOURCES).

Results that are defined: documents without tokens or source, and sources without a target, are not used; a source with a target
but no documents is reported with share 0; shares are taken relative to the sum of those that have documents; a NULL or
negative share counts as 0, NULL repetitions as 1; repeated rows are documents of their own; ties of the hash are broken by id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

GOLDEN = 0.6180339887498949
BLOCK = 2048  # tokens of a block
BUCKET_ROWS = 20_000  # rows of a bucket, about
SOURCES = 10_000  # sources at most
SLOTS = 100_000  # slots of a bucket
CELLS = 4096  # by which a point finds its stretch


def _running(df: DataFrame, keys: list[str], bucket: str, order: list[str], value: str, name: str) -> DataFrame:
    """df with the sum of value over the rows before, by keys in the order of bucket and then order."""
    sums = df.groupBy(*keys, bucket).agg(F.sum(value).alias("_sum"))
    before = sums.withColumn("_before", F.sum("_sum").over(Window.partitionBy(*keys).orderBy(bucket)) - F.col("_sum")).drop("_sum")
    inside = Window.partitionBy(*keys, bucket).orderBy(*order)
    return df.join(before, [*keys, bucket]).withColumn(name, F.col("_before") + F.sum(value).over(inside) - F.col(value)).drop("_before")


def plan(docs: DataFrame, targets: DataFrame, total: int | None = None) -> list[dict]:
    """One row of settings per target source: its tokens, its share, and the tokens it is to give."""
    rows = targets.where("source is not null").groupBy("source").agg(F.max("target_share").alias("share"), F.max("max_repeats").alias("most")).orderBy("source").limit(SOURCES + 1).collect()
    if len(rows) > SOURCES:
        raise ValueError(f"more than {SOURCES} sources")
    wanted = docs.join(targets.select("source").distinct(), "source", "left_semi")  # so at most as many groups
    sums = {r["source"]: (r["t"], r["n"]) for r in wanted.groupBy("source").agg(F.sum("tokens").alias("t"), F.count("*").alias("n")).collect()}
    out = [{"source": r["source"], "target": max(0.0, r["share"] or 0.0), "most": max(0, 1 if r["most"] is None else r["most"]), "tokens": sums.get(r["source"], (0, 0))[0] or 0, "rows": sums.get(r["source"], (0, 0))[1]} for r in rows]
    able = [x for x in out if x["target"] > 0 and x["tokens"] * x["most"] > 0]
    whole = sum(x["target"] for x in able)
    reach = min((x["tokens"] * x["most"] / (x["target"] / whole) for x in able), default=0)
    size = reach if total is None else float(total)
    for x in out:
        x["weight"] = x["target"] / whole if x in able else 0.0
        x["wanted"] = min(x["tokens"] * x["most"], round(size * x["weight"])) if x in able else 0
    return out


def mix(docs: DataFrame, targets: DataFrame, total: int | None = None, block: int = BLOCK, seed: int = 17) -> DataFrame:
    """(slot, source, doc_id, repetition, tokens): the documents of the mix; those of one slot stand together.

    docs has source, doc_id and tokens."""
    spark = docs.sparkSession
    own = docs.select("source", "doc_id", "tokens").where("source is not null and tokens > 0")
    settings = [x for x in plan(own, targets, total) if x["wanted"] > 0]
    schema = "slot bigint, source string, doc_id bigint, repetition int, tokens bigint"
    if not settings:
        return spark.createDataFrame([], schema)
    # One row of settings per source, at most SOURCES of them, so they may go to every task.
    at, table, cells = 0.0, [], []
    for n, x in enumerate(settings):
        upto = 2.0 if n == len(settings) - 1 else at + x["weight"]
        table.append((x["source"], int(x["wanted"]), int(min(x["most"], -(-x["wanted"] // x["tokens"]))), int(max(1, x["rows"] // BUCKET_ROWS))))
        cells += [(c, x["source"], at, upto) for c in range(int(at * CELLS), min(CELLS - 1, int(upto * CELLS)) + 1)]
        at += x["weight"]
    known = F.broadcast(spark.createDataFrame(table, "source string, wanted bigint, passes int, buckets bigint"))
    repeated = own.join(known, "source").withColumn("repetition", F.explode(F.sequence(F.lit(0), F.col("passes") - 1)))
    shuffled = repeated.withColumn("h", F.xxhash64("doc_id", "repetition", F.lit(seed)))
    # Buckets are stretches of the hash within a repetition, so their order is the order of the shuffle.
    place = F.floor((F.shiftrightunsigned("h", 1) / F.lit(float(1 << 63))) * F.col("buckets")).cast("bigint")
    bucketed = shuffled.withColumn("bucket", F.col("repetition").cast("bigint") * F.lit(1 << 32) + place)
    order = ["h", "doc_id", "tokens"]
    summed = _running(bucketed.withColumn("h", F.shiftrightunsigned("h", 1)), ["source"], "bucket", order, "tokens", "before").where(F.col("before") + F.col("tokens") / 2 <= F.col("wanted"))
    blocks = summed.withColumn("k", F.floor(F.col("before") / F.lit(block)).cast("bigint"))

    slots = -(-sum(x["wanted"] for x in settings) // block)
    point = F.col("i") * F.lit(GOLDEN)
    point = point - F.floor(point)
    # The stretch of a point is found by its cell: stretches are listed under every cell they touch, at most CELLS + SOURCES rows.
    stretches = F.broadcast(spark.createDataFrame(cells, "cell int, source string, low double, high double"))
    pointed = spark.range(slots).withColumnRenamed("id", "i").withColumn("point", point).withColumn("cell", F.floor(F.col("point") * CELLS).cast("int"))
    schedule = pointed.join(stretches, "cell").where("point >= low and point < high").select("i", "source", F.floor(F.col("i") / SLOTS).cast("bigint").alias("bucket"), F.lit(1).alias("one"))
    ranked = _running(schedule, ["source"], "bucket", ["i"], "one", "k").select("source", "k", F.col("i").alias("slot"))
    # Blocks that the schedule has no slot for, a few at most by its low discrepancy, follow after the last slot.
    joined = blocks.join(ranked, ["source", "k"], "left")
    return joined.select(F.coalesce("slot", F.lit(slots) + F.col("k")).cast("bigint").alias("slot"), "source", "doc_id", F.col("repetition").cast("int").alias("repetition"), "tokens")


def report(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, target_share, actual_share, tokens, documents, most_uses, max_repeats) of each target source."""
    uses = mixed.groupBy("source", "doc_id").agg(F.sum("tokens").alias("t"), F.count("*").alias("n"))
    by = uses.groupBy("source").agg(F.sum("t").alias("tokens"), F.count("*").alias("documents"), F.max("n").alias("most_uses"))
    own = targets.groupBy("source").agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    every = own.join(by, "source", "left").fillna(0, ["tokens", "documents", "most_uses"])
    # One row per source is left by now, so their sum may be taken in one place.
    out = every.withColumn("whole", F.sum("tokens").over(Window.partitionBy(F.lit(0))))
    return out.select("source", "target_share", F.when(F.col("whole") > 0, F.col("tokens") / F.col("whole")).otherwise(0.0).alias("actual_share"), "tokens", "documents", "most_uses", "max_repeats")
