"""Reading and writing the corpus: JSON lines strict and lenient, routed exports, CSV, delivered files, cached pages, site rules."""

from __future__ import annotations

import tomllib
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from minutesmith import schema
from minutesmith.functions.text import record_key, slug, squash
from minutesmith.operators.corpus import meeting_kind


def read_meetings(spark: SparkSession, path: str) -> DataFrame:
    """Meetings of JSON lines with their derived kind; a malformed line fails the read."""
    rows = spark.read.schema(schema.MEETINGS).option("mode", "FAILFAST").json(path)
    return rows.withColumn("kind", meeting_kind(F.col("speeches")))


def seen_keys(spark: SparkSession, *paths: str) -> DataFrame:
    """Distinct keys of records in JSON lines; lines that are malformed or name no record are passed over."""
    ddl = "url string, source_file string, _bad string"
    rows = spark.read.schema(ddl).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad").json(list(paths))
    return rows.where("_bad is null").select(record_key(F.col("url"), F.col("source_file")).alias("key")).where("key is not null").distinct()


def malformed_lines(spark: SparkSession, *paths: str) -> DataFrame:
    rows = spark.read.schema("url string, _bad string").option("columnNameOfCorruptRecord", "_bad").json(list(paths))
    return rows.select("_bad", "url").where("_bad is not null").select(F.col("_bad").alias("line"))


def write_routed(meetings: DataFrame, path: str, mode: str = "append") -> None:
    """JSON lines in folders by kind and prefecture: summaries never lie among transcripts."""
    meetings.withColumn("kind", meeting_kind(F.col("speeches"))).withColumn("folder", slug(F.col("prefecture"))).write.mode(mode).partitionBy("kind", "folder").json(path)


def csv_rows(flat: DataFrame) -> DataFrame:
    """The columns of an export as text; only here NULL and '' are one."""
    stamp = F.date_format("retrieved_at", "yyyy-MM-dd'T'HH:mm:ssXXX")
    text = {c: F.col(c).cast("string") for c in schema.FLAT} | {"retrieved_at": stamp}
    return flat.select(*(F.coalesce(text[c], F.lit("")).alias(c) for c in schema.FLAT))


def write_csv(flat: DataFrame, path: str) -> None:
    csv_rows(flat).write.mode("overwrite").option("header", True).option("escape", '"').option("quoteAll", True).csv(path)


BOM = "\ufeff"


def append_csv(flat: DataFrame, path: str) -> None:
    """Append to CSV in folders by kind and prefecture, made when their first row comes. Every file of a run has one header, opened by the
    mark that spreadsheet programs know UTF-8 by."""
    first = schema.FLAT[0]
    rows = csv_rows(flat).withColumn("_kind", F.coalesce(F.nullif(F.col("kind"), F.lit("")), F.lit("verbatim"))).withColumn("_folder", slug(F.col("prefecture")))
    rows.withColumnRenamed(first, BOM + first).write.mode("append").partitionBy("_kind", "_folder").option("header", True).option("escape", '"').option("quoteAll", True).csv(path)


def read_appended(spark: SparkSession, path: str) -> DataFrame:
    """What append_csv wrote, from all runs."""
    names = ", ".join(f"`{c}` string" for c in schema.FLAT)
    return spark.read.schema(names).option("header", True).option("enforceSchema", True).option("multiLine", True).option("escape", '"').csv(path).select(*schema.FLAT)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)


def delivered(spark: SparkSession, root: str, pattern: str = "*.txt") -> DataFrame:
    """(path, name, content) of delivered files below root, as bytes."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "content")


def collisions(planned: DataFrame, target: str) -> DataFrame:
    """Targets that several deliveries would be filed under: an error for the caller."""
    return planned.groupBy(target).agg(F.count("*").alias("n")).where("n > 1")


def cache_key(url: Column, kind: Column | None = None, body: Column | None = None) -> Column:
    """Key of a cached answer: the address, for a request with a body with the digest of its canonical form."""
    if kind is None or body is None:
        return url
    return F.when(body.isNull(), url).otherwise(F.concat(url, F.lit("#"), kind, F.lit(":"), F.sha2(body, 256)))


def cache_rows(pages: DataFrame, final_url: str = "final_url") -> DataFrame:
    """Rows to store: an answer after a redirect is stored under both addresses."""
    keys = F.array_distinct(F.array(F.col("key"), F.coalesce(F.col(final_url), F.col("key"))))
    return pages.withColumn("key", F.explode(keys))


def site_rules(spark: SparkSession, folder: str, kinds: set[str] | None = None) -> DataFrame:
    """(site, scraper, prefecture, start_urls) of the TOML files of a folder; names that begin with _ are templates. A scraper that is not one of
    `kinds`, where they are given, fails."""
    rows = []
    for path in sorted(Path(folder).glob("*.toml")):
        if path.name.startswith("_"):
            continue
        rules = tomllib.loads(path.read_text(encoding="utf-8"))
        scraper = rules.get("scraper", "generic")
        if kinds is not None and scraper not in kinds:
            raise ValueError(f"{path.name}: unknown scraper {scraper!r}")
        rows.append((path.stem, scraper, rules.get("prefecture", ""), [str(u) for u in rules.get("start_urls", [])]))
    if not rows:
        raise ValueError(f"no site rules in {folder}")
    return spark.createDataFrame(rows, "site string, scraper string, prefecture string, start_urls array<string>")


BLOCKS = "tenant_minutes array<struct<minute_id:bigint,title:string,minute_type:string,minute_type_code:int,body:string>>"
COUNCILS = "councils array<struct<view_years:array<struct<view_year:string,council_type:array<struct<council_type_name1:string,council_type_name2:string,council_type_name3:string,council_type_name4:string,council_type_name5:string,councils:array<struct<council_id:bigint,name:string>>>>>>>>"
SCHEDULES = "council_schedules array<struct<schedule_id:bigint,name:string,page_no:int>>"


def api_rows(pages: DataFrame, ddl: str, array: str) -> DataFrame:
    """One row per element of an array of a JSON answer, parsed from its bytes as UTF-8."""
    parsed = F.from_json(F.decode(F.col("body"), "UTF-8"), f"struct<{ddl.replace(' array', ':array', 1)}>")
    return pages.select(F.col("key"), F.posexplode_outer(parsed[array]).alias("position", "item")).select("key", "position", "item.*")


PROCEEDINGS = "全会議"  # first level of the tree under which proceedings lie; what lies elsewhere is material


def council_rows(pages: DataFrame, years: list[int] | None = None, root: str = PROCEEDINGS) -> DataFrame:
    """(key, view_year, names, council_id, name, material) of the councils of tree answers, each level unfolded; materials are marked, not
    dropped, so that they can be counted."""
    tree = F.from_json(F.decode(F.col("body"), "UTF-8"), f"struct<{COUNCILS.replace(' array', ':array', 1)}>")
    by_year = pages.select("key", F.explode(F.flatten(F.transform(tree["councils"], lambda b: b["view_years"]))).alias("y")).withColumn("view_year", F.col("y.view_year").try_cast("int"))
    wanted = by_year if years is None else by_year.where(F.col("view_year").isin(years))
    kinds = wanted.select("key", "view_year", F.explode("y.council_type").alias("t"))
    names = F.filter(F.array(*(F.col(f"t.council_type_name{i}") for i in range(1, 6))), lambda n: F.coalesce(n, F.lit("")) != "")
    rows = kinds.select("key", "view_year", names.alias("names"), F.explode("t.councils").alias("c"))
    return rows.select("key", "view_year", "names", "c.council_id", squash(F.col("c.name")).alias("name"), (~F.coalesce(F.get("names", F.lit(0)), F.lit("")).eqNullSafe(F.lit(root))).alias("material"))


def read_cache(spark: SparkSession, folder: str) -> DataFrame:
    """(key, url, status, body, header_charset, fetched_at) of a folder of cached answers: `<digest>.body` beside `<digest>.json`. An answer counts only
    with both; what is stored of its encoding is not read, for the charset is found from the bytes each time."""
    digest = F.regexp_extract("path", "([0-9a-f]{8,64})\\.(?:body|json)$", 1)
    bodies = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.body").load(folder).select(digest.alias("digest"), F.col("content").alias("body"))
    texts = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").load(folder).select(digest.alias("digest"), F.decode("content", "UTF-8").alias("j"))
    meta = texts.select("digest", F.from_json("j", "key string, url string, status int, header_charset string, fetched_at timestamp").alias("m"))
    return meta.join(bodies, "digest").select("m.key", "m.url", "m.status", "body", "m.header_charset", "m.fetched_at")


def inspect(pages: DataFrame, body: str, selector: str | None = None, n: int = 20, shown: int = 500) -> DataFrame:
    """A look at n pages: size, digest and the first characters, or how many elements a selector finds and the text of the first."""
    from minutesmith.functions.bytes import page_text, parse_html, select

    header = F.col("header_charset") if "header_charset" in pages.columns else F.lit(None).cast("string")
    looked = pages.limit(n).withColumn("_t", page_text(F.col(body), header))
    own = looked.select(*[c for c in pages.columns if c != body], F.octet_length(body).alias("bytes"), F.sha2(body, 256).alias("digest"), F.col("_t.charset").alias("charset"), F.col("_t.text").alias("text"))
    if selector is None:
        return own.withColumn("text", F.substring("text", 1, shown))
    count = F.pandas_udf(lambda s: s.map(lambda v: len(select(parse_html(v), selector)) if v is not None else 0), "int")
    first = F.pandas_udf(lambda s: s.map(lambda v: next((e.text()[:shown] for e in select(parse_html(v), selector)), None) if v is not None else None), "string")
    return own.withColumn("found", count("text")).withColumn("text", first("text"))
