"""Named queries over the corpus tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from minutesmith.functions import dates, labels, patterns, policy, text
from minutesmith.functions.patterns import to_java
from minutesmith.operators import audit, corpus, documents, sequences, titles, walk
from minutesmith.runtime import checkpoint_dir, table
from minutesmith.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]


def _speeches(s: SparkSession, d: str, *columns: Column | str) -> DataFrame:
    """Speeches, each once, as delivered last; only the columns named, so that nothing else is read or moved."""
    rows = table(s, d, "speeches")
    return corpus.latest(rows.select("speech_id", "retrieved_at", *(c for c in columns if not isinstance(c, str) or c != "speech_id")) if columns else rows, "speech_id", "retrieved_at")


def _meetings(s: SparkSession, d: str, *columns: Column | str) -> DataFrame:
    rows = table(s, d, "meetings")
    return corpus.latest(rows.select("meeting_id", "retrieved_at", *(c for c in columns if not isinstance(c, str) or c != "meeting_id")) if columns else rows, "meeting_id", "retrieved_at")


def corpus_stats(s: SparkSession, d: str) -> DataFrame:
    spoken = _speeches(s, d, "meeting_id", "kind", F.length("text").alias("characters"))
    found = corpus.stats(_meetings(s, d, "prefecture", "meeting_date"), spoken, ["prefecture"], size=F.col("characters"))
    return found.withColumn("first_date", F.col("first_date").cast("string")).withColumn("last_date", F.col("last_date").cast("string"))


def latest_speeches(s: SparkSession, d: str) -> DataFrame:
    return _speeches(s, d, "meeting_id", "speech_order", "speaker", "role", "kind", text.text_digest(F.col("text")).alias("digest")).drop("retrieved_at")


def build_meetings(s: SparkSession, d: str) -> DataFrame:
    nested = corpus.nest(_meetings(s, d, "prefecture").drop("retrieved_at"), _speeches(s, d, "meeting_id", "speech_order", "speaker", "role", "text", "kind"), "meeting_id", "speech_order", ["speaker", "role", "text", "kind"])
    joined = corpus.full_text(F.col("speeches"))
    return nested.select("meeting_id", "prefecture", F.size("speeches").cast("bigint").alias("n"), text.text_digest(joined).alias("digest"), F.length(joined).cast("bigint").alias("characters"), corpus.meeting_kind(F.col("speeches")).alias("kind"))


def flatten_outer(s: SparkSession, d: str) -> DataFrame:
    nested = corpus.nest(_meetings(s, d, "title").drop("retrieved_at"), _speeches(s, d, "meeting_id", "speech_order", "speaker", "role", "kind"), "meeting_id", "speech_order", ["speaker", "role", "kind"])
    return corpus.flatten(nested).select("meeting_id", "title", "speech_order", "speaker", "role", "kind")


def kind_rollup(s: SparkSession, d: str) -> DataFrame:
    by = _speeches(s, d, "meeting_id", "kind").groupBy("meeting_id").agg(F.bool_and(F.col("kind") == "summary").alias("all_summary"))
    return by.groupBy(F.when(F.col("all_summary"), "summary").otherwise("verbatim").alias("kind")).agg(F.count("*").alias("n"))


def record_keys(s: SparkSession, d: str) -> DataFrame:
    return corpus.with_key(_meetings(s, d, "url", "source_file")).select("meeting_id", "record_key")


def routed_counts(s: SparkSession, d: str) -> DataFrame:
    spoken = _speeches(s, d, "prefecture", "kind")
    return spoken.groupBy(corpus.routed_path(F.col("prefecture"), F.col("kind")).alias("path")).agg(F.count("*").alias("n"))


def csv_export(s: SparkSession, d: str) -> DataFrame:
    flat = _speeches(s, d, "speaker", "role", "meeting_date")
    return flat.select("speech_id", F.coalesce("speaker", F.lit("")).alias("speaker"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce(F.col("meeting_date").cast("string"), F.lit("")).alias("date"))


def dated_range(s: SparkSession, d: str) -> DataFrame:
    m = _meetings(s, d, "meeting_date")
    return m.where(dates.in_range(F.col("meeting_date"), "2023-01-01", "2024-06-30")).select("meeting_id", F.col("meeting_date").cast("string").alias("date"))


def wanted_links(s: SparkSession, d: str) -> DataFrame:
    listed = table(s, d, "listing")
    return listed.where(text.wanted(F.col("title"), F.col("url"), "委員会|minutes", "速報|第1号")).select("url", "title").distinct()


def resume_anti(s: SparkSession, d: str) -> DataFrame:
    return audit.unseen(table(s, d, "listing").select("url", "site").distinct(), table(s, d, "meetings").select("url"), "url").select("url", "site")


def audit_missing(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "listing").select("url", "listed_at", "site", "prefecture")
    return audit.missing(rows, table(s, d, "meetings"), "url", "listed_at").select("url", "site", "prefecture")


def audit_by_site(s: SparkSession, d: str) -> DataFrame:
    listed = table(s, d, "listing").groupBy("site").agg(F.count_distinct("url").alias("listed"))
    lost = audit_missing(s, d).groupBy("site").agg(F.count("*").alias("missing"))
    return listed.join(lost, "site", "left").fillna(0, ["missing"])


def presence_counts(s: SparkSession, d: str) -> DataFrame:
    return audit.presence(table(s, d, "listing").where("url is not null"), table(s, d, "meetings").where("url is not null"), ["url"]).groupBy("found").agg(F.count("*").alias("n"))


def prefix_route(s: SparkSession, d: str) -> DataFrame:
    routed = audit.longest_prefix(_meetings(s, d, "url").select("meeting_id", "url"), "url", table(s, d, "sites").where("start_url is not null"), "start_url", "site")
    return routed.select("meeting_id", "site")


def listing_lookup(s: SparkSession, d: str) -> DataFrame:
    listed = corpus.latest(table(s, d, "listing").where("url is not null"), "url", "listed_at").select("url", F.col("title").alias("listed_title"), F.col("meeting_date").alias("listed_date"))
    m = _meetings(s, d, "url", "meeting_date", "title").join(listed, "url", "left")
    return m.select("meeting_id", F.coalesce("meeting_date", "listed_date").cast("string").alias("date"), F.coalesce("title", "listed_title").alias("title"), F.coalesce(F.col("meeting_date") != F.col("listed_date"), F.lit(False)).alias("disagrees"))


def edition_preference(s: SparkSession, d: str) -> DataFrame:
    m = _meetings(s, d, "council_id", "title").drop("retrieved_at")
    edition = F.when(F.col("title").contains("確定版"), "確定版").when(F.col("title").contains("速報版"), "速報版").otherwise("")
    label = F.regexp_replace(F.regexp_replace("title", "[（【]?(確定版|速報版)[）】]?", ""), "[ 　]", "")
    rows = m.withColumn("edition", F.when(F.col("title").isNotNull(), edition)).withColumn("label", label)
    return audit.preferred_edition(rows, ["council_id", "label"], "edition", "確定版", "速報版").select("meeting_id", "edition")


def speaker_diff(s: SparkSession, d: str) -> DataFrame:
    """Listed names without a speech, compared without spaces."""
    index, spoken = (table(s, d, name).select("prefecture", "speaker") for name in ("speaker_index", "speeches"))
    return audit.name_differences(index, spoken, ["prefecture"], "speaker", lambda name: F.regexp_replace(name, "[ 　]", ""))


def page_concat(s: SparkSession, d: str) -> DataFrame:
    parts = F.array_sort(F.collect_list(F.struct("speech_order", "speech_id", "text")))
    joined = _speeches(s, d, "meeting_id", "speech_order", "text").groupBy("meeting_id").agg(F.array_join(F.transform(parts, lambda x: x["text"]), "\n").alias("body"))
    return joined.select("meeting_id", F.length("body").cast("bigint").alias("characters"), text.text_digest(F.col("body")).alias("digest"))


def speaker_counts(s: SparkSession, d: str) -> DataFrame:
    sp = _speeches(s, d, "prefecture", "speaker")
    return sp.groupBy("prefecture").agg(F.count_distinct("speaker").alias("spellings"), F.count_distinct(F.regexp_replace("speaker", "[ 　]", "")).alias("without_spaces"), F.count_if(F.col("speaker") == "").alias("unattributed"))


def role_counts(s: SparkSession, d: str) -> DataFrame:
    return corpus.top_counts(_speeches(s, d, "role").where("role is not null"), "role")


def top_roles(s: SparkSession, d: str) -> DataFrame:
    return corpus.top_counts(_speeches(s, d, "role").where("role is not null"), "role", 10)


def grouped_names(s: SparkSession, d: str) -> DataFrame:
    names = _speeches(s, d, "meeting_id", "speaker").where("speaker <> ''").select("meeting_id", "speaker").distinct()
    return names.groupBy("meeting_id").agg(F.array_join(F.sort_array(F.collect_list("speaker")), "|").alias("names"))


def pooled_offices(s: SparkSession, d: str) -> DataFrame:
    return corpus.pooled_offices(_speeches(s, d, "role"))


def stated_counts(s: SparkSession, d: str) -> DataFrame:
    m = table(s, d, "meetings").select("meeting_id", "n_speeches").distinct()
    joined = m.join(table(s, d, "speeches").select("meeting_id", "speech_id"), "meeting_id", "left")
    return audit.stated_against_found(joined, "meeting_id", "n_speeches", "speech_id")


def gap_check(s: SparkSession, d: str) -> DataFrame:
    return audit.gaps(_speeches(s, d, "meeting_id", "speech_order"), "meeting_id", "speech_order")


def order_breaks(s: SparkSession, d: str) -> DataFrame:
    sp = _speeches(s, d, "meeting_id", "speech_order").withColumn("upto", F.col("speech_order"))
    return sequences.breaks(sp, ["meeting_id"], ["speech_order", "speech_id"], "speech_order", "upto").where("breaks > 0")


def reparse_diff(s: SparkSession, d: str) -> DataFrame:
    before = _speeches(s, d, "meeting_id", "speaker", "role", "kind", "text").drop("retrieved_at")
    after = before.withColumn("speaker", F.regexp_replace("speaker", "[ 　]", ""))
    return audit.rewritten(before, after, "meeting_id", "speech_id", ["speaker", "role", "kind", "text"])


def line_width_mode(s: SparkSession, d: str) -> DataFrame:
    lines = _speeches(s, d, "meeting_id", "text").select("meeting_id", F.explode(F.split("text", "\n")).alias("line")).select("meeting_id", F.length("line").alias("width"))
    counts = lines.groupBy("meeting_id", "width").agg(F.count("*").alias("n"))
    return counts.groupBy("meeting_id").agg(F.max_by("width", F.struct("n", "width")).cast("bigint").alias("width"))


def first_per_group(s: SparkSession, d: str) -> DataFrame:
    m = table(s, d, "meetings").select("council_id", "meeting_date", "meeting_id", "url", "retrieved_at")
    own = F.coalesce(F.col("url"), F.lit("~"))
    return sequences.first_per_group(m, ["council_id", "meeting_date"], [F.col("url").isNull(), own, "meeting_id", "retrieved_at"]).select("council_id", F.col("meeting_date").cast("string").alias("date"), "meeting_id")


def repeated_deliveries(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "meetings").select("meeting_id", "title", "retrieved_at")
    again = sequences.repeated_deliveries(rows, ["meeting_id"], ["retrieved_at"], "title")
    return again.groupBy("same_text").agg(F.count("*").alias("n"))


def fill_forward(s: SparkSession, d: str) -> DataFrame:
    sp = _speeches(s, d, "meeting_id", "speech_order", "role").drop("retrieved_at")
    return sequences.fill_forward(sp, ["meeting_id"], ["speech_order", "speech_id"], "role", "last_role").select("speech_id", "last_role")


def ordered_sample(s: SparkSession, d: str) -> DataFrame:
    m = _meetings(s, d, "prefecture").select("prefecture", "meeting_id")
    return sequences.even_sample(m, ["prefecture"], ["meeting_id"], 6)


def rotating_sample(s: SparkSession, d: str) -> DataFrame:
    m = _meetings(s, d, "committee", "meeting_date").where("committee is not null and meeting_date is not null").withColumn("year", F.year("meeting_date"))
    return sequences.rotating_sample(m.select("year", "committee", "meeting_id"), "year", "committee", "meeting_id")


def ordered_unique(s: SparkSession, d: str) -> DataFrame:
    listed = table(s, d, "listing").where("url is not null").select("url", F.struct("listed_at", "title").alias("place"), "title")
    return sequences.ordered_unique(listed, ["url"], "place", "title").select("url", F.unix_timestamp("place.listed_at").alias("first_listed"), "title")


def speech_turns(s: SparkSession, d: str) -> DataFrame:
    """The speeches of a meeting as lines, joined while the speaker stays the same."""
    w = Window.partitionBy("meeting_id").orderBy("speech_order", "speech_id")
    lines = _speeches(s, d, "meeting_id", "speech_order", "speaker", "text").withColumn("before", F.lag("speaker").over(w)).withColumn("position", F.struct("speech_order", "speech_id"))
    turns = sequences.turns_in_lines(lines.withColumn("opens", ~F.col("before").eqNullSafe(F.col("speaker")) | (F.row_number().over(w) == 1)), ["meeting_id"], "position", "text", F.col("opens"))
    return turns.groupBy("meeting_id").agg(F.count("*").alias("turns"))


def marker_spans(s: SparkSession, d: str) -> DataFrame:
    """Every speech with its text under its marker, split again; a speech whose marker no pattern fits is one row of NULLs."""
    body = F.concat(F.lit("前書き\n○"), F.coalesce("role", F.lit("")), F.lit("（"), F.coalesce("speaker", F.lit("")), F.lit("君）　"), F.coalesce("text", F.lit("")))
    found = _speeches(s, d, "speaker", "role", "text").select("speech_id", F.inline_outer(patterns.split_speeches(body, r"(?m)^○(?P<role_a>[^（\n]*)（(?P<speaker_a>[^）\n]+?)君）\s*")))
    return found.select("speech_id", "order", "speaker", "role", "text", "kind")


def numbered_blocks(s: SparkSession, d: str) -> DataFrame:
    """The names of every meeting as numbered lines, in whatever script they are, read back; names lose the white space at their ends."""
    lines = F.array_join(F.transform(F.col("names"), lambda x, i: F.concat((i + 1).cast("string"), F.lit(":"), x)), "\n")
    own = _speeches(s, d, "meeting_id", "speaker").groupBy("meeting_id").agg(F.sort_array(F.collect_set("speaker")).alias("names"))
    return own.select("meeting_id", F.inline(patterns.split_blocks(lines))).select("meeting_id", "number", "body")


def limited(s: SparkSession, d: str) -> DataFrame:
    return _meetings(s, d, "meeting_date").where(dates.in_range(F.col("meeting_date"), "2022-01-01", None)).orderBy("meeting_id").limit(25).select("meeting_id")


def councils_latest(s: SparkSession, d: str) -> DataFrame:
    m = _meetings(s, d, "council_id", "meeting_date")
    return m.groupBy("council_id").agg(F.max("meeting_date").cast("string").alias("last_date"), F.count("*").alias("n")).orderBy(F.desc("council_id"))


def set_ops(s: SparkSession, d: str) -> DataFrame:
    a, b = table(s, d, "meetings").select("prefecture").distinct(), table(s, d, "sites").select("prefecture").distinct()
    tag = lambda df, name: df.groupBy().agg(F.count("*").alias("n")).select(F.lit(name).alias("what"), "n")
    return tag(a.intersect(b), "both").unionByName(tag(a.subtract(b), "first only")).unionByName(tag(b.subtract(a), "second only")).unionByName(tag(a.union(b).distinct(), "either"))


def dedupe_text(s: SparkSession, d: str) -> DataFrame:
    digest = text.text_digest(F.col("text"))
    return table(s, d, "documents").groupBy(digest.alias("digest")).agg(F.count("*").alias("copies"), F.min("doc_id").alias("first_id")).where("copies > 1")


def session_months(s: SparkSession, d: str) -> DataFrame:
    month = F.regexp_extract("session", "年([0-9]{1,2})月", 1).try_cast("int")
    m = _meetings(s, d, "meeting_date", "session").select("meeting_id", "meeting_date", month.alias("session_month")).where("session_month is not null and meeting_date is not null")
    return m.select("meeting_id", dates.within_session(F.month("meeting_date"), F.col("session_month")).alias("within"), dates.sitting_year(F.year("meeting_date"), F.col("session_month"), F.month("meeting_date"), F.year("meeting_date")).cast("bigint").alias("year"))


def plain_speakers(s: SparkSession, d: str) -> DataFrame:
    """The speaker of every speech in today's characters without plain and ideographic spaces; other characters stay."""
    return _speeches(s, d, "speaker").select("speech_id", F.regexp_replace(text.modern_forms(F.col("speaker")), "[ 　]", "").alias("speaker"))


def name_collisions(s: SparkSession, d: str) -> DataFrame:
    """Spellings that differ by spaces, width or old forms only, over every name."""
    return audit.name_collisions(_speeches(s, d, "speaker"), "speaker")


def swallowed_markers(s: SparkSession, d: str) -> DataFrame:
    return audit.swallowed_markers(_speeches(s, d, "text")).select("speech_id")


def odd_speakers(s: SparkSession, d: str) -> DataFrame:
    sp = _speeches(s, d, "speaker").where("speaker <> ''")
    return sp.groupBy(F.length("speaker").cast("bigint").alias("characters")).agg(F.count("*").alias("n"), F.count_if(F.col("speaker").rlike("[0-9０-９]")).alias("with_digits"), F.count_if(F.col("speaker").rlike("[A-Za-z]")).alias("with_letters"))


def office_suffixes(s: SparkSession, d: str) -> DataFrame:
    offices = table(s, d, "canon_values").where("field = 'role'").select(F.col("name").alias("office"))
    return audit.with_and_without_office(table(s, d, "speaker_index").select(F.col("speaker").alias("name")), "name", offices, "office")


def committee_lengths(s: SparkSession, d: str) -> DataFrame:
    return _meetings(s, d, "committee").groupBy(F.length("committee").cast("bigint").alias("characters")).agg(F.count("*").alias("n"))


def quality_counts(s: SparkSession, d: str) -> DataFrame:
    m = _meetings(s, d, "prefecture", "url", "meeting_date", "committee", "n_speeches", "source_html_sha256")
    return m.groupBy("prefecture").agg(
        F.count("*").alias("meetings"), F.count_if(F.col("url").isNull()).alias("without_url"), F.count_if(F.col("meeting_date").isNull()).alias("undated"), F.count_if(F.col("committee").isNull()).alias("plenary"),
        F.count_if(F.col("n_speeches") == 0).alias("empty"), F.count_if(F.col("source_html_sha256").isNull()).alias("without_digest"),
    )


def duplicate_urls(s: SparkSession, d: str) -> DataFrame:
    return _meetings(s, d, "url").where("url is not null").groupBy("url").agg(F.count("*").alias("n")).where("n > 1")


def url_shapes(s: SparkSession, d: str) -> DataFrame:
    shaped = table(s, d, "listing").where("url is not null").select(text.url_shape(F.col("url")).alias("shape"))
    return corpus.top_counts(shaped, "shape")


def url_hosts(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "listing").where("url is not null").groupBy(text.url_host(F.col("url")).alias("host")).agg(F.count_distinct("url").alias("urls"))


def slugs(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "sites").select("site", text.slug(F.concat_ws("/", "prefecture", "site")).alias("slug"))


def title_split(s: SparkSession, d: str) -> DataFrame:
    index = table(s, d, "speaker_index").where("speaker <> ''")
    offices = table(s, d, "canon_values").where("field = 'role'").select(F.col("name").alias("office"))
    bare = F.regexp_replace("speaker", "[ 　]", "")
    # Known names are all that end in no office, in whatever script and length.
    spelled = index.select("council_id", bare.alias("name")).where("name <> ''").distinct()
    ends = spelled.select("name").distinct().select("name", F.explode(F.sequence(F.lit(1), F.length("name"))).alias("k")).select("name", F.expr("substring(name, k)").alias("office"))
    names = spelled.join(ends.join(offices, "office", "left_semi").select("name"), "name", "left_anti").select("council_id", "name")
    held = index.where("role is not null").select("council_id", bare.alias("name"), F.col("role").alias("office")).join(offices, "office", "left_semi")
    return titles.decide_titles(index.select("council_id", bare.alias("title")), names, held, offices, "council_id")


def fetch_window(s: SparkSession, d: str) -> DataFrame:
    window = policy.FetchWindow(days=(5, 6), start=20 * 60, end=7 * 60)
    return table(s, d, "events").groupBy(window.allows(F.col("ts")).alias("open")).agg(F.count("*").alias("n"))


def throttle(s: SparkSession, d: str) -> DataFrame:
    e = table(s, d, "events").select("event_id", "user_id", F.unix_timestamp("ts").alias("arrival"))
    return policy.throttled(e, "user_id", ["arrival", "event_id"], "arrival", F.lit(3600)).select("event_id", F.col("start_at").cast("bigint").alias("start_at"))


def retries(s: SparkSession, d: str) -> DataFrame:
    e = table(s, d, "events").select((F.lit(200) + F.col("event_id") % 400).alias("status"), (F.col("event_id") % 5).alias("attempt"))
    return e.groupBy(policy.retry_action(F.col("status"), F.col("attempt")).alias("action")).agg(F.count("*").alias("n"))


def hourly_events(s: SparkSession, d: str) -> DataFrame:
    counted = incremental.windowed_counts(table(s, d, "events"), "ts", "event_type", "value")
    return counted.select(F.unix_timestamp("start").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


def event_sessions(s: SparkSession, d: str) -> DataFrame:
    found = incremental.sessions(table(s, d, "events"), "user_id", "ts")
    return found.select("user_id", F.unix_timestamp("start").alias("start"), "n")


def incremental_append(s: SparkSession, d: str) -> DataFrame:
    """The meetings table delivered in two streams' runs, each record stored once."""
    base = f"{checkpoint_dir(s)}/import-{uuid.uuid4().hex}"
    m = table(s, d, "meetings").select("meeting_id", "prefecture", "kind")
    m.where("meeting_id % 2 = 0").write.parquet(f"{base}/in/first")
    ddl = "meeting_id bigint, prefecture string, kind string"
    for run in range(2):
        if run:
            m.write.parquet(f"{base}/in/second")
        stream = incremental.import_stream(s, f"{base}/in/*", ddl, f"{base}/store", f"{base}/checkpoint", "meeting_id", ["prefecture", "kind"])
        stream.awaitTermination()
    return s.read.parquet(f"{base}/store").select("meeting_id", "prefecture", "kind")


def url_walk(s: SparkSession, d: str) -> DataFrame:
    """Councils reached from the first one over meetings of one day: a graph walk of three steps, each from a council to a day and on, so
    that the councils of a day are never paired."""
    m = _meetings(s, d, "council_id", "meeting_date").where("meeting_date is not null and council_id is not null")
    both = m.select(F.col("council_id").cast("string").alias("council"), F.concat(F.lit("day "), F.col("meeting_date").cast("string")).alias("day")).distinct()
    links = both.select(F.col("council").alias("source"), F.col("day").alias("target")).unionByName(both.select(F.col("day").alias("source"), F.col("council").alias("target")))
    start = s.range(1, 2).select(F.col("id").cast("string").alias("url"))
    found = walk.reach(start, links, 6).where(~F.col("url").startswith("day "))
    return found.select("url", F.floor(F.col("depth") / 2).cast("bigint").alias("depth"))


def list_pages(s: SparkSession, d: str) -> DataFrame:
    listed = table(s, d, "listing").groupBy("site").agg(F.count("*").alias("n"))
    return listed.select("site", F.explode(sequences.page_numbers(F.col("n")).cast("array<bigint>")).alias("page"))


def packed_requests(s: SparkSession, d: str) -> DataFrame:
    sp = _speeches(s, d, "meeting_id", "speech_order", F.length("text").alias("cost")).groupBy("meeting_id").agg(F.array_sort(F.collect_list(F.struct("speech_order", "speech_id", "cost"))).alias("x"))
    chunks = sequences.packed_positions(F.transform("x", lambda v: v["speech_id"]), F.transform("x", lambda v: v["cost"]), 1800)
    return sp.select("meeting_id", F.size(chunks).cast("bigint").alias("requests"))


def order_revenue(s: SparkSession, d: str) -> DataFrame:
    """Inherited aggregation, join and date filter over the star schema."""
    o, li = table(s, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate"), table(s, d, "lineitem").select("l_orderkey", "l_extendedprice", "l_discount")
    c = table(s, d, "customer").select("c_custkey", "c_mktsegment")
    per_order = li.groupBy("l_orderkey").agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("r"))
    joined = per_order.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(c, F.col("o_custkey") == F.col("c_custkey"))
    return joined.groupBy("c_mktsegment", F.year("o_orderdate").cast("bigint").alias("year")).agg(F.count("*").alias("orders"), F.round(F.sum("r"), 2).alias("revenue"))


def listed_kinds(s: SparkSession, d: str) -> DataFrame:
    own = table(s, d, "listing").where("title is not null").select(documents.listed_kind(F.col("title")).alias("kind"), documents.is_sitting(F.col("title")).alias("sitting"))
    return own.groupBy("kind", "sitting").agg(F.count("*").alias("n"))


def sessions_of_titles(s: SparkSession, d: str) -> DataFrame:
    m = _meetings(s, d, "title").where("title is not null")
    return m.select("meeting_id", documents.split_session(F.col("title")).alias("session"), documents.committee_of(F.col("title")).alias("committee"))


def transcript_sections(s: SparkSession, d: str) -> DataFrame:
    """Transcripts with circles as markers, what became of their sections."""
    raw = table(s, d, "raw_transcripts").select("raw_id", "body")
    found = documents.section_counts(documents.section_rows(raw, "raw_id", "body", to_java("^[○◯〇◎●]([^　（(]+)(?:[　（(]\\s*([^）)　]*)[）)]?)?")), "raw_id")
    return raw.select("raw_id").join(found, "raw_id", "left").fillna(0)


def rosters(s: SparkSession, d: str) -> DataFrame:
    listed = F.regexp_replace(F.regexp_replace("attendees", "[A-Z]＝", ""), "[;；、／\n]+ *", "\n")
    columns = F.regexp_replace(listed, "[:　 ]+", "　　")
    return table(s, d, "raw_transcripts").select("raw_id", documents.read_roster(columns).alias("r")).select("raw_id", F.array_join("r.names", "|").alias("names"), F.array_join("r.offices", "|").alias("offices"))


def indented_speeches(s: SparkSession, d: str) -> DataFrame:
    found = table(s, d, "raw_transcripts").select("raw_id", F.inline(documents.indented(F.col("body"))))
    return found.groupBy("raw_id").agg(F.count("*").alias("speeches"), F.sum(F.length("text")).alias("characters"))


def unwrapped_documents(s: SparkSession, d: str) -> DataFrame:
    own = table(s, d, "documents").select("doc_id", "text", documents.unwrap(F.col("text")).alias("joined"))
    return own.select("doc_id", (F.length("text") - F.length("joined")).cast("bigint").alias("breaks_removed"))


def labels_read(s: SparkSession, d: str) -> DataFrame:
    """The first line of every speech behind its label, in every shape, read back; where no shape fits or what fits is no name, speaker is '' and rest the whole line."""
    speaker, role, said = F.coalesce("speaker", F.lit("")), F.coalesce("role", F.lit("")), F.coalesce(F.split("text", "\n")[0], F.lit(""))
    shape = F.pmod("speech_id", F.lit(3))
    line = F.when(shape == 0, F.concat(F.lit("○"), role, F.lit("（"), speaker, F.lit("君）　"), said)).when(shape == 1, F.concat(F.lit("◆"), speaker, F.lit("議員　"), said)).otherwise(F.concat(F.lit("◎"), speaker, F.lit("　"), role, F.lit("　"), said))
    return labels.with_label(_speeches(s, d, "speaker", "role", "text").select("speech_id", line.alias("line")), "line", "l").select("speech_id", "l.speaker", "l.role", "l.rest")


def resolved_dates(s: SparkSession, d: str) -> DataFrame:
    listed = corpus.latest(table(s, d, "listing").where("url is not null").select("url", "listed_at", "meeting_date"), "url", "listed_at").select("url", F.col("meeting_date").alias("listed"))
    own = _meetings(s, d, "url", "meeting_date").join(listed, "url", "left").select(labels.resolved_date(F.col("listed"), F.col("meeting_date")).alias("r"))
    return own.groupBy("r.source", "r.disagrees").agg(F.count("*").alias("n"))


def echoes_removed(s: SparkSession, d: str) -> DataFrame:
    """The text of every speech behind an echo of its label, without it; white space at its ends goes."""
    title = F.concat(F.coalesce("role", F.lit("")), F.lit("（"), F.coalesce("speaker", F.lit("")), F.lit("君）"))
    body = F.concat(F.lit("<pre>◆"), title, F.lit("　"), F.coalesce("text", F.lit("")), F.lit("</pre>"))
    return _speeches(s, d, "speaker", "role", "text").select("speech_id", text.text_digest(labels.without_echo(body, title)).alias("digest"))


def catalogue(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "sites").groupBy("scraper").agg(F.count("*").alias("sites"), F.count("start_url").alias("with_start"))


def new_on_second_page(s: SparkSession, d: str) -> DataFrame:
    listed = table(s, d, "listing").where("url is not null").select("site", "url").distinct()
    met = table(s, d, "meetings").select("url").distinct()
    return walk.missing_nodes(met.withColumnRenamed("url", "node"), listed.select(F.col("url").alias("node")), "node").select(F.col("node").alias("url"))


def hinted_links(s: SparkSession, d: str) -> DataFrame:
    listed = table(s, d, "listing").where("url is not null").select("url", F.coalesce("title", F.lit("")).alias("title"), F.unix_timestamp("listed_at").alias("position"))
    return walk.accepted(listed, "title", "url", "委員会", "特別").select("url", "title")


def next_openings(s: SparkSession, d: str) -> DataFrame:
    window = policy.FetchWindow(days=(5, 6), start=20 * 60, end=7 * 60)
    return window.next_open(table(s, d, "events").select("ts"), "ts").groupBy(F.col("opens_on").cast("string").alias("opens_on")).agg(F.count("*").alias("n"))


def notices(s: SparkSession, d: str) -> DataFrame:
    m = _meetings(s, d, "prefecture", "meeting_date", "kind")
    told = policy.covered(F.col("meeting_date"), F.lit("2023-01-01").cast("date"), F.lit("2023-12-31").cast("date"), F.col("kind") == "verbatim")
    return m.groupBy(told.alias("covered")).agg(F.count("*").alias("n"))


def exemptions(s: SparkSession, d: str) -> DataFrame:
    prefixes = F.array(F.lit("https://gijiroku.kasumi.example/view/"), F.lit("https://gijiroku.azusa.example/"))
    return table(s, d, "listing").groupBy(policy.exempt(F.col("url"), prefixes).alias("exempt")).agg(F.count("*").alias("n"))


def daily_rollup(s: SparkSession, d: str) -> DataFrame:
    """Inherited: grouping sets over kinds and days."""
    e = table(s, d, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type", "value")
    return e.rollup("event_type", "day").agg(F.count("*").alias("n"), F.round(F.sum("value"), 3).alias("total"))


def ranked_customers(s: SparkSession, d: str) -> DataFrame:
    """Inherited: the first three of each group by window rank."""
    c = table(s, d, "customer")
    w = Window.partitionBy("c_mktsegment").orderBy(F.desc("c_acctbal"), "c_custkey")
    return c.withColumn("place", F.row_number().over(w).cast("bigint")).where("place <= 3").select("c_mktsegment", "place", "c_custkey")


ALL: tuple[Query, ...] = (
    corpus_stats, latest_speeches, build_meetings, flatten_outer, kind_rollup, record_keys, routed_counts, csv_export, dated_range, wanted_links, resume_anti, audit_missing, audit_by_site, presence_counts,
    prefix_route, listing_lookup, edition_preference, speaker_diff, page_concat, speaker_counts, role_counts, top_roles, grouped_names, pooled_offices, stated_counts, gap_check, order_breaks, reparse_diff,
    line_width_mode, first_per_group, repeated_deliveries, fill_forward, ordered_sample, rotating_sample, ordered_unique, speech_turns, marker_spans, numbered_blocks, limited, councils_latest, set_ops,
    dedupe_text, session_months, plain_speakers, name_collisions, swallowed_markers, odd_speakers, office_suffixes, committee_lengths, quality_counts, duplicate_urls, url_shapes,
    url_hosts, slugs, title_split, fetch_window, throttle, retries, hourly_events, event_sessions, incremental_append, url_walk, list_pages, packed_requests, order_revenue, listed_kinds, sessions_of_titles,
    transcript_sections, rosters, indented_speeches, unwrapped_documents, labels_read, resolved_dates, echoes_removed, catalogue, new_on_second_page, hinted_links, next_openings, notices, exemptions,
    daily_rollup, ranked_customers,
)
