"""Queries of the operators that read and write: what is written from the tables, or put into the form a site delivers, is read back."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from minutesmith.functions import bytes as raw
from minutesmith.functions import dates, policy, text
from minutesmith.operators import corpus, walk
from minutesmith.runtime import checkpoint_dir, table
from minutesmith.sources import files, parsing


def _era() -> Column:
    return F.when(F.col("meeting_date") >= F.lit("2019-05-01").cast("date"), F.lit("令和")).otherwise("平成")


def _era_year() -> Column:
    return F.year("meeting_date") - F.when(F.col("meeting_date") >= F.lit("2019-05-01").cast("date"), 2018).otherwise(1988)


def _meetings(s: SparkSession, d: str, *columns: str) -> DataFrame:
    return corpus.latest(table(s, d, "meetings").select("meeting_id", "retrieved_at", *columns), "meeting_id", "retrieved_at")


def _place(s: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(s)}/{name}-{uuid.uuid4().hex}"


def _kanji(number: Column) -> Column:
    """A number from 1 to 99 in kanji."""
    digit = lambda n: F.element_at(F.split(F.lit("一,二,三,四,五,六,七,八,九"), ","), n.cast("int"))
    tens, units = F.floor(number / 10), number % 10
    return F.concat(F.when(tens > 1, digit(F.greatest(tens, F.lit(1)))).otherwise(""), F.when(tens > 0, "十").otherwise(""), F.when(units > 0, digit(F.greatest(units, F.lit(1)))).otherwise(""))


def jsonl_strict(s: SparkSession, d: str) -> DataFrame:
    """Every meeting with its speeches written as routed JSON lines and read strictly."""
    spoken = corpus.latest(table(s, d, "speeches").select("speech_id", "meeting_id", "speech_order", "speaker", "role", "text", "kind", "retrieved_at"), "speech_id", "retrieved_at").drop("retrieved_at")
    held = _meetings(s, d, "prefecture", "url", "source_file", F.col("meeting_date").alias("date"), "session", "committee", "title", "source_html_sha256")
    path = _place(s, "jsonl")
    files.write_routed(corpus.nest(held, spoken, "meeting_id", "speech_order", ["speaker", "role", "text", "kind"]).drop("meeting_id"), path)
    read = files.read_meetings(s, path)
    return read.groupBy("prefecture", "kind").agg(F.count("*").alias("meetings"), F.sum(F.size("speeches")).alias("speeches"), F.sum(F.length(corpus.full_text(F.col("speeches")))).cast("bigint").alias("characters"))


def jsonl_lenient(s: SparkSession, d: str) -> DataFrame:
    """Keys of records in JSON lines of which every third is torn."""
    path = _place(s, "lenient")
    line = F.to_json(F.struct("url", "source_file"))
    _meetings(s, d, "url", "source_file").select(F.when(F.col("meeting_id") % 3 == 0, F.substring(line, 1, 9)).otherwise(line).alias("value")).write.text(path)
    return files.seen_keys(s, path)


def csv_round_trip(s: SparkSession, d: str) -> DataFrame:
    """The whole export as CSV, with line breaks and quotation marks inside its fields, read back."""
    own = corpus.latest(table(s, d, "speeches"), "speech_id", "retrieved_at")
    held = _meetings(s, d, "url", "source_file", "session", "committee", "title", "source_html_sha256").drop("retrieved_at")
    path = _place(s, "csv")
    files.write_csv(own.join(held, "meeting_id", "left").withColumn("date", F.col("meeting_date")), path)
    return files.read_csv(s, path).groupBy("prefecture", "kind").agg(F.count("*").alias("n"), F.sum(F.length("text")).cast("bigint").alias("characters"), F.countDistinct("date").alias("dates"), F.count_if(F.coalesce("role", F.lit("")) != "").alias("with_role"))


def csv_appended(s: SparkSession, d: str) -> DataFrame:
    """Two runs appended to routed CSV: each file has its header and mark once, summaries lie apart."""
    own = corpus.latest(table(s, d, "speeches"), "speech_id", "retrieved_at")
    held = _meetings(s, d, "url", "source_file", "session", "committee", "title", "source_html_sha256").drop("retrieved_at")
    flat = own.join(held, "meeting_id", "left").withColumn("date", F.col("meeting_date"))
    path = _place(s, "appended")
    files.append_csv(flat.where("speech_id % 2 = 0"), path)
    files.append_csv(flat.where("speech_id % 2 = 1"), path)
    return files.read_appended(s, path).groupBy("prefecture", "kind").agg(F.count("*").alias("n"))


def sniffed_charsets(s: SparkSession, d: str) -> DataFrame:
    """Pages whose charset is stated by themselves, stated by their header, or left to be found."""
    said, kind = F.coalesce("prefecture", F.lit("")), F.col("meeting_id") % 4
    own = F.when(kind == 0, raw.encoded(F.concat(F.lit("<meta charset=Shift_JIS>"), said), "cp932")).when(kind == 1, raw.encoded(F.concat(F.lit("<meta charset='euc-jp'>"), said), "euc_jp")).when(kind == 2, raw.encoded(said, "euc_jp")).otherwise(F.encode(said, "UTF-8"))
    pages = _meetings(s, d, "prefecture").select("meeting_id", raw.page_text(own, F.when(kind == 2, "EUC-JP")).alias("p"))
    return pages.select("meeting_id", "p.charset", F.regexp_replace("p.text", "<[^>]*>", "").alias("prefecture"))


def decoded_in_order(s: SparkSession, d: str) -> DataFrame:
    """Delivered text in UTF-8 with a mark, cp932 and EUC-JP, with the line ends of other systems."""
    said, kind = F.concat(F.coalesce("prefecture", F.lit("")), F.lit("\r\n県議会")), F.col("meeting_id") % 3
    own = F.when(kind == 0, raw.encoded(F.concat(F.lit("﻿"), said), "UTF-8")).when(kind == 1, raw.encoded(said, "cp932")).otherwise(raw.encoded(said, "euc_jp"))
    return _meetings(s, d, "prefecture").select("meeting_id", raw.ordered_text(own).alias("text"))


def _escaped(value: Column) -> Column:
    return F.replace(F.replace(F.replace(value, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit('"'), F.lit("&quot;"))


def page_links(s: SparkSession, d: str) -> DataFrame:
    """Listing pages of every site, written as HTML and read back link by link."""
    rows = table(s, d, "listing").where("url is not null").groupBy("site", "url").agg(F.max("listed_at").cast("date").cast("string").alias("day"))
    links = F.array_sort(F.collect_list(F.struct("url", "day")))
    html = F.concat(F.lit("<ul>"), F.array_join(F.transform(links, lambda x: F.concat(F.lit('<li><a href="'), _escaped(x["url"]), F.lit('">\n  '), x["day"], F.lit(" <b>会議録</b></a>"))), ""), F.lit("</ul>"))
    return rows.groupBy("site").agg(html.alias("page")).select("site", F.inline(raw.html_links(F.col("page")))).select("site", F.col("href").alias("url"), "label")


def page_speeches(s: SparkSession, d: str) -> DataFrame:
    """Every meeting as a page of speech blocks, read back by selectors; blocks without words are dropped but keep their number."""
    own = corpus.latest(table(s, d, "speeches").select("speech_id", "meeting_id", "speech_order", "kind", "retrieved_at"), "speech_id", "retrieved_at").where("meeting_id is not null")
    block = F.concat(F.lit('<div class="b"><i class=who>'), F.col("kind"), F.lit("</i><p class='t'>"), F.when(F.col("speech_id") % 5 == 0, "").otherwise(F.concat(F.lit("発言 "), F.col("speech_id").cast("string"))), F.lit("</p></div>"))
    pages = own.groupBy("meeting_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("speech_order", "speech_id", block.alias("b")))), lambda x: x["b"]), "").alias("page"))
    read = pages.select("meeting_id", F.inline(raw.html_speeches(F.concat(F.lit('<div id="m">'), F.col("page"), F.lit("</div>")), "div#m", "div.b", "i.who", "", "p.t")))
    return read.select("meeting_id", "order", "speaker", "text")


def page_downloads(s: SparkSession, d: str) -> DataFrame:
    """Document pages as the text that their download would be."""
    page = F.concat(F.lit("<h1>"), "prefecture", F.lit("議会  会議録 "), F.col("meeting_date").cast("string"), F.lit("</h1><li class='voice-block' data-voice_code='7'><p class='voice__text'>開議</p></li>"))
    return _meetings(s, d, "prefecture", "meeting_date").select("meeting_id", parsing.download_shape(page).alias("text"))


def rtf_titles(s: SparkSession, d: str) -> DataFrame:
    """Prefectures as RTF, once as bytes of the code page and once as code points with a stand-in."""
    bytes_of = F.regexp_replace(F.lower(F.hex(raw.encoded(F.col("prefecture"), "cp932"))), "(..)", r"\\'$1")
    points = F.array_join(F.transform(F.filter(F.split("prefecture", ""), lambda c: c != ""), lambda c: F.concat(F.lit("\\u"), F.ascii(c).cast("string"), F.lit("?"))), "")
    body = F.concat(F.lit("{\\rtf1\\ansicpg932{\\fonttbl{\\f0 MS;}}"), bytes_of, F.lit("\\par "), points, F.lit("}"))
    return _meetings(s, d, "prefecture").select("meeting_id", raw.rtf(F.encode(body, "ISO-8859-1")).alias("text"))


def hand_made_sittings(s: SparkSession, d: str) -> DataFrame:
    """A file of two sittings for every dated meeting, split at the printed dates."""
    day = F.concat(F.lit("平成"), (F.year("meeting_date") - 1988).cast("string"), F.lit("年"), F.month("meeting_date").cast("string"), F.lit("月"), F.dayofmonth("meeting_date").cast("string"), F.lit("日（水曜日）\n本文\n午後４時　散会\n付録\n"))
    number = lambda n: F.concat(F.lit("第　"), n.cast("string"), F.lit("　号\n"))
    body = F.concat(F.lit("目次\n"), number(F.col("meeting_id") % 90 + 1), day, number(F.col("meeting_id") % 90 + 2), day)
    rows = _meetings(s, d, "meeting_date").select(F.col("meeting_id").cast("string").alias("name"), body.alias("body"))
    return parsing.split_sittings(rows, "name", "body").select("source", F.col("date").cast("string").alias("date"), "number", F.length("text").cast("bigint").alias("characters"))


def _numbered(body: bytes) -> list[dict]:
    """A parser for tests of the plug-ins: one speech per line, none from an empty page, an error from a torn one."""
    lines = body.decode().split("\n")
    if lines[0] == "torn":
        raise ValueError("torn page")
    return [{"order": i, "speaker": "", "role": None, "text": x} for i, x in enumerate(lines) if x]


def parse_report(s: SparkSession, d: str) -> DataFrame:
    """Pages of which some are empty, torn or of an unknown kind: one row of diagnostics for each reason, and no failed run."""
    if "numbered" not in parsing._PARSERS:
        parsing.register_parser("numbered", _numbered)
    case = F.col("meeting_id") % 4
    pages = _meetings(s, d, "prefecture").select(F.col("meeting_id").cast("string").alias("key"), F.when(case == 3, "strange").otherwise("numbered").alias("kind"), F.encode(F.when(case == 1, "").when(case == 2, "torn").otherwise(F.coalesce("prefecture", F.lit("x"))), "UTF-8").alias("body"))
    return parsing.diagnostics(parsing.parse_pages(pages, "key", "kind", "body"))


def cache_keys(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "listing").where("url is not null").select(files.cache_key(F.col("url"), F.lit("json"), F.col("title")).alias("key"), "url").distinct()


def cache_puts(s: SparkSession, d: str) -> DataFrame:
    """Answers stored under the address asked for and that of a redirect."""
    asked = table(s, d, "listing").where("url is not null").select(F.col("url").alias("key"), F.when(F.length("url") % 2 == 0, F.concat("url", F.lit("/"))).alias("final_url"))
    return files.cache_rows(asked).groupBy("key").agg(F.count("*").alias("n"))


def session_dates(s: SparkSession, d: str) -> DataFrame:
    """The date of every meeting in each of the forms a date is written in, read back; no date is NULL."""
    y, m, day = F.year("meeting_date"), F.month("meeting_date"), F.dayofmonth("meeting_date")
    t = lambda c: c.cast("string")
    forms = (
        F.concat(_era(), t(_era_year()), F.lit("年"), t(m), F.lit("月"), t(day), F.lit("日（会議録）")),
        F.concat(_era(), F.translate(t(_era_year()), text.DIGITS, text.FULL_DIGITS), F.lit("年 "), F.translate(t(m), text.DIGITS, text.FULL_DIGITS), F.lit(" 月"), t(day), F.lit("日")),
        F.concat(_era(), _kanji(_era_year()), F.lit("年"), _kanji(m), F.lit("月"), _kanji(day), F.lit("日")),
        F.concat(F.when(_era() == "令和", "R").otherwise("H"), t(_era_year()), F.lit("."), t(m), F.lit("."), t(day)),
        F.concat(t(y), F.lit("年"), t(m), F.lit("月"), t(day), F.lit("日")),
        F.concat(t(m), F.lit("/"), t(day), F.lit("/"), t(y)),
    )
    written = F.element_at(F.array(*forms), (F.pmod("meeting_id", F.lit(len(forms))) + 1).cast("int"))
    return _meetings(s, d, "meeting_date").select("meeting_id", dates.japanese_date(written).cast("string").alias("date"))


def file_dates(s: SparkSession, d: str) -> DataFrame:
    name = F.concat(F.when(_era() == "令和", "R").otherwise("H"), F.lpad(_era_year().cast("string"), 2, "0"), F.date_format("meeting_date", "MMdd"), F.lit("A1"))
    return _meetings(s, d, "meeting_date").select("meeting_id", dates.file_date(name).cast("string").alias("date"))


def kanji_numbers(s: SparkSession, d: str) -> DataFrame:
    own = _meetings(s, d, "meeting_date").where("meeting_date is not null")
    return own.select("meeting_id", dates.kanji_number(_kanji(F.dayofmonth("meeting_date"))).alias("day"), dates.kanji_number(_kanji(_era_year())).alias("year"))


def listing_years(s: SparkSession, d: str) -> DataFrame:
    """The year of a sitting from that of its council's name and that of the list."""
    m = _meetings(s, d, "meeting_date").where("meeting_date is not null")
    named = F.when(F.col("meeting_id") % 3 > 0, F.year("meeting_date") + F.when(F.col("meeting_id") % 3 == 1, 0).otherwise(3))
    return m.select("meeting_id", dates.listing_year(named, F.year("meeting_date"), F.lit(12), F.month("meeting_date")).alias("year"))


def era_sorted(s: SparkSession, d: str) -> DataFrame:
    """Labels of years of both eras, the latest first."""
    labels = _meetings(s, d, "meeting_date").where("meeting_date is not null").select(F.concat(_era(), F.when(_era_year() == 1, "元").otherwise(_era_year().cast("string")), F.lit("年")).alias("label")).distinct()
    # One row per year is left, so one place may rank them.
    return labels.select("label", F.row_number().over(Window.orderBy(*dates.by_era(F.col("label")))).alias("place"))


def clean_names(s: SparkSession, d: str) -> DataFrame:
    """Names with honorifics, repeated ones and a different one before, which belongs to the name."""
    kind = F.length("prefecture") % 3
    said = F.concat("prefecture", F.when(kind == 0, " 君").when(kind == 1, "さん さん").otherwise("さん 君"))
    return table(s, d, "sites").select("site", text.clean_speaker(said).alias("speaker"))


def squashed(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "sites").select("site", text.squash(F.concat(F.lit(" "), F.col("prefecture"), F.lit("　Ａ１\t"), F.col("scraper"))).alias("text"))


def first_groups(s: SparkSession, d: str) -> DataFrame:
    """The group of a pattern that has one, and the whole match of one that has none."""
    found = F.concat_ws(" ", text.first_group(F.col("url"), "sitting=([0-9]+)", 1), text.first_group(F.col("url"), "council=[0-9]+", 0))
    return table(s, d, "listing").where("url is not null").select("url", found.alias("part")).distinct()


def plain_pages(s: SparkSession, d: str) -> DataFrame:
    """Texts in a stated codec with page marks and the line ends of other systems."""
    said = F.concat(F.coalesce("prefecture", F.lit("")), F.lit('\r\n<PAGE="12">県\r議会'))
    return _meetings(s, d, "prefecture").select("meeting_id", raw.without_page_marks(raw.decoded(raw.encoded(said, "cp932"), "cp932")).alias("text"))


def page_targets(s: SparkSession, d: str) -> DataFrame:
    """Pages of every site with its listed addresses as frames, inline frames, links and clicks."""
    rows = table(s, d, "listing").where("url is not null").select("site", "url").distinct()
    at, to = F.length("url") % 4, _escaped(F.col("url"))
    tag = F.when(at == 0, F.concat(F.lit('<frame src="'), to, F.lit('">'))).when(at == 1, F.concat(F.lit('<iframe src="'), to, F.lit('"></iframe>'))).when(at == 2, F.concat(F.lit('<a href="'), to, F.lit('">x</a>'))).otherwise(F.concat(F.lit("<p onClick=\"winopen('"), to, F.lit("')\">x</p>")))
    pages = rows.groupBy("site").agg(F.array_join(F.array_sort(F.collect_list(tag)), "\n").alias("page"))
    return pages.select("site", F.inline(raw.html_targets(F.col("page"))))


def council_tree(s: SparkSession, d: str) -> DataFrame:
    """Tree answers of every prefecture with its councils under proceedings or, every third, under materials."""
    own = _meetings(s, d, "prefecture", "council_id", "meeting_date").where("meeting_date is not null and council_id is not null").select("prefecture", F.year("meeting_date").cast("string").alias("view_year"), F.when(F.col("council_id") % 3 == 0, "資料").otherwise(files.PROCEEDINGS).alias("kind"), "council_id").distinct()
    kinds = own.groupBy("prefecture", "view_year", "kind").agg(F.collect_list(F.struct("council_id", F.concat(F.lit("第 "), F.col("council_id").cast("string"), F.lit("　回")).alias("name"))).alias("councils"))
    years = kinds.groupBy("prefecture", "view_year").agg(F.collect_list(F.struct(F.col("kind").alias("council_type_name1"), F.lit("定例会").alias("council_type_name2"), "councils")).alias("council_type"))
    body = F.to_json(F.struct(F.array(F.struct(F.collect_list(F.struct("view_year", "council_type")).alias("view_years"))).alias("councils")))
    pages = years.groupBy(F.col("prefecture").alias("key")).agg(F.encode(body, "UTF-8").alias("body"))
    return files.council_rows(pages).select("key", "view_year", "council_id", "name", "material", F.array_join("names", "/").alias("names"))


def stripped_answers(s: SparkSession, d: str) -> DataFrame:
    """Answers that repeat one or both lines of their header, or none."""
    day, name = F.concat(F.lit("開催日："), F.col("meeting_date").cast("string"), F.lit("\n")), F.lit("会議名：定例会\n")
    kind = F.col("meeting_id") % 4
    body = F.concat(F.when(kind != 1, day).otherwise(""), F.when(kind != 2, name).otherwise(""), F.lit("\r\n"), "prefecture", F.lit("\n会議名：本文"))
    return _meetings(s, d, "prefecture", "meeting_date").select("meeting_id", raw.without_response_header(body).alias("text"))


def waits(s: SparkSession, d: str) -> DataFrame:
    """Seconds between requests and before a retry, with and without what the host asks for."""
    e = table(s, d, "events").select("event_id", (F.col("event_id") % 8).alias("attempt"), F.when(F.col("event_id") % 3 == 0, "17").when(F.col("event_id") % 3 == 1, "soon").alias("asked"), F.when(F.col("event_id") % 2 == 0, F.lit(5)).alias("delay"))
    return e.select("event_id", policy.interval_seconds(F.lit(2), F.col("delay")).alias("interval"), policy.retry_wait(F.col("attempt"), F.col("asked")).alias("wait"))


def heading_dates(s: SparkSession, d: str) -> DataFrame:
    """Headings with a date and weekday, with a year only, or with a date beyond reach, beside labels of the day or of the next."""
    kind, m, day = F.col("meeting_id") % 3, F.month("meeting_date"), F.dayofmonth("meeting_date")
    full = F.concat(_era(), _era_year().cast("string"), F.lit("年"), m.cast("string"), F.lit("月"), day.cast("string"), F.lit("日（水曜日）"))
    year = F.concat(_era(), _era_year().cast("string"), F.lit("年定例会"))
    text_ = F.when(kind == 0, F.concat(F.lit("会議録\n"), full)).when(kind == 1, F.concat(year, F.lit("\n開議"))).otherwise(F.concat(year, F.repeat(F.lit("　"), 400), full))
    label = F.concat(m.cast("string"), F.lit("月"), F.when(F.col("meeting_id") % 2 == 0, day).otherwise(F.lit(1)).cast("string"), F.lit("日"))
    return _meetings(s, d, "meeting_date").where("meeting_date is not null").select("meeting_id", dates.dated_heading(text_, label).alias("x")).select("meeting_id", F.col("x.date").cast("string").alias("date"), "x.from_label", "x.differs")


def site_survey(s: SparkSession, d: str) -> DataFrame:
    """A first look at every site: its start page, the frame of it, and its lists by year, at most five pages that are not stored."""
    listed = table(s, d, "listing").where("url is not null and meeting_date is not null")
    root = F.concat(F.lit("site:"), "site")
    years = listed.groupBy(root.alias("source"), F.year("meeting_date").alias("y")).agg(F.count("*").alias("n")).select("source", F.concat("source", F.lit("/"), F.col("y").cast("string")).alias("target"), F.lit("link").alias("kind"), F.concat(F.col("y").cast("string"), F.lit("年")).alias("label"), F.col("y").alias("position"))
    frames = years.select("source", F.concat("source", F.lit("/menu")).alias("target"), F.lit("frame").alias("kind"), F.lit(None).cast("string").alias("label"), F.lit(0).alias("position")).distinct()
    start = years.select(F.col("source").alias("url")).distinct()
    return walk.survey(start, years.unionByName(frames), ["^[0-9]+年$"], "2024", 5, start)


ALL: tuple[Callable[[SparkSession, str], DataFrame], ...] = (
    jsonl_strict, jsonl_lenient, csv_round_trip, csv_appended, sniffed_charsets, decoded_in_order, page_links, page_speeches, page_downloads, rtf_titles, hand_made_sittings, parse_report, cache_keys, cache_puts,
    session_dates, file_dates, kanji_numbers, listing_years, era_sorted, clean_names, squashed, first_groups, plain_pages, page_targets, council_tree, stripped_answers, waits, heading_dates, site_survey,
)

_ONCE = "m AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY meeting_id ORDER BY retrieved_at DESC) AS rn FROM meetings) WHERE rn = 1), sp AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY speech_id ORDER BY retrieved_at DESC) AS rn FROM speeches) WHERE rn = 1)"
SQL: dict[str, str] = {
    "jsonl_strict": f"""WITH {_ONCE}, j AS (SELECT meeting_id, count(*) AS n, sum(length(text)) + 2 * (count(*) - 1) AS c, bool_and(kind = 'summary') AS s FROM sp GROUP BY 1)
        SELECT prefecture, CASE WHEN s THEN 'summary' ELSE 'verbatim' END AS kind, count(*) AS meetings, CAST(sum(coalesce(n, 0)) AS BIGINT) AS speeches, CAST(sum(coalesce(c, 0)) AS BIGINT) AS characters FROM m LEFT JOIN j USING (meeting_id) GROUP BY 1, 2""",
    "jsonl_lenient": f"WITH {_ONCE} SELECT DISTINCT coalesce(url, 'file:' || source_file) AS key FROM m WHERE meeting_id % 3 <> 0 AND coalesce(url, source_file) IS NOT NULL",
    "csv_round_trip": f"WITH {_ONCE} SELECT prefecture, kind, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS characters, count(DISTINCT meeting_date) AS dates, count(*) FILTER (coalesce(role, '') <> '') AS with_role FROM sp GROUP BY 1, 2",
    "csv_appended": f"WITH {_ONCE} SELECT prefecture, kind, count(*) AS n FROM sp GROUP BY 1, 2",
    "sniffed_charsets": f"WITH {_ONCE} SELECT meeting_id, CASE meeting_id % 4 WHEN 0 THEN 'cp932' WHEN 1 THEN 'euc-jp' WHEN 2 THEN 'euc-jp' ELSE 'utf-8' END AS charset, coalesce(prefecture, '') AS prefecture FROM m",
    "decoded_in_order": f"WITH {_ONCE} SELECT meeting_id, coalesce(prefecture, '') || chr(10) || '県議会' AS text FROM m",
    "page_links": "SELECT site, url, CAST(CAST(max(listed_at) AS DATE) AS VARCHAR) || ' 会議録' AS label FROM listing WHERE url IS NOT NULL GROUP BY 1, 2",
    "page_speeches": f"""WITH {_ONCE}, o AS (SELECT *, CAST(row_number() OVER (PARTITION BY meeting_id ORDER BY speech_order NULLS FIRST, speech_id) - 1 AS INTEGER) AS n FROM sp WHERE meeting_id IS NOT NULL)
        SELECT meeting_id, n AS "order", kind AS speaker, '発言 ' || speech_id AS text FROM o WHERE speech_id % 5 <> 0""",
    "page_downloads": f"WITH {_ONCE} SELECT meeting_id, prefecture || '議会 会議録 : ' || CAST(meeting_date AS VARCHAR) || chr(10) || repeat('-', 64) || chr(10) || '7:' || chr(10) || '開議' AS text FROM m",
    "rtf_titles": f"WITH {_ONCE} SELECT meeting_id, prefecture || chr(10) || prefecture AS text FROM m",
    "hand_made_sittings": f"""WITH {_ONCE}, k AS (SELECT meeting_id, meeting_date, unnest([1, 2]) AS i FROM m WHERE meeting_date IS NOT NULL)
        SELECT meeting_id || '#' || CAST(meeting_date AS VARCHAR) AS source, CAST(meeting_date AS VARCHAR) AS date, CAST(meeting_id % 90 + i AS INTEGER) AS number,
        CAST(length('平成年月日（水曜日）') + length(CAST(year(meeting_date) - 1988 AS VARCHAR)) + length(CAST(month(meeting_date) AS VARCHAR)) + length(CAST(day(meeting_date) AS VARCHAR)) + length('|本文|午後４時　散会') AS BIGINT) AS characters FROM k""",
    "parse_report": f"""WITH {_ONCE} SELECT CASE WHEN meeting_id % 4 = 3 THEN 'strange' ELSE 'numbered' END AS site, CASE meeting_id % 4 WHEN 0 THEN 'parsed' WHEN 1 THEN 'no speeches' WHEN 2 THEN 'ValueError' ELSE 'KeyError' END AS reason, count(*) AS n FROM m GROUP BY 1, 2""",
    "cache_keys": "SELECT DISTINCT url || CASE WHEN title IS NULL THEN '' ELSE '#json:' || sha256(title) END AS key, url FROM listing WHERE url IS NOT NULL",
    "cache_puts": "SELECT key, count(*) AS n FROM (SELECT url AS key FROM listing WHERE url IS NOT NULL UNION ALL SELECT url || '/' FROM listing WHERE url IS NOT NULL AND length(url) % 2 = 0) GROUP BY 1",
    "session_dates": f"WITH {_ONCE} SELECT meeting_id, CAST(meeting_date AS VARCHAR) AS date FROM m",
    "file_dates": f"WITH {_ONCE} SELECT meeting_id, CAST(meeting_date AS VARCHAR) AS date FROM m",
    "kanji_numbers": f"WITH {_ONCE} SELECT meeting_id, CAST(day(meeting_date) AS INTEGER) AS day, CAST(year(meeting_date) - CASE WHEN meeting_date >= DATE '2019-05-01' THEN 2018 ELSE 1988 END AS INTEGER) AS year FROM m WHERE meeting_date IS NOT NULL",
    "listing_years": f"WITH {_ONCE} SELECT meeting_id, CAST(year(meeting_date) + CASE WHEN month(meeting_date) <= 4 THEN 1 ELSE 0 END AS INTEGER) AS year FROM m WHERE meeting_date IS NOT NULL",
    "era_sorted": f"""WITH {_ONCE}, y AS (SELECT DISTINCT CASE WHEN meeting_date >= DATE '2019-05-01' THEN '令和' ELSE '平成' END AS e, year(meeting_date) - CASE WHEN meeting_date >= DATE '2019-05-01' THEN 2018 ELSE 1988 END AS n FROM m WHERE meeting_date IS NOT NULL)
        SELECT e || CASE WHEN n = 1 THEN '元' ELSE CAST(n AS VARCHAR) END || '年' AS label, CAST(row_number() OVER (ORDER BY e = '令和' DESC, n DESC) AS INTEGER) AS place FROM y""",
    "clean_names": "SELECT site, prefecture || CASE WHEN length(prefecture) % 3 = 2 THEN 'さん' ELSE '' END AS speaker FROM sites",
    "squashed": "SELECT site, prefecture || 'A1' || scraper AS text FROM sites",
    "first_groups": "SELECT DISTINCT url, regexp_extract(url, 'sitting=([0-9]+)', 1) || ' ' || regexp_extract(url, 'council=[0-9]+') AS part FROM listing WHERE url IS NOT NULL",
    "plain_pages": f"WITH {_ONCE} SELECT meeting_id, coalesce(prefecture, '') || chr(10) || '県' || chr(10) || '議会' AS text FROM m",
    "page_targets": "SELECT DISTINCT site, CASE length(url) % 4 WHEN 0 THEN 'frame' WHEN 1 THEN 'frame' WHEN 2 THEN 'link' ELSE 'script' END AS kind, url AS address FROM listing WHERE url IS NOT NULL",
    "council_tree": f"""WITH {_ONCE} SELECT DISTINCT prefecture AS key, CAST(year(meeting_date) AS INTEGER) AS view_year, council_id, '第' || council_id || '回' AS name, council_id % 3 = 0 AS material, CASE WHEN council_id % 3 = 0 THEN '資料' ELSE '全会議' END || '/定例会' AS names FROM m WHERE meeting_date IS NOT NULL AND council_id IS NOT NULL""",
    "stripped_answers": f"WITH {_ONCE} SELECT meeting_id, CASE WHEN meeting_id % 4 <> 1 AND meeting_date IS NULL THEN NULL ELSE prefecture || chr(10) || '会議名：本文' END AS text FROM m",
    "waits": "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 5 ELSE 2 END::DOUBLE AS interval, CASE WHEN event_id % 3 = 0 THEN 17 ELSE least(60, pow(2, event_id % 8)) END::DOUBLE AS wait FROM events",
    "heading_dates": f"""WITH {_ONCE} SELECT meeting_id, CAST(CASE WHEN meeting_id % 3 = 0 OR meeting_id % 2 = 0 THEN meeting_date ELSE date_trunc('month', meeting_date) END AS DATE)::VARCHAR AS date, meeting_id % 3 <> 0 AS from_label, meeting_id % 3 = 0 AND meeting_id % 2 = 1 AND day(meeting_date) <> 1 AS differs FROM m WHERE meeting_date IS NOT NULL""",
    "site_survey": """WITH y AS (SELECT DISTINCT 'site:' || site AS site, year(meeting_date) AS y FROM listing WHERE url IS NOT NULL AND meeting_date IS NOT NULL),
        p AS (SELECT DISTINCT site, site AS url, 0 AS depth, 0 AS a, 0 AS b, 0 AS c, 0 AS cost FROM y UNION ALL SELECT DISTINCT site, site || '/menu', 0, 0, 1, 0, 1 FROM y UNION ALL SELECT site, site || '/' || y, 1, 1, CASE WHEN y = 2024 THEN 0 ELSE 1 END, y, 1 FROM y),
        r AS (SELECT *, sum(cost) OVER w AS spent, row_number() OVER w AS place FROM p WINDOW w AS (PARTITION BY site ORDER BY depth, a, b, c, url ROWS UNBOUNDED PRECEDING))
        SELECT site, url, CAST(depth AS INTEGER) AS depth, CAST(place AS INTEGER) AS place FROM r WHERE spent <= 5""",
}
