import datetime as dt

import pytest
from pyspark.sql import functions as F

from minutesmith.operators import audit, corpus, sequences, titles, walk
from minutesmith.sources import files
from minutesmith.streaming import incremental


def test_flatten_keeps_empty_meetings(spark):
    m = spark.createDataFrame([(1, "a"), (2, "b")], "id int, t string")
    s = spark.createDataFrame([(1, 1, "x"), (1, 0, "y")], "id int, o int, text string")
    flat = corpus.flatten(corpus.nest(m, s, "id", "o", ["text"])).orderBy("id", "speech_order").collect()
    assert [(r["id"], r["speech_order"], r["text"]) for r in flat] == [(1, 0, "y"), (1, 1, "x"), (2, None, None)]


def test_kind(spark):
    df = spark.sql("select array() a union all select array('summary') union all select array('summary', 'verbatim')").select(F.transform("a", lambda k: F.struct(k.cast("string").alias("kind"))).alias("s"))
    assert [r[0] for r in df.select(corpus.meeting_kind(F.col("s"))).collect()] == ["verbatim", "summary", "verbatim"]


def test_key_is_required(spark):
    df = spark.createDataFrame([(None, "f"), ("u", None)], "url string, source_file string")
    assert {r["record_key"] for r in corpus.with_key(df).collect()} == {"file:f", "u"}
    with pytest.raises(Exception, match="neither"):
        corpus.with_key(spark.createDataFrame([(None, None)], "url string, source_file string")).collect()


def test_longest_prefix(spark):
    rows = spark.createDataFrame([("https://a.x/b/1",), ("https://a.x/c",), ("https://z/",), (None,)], "url string")
    routes = spark.createDataFrame([("https://a.x/", "short"), ("https://a.x/b/", "long")], "p string, site string")
    routed = audit.longest_prefix(rows, "url", routes, "p", "site")
    assert {r["url"]: r["site"] for r in routed.collect()} == {"https://a.x/b/1": "long", "https://a.x/c": "short", "https://z/": None, None: None}
    assert audit.unrouted(routed, "site") == 2


def test_edition(spark):
    rows = spark.createDataFrame([(1, "a", "速報版"), (2, "a", "確定版"), (3, "b", "速報版"), (4, "c", None)], "id int, label string, e string")
    assert {r["id"] for r in audit.preferred_edition(rows, ["label"], "e", "確定版", "速報版").collect()} == {2, 3, 4}


def test_even_sample(spark):
    rows = spark.range(40).withColumn("g", F.lit(1))
    found = sorted(r["id"] for r in sequences.even_sample(rows, ["g"], ["id"], 6).collect())
    assert found == [round(i * 39 / 5) for i in range(6)]


def test_rotating_sample(spark):
    rows = spark.createDataFrame([(y, c, i) for y in (1, 2, 3) for i, c in enumerate("abc")], "year int, c string, id int")
    assert sorted(r["c"] for r in sequences.rotating_sample(rows, "year", "c", "id").collect()) == ["a", "b", "c"]


def test_packed_positions(spark):
    df = spark.sql("select array(1, 2, 3, 4) p, array(1000, 900, 1800, 1) c")
    assert df.select(sequences.packed_positions(F.col("p"), F.col("c"), 1800)).first()[0] == [[1], [2], [3], [4]]


def test_page_numbers(spark):
    assert [r[0] for r in spark.sql("select explode(array(0, 10, 11, 35)) n").select(sequences.page_numbers(F.col("n"))).collect()] == [[], [], [2], [2, 3, 4]]


def decide(title, names, held, offices):
    """The rules one title at a time."""
    if title in names:
        return ("name", title, None)
    for office in sorted(offices, key=len, reverse=True):
        if not title.endswith(office):
            continue
        rest = title[: -len(office)].strip()
        if rest == "":
            return ("office", "", office)
        if len(rest) < 2:
            continue
        if rest in names:
            return ("split", rest, office)
        near = sorted(n for n in names if n.startswith(rest))
        if len(near) == 1:
            return ("surname", rest, office)
        if near:
            who = [n for n in near if (n, office) in held]
            return ("holder", who[0], office) if len(who) == 1 else ("ambiguous", title, None)
    for office in sorted(offices, key=len, reverse=True):
        rest = title[: -len(office)].strip()
        if title.endswith(office) and len(rest) >= 2 and not any(rest.endswith(o) for o in offices):
            return ("uncorroborated", rest, office)
    return ("unknown", title, None)


def test_titles_follow_the_rules(spark):
    import itertools
    import random

    random.seed(5)
    offices = ["委員長", "副委員長", "委員", "部長", "総務部長", "長官"]
    names = ["甲田一", "甲田二", "乙山三", "丙川四郎", "甲"]
    held = [("甲田一", "部長"), ("甲田二", "委員"), ("甲田一", "委員")]
    heads = ["", "甲田", "甲田一", "乙山", "丙川四", "戊野", "丁", "乙山三", "甲田副"]
    pool = ["".join(x) for x in itertools.product(heads, ["", *offices])]
    sample = sorted({t for t in pool if t})
    frame = lambda rows, ddl: spark.createDataFrame(rows, ddl)
    found = titles.decide_titles(
        frame([(1, t) for t in sample], "g int, title string"), frame([(1, n) for n in names], "g int, name string"), frame([(1, *h) for h in held], "g int, name string, office string"), frame([(o,) for o in offices], "office string"), "g"
    ).collect()
    assert {r["title"]: (r["outcome"], r["speaker"], r["role"]) for r in found} == {t: decide(t, set(names), set(held), offices) for t in sample}


def test_roster_split(spark):
    df = spark.createDataFrame([("役職（甲田一君）",), ("甲田　一副委員長",), ("乙山委員長",), ("何某",)], "t string")
    split = titles.roster_split(F.col("t"), F.array(F.lit("甲田一"), F.lit("乙山三")), F.array(F.lit("委員長"), F.lit("副委員長")))
    assert [tuple(r[0]) for r in df.select(split).collect()] == [("甲田一", "役職"), ("甲田一", "副委員長"), ("乙山", "委員長"), ("何某", None)]


def test_walk(spark):
    links = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d")], "source string, target string")
    found = walk.reach(spark.createDataFrame([("a",)], "url string"), links, 2).collect()
    assert {r["url"]: r["depth"] for r in found} == {"a": 0, "b": 1, "c": 2}


def test_json_lines(spark, tmp_path):
    good = '{"prefecture":"p","url":"u1","speeches":[{"order":0,"speaker":"s","text":"a, \\"b\\"\\nc","kind":"summary"}],"retrieved_at":"2025-01-01T00:00:00Z"}'
    (tmp_path / "a.jsonl").write_text(good + "\n\n" + '{"source_file":"f"}\n', encoding="utf-8")
    (tmp_path / "b.jsonl").write_text(good + "\n{ not json\n", encoding="utf-8")
    assert {r["kind"] for r in files.read_meetings(spark, str(tmp_path / "a.jsonl")).collect()} == {"summary", "verbatim"}
    assert {r["key"] for r in files.seen_keys(spark, str(tmp_path / "a.jsonl"), str(tmp_path / "b.jsonl")).collect()} == {"u1", "file:f"}
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_meetings(spark, str(tmp_path / "b.jsonl")).collect()


def test_csv_round_trip(spark, tmp_path):
    rows = [("p", dt.date(2025, 1, 2), None, None, "t", "u", None, 0, "s", None, "verbatim", 'x, "y"\n「z」', dt.datetime(2025, 1, 1), None)]
    ddl = "prefecture string, date date, session string, committee string, title string, url string, source_file string, speech_order int, speaker string, role string, kind string, text string, retrieved_at timestamp, source_html_sha256 string"
    files.write_csv(spark.createDataFrame(rows, ddl), str(tmp_path / "out"))
    back = files.read_csv(spark, str(tmp_path / "out")).first()
    assert back["text"] == 'x, "y"\n「z」' and back["date"] == "2025-01-02" and back["role"] in ("", None)


def test_append_once(spark, tmp_path):
    store, report = str(tmp_path / "store"), str(tmp_path / "report")
    frame = lambda rows: spark.createDataFrame(rows, "k int, v string")
    incremental.append_once(frame([(1, "a"), (2, "b")]), store, "k", ["v"], report)
    incremental.append_once(frame([(2, "b"), (1, "x"), (3, "c")]), store, "k", ["v"], report)
    assert {(r["k"], r["v"]) for r in spark.read.parquet(store).collect()} == {(1, "a"), (2, "b"), (3, "c")}
    assert {(r["k"], r["same"]) for r in spark.read.parquet(report).collect()} >= {(2, True), (1, False)}


def test_api_rows(spark):
    body = '{"tenant_minutes":[{"minute_id":1,"title":"議長","minute_type_code":4,"body":"<pre>x</pre>"}]}'.encode()
    rows = files.api_rows(spark.createDataFrame([("k", bytearray(body))], "key string, body binary"), files.BLOCKS, "tenant_minutes").collect()
    assert rows[0]["title"] == "議長" and rows[0]["minute_type_code"] == 4


def test_gaps_and_breaks(spark):
    rows = spark.createDataFrame([(1, 0), (1, 1), (1, 3), (2, 0), (2, 0)], "g int, n int")
    assert {r["g"]: (r["missing"], r["repeated"]) for r in audit.gaps(rows, "g", "n").collect()} == {1: (1, 0), 2: (0, 1)}


def test_sections(spark):
    from minutesmith.operators import documents

    text = "表紙\n○議長（甲君）　議席は表のとおりです。\n─────\n〔参照〕\n表\n─────\n次に移ります。\n─────\n午前10時00分休憩\n─────\n黙祷を行います。\n○部長（乙君）\n○議員（丙君）はい。"
    # Behind an aside, what an empty section parts from it does not resume; a resumption before any speech stands for itself.
    other = "◎議長（丁君）\n---\n（氏名\n---\n\n---\n一\n---\n出席者氏名\n----\n二\n" + "-" * 40 + "\n三"
    rows = spark.createDataFrame([(1, text), (2, other), (3, None), (4, ""), (5, "表紙だけ")], "k int, t string")
    found = documents.section_rows(rows, "k", "t", r"^[○◯◎](?<role>[^（]*)（(?<speaker>[^）]+?)君）", speaker=2, role=1)
    speeches = [tuple(r) for r in documents.section_speeches(found, "k").orderBy("k", "order").collect()]
    assert speeches == [(1, 0, "甲", "議長", "議席は表のとおりです。\n次に移ります。"), (1, 1, "", None, "黙祷を行います。"), (1, 2, "丙", "議員", "はい。"), (2, 0, "", None, "一\n二\n" + "-" * 40 + "\n三")]
    counts = {r["k"]: r.asDict() for r in documents.section_counts(found, "k").collect()}
    assert counts[1] == {"k": 1, "speeches": 3, "silent": 1, "cut": 5, "resumed": 1, "unattributed": 1, "rules": 4} and set(counts) == {1, 2}


def test_rosters_and_wraps(spark):
    from minutesmith.operators import documents

    names, offices = documents.roster("議長　　　甲田　一君\n副議長　　乙山三\n〃　　　　丙川四君\n丁野五\n1234")
    assert names == ["丁野五", "丙川四", "乙山三", "甲田一"] and offices[0] == "副議長" and "議長" in offices
    long = "あ" * 60
    texts = {
        "        これは途中\n        で折れる。\n        次の行。": "これは途中で折れる。\n次の行。",
        "\n".join([long] * 60 + ["終わり。"]): long * 60 + "終わり。",
        "\n".join([long] * 59 + ["あ" * 58, "　段落", long, "続き", "○次"]): None,
        "短い\n行": "短い\n行", "": "", "        \n        ": "        \n        ",
    }
    got = [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(documents.unwrap(F.col("t"))).collect()]
    want = list(texts.values())
    want[2] = long * 59 + "あ" * 58 + "\n　段落\n" + long + "続き\n○次"
    assert got == want
    widths = spark.createDataFrame([("aあ①ｱ",), ("",)], "t string").select(documents.width(F.col("t"))).collect()
    assert [r[0] for r in widths] == [6, 0]
    assert documents.indented_record("田中委員\n　質問です。\n　続きます。\n3 議題\n　内容\n説明。\n　x") == [("田中委員", "質問です。\n続きます。\n内容\nx")]


def test_headers(spark):
    from minutesmith.operators import documents

    df = spark.createDataFrame([("令和7年定例会（第2号）　本文 : 2025-06-10\n---",), ("x",)], "t string")
    first, second = [r["h"] for r in df.select(documents.download_header(F.col("t")).alias("h")).collect()]
    assert (first["heading"], first["number"], first["kind"], first["date"]) == ("令和7年定例会", 2, "本文", dt.date(2025, 6, 10)) and second["kind"] is None
    url = spark.createDataFrame([("https://a.x/b/c?x=1", "../d#e")], "b string, h string").select(documents.absolute_url(F.col("b"), F.col("h"))).first()[0]
    assert url == "https://a.x/d"


@pytest.mark.parametrize(
    ("line", "speaker", "role", "rest"),
    [
        ("○議長（甲江正人君）　開会します。", "甲江正人", "議長", "　開会します。"), ("◆11番（乙野瀬明子議員）", "乙野瀬明子", "11番", ""), ("◎２０番（総務企画常任委員長丙川治君）", "丙川治", "20番　総務企画常任委員長", ""),
        ("◆（丁井廣明君）はい", "丁井広明", None, "はい"), ("◎戊田富郎君　はい", "戊田富郎", None, "　はい"), ("○己谷暢之　議長　はい", "己谷暢之", "議長", "　はい"), ("◎20番（庚片信悟議員［総務・企画常任委員長］）", "庚片信悟", "20番　総務・企画常任委員長", ""),
        ("○県政経営委員会　辛崎信委員長　はい", "辛崎信", "県政経営委員会委員長", "　はい"), ("◎教育長（教育長壬山隆一　君）", "壬山隆一", "教育長", ""), ("○○○議会議長○○", "", None, "○○○議会議長○○"), ("ただの行", "", None, "ただの行"),
    ],
)
def test_labels(spark, line, speaker, role, rest):
    from minutesmith.functions import labels

    found = labels.with_label(spark.createDataFrame([(line,)], "line string"), "line").first()["label"]
    assert (found["speaker"], found["role"], found["rest"]) == (speaker, role, rest)


def test_bodies(spark):
    from minutesmith.functions import labels

    one = lambda f, *v: spark.createDataFrame([v], ", ".join(f"c{i} string" for i in range(len(v)))).select(f(*(F.col(f"c{i}") for i in range(len(v))))).first()[0]
    assert one(labels.speech_body, "はい。\n　─────\n 次。\n会議録署名議員\n議長") == "はい。\n次。"
    assert tuple(one(labels.cut_at_rule, "はい。\n────\n資料")) == ("はい。", True)
    assert one(labels.from_first_label, "午前10時開議\n○議長　はい") == "○議長　はい" and one(labels.from_first_label, "前\n─────\n○議長") == "前\n─────\n○議長"
    assert one(labels.without_echo, "<pre>◆二番（甲君）　はい</pre>", "二番（甲君）") == "はい" and one(labels.without_echo, "別の文", "二番（甲君）") == "別の文"
    assert [(r["id"], r["text"]) for r in one(labels.anchored_blocks, 'x<A NAME="HUID1">a<BR>b<script>1</script><A NAME="HUID2">c')] == [("HUID1", "a\nb"), ("HUID2", "c")]


def test_plug_ins_isolate_failures(spark):
    from minutesmith.sources import parsing

    def parser(raw):
        if raw == b"bad":
            raise KeyError("no")
        return [{"order": 0, "speaker": "a", "role": None, "text": raw.decode()}] if raw else []

    parsing.register_parser("test", parser)
    pages = spark.createDataFrame([("1", "test", bytearray(b"x")), ("2", "test", bytearray(b"bad")), ("3", "none", bytearray(b"x")), ("4", "test", bytearray())], "key string, kind string, body binary")
    parsed = parsing.parse_pages(pages, "key", "kind", "body")
    assert {r["key"]: (r["error"] or "")[:8] for r in parsed.collect()} == {"1": "", "2": "KeyError", "3": "KeyError", "4": "no speec"}
    assert {(r["reason"], r["n"]) for r in parsing.diagnostics(parsed).where("site = 'test'").collect()} == {("parsed", 1), ("KeyError", 1), ("no speeches", 1)}
    with pytest.raises(ValueError):
        parsing.register_parser("test", lambda raw: [])


def test_deliveries(spark, tmp_path):
    from minutesmith.sources import parsing

    assert parsing.right_name("H19年".encode("cp932").decode("cp437")) == "H19年" and parsing.right_name("平成") == "平成"
    assert parsing.filed_as("x/y.txt", "令和7年定例会（第２号）　本文 : 2025-06-10") == "download/20250610_令和7年定例会_2.txt"
    pages = spark.createDataFrame([("<h1>目次</h1><h1>会議録（第1号）  本文 2025-06-10</h1><li class=voice-block data-voice_code=3><p class=voice__text>はい</p></li>",), ("<h1>目次</h1>",), (None,)], "p string")
    shaped = [r[0] for r in pages.select(parsing.download_shape(F.col("p"))).collect()]
    assert shaped[1:] == [None, None] and shaped[0] == "会議録（第1号） 本文 : 2025-06-10\n" + "-" * 64 + "\n3:\nはい"
    text = "第１号\n平成16年9月28日（火曜日）\n一\n午後4時散会\n第２号\n平成16年9月29日（水曜日）\n二\n閉会\n付録"
    rows = parsing.split_sittings(spark.createDataFrame([("f", text), ("g", "日付なし"), ("h", None)], "s string, t string"), "s", "t").collect()
    assert [(r["source"], r["number"], r["text"].split("\n")[-1]) for r in rows] == [("f#2004-09-28", 1, "午後4時散会"), ("f#2004-09-29", 2, "閉会")]
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    parsing.swap_rewrite(spark, spark.read.parquet(path).where("id > 0"), path, path + ".bak")
    assert spark.read.parquet(path).count() == 2 and spark.read.parquet(path + ".bak").count() == 3


def test_link_rules(spark):
    links = spark.createDataFrame([("a", "b", "令和7年", 1), ("b", "c", "総務委員会", 2), ("b", "d", "特別", 3), ("c", "e", "会議録", 4)], "source string, target string, label string, position int")
    start = spark.createDataFrame([("a",)], "url string")
    assert [(r["url"], r["path"]) for r in walk.levels(start, links, ["年$", "委員会", "会議録"]).collect()] == [("e", ["令和7年", "総務委員会", "会議録"])]
    twice = spark.createDataFrame([("u", "目次", 1), ("u", "会議録", 2)], "target string, label string, position int")
    assert [(r["target"], r["label"]) for r in walk.accepted(twice, "label", "target", None, "目次").collect()] == [("u", "会議録")]
    assert not walk.pages_differ(start, start, "url")


def test_cache(spark, tmp_path):
    import json

    (tmp_path / "ab").mkdir()
    for name, key in (("ab12cd34", "u1"), ("ffffffff", "u2")):
        (tmp_path / "ab" / f"{name}.json").write_text(json.dumps({"key": key, "url": key, "status": 200, "header_charset": "utf-8", "encoding": "wrong"}), encoding="utf-8")
    (tmp_path / "ab" / "ab12cd34.body").write_bytes('<meta charset=shift_jis><p class="x">髙木</p>'.encode("cp932"))
    rows = files.read_cache(spark, str(tmp_path))
    assert [r["key"] for r in rows.collect()] == ["u1"]
    assert files.inspect(rows, "body", "p.x").first()["text"] == "髙木" and files.inspect(rows, "body").first()["charset"] == "cp932"
    keys = files.cache_rows(spark.createDataFrame([("a", "b"), ("c", "c"), ("d", None)], "key string, final_url string")).collect()
    assert sorted(r["key"] for r in keys) == ["a", "b", "c", "d"]


def test_windows_as_a_stream(spark, tmp_path):
    rows = [(dt.datetime(2025, 1, 1, 0, 10), "a", 1.0), (dt.datetime(2025, 1, 1, 0, 50), "a", 2.0), (dt.datetime(2025, 1, 1, 5, 0), "b", 3.0)]
    ddl = "ts timestamp, kind string, value double"
    spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(str(tmp_path / "in"))
    counted = incremental.windowed_counts(spark.readStream.schema(ddl).parquet(str(tmp_path / "in")), "ts", "kind", "value", late="10 minutes")
    query = counted.writeStream.format("memory").queryName("counted").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert [(r["kind"], r["n"], r["total"]) for r in spark.sql("select * from counted").collect()] == [("a", 2, 3.0)]


def test_site_rules(spark, tmp_path):
    (tmp_path / "_template.toml").write_text("scraper = 1", encoding="utf-8")
    (tmp_path / "a.toml").write_text('prefecture = "甲県"\nstart_urls = ["https://a.example/"]', encoding="utf-8")
    (tmp_path / "b.toml").write_text('scraper = "other"', encoding="utf-8")
    assert [(r["site"], r["scraper"], r["start_urls"]) for r in files.site_rules(spark, str(tmp_path)).collect()] == [("a", "generic", ["https://a.example/"]), ("b", "other", [])]
    with pytest.raises(ValueError):
        files.site_rules(spark, str(tmp_path), {"generic"})
