import datetime as dt
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from minutesmith.functions import bytes as by
from minutesmith.functions import dates, patterns, policy, text


def one(spark, column, **values):
    names = {str: "string", int: "int", bytes: "binary", dt.datetime: "timestamp", list: "array<string>"}
    ddl = ", ".join(f"{k} {names[type(v)] if v is not None else 'string'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], ddl).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("value", "date"),
    [
        ("令和7年6月10日", dt.date(2025, 6, 10)), ("令和元年5月1日", dt.date(2019, 5, 1)), ("昭和64年1月7日", dt.date(1989, 1, 7)), ("R7.6.10", dt.date(2025, 6, 10)), ("2025-06-10", dt.date(2025, 6, 10)),
        ("", None), ("第2回定例会", None), ("令和7年13月45日", None), ("平成十二年十二月八日", dt.date(2000, 12, 8)), ("06/23/2025", dt.date(2025, 6, 23)), ("23/06/2025", None),
        ("議案1234 令和6年12月3日", dt.date(2024, 12, 3)), ("令和7年6月10日（06/10/2025）", dt.date(2025, 6, 10)), ("令和６年６月19日（水曜日）", dt.date(2024, 6, 19)), ("令和元年五月一日", None), ("平成三十年十三月一日 2018-02-03", dt.date(2018, 2, 3)),
        ("令和7年13月45日 2018-02-03", None), (None, None),
    ],
)
def test_japanese_date(spark, value, date):
    expected = dt.date(2019, 5, 1) if value == "令和元年五月一日" else date
    assert one(spark, dates.japanese_date(F.col("v")), v=value) == expected


@pytest.mark.parametrize(("value", "number"), [("十", 10), ("二十八", 28), ("二〇二五", 2025), ("十二", 12), ("九", 9), ("x", None)])
def test_kanji_number(spark, value, number):
    assert one(spark, dates.kanji_number(F.col("v")), v=value) == number


def test_file_date(spark):
    assert one(spark, dates.file_date(F.col("v")), v="R070303A") == dt.date(2025, 3, 3)
    assert one(spark, dates.file_date(F.col("v")), v="H999999") is None


@pytest.mark.parametrize(
    ("a", "b"), [("渡山　治", "渡山治"), ("尾﨑一郎", "尾崎一郎"), ("鈴本（澄）委員", "鈴本(澄)委員"), ("髙橋", "高橋")]
)
def test_normal_speaker(spark, a, b):
    assert one(spark, text.normal_speaker(F.col("v")), v=a) == one(spark, text.normal_speaker(F.col("v")), v=b)


@pytest.mark.parametrize(("value", "clean"), [("山田　一君君", "山田一"), ("山田清氏君", "山田清氏"), (" 山田さん ", "山田"), ("", ""), (None, None)])
def test_clean_speaker(spark, value, clean):
    assert one(spark, text.clean_speaker(F.col("v")), v=value) == clean


def test_listing_year_rolls(spark):
    row = spark.sql("select 2024 a, 2024 b, 12 c, 1 d, 1982 e")
    assert row.select(dates.listing_year(F.col("a"), F.col("b"), F.col("c"), F.col("d"))).first()[0] == 2025
    assert row.select(dates.listing_year(F.lit(2045), F.col("e"), F.lit(3), F.lit(3))).first()[0] == 1982


def test_window_wraps(spark):
    w = policy.FetchWindow(days=(5, 6), start=20 * 60, end=7 * 60, zone="UTC")
    at = lambda s: one(spark, w.allows(F.col("t")), t=dt.datetime.fromisoformat(s))
    assert at("2025-06-08T23:00:00") and at("2025-06-09T01:00:00") and not at("2025-06-09T21:00:00") and not at("2025-06-07T07:00:00")
    with pytest.raises(ValueError):
        policy.FetchWindow(days=(), start=0, end=0)


def test_throttle_is_the_loop(spark):
    random.seed(3)
    arrivals = sorted(random.randint(0, 50) for _ in range(40))
    rows = [("h", i, a) for i, a in enumerate(arrivals)]
    found = {r["i"]: r["start_at"] for r in policy.throttled(spark.createDataFrame(rows, "h string, i int, a int"), "h", ["a", "i"], "a", F.lit(3)).collect()}
    last = -(10**9)
    for _, i, a in rows:
        last = max(a, last + 3)
        assert found[i] == last


def test_split_speeches(spark):
    marker = r"(?xm)^○ (?: (?P<role_a>[^（\n]*) （ (?P<speaker_a>[^）\n]+) 君 ） | (?P<speaker_b>[一-龥]{2,4}) 委員 ) [ 　]*  # a marker"
    body = "前文\n○議長（山田一君）　開きます。\n○田中委員　はい。\n○議長（山田一君）　\n○鈴木委員　以上。"
    found = one(spark, patterns.split_speeches(F.col("v"), marker, "以上|はい"), v=body)
    assert [(r["order"], r["speaker"], r["role"], r["text"]) for r in found] == [(0, "山田一", "議長", "開きます。"), (1, "田中", None, "はい。"), (2, "鈴木", None, "以上。")]


def test_patterns_compile():
    assert patterns.to_java(r"(?P<role_a>a)(?P=role_a)") == r"(?Ud)(?<roleA>a)\k<roleA>"


@given(st.integers(1, 99))
@settings(max_examples=20, deadline=None)
def test_kanji_numbers_round_trip(spark, n):
    digits = "〇一二三四五六七八九"
    tens, units = divmod(n, 10)
    written = (("" if tens == 1 else digits[tens]) + "十" if tens else "") + (digits[units] if units else "")
    assert one(spark, dates.kanji_number(F.col("v")), v=written) == n


def test_charset_prefers_the_page(spark):
    body = '<meta charset="Shift_JIS">髙﨑'.encode("cp932")
    assert by.charset(body, "utf-8") == "cp932"
    assert by.charset("日本".encode(), None) == "utf-8"
    assert by.charset("日本語です".encode("euc_jp"), "euc-jp") == "euc-jp"


def test_ordered_text(spark):
    assert one(spark, by.ordered_text(F.col("b")), b="議長\r\n".encode("cp932")) == "議長\n"


def test_rtf():
    assert by.rtf_text(b"{\\rtf1{\\fonttbl x}\\'93\\'fa\\u26412?\\par o k}") == "日本\no k"
    assert by.rtf_text(b"{\\rtf1\\ansi\\ansicpg1252 caf\\'e9\\tab x\\par}") == "café\tx\n"
    assert by.rtf_text(b"{\\rtf1\\uc2 \\u12354\\'82\\'a0\\u12356ab{\\uc0\\u12358 c}}") == "あいうc"
    assert by.rtf_text(b"{\\rtf1{\\*\\x y}\\u-10179?\\u-8704?\\{\\'93\r\n\\'fa}") == "😀{日" and by.rtf_text(b"") == ""


def test_html():
    page = '<div id=a><p>one<p class="x y">two<br>three</div><div class=x>no</div><a href="/u">link &amp; more</a><script>"</p>"</script>'
    root = by.parse_html(page)
    assert [e.text() for e in by.select(root, "#a p")] == ["one", "two\nthree"]
    assert by.select(root, "a[href^='/']")[0].text() == "link & more"
    assert [e.text() for e in by.select(root, ".y, .x")] == ["two\nthree", "no"]


def test_html_of_any_depth(spark):
    page = "".join(f'<frame src="f{i}">' for i in range(3000)) + "".join(f'<p><b onclick="open(\'c{i}\')">x{i}' for i in range(3000)) + "<i>end</i>"
    found = one(spark, by.html_targets(F.col("v")), v=page)
    assert [tuple(r) for r in found] == [("frame", f"f{i}") for i in range(3000)] + [("script", f"c{i}") for i in range(3000)]
    assert by.parse_html(page).text().split("\n")[-1] == "x2999end"
    assert by.parse_html('<frameset><frame src="a"><frame src="b"></frameset><p>after</p>').children[1].text() == "after"


def test_html_speeches(spark):
    page = '<div id=h><div class=s><span class=w>甲</span><p>言う</p></div><div class=s><span class=w>乙</span><p></p></div><div class=s><p>三</p></div></div>'
    found = one(spark, by.html_speeches(F.col("v"), "#h", ".s", ".w", "", "p"), v=page)
    assert [(r["order"], r["speaker"], r["text"]) for r in found] == [(0, "甲", "言う"), (2, "", "三")]
