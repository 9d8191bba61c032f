"""Japanese calendar dates and the rules that give a sitting its date, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from minutesmith.functions.text import plain_digits

#: Year before the first year of each era. Fixed values.
ERAS = {"令和": 2018, "平成": 1988, "昭和": 1925, "大正": 1911, "明治": 1867, "R": 2018, "H": 1988, "S": 1925}
#: Forms of a date. Fixed values.
_NAMES, _KANJI = "令和|平成|昭和|大正|明治", "〇零一二三四五六七八九十"
ERA_FORM = rf"({_NAMES}|[RHS])\s*(元|[0-9]{{1,2}})\s*年\s*([0-9]{{1,2}})\s*月\s*([0-9]{{1,2}})\s*日"
KANJI_FORM = rf"({_NAMES})\s*(元|[{_KANJI}]{{1,4}})\s*年\s*([{_KANJI}]{{1,3}})\s*月\s*([{_KANJI}]{{1,3}})\s*日"
LETTER_FORM = r"([RHS])\s*([0-9]{1,2})[./-]([0-9]{1,2})[./-]([0-9]{1,2})"
WESTERN_FORM = r"([0-9]{4})\s*[年./-]\s*([0-9]{1,2})\s*[月./-]\s*([0-9]{1,2})\s*日?"
MONTH_FIRST_FORM = r"\b([0-9]{1,2})/([0-9]{1,2})/([0-9]{4})\b"


def era_base(name: Column) -> Column:
    """Year before an era's first; NULL for what is no era."""
    found = F.lit(None).cast("int")
    for era, base in ERAS.items():
        found = F.when(name == era, base).otherwise(found)
    return found


def kanji_number(text: Column) -> Column:
    """A number from 1 to 99 with 十, or a string of kanji digits; NULL if it is neither."""
    digits = F.translate(text, "〇零一二三四五六七八九", "00123456789")
    tens, units = F.substring_index(digits, "十", 1), F.substring_index(digits, "十", -1)
    ten = lambda x, empty: F.when(x == "", empty).otherwise(x.try_cast("int"))
    return F.when(F.instr(text, "十") > 0, ten(tens, 1) * 10 + ten(units, 0)).otherwise(digits.try_cast("int"))


def safe_date(year: Column, month: Column, day: Column) -> Column:
    """The date, or NULL where there is no such day."""
    return F.to_date(F.try_make_timestamp(year, month, day, F.lit(0), F.lit(0), F.lit(0)))


def japanese_date(text: Column) -> Column:
    """The first date in a text. The first form that occurs decides, even where its day does not exist, except that a kanji
    date that does not exist leaves the choice to the later forms. Forms: era, era in kanji, letter, western, month first."""
    plain = plain_digits(text)
    part = lambda form, i: F.regexp_extract(plain, "(?U)" + form, i)
    number = lambda form, i: part(form, i).try_cast("int")
    has = lambda form: plain.rlike("(?U)" + form)
    year = lambda x: F.when(x == "元", 1).otherwise(x.try_cast("int"))
    era = safe_date(era_base(part(ERA_FORM, 1)) + year(part(ERA_FORM, 2)), number(ERA_FORM, 3), number(ERA_FORM, 4))
    kanji_year = F.when(part(KANJI_FORM, 2) == "元", 1).otherwise(kanji_number(part(KANJI_FORM, 2)))
    kanji = safe_date(era_base(part(KANJI_FORM, 1)) + kanji_year, kanji_number(part(KANJI_FORM, 3)), kanji_number(part(KANJI_FORM, 4)))
    letter = safe_date(era_base(part(LETTER_FORM, 1)) + number(LETTER_FORM, 2), number(LETTER_FORM, 3), number(LETTER_FORM, 4))
    western = safe_date(number(WESTERN_FORM, 1), number(WESTERN_FORM, 2), number(WESTERN_FORM, 3))
    month_first = safe_date(number(MONTH_FIRST_FORM, 3), number(MONTH_FIRST_FORM, 1), number(MONTH_FIRST_FORM, 2))
    later = F.when(has(LETTER_FORM), letter).when(has(WESTERN_FORM), western).when(has(MONTH_FIRST_FORM), month_first)
    return F.when(has(ERA_FORM), era).when(has(KANJI_FORM) & kanji.isNotNull(), kanji).otherwise(later)


def file_date(name: Column) -> Column:
    """The date a file name opens with: an era letter and six digits."""
    form = "^([RHS])([0-9]{2})([0-9]{2})([0-9]{2})"
    part = lambda i: F.regexp_extract(name, form, i)
    return safe_date(era_base(part(1)) + part(2).try_cast("int"), part(3).try_cast("int"), part(4).try_cast("int"))


def listing_year(council_year: Column, node_year: Column, council_month: Column, label_month: Column) -> Column:
    """The year of a listed sitting: that of the council's name unless it is more than one from the list's; the next year where
    a council of the end of a year lists a sitting of its beginning."""
    named = F.when(council_year.isNull() | (F.abs(council_year - node_year) > 1), node_year).otherwise(council_year)
    return named + F.when((council_month >= 11) & (label_month <= 4), 1).otherwise(0)


def sitting_year(session_year: Column, session_month: Column, label_month: Column, page_year: Column) -> Column:
    """The year of a sitting of a session: the next one if its month comes before the session's; that of the page without a session month."""
    return F.when(session_month.isNull(), page_year).otherwise(session_year + F.when(label_month < session_month, 1).otherwise(0))


def within_session(month: Column, session_month: Column, months: int = 2) -> Column:
    """Whether a month lies in the session that began in session_month."""
    return F.pmod(month - session_month, F.lit(12)) <= months


def in_range(date: Column, since: str | None, until: str | None) -> Column:
    """Inclusive date filter that undated rows pass."""
    keep = F.lit(True)
    if since is not None:
        keep = keep & (date >= F.lit(since).cast("date"))
    if until is not None:
        keep = keep & (date <= F.lit(until).cast("date"))
    return date.isNull() | keep


def by_era(label: Column) -> list[Column]:
    """Order of labels that begin with an era and its year or with a western year, the latest first; labels without a year last."""
    form = rf"(?:({_NAMES})\s*(元|[0-9]+)|([0-9]{{4}}))\s*年"
    part = lambda i: F.regexp_extract(plain_digits(label), form, i)
    own = F.when(part(2) == "元", 1).otherwise(part(2).try_cast("int"))
    year = F.coalesce(part(3).try_cast("int"), era_base(part(1)) + own)
    # Of the two labels of a year in which the era changes, that of the later era comes first.
    return [year.desc_nulls_last(), F.coalesce(era_base(part(1)), year).desc(), label.asc()]


#: A date with its weekday behind it, as headings print it. Fixed value.
HEADING_FORM = r"((?:令和|平成|昭和)(?:元|[0-9]{1,3})年\s*[0-9]{1,2}月\s*[0-9]{1,2}日)\s*（[日月火水木金土]"


def dated_heading(text: Column, label: Column, reach: int = 400) -> Column:
    """struct<date, from_label, differs> of a sitting: the first date with a weekday in the first `reach` characters; else the year of the heading
    with the month and day of the list's label, and from_label says so. differs: the label names another day than the heading."""
    head = plain_digits(F.substring(text, 1, reach))
    printed = japanese_date(F.nullif(F.regexp_extract(head, HEADING_FORM, 1), F.lit("")))
    own = lambda i: F.regexp_extract(head, rf"({_NAMES})\s*(元|[0-9]{{1,3}})\s*年", i)
    year = era_base(own(1)) + F.when(own(2) == "元", 1).otherwise(own(2).try_cast("int"))
    part = lambda i: F.regexp_extract(plain_digits(label), r"([0-9]{1,2})\s*月\s*([0-9]{1,2})\s*日", i).try_cast("int")
    completed = safe_date(year, part(1), part(2))
    # Bound once, for the expressions of a date are long.
    found = F.array(F.struct(printed.alias("printed"), completed.alias("completed"), part(1).alias("m"), part(2).alias("d")))
    result = F.transform(
        found,
        lambda x: F.struct(
            F.coalesce(x["printed"], x["completed"]).alias("date"), (x["printed"].isNull() & x["completed"].isNotNull()).alias("from_label"),
            F.coalesce((F.month(x["printed"]) != x["m"]) | (F.dayofmonth(x["printed"]) != x["d"]), F.lit(False)).alias("differs"),
        ),
    )
    return F.element_at(result, 1)
