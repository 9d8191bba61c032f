"""Text columns: spaces, digits, names, session names, paths and addresses. JVM expressions unless said otherwise."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Old forms in names and what they are today. Results must agree on them.
OLD_FORMS = "﨑嵜髙澤濱濵邉邊齋齊眞德廣榮藏龍惠圓學國瀧瀨栁淺萬與壽實兒顯讀讓禮曉黑奧臺攝擴爲隨對巖桒曾覺條團氣壯釋藪嶌嶋冨\ue002"
NEW_FORMS = "崎崎高沢浜浜辺辺斎斉真徳広栄蔵竜恵円学国滝瀬柳浅万与寿実児顕読譲礼暁黒奥台摂拡為随対巌桑曽覚条団気壮釈薮島島富隆"
FULL_DIGITS, DIGITS = "０１２３４５６７８９", "0123456789"
#: Characters that NFKC may change; values without one need no Python.
_COMPATIBLE = r"[^\x00-\x7F぀-ヿ一-鿿、。「」]|[\u3099-゜]"


def nfkc(text: Column) -> Column:
    """NFKC of a column. Spark has no such expression: values that it may change pass through one Arrow function."""
    fold = F.pandas_udf(lambda s: s.map(lambda v: unicodedata.normalize("NFKC", v) if v is not None else None), "string")
    return F.when(text.rlike(_COMPATIBLE), fold(F.when(text.rlike(_COMPATIBLE), text))).otherwise(text)


def strip(text: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def squash(text: Column) -> Column:
    """NFKC, all white space removed."""
    return F.regexp_replace(nfkc(text), r"(?U)\s+", "")


def plain_digits(text: Column) -> Column:
    return F.translate(text, FULL_DIGITS, DIGITS)


def modern_forms(text: Column) -> Column:
    return F.translate(text, OLD_FORMS, NEW_FORMS)


def normal_speaker(name: Column) -> Column:
    """One spelling of a name: today's characters, NFKC, no spaces. NULL stays NULL."""
    return F.replace(nfkc(modern_forms(name)), F.lit(" "), F.lit(""))


def clean_speaker(name: Column) -> Column:
    """normal_speaker without a closing honorific, repeated or not; a different honorific before it is part of the name."""
    return normal_speaker(F.regexp_replace(strip(name), r"(?U)\s*(君|さん|氏)(?:\s*\1)*$", ""))


def slug(text: Column) -> Column:
    """Letters, digits, - and _ of a name; 'unknown' if none."""
    return F.coalesce(F.nullif(F.regexp_replace(text, r"[^\p{L}\p{N}_-]", ""), F.lit("")), F.lit("unknown"))


def record_key(url: Column, source_file: Column) -> Column:
    """The identity of a record: its address, else its file."""
    return F.coalesce(url, F.concat(F.lit("file:"), source_file))


def url_shape(url: Column) -> Column:
    """An address with every run of digits as N."""
    return F.regexp_replace(url, "[0-9]+", "N")


def url_host(url: Column) -> Column:
    return F.regexp_extract(url, "^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)


def without_scheme(url: Column) -> Column:
    return F.regexp_replace(url, "^[a-zA-Z][a-zA-Z0-9+.-]*://", "")


def first_group(text: Column, pattern: str, groups: int) -> Column:
    """Group 1 of the first match, or the whole match where the pattern has no group; '' if there is none."""
    return F.regexp_extract(text, pattern, 1 if groups else 0)


def wanted(label: Column, url: Column, include: str | None, exclude: str | None) -> Column:
    """Whether a link is to be followed: exclusion wins; either pattern may match the label or the address."""
    either = lambda p: F.coalesce(label.rlike(p), F.lit(False)) | F.coalesce(url.rlike(p), F.lit(False))
    keep = F.lit(True) if include is None else either(include)
    return keep if exclude is None else keep & ~either(exclude)


def text_digest(text: Column) -> Column:
    return F.sha2(text, 256)


def pandas_text(f, kind: str = "string"):  # noqa: ANN001, ANN201
    """An Arrow function over one string column that leaves NULL alone."""
    return F.pandas_udf(lambda s: pd.Series([None if v is None else f(v) for v in s], dtype=object), kind)
