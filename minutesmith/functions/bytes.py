"""Bytes to text: charset by evidence, decoding in order of strictness, RTF, HTML. Arrow functions, for Spark has none of these."""

from __future__ import annotations

import codecs
import html
import re
from html.parser import HTMLParser
from itertools import groupby

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Names of one family: the vendor's superset reads what the standard cannot.
_SHIFT_JIS = re.compile(r"^(?:shift[-_]?jis|sjis|x-sjis|ms_kanji|windows-31j|cp932)$", re.I)
_META = re.compile(rb"<meta[^>]+charset=[\"']?\s*([A-Za-z0-9_-]+)", re.I)
SNIFFED = 4096


def charset(body: bytes, header: str | None = None) -> str:
    """The charset of a page: its own statement, the header's, a guess; the first that decodes it."""
    stated = _META.search(body[:SNIFFED])
    named = [stated[1].decode("ascii")] if stated else []
    named += [header] if header else []
    for name in (*named, "utf-8", "cp932", "euc_jp"):
        codec = "cp932" if _SHIFT_JIS.match(name) else name
        try:
            body.decode(codec)
        except (LookupError, UnicodeDecodeError):
            continue
        return codec.lower()
    return "utf-8"


def page_text(body: Column, header: Column) -> Column:
    """struct<charset, text> of pages; the charset is found anew each time and never stored."""

    def f(b: pd.Series, h: pd.Series) -> pd.DataFrame:
        names = [charset(bytes(x), y if isinstance(y, str) else None) if x is not None else None for x, y in zip(b, h, strict=True)]
        return pd.DataFrame({"charset": names, "text": [bytes(x).decode(n, "replace") if n else None for x, n in zip(b, names, strict=True)]})

    return F.pandas_udf(f, "charset string, text string")(body, header)


def ordered_text(body: Column) -> Column:
    """Delivered text: UTF-8, else cp932, else EUC-JP, strictly; NULL if none reads it. Line ends become line feeds."""

    def one(b: object) -> str | None:
        for codec in ("utf-8-sig", "cp932", "euc_jp"):
            try:
                return bytes(b).decode(codec).replace("\r\n", "\n")  # type: ignore[call-overload]
            except UnicodeDecodeError:
                continue
        return None

    return F.pandas_udf(lambda s: pd.Series([None if v is None else one(v) for v in s], dtype=object), "string")(body)


def encoded(text: Column, codec: str) -> Column:
    """Bytes of a text in a codec; what it cannot write becomes a question mark."""
    return F.pandas_udf(lambda s: pd.Series([None if v is None else v.encode(codec, "replace") for v in s], dtype=object), "binary")(text)


def decoded(body: Column, codec: str) -> Column:
    """Bytes read in a stated codec; what it cannot read becomes a replacement character."""
    return F.pandas_udf(lambda s: pd.Series([None if v is None else bytes(v).decode(codec, "replace") for v in s], dtype=object), "string")(body)


def without_page_marks(text: Column) -> Column:
    """text without marks of printed pages, its line ends as line feeds."""
    return F.regexp_replace(F.regexp_replace(text, r"\r\n?", "\n"), r'(?i)<PAGE="?[0-9]+"?>', "")


#: Groups of an RTF document that hold no text, and words that stand for characters. Fixed values.
RTF_SILENT = frozenset("fonttbl colortbl stylesheet info pict header footer generator themedata datastore".split())
RTF_SIGNS = {"par": "\n", "line": "\n", "tab": "\t", "emdash": "—", "endash": "–", "bullet": "•", "lquote": "‘", "rquote": "’", "ldblquote": "“", "rdblquote": "”", "~": "\xa0", "\\": "\\", "{": "{", "}": "}"}
_RTF = re.compile(rb"(?P<open>\{)|(?P<close>\})|\\'(?P<hex>[0-9a-fA-F]{2})|\\(?P<word>[a-zA-Z]+)(?P<value>-?\d+)? ?|\\(?P<sign>[^a-zA-Z'])|(?P<break>[\r\n]+)|(?P<plain>[^\\{}\r\n]+)", re.S)
_CODEPAGE = re.compile(rb"\\ansicpg(\d+)")


def _codepage(body: bytes, codec: str) -> str:
    """The codec that a document states, if there is one of that name; else the one given."""
    stated = _CODEPAGE.search(body)
    try:
        return codecs.lookup(f"cp{int(stated[1])}").name if stated else codec
    except LookupError:
        return codec


def rtf_text(body: bytes, codec: str = "cp932") -> str:
    """The text of an RTF document in the code page it states, else in codec. Groups that hold no text are passed over; behind a code point
    as many bytes or letters as \\uc says stand in for it and are dropped."""
    codec = _codepage(body, codec)
    chunks: list[str | bytes] = []  # text, and single bytes that only make sense together
    groups = [{"silent": False, "stand_ins": 1}]
    owed = 0  # stand-ins still to be dropped
    for m in _RTF.finditer(body):
        kind, found = m.lastgroup, m.group
        if kind == "open":
            groups.append(dict(groups[-1]))
            owed = 0
        elif kind == "close":
            owed = 0
            if len(groups) > 1:
                groups.pop()
        elif found("sign") == b"*" or (found("word") or b"").decode() in RTF_SILENT:
            groups[-1]["silent"] = True
        elif groups[-1]["silent"] or kind == "break":
            continue
        elif found("hex"):
            if owed:
                owed -= 1
            else:
                chunks.append(bytes.fromhex(found("hex").decode()))
        elif found("plain"):
            chunks.append(found("plain")[owed:])
            owed = max(0, owed - len(found("plain")))
        elif found("word") == b"uc":
            groups[-1]["stand_ins"] = int(found("value") or 1)
        elif found("word") == b"u" and found("value"):
            chunks.append(chr(int(found("value")) % 65536))
            owed = groups[-1]["stand_ins"]
        else:
            chunks.append(RTF_SIGNS.get((found("word") or found("sign")).decode("latin-1"), ""))
    text = "".join(b"".join(run).decode(codec, "replace") if raw else "".join(run) for raw, run in groupby((c for c in chunks if c), key=lambda c: isinstance(c, bytes)))
    # Code points beyond the basic plane come as two.
    return text.replace("\u2028", "\n").encode("utf-16", "surrogatepass").decode("utf-16", "replace")


def rtf(body: Column) -> Column:
    return F.pandas_udf(lambda s: pd.Series([None if v is None else rtf_text(bytes(v)) for v in s], dtype=object), "string")(body)


_VOID = frozenset("area base br col embed frame hr img input link meta source track wbr".split())
_BREAKS = frozenset("p div li tr br h1 h2 h3 h4 h5 h6 dt dd section article table ul ol".split())


class Element:
    """A node of a parsed page."""

    __slots__ = ("attrs", "children", "parent", "tag")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Element | None) -> None:
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []

    def walk(self):  # noqa: ANN201
        # A stack of its own, for unclosed tags nest as deep as the page is long.
        ahead = [c for c in reversed(self.children) if isinstance(c, Element)]
        while ahead:
            yield (e := ahead.pop())
            ahead += [c for c in reversed(e.children) if isinstance(c, Element)]

    def text(self) -> str:
        parts: list[str] = []
        ahead = self.children[::-1]
        while ahead:
            c = ahead.pop()
            if isinstance(c, str):
                parts.append(c)
            elif c.tag not in ("script", "style"):
                if c.tag in _BREAKS:
                    parts.append("\n")
                ahead += reversed(c.children)
        lines = (re.sub(r"[ \t\r\f\v]+", " ", x).strip() for x in "".join(parts).split("\n"))
        return "\n".join(x for x in lines if x)


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Element("", {}, None)
        self.at = self.root

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in ("p", "li", "tr", "td", "option", "dt", "dd") and self.at.tag == tag:  # an unclosed one before it
            self.at = self.at.parent or self.root
        e = Element(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(e)
        if tag not in _VOID:
            self.at = e

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.at.children.append(Element(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag: str) -> None:
        e: Element | None = self.at
        while e is not None and e.tag != tag:
            e = e.parent
        if e is not None and e.parent is not None:
            self.at = e.parent

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def parse_html(page: str) -> Element:
    builder = _Builder()
    builder.feed(page)
    builder.close()
    return builder.root


_SIMPLE = re.compile(r"([a-zA-Z][\w-]*|\*)?((?:[#.][\w-]+|\[[^\]]+\])*)")


def select(root: Element, selector: str) -> list[Element]:
    """Elements of a selector of tags, .class, #id, [attr], [attr=v], [attr*=v], [attr^=v], descendants and commas."""
    found: dict[Element, None] = {}
    for alternative in selector.split(","):
        level = [root]
        for step in alternative.split():
            m = _SIMPLE.fullmatch(step)
            if not m:
                raise ValueError(f"no such selector: {step}")
            level = list(dict.fromkeys(e for base in level for e in base.walk() if _fits(e, m[1], m[2])))
        found |= dict.fromkeys(level)
    return list(found)


def _fits(e: Element, tag: str | None, rest: str) -> bool:
    if tag and tag != "*" and e.tag != tag.lower():
        return False
    for part in re.findall(r"[#.][\w-]+|\[[^\]]+\]", rest):
        if part[0] == "#" and e.attrs.get("id") != part[1:]:
            return False
        if part[0] == "." and part[1:] not in e.attrs.get("class", "").split():
            return False
        if part[0] == "[":
            m = re.fullmatch(r"\[([\w-]+)(?:([*^$]?=)[\"']?(.*?)[\"']?)?\]", part)
            value = e.attrs.get(m[1]) if m else None
            if m is None or value is None:
                return False
            if m[2] == "=" and value != m[3] or m[2] == "*=" and m[3] not in value or m[2] == "^=" and not value.startswith(m[3]) or m[2] == "$=" and not value.endswith(m[3]):
                return False
    return True


def html_text(page: Column) -> Column:
    return F.pandas_udf(lambda s: pd.Series([None if v is None else parse_html(v).text() for v in s], dtype=object), "string")(page)


def html_links(page: Column) -> Column:
    """array<struct<href, label>> of the links of a page in its order."""

    def f(s: pd.Series) -> pd.Series:
        return s.map(lambda v: [{"href": e.attrs["href"], "label": e.text()} for e in select(parse_html(v), "a[href]")] if v is not None else None)

    return F.pandas_udf(f, "array<struct<href:string,label:string>>")(page)


_OPENED = re.compile(r"""(?:open|location(?:\.href)?\s*=)\W*?['"]([^'"]+)['"]""", re.I)


def html_targets(page: Column) -> Column:
    """array<struct<kind, address>> of what a page leads to, in the order of kinds: frame (of a frameset or inline), link, script (the address
    that a click opens)."""

    def one(v: str) -> list[dict]:
        root = parse_html(v)
        found = [("frame", e.attrs["src"]) for e in select(root, "frame[src],iframe[src]")] + [("link", e.attrs["href"]) for e in select(root, "a[href]")]
        found += [("script", m[1]) for e in select(root, "[onclick]") if (m := _OPENED.search(e.attrs["onclick"]))]
        return [{"kind": k, "address": a} for k, a in found]

    return F.pandas_udf(lambda s: s.map(lambda v: one(v) if v is not None else None), "array<struct<kind:string,address:string>>")(page)


def without_response_header(text: Column, labels: tuple[str, ...] = ("開催日：", "会議名：")) -> Column:
    """text without the labelled lines that every answer repeats at its beginning, and without the empty lines behind them."""
    return F.regexp_replace(text, "^" + "".join(f"(?:{label}[^\\n]*(?:\\n|$))?" for label in labels) + r"[\r\n]*", "")


def html_fields(page: Column, fields: dict[str, tuple[str, str | None]]) -> Column:
    """struct of one array<string> per field: of all elements of a selector the text, or the named attribute ('' where it is missing)."""

    def f(s: pd.Series) -> pd.DataFrame:
        rows = []
        for v in s:
            root = parse_html(v or "")
            rows.append([[e.text() if attr is None else e.attrs.get(attr, "") for e in select(root, chosen)] for chosen, attr in fields.values()])
        return pd.DataFrame(rows, columns=list(fields))

    return F.pandas_udf(f, ", ".join(f"{name} array<string>" for name in fields))(page)


def html_speeches(page: Column, container: str, block: str, speaker: str, role: str, text: str) -> Column:
    """array<struct<order, speaker, role, text>> of the blocks of a container: order is the block's place, blank ones are dropped; without a
    block selector the container is one speech."""

    def one(v: str) -> list[dict]:
        out = []
        for box in select(parse_html(v), container)[:1]:
            blocks = select(box, block) if block else [box]
            for i, b in enumerate(blocks):
                get = lambda sel: (select(b, sel) or [None])[0] if sel else None  # noqa: B023, E731
                who, what, said = get(speaker), get(role), get(text) or b
                if said.text():
                    out.append({"order": i, "speaker": who.text() if who else "", "role": what.text() if what else None, "text": said.text()})
        return out

    return F.pandas_udf(lambda s: s.map(lambda v: one(v) if v is not None else None), "array<struct<order:int,speaker:string,role:string,text:string>>")(page)


def unescape(text: Column) -> Column:
    return F.pandas_udf(lambda s: s.map(lambda v: html.unescape(v) if v is not None else None), "string")(text)
