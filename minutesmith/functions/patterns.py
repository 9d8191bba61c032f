"""Speaker markers kept as data: patterns written for Python's re, run by the JVM, and texts split at their matches."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters that cannot occur in a transcript and so can stand for structure in it.
RECORD, FIELD = "\x01", "\x02"


def to_java(pattern: str) -> str:
    """A Python pattern for Java's engine: its named groups, its Unicode classes and line ends, verbose layout taken out."""
    flags = ""
    lead = re.match(r"\(\?([aiLmsux]+)\)", pattern)
    if lead:
        flags, pattern = lead[1], pattern[lead.end() :]
    if "x" in flags:
        pattern = _compact(pattern)
    java = re.sub(r"\(\?P<(\w+)>", lambda m: f"(?<{_java_name(m[1])}>", pattern)
    java = re.sub(r"\(\?P=(\w+)\)", lambda m: rf"\k<{_java_name(m[1])}>", java)
    return "(?Ud" + "".join(f for f in "ims" if f in flags) + ")" + java


def _java_name(name: str) -> str:
    return re.sub(r"_(\w)", lambda m: m[1].upper(), name.strip("_")).replace("_", "")


def _compact(pattern: str) -> str:
    """Without the white space and comments of verbose mode; what stands in classes or is escaped stays."""
    out, i, inside = [], 0, False
    while i < len(pattern):
        ch = pattern[i]
        if ch == "\\":
            out.append(pattern[i : i + 2])
            i += 2
            continue
        if ch == "[" and not inside:
            inside = True
        elif ch == "]" and inside and out and out[-1] != "[":
            inside = False
        if not inside and ch == "#":
            i = pattern.find("\n", i) if "\n" in pattern[i:] else len(pattern)
            continue
        if inside or not ch.isspace():
            out.append(ch)
        i += 1
    return "".join(out)


def group_names(pattern: str) -> list[str]:
    return [_java_name(n) for n in re.findall(r"\(\?P<(\w+)>", pattern)]


def split_speeches(text: Column, marker: str, summary: str | None = None) -> Column:
    """array<struct<order, speaker, role, text, kind>>: the stretches from each match of marker to the next.

    marker may name groups speaker, speaker2, ... and role, role2, ...; of several branches the one that matched is taken. Text before
    the first match and empty stretches are dropped, orders are dense. Where the matched text also matches summary, kind is summary."""
    names = group_names(marker)
    take = lambda kind: "".join(f"${{{n}}}" for n in names if n.startswith(kind))
    clean = F.translate(text, RECORD + FIELD, "  ")
    marked = F.regexp_replace(clean, to_java(marker), f"{RECORD}{take('speaker')}{FIELD}{take('role')}{FIELD}$0{FIELD}")
    stretches = F.slice(F.split(marked, RECORD), 2, 1_000_000_000)
    trim = lambda c: F.regexp_replace(c, r"(?U)^\s+|\s+$", "")

    def row(s: Column) -> Column:
        parts = F.split(s, FIELD)
        is_summary = F.lit(False) if summary is None else parts[2].rlike(to_java(summary))
        return F.struct(
            trim(parts[0]).alias("speaker"), F.nullif(trim(parts[1]), F.lit("")).alias("role"), trim(F.get(parts, F.lit(3))).alias("text"), F.when(is_summary, "summary").otherwise("verbatim").alias("kind")
        )

    rows = F.filter(F.transform(stretches, row), lambda r: r["text"] != "")
    return F.transform(rows, lambda r, i: F.struct(i.cast("int").alias("order"), r["speaker"].alias("speaker"), r["role"].alias("role"), r["text"].alias("text"), r["kind"].alias("kind")))


def split_blocks(text: Column, start: str = r"(?m)^([0-9]+)[:：]") -> Column:
    """array<struct<number, body>> of the numbered blocks of a text."""
    marked = F.regexp_replace(F.translate(text, RECORD + FIELD, "  "), to_java(start), f"{RECORD}$1{FIELD}")
    return F.transform(F.slice(F.split(marked, RECORD), 2, 1_000_000_000), lambda s: F.struct(F.substring_index(s, FIELD, 1).try_cast("int").alias("number"), F.regexp_replace(F.substring_index(s, FIELD, -1), r"(?U)^\s+|\s+$", "").alias("body")))
