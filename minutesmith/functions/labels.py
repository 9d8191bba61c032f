"""First lines of speeches: who speaks and as what, and what of a block is speech. Column expressions on single lines and blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from minutesmith.functions.text import clean_speaker, plain_digits, strip

SIGNS = "○◎◆◯〇●△"
SIGNATURES = "会議録署名議員"
_GAP = r"[　\s]"
#: Shapes of a label, in the order in which they are tried: office and bracketed name; bracketed name alone; bare name with honorific; name, wide
#: space, office. Groups: name, office.
SHAPES = (
    (rf"(?U)^[{SIGNS}]([^（）　\s]{{1,60}}?)（([^（）]{{1,60}})）", 2, 1),
    (rf"(?U)^[{SIGNS}]（([^（）]{{1,40}})）", 1, 0),
    (rf"(?U)^[{SIGNS}]([^（）　\s、。，「」]{{1,20}}?(?:君|さん|氏|議員))(?={_GAP}|$)", 1, 0),
    (rf"(?U)^[{SIGNS}]([^（）　\s、。，「」]{{2,12}})　([^（）　\s、。，「」]{{1,30}})(?=　|$)", 1, 2),
)


def with_label(df: DataFrame, line: str, name: str = "label") -> DataFrame:
    """df with struct<speaker, role, rest> of a speech's first line; speaker '' and the whole line as rest where no shape fits or what fits is no name.

    A chair's office inside the name's bracket, before or behind the name, becomes part of the office; a committee in the name's place takes the
    chair's name out of the office; an office typed twice is taken once; 議員 behind a name goes. Built in steps, each used by the next, so that
    no pattern is evaluated more than once."""
    which = F.lit(-1)
    for i in reversed(range(len(SHAPES))):
        which = F.when(F.col(line).rlike(SHAPES[i][0]), i).otherwise(which)
    out = df.withColumn("_i", which)
    group = lambda g: F.nullif(F.coalesce(*(F.when(F.col("_i") == i, F.regexp_extract(line, s[0], s[g])) for i, s in enumerate(SHAPES) if s[g])), F.lit(""))
    ends = F.coalesce(*(F.when(F.col("_i") == i, F.length(F.regexp_extract(line, s[0], 0))) for i, s in enumerate(SHAPES)), F.lit(0))
    out = out.withColumn("_n", group(1)).withColumn("_o", group(2)).withColumn("_rest", F.substring(F.col(line), ends + 1, F.length(line)))
    before, behind = r"^(.+委員長)([^委]{2,12})$", r"^([^［\[]+)[［\[]([^］\]]+)[］\]]$"
    n, o = F.col("_n"), F.col("_o")
    committee = (F.col("_i") == 3) & F.endswith(n, F.lit("委員会")) & o.rlike("^[^委]{2,12}委員長$")
    twice = F.startswith(n, o) & (F.length(n) - F.length(o) >= 2)
    kind = F.when(committee, "committee").when(n.rlike(before), "before").when(n.rlike(behind), "behind").when(twice, "twice")
    out = out.withColumn("_k", kind)
    k = F.col("_k")
    joined = lambda x: F.when(o.isNull(), x).otherwise(F.concat(o, F.lit("　"), x))
    person = (
        F.when(k == "committee", F.regexp_extract(o, "^([^委]{2,12})委員長$", 1)).when(k == "before", F.regexp_extract(n, before, 2)).when(k == "behind", F.regexp_extract(n, behind, 1))
        .when(k == "twice", F.substring(n, F.length(o) + 1, F.length(n))).otherwise(n)
    )
    role = F.when(k == "committee", F.concat(n, F.lit("委員長"))).when(k == "before", joined(F.regexp_extract(n, before, 1))).when(k == "behind", joined(F.regexp_extract(n, behind, 2))).otherwise(o)
    out = out.withColumn("_role", role).withColumn("_p", person)
    out = out.withColumn("_p", F.regexp_replace(clean_speaker(F.col("_p")), "議員$", "")).withColumn("_p", clean_speaker(F.col("_p")))
    named = F.col("_p").isNotNull() & (F.col("_p") != "") & ~F.col("_p").rlike(r"^[0-9０-９]|[○〇◯]")
    label = F.struct(
        F.when(named, F.col("_p")).otherwise("").alias("speaker"), F.when(named, F.nullif(strip(plain_digits(F.col("_role"))), F.lit(""))).alias("role"), F.when(named, F.col("_rest")).otherwise(F.col(line)).alias("rest")
    )
    return out.withColumn(name, label).drop("_i", "_n", "_o", "_rest", "_k", "_role", "_p")


def _lines(block: Column) -> Column:
    return F.transform(F.split(block, "\n"), strip)


def _before(lines: Column, stop: Column) -> Column:
    """The lines before the first for which stop, an array of booleans, holds."""
    at = F.array_position(stop, True)
    return F.when(at > 0, F.slice(lines, 1, (at - 1).cast("int"))).otherwise(lines)


def speech_body(block: Column) -> Column:
    """The words of a block: up to the signatures, without blank lines and lines of strokes."""
    lines = _lines(block)
    kept = _before(lines, F.transform(lines, lambda x: F.regexp_replace(x, "　", "") == SIGNATURES))
    return F.array_join(F.filter(kept, lambda x: (x != "") & ~x.rlike(r"^[─━―\-‐ー\s　・]+$")), "\n")


def cut_at_rule(block: Column) -> Column:
    """struct<body, cut>: a block up to its first rule, and whether there was one."""
    lines = _lines(block)
    rules = F.transform(lines, lambda x: x.rlike(r"^[─━―ー\-=＝_]{3,}$"))
    return F.struct(F.array_join(F.filter(_before(lines, rules), lambda x: x != ""), "\n").alias("body"), F.array_contains(rules, True).alias("cut"))


def from_first_label(block: Column) -> Column:
    """A block without the clerk's heading before its first label; a block without label, or with a rule before it, is left alone."""
    lines = F.split(block, "\n")
    labels = F.transform(lines, lambda x: x.rlike(f"^[{SIGNS}]"))
    rules = F.transform(lines, lambda x: x.rlike(r"^[\s　]*[─━―ー\-=＝_]{3,}[\s　]*$"))
    label, rule = F.array_position(labels, True), F.array_position(rules, True)
    return F.when((label > 1) & ((rule == 0) | (rule > label)), F.array_join(F.slice(lines, label.cast("int"), F.size(lines)), "\n")).otherwise(block)


def without_echo(body: Column, title: Column) -> Column:
    """A body without the label line that repeats its title; every other body keeps each character but the tags around it."""
    plain = strip(F.regexp_replace(body, "(?i)</?pre>", ""))
    # The title may itself begin with a sign or white space.
    lead = rf"(?U)^[{SIGNS}\s]+"
    head = F.regexp_replace(plain, lead, "")
    own = strip(F.regexp_replace(title, lead, ""))
    return F.when((own != "") & F.startswith(head, own), strip(F.substring(head, F.length(own) + 1, F.length(head)))).otherwise(plain)


def resolved_date(listed: Column, printed: Column) -> Column:
    """struct<date, source, disagrees>: the listing's date, else the printed one."""
    return F.struct(
        F.coalesce(listed, printed).alias("date"), F.when(listed.isNotNull(), "listing").when(printed.isNotNull(), "printed").otherwise("missing").alias("source"), F.coalesce(listed != printed, F.lit(False)).alias("disagrees")
    )


def anchored_blocks(page: Column, anchor: str = r"(?i)<a\s+name=\"?(HUID[0-9]+)\"?[^>]*>") -> Column:
    """array<struct<id, text>> of the parts of a page between a vendor's anchors: breaks as line feeds, tags and scripts gone."""
    marked = F.regexp_replace(F.regexp_replace(page, "\x01|\x02", " "), anchor, "\x01$1\x02")
    plain = lambda t: F.regexp_replace(F.regexp_replace(F.regexp_replace(t, r"(?is)<script.*?</script>|<script.*$", ""), r"(?i)<br\s*/?>", "\n"), "<[^>]+>", "")
    return F.transform(F.slice(F.split(marked, "\x01"), 2, 1_000_000_000), lambda s: F.struct(F.substring_index(s, "\x02", 1).alias("id"), plain(F.substring_index(s, "\x02", -1)).alias("text")))
