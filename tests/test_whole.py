"""Reference queries over every speech, against the plain rule one row at a time."""

import hashlib
import re

import pytest

from minutesmith import plans
from minutesmith.functions import labels, text

SPACE = re.compile(r"^\s+|\s+$")


def strip(x):
    return SPACE.sub("", x)


@pytest.fixture(scope="module")
def speeches(spark, data):
    rows = spark.read.parquet(f"{data}/speeches.parquet").orderBy("retrieved_at").collect()
    return {r["speech_id"]: r for r in rows}


def found(spark, data, name):
    return plans.queries()[name](spark, data).collect()


def test_marker_spans(spark, data, speeches):
    marker, wanted = re.compile(r"(?m)^○([^（\n]*)（([^）\n]+?)君）\s*"), []
    for i, r in speeches.items():
        body = f"前書き\n○{r['role'] or ''}（{r['speaker'] or ''}君）　{r['text'] or ''}"
        hits = list(marker.finditer(body))
        spans = [(h, strip(body[h.end() : n])) for h, n in zip(hits, [*(h.start() for h in hits[1:]), len(body)], strict=False)]
        spans = [(h, t) for h, t in spans if t]
        wanted += [(i, k, strip(h[2]), strip(h[1]) or None, t, "verbatim") for k, (h, t) in enumerate(spans)] or [(i, None, None, None, None, None)]
    assert sorted(map(repr, map(tuple, found(spark, data, "marker_spans")))) == sorted(map(repr, wanted))


def test_numbered_blocks(spark, data, speeches):
    names = {}
    for r in speeches.values():
        if r["speaker"] is not None:
            names.setdefault(r["meeting_id"], set()).add(r["speaker"])
    wanted = {(m, k, strip(n)) for m, own in names.items() for k, n in enumerate(sorted(own, key=lambda n: n.encode()), 1)}
    rows = [tuple(r) for r in found(spark, data, "numbered_blocks")]
    assert set(rows) == wanted and len(rows) == len(wanted)


def test_plain_speakers(spark, data, speeches):
    modern = {ord(a): b for a, b in zip(text.OLD_FORMS, text.NEW_FORMS, strict=True)}
    wanted = {i: None if r["speaker"] is None else re.sub("[ 　]", "", r["speaker"].translate(modern)) for i, r in speeches.items()}
    assert {r["speech_id"]: r["speaker"] for r in found(spark, data, "plain_speakers")} == wanted


def test_labels_are_read(spark, data, speeches):
    rows = {r["speech_id"]: r for r in found(spark, data, "labels_read")}
    assert rows.keys() == speeches.keys()
    for i, r in speeches.items():
        name, role, said = r["speaker"] or "", r["role"] or "", (r["text"] or "").split("\n")[0]
        line = (f"○{role}（{name}君）　{said}", f"◆{name}議員　{said}", f"◎{name}　{role}　{said}")[i % 3]
        hits = [h for p, _, _ in labels.SHAPES if (h := re.match(p.replace("(?U)", ""), line))]
        got = rows[i]
        assert got["rest"] == (line[hits[0].end() :] if hits and got["speaker"] else line)
        assert hits or got["speaker"] == ""
        if re.fullmatch("[一-龥]{4}", name) and re.fullmatch("[一-龥]{2,8}", role):
            assert got["speaker"] and (i % 3 == 1 or got["role"] == role)


def test_echoes_are_removed(spark, data, speeches):
    rows = {r["speech_id"]: r["digest"] for r in found(spark, data, "echoes_removed")}
    assert rows == {i: hashlib.sha256(strip(re.sub("(?i)</?pre>", "", r["text"] or "")).encode()).hexdigest() for i, r in speeches.items()}


def test_titles_know_every_name(spark, data):
    offices = {r["name"] for r in spark.read.parquet(f"{data}/canon_values.parquet").where("field = 'role'").collect()}
    index = {(r["council_id"], re.sub("[ 　]", "", r["speaker"])) for r in spark.read.parquet(f"{data}/speaker_index.parquet").where("speaker <> ''").collect()}
    bare = {(c, n) for c, n in index if n and not any(n.endswith(o) for o in offices)}
    rows = found(spark, data, "title_split")
    assert {(r["council_id"], r["title"]) for r in rows} == {x for x in index if x[1]}
    assert {(r["council_id"], r["title"]) for r in rows if r["outcome"] == "name"} == bare
