"""Transcripts to clean, ordered speaker turns.

Method: parsing-expression grammars. TRANSCRIPT splits a body into segments of any of its layouts (numbered cues with voice
tags, bracketed or tabulated clocks, clocks after the label, labels alone); ATTENDEES reads who took part; UTTERANCE reads
nested annotations, hesitations and words. The trees are turned into segments, sorted by time, cleaned, and merged into turns.
A label counts only if it names someone present (a semantic predicate of the grammar) or the hall.

Results that are defined: NULL or empty bodies give no turn; a body without any label gives none; a segment of noise or
hesitation only is no turn and does not end one; what the hall says is no turn; a label that fits several people names the
first of them listed; segments without time stay behind the segment before; repeated rows give repeated turns; bodies of
any length are read whole; extra columns are not carried.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame

from minutesmith.llm.peg import Parser, Tree

#: Signs before a label.
MARKS = "○◯〇◎●◆◇▲△▼▽■□★☆"
CLOCK = r"(?:\d{1,2}:)?\d{1,2}:\d{2}(?:[.,]\d{1,3})?"
AFTER = r"[（(](?:\d+時間?)?\d+分(?:\d+秒)?[）)]"
#: Layouts of a transcript. header: everything before the words of a segment; label: decided by the test of that name.
TRANSCRIPT: dict[str, object] = {
    "body": ("seq", r"(?:\ufeff|WEBVTT[^\n]*\n)?\s*", ("many", ("or", "<segment>", "<line>"))),
    "segment": ("seq", "<header>", "<words>"),
    "header": ("or", "<cue>", "<clocked>", "<tabbed>", "<timed>", "<marked>", "<plain>"),
    "cue": ("seq", ("maybe", r"[ \t]*\d+[ \t]*\n"), r"[ \t]*", "<time>", rf"[ \t]*-->[ \t]*{CLOCK}[^\n]*\n", "<voice>"),
    "voice": ("or", ("seq", r"<v[. ]?", "<tagged>", r">[ \t]*"), ("seq", "<label>")),
    "clocked": ("seq", r"[ \t]*[\[(（]", "<time>", r"[\])）][ \t　]*", "<label>"),
    "tabbed": ("seq", r"[ \t]*", "<time>", r"[\t ]+", "<label>"),
    "timed": ("seq", "<name>", "<after>", r"[:：]?[ \t]*\n?"),
    "marked": ("seq", rf"[ \t]*(?=[{MARKS}])", "<label>"),
    "plain": ("seq", r"[ \t]*", "<label>"),
    "time": CLOCK,
    "after": AFTER,
    "name": ("test", "name"),
    "label": ("test", "label"),
    "tagged": r"[^>\n]+",
    "words": ("many", ("or", "<text>", ("seq", r"\n", ("not", "<header>"), ("not", r"[ \t]*\d+[ \t]*\n[ \t]*" + CLOCK)))),
    "text": r"[^\n]+",
    "line": ("or", r"[^\n]*\n", r"[^\n]+"),
}
ATTENDEES: dict[str, object] = {
    "list": ("seq", r"\s*", ("many", ("seq", "<person>", r"[\s;；、,，/／|]*"))),
    "person": ("seq", "<letter>", r"\s*[＝=:：]\s*", "<office>", r"[\s:：]+", "<full>"),
    "letter": r"[A-ZＡ-Ｚa-z]\d?",
    "office": r"[^\s:：;；、,，/／|＝=]+",
    "full": r"(?:(?![A-ZＡ-Ｚ]\d?\s*[＝=:：])[^;；、,，/／|\n])+",
}
#: Annotations may hold annotations; those in round brackets are noise only if they say so.
UTTERANCE: dict[str, object] = {
    "all": ("many", ("or", "<noise>", "<hesitation>", "<kept>")),
    "noise": ("or", r"♪+", "<star>", "<double>", "<square>", ("seq", ("and", "<telling>"), "<round>")),
    "star": r"[*＊][^*＊\n]+[*＊]",
    "double": ("seq", r"\(\(|（（", ("many", ("or", "<noise>", r"(?!\)\)|））)[^\n]")), r"\)\)|））"),
    "square": ("or", *(("seq", a, ("many", ("or", "<noise>", f"(?!{b})[^\\n]")), b) for a, b in ((r"\[", r"\]"), ("［", "］"), ("【", "】"), ("〔", "〕"), ("＜", "＞"), ("<", ">"), ("《", "》"), ("｛", "｝")))),
    "round": ("seq", r"[（(]", ("many", ("or", "<round>", r"[^（()）\n]")), r"[）)]"),
    "telling": r"[（(][^）)\n]*?(?:拍手|笑|発言|呼ぶ者|叫ぶ者|咳|せき|無音|沈黙|雑音|ノイズ|チャイム|ベル|ざわめき|騒然|聴取|聞き取|不明|音声|マイク|電話|物音|退場|入場|着席|起立|頷|うなず|ため息|間$|inaudible|laughter|applause|cough|noise|silence|music|crosstalk)",
    "hesitation": ("seq", r"(?:(?<=^)|(?<=[、。，．！？!?…\s」』）)\]］】〕＞♪*＊>]))(?:え[えぇーっ]*と|えー+|えぇー*|あの[ーう]+|その[ーう]+|う[ーう]*ん|うー+|んー+|ん[、。…]|まあ(?=[、。…])|まぁ(?=[、。…])|あー+|あの(?=[、。…])|その(?=[、。…])|uh+|um+|er+m?|hmm+)", r"[、，…。．ー]*"),
    "kept": r"[^\s、。，．！？!?…」』♪*＊（(\[［【〔＜<《｛）)\]］】〕＞>]+|[^\n]|\n",
}
HALL = re.compile(r"^[（(【]?(?:一同|会場|議場|場内|議場内|傍聴席|全員|複数|多数|聴衆|発言者不明|話者不明|不明|\?+|？+)[）)】]?$")
_TITLES = re.compile(r"(?:君|氏|さん|様|殿|議員|委員)$")
_FIRST = "[^\\n\\t>:：]+"


@dataclass(frozen=True)
class Person:
    letter: str
    office: str
    name: str


def attendees(text: str | None) -> list[Person]:
    """People of an attendance list, in its order."""
    if not text:
        return []
    source = unicodedata.normalize("NFKC", text).replace("\r", "")
    tree = Parser(ATTENDEES, source).rule("list", 0)

    def part(t: Tree, rule: str) -> str:
        found = t.find(rule)
        return re.sub(r"\s+", "", source[found.start : found.end]) if found else ""

    return [Person(part(p, "letter"), part(p, "office"), part(p, "full")) for p in (tree.children if tree else [])]


class Labels:
    """Who a label names among those present."""

    def __init__(self, people: list[Person]) -> None:
        self.people = people
        self.known: dict[str, Person | None] = {}
        # No label that names someone has more signs than the longest office and name together, twice as many before normalisation.
        most = 2 * max((len(p.letter) + len(p.office) + len(p.name) for p in people), default=0) + 32
        self.reach = re.compile(rf"(?:\s*\S){{0,{most}}}\s*")

    def who(self, label: str) -> Person | None:
        """The first of the people present that the label fits."""
        if label not in self.known:
            self.known[label] = self._who(label)
        return self.known[label]

    def _who(self, label: str) -> Person | None:
        text = unicodedata.normalize("NFKC", label).strip()
        text = re.sub(rf"^[{MARKS}【\s]+|[】\s:]+$", "", text)
        bare = re.sub(r"[\s・()]+", " ", text).strip()
        if not bare:
            return None
        for p in self.people:
            if bare == p.letter:
                return p
        parts = [q for w in bare.split() for q in (w, _TITLES.sub("", w)) if q]
        joined = "".join(bare.split())
        candidates = {joined, _TITLES.sub("", joined)}
        best: tuple[int, Person] | None = None
        for p in self.people:
            score = 0
            if p.name in candidates:
                score = 100
            elif p.office in candidates:
                score = 50
            else:
                for c in candidates:
                    rest = c.replace(p.office, "", 1) if p.office and p.office in c else None
                    if rest is not None and len(rest) > 0 and (p.name.startswith(rest) or p.name.startswith(_TITLES.sub("", rest)) or _TITLES.sub("", rest) == p.name):
                        score = max(score, 90 + len(rest))
                    if len(c) >= 1 and len(c) < len(p.name) and p.name.startswith(c):
                        score = max(score, 10 + len(c))
                if len(parts) >= 2 and p.name == "".join(dict.fromkeys(parts)):
                    score = max(score, 100)
            if score and (best is None or score > best[0]):
                best = (score, p)
        return best[1] if best else None

    def names(self, label: str) -> bool:
        return bool(HALL.match(label.strip())) or self.who(label) is not None

    # The two tests of TRANSCRIPT.
    def label(self, text: str, at: int) -> int:
        """A label with the mark that ends it: the longest one that names someone."""
        line_end = text.find("\n", at)
        line = text[at : line_end if line_end >= 0 else len(text)]
        begin = self.reach.match(line).group()
        for end in [m.end() for m in re.finditer(r"[:：]\s?|[\t　 】]|(?<=[）)])(?=[^（(])", begin)][::-1]:
            head = re.sub(r"[:：\t　 ]+$", "", line[:end])
            marked = head[:1] in MARKS + "【" or re.search(r"[:：\t]\s?$", line[:end]) or at and text[at - 1] in "]\t ) ）"
            if head and marked and self.names(head) and (line[end : end + 1] != "（" or not re.match(AFTER, line[end:])):
                return at + end
        return -1

    def name(self, text: str, at: int) -> int:
        """A label before a clock in brackets at the end of a line."""
        m = re.compile(rf"{_FIRST}?(?={AFTER}[:：]?[ \t]*(?:\n|$))").match(text, at)
        return m.end() if m and self.names(m.group()) else -1


def seconds(clock: str) -> float:
    if "分" in clock:
        m = re.search(r"(?:(\d+)時間?)?(\d+)分(?:(\d+)秒)?", clock)
        return int(m[1] or 0) * 3600 + int(m[2]) * 60 + int(m[3] or 0) if m else 0.0
    value = 0.0
    for x in clock.replace(",", ".").split(":"):
        value = value * 60 + float(x)
    return value


def clean(words: str) -> str:
    """The words without annotations, hesitation and stuttering; '' if nothing is left."""
    tree = Parser(UTTERANCE, words).rule("all", 0)
    text = "".join(words[c.start : c.end] for c in (tree.children if tree else []) if c.rule == "kept")
    text = re.sub(r"([一-龥ぁ-んァ-ヶー]{2,6})、(?=\1)", "", text)
    text = re.sub(r"\s*\n[\s　]*", "", text)
    text = re.sub(r"^[、，。．…・\s　]+", "", text).strip()
    return text if re.search(r"\w", text) else ""


def segments(body: str, people: list[Person]) -> Iterator[tuple[float | None, str, str]]:
    """(seconds or None, label, words) of each segment in the order of the body."""
    text = body.replace("\r\n", "\n").replace("\r", "\n")
    labels = Labels(people)
    parser = Parser(TRANSCRIPT, text, {"label": labels.label, "name": labels.name})

    def inner(tree: Tree, rule: str) -> str | None:
        for c in tree.children:
            if c.rule == rule:
                return text[c.start : c.end]
            if (found := inner(c, rule)) is not None:
                return found
        return None

    for t in parser.parse("body").children:
        if t.rule == "segment":
            header, words = t.children
            clock = inner(header, "time") or inner(header, "after")
            label = inner(header, "label") or inner(header, "name") or inner(header, "tagged") or ""
            yield (seconds(clock) if clock else None), re.sub(r"[:：\t　 ]+$", "", label), re.sub("</v>", "", text[words.start : words.end])


def turns(body: str | None, attendance: str | None) -> list[tuple[str, str, float | None]]:
    """(speaker, text, seconds of its start) of each turn in order of time."""
    if not body:
        return []
    people = attendees(attendance)
    labels = Labels(people)
    found, last = [], -1.0
    for at, label, words in segments(body, people):
        last = at if at is not None else last
        found.append((last, at, label, words))
    found.sort(key=lambda x: x[0])
    out: list[tuple[str, str, float | None]] = []
    for _, at, label, words in found:
        person = None if HALL.match(label.strip()) else labels.who(label)
        said = clean(words) if person else ""
        if not person or not said:
            continue
        if out and out[-1][0] == person.name:
            out[-1] = (person.name, out[-1][1] + "\n" + said, out[-1][2])
        else:
            out.append((person.name, said, at))
    return out


def speaker_turns(df: DataFrame, key: str = "raw_id", body: str = "body", attendance: str = "attendees") -> DataFrame:
    """(key, turn_no, speaker, text, at_seconds) of the transcripts of df."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(k, n, *t) for k, b, a in zip(pdf["k"], pdf["b"], pdf["a"], strict=True) for n, t in enumerate(turns(b, a), 1)]
            yield pd.DataFrame(rows, columns=["k", "turn_no", "speaker", "text", "at_seconds"])

    out = df.selectExpr(f"`{key}` as k", f"`{body}` as b", f"`{attendance}` as a").mapInPandas(run, f"k {kind}, turn_no int, speaker string, text string, at_seconds double")
    return out.withColumnRenamed("k", key)
