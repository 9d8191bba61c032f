"""Text that looks the same in one spelling: invisible, full-width, decomposed and look-alike characters.

Method: every character has the set of scripts it can stand for (its own and those of its twins); the sets are intersected
across each token. An empty intersection of the characters' own scripts with a script left in the resolved sets is a mixed
token and is spelled in the script left; a token all of twins (whole-script confusable) is spelled in the script the value
otherwise uses. What remains (widths, compositions, radicals, spaces, invisible characters) is normalised by rule.

A cheap regular expression in the JVM passes sound values by; only the others reach Python.

Results that are defined: NULL stays NULL and is no case; '' stays ''; the usual form of a usual form is itself; kanji of
visibly different old shape stay (U+FA0E and above are not touched); joiners after a virama and presentation selectors
after symbols stay; values of any length are read whole.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

INVISIBLE = "\u00ad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180e\u200b-\u200f\u202a-\u202e\u2060-\u2064\u2066-\u206f\u2800\u3164\ufe00-\ufe0f\ufeff\uffa0\U000e0000-\U000e0fff"
SPACES = "\u00a0\u1680\u2000-\u200a\u202f\u205f"
#: Full-width letters and digits, half-width kana, radicals, duplicates among the ideographs, joining jamo, letter-like signs.
FORMS = "０-９Ａ-Ｚａ-ｚ｡-ﾟ⺀-⿕豈-廓ᄀ-ᇿꥠ-꥿ힰ-퟿ΩKÅ\U0001d400-\U0001d7ffﬀ-ﬆ"
MARKS = "\u0300-\u036f\u3099\u309a゛゜"
#: Twins: characters that look the same in the scripts named, each column one shape. Fixed values.
LATIN_CYRILLIC = ("ABEKMHOPCTXYSIJVaeopcyxsijhvwdqlGgNR", "АВЕКМНОРСТХУЅІЈѴаеорсухѕіјһѵԝԁԛӏԌɡИЯ")
LATIN_GREEK = ("ABEZHIKMNOPTYXovpiuyn", "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧονριυγη")
LATIN_ARMENIAN = ("OSUhnouq", "ՕՏՍհոօսզ")
LATIN_CHEROKEE = ("ABCDEGHIJKLMPRSTVWZ", "ᎪᏴᏟᎠᎬᏀᎻᏆᎫᏦᏞᎷᏢᏒᏚᎢᏙᎳᏃ")
KATAKANA_HAN = ("ーニミハロエカタトチヌオリ", "一二三八口工力夕卜千又才刂")
HIRAGANA_KATAKANA = ("へべぺり", "ヘベペリ")
#: Strokes that stand for the long mark of katakana; some are signs of their own elsewhere.
STROKES = "‐‑‒–—―−─ー一⼀"
#: Greek and Cyrillic pairs above that only resemble at a glance are used in mixed tokens, not on their own.
WEAK = set("ИЯνγηυρӏг")
_HAN, _STROKE = KATAKANA_HAN[1], STROKES.replace("ー", "")
SUSPECT = (
    f"[{INVISIBLE}{SPACES}{FORMS}{MARKS}Ͱ-ԯԱ-ևᎠ-Ᏼɑɡ]"
    f"|[ァ-ヺー][{_HAN}{_STROKE}へべぺり]|[{_HAN}へべぺり][ー{_STROKE}]?[ァ-ヺー]|[ぁ-ゖ][ヘベペリー][ぁ-ゖ]|[一-龥][ーニロエカタトハ][一-龥]"
)

_RANGES = (
    ("Latin", "A-Za-zÀ-ɏɐ-ʯ"), ("Cyrillic", "Ѐ-ԯ"), ("Greek", "Ͱ-Ͽ"), ("Armenian", "Ա-և"), ("Cherokee", "Ꭰ-Ᏼ"),
    ("Katakana", "ァ-ヺー"), ("Hiragana", "ぁ-ゖ"), ("Han", "一-鿿㐀-䶿豈-﫿々〇"),
)
_OWN = [(name, re.compile(f"[{chars}]")) for name, chars in _RANGES]
_TWINS: dict[str, dict[str, str]] = {}
for first, second, pair in (
    ("Latin", "Cyrillic", LATIN_CYRILLIC), ("Latin", "Greek", LATIN_GREEK), ("Latin", "Armenian", LATIN_ARMENIAN), ("Latin", "Cherokee", LATIN_CHEROKEE),
    ("Katakana", "Han", KATAKANA_HAN), ("Hiragana", "Katakana", HIRAGANA_KATAKANA),
):
    for x, y in zip(*pair, strict=True):
        _TWINS.setdefault(x, {}).setdefault(second, y)
        _TWINS.setdefault(y, {}).setdefault(first, x)

_LETTERS = re.compile("[A-Za-zÀ-ɏɐ-ʯͰ-ԯԱ-ևᎠ-Ᏼ]+")
_FORM = re.compile(f"[{FORMS}]+")
_GONE = re.compile(f"(?<!्)[\u200c\u200d]|(?<![←-⯿〰〽㊗㊙\U0001f000-\U0001faff#*0-9])[\ufe0e\ufe0f]|[{INVISIBLE.replace('\u200b-\u200f', '\u200b\u200e\u200f').replace('\ufe00-\ufe0f', '\ufe00-\ufe0d')}]")
_SPACE = re.compile(f"[{SPACES}]")
_MARKED = re.compile(f"[^\\s{MARKS}][{MARKS}]+")
_KATA = re.compile("[ァ-ヺー]")
_HAN_TWIN = dict(zip(KATAKANA_HAN[1], KATAKANA_HAN[0], strict=True))
_KATAKANA_OF = {**_HAN_TWIN, **dict.fromkeys(STROKES, "ー")}
_BODIES = re.compile("法人|会社|組合|団体|財団|協会")
#: Kanji after which 力 is the word for power.
_POWER = set("労働火水電子能体学協圧動努主有戦気視聴浮引重磁出入権暴魅活迫握馬風地効助資筋財実武人弾潮速応自他全微無総国県術界像現解業組続定継造進")
_SHAPES = "".join(_HAN_TWIN) + STROKES.replace("ー", "")
_MIXED = re.compile(f"(?:[{''.join(_HAN_TWIN)}][{STROKES}]?)?[ァ-ヺー](?:[ァ-ヺー{_SHAPES}]*[{_SHAPES}][ァ-ヺー{_SHAPES}]*)|[{''.join(_HAN_TWIN)}][{STROKES}]?[ァ-ヺー]+")


def script(ch: str) -> str:
    """The script of a character; '' of anything that is no letter of _RANGES."""
    return next((name for name, pattern in _OWN if ch and pattern.match(ch)), "")


def _respell(token: str, target: str) -> str:
    return "".join(ch if script(ch) == target else _TWINS[ch][target] for ch in token)


def _alphabetic(value: str) -> str:
    """Mixed and whole-script confusable tokens of alphabetic scripts."""
    tokens = _LETTERS.findall(value)
    #: Scripts that some character without a twin proves to be used in the value.
    proven = {script(ch) for token in tokens for ch in token if ch not in _TWINS or ch in WEAK}

    def fix(m: re.Match[str]) -> str:
        token = m.group()
        own = [{script(ch)} for ch in token]
        resolved = [s | set(_TWINS.get(ch, {})) for s, ch in zip(own, token, strict=True)]
        together, possible = set.intersection(*own), set.intersection(*resolved)
        if together == {"Latin"} or not possible:
            return token
        if not together:  # mixed
            return _respell(token, "Latin" if "Latin" in possible else sorted(possible)[0])
        (alone,) = together
        if "Latin" in possible and alone not in proven and not all(ch in WEAK or ch in "αβμπω" for ch in token):
            return _respell(token, "Latin")
        return token

    return _LETTERS.sub(fix, value)


def _east(value: str) -> str:
    """Kanji, strokes and kana inside words of another script."""

    def word(m: re.Match[str]) -> str:
        w = m.group()
        before, after = value[m.start() - 1 : m.start()], value[m.end() : m.end() + 1]
        first = next(i for i, ch in enumerate(w) if _KATA.match(ch))
        last = len(w) - 1 - next(i for i, ch in enumerate(reversed(w)) if _KATA.match(ch))
        head, body, tail = w[:first], w[first : last + 1], w[last + 1 :]
        if len(head) == 2 and head[1] in STROKES and head[0] in "口力夕卜工又才":  # no word begins with a stroke after such a kanji
            head = "".join(_KATAKANA_OF.get(ch, ch) for ch in head)
        elif len(head) == 1:  # kanji before katakana: a twin if the word before is complete
            free = script(before) in ("", "Hiragana") or _BODIES.search(value[max(0, m.start() - 2) : m.start()]) or (head == "力" and before not in _POWER and script(before) == "Han")
            whole = len(body) > 1 and head[-1] in "力口夕卜工" and free
            head = head[:-1] + _KATAKANA_OF[head[-1]] if whole else head
        body = "".join(_KATAKANA_OF.get(ch, ch) for ch in body)
        if tail:
            han = script(after) == "Han"
            sure = len(tail) > 1 and any(ch in STROKES or ch in "夕卜" for ch in tail) and len(set(tail)) > 1
            single = len(tail) == 1 and (tail == "卜" or (tail == "力" and len(body) == 2 and not head and script(before) != "Katakana" and script(after) in ("Han", "") and after not in set("士学量作説点走強持戦")) or (tail in STROKES and tail != "一") or (tail in "夕一" and not han and (after or before) and tail + after != "一つ"))
            if sure or single:
                tail = "".join(_KATAKANA_OF.get(ch, ch) for ch in tail)
        return head + body + tail

    def kana(m: re.Match[str]) -> str:
        return _TWINS[m.group()]["Hiragana"]

    def kanji(m: re.Match[str]) -> str:
        return _TWINS[m.group()]["Han"]

    text = _MIXED.sub(word, value)
    text = re.sub("(?<=[ァ-ヺー])[へべぺり](?=[ァ-ヺー])", lambda m: _TWINS[m.group()]["Katakana"], text)
    text = re.sub("(?<=[ぁ-ゖ])[ヘベペリ](?=[ぁ-ゖ])", kana, text)
    return re.sub("(?<=[一-龥])[ーニロエタト](?=[一-龥])", kanji, text)


def usual(value: str) -> str:
    """The value in the usual characters."""
    text = _GONE.sub("", value)
    text = _SPACE.sub(" ", text)
    text = text.replace("゛", "\u3099").replace("゜", "\u309a") if re.search("[か-ほカ-ホウ][゛゜]", text) else text
    text = _FORM.sub(lambda m: unicodedata.normalize("NFKC", m.group()), text)
    text = _MARKED.sub(lambda m: unicodedata.normalize("NFC", m.group()), text)
    return _east(_alphabetic(text.replace("ɑ", "a").replace("ɡ", "g")))


def usual_form(text: Column) -> Column:
    """The usual form of a string column; sound values do not leave the JVM's fast path with a change."""
    f = F.pandas_udf(lambda s: s.map(lambda v: usual(v) if v is not None else None).astype(object).where(s.notna(), None), "string")
    return F.when(text.rlike(SUSPECT), f(F.when(text.rlike(SUSPECT), text))).otherwise(text)


def unusual(text: Column) -> Column:
    """Whether a string column, already limited to suspicious values, has a character that its usual form has not."""
    return F.pandas_udf(lambda s: pd.Series([v is not None and usual(v) != v for v in s], dtype=bool), "boolean")(text)


