"""Variant spellings of names of people and organisations, linked within a group (here: a council).

Method: prefix-filtered set-similarity join on token q-grams, verified by soft weighted token similarity. Every distinct spelling is
parsed into surname and given name, or into the core of an organisation's name, in writing and in reading (kana and
Latin letters share one Latin form; readings of kanji are learnt from the entries that state them). Its q-grams of both, rarest
first, are joined to those of the other spellings of its group; pairs are verified by the similarity of their tokens, weighted by
rarity. Full spellings that agree form an entity (connected components by repeated minima); a partial spelling (initial,
nickname, surname with office, cut or mistyped name) joins an entity only if exactly one of its group fits best.

Results that are defined: NULL and empty names are linked to nothing; equal spellings of a group are one entity; ties between
entities leave a partial spelling alone; a NULL group is a group of its own for no one; repeated rows change nothing; an
empty table gives no rows; extra columns are not carried.
"""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from minutesmith.llm.japanese import HIRAGANA, MODERN
from minutesmith.llm.linking import components
from minutesmith.llm.lookalikes import usual
from minutesmith.runtime import keep

#: Share of the rarer side's weight that candidates have in common, and the score from which full spellings are one entity.
CONTAINED, SAME = 0.3, 0.85
#: Score below which two full names have nothing in common that counts: one token alone.
FAINT = 0.75
#: Legal forms, as written before or after the name of an organisation, and short forms of kinds of organisation.
FORMS = "株式会社|有限会社|合同会社|合資会社|一般社団法人|公益社団法人|社団法人|一般財団法人|公益財団法人|財団法人|特定非営利活動法人|NPO法人|社会福祉法人|学校法人|医療法人|宗教法人|(?:\\((?:株|有|合|一社|公社|社|一財|公財|財|特非|福|学|医|宗)\\))|㈱|㈲|カ\\)|\\(カ|\\(カ\\)|ユ\\)|トクヒ\\)"
SHORT = (("漁協", "漁業協同組合"), ("農協", "農業協同組合"), ("森組", "森林組合"), ("総研", "総合研究所"), ("商議所", "商工会議所"), ("観連", "観光連盟"), ("建協", "建設協会"))
KINDS = "組合|協会|連盟|会議所|研究所|福祉会|医師会|交通|電設|水産加工|加工|建設|工業|商事|商会|銀行|大学|病院|学校|センター|クラブ|協議会|連合会|財団|法人|会社|協$|会$|所$|団$"
HONORIFICS = "さん|様|殿|氏|君|先生|議員|御中"
_KANJI = "一-鿿㐀-䶿々〆ヶ"
_FORM = re.compile(FORMS, re.I)
_KIND = re.compile(KINDS)

_ROWS = {"k": "かきくけこ", "s": "さしすせそ", "t": "たちつてと", "n": "なにぬねの", "h": "はひふへほ", "m": "まみむめも", "y": "や ゆ よ", "r": "らりるれろ", "g": "がぎぐげご", "z": "ざじずぜぞ", "d": "だぢづでど", "b": "ばびぶべぼ", "p": "ぱぴぷぺぽ"}
_LATIN = {k: c + v for c, ks in _ROWS.items() for k, v in zip(ks, "aiueo", strict=True) if k != " "} | dict(zip("あいうえお", "aiueo", strict=True))
_LATIN |= {"し": "shi", "ち": "chi", "つ": "tsu", "ふ": "fu", "じ": "ji", "ぢ": "ji", "づ": "zu", "わ": "wa", "を": "o", "ん": "n", "ー": ""}
for _k in "きしちにひみりぎじびぴ":
    for _s, _v in (("ゃ", "a"), ("ゅ", "u"), ("ょ", "o")):
        _LATIN[_k + _s] = (_LATIN[_k][:-1] if _LATIN[_k] in ("shi", "chi", "ji") else _LATIN[_k][0] + "y") + _v


def latin(kana: str) -> str:
    """Latin letters of a kana reading, in the usual romanisation, without marks for length."""
    text = kana.translate(HIRAGANA)
    out, i = [], 0
    while i < len(text):
        two = text[i : i + 2]
        if text[i] == "っ":
            out.append(_LATIN.get(text[i + 1 : i + 2], "")[:1])
        elif two in _LATIN:
            out.append(_LATIN[two])
            i += 1
        else:
            out.append(_LATIN.get(text[i], text[i] if text[i].isascii() else ""))
        i += 1
    return "".join(out)


def short(reading: str) -> str:
    """A reading for comparison: spellings of long vowels and of n and m are one."""
    text = re.sub(r"[^a-z]", "", reading.lower().translate(str.maketrans("āīūēō", "aiueo")))
    text = text.replace("oh", "o") if re.search(r"oh(?![aiueo])", text) else text
    return re.sub(r"m(?=[bp])", "n", text)


@dataclass(slots=True)
class Name:
    """A parsed spelling. ks, kg: surname and given name in kanji; rs, rg: their readings; whole: reading of the full name.
    part says how little is known of the given name: '' full, 'kanji' its beginning in kanji, 'nick' or 'initial' of its reading, 'none'."""

    kind: str = "person"
    ks: str = ""
    kg: str = ""
    rs: str = ""
    rg: str = ""
    whole: str = ""
    part: str = ""
    office: str = ""


def parse(speaker: str, kana: str | None = None) -> Name:
    text = usual(unicodedata.normalize("NFKC", usual(speaker))).translate(MODERN)
    text = re.sub(r"\s+", " ", text.replace("　", " ")).strip()
    read = short(latin(re.sub(r"\s", "", unicodedata.normalize("NFKC", kana)))) if kana else ""
    parts = [short(latin(p)) for p in re.split(r"\s+", unicodedata.normalize("NFKC", kana).strip())] if kana else []
    bare = _FORM.sub("", text)
    if bare != text or (_KIND.search(text) and not re.search(r"[A-Za-z]", text) and not re.fullmatch(rf"[{_KANJI}]{{2}}.{{0,10}}(?:長|員|監|者|事|人)", text)):
        core = re.sub(rf"(?:{HONORIFICS})$", "", re.sub(r"[\s()・]", "", bare))
        for a, b in SHORT:
            core = core[: -len(a)] + b if core.endswith(a) else core
        core = core + "会" if core.endswith("建設協") else core
        return Name("org", ks=core.translate(HIRAGANA))
    name = Name(whole=read)
    if len(parts) == 2:
        name.rs, name.rg = parts
    if re.search(r"[A-Za-z]", text):
        if m := re.fullmatch(r"([A-Za-z'-]+), ?([A-Za-z.'-]+)", text):
            s, g = m[1], m[2]
        elif m := re.fullmatch(r"([A-Za-z.'-]+) ([A-Za-z.'-]+)", text):
            s, g = (m[1], m[2]) if m[1].isupper() and len(m[1]) > 2 and "." not in m[1] else (m[2], m[1])
        else:
            return Name(whole=short(text), part="" if " " in text else "none")
        if re.fullmatch(r"[A-Za-z]\.?", g):
            name.rs, name.part = name.rs or short(s), "initial"
            name.rg = name.rg or short(g)
            name.part = "" if len(parts) == 2 else "initial"
            return name if name.part == "" or not read else Name(whole=read, rs=short(s), rg=short(g), part="")
        typed = Name(rs=short(s), rg=short(g), whole=short(s) + short(g))
        return Name(rs=name.rs, rg=name.rg, whole=read) if read and len(parts) == 2 else Name(rs=typed.rs, rg=typed.rg, whole=read or typed.whole)
    if m := re.fullmatch(r"(.+?) ?\((.+?)ちゃん\)", text):
        return Name(ks=m[1], rs=name.rs, rg=name.rg or short(latin(m[2])), whole=read, part="" if read and len(parts) == 2 else "nick")
    if m := re.fullmatch(r"(.+?) ?\((.)\)", text):
        return Name(ks=m[1], kg=m[2], rs=name.rs, rg=name.rg, whole=read, part="kanji")
    text = re.sub(r" ?(?:\(.*?\))$", "", text)
    if re.fullmatch(r"[ぁ-ゖァ-ヺー・ ]+", text):
        halves = [short(latin(p)) for p in re.split(r"[ ・]", text) if p]
        joined = "".join(halves)
        return Name(rs=halves[0] if len(halves) == 2 else name.rs, rg=halves[1] if len(halves) == 2 else name.rg, whole=joined)
    if m := re.fullmatch(rf"([{_KANJI}]{{2,3}}) ?([ぁ-ゖァ-ヺー]{{2,}})", text):
        if m[2].translate(HIRAGANA) != "すぽーつ":
            return Name(ks=m[1], rs=name.rs, rg=short(latin(m[2])), whole=read)
    body = re.sub(rf"(?:さん|様|殿|氏|君|先生)$", "", text)
    if m := re.fullmatch(rf"([{_KANJI}]{{2}})(議員|委員|委員長|副?知事|副?議長|参考人|公述人|[^ ]*(?:課長|部長|局長|委員長|監査委員|管理者|管理監|教育長))", body):
        return Name(ks=m[1], whole=read, rs=name.rs, rg=name.rg, part="" if len(parts) == 2 else "none", office=m[2])
    body = re.sub(r"(?<=..)(?:議員|委員|委員長|議長|知事)$", "", body) if len(re.sub(" ", "", body)) > 4 else body
    if " " in body:
        s, g = body.split(" ", 1)
        return Name(ks=s, kg=g.replace(" ", ""), rs=name.rs, rg=name.rg, whole=read)
    once = re.sub(r"(.)\1", r"\1", body) if len(body) == 5 else body
    return Name(ks=once[:2], kg=once[2:], rs=name.rs, rg=name.rg, whole=read, part="kanji" if len(once) == 3 else "")


def grams(n: Name) -> list[str]:
    """q-grams of a spelling: pairs of characters of its writing, triples of its reading, marked by what they are of; and the whole
    as a sorted word (m, n), which exchanged characters leave as it is."""
    if n.kind == "org":
        return sorted({f"o{n.ks[i : i + 2]}" for i in range(max(1, len(n.ks) - 1))} | {"m" + "".join(sorted(n.ks))})
    out = {f"k{n.ks}", *(f"s{c}" for c in n.ks + n.kg)} if n.ks else set()
    if n.ks and n.kg and not n.part:
        out.add("n" + "".join(sorted(n.ks + n.kg)))
    for mark, reading in (("r", n.rs), ("w", n.whole)):
        out |= {f"{mark}{reading[i : i + 3]}" for i in range(max(0, len(reading) - 2))}
    if n.rs:
        out |= {f"w{n.rs[i : i + 3]}" for i in range(max(0, len(n.rs) - 2))}
    return sorted(out)


def cut_once(a: str, b: str) -> bool:
    """Whether one of two words is the other with one letter left out."""
    if abs(len(a) - len(b)) != 1:
        return False
    long, small = (a, b) if len(a) > len(b) else (b, a)
    return any(long[:i] + long[i + 1 :] == small for i in range(len(long)))


def swapped(a: str, b: str) -> bool:
    """Whether two words differ by one exchange of neighbours."""
    at = [i for i in range(len(a)) if a[i] != b[i]] if len(a) == len(b) else []
    return len(at) == 2 and at[1] == at[0] + 1 and a[at[0]] == b[at[1]] and a[at[1]] == b[at[0]]


CLOSE = 0.8  # similarity from which two tokens count at all


def written(x: str, y: str, sound: bool = False) -> float:
    """Likeness of two tokens in kanji: letters exchanged or doubled, or one letter put for another of the same sound."""
    if x == y:
        return 1.0
    if sorted(set(x)) == sorted(set(y)):
        return 0.95
    return 0.9 if sound and len(x) == len(y) > 1 and sum(p != q for p, q in zip(x, y, strict=True)) == 1 else 0.0


def heard(x: str, y: str) -> float:
    """Likeness of two tokens in reading: a letter left out or exchanged."""
    return 1.0 if x == y else CLOSE if cut_once(x, y) or swapped(x, y) else 0.0


def soft(tokens: list[tuple[float, float]]) -> tuple[float, bool]:
    """Soft weighted similarity of (likeness, weight) of the tokens of two names, and whether every token surely agrees.
    Tokens less alike than CLOSE count nothing, rare ones more."""
    whole = sum(w for _, w in tokens)
    return (sum(x * w for x, w in tokens if x >= CLOSE) / whole if whole else 0.0), all(x >= 0.9 for x, _ in tokens)


def agree(a: Name, b: Name, ws: float = 1.0, wg: float = 1.0, sound: bool = False) -> tuple[float, bool]:
    """(similarity, whether it is that of two full names which surely agree): soft weighted similarity of surname and given name, in writing or
    in reading, whichever is more. ws, wg: how rare the two are. sound: the letters in which their given names differ are read alike."""
    if a.kind != b.kind:
        return 0.0, True
    if a.kind == "org":
        # The letters of an organisation's name are one token; names of some length may miss one.
        x, y = a.ks, b.ks
        return soft([(1.0 if x == y else 0.9 if swapped(x, y) or (min(len(x), len(y)) >= 6 and cut_once(x, y)) else 0.0, ws)])
    if not (a.part or b.part):
        options = [(0.0, True)]
        if a.ks and b.ks and a.kg and b.kg:
            if sorted(set(a.ks + a.kg)) == sorted(set(b.ks + b.kg)):  # parts in another order, too
                options.append(soft([(1.0, ws), (1.0, wg)]))
            options.append(soft([(written(a.ks, b.ks), ws), (written(a.kg, b.kg, sound and not (a.whole and b.whole and a.whole != b.whole)), wg)]))
            if a.ks == b.ks and len(a.kg) != len(b.kg) and (a.kg.startswith(b.kg) or b.kg.startswith(a.kg)) and not (a.whole and b.whole and a.whole != b.whole):
                options.append((soft([(1.0, ws), (0.85, wg)])[0], False))
            if a.whole and b.whole:
                options.append(soft([(float(a.whole == b.whole), ws + wg)]))
            elif a.rg and b.rg:
                options.append(soft([(float(a.ks == b.ks), ws), (0.95 * (a.rg == b.rg), wg)]))
        elif a.whole and b.whole:
            options.append(soft([(float(a.whole == b.whole), ws + wg)]))
            if min(len(a.whole), len(b.whole)) >= 8 and cut_once(a.whole, b.whole):
                options.append(soft([(CLOSE, ws + wg)]))
            if a.rs and b.rs and a.rg and b.rg:
                score, sure = soft([(heard(a.rs, b.rs) if cut_once(a.rs, b.rs) else float(a.rs == b.rs), ws), (float(a.rg == b.rg), wg)])
                options.append((score, sure) if a.rg == b.rg else (0.0, True))
        elif a.ks and a.ks == b.ks and a.rg and a.rg == b.rg:
            options.append(soft([(1.0, ws), (1.0, wg)]))
        best = max(options)
        return best if best[0] >= FAINT else (0.0, True)
    # A partial spelling: what it states of the given name is all that can be compared.
    s = 1.0 if (a.ks and a.ks == b.ks) or (a.rs and a.rs == b.rs) else CLOSE if a.rs and b.rs and min(len(a.rs), len(b.rs)) > 4 and cut_once(a.rs, b.rs) else 0.0
    if not s and not (a.whole and b.whole and a.whole == b.whole):
        return 0.0, False
    p, q = (a, b) if a.part else (b, a)
    apart = bool(p.whole and q.whole and p.whole != q.whole)
    g = 0.0
    if p.part == "kanji" and not apart:
        g = 1.0 if q.kg and q.kg[:1] == p.kg[:1] else 0.9 if p.whole and p.whole == q.whole else 0.0
    elif p.part in ("nick", "initial"):
        g = 1.0 if q.rg and p.rg and q.rg.startswith(p.rg) or (q.part == p.part and p.rg == q.rg and q.ks == p.ks and q.rs == p.rs) else 0.0
    elif p.part == "none" and not apart:
        return (ws * s + 0.5) / (ws + 1), False  # nothing is stated, so how rare the other's given name is says nothing
    return (soft([(s, ws), (g, wg)])[0] if g else 0.0), False


_SCHEMA = "struct<kind:string,ks:string,kg:string,rs:string,rg:string,whole:string,part:string,office:string>"
_FIELDS = ("kind", "ks", "kg", "rs", "rg", "whole", "part", "office")


def _most(df: DataFrame, key: str, value: str) -> DataFrame:
    """The most frequent value of each key."""
    counts = df.where(f"{key} <> '' and {value} <> ''").groupBy(key, value).agg(F.count("*").alias("n"))
    return counts.groupBy(key).agg(F.max_by(value, F.struct("n", value)).alias(value))


def _cuts(pairs: DataFrame, key: str, value: str) -> DataFrame:
    """(c1, p1, c2, p2): every known pair of two characters and their reading, cut where its parts recur in most other pairs."""
    known = pairs.select(F.col(key).alias("k"), F.col(value).alias("v")).where("length(k) = 2 and length(v) > 1").distinct()
    cuts = known.withColumn("i", F.explode(F.expr("sequence(1, length(v) - 1)"))).select("k", "v", F.expr("substring(k, 1, 1)").alias("c1"), F.expr("substring(v, 1, i)").alias("p1"), F.expr("substring(k, 2, 1)").alias("c2"), F.expr("substring(v, i + 1)").alias("p2"))
    first, second = cuts.groupBy("c1", "p1").agg(F.count("*").alias("n1")), cuts.groupBy("c2", "p2").agg(F.count("*").alias("n2"))
    best = cuts.join(first, ["c1", "p1"]).join(second, ["c2", "p2"]).groupBy("k", "v").agg(F.max_by(F.struct("c1", "p1", "c2", "p2"), F.struct(F.col("n1") * F.col("n2"), "p1")).alias("b")).select("b.*")
    return best


def _by_character(best: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Most frequent readings of first and of second characters."""
    heads = best.groupBy("c1", "p1").agg(F.count("*").alias("n")).groupBy("c1").agg(F.max_by("p1", F.struct("n", "p1")).alias("p1"))
    tails = best.groupBy("c2", "p2").agg(F.count("*").alias("n")).groupBy("c2").agg(F.max_by("p2", F.struct("n", "p2")).alias("p2"))
    return heads, tails


def _complete(names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Readings of kanji surnames and given names, learnt from the spellings that state them, put where they are missing; and the order
    of names written given name first set right. Also (p, q): characters that are read alike in several of those spellings."""
    flat = names.select("*", *(F.col(f"n.{f}").alias(f) for f in _FIELDS)).drop("n")
    stated = flat.where("kind = 'person' and ks <> '' and rs <> '' and length(ks) = 2")
    surnames = _most(stated.select("ks", "rs"), "ks", "rs").withColumnRenamed("rs", "read_s")
    parted = stated.where("kg <> '' and rg <> '' and part = ''").select("kg", "rg")
    # A reading without a gap states the given name's after the surname's.
    gapless = flat.where("kind = 'person' and part = '' and kg <> '' and rg = '' and whole <> ''").join(surnames, "ks").where(F.startswith("whole", "read_s")).select("kg", F.expr("substring(whole, length(read_s) + 1)").alias("rg")).where("rg <> ''")
    split = parted.unionByName(gapless)
    givens = _most(split, "kg", "rg").withColumnRenamed("rg", "read_g")
    reversed_ = flat.join(surnames.select(F.col("ks").alias("kg"), F.lit(True).alias("g_is_surname")), "kg", "left").join(surnames.select("ks", F.lit(True).alias("s_is_surname")), "ks", "left")
    turn = F.coalesce(F.col("g_is_surname"), F.lit(False)) & ~F.coalesce(F.col("s_is_surname"), F.lit(False)) & (F.col("part") == "") & (F.col("kind") == "person") & (F.length("kg") == 2)
    turned = reversed_.withColumn("_s", F.when(turn, F.col("kg")).otherwise(F.col("ks"))).withColumn("kg", F.when(turn, F.col("ks")).otherwise(F.col("kg"))).withColumn("ks", F.col("_s")).drop("_s", "g_is_surname", "s_is_surname")
    both = turned.join(surnames, "ks", "left").join(givens, "kg", "left")
    # Names never seen with a reading are read character by character.
    cuts = [keep(_cuts(stated.select("ks", "rs"), "ks", "rs"), "names-cuts"), keep(_cuts(split, "kg", "rg"), "names-cuts")]
    for column, source, cut in (("read_s", "ks", cuts[0]), ("read_g", "kg", cuts[1])):
        heads, tails = _by_character(cut)
        both = both.withColumn("c1", F.substring(source, 1, 1)).withColumn("c2", F.when(F.length(source) == 2, F.substring(source, 2, 1))).join(heads, "c1", "left").join(tails, "c2", "left")
        both = both.withColumn(column, F.coalesce(column, F.concat("p1", "p2"))).drop("c1", "c2", "p1", "p2")
    person = F.col("kind") == "person"
    rs = F.when(person & (F.col("rs") == ""), F.coalesce("read_s", F.lit(""))).otherwise(F.col("rs"))
    # A reading without a gap is cut after the surname's reading.
    rest = F.when((F.col("whole") != "") & (rs != "") & F.col("whole").startswith(rs), F.substring(F.col("whole"), F.length(rs) + 1, F.length("whole")))
    full_kg = (F.col("part") == "") & (F.col("kg") != "")
    rg = F.when(person & (F.col("rg") == "") & (F.col("part").isin("", "kanji", "none")), F.coalesce(rest, F.when(full_kg, F.col("read_g")), F.lit(""))).otherwise(F.col("rg"))
    done = both.withColumn("rs", rs).withColumn("rg", rg)
    known = person & (F.col("whole") == "") & (F.col("part") == "") & (F.col("rs") != "") & (F.col("rg") != "")
    done = done.withColumn("whole", F.when(known, F.concat("rs", "rg")).otherwise(F.col("whole")))
    # A stated full reading makes a partial spelling full.
    done = done.withColumn("part", F.when(person & (F.col("whole") != "") & (F.col("rs") != "") & (F.col("rg") != "") & (F.col("part") != ""), "").otherwise(F.col("part")))
    tails = cuts[0].unionByName(cuts[1]).groupBy("c2", "p2").agg(F.count("*").alias("n")).where("n > 1")
    alike = tails.select(F.col("c2").alias("p"), "p2").join(tails.select(F.col("c2").alias("q"), "p2"), "p2").where("p <> q").select("p", "q").distinct()
    return done.drop("read_s", "read_g"), alike


def link(df: DataFrame, entry: str, group: str, name: str, reading: str, office: str, sounds: tuple[str, ...] = ()) -> DataFrame:
    """(entry, group, entity) of every entry with a name; entity is the least entry of those that name the same one.

    sounds: letters that are read alike, besides those that the readings of df show (see `glossary`)."""
    rows = df.select(F.col(entry).cast("bigint").alias("entry"), F.col(group).alias("grp"), F.col(name).alias("name"), F.col(reading).alias("kana"), F.col(office).alias("office_said")).where("name is not null and trim(name) <> '' and grp is not null and entry is not null")

    def parsed(n: pd.Series, k: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([[getattr(p, f) for f in _FIELDS] for p in (parse(a, b if isinstance(b, str) and b.strip() else None) for a, b in zip(n, k, strict=True))], columns=list(_FIELDS))

    def office_of(o: pd.Series) -> pd.Series:
        from minutesmith.llm.canonical import NOISE, fold

        def f(v: object) -> str:
            text = fold(v) if isinstance(v, str) else ""
            for word in NOISE:
                text = text.replace(word, "") if len(text) > len(word) else text
            return text.removeprefix("職")

        return o.map(f)

    distinct = rows.groupBy("grp", "name", "kana", "office_said").agg(F.min("entry").alias("node"))
    distinct = keep(distinct, "names-distinct")
    # Each spelling is parsed once, however many groups and offices it has.
    spelled = distinct.select("name", "kana").distinct().withColumn("n", F.pandas_udf(parsed, _SCHEMA)("name", "kana"))
    offices = distinct.select("office_said").where("office_said is not null").distinct().withColumn("said", F.pandas_udf(office_of, "string")("office_said"))
    named = distinct.join(spelled, (distinct["name"] == spelled["name"]) & distinct["kana"].eqNullSafe(spelled["kana"])).select("grp", "node", "office_said", "n").join(offices, "office_said", "left")
    done, alike = _complete(keep(named.select("grp", "node", F.coalesce("said", F.lit("")).alias("said"), "n"), "names-parsed"))
    fields = F.struct(*(F.col(f) for f in _FIELDS))

    def gram_udf(s: pd.DataFrame) -> pd.Series:
        return pd.Series([grams(Name(*r)) for r in s[list(_FIELDS)].itertuples(index=False)])

    nodes = keep(done.withColumn("grams", F.pandas_udf(gram_udf, "array<string>")(fields)), "names-nodes")
    # Prefix filter: the rarest q-grams of one side against all of the other's, within the group.
    token = nodes.select("grp", "node", F.explode("grams").alias("gram"))
    weight = token.groupBy("grp", "gram").agg(F.count("*").alias("df"))
    ranked = token.join(weight, ["grp", "gram"]).groupBy("grp", "node").agg(F.array_sort(F.collect_list(F.struct("df", "gram"))).alias("g"))
    prefix = ranked.select("grp", "node", F.explode(F.expr(f"array_union(slice(g, 1, size(g) - cast(ceil({CONTAINED} * size(g)) as int) + 1), filter(g, x -> left(x.gram, 1) in ('m', 'n')))")).alias("p")).select("grp", "node", "p.gram")
    pairs = prefix.join(token.withColumnRenamed("node", "other"), ["grp", "gram"]).where("node <> other").select("grp", F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()
    # How rare the tokens are among all spellings: from 1 for one that all have to 2 for one that a single one has.
    total = nodes.count()
    weighed = nodes.withColumn("st", F.when(F.col("ks") != "", F.col("ks")).otherwise(F.col("rs"))).withColumn("gt", F.when(F.col("kg") != "", F.col("kg")).otherwise(F.col("rg")))
    for token_name, weight_name in (("st", "ws"), ("gt", "wg")):
        rare = weighed.groupBy(token_name).agg((2 - F.log(F.count("*")) / F.log(F.lit(float(max(2, total))))).alias(weight_name))
        weighed = weighed.join(rare, token_name)
    weighed = weighed.select("grp", "node", fields.alias("n"), "said", "ws", "wg")
    left = weighed.select("grp", F.col("node").alias("a"), F.col("n").alias("x"), F.col("said").alias("said_a"), F.col("ws").alias("wsa"), F.col("wg").alias("wga"))
    right = weighed.select("grp", F.col("node").alias("b"), F.col("n").alias("y"), F.col("said").alias("said_b"), F.col("ws").alias("wsb"), F.col("wg").alias("wgb"))

    def verify(x: pd.DataFrame, y: pd.DataFrame, ws: pd.Series, wg: pd.Series, sound: pd.Series) -> pd.DataFrame:
        pairs_of = zip(x[list(_FIELDS)].itertuples(index=False), y[list(_FIELDS)].itertuples(index=False), ws, wg, sound, strict=True)
        return pd.DataFrame([agree(Name(*p), Name(*q), u, v, w) for p, q, u, v, w in pairs_of], columns=["score", "full"])

    met = pairs.join(left, ["grp", "a"]).join(right, ["grp", "b"])
    # The one letter in which two given names differ.
    differ = F.expr("filter(transform(sequence(1, length(x.kg)), i -> struct(substring(x.kg, i, 1) as p, substring(y.kg, i, 1) as q)), z -> z.p <> z.q)")
    apart = F.when((F.length("x.kg") > 0) & (F.length("x.kg") == F.length("y.kg")), differ)
    # Pairs that differ otherwise meet nothing, and each by a key of its own, so that they are not all sent to one task.
    met = met.withColumn("d", F.when(F.size(apart) == 1, apart[0])).withColumn("p", F.coalesce("d.p", F.concat(F.lit("\0"), F.col("a").cast("string")))).withColumn("q", F.col("d.q")).drop("d")
    told = df.sparkSession.createDataFrame([(p, q) for letters in sounds for p in letters for q in letters if p != q], "p string, q string")
    alike = alike.unionByName(told).distinct()
    met = met.join(alike.withColumn("sound", F.lit(True)), ["p", "q"], "left").withColumn("sound", F.coalesce("sound", F.lit(False)))
    checked = met.withColumn("v", F.pandas_udf(verify, "score double, full boolean")("x", "y", (F.col("wsa") + F.col("wsb")) / 2, (F.col("wga") + F.col("wgb")) / 2, "sound"))
    titled = lambda part, own, other: F.when(F.col(f"{part}.office") != "", (F.col(f"{part}.office") == F.col(other)) | F.col(f"{part}.office").isin("議員", "委員"))
    same_office = F.coalesce(titled("x", "said_a", "said_b"), titled("y", "said_b", "said_a"), (F.col("said_a") == F.col("said_b")) & (F.col("said_a") != ""))
    conflict = (F.col("x.office") != "") & ~F.col("x.office").isin("議員", "委員") & (F.col("said_b") != "") & (F.col("said_b") != F.col("x.office"))
    conflict = conflict | ((F.col("y.office") != "") & ~F.col("y.office").isin("議員", "委員") & (F.col("said_a") != "") & (F.col("said_a") != F.col("y.office")))
    edges = keep(checked.where("v.score > 0").select("grp", "a", "b", "v.score", "v.full", same_office.alias("office"), conflict.alias("conflict"), F.col("x.part").alias("pa"), F.col("y.part").alias("pb")), "names-edges")
    strong = edges.where(f"full and score >= {SAME}").select("grp", "a", "b")
    entity = components(nodes.select("grp", "node"), strong)
    # Partial spellings: the entity that fits best, if there is exactly one.
    weak = edges.where(f"not (full and score >= {SAME})")
    sided = weak.select("grp", F.col("a").alias("node"), F.col("b").alias("other"), "score", "office", "conflict", F.col("pa").alias("part"), F.col("pb").alias("part_other")).unionByName(
        weak.select("grp", F.col("b").alias("node"), F.col("a").alias("other"), "score", "office", "conflict", F.col("pb").alias("part"), F.col("pa").alias("part_other"))
    )
    alone = entity.groupBy("entity").agg(F.count("*").alias("n")).where("n = 1").select(F.col("entity").alias("node"))
    whole = entity.select(F.col("node").alias("other"), F.col("entity").alias("to"))
    # What joins: partial spellings, and full ones that no other full one agrees with (mistyped ones).
    joins = sided.where("part <> ''").unionByName(sided.where("part = ''").join(alone, "node", "left_semi"))
    scored = joins.where("part_other = ''").join(whole, "other").groupBy("grp", "node", "to").agg(
        (F.max("score") + F.when(F.max(F.col("office").cast("int")) == 1, 0.15).otherwise(0.0) - F.when(F.min(F.col("conflict").cast("int")) == 1, 0.3).otherwise(0.0)).alias("fit"),
        F.count("*").alias("n"), F.max(F.when(F.col("part") == "", 1).otherwise(0)).alias("typo"),
    )
    best = scored.where("fit > 0.4").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("fit", "to")), asc=False).alias("r"))
    chosen = best.where("size(r) = 1 or r[0].fit > get(r, 1).fit + 0.04").select("node", F.expr("r[0].to").alias("to")).where("node <> to")
    extra = chosen.select("node", F.col("to").alias("other"))
    # Partial spellings of an entity that has no full one: equal partial spellings are one entity.
    orphans = edges.where("pa <> '' and pb <> '' and score >= 0.85").join(chosen.select(F.col("node").alias("a")), "a", "left_anti").join(chosen.select(F.col("node").alias("b")), "b", "left_anti")
    final = components(nodes.select("grp", "node"), strong.select("grp", "a", "b").unionByName(extra.join(nodes.select("grp", "node"), "node").select("grp", F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"))).unionByName(orphans.select("grp", "a", "b")))
    # NULL readings and offices are values of their own here.
    keys = ["grp", "name", "kana_key", "office_key"]
    keyed = lambda x: x.withColumn("kana_key", F.coalesce("kana", F.lit("\0"))).withColumn("office_key", F.coalesce("office_said", F.lit("\0")))
    back = keyed(rows).select(*keys, "entry").join(keyed(distinct).select(*keys, "node"), keys)
    return back.join(final, "node").select(F.col("entry").alias(entry), F.col("grp").alias(group), "entity").distinct()


def pairs(linked: DataFrame, entry: str) -> DataFrame:
    """(entry_a, entry_b), entry_a < entry_b, of entries of one entity."""
    a, b = linked.select("entity", F.col(entry).alias("entry_a")), linked.select("entity", F.col(entry).alias("entry_b"))
    return a.join(b, "entity").where("entry_a < entry_b").select("entry_a", "entry_b")

