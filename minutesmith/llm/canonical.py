"""Freely typed values mapped to the closest entry of a reference list, of any language.

Method: token-level repair. The tokens are learnt from the reference list itself: words where the script has them, else the cut of each
name into the substrings that recur in it. Every distinct piece of the typed values is joined to this vocabulary by edit distance (an
equi-join on deletion variants of both sides, then a check), and to the beginnings of tokens for abbreviations; a token may have more
spellings (its reading, its English word) from optional tables. The repaired tokens of a value are combined with soft TF-IDF into a
score for every entry, and the best entry is taken if it is good enough and better than the second.

Scale: everything runs on distinct values; vocabulary, spellings and entries are joined by key, and nothing is broadcast by us. An entry
is found through its rarest tokens only: those without which its score cannot reach ACCEPT, so no entry that could be accepted is lost.

Results that are defined: a NULL value gives no row; an empty value or one of signs only is unmatched (-1); a value equal to
an entry is mapped to it; a tie is unmatched; repeated values get the same answer; a reference list without entries leaves
everything unmatched; NULL names are no entries; extra columns are not carried; values of any length are read whole.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from minutesmith.llm.japanese import HIRAGANA, MODERN
from minutesmith.runtime import keep

#: Words around a value that name nothing: the body, forms of address, notes of the sitting. A parameter of the operator.
NOISE = (
    "教育委員会", "県議会", "当委員会", "本県", "当県", "御中", "再任", "当時", "出席", "欠席", "招致", "速報版", "確定版", "閉会中", "開会中", "代理", "代行",
    "出納", "様", "殿", "氏", "君", "代", "分", "職", "県", "元", "前", "兼",
)
NOTE = re.compile(r"第?\d+(?:回|日目|号)|\d+")
STOPS = {"of", "and", "the", "for", "to", "on", "in"}
ACCEPT = 0.33  # least score
MARGIN = 0.02  # by which the best entry must be better
_RUN = re.compile(r"[一-鿿々]+|[ァ-ヺー]+|[ぁ-ゖ]+|[^\W\d_一-鿿々ァ-ヺーぁ-ゖ]+|\d+")


def fold(value: str) -> str:
    """Today's characters, NFKC, lower case, notes taken off; words where there are any, else letters and digits only."""
    text = unicodedata.normalize("NFKC", value).translate(MODERN).lower()
    text = NOTE.sub("", text)
    if re.search(r"[^\W\d_]{3}", text) and not re.search(r"[぀-ヿ㐀-鿿]", text):
        marks = "".join(c for c in unicodedata.normalize("NFD", text) if not unicodedata.combining(c))
        return " ".join(w for w in re.findall(r"[^\W_]+", unicodedata.normalize("NFC", marks)) if w not in STOPS)
    plain = "".join(c for c in text if unicodedata.category(c)[0] in "LN")
    body = next((w for w in NOISE if len(w) > 4 and plain.startswith(w) and len(plain) > len(w) + 1), "")
    return plain[len(body) :]


def worded(value: str) -> bool:
    """Whether a folded value is written in words that spaces part."""
    return not re.search(r"[぀-ヿ㐀-鿿]", value)


def tokens_of(name: str, entries: Mapping[str, int]) -> list[str]:
    """Tokens of a folded entry: its words; or the cheapest cut into pieces, which cost less the more entries hold them.

    entries: how many entries hold each substring of the name, negative for those that are an entry themselves."""
    if worded(name):
        return name.split()

    def cost(i: int, j: int) -> float:
        piece = name[i:j]
        held = entries.get(piece, 1)
        n, size = abs(held), j - i
        kinds = [m.group() for m in _RUN.finditer(piece)]
        if len(kinds) == 1 and re.fullmatch("[ァ-ヺー]+|[^\\W\\d_一-鿿々ぁ-ゖ]+", piece):
            cuts_word = (i and _RUN.fullmatch(name[i - 1] + piece)) or (j < len(name) and _RUN.fullmatch(piece + name[j]))
            return 3.0 * size if cuts_word else 1.0
        own = 0.5 if held < 0 and size > 1 and piece != name else 0.0
        if size == 1:
            return 1.2 if i == 0 or j == len(name) else 1.6
        if size == 2:
            return 1.0 - 0.12 * math.log(n) - own
        return (1.45 + 0.45 * (size - 3) - 0.2 * math.log(n) if n >= 3 else 1.7 + 0.9 * (size - 3)) - own

    best: list[tuple[float, int]] = [(0.0, 0)]
    for j in range(1, len(name) + 1):
        best.append(min((best[i][0] + cost(i, j), i) for i in range(j)))
    out, j = [], len(name)
    while j:
        out.append(name[best[j][1] : j])
        j = best[j][1]
    return out[::-1]


def readings_of(token: str, kanji: Mapping[str, str], others: Mapping[str, str]) -> list[str]:
    """Readings of a token in hiragana, character by character; none if a character has none."""
    found = []
    for table in (kanji, {**kanji, **others}):
        parts = [table.get(c, c if "ぁ" <= c <= "ゖ" or c == "ー" else "") for c in token.translate(HIRAGANA)]
        if all(parts):
            text = "".join(parts)
            # つ and く contract before the consonants that follow them in compounds.
            found += [text, re.sub("つ(?=[かきくけこさしすせそたちつてとはひふへほ])", "っ", text)]
    return sorted(set(found) - {token})


def cover(value: str, matches: list[tuple[int, int, str, float]], entry: list[tuple[str, float]], noise: tuple[str, ...] = NOISE) -> float:
    """The better soft TF-IDF of a value and an entry, with and without replaced characters (文警 is two initials, 光安 one misspelling)."""
    whole = _cover(value, matches, entry, noise) if len(value) > 2 else 0.0
    return max(whole, _cover(value, [m for m in matches if m[1] != len(m[2]) or m[3] > 0.7], entry, noise))


def _cover(value: str, matches: list[tuple[int, int, str, float]], entry: list[tuple[str, float]], noise: tuple[str, ...]) -> float:
    """Soft TF-IDF of a value and an entry: stated weight of the entry's tokens, times the part of the value that is used.

    A piece is used once; the surest pieces first, then the earliest."""
    free, used = set(range(len(entry))), [False] * len(value)
    stated, order = 0.0, []
    options = sorted(
        ((sim * len(token), -size, -abs(at / max(1, len(value)) - k / len(entry)), -at, k, sim) for at, size, token, sim in matches for k, (t, _) in enumerate(entry) if t == token), reverse=True
    )
    for _, size, _, at, k, sim in options:
        at, size = -at, -size
        if k in free and not any(used[at : at + size]):
            free.remove(k)
            used[at : at + size] = [True] * size
            stated += entry[k][1] * sim
            order.append((at, k))
    whole = sum(w for _, w in entry)
    if worded(value):
        stated_tokens = {t for k, (t, _) in enumerate(entry) if k not in free}
        for at, size, token, _ in matches:
            if token in stated_tokens:  # one token may take several words
                used[at : at + size] = [True] * size
        left = "".join(c for c, u in zip(value, used, strict=True) if not u and c != " ")
        part = 1 - len(left) / max(1, len(value.replace(" ", "")))
    else:
        runs = re.split(r"\0+", "".join("\0" if u else c for c, u in zip(value, used, strict=True)))
        size, left_n = len(value), 0
        for run in runs:
            kept = run
            for word in noise:
                kept = kept.replace(word, "")
            size -= len(run) - len(kept)
            left_n += len(kept)
        part = 1 - left_n / max(1, size)
    kept_order = [k for _, k in sorted(order)]
    return stated / whole * part * (1.0 if kept_order == sorted(kept_order) else 0.94) if whole else 0.0


def _variants(word: Column) -> Column:
    """A word and what is left of it without each of its letters; two words that share one are at most two edits apart."""
    shorter = F.transform(F.sequence(F.lit(1), F.length(word)), lambda i: F.concat(word.substr(F.lit(1), i - 1), word.substr(i + 1, F.length(word))))
    return F.array_distinct(F.concat(F.array(word), F.when(F.length(word) > 1, shorter).otherwise(F.array().cast("array<string>"))))


def _likeness(piece: Column, token: Column, cjk: Column) -> Column:
    """How much of the token the piece states, from 0 to 1; an expression."""
    size, edits = F.length(token), F.levenshtein(piece, token)
    swapped = (F.length(piece) == size) & (edits == 2) & (F.array_sort(F.split(piece, "")) == F.array_sort(F.split(token, "")))
    return (
        F.when(piece == token, 1.0)
        .when(swapped, 0.85)
        .when((edits == 1) & (F.length(piece) > size), F.when(cjk, 0.8).otherwise(F.greatest(F.lit(0.8), 1 - 1 / size)))
        .when((edits == 1) & (size > 1), (1 - 1 / size) * F.when(F.length(piece) < size, 1.0).otherwise(1.1))
        .when(~cjk & (edits == 2) & (size >= 6) & (F.length(piece) >= 5), 1 - 2 / size)
        .otherwise(0.0)
    )


def _is_cjk(word: Column) -> Column:
    return word.rlike("[぀-ヿ㐀-鿿]")


def vocabulary(reference: DataFrame, field: str, entry_id: str, name: str, readings: Mapping[str, str] | None, other_readings: Mapping[str, str] | None, glosses: Mapping[str, list[str]] | None) -> tuple[DataFrame, DataFrame]:
    """What is learnt of a reference list: (field, entry, tokens, prefix) of each entry, its weighed tokens and those by which it is found; and
    (field, token, spelling, base) of each token, base being what a match of that spelling is worth."""
    folded = F.pandas_udf(lambda s: s.map(fold), "string")
    listed = reference.select(F.col(field).alias("field"), F.col(entry_id).cast("bigint").alias("entry"), F.col(name).alias("name")).where("name is not null and entry is not null").withColumn("name", folded("name")).where("name <> ''")
    spots = listed.select("field", "entry", "name", F.explode(F.sequence(F.lit(1), F.length("name"))).alias("i"))
    subs = spots.select("field", "entry", "name", F.explode(F.expr("transform(sequence(1, length(name) - i + 1), n -> substring(name, i, n))")).alias("sub")).where(~F.col("sub").contains(" ")).distinct()
    counts = subs.groupBy("sub").agg((F.count_distinct("name") * F.when(F.max((F.col("sub") == F.col("name")).cast("int")) == 1, -1).otherwise(1)).alias("n")).where("abs(n) > 1 or n < 0")
    held = subs.join(counts, "sub").groupBy("field", "entry", "name").agg(F.map_from_entries(F.collect_list(F.struct("sub", "n"))).alias("held"))

    def cut(names: pd.Series, counts: pd.Series) -> pd.Series:
        return pd.Series([tokens_of(n, dict(c) if c is not None else {}) for n, c in zip(names, counts, strict=True)], dtype=object)

    cut_up = listed.join(held, ["field", "entry", "name"], "left").select("field", "entry", F.pandas_udf(cut, "array<string>")("name", "held").alias("words"))
    words = keep(cut_up.select("field", "entry", F.posexplode("words").alias("k", "token")), "canonical-words")
    sizes = words.groupBy("field").agg(F.count_distinct("entry").alias("n"))
    idf = words.groupBy("field", "token").agg(F.count_distinct("entry").alias("df")).join(sizes, "field")
    idf = idf.select("field", "token", (F.log(1 + F.col("n") / F.col("df")) * F.length("token")).alias("weight"))
    weighed = words.join(idf, ["field", "token"]).groupBy("field", "entry").agg(F.array_sort(F.collect_list(F.struct("k", "token", "weight"))).alias("t"), F.sum("weight").alias("whole"))
    # Tokens from the heaviest on, up to the point after which what is left weighs less than ACCEPT of the entry.
    heavy = F.expr("array_sort(t, (a, b) -> case when a.weight > b.weight then -1 when a.weight < b.weight then 1 else a.k - b.k end)")
    walked = F.aggregate(
        heavy,
        F.struct(F.array().cast("array<string>").alias("found"), F.col("whole").alias("left")),
        lambda a, x: F.struct(F.when(a["left"] >= ACCEPT * F.col("whole"), F.array_union(a["found"], F.array(x["token"]))).otherwise(a["found"]).alias("found"), (a["left"] - x["weight"]).alias("left")),
    )
    entries = weighed.select("field", "entry", F.expr("transform(t, x -> struct(x.token as token, x.weight as weight))").alias("tokens"), walked["found"].alias("prefix"))

    spark = reference.sparkSession
    kanji, others = dict(readings or {}), dict(other_readings or {})
    own = idf.select("field", "token", F.col("token").alias("spelling"), F.lit(1.0).alias("base"))
    read = idf.select("field", "token", F.explode(F.pandas_udf(lambda s: s.map(lambda t: readings_of(t, kanji, others)), "array<string>")("token")).alias("spelling"), F.lit(0.95).alias("base"))
    spelled = own.unionByName(read)
    if glosses:
        table = spark.createDataFrame([(w, t) for w, ts in glosses.items() for t in ts], "spelling string, term string")
        parts = idf.select("field", "token", F.explode(F.expr("flatten(transform(sequence(1, length(token)), i -> transform(sequence(1, length(token) - i + 1), n -> substring(token, i, n))))")).alias("term")).distinct()
        spelled = spelled.unionByName(parts.join(table, "term").select("field", "token", "spelling", (0.95 * F.length("term") / F.length("token")).alias("base")))
    return entries, spelled


def map_values(values: DataFrame, reference: DataFrame, field: str, value: str, entry_id: str, name: str, readings: Mapping[str, str] | None = None, other_readings: Mapping[str, str] | None = None, glosses: Mapping[str, list[str]] | None = None, noise: tuple[str, ...] = NOISE) -> DataFrame:
    """(field, value, entry id, score) for every distinct value of values that is not NULL; entry id -1 where none fits.

    values has the columns field and value; reference has field, entry_id and name. readings, other_readings and glosses: see `glossary`."""
    folded = F.pandas_udf(lambda s: s.map(fold), "string")
    typed = keep(values.select(F.col(field).alias("field"), F.col(value).alias("raw")).where("raw is not null").distinct().withColumn("value", folded("raw")), "canonical-typed")
    entries, spelled = vocabulary(reference, field, entry_id, name, readings, other_readings, glosses)
    entries, spelled = keep(entries, "canonical-entries"), keep(spelled, "canonical-spellings")
    longest = spelled.agg(F.max(F.length("spelling"))).first()[0] or 0

    # Pieces of the values: words, or all runs of up to one character more than the longest spelling.
    distinct_values = typed.select("field", "value").where("value <> ''").distinct()
    cjk = _is_cjk(F.col("value"))
    words = F.expr("transform(regexp_extract_all(value, '([^ ]+)', 1), w -> w)")
    in_words = distinct_values.where(~cjk).withColumn("w", words).select("field", "value", F.posexplode("w").alias("k", "piece"), "w").select("field", "value", F.expr("cast(aggregate(slice(w, 1, k), 0, (a, x) -> a + length(x) + 1) as int)").alias("at"), "piece")
    starts = distinct_values.where(cjk).select("field", "value", F.explode(F.sequence(F.lit(1), F.length("value"))).alias("i"))
    runs = starts.select("field", "value", (F.col("i") - 1).cast("int").alias("at"), F.explode(F.expr(f"transform(sequence(1, least({longest + 1}, length(value) - i + 1)), n -> substring(value, i, n))")).alias("piece"))
    placed = keep(in_words.unionByName(runs), "canonical-pieces")
    distinct = placed.select("field", "piece").distinct()

    spelling = F.col("spelling")
    near = distinct.withColumn("key", F.explode(_variants(F.col("piece")))).join(spelled.withColumn("key", F.explode(_variants(spelling))), ["field", "key"])
    near = near.select("field", "piece", "token", (_likeness(F.col("piece"), spelling, _is_cjk(spelling)) * F.col("base")).alias("sim"))
    # Abbreviations: the beginning of a token, one character where the script has no words, three where it has.
    begun = spelled.where(F.length("spelling") > 1).select("field", "token", "spelling", "base", F.explode(F.expr("transform(sequence(1, length(spelling) - 1), n -> substring(spelling, 1, n))")).alias("piece"))
    begun = begun.where(F.when(_is_cjk(spelling), (F.col("base") == 1.0) | (F.length("piece") > 1)).otherwise(F.length("piece") >= 3))
    share = F.length("piece") / F.length("spelling")
    initial = F.when(F.length("spelling") == 2, 0.5).when(F.length("spelling") == 3, 0.4).otherwise(0.3)
    short = distinct.join(begun, ["field", "piece"]).select("field", "piece", "token", (F.col("base") * F.when(_is_cjk(spelling) & (F.length("piece") == 1), initial).when(_is_cjk(spelling), 0.9 * share).otherwise(F.greatest(F.lit(0.6), 0.9 * share))).alias("sim"))
    matched = near.unionByName(short).where("sim > 0.25").groupBy("field", "piece", "token").agg(F.max("sim").alias("sim"))
    hits = placed.join(matched, ["field", "piece"]).groupBy("field", "value").agg(F.collect_list(F.struct("at", F.length("piece").alias("size"), "token", "sim")).alias("matches"))
    hits = keep(hits, "canonical-hits")
    found = hits.select("field", "value", F.explode(F.expr("array_distinct(transform(matches, m -> m.token))")).alias("token"))
    pairs = found.join(entries.select("field", "entry", F.explode("prefix").alias("token")), ["field", "token"]).select("field", "value", "entry").distinct()

    def scored(value_s: pd.Series, matches: pd.Series, tokens_s: pd.Series) -> pd.Series:
        return pd.Series(
            [cover(v, [(x["at"], x["size"], x["token"], x["sim"]) for x in m], [(x["token"], x["weight"]) for x in t], noise) for v, m, t in zip(value_s, matches, tokens_s, strict=True)], dtype=float
        )

    full = pairs.join(hits, ["field", "value"]).join(entries.select("field", "entry", "tokens"), ["field", "entry"])
    ranked = keep(full.select("field", "value", "entry", F.pandas_udf(scored, "double")("value", "matches", "tokens").alias("score")), "canonical-scores").where(F.col("score") >= ACCEPT)
    # The best and what comes second, each by an aggregate, so that no value ever collects its candidates.
    top = ranked.groupBy("field", "value").agg(F.max(F.struct("score", "entry")).alias("r"))
    second = ranked.join(top, ["field", "value"]).where("entry <> r.entry").groupBy("field", "value").agg(F.max("score").alias("second"))
    sure = top.join(second, ["field", "value"], "left").where(f"r.score - coalesce(second, 0) >= {MARGIN}").select("field", "value", "r.entry", "r.score")
    same = reference.where(F.col(entry_id).isNotNull()).groupBy(F.col(field).alias("field"), F.col(name).alias("raw")).agg(F.min(F.col(entry_id).cast("bigint")).alias("exact"))
    out = typed.join(sure, ["field", "value"], "left").join(same, ["field", "raw"], "left")
    return out.select(
        F.col("field").alias(field), F.col("raw").alias(value), F.coalesce("exact", "entry", F.lit(-1)).cast("bigint").alias(entry_id), F.when(F.col("exact").isNotNull(), 1.0).otherwise(F.coalesce("score", F.lit(0.0))).alias("score")
    )
