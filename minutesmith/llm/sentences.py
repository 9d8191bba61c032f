"""Sentence units for texts in several languages and scripts, in SQL expressions only.

Method: full stops that end no sentence (decimals, URLs, initials, abbreviations, everything inside brackets and quotations)
are masked by private-use characters of the same length, the masked text is cut after the terminators of its scripts, and
the sentences are taken from the original text at the positions found, so nothing has to be escaped. No Python runs.

Results that are defined: NULL and empty texts give no sentence; a text of white space gives none; a text without any
terminator is one sentence; repeated rows give repeated sentences; columns of the input other than the key and the text
are not carried. Positions count Unicode code points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Private-use characters: a masked full stop, masked terminators, quotation marks made directional, the cut, and the line break after a list item.
STOP, ENDMARK, OPEN, CLOSE, CUT, ITEM = "\ue000", "\ue001", "\ue002", "\ue003", "\ue004", "\ue005"

#: Abbreviations that are followed by a name or number and so never end a sentence.
TITLES = (
    "Mr", "Mrs", "Ms", "Dr", "Dra", "Drs", "Sr", "Sra", "Srta", "St", "Sto", "Sta", "Prof", "Profa", "Gov", "Sen", "Rep",
    "Hon", "Gen", "Col", "Capt", "Rev", "Mt", "Ft", "Messrs", "Bros", "Exmo", "Exma", "Av", "Eng", "Dep", "Ver", "Vol",
    "Vols", "Fig", "Figs", "Tab", "Eq", "Sec", "Ch", "cf", "vs", "viz", "ex", "डॉ", "श्री", "क्र", "पृ", "प्रो", "सं",
)
#: Abbreviations that are masked only where a number follows.
NUMBERED = ("No", "Nos", "Nr", "no", "n", "nº", "p", "pp", "P", "PP", "art", "Art", "cap", "Cap", "pág", "par", "págs", "fl", "fls")

BRACKETS = (("「", "」"), ("『", "』"), ("（", "）"), (r"\(", r"\)"), ("“", "”"), ("【", "】"), ("〈", "〉"), ("《", "》"), ("〔", "〕"), ("‘", "’"), ("«", "»"), (OPEN, CLOSE))
#: Terminators that are masked inside brackets and quotations.
STOPS = "。｡．！？!?।."

ENDS = r"[。｡．！？!?।॥؟۔…‥]"
CLOSERS = rf"[」』）)”’»】〉》〕\]{CLOSE}]"
#: What goes on after a closing quotation, and after a question or exclamation that is only quoted.
PARTICLES = r"(?:[、，,;；:：・]|と(?!ころ|りわけ|もに)|を|に(?!ぎ|わ)|は(?!い|じ|や)|が(?!ん)|の(?!び|ち|ぞ)|で(?!す)|も(?!っと|し|う|ち)|や(?!は|む)|など|って|か(?!ね|つ|く|な)|라|고|이라|하는|这句|的|[\s]+(?:[a-zà-öø-ÿ]|और|कि|तो))"
GOES_ON = rf"(?:{PARTICLES}|\n(?:と(?!ころ|りわけ|もに)|、|，|を)|{ENDS})"
QUOTED = r"(?:\n?(?:と(?!ころ|りわけ|もに)|って|、|，)|라는|라고)"
#: What goes on after a polite ending in spite of a line break.
JOINED = rf"(?:[、。，．！？」』）{ENDMARK}]|が(?!ん)|ので|のに|と(?!ころ|りわけ|もに)|から|けれ|けど|し[、，]|か[。．？！\s]|ね[。．]|よ[。．う]|もの[の、])"
#: Endings of polite Japanese sentences: there a line break or a wide space may end a sentence without an end mark.
POLITE = r"(?:ます|です|ました|でした|ません|でしょう|ましょう|ください|下さい)(?:か|ね|よ)?"
MARKER = r"(?:・|[(（][0-9０-９]{1,3}[)）]|[①-⑳]|[0-9０-９]{1,3}[)）]|[-*•◆■●○◎▼▽]|第[0-9０-９一二三四五六七八九十]{1,3}[　 、])"


def mask(text: Column) -> Column:
    """text with every terminator that ends no sentence replaced, character by character."""
    names, numbered = "|".join(TITLES), "|".join(NUMBERED)
    m = F.regexp_replace(text, r'"([^"]*+)"', f"{OPEN}$1{CLOSE}")
    m = F.regexp_replace(m, r"(?<=[0-9０-９])[.．](?=\n?[0-9０-９])", STOP)
    # Inside an address, from its beginning or from the stop masked last, however long it is.
    m = F.regexp_replace(m, r"((?:https?://|www(?=\.)|\G(?!^))[^\s　、。「」（）.?!]*+(?:[.?!](?![A-Za-z0-9/_%&=-])[^\s　、。「」（）.?!]*+)*+)[.?!](?=[A-Za-z0-9/_%&=-])", f"$1{STOP}")
    m = F.regexp_replace(m, r"(?<=[A-Za-z0-9_-])\.(?=[a-z0-9_-]{2,}[.@/])", STOP)
    m = F.regexp_replace(m, r"((?:@|\G(?!^))[A-Za-z0-9-]++)\.(?=[A-Za-z])", f"$1{STOP}")
    m = F.regexp_replace(m, r"(?<![A-Za-z])((?:[A-Z]|Ph))\.(?=\s?[A-Z]\.|\s[A-Z][a-z])", f"$1{STOP}")
    m = F.regexp_replace(m, rf"(?<={STOP})([A-Z])\.(?=\s?[^\sA-Za-z])", f"$1{STOP}")
    m = F.regexp_replace(m, rf"(?<![\p{{L}}\p{{M}}])({names})\.(?=\s|[0-9])", f"$1{STOP}")
    m = F.regexp_replace(m, rf"(?<![\p{{L}}\p{{M}}])({numbered})\.(?=\s?[0-9])", f"$1{STOP}")
    for opening, closing in BRACKETS:
        # From an opening mark whose closing mark follows, however far, or from the last terminator masked behind it, to the next terminator.
        m = F.regexp_replace(m, rf"((?:{opening}(?=[^{opening}{closing}]*+{closing})|\G(?!^))[^{opening}{closing}{STOPS}]*+)[{STOPS}]", f"$1{ENDMARK}")
    # The line break after a list item, however long the item is.
    return F.regexp_replace(m, rf"((?<=(?:^|[\n。．！？])[ 　]{{0,3}}){MARKER}[^\n。．！？]++)\n", f"$1{ITEM}")


def pieces(masked: Column) -> Column:
    """Array of the pieces of a masked text; together they are the text."""
    # A full stop ends a sentence at once, a question or exclamation mark unless the text quotes it; a run is never cut.
    full = rf"[。｡．।॥۔！？!?؟]*[。｡．।॥۔][。｡．।॥۔！？!?؟]*+(?:\n[。！？]++)*+(?:{CLOSERS}++(?!{GOES_ON}))?+(?!{CLOSERS})"
    asked = rf"[！？!?؟]++(?:\n[。！？]++)*+(?:(?!{CLOSERS}|{QUOTED}|{ENDS}|\\s+[a-zà-öø-ÿ])|{CLOSERS}++(?!{GOES_ON}))"
    latin = rf"(?=\.)(?<=[\p{{L}}\p{{M}}\p{{N}}%％°)\]{CLOSE}{STOP}])\.+{CLOSERS}*(?=\s+[^\sa-zà-öø-ÿ]|\s*$)"
    local = r"(?=\.)(?<=[\p{IsHangul}\p{IsHiragana}\p{IsKatakana}\p{IsHan}\p{IsDevanagari}])\." + rf"{CLOSERS}*(?!\S{{0,3}}\.)(?!{GOES_ON})"
    held = rf"{ENDMARK}+{CLOSERS}+(?!{GOES_ON})(?![\s]*$)"
    item = rf"(?={ITEM})"
    before = rf"(?=\n)(?<=[^\n{ITEM}])(?=\n[ 　]{{0,3}}{MARKER})"
    polite = rf"(?=[ 　\n{ITEM}])(?<={POLITE})(?=[ 　\n{ITEM}]+[^ 　\n{ITEM}])(?![ 　\n{ITEM}]*{JOINED})"
    rule = "|".join([f"{full}|{asked}", held, latin, local, item, before, polite])
    return F.split(F.translate(F.regexp_replace(masked, f"(?s)(?:{rule})", f"$0{CUT}"), ITEM, "\n"), CUT)


def ends(text: Column) -> Column:
    """Array of the end positions of the sentences, in code points from the start of the text."""
    parts = F.transform(
        pieces(mask(text)),
        lambda p: F.struct(F.length(p).alias("n"), F.length(F.regexp_replace(p, r"(?U)[\s　]+$", "")).alias("kept")),
    )
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("found"))
    walked = F.aggregate(
        parts,
        zero,
        lambda a, p: F.struct(
            (a["at"] + p["n"]).alias("at"),
            F.when(p["kept"] > 0, F.concat(a["found"], F.array(a["at"] + p["kept"]))).otherwise(a["found"]).alias("found"),
        ),
    )
    return walked["found"]


def sentences(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, sentence_no, start_char, end_char, sentence) of every sentence; sentence_no from 1, start_char from 0."""
    found = df.select(F.col(key).alias("k"), F.col(text).alias("t")).where(F.length("t") > 0).withColumn("e", ends(F.col("t")))
    rows = found.select("k", "t", "e", F.posexplode("e").alias("i", "end_char"))
    before = F.when(F.col("i") > 0, F.expr("e[i - 1]")).otherwise(0)
    raw = F.substring(F.col("t"), before + 1, F.col("end_char") - before)
    clean = F.regexp_replace(raw, r"(?U)^[\s　]+", "")
    return rows.select(F.col("k").alias(key), (F.col("i") + 1).alias("sentence_no"), (F.col("end_char") - F.length(clean)).alias("start_char"), "end_char", clean.alias("sentence"))
