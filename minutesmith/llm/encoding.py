"""Texts decoded with the wrong character encoding: found, and restored where nothing was lost.

Method: best-first graph search. A state is a text; an edge encodes it with one encoding and decodes it with another, or
unescapes it; a cost of implausible characters (PLAUSIBLE below, built from the standard's own character sets) orders the queue,
visited states are known by hash, and the cheapest text reached is the answer. Only the damaged span of a text is searched, so
half-damaged texts keep their sound half. Finding spans is vectorised over whole batches; the search runs on those few only.

Results that are defined: NULL and empty texts are sound; a text is damaged if a span of it is implausible and either a
cheaper text can be reached or characters were lost (U+FFFD, C1 controls, private use); `restored` is NULL where characters
were lost or nothing better was found; texts of any length are read whole; repeated rows get equal results; other columns
are untouched.
"""

from __future__ import annotations

import codecs
import heapq
import html
import re
from collections.abc import Iterator
from functools import cache
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Encodings of one byte, undone run by run in the whole text, and what the bytes may really have been.
SINGLE = ("latin-1", "cp1252", "mac_roman", "cp1251", "koi8_r", "cp866", "cp1250", "cp437")
DECODINGS = ("utf-8", "cp932", "euc_jp", "cp949", "gb18030")
#: Pairs (encode, decode) of encodings of several bytes, undone on damaged spans.
DOUBLE = tuple((e, tuple(d for d in ("utf-8", "euc_jp", "cp932", "cp949", "gb18030") if d != e)) for e in ("cp932", "euc_jp", "cp949", "gb18030", "big5hkscs", "utf-8"))
SHIFTS = ((0, 0), *((a, b) for a in (0, -1, 1, -2, 2, -3) for b in (0, 1, -1, 2, -2, 3) if a or b))
#: Look-alike letters, Greek and Cyrillic: another operator's concern, so cheap.
LOOKALIKE = "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧαικνορτυχνωςАВЕЅІЈКМНОРСТУХЅѴаеѕіјорсухѵԁһԛԝьҮүӏ"
WINDOW, SUSPECT, CERTAIN = 8, 4.25, 6.0
CLEAN = "utf-8, every byte"
#: Share of its price at which a text queues, by its reading: bytes that happen to be UTF-8 are rare, whole texts of them hardly chance.
PRIOR = {"utf-8": 0.2, CLEAN: 0.02}
GOAL = 0.1  # mean cost of a character at which the search is over
_ESCAPE = re.compile(r"\\u([0-9a-fA-F]{4})")
_ESCAPED = re.compile(r"&#?\w+;|\\u[0-9a-fA-F]{4}")
LOST = re.compile("[�\ue000-\uf8ff\x80-\x9f]")
HAN, HANGUL, KANA, HALF, LATIN, CYRILLIC, GREEK, DEVANAGARI, OTHER, NEUTRAL = range(10)


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cost of each character of the basic plane, its script family, and the cost of neighbouring families."""
    cost, family = np.full(65536, 2.0, np.float32), np.full(65536, OTHER, np.uint8)

    def put(a: int, b: int, c: float, f: int) -> None:
        cost[a : b + 1], family[a : b + 1] = c, f

    put(0x00, 0x1F, 3, NEUTRAL)
    for c in (9, 10, 13):
        put(c, c, 0, NEUTRAL)
    put(0x20, 0x7E, 0, NEUTRAL)
    put(0x7F, 0x9F, 3, OTHER)
    put(0xA0, 0xA0, 0.3, NEUTRAL)
    put(0xA1, 0xBF, 1.5, LATIN)
    for ch in "·°§±²³«»ªº×":
        put(ord(ch), ord(ch), 0.8, LATIN)
    put(0xAD, 0xAD, 0.3, NEUTRAL)
    put(0xC0, 0xFF, 0.9, LATIN)
    for ch in "ÁÉÍÓÚÀÂÊÔÃÕÇáéíóúàâêôãõçüñÜÑ":
        put(ord(ch), ord(ch), 0.35, LATIN)
    put(0x100, 0x24F, 1.5, LATIN)
    put(0x250, 0x2FF, 2, OTHER)
    put(0x300, 0x36F, 0.3, NEUTRAL)
    put(0x370, 0x3FF, 1.5, GREEK)
    put(0x400, 0x52F, 1.5, CYRILLIC)
    for ch in LOOKALIKE:
        put(ord(ch), ord(ch), 0.3, NEUTRAL)
    put(0x900, 0x97F, 0, DEVANAGARI)
    put(0x1100, 0x11FF, 0.1, HANGUL)
    put(0x2000, 0x206F, 0.3, NEUTRAL)
    for ch in "‘’“”…—–‐‑―※‥〜":
        put(ord(ch), ord(ch), 0.1, NEUTRAL)
    put(0x20A0, 0x20CF, 1, OTHER)
    put(0x2100, 0x24FF, 0.8, OTHER)
    put(0x2460, 0x2473, 0.1, NEUTRAL)
    put(0x2500, 0x25FF, 1, OTHER)
    put(0x2F00, 0x2FDF, 0.1, HAN)
    put(0x2E80, 0x2EFF, 0.3, HAN)
    put(0x3000, 0x303F, 0, NEUTRAL)
    put(0x3040, 0x30FF, 0, KANA)
    put(0x3099, 0x309A, 0.1, NEUTRAL)
    put(0x3130, 0x318F, 0.5, HANGUL)
    put(0x3400, 0x4DBF, 2.5, HAN)
    put(0x4E00, 0x9FFF, 2.2, HAN)
    put(0xAC00, 0xD7A3, 1.6, HANGUL)
    put(0xD800, 0xDFFF, 1, OTHER)
    put(0xE000, 0xF8FF, 3, OTHER)
    put(0xF900, 0xFAFF, 0.3, HAN)
    put(0xFE00, 0xFE0F, 0.2, NEUTRAL)
    put(0xFEFF, 0xFEFF, 0.2, NEUTRAL)
    put(0xFF01, 0xFF60, 0.1, NEUTRAL)
    put(0xFF61, 0xFF9F, 0.5, HALF)
    put(0xFFE0, 0xFFE6, 0.2, NEUTRAL)
    put(0xFFFD, 0xFFFD, 4.5, OTHER)
    for lead in (*range(0x81, 0xA0), *range(0xE0, 0xFD)):
        for trail in range(0x40, 0xFD):
            try:
                ch = bytes((lead, trail)).decode("cp932")
            except UnicodeDecodeError:
                continue
            if len(ch) == 1 and 0x4E00 <= ord(ch) <= 0x9FFF:
                put(ord(ch), ord(ch), 0.12 if lead < 0x98 or (lead == 0x98 and trail <= 0x72) else 1.0, HAN)
    for lead in range(0xB0, 0xF8):
        for trail in range(0xA1, 0xFF):
            try:
                ch = bytes((lead, trail)).decode("gb2312")
            except UnicodeDecodeError:
                continue
            if cost[ord(ch)] > 0.3:
                cost[ord(ch)] = 0.3 if lead < 0xD8 else 1.0
    for lead in range(0xB0, 0xC9):
        for trail in range(0xA1, 0xFF):
            ch = bytes((lead, trail)).decode("euc_kr")
            put(ord(ch), ord(ch), 0.05, HANGUL)
    pair = np.zeros((10, 10), np.float32)
    for a in range(NEUTRAL):
        for b in range(NEUTRAL):
            if a != b:
                pair[a, b] = 0.7
    for a, b, c in ((HAN, KANA, 0), (KANA, HALF, 0.1), (HAN, HALF, 0.15), (LATIN, CYRILLIC, 0.5), (HALF, HALF, 0)):
        pair[a, b] = pair[b, a] = c
    pair[LATIN, LATIN] = 0.45  # accented letters stand between plain ones
    pair[CYRILLIC, CYRILLIC] = 0.3
    pair[GREEK, GREEK] = 0.3
    return cost, family, pair


def _costs(points: np.ndarray) -> np.ndarray:
    """Cost at each character, its own and that of the seam before it."""
    cost, family, pair = _tables()
    low = np.minimum(points, 0xFFFF)
    c = np.where(points > 0xFFFF, 1.0, cost[low]).astype(np.float32)
    f = family[low]
    if len(points) < 2:
        return c
    c[1:] += pair[f[:-1], f[1:]]
    # An accent that stands on no letter of an alphabet.
    c[1:] += 3.0 * ((low[1:] >= 0x300) & (low[1:] <= 0x36F) & ((f[:-1] == HAN) | (f[:-1] == HANGUL) | (f[:-1] == HALF)))
    # UTF-8 of accented letters read by single-byte encodings: these pairs do not occur otherwise.
    a, b = low[:-1], low[1:]
    tail = ((b >= 0x80) & (b <= 0xBF)) | ((b >= 0x2000) & (b <= 0x2122)) | (b == 0x192) | (b == 0x2C6) | (b == 0x2DC) | (b == 0x152) | (b == 0x153) | (b == 0x160) | (b == 0x161) | (b == 0x178) | (b == 0x17D) | (b == 0x17E)
    c[:-1] += 4.5 * (((a == 0xC2) | (a == 0xC3)) & tail | (a == 0x221A) & (b >= 0x80) | ((a == 0x413) | (a == 0x412)) & (b >= 0x80) & (b < 0x3000) & (b != 0x410))
    # An East Asian character inside a word of small Latin letters.
    small = (low >= 0x61) & (low <= 0x7A)
    c[1:-1] += 3.0 * (small[:-2] & (low[1:-1] >= 0x3130) & (low[1:-1] < 0xFF9F) & (low[1:-1] != 0x3000) & (small[2:] | (low[2:] >= 0x3130) & (low[2:] != 0xFF01)) & ((f[1:-1] == HAN) | (f[1:-1] == HANGUL) | (f[1:-1] == HALF)))
    return c


def price(text: str) -> float:
    return float(_costs(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)).sum()) if text else 0.0


def _profile(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Cost at each character, and of the window that begins there."""
    pad = np.full(WINDOW, 0x20, np.uint32)
    costs = _costs(np.concatenate([np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), pad]))
    return costs[: len(text)], np.convolve(costs, np.ones(WINDOW, np.float32))[WINDOW - 1 :][: len(text)]


def spans(costs: np.ndarray, sums: np.ndarray) -> list[tuple[int, int]]:
    """Stretches of the text in which every window is implausible, cut back to their first and last costly character."""
    hot = np.flatnonzero(sums >= SUSPECT)
    found: list[tuple[int, int]] = []
    for at in hot:
        if found and at <= found[-1][1] + 2 * WINDOW:
            found[-1] = (found[-1][0], int(at) + WINDOW)
        else:
            found.append((int(at), int(at) + WINDOW))
    out = []
    for a, b in found:
        inside = np.flatnonzero(costs[a:b] >= 0.5)
        if not len(inside):
            continue
        a, b = a + int(inside[0]), a + int(inside[-1]) + 1
        # Costly characters near a stretch belong to it.
        while len(near := np.flatnonzero(costs[max(0, a - WINDOW) : a] >= 0.5)):
            a = max(0, a - WINDOW) + int(near[0])
        while len(near := np.flatnonzero(costs[b : b + WINDOW] >= 0.5)):
            b += int(near[-1]) + 1
        out.append((a, b))
    return out


@cache
def _single(encoding: str) -> tuple[re.Pattern[str], dict[str, int], list[str]]:
    """Runs of characters that encoding can write with one of its upper half among them, and its character and byte tables.

    Bytes that stand for nothing there were kept as C1 controls by the wrong decoder, and are taken so."""
    chars = []
    for byte in range(256):
        try:
            ch = bytes((byte,)).decode(encoding)
        except UnicodeDecodeError:
            ch = chr(byte)
        chars.append(ch)
    to_byte = {ch: byte for byte, ch in reversed(list(enumerate(chars)))}
    if encoding != "latin-1":  # a no-break space is often kept, too
        to_byte.setdefault("\xa0", 0xA0)
        for byte in range(0x80, 0xA0):
            to_byte.setdefault(chr(byte), byte)
    upper = re.escape("".join(ch for ch, byte in to_byte.items() if byte >= 0x80))
    return re.compile(f"[\\x00-\\x7f]*?[{upper}][\\x00-\\x7f{upper}]*"), to_byte, chars


def _undo_single(text: str, encoding: str) -> Iterator[tuple[str, str]]:
    """text with every run that encoding can write read again; bytes that a decoding cannot read stay the characters they were."""
    runs, to_byte, chars = _single(encoding)
    name = f"keep-{encoding}"

    def keep(error: UnicodeError) -> tuple[str, int]:
        return "".join(chars[x] for x in error.object[error.start : error.end]), error.end

    codecs.register_error(name, keep)
    parts, done = [], 0
    for m in runs.finditer(text):
        parts.append((text[done : m.start()], bytes([to_byte[ch] for ch in m.group()])))
        done = m.end()
    if parts:
        for d in DECODINGS:
            read = "".join(x for sound, raw in parts for x in (sound, raw.decode(d, name))) + text[done:]
            yield read, CLEAN if d == "utf-8" and all(_valid(raw) for _, raw in parts) else d


def _valid(raw: bytes) -> bool:
    try:
        raw.decode("utf-8")
    except UnicodeDecodeError:
        return False
    return True


def _edges(text: str) -> Iterator[tuple[str, str]]:
    """Texts one operation away, and the decoding that read them."""
    if "&" in text and (plain := html.unescape(text)) != text:
        yield plain, "unescape"
    if "\\" in text and re.search(r"\\u[0-9a-fA-F]{4}", text):
        yield re.sub(r"\\u([0-9a-fA-F]{4})", lambda m: chr(int(m[1], 16)), text), "unescape"
    for e in SINGLE:
        yield from _undo_single(text, e)
    places = spans(*_profile(text))
    for e, decodings in DOUBLE:
        try:
            for a, b in places:
                text[a:b].encode(e)
        except UnicodeError:
            continue
        for d in decodings:
            # The damaged bytes may begin or end inside what is now one character, so the ends of a span are moved a little.
            parts, done = [], 0
            for a, b in places:
                for da, db in SHIFTS:
                    x, y = max(done, a + da), min(len(text), b + db)
                    try:
                        read = text[x:y].encode(e).decode(d) if y - x > 1 else ""
                    except UnicodeError:
                        continue
                    if read:
                        parts += [text[done:x], read]
                        done = y
                        break
            if parts:
                yield "".join([*parts, text[done:]]), d


def repair(text: str) -> str:
    """The cheapest text that can be reached; text itself if none is clearly cheaper."""
    order, best, best_price = count(), text, price(text)
    queue, seen = [(best_price, next(order), best_price, text)], {hash(text)}
    while queue:
        promise, _, parent, state = heapq.heappop(queue)
        if promise > best_price:  # nothing that is left promises to become cheaper than what was reached
            break
        if parent <= GOAL * len(state) and state != text:
            return state
        for reached, decoding in _edges(state):
            if len(reached) <= len(state) and (h := hash(reached)) not in seen:
                seen.add(h)
                p = price(reached)
                if p < best_price:
                    best, best_price = reached, p
                    if p <= GOAL * len(reached) and decoding in PRIOR:
                        return best
                if p < parent - 1:  # undoing a wrong decoding makes a text more plausible
                    heapq.heappush(queue, (p * PRIOR.get(decoding, 1), next(order), p, reached))
    return best


def plain(text: str) -> str:
    """text without character references and \\u escapes, however often they were escaped."""
    while True:
        bare = html.unescape(text) if "&" in text else text
        bare = _ESCAPE.sub(lambda m: chr(int(m[1], 16)), bare) if "\\u" in bare else bare
        if bare == text:
            return text.encode("utf-16", "surrogatepass").decode("utf-16", "replace")
        text = bare


def mend(text: str) -> tuple[bool, str | None]:
    """Whether a suspicious text is damaged, and the whole text restored if nothing was lost."""
    peak = float(_profile(text)[1].max(initial=0.0))
    if "\ufffd" in text:  # bytes are gone, so no decoding can be undone exactly
        return True, None
    fixed = repair(text)
    gain = price(text) - price(fixed)
    if fixed == text or gain < 1.5:
        return peak >= CERTAIN or bool(LOST.search(text)), None
    left = float(_profile(fixed)[1].max(initial=0.0))
    return True, fixed if left < SUSPECT and not LOST.search(fixed) else None


def examine(texts: list[str | None]) -> list[tuple[bool, str | None]]:
    """(damaged, restored) of each text."""
    out: list[tuple[bool, str | None]] = [(False, None)] * len(texts)
    # Escapes hide the characters they stand for, so they are undone before anything is judged.
    kept = [(i, plain(t) if _ESCAPED.search(t) else t) for i, t in enumerate(texts) if t]
    if not kept:
        return out
    points = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for _, t in kept]
    pad = np.full(WINDOW, 0x20, np.uint32)
    joined = np.concatenate([p for q in points for p in (q, pad)])
    costs = _costs(joined)
    sums = np.convolve(costs, np.ones(WINDOW, np.float32))[WINDOW - 1 :]
    at = 0
    starts = []
    for p in points:
        starts.append(at)
        at += len(p) + WINDOW
    suspicious = np.add.reduceat((sums >= SUSPECT).astype(np.int32), starts)
    for (i, text), n in zip(kept, suspicious, strict=True):
        if n:
            out[i] = mend(text)
    return out


def check_encoding(text: Column) -> Column:
    """struct<damaged, restored> of a string column."""

    def f(s: pd.Series) -> pd.DataFrame:
        found = examine(s.tolist())
        return pd.DataFrame({"damaged": [d for d, _ in found], "restored": [r for _, r in found]})

    return F.pandas_udf(f, "damaged boolean, restored string")(text)
