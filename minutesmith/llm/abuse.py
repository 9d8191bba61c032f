"""Scores of abusive, hateful and sexual language, for texts in several languages and in disguise.

Method: Levenshtein automata intersected with a lexicon trie. A text is folded to a stream of letters (full width, kana,
separators and laughter marks are disguise); where a third or half of a term stands unchanged (one pass of a keyword automaton;
by the pigeonhole principle no match within the allowed edits is lost), the automaton of the stream around it walks the trie.

The lexicon has classes of general words (insults, words that deny others to be human, threats, sexual words, words for the person
addressed and for groups), which count half alone and whole beside a target in their sentence; and the phrases that `learn` finds to
be peculiar to flagged documents of a reviewed sample. A context window tells quotation and report from abuse: a term inside
quotation marks that the words around report counts a tenth, and so do short terms among words of debate.

Results that are defined: NULL and empty texts score 0; a text scores its worst sentence, from 0 to 3; 1 and more is
flagged; texts of any length are read whole; equal texts get equal scores; a NULL source is a source of its own in rates;
columns of the input other than those named are not carried; without reviewed documents the general words stand alone.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from minutesmith.llm.japanese import HIRAGANA, MODERN
from minutesmith.runtime import keep

try:
    import ahocorasick
except ImportError:  # the regular expression below is slower but finds the same
    ahocorasick = None

#: General words by class; a parameter of the operator. `you` and `group` are no abuse themselves, but make what stands beside them such.
WORDS: dict[str, str] = {
    "you": "おまえ|お前|てめえ|てめぇ|貴様|きさま|あんた|アンタ|こいつ|おのれ|あの女|you|your|you're|youre|yourself|你|你们|您|너|너희|네놈|당신|você|voce|vocês|seu|sua|तू|तुम|तुझे|तुम्हारी",
    "group": "外国人|移民|難民|在日|朝鮮人|韓国人|中国人|支那|ユダヤ人|黒人|イスラム教徒|同性愛者|障害者|障害のある|生活保護の連中|在留者|女ども|年寄り|老人|よそ者|信者|LGBT|老害|部落|連中|やつら|奴ら"
    "|女は|女を|女なんぞ|people|immigrants|foreigners|refugees|migrants|jews|muslims|blacks|gays|homosexuals|gypsies|women|disabled people|that race|those people"
    "|外国人|外地人|移民|难民|黑人|犹太人|同性恋|残疾人|놈들|사람들|외국인|이민자|난민|장애인|동성애자|imigrantes|estrangeiros|refugiados|negros|judeus|gays|deficientes|लोग|विदेशी|शरणार्थी|मुसलमान|दलित|विकलांग",
    "insult": "馬鹿|ばか野郎|バカ野郎|大ばか|あほんだら|アホ|くず野郎|クズ|ゴミ野郎|かす野郎|能なし|能無し|間抜け|まぬけ|腰抜け|恥さらし|恥知らず|役立たず|税金泥棒|嘘つき野郎|ろくでなし|ボケ|ぼけなす|クソ野郎|くそったれ|ブス|ババア|ジジイ|キモい|死に損ない|気違い|白痴|低能|無能|大ばか|豚野郎|消えろ|失せろ|黙れ|みたいなゴミ|みたいなかす|かすめ|くずめ|ばかめ|あほめ|引っ込んで|引っ込め|吐き気がする|ぽんこつ|人間のくず|生きる価値"
    "|idiot|moron|imbecile|stupid|worthless|pathetic|scum|human trash|human garbage|piece of trash|are garbage|loser|bastard|bitch|whore|slut|asshole|dumbass|cretin|retard|piece of shit|son of a bitch|motherfucker|shut up|fuck|disgusting pig"
    "|白痴|蠢货|混蛋|傻逼|王八蛋|废物|贱人|滚开|滚出|都是垃圾|闭嘴|狗东西|멍청|바보|놈아|집어치우|쓰레기다|쓰레기 같은|인간 쓰레기|병신|씨발|개새끼|닥쳐|꺼져|미친놈|idiota|imbecil|burro|seu lixo|é um lixo|merda|puta|filho da puta|vagabund|otário|cala a boca|estúpid|inútil|मूर्ख|निकम्मे|बेवकूफ|कमीने|हरामी|कुत्ते की औलाद|चुप रह|गधे",
    "vermin": "害虫|寄生虫|ゴキブリ|蛆虫|うじ虫|人間じゃない|人間ではない|下等な|劣等|劣った血|血が汚れ|血が濁|生まれつき劣|汚らわしい|vermin|subhuman|cockroaches|parasites|filthy|inferior race|害虫|寄生虫|蟑螂|劣等|벌레|기생충|바퀴벌레|praga|parasitas|baratas|sub-humanos|ratos imundos|कीड़े|परजीवी|नीच",
    "harm": "叩き出せ|たたき出せ|追い出せ|追い払え|国へ帰れ|国に帰れ|皆殺し|殺せ|殺してしまえ|駆除しろ|駆除すべき|駆除せよ|絶滅させ|ガス室|根絶やし|隔離しろ|焼き払え|石を投げて|近寄るな|口を出すな|街が汚れる|子孫を残させるな|選挙権はいらない"
    "|should be gassed|should be killed|should be shot|should be exterminated|should all die|should be hanged|must be exterminated|gas the|gas them|gas all|kill all|kill them all|exterminate|send them all back|throw them out|throw all of them out|deport them all|wiped out|lynch"
    "|赶出去|滚出|全部赶走|杀光|消灭|쫓아내라|죽여라|몰아내|없애버려|fora todos|expulsem|deviam morrer|matem todos|exterminar|सबको भगाओ|मार डालो|भगा दो",
    "threat": "殺してやる|ぶっ殺|殺すぞ|死ね|氏ね|タヒね|死んでしまえ|死んじまえ|死んで詫び|死ねばいい|死んだほうがまし|くたばれ|地獄に落ちろ|首を吊れ|夜道に気をつけろ|家まで行くぞ|家族がどうなっても|犯してやる|レイプしてやる|強姦してやる|刺してやる|殴り殺|消え失せろ|息をするな|生きてる価値がない|生きている価値がない"
    "|kill yourself|go die|drop dead|go to hell|i will kill you|ill kill you|i will rape|ill rape|rape you|raped to death|gonna rape|going to rape|hope you die|hope you get raped|hope you rot|you deserve to die|shut up and die|i know where you live|burn in hell|slit your throat"
    "|去死|杀了你|弄死你|不得好死|죽어버려|죽어라|죽여버|뒈져|vai morrer|que morra|morra seu|morra sua|vou te matar|te mato|vou te estuprar|vá para o inferno|जा मर|मर जा|मार डालूंगा|जान से मार",
    "sexual": "裸を見せろ|裸になれ|服を脱げ|脱いで見せろ|脱げよ|下着は何色|下着を見せろ|抱かせろ|やらせろ|一発やらせ|一晩やりたい|胸を揉ませ|乳を揉ませ|尻を振|股を開け|足を開け|くわえろ|しゃぶれ|舐めさせろ|舐めたい|濡れてる|いやらしい体|犯したい|体を見せろ|スカートの中|ちんこ|まんこ|セックスしろ"
    "|suck my|blow me|strip for|take off your clothes|take your clothes off|show me your tits|show us your tits|your tits|get you naked|get naked|spread your legs|bend over for|sleep with me|sit on my|want to fuck you|fuck you hard|your pussy"
    "|脱光|脱衣服给|陪我睡|给我看你的胸|옷이나 벗|벗어라|가슴 보여|자자고|tira a roupa|tire a roupa|mostra os peitos|chupa|quero te comer|abre as pernas|gostosa|कपड़े उतार|नंगी|मेरे साथ सो",
}
CATEGORY = {"insult": "abuse", "threat": "abuse", "vermin": "hate", "harm": "hate", "sexual": "sexual"}
#: What a word of a class counts alone, and what it gains by an addressed person or a group in its sentence.
WEIGHT = {"insult": 0.5, "threat": 1.0, "vermin": 0.45, "harm": 0.45, "sexual": 1.0, "you": 0.0, "group": 0.0}
GAIN = {("insult", "you"): 0.5, ("insult", "group"): 0.3, ("threat", "you"): 0.3, ("threat", "group"): 0.3, ("vermin", "group"): 0.55, ("harm", "group"): 0.55, ("vermin", "you"): 0.55, ("sexual", "you"): 0.5}
#: Reviewed documents that `learn` reads at most, phrases it keeps at most, and how sure it must be (a G statistic).
LABELLED, PHRASES, SURE = 50_000, 20_000, 24.0
#: Words that report or debate what others said.
REPORTS = (
    "など|という|とい[うっ]|と書き込|と呼ば|と言わ|と発言|との声|との不規則|とのや[じジ]|とされ|と叫|と投稿|訴え|相談(?=が|を受|も)|報告(?!によ)|中傷|被害|差別的|暴言|ヤジ|やじ|発言がありました|取り消|撤回|条例|対策|防止|啓発"
    "|发言|言论|条例|歧视|举报|발언|표현|대책|신고|ordinance|reported|quoted|debated|insult|slur|discurso|debatid|denúncia|contra o|चर्चा|शिकायत|नियम|अपशब्द"
)
FLAG = 1.0
AROUND = 16  # letters of the context window on either side
_REPORT = re.compile(REPORTS)
_QUOTES = re.compile(r"「[^「」]*」|『[^『』]*』|“[^“”]*”|\"[^\"\n]+\"")
_END = re.compile(r"[。！？!?।\n]|(?<=\w{3})\.(?=\s|$)|(?<=[가-힣])\.")
_LAUGH = re.compile(r"[\(（]笑[\)）]|(?<=[^\x00-\x7f])[wｗ]+|[wｗ]+(?=[^\x00-\x7f])|\b[wｗ]{2,}\b")
_LAUGHS = re.compile("[wｗ笑]")  # without one of these nothing laughs
_LATIN = re.compile("[a-zà-öø-ÿ]")


def _fold_char(ch: str) -> str:
    folded = unicodedata.normalize("NFKC", ch).lower().translate(MODERN).translate(HIRAGANA)
    return "".join({"ヵ": "か", "ヶ": "け", "ゕ": "か", "ゖ": "け"}.get(c, c) for c in folded if unicodedata.category(c)[0] in "LM" and c not in "\ufe00\ufe0f")


class _Folder(dict):
    """Translation table that is filled as characters are met; sentence ends become line breaks, other signs vanish."""

    def __missing__(self, point: int) -> str:
        ch = chr(point)
        out = "\n" if ch in "。！？!?।\n｡" else "く" if ch in "＜" else "力" if ch == "力" else _fold_char(ch)
        self[point] = out
        return out


_FOLD = _Folder()


def fold(text: str) -> str:
    """The letters of a text: one stream, with line breaks where sentences end."""
    return (_LAUGH.sub("", text) if _LAUGHS.search(text) else text).translate(_FOLD).replace("力す", "かす").replace("力ス", "かす")


def allowed(term: str) -> int:
    """Edits a term may differ by."""
    return 0 if len(term) < 5 else 1 if len(term) < (14 if term.isascii() else 10) else 2


class Trie:
    """The lexicon. The branches that a walk takes are those of sorted terms: each goes on from the row of the letters it shares with the last."""

    def __init__(self, words: dict[str, str], phrases: tuple[tuple[str, str, float], ...] = ()) -> None:
        self.terms: list[tuple[str, str, float]] = []  # (term, class or category, weight)
        self.pieces: dict[str, set[tuple[int, int]]] = {}
        known = {(fold(raw).replace("\n", ""), kind): WEIGHT[kind] for kind, joined in words.items() for raw in joined.split("|")}
        for (term, kind), weight in known.items():
            self._add(term, kind, weight)
        for term, category, weight in phrases:
            if (term, category) not in known:
                self._add(term, category, weight)
        self.edits = [allowed(term) for term, *_ in self.terms]
        self.letters = [set(term) for term, *_ in self.terms]
        self.needs = [len(term) + 4 if k else 0 for (term, *_), k in zip(self.terms, self.edits, strict=True)]
        if ahocorasick:
            self.machine = ahocorasick.Automaton()
            for piece, uses in self.pieces.items():
                self.machine.add_word(piece, (len(piece), tuple(uses)))
            self.machine.make_automaton()
        else:
            self.pattern = re.compile("(?=(" + "|".join(sorted(map(re.escape, self.pieces), key=len, reverse=True)) + "))")

    def _add(self, term: str, category: str, weight: float) -> None:
        number = len(self.terms)
        self.terms.append((term, category, weight))
        k = allowed(term)
        # k edits leave one of k + 1 pieces untouched.
        step = -(-len(term) // (k + 1))
        for at in range(0, len(term), step):
            self.pieces.setdefault(term[at : at + step], set()).add((number, at))
            if k and at:  # an exchange of the letters on either side of a cut touches both pieces, so it is a piece itself
                both = term[at - step : at - 1] + term[at] + term[at - 1] + term[at + 1 : at + step]
                self.pieces.setdefault(both, set()).add((number, at - step))

    def seeds(self, stream: str) -> Iterator[tuple[int, int]]:
        """(place, term number): where a term may begin, give or take its allowed edits."""
        if ahocorasick:
            for end, (size, uses) in self.machine.iter(stream):
                for number, offset in uses:
                    yield end - size + 1 - offset, number
        else:
            for m in self.pattern.finditer(stream):
                for piece in (m.group(1)[:n] for n in range(1, len(m.group(1)) + 1)):
                    for number, offset in self.pieces.get(piece, ()):
                        yield m.start() - offset, number

    def walk(self, stream: str, start: int, wanted: set[int]) -> dict[int, tuple[int, int]]:
        """Terms of wanted that the stream spells from start on, with (edits, end): the rows of the Levenshtein automaton of
        the stream step down the branches of the trie that lead to wanted terms, which share the rows of what they begin with;
        a branch is left where every state exceeds the edits allowed. States further than these from the diagonal do."""
        found: dict[int, tuple[int, int]] = {}
        inexact: list[tuple[str, int]] = []
        most = 0
        for number in wanted:
            term = self.terms[number][0]
            if stream.startswith(term, start):
                found[number] = (0, start + len(term))
            elif self.edits[number]:
                inexact.append((term, number))
                most = max(most, self.edits[number])
        if not inexact:
            return found
        inexact.sort()
        window = stream[start : start + max(len(term) for term, _ in inexact) + most]
        cut = window.find("\n")
        window = window if cut < 0 else window[:cut]
        n, far = len(window), most + 1
        # A row for each letter of the branch, and its least state.
        rows, leasts = [[j if j <= most else far for j in range(n + 1)]], [0]
        before = ""
        for term, number in inexact:
            shared = 0
            while shared < len(rows) - 1 and shared < len(term) and before[shared] == term[shared]:
                shared += 1
            del rows[shared + 1 :], leasts[shared + 1 :]
            before = term
            for i in range(shared + 1, len(term) + 1):
                if leasts[-1] > most and (i < 3 or leasts[-2] > most - 1):
                    break
                ch, row, new = term[i - 1], rows[-1], [far] * (n + 1)
                if i <= most:
                    new[0] = i
                for j in range(max(1, i - most), min(n, i + most) + 1):
                    w = window[j - 1]
                    least = row[j - 1] if w == ch else row[j - 1] + 1
                    if row[j] < least:
                        least = row[j] + 1
                    if new[j - 1] < least:
                        least = new[j - 1] + 1
                    if i > 1 and j > 1 and w == term[i - 2] and window[j - 2] == ch and rows[-2][j - 2] < least:  # two letters exchanged are one edit
                        least = rows[-2][j - 2] + 1
                    new[j] = least
                rows.append(new)
                leasts.append(min(new))
            else:
                best = leasts[-1]
                if best <= self.edits[number]:
                    found[number] = (best, start + rows[-1].index(best))
        return found


@cache
def _trie(phrases: tuple[tuple[str, str, float], ...] = ()) -> Trie:
    return Trie(WORDS, phrases)


def _places(text: str) -> tuple[str, list[int]]:
    """The folded stream and the place in the text of each of its characters."""
    gone = [False] * len(text)
    for m in _LAUGH.finditer(text):
        gone[m.start() : m.end()] = [True] * (m.end() - m.start())
    out, at = [], []
    for i, ch in enumerate(text):
        if not gone[i]:
            for c in _FOLD[ord(ch)]:
                out.append(c)
                at.append(i)
    return "".join(out).replace("力す", "かす"), at


def score(text: str | None, trie: Trie | None = None) -> tuple[float, str | None, str | None]:
    """(score, category, worst sentence) of a text."""
    trie = trie or _trie()
    if not text:
        return 0.0, None, None
    stream = fold(text)
    starts: dict[int, set[int]] = {}
    for at, number in trie.seeds(stream):
        # Every distinct letter of the term that the stream lacks there costs an edit.
        if trie.needs[number] and len(trie.letters[number].difference(stream[max(0, at - 2) : at + trie.needs[number]])) > trie.edits[number]:
            continue
        starts.setdefault(at, set()).add(number)
    if not starts:
        return 0.0, None, None
    stream, place = _places(text)
    hits: dict[tuple[int, int], tuple[int, int, int]] = {}
    for at, numbers in starts.items():
        k = max(allowed(trie.terms[n][0]) for n in numbers)
        for begin in range(max(0, at - k), min(len(stream), at + k + 1)):
            for number, (edits, end) in trie.walk(stream, begin, numbers).items():
                term = trie.terms[number][0]
                if end <= begin:
                    continue
                a, b = place[begin], place[end - 1] + 1
                if _LATIN.match(term):  # a whole word, not a part of one
                    if a and text[a - 1].isalpha() and text[a].isalpha() and text[a - 1].isascii() and not _spread(text, a, b):
                        continue
                    if b < len(text) and text[b].isalpha() and text[b].isascii() and len(term) < 8:
                        continue
                old = hits.get((number, at))
                if old is None or edits < old[0]:
                    hits[number, at] = (edits, a, b)
    if not hits:
        return 0.0, None, None
    quotes = [(m.start(), m.end()) for m in _QUOTES.finditer(text)]
    cuts = [0, *(m.end() for m in _END.finditer(text)), len(text)]
    worth_of: dict[int, dict[str, float]] = {}
    kinds: dict[int, set[str]] = {}
    seen: set[tuple[int, int]] = set()
    for (number, _), (edits, a, b) in sorted(hits.items(), key=lambda x: x[1][0]):
        term, kind, weight = trie.terms[number]
        sentence = next(i for i in range(len(cuts) - 1, -1, -1) if cuts[i] <= a)
        if (sentence, number) in seen:
            continue
        seen.add((sentence, number))
        held = next(((x, y) for x, y in quotes if x < a and b <= y), None)
        share = 1.0
        # The window ends with the sentence, or with that which goes on behind the quotation.
        first = cuts[sentence]
        if held:
            around = text[max(0, held[0] - AROUND) : held[0]] + "\x00" + text[held[1] : held[1] + AROUND]
            share = 0.1 if _REPORT.search(around) else 1.0
        elif (weight < 1 or kind in WEIGHT) and _REPORT.search(text[max(first, a - AROUND) : a] + "\x00" + text[b : min(b + AROUND, cuts[sentence + 1] if sentence + 1 < len(cuts) else len(text))]):
            share = 0.3
        if share < 1 and kind in ("you", "group"):
            continue
        kinds.setdefault(sentence, set()).add(kind)
        own = worth_of.setdefault(sentence, {})
        own[kind] = own.get(kind, 0.0) + share * weight * (1 - 0.1 * edits if len(term) < 8 and weight < 1 else 1.0)
    sums: dict[int, dict[str, float]] = {}
    for sentence, own in worth_of.items():
        for kind, worth in own.items():
            if worth > 0:
                # What is reported gains nothing by whom it is said of.
                gain = max((GAIN.get((kind, target), 0.0) for target in kinds[sentence]), default=0.0) if worth >= 0.8 * WEIGHT.get(kind, 9.0) else 0.0
                category = CATEGORY.get(kind, kind)
                by = sums.setdefault(sentence, {})
                by[category] = by.get(category, 0.0) + worth + gain
    if not sums:
        return 0.0, None, None
    worst = max(sums, key=lambda s: (sum(sums[s].values()), -s))
    total = min(3.0, sum(sums[worst].values()))
    end = cuts[worst + 1] if worst + 1 < len(cuts) else len(text)
    return total, max(sums[worst], key=lambda c: sums[worst][c]), text[cuts[worst] : end].strip()


def _spread(text: str, a: int, b: int) -> bool:
    """Whether a span of the text is written with signs between its letters."""
    span = text[a:b]
    return sum(not c.isalpha() for c in span) * 2 >= len(span) - 1


def _size(ch: str) -> int:
    """Letters of the runs that phrases are learnt from: fewer where a letter says more."""
    return 5 if ch >= "\u3040" else 8


def grams(text: str | None) -> set[str]:
    """Runs of letters of the sentences of a text that report nothing."""
    found: set[str] = set()
    at = 0
    for end in [*(m.end() for m in _END.finditer(text or "")), len(text or "")]:
        sentence, at = (text or "")[at:end], end
        if _QUOTES.search(sentence) and _REPORT.search(sentence):
            continue
        for stream in fold(sentence).split("\n"):
            for i in range(len(stream)):
                run = stream[i : i + _size(stream[i])]
                if len(run) == _size(stream[i]):
                    found.add(run)
    return found


def phrases(counts: dict[str, tuple[int, str, float]]) -> tuple[tuple[str, str, float], ...]:
    """Runs that follow each other in about the same documents, joined. counts: documents, category and weight of each run."""
    after: dict[str, str] = {}
    by_head: dict[str, list[str]] = {}
    for run in counts:
        by_head.setdefault(run[:-1], []).append(run)
    for run, (n, category, _) in counts.items():
        follows = [r for r in by_head.get(run[1:], ()) if r != run and counts[r][1] == category and 0.6 * n <= counts[r][0] <= n / 0.6]
        if follows:
            after[run] = max(follows, key=lambda r: (counts[r][0], r))
    followed = set(after.values())
    out = []
    for run in sorted(counts):
        if run not in followed:
            chain, weights, passed = run, [counts[run][2]], {run}
            while run in after and after[run] not in passed:
                run = after[run]
                passed.add(run)
                chain += run[-1]
                weights.append(counts[run][2])
            # A short phrase says too little alone.
            out.append((chain, counts[run][1], min(weights) if len(chain) >= _size(chain[0]) + 2 else 0.5))
    return tuple(out)


def learn(reviewed: DataFrame, key: str, text: str, flagged: str, category: str) -> tuple[tuple[str, str, float], ...]:
    """Phrases that are peculiar to the flagged documents of a reviewed sample, with category and weight.

    At most LABELLED documents (by a hash of their key) and PHRASES runs are used, so what the driver gets is bounded."""
    rows = reviewed.where(F.col(flagged).isNotNull() & F.col(text).isNotNull()).select(F.xxhash64(key).alias("h"), F.col(text).alias("text"), (F.col(flagged) == 1).alias("bad"), F.coalesce(category, F.lit("abuse")).alias("category"))
    rows = keep(rows.orderBy("h").limit(LABELLED), "reviewed")  # used twice, and costs a join with all documents
    n_bad, n_good = rows.agg(F.count_if("bad"), F.count_if(~F.col("bad"))).first()
    if not n_bad or not n_good:
        return ()
    spread = rows.repartition(rows.sparkSession.sparkContext.defaultParallelism).select("bad", "category", F.explode(F.pandas_udf(lambda s: s.map(lambda t: sorted(grams(t))), "array<string>")("text")).alias("run"))
    counted = spread.groupBy("run").agg(F.count_if("bad").alias("bad"), F.count_if(~F.col("bad")).alias("good"), *(F.count_if(F.col("bad") & (F.col("category") == c)).alias(c) for c in ("abuse", "hate", "sexual")))
    share = n_bad / (n_bad + n_good)
    both, part = F.col("bad") + F.col("good"), F.col("bad") / (F.col("bad") + F.col("good"))
    # How surely a run is more frequent in flagged documents than in others.
    g = 2 * (F.col("bad") * F.log(part / share) + F.when(F.col("good") > 0, F.col("good") * F.log((1 - part) / (1 - share))).otherwise(0.0))
    sure = counted.where((part >= 0.8) & (both >= 3) & (g >= SURE)).orderBy(F.desc("bad"), "run").limit(PHRASES).collect()
    return phrases({r["run"]: (r["bad"], max(("abuse", "hate", "sexual"), key=lambda c: r[c]), 1.0 if r["bad"] >= 0.9 * (r["bad"] + r["good"]) else 0.7) for r in sure})


def scored(text: Column, learnt: tuple[tuple[str, str, float], ...] = ()) -> Column:
    """struct<score, category, sentence> of a string column; learnt: phrases besides the general words."""

    def f(s: pd.Series) -> pd.DataFrame:
        trie = _trie(learnt)
        return pd.DataFrame([score(t, trie) for t in s.tolist()], columns=["score", "category", "sentence"])

    return F.pandas_udf(f, "score double, category string, sentence string")(text)


def rates(df: DataFrame, source: str, text: str, learnt: tuple[tuple[str, str, float], ...] = ()) -> DataFrame:
    """(source, documents, flagged, rate, mean_score) by source."""
    own = df.select(F.col(source).alias("source"), scored(F.col(text), learnt)["score"].alias("s"))
    flagged = F.sum(F.when(F.col("s") >= FLAG, 1).otherwise(0))
    return own.groupBy("source").agg(F.count("*").alias("documents"), flagged.alias("flagged"), (flagged / F.count("*")).alias("rate"), F.avg("s").alias("mean_score"))
