"""Operators on tables, against brute force on small fixtures."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from minutesmith.llm import abuse, canonical, glossary, linking, mixing, names, nearcopies, packing
from minutesmith.llm.queries import oracle_sql, queries


def test_near_copies(spark):
    random.seed(4)
    words = [f"{a}{b}の件" for a in "道橋港川森町村市" for b in "整備管理保全計画"]
    texts = {i: "".join(random.choice(words) + random.choice("、。") for _ in range(random.randint(20, 90))) for i in range(40)}
    for i in range(40, 70):
        base = list(texts[i - 40])
        for _ in range(len(base) // random.choice([12, 25, 60])):
            base[random.randrange(len(base))] = random.choice("甲乙丙")
        texts[i] = "".join(base)
    texts |= {70: texts[0], 71: " " + texts[0] + "\n", 72: "", 73: None, 74: "短い"}
    rows = []
    for i, t in texts.items():
        half = len(t or "") // 2
        rows += [(i, f"{i}a", 0, (t or "")[:half], "x"), (i, f"{i}b", 1, t[half:] if t else t, "x"), (i, f"{i}b", 1, t[half:] if t else t, "again")]
    docs = nearcopies.assemble(spark.createDataFrame(rows, "m bigint, s string, o int, t string, doc string"), "m", "s", "o", "t")
    found = {(r["a"], r["b"]) for r in nearcopies.similar_pairs(docs).collect()}
    plain = {i: "".join((t or "").split()) for i, t in texts.items()}
    grams = {i: {t[k : k + 5] for k in range(len(t) - 4)} for i, t in plain.items()}
    wanted = {(a, b) for a, b in itertools.combinations(sorted(grams), 2) if grams[a] and grams[b] and 2 * len(grams[a] & grams[b]) >= len(grams[a] | grams[b])}
    assert found <= wanted
    sure = {(a, b) for a, b in wanted if len(grams[a] & grams[b]) >= 0.6 * len(grams[a] | grams[b])}
    assert sure <= found and len(found) >= 0.9 * len(wanted)


def _against_all(spark, texts):
    """Pairs found and pairs wanted, by a comparison of all texts with all."""
    docs = nearcopies.assemble(spark.createDataFrame([(i, "a", 0, t) for i, t in enumerate(texts)], "m bigint, s string, o int, t string"), "m", "s", "o", "t")
    grams = [{t[k : k + 5] for k in range(len(t) - 4)} for t in texts]
    wanted = {(a, b) for a, b in itertools.combinations(range(len(texts)), 2) if 2 * len(grams[a] & grams[b]) >= len(grams[a] | grams[b])}
    return {(r["a"], r["b"]) for r in nearcopies.similar_pairs(docs).collect()}, wanted


@pytest.mark.parametrize("size", [25, 60, 200])
def test_near_copies_in_families(spark, size):
    random.seed(size)
    texts = ["".join(chr(random.randrange(0x4E00, 0x5E00)) for _ in range(900))]
    while len(texts) < size:  # copies of copies
        copy = list(random.choice(texts[: max(1, size // 3)]))
        for _ in range(len(copy) // random.choice([40, 60, 80])):
            copy[random.randrange(len(copy))] = chr(random.randrange(0x6000, 0x7000))
        texts.append("".join(copy))
    found, wanted = _against_all(spark, texts)
    assert len(wanted) > size and found <= wanted and len(found) >= 0.999 * len(wanted)


def test_near_copies_with_common_runs(spark):
    # Sub-families: no run that two of them share is in few texts, and each has runs of its own.
    random.seed(3)
    text = [chr(random.randrange(0x4E00, 0x5E00)) for _ in range(900)]
    texts = []
    for _ in range(3):
        branch = list(text)
        for k in random.sample(range(900), 24):
            branch[k] = chr(random.randrange(0x6000, 0x7000))
        for _ in range(25):
            copy = list(branch)
            for k in random.sample(range(900), 8):
                copy[k] = chr(random.randrange(0x6000, 0x7000))
            texts.append("".join(copy))
    found, wanted = _against_all(spark, texts)
    assert found == wanted and len(wanted) > 2700


def test_near_copies_at_the_bound(spark):
    # An edit every 15 characters in every other of two texts: similarity 0.5, and a third of the ten-character runs is left.
    random.seed(5)
    texts = []
    for _ in range(150):
        text = [chr(random.randrange(0x4E00, 0x5E00)) for _ in range(1500)]
        texts += ["".join(text), "".join("〓" if k % 15 == 7 and k > 15 else c for k, c in enumerate(text))]
    found, wanted = _against_all(spark, texts)
    assert len(wanted) >= 100 and found <= wanted and len(found) >= 0.97 * len(wanted)


def test_near_copies_of_short_texts(spark):
    pairs = [("甲乙丙丁戊己庚辛壬癸子丑", "甲乙丙丁戊己庚辛壬癸子寅"), ("春夏秋冬東西南北上下左右前後内外大小高低", "春夏秋冬東西南北上下左右前後内外大小高底"), ("一二三四五六七八九", "一二三四五六七八九十"), ("山川草木花", "山川草木花"), ("犬猫牛馬鳥", "犬猫牛馬鳥魚")]
    long = "".join(chr(0x5000 + k) for k in range(100))
    pairs += [(long[:59], long[:61]), (long[:50], long[:95]), (long[:60], long[1:])]
    found, wanted = _against_all(spark, [t for pair in pairs for t in pair])
    assert found == wanted and {(2 * k, 2 * k + 1) for k in range(7)} <= wanted


def test_near_copies_of_nothing(spark):
    docs = nearcopies.assemble(spark.createDataFrame([], "m bigint, s string, o int, t string"), "m", "s", "o", "t")
    assert nearcopies.similar_pairs(docs).collect() == []


def test_common_runs_are_counted_in_all_texts(spark):
    random.seed(6)
    letters = lambda n: "".join(chr(random.randrange(0x4E00, 0x9000)) for _ in range(n))
    phrase = letters(14)
    texts = [letters(50) + (phrase if i < 300 else letters(14)) for i in range(8_200)]
    weight = nearcopies._weights(nearcopies._common(spark.createDataFrame(list(enumerate(texts)), "doc bigint, text string")))
    own = weight[nearcopies._counter(nearcopies.runs(phrase, nearcopies.WIDE))]
    # A counter may be shared by a few runs; there are three of them for each run.
    assert all(nearcopies.COMMON / 306 < w <= nearcopies.COMMON / 299.99 for w in own) and (weight < 1).sum() == 15
    assert nearcopies._common(spark.createDataFrame(list(enumerate(texts[:200])), "doc bigint, text string")) is None


def test_pairs_of_copies_are_not_moved_again(spark):
    random.seed(8)
    text = "".join(chr(random.randrange(0x4E00, 0x9000)) for _ in range(300))
    rows = [(i, "a", 0, text if i < 40 else text[:200] + "々" + text[201:]) for i in range(60)] + [(i, "b", 1, None) for i in range(5)]
    parts = spark.createDataFrame(rows, "m bigint, s string, o int, t string")
    found = nearcopies.similar_pairs(nearcopies.assemble(parts, "m", "s", "o", "t"))
    assert sorted(map(tuple, found.collect())) == list(itertools.combinations(range(60), 2))
    assert found._jdf.queryExecution().optimizedPlan().nodeName() != "Aggregate"
    known = spark.createDataFrame([(1,), (1,), (2,), (50,), (99,), (None,)], "m bigint")
    docs = nearcopies.assemble(parts, "m", "s", "o", "t", known=known)
    assert sorted(map(tuple, nearcopies.similar_pairs(docs).collect())) == [(1, 2), (1, 50), (2, 50)]


def test_values_are_mapped(spark):
    reference = spark.createDataFrame([("c", 1, "総務企画委員会"), ("c", 2, "予算特別委員会"), ("c", 3, "県土整備委員会"), ("r", 4, "議長"), ("r", 5, "副議長"), ("r", 6, "医療政策課長")], "f string, id bigint, name string")
    typed = [("c", "総務企画委員会", 1), ("c", "（總務企畫委員會）", 1), ("c", "総務企委", 1), ("c", "予特", 2), ("c", "けんどせいび委員会", 3), ("c", "県土正備委員会【閉会中】", 3), ("c", "Budget Special Committee", 2), ("c", "茶話会", -1), ("c", "", -1), ("c", "?", -1), ("r", "ふくぎちょう", 5), ("r", "議長(再任)", 4), ("r", "団長", -1), ("r", "医療制策科長", 6)]
    rows = spark.createDataFrame([(f, v, "x") for f, v, _ in typed] + [("c", None, "x")], "f string, v string, name string")
    mapped = canonical.map_values(rows.withColumnRenamed("v", "value"), reference, "f", "value", "id", "name", glossary.READINGS, glossary.OTHER_READINGS, glossary.ENGLISH)
    assert {(r["f"], r["value"]): r["id"] for r in mapped.collect()} == {(f, v): i for f, v, i in typed}
    assert canonical.map_values(rows.withColumnRenamed("v", "value").limit(0), reference, "f", "value", "id", "name").collect() == []
    none = canonical.map_values(rows.withColumnRenamed("v", "value"), reference.limit(0), "f", "value", "id", "name").collect()
    assert {r["id"] for r in none} == {-1}


def test_names_are_linked(spark):
    same = [
        ["椋島凪也", "椋嶋　凪也", "凪也　椋島", "MUKUSHIMA Nagiya", "Nagiya Mukushma", "椋島（なぎちゃん）", "椋島（凪）", "N. Mukushima", "椋島委員", "むくしまなぎや", "ムクシマ・ナギヤ", "椋島凪凪也"],
        ["椋谷朔太", "椋谷朔太君", "朔椋谷太"], ["椋谷朔希"], ["株式会社ホタル漁業協同組合", "ホタル漁協（株）", "ほたる　漁業協同組合様"], ["ホタル建設協会", "NPO法人ホタル建設協"],
    ]
    kana = {"椋島凪也": "むくしま　なぎや", "椋谷朔太": "むくたに さくた", "椋谷朔希": "むくたに さくき"}
    rows, want = [], {}
    for g, spelled in enumerate(same):
        for n in spelled:
            rows.append((len(rows), 1, n, kana.get(n), "委員" if g == 0 else None, "x"))
            want.setdefault(g, set()).add(len(rows) - 1)
    rows += [(100, 2, "椋島凪也", None, None, "x"), (101, 1, None, None, None, "x"), (102, 1, " ", None, None, "x"), (103, None, "椋島凪也", None, None, "x")]
    linked = names.link(spark.createDataFrame(rows, "e bigint, c int, n string, k string, o string, entity string"), "e", "c", "n", "k", "o")
    found = {}
    for r in linked.collect():
        found.setdefault(r["entity"], set()).add(r["e"])
    assert sorted(map(sorted, found.values())) == sorted([*map(sorted, want.values()), [100]])
    pairs = {(r["entry_a"], r["entry_b"]) for r in names.pairs(linked, "e").collect()}
    assert pairs == {(a, b) for g in want.values() for a, b in itertools.combinations(sorted(g), 2)}


def test_no_names(spark):
    empty = spark.createDataFrame([], "e bigint, c int, n string, k string, o string")
    assert names.link(empty, "e", "c", "n", "k", "o").collect() == []


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(50, 51)]
    found = linking.components(spark.range(60).select(F.col("id").alias("node")), spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {r["node"]: r["entity"] for r in found} == {i: 0 if i <= 30 else 50 if i in (50, 51) else i for i in range(60)}


def test_pack_tables(spark):
    items = spark.createDataFrame([(i, s, "x") for i, s in enumerate([5, 5, 3, 7, 25, 0, None, 2])] + [(0, 5, "x")], "id bigint, size bigint, part string")
    profiles = spark.createDataFrame([("p", 10), ("q", 6)], "profile string, capacity_tokens int")
    packed = packing.pack_items(items, "id", "size", profiles, shard_tokens=20).collect()
    for p, c in (("p", 10), ("q", 6)):
        own = [r for r in packed if r["profile"] == p]
        fill = {}
        for r in own:
            fill[r["container"]] = fill.get(r["container"], 0) + r["tokens"]
        assert max(fill.values()) <= c and sum(fill.values()) == 52
    assert packing.report(packing.pack_items(items.limit(0), "id", "size", profiles)).collect() == []
    assert packing.pack_items(items, "id", "size", profiles.limit(0)).collect() == []


def test_mixing(spark):
    random.seed(6)
    docs = [("big", i, random.randint(50, 150)) for i in range(4000)] + [("small", 10_000 + i, 100) for i in range(30)] + [("other", 20_000, 5), (None, 1, 5), ("big", 1, 0)]
    frame = spark.createDataFrame(docs, "source string, doc_id bigint, tokens bigint")
    targets = spark.createDataFrame([("big", 0.7, 1), ("small", 0.3, 4), ("none", 0.2, 2)], "source string, target_share double, max_repeats int")
    mixed = mixing.mix(frame, targets, block=200)
    shares = {r["source"]: r for r in mixing.report(mixed, targets).collect()}
    assert abs(shares["big"]["actual_share"] - 0.7) < 0.01 and abs(shares["small"]["actual_share"] - 0.3) < 0.01 and shares["none"]["actual_share"] == 0
    assert shares["small"]["most_uses"] == 4 and shares["big"]["most_uses"] == 1
    rows = mixed.collect()
    assert len({(r["source"], r["doc_id"], r["repetition"]) for r in rows}) == len(rows)
    head = [r for r in rows if r["slot"] < max(x["slot"] for x in rows) // 3]
    assert abs(sum(r["tokens"] for r in head if r["source"] == "big") / sum(r["tokens"] for r in head) - 0.7) < 0.08
    assert mixing.mix(frame.limit(0), targets).collect() == []


def test_mixing_many_sources(spark):
    n = 2000
    docs = spark.range(n * 5).select(F.concat(F.lit("s"), F.col("id") % n).alias("source"), F.col("id").alias("doc_id"), F.lit(100).cast("bigint").alias("tokens"))
    targets = spark.createDataFrame([(f"s{i}", (1 + i % 3) / (2 * n), 2) for i in range(n)], "source string, target_share double, max_repeats int")
    shares = mixing.report(mixing.mix(docs, targets, block=50), targets).collect()
    whole = sum(r["target_share"] for r in shares)
    assert len(shares) == n and all(abs(r["actual_share"] * whole / r["target_share"] - 1) < 0.3 and r["most_uses"] <= 2 for r in shares)


def test_turn_tables(spark):
    from minutesmith.llm import turns

    ddl = "raw_id bigint, attendees string, body string, k string, turn_no int"
    att = "A＝部長:甲田一郎; B＝議長　丙川三子"
    long = "\n".join(f"{'甲田' if i % 2 else '議長'}：第{i}点です。" for i in range(2000))
    rows = [(1, att, "甲田：はい。", "x", 9), (1, att, "甲田：はい。", "x", 9), (2, None, "甲田：はい。", None, None), (3, att, None, None, None), (4, att, "", None, None), (5, att, long, None, None), (None, att, "A：はい。", None, None)]
    found = turns.speaker_turns(spark.createDataFrame(rows, ddl)).collect()
    by = {}
    for r in found:
        by.setdefault(r["raw_id"], []).append(r["turn_no"])
    assert sorted(by[1]) == [1, 1] and by[None] == [1] and sorted(by[5]) == list(range(1, 2001)) and set(by) == {1, 5, None}
    assert turns.speaker_turns(spark.createDataFrame([], ddl)).collect() == []


def test_column_operators_on_odd_tables(spark):
    from minutesmith.llm import encoding, lookalikes

    texts = [None, "", "はい。" * 4000, "はい。", "はい。", "ã\x81¯ã\x81\x84ã\x80\x82", "令和５年"]
    df = spark.createDataFrame([(t, "x") for t in texts], "t string, damaged string")
    out = df.select(encoding.check_encoding(F.col("t")).alias("e"), lookalikes.usual_form(F.col("t")).alias("u"), abuse.scored(F.col("t"))["score"].alias("s"), "damaged").collect()
    assert [r["e"]["damaged"] for r in out] == [False] * 5 + [True, False] and out[5]["e"]["restored"] == "はい。"
    assert [r["u"] for r in out] == [*texts[:6], "令和5年"] and {r["s"] for r in out} == {0.0}
    empty = spark.createDataFrame([], "t string")
    assert empty.select(encoding.check_encoding(F.col("t")), lookalikes.usual_form(F.col("t")), abuse.scored(F.col("t"))).collect() == []


def test_ties_are_unmatched(spark):
    reference = spark.createDataFrame([("c", 1, "総務企画委員会"), ("c", 2, "総務財政委員会")], "f string, id bigint, name string")
    typed = spark.createDataFrame([("c", "総務委員会"), ("c", "総務" * 200)], "f string, value string")
    assert {r["id"] for r in canonical.map_values(typed, reference, "f", "value", "id", "name").collect()} == {-1}


def test_rates(spark):
    df = spark.createDataFrame([("a", "おまえは無能だ、消えろ。"), ("a", "はい。"), (None, None)], "source string, t string")
    assert {r["source"]: (r["documents"], r["flagged"]) for r in abuse.rates(df, "source", "t").collect()} == {"a": (2, 1), None: (1, 0)}


@pytest.mark.parametrize("name", sorted(queries()))
def test_queries_run(spark, data, name):
    found = queries()[name](spark, data)
    assert found.count() > 0 and len(set(found.columns)) == len(found.columns)


def test_near_copies_against_sql(spark, data):
    import glob
    import os

    con = pytest.importorskip("duckdb").connect()
    for f in glob.glob(f"{data}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM read_parquet('{f}')")
    assert sorted(map(tuple, queries()["p2_found"](spark, data).collect())) == sorted(con.execute(oracle_sql()["p2_found"]).fetchall())


def test_sql_has_queries():
    assert set(oracle_sql()) <= set(queries())
