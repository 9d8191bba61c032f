"""Operators on inputs that are like none of the tables."""

from minutesmith.llm import canonical, glossary


def _mapped(spark, names, typed, **tables):
    reference = spark.createDataFrame([("f", i, n) for i, n in enumerate(names)], "f string, id bigint, name string")
    values = spark.createDataFrame([("f", t) for t in typed], "f string, value string")
    return {r["value"]: names[r["id"]] if r["id"] >= 0 else None for r in canonical.map_values(values, reference, "f", "value", "id", "name", **tables).collect()}


def test_cities(spark):
    names = ["Sacramento", "San Francisco", "Philadelphia", "Albuquerque", "San Diego", "São Paulo"]
    typed = {"Sacremento": names[0], "San Fransisco": names[1], "Phildelphia": names[2], "Albuqerque": names[3], "Philadelphia PA": names[2], "sacramento": names[0], "Sao Paulo": names[5], "Boston": None, "San": None, "": None}
    assert _mapped(spark, names, typed) == typed


def test_a_list_that_no_table_knows(spark):
    names = ["土木建築部長", "土木総務課長", "消防防災課長", "消防学校長", "学校保健課長"]
    typed = {"土木建築部長殿": names[0], "土木建策部長": names[0], "土総課長": names[1], "消防々災課長": names[2], "消防学校校長": names[3], "消学校長": names[3], "保健課長": names[4], "水道局長": None}
    assert _mapped(spark, names, typed) == typed
    assert _mapped(spark, names, ["どぼく総務課長"], readings={"土": "ど", "木": "ぼく"}) == {"どぼく総務課長": names[1]}


def test_english_by_glossary(spark):
    names = ["総務財政委員会", "予算特別委員会", "農林水産委員会"]
    typed = {"Fniance Committee": names[0], "Ifnance Committee": names[0], "Finacne Committee": names[0], "Budget Special Cttee": names[1], "Agri., Forestry & Fisheries": names[2]}
    assert _mapped(spark, names, typed, glosses=glossary.ENGLISH) == typed
    assert set(_mapped(spark, names, typed).values()) == {None}


TEXT = "ただいまから委員会を開会いたします。令和7年6月の予算は3.5億円です。次に道路の整備について質問します。"


def test_layers_of_wrong_decodings():
    from minutesmith.llm import encoding

    once = TEXT.encode().decode("latin-1")
    garbled = [once, once.encode().decode("latin-1"), once.encode().decode("latin-1").encode().decode("latin-1")]
    garbled += ["".join(f"&#{ord(c)};" if ord(c) > 127 else c for c in once), "".join(f"\\u{ord(c):04x}" if ord(c) > 127 else c for c in once), "".join(f"\\u{ord(c):04x}" if 127 < ord(c) < 160 else c for c in once)]
    assert encoding.examine(garbled) == [(True, TEXT)] * len(garbled)
    assert encoding.examine(["A &amp; B &lt;p&gt; &#12354;", "caf&eacute; &nbsp;", r"あ"]) == [(False, None)] * 3


def test_editions_with_many_printings(spark):
    import random

    from minutesmith.llm import nearcopies

    random.seed(1)
    letters = lambda n: [chr(random.randrange(0x4E00, 0x9000)) for _ in range(n)]
    texts = []
    for _ in range(3):
        base = letters(900)
        for part in (letters(180), letters(180)):
            for _ in range(10):
                t = base[:450] + part + base[450:]
                t[random.randrange(len(t))] = "々"
                texts.append("".join(t))
    texts.append(texts[0])
    rows = [(i, "a", 0, t, "x") for i, t in enumerate(texts)] + [(99, "a", 0, "", "x")]
    docs = nearcopies.assemble(spark.createDataFrame(rows, "m bigint, s string, o int, t string, class string"), "m", "s", "o", "t")
    family = lambda i: 0 if i == 60 else i // 20
    wanted = {(a, b) for b in range(61) for a in range(b) if family(a) == family(b)}
    assert {tuple(r) for r in nearcopies.similar_pairs(docs).collect()} == wanted == {tuple(r) for r in nearcopies.similar_pairs(docs, exact=True).collect()}
    rows = {r["doc"]: (r["head"], r["class"], r["links"]) for r in nearcopies.classes(docs).collect()}
    assert rows == {i: (0 if i == 60 else i, 20 * family(i), 19) for i in range(61)}


def test_rare_parts_of_names_count_more():
    from minutesmith.llm.names import agree, parse

    of = lambda a, b, *w: agree(parse(a), parse(b), *w)[0]
    assert of("鈴木次郎", "鈴木治郎", 2, 1, True) > of("鈴木次郎", "鈴木治郎", 1, 1, True) > of("鈴木次郎", "鈴木治郎", 1, 2, True) > 0.85
    assert of("佐藤健一", "佐藤謙一", 1, 1, True) > 0.85 and of("佐藤健一", "佐藤謙一") == of("高橋一郎", "高木一郎") == of("佐藤健一", "伊藤健一") == 0
    assert of("J. Smith", "Jon Smith", 2, 1) != 0 and of("J. Smith", "Mary Smith") == 0


def test_names_that_readings_show_to_be_alike(spark):
    from minutesmith.llm import names

    read = [("高田琥乃", "たかだ この"), ("高田琥野", "たかだ この"), ("山田綾乃", "やまだ あやの"), ("山田綾野", "やまだ あやの"), ("高井琥太", "たかい こた"), ("山井綾太", "やまい あやた")]
    rows = [(i, 1, n, k, None) for i, (n, k) in enumerate(read)] + [(10, 2, "高井琥乃", None, "部長"), (11, 2, "高井琥野", None, None), (12, 2, "高井琥太", None, None), (13, 2, "高井琥乃", None, "部長")]
    linked = names.link(spark.createDataFrame(rows, "e bigint, c int, n string, k string, o string"), "e", "c", "n", "k", "o")
    found = {tuple(r) for r in names.pairs(linked.where("e >= 10"), "e").collect()}
    assert found == {(10, 11), (10, 13), (11, 13)}


def test_long_labels_and_annotations():
    from minutesmith.llm.turns import turns

    office = "総合" * 120 + "部長"
    long = "拍手と歓声" * 20
    body = f"{office}甲田一郎：はい。*{long}*次です。\n議長：" + "あ　" * 3000 + "\n甲田一郎（1分05秒）\nわかりました。"
    found = turns(body, f"A＝{office}:甲田一郎; B＝議長　丙川三子")
    assert [w for w, *_ in found] == ["甲田一郎", "丙川三子", "甲田一郎"]
    assert found[0][1] == "はい。次です。"
