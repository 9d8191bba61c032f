import pytest
from pyspark.sql import functions as F

from minutesmith.llm import sentences


def cut(spark, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    out = {}
    for r in sentences.sentences(df, "id", "t").orderBy("id", "sentence_no").collect():
        out.setdefault(r["id"], []).append(r["sentence"])
    return [out.get(i, []) for i in range(len(texts))]


CASES = [
    "開議します。|3.5億円で、No.4では2倍です。|「そうだ。もっと急げ。」という声があり、進めます。",
    "「以上です。」|次に移ります。",
    "必要か？と問われれば、はい。|よいですか？|はい！！",
    "(1) 用地の件|\n・道路について|\n進めております|\n次の件です",
    "見直すべ\nきである。|以\n上です。",
    "思います|　次に進みます|　以上です",
    "（詳細は別紙2.1にあります。御覧ください。）、進めます。|これは……大事です。",
    "Dr. Ito met Mr. Ueda at 9.30 a.m. and left.| According to item No. 4, e.g. roads, costs rose 3.5 percent.| \"Is it fair? Who pays?\" and the hall fell silent.| Done!",
    "O Sr. Ayase informou, p. ex., que o custo chegou a 9.464,50 ienes.| Será que sim?",
    "사업은 늦어졌습니다.|다음 안건입니다.| \"왜 늦었습니까? 급합니다.\"라는 편지를 받았습니다.",
    "费用约为5.4亿日元。|“请不要忘记。”这句话结束了发言。|为什么？",
    "क्र. 5 के अनुसार देर हो रही है।| डॉ. Ito ने बताया।",
    "See https://a.example/x.html?b=1. It is|",
]


@pytest.mark.parametrize("marked", CASES[:-1])
def test_cases(spark, marked):
    wanted = [p.strip(" \n　") for p in marked.split("|")]
    assert cut(spark, marked.replace("|", "")) == [wanted]


@pytest.mark.parametrize(("opening", "closing"), [("「", "」"), ("（", "）"), ("(", ")"), ("“", "”"), ('"', '"')])
def test_long_brackets(spark, opening, closing):
    letter = opening + "道路を直してください。もう待てません。" * 300 + closing
    texts = [f"手紙を読みます。|{letter}という手紙です。|次に移ります。", f"開きます。|「短い。」と言う。|{letter}、以上です。|終わり", f"閉じない{opening if opening != '"' else '「'}括弧です。|次です。"]
    assert cut(spark, *(x.replace("|", "") for x in texts)) == [x.split("|") for x in texts]


def test_empty_null_long_and_repeated(spark):
    long = "これは長い文です。" * 3000
    found = cut(spark, None, "", " \n　", long, "終わり", "終わり")
    assert [len(x) for x in found] == [0, 0, 0, 3000, 1, 1]
    assert cut(spark)== []


def test_positions_are_code_points(spark):
    df = spark.createDataFrame([(1, "𠮷野です。 𠮷だ。")], "id int, t string")
    rows = sentences.sentences(df, "id", "t").orderBy("sentence_no").collect()
    assert [(r["start_char"], r["end_char"]) for r in rows] == [(0, 5), (6, 9)]


def test_no_python_runs(spark):
    df = spark.createDataFrame([(1, "x")], "id int, t string")
    assert "Python" not in sentences.sentences(df, "id", "t")._jdf.queryExecution().executedPlan().toString()
    assert sentences.sentences(df.withColumn("end_char", F.lit(1)), "id", "t").columns.count("end_char") == 1
