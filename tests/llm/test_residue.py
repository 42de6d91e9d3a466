import random

import pytest
from pyspark.sql import functions as F

from filmstrip.llm.residue import parts, parts_column, residue, train, unseen, validate, weak_label

WHO, DOES, WHERE = ["cụ ông", "cô gái trẻ", "hai thợ máy", "a nurse", "an old farmer"], ["băng qua đường", "vẫy tay", "ngồi xuống ghế đá", "crosses the road", "opens a lunch box"], ["ở vườn chè", "trước rạp xiếc", "near the fire station"]
ODD = ["{{subject}} đang {{verb}}", "Lorem ipsum dolum etium", "502 Bad Gateway", "Please enable JavaScript to continue.", "TODO: viết mô tả sau", "[lỗi API: 500 nội bộ]", "test test test", "<noscript>cần JS</noscript>", "${caption}", "Access denied. Reference #12.7", "Traceback (most recent call last): KeyError"]
SEEN = ['biển hiệu "{}" phía sau {}', "{1} đọc thông báo «{0}» trên điện thoại", "{1} points at a screen that reads {0}", "áo của {1} in chữ '{0}'"]


def corpus(seed, n=900):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        fine = f"{rng.choice(WHO)} {rng.choice(DOES)} {rng.choice(WHERE)}"
        odd = rng.choice(ODD)
        kind = rng.random()
        text, label = (fine, 0) if kind < 0.5 else (odd, 1) if kind < 0.65 else (f"{fine}. {odd}", 1) if kind < 0.72 else (f"{odd} {fine}", 1) if kind < 0.8 else (rng.choice(SEEN).format(rng.choice(["TODO", "404", "Loading", "Enable JavaScript"]), rng.choice(WHO)), 0)
        out.append((i, text, f"h{rng.randrange(30)}", label))
    return out


@pytest.fixture(scope="module")
def model(spark):
    return train(spark.createDataFrame(corpus(1), "id long, text string, host string, label int"), "text", "host")


def test_other_texts(spark, model):
    data = corpus(2)
    df = spark.createDataFrame(data, "id long, text string, host string, label int")
    got = {r.id: r.is_residue for r in residue(df, "id", "text", model).collect()}
    hit = sum(got[i] for i, *_, y in data if y)
    assert hit / sum(y for *_, y in data) > 0.97
    assert sum(got[i] for i, *_, y in data if not y) / sum(1 - y for *_, y in data) < 0.01


def test_unseen_hosts(spark):
    df = spark.createDataFrame(corpus(3), "id long, text string, host string, label int")
    df = df.withColumn("text", F.when(F.col("host") == held(spark), F.concat("text", F.lit(" nhé bạn"))).otherwise(F.col("text")))
    rows = {(r.test, r.label): r for r in validate(df, "text", "host").collect()}
    assert rows["unseen hosts", "residue"].share > 0.8 and rows["unseen hosts", "plain"].share < 0.05
    assert {"without status", "without scripts"} < {t for t, _ in rows}


def test_hosts_are_told_apart_without_case_and_spaces(spark):
    df = spark.createDataFrame([(h, h.strip().lower()) for h in ("N1_V1", " n1_v1", "T2_V9 ", "t2_V9")], "a string, b string")
    assert all(r[0] == r[1] for r in df.select(unseen(F.col("a")), unseen(F.col("b"))).collect())


def held(spark):
    """A host that training doesn't see."""
    return spark.createDataFrame([(f"h{i}",) for i in range(30)], "h string").where(unseen(F.col("h"))).orderBy("h").first().h


def test_odd_inputs(spark, model):
    df = spark.createDataFrame([(1, None), (2, ""), (3, " \n"), (4, "cụ ông vẫy tay. " * 20000 + "{{subject}} đang {{verb}}"), (5, "cụ ông vẫy tay\nTEXT: 404 | TODO"), (None, "TODO: viết mô tả sau")], "id long, text string").withColumn("score", F.lit("clash"))
    got = {r.id: r.is_residue for r in residue(df, "id", "text", model).collect()}
    assert got == {1: False, 2: False, 3: False, 4: True, 5: False, None: True}
    assert residue(df.limit(0), "id", "text", model).count() == 0


def test_nothing_to_learn_finds_nothing(spark):
    df = spark.createDataFrame([(1, "cụ ông vẫy tay", "h")], "id long, text string, host string")
    assert not any(r.is_residue for r in residue(df, "id", "text", train(df.limit(0), "text", "host")).collect())


def test_parts_agree_on_both_sides(spark):
    texts = ["Một câu. Hai câu!  Ba\nTEXT: A | B", "x\n\ny", "TEXT: all seen", ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r.p for r in df.select(parts_column(F.col("t")).alias("p")).collect()] == [parts(t) for t in texts]


def test_weak_labels(spark):
    said = {"｛ai｝ ở ｛đâu｝": 1, "TBD": 1, 'dòng "TODO" chạy ngang màn hình': 2, "cụ ông vẫy tay": 0, "Session expired - sign in again": 1}
    rows = spark.createDataFrame([(t,) for t in said], "t string").select("t", weak_label(F.col("t")).alias("y")).collect()
    assert {r.t: r.y for r in rows} == said
