import random

import pytest
from pyspark.sql import functions as F

from filmstrip.llm.runs import collapse_runs, motion_class


def brute(data):
    """(key, first, last, events) of every run; a null value is a run alone."""
    out = []
    for key in {(v, s) for _, v, s, _, _ in data if v is not None and s is not None}:
        run = []
        for i, v, s, o, m in sorted((d for d in data if (d[1], d[2]) == key and d[3] is not None), key=lambda d: (d[3], d[0])):
            if run and m is not None and run[-1][4] == m:
                run.append((i, v, s, o, m))
            else:
                if run:
                    out.append((*key, run[0][3], run[-1][3], len(run)))
                run = [(i, v, s, o, m)]
        if run:
            out.append((*key, run[0][3], run[-1][3], len(run)))
    return sorted(out)


def run(spark, data):
    df = spark.createDataFrame([(*d, "clash", d[3], 5) for d in data], "id long, video_id string, shot_index int, o int, m string, run_value string, s long, e long")
    out = collapse_runs(df, ["video_id", "shot_index"], ["o", "id"], "m", "s", "e")
    return sorted((r.video_id, r.shot_index, r.first_o, r.last_o, r.events) for r in out.collect())


def test_against_a_loop(spark):
    rng = random.Random(1)
    data = [(i, rng.choice(["a", "b", None]), rng.randrange(3) if rng.random() < 0.95 else None, rng.randrange(60), rng.choice(["x", "y", None])) for i in range(400)]
    data += [(1000 + i, "hot", 0, i, "z") for i in range(137)]  # one long run with no place to split
    assert run(spark, data) == brute(data)


def test_holes_ties_and_nulls(spark):
    assert run(spark, [(1, "a", 0, 1, "x"), (2, "a", 0, 7, "x"), (3, "a", 0, 9, None), (4, "a", 0, 10, "x"), (5, "a", 0, 10, "x"), (6, None, 0, 11, "x"), (7, "a", None, 1, "x")]) == [("a", 0, 1, 7, 2), ("a", 0, 9, 9, 1), ("a", 0, 10, 10, 2)]
    assert run(spark, []) == []


def test_duration(spark):
    df = spark.createDataFrame([(1, 0, "x", 10, 19), (2, 1, "x", 40, 31), (3, 2, "y", None, None)], "id long, o int, m string, s long, e long").withColumn("k", F.lit("k"))
    got = {r.first_o: (r.first_frame, r.last_frame, r.frames) for r in collapse_runs(df, ["k"], ["o", "id"], "m", "s", "e").collect()}
    assert got == {0: (10, 40, 31), 2: (None, None, None)}


@pytest.mark.parametrize(
    "text,want",
    [
        ("gần như tĩnh", "gannhutinh"), ("GẦN-NHƯ  TĨNH…", "gannhutinh"), ("gầ nnhư tĩnh", "gannhutinh"), ("gan nuh tinh", "gannhutinh"),
        ("Camera lia sang trái / lên(vừa)", "cameraliasangtrailenvua"), ("camrea lia sang trái/lên - vừa", "cameraliasangtrailenvua"), ("camera lia sang phải/lên (vừa)", "cameraliasangphailenvua"),
        ("camera lia sang lên (mạnh)", "cameraliasanglenmanh"), ("chủ thể/vật di chuyển sang xuống (nhẹ)", "chuthevatdichuyensangxuongnhe"),
        ("  ", None), ("…", None), (None, None), ("zoom nhanh vào mặt", "zoomnhanhvaomat"), ("x" * 5000, "x" * 5000),
    ],
)
def test_motion_class(spark, text, want):
    assert spark.createDataFrame([(text,)], "t string").select(motion_class(F.col("t")).alias("c")).first().c == want
