import hashlib
from types import SimpleNamespace

import pytest

from filmstrip.catalog import aggregates
from filmstrip.operators import score
from filmstrip.operators.score import DEPTHS


def test_rank_table(spark):
    truth = spark.createDataFrame([(str(r), "v", "t", 500, 510) for r in (1, 2, 6, 21, 51, 101, 0)], "query_id string, gt_video string, level string, first long, last long")
    answers = [(str(r), k, "v" if k == r else "w", 505) for r in (1, 2, 6, 21, 51, 101) for k in range(1, 111)]
    df = spark.createDataFrame(answers, "query_id string, rank int, video_id string, frame_id long")
    got = {r.query_id: r for r in score.final_scores(score.judged(df, truth), ["query_id", "level"]).collect()}
    want = {"1": 1.0, "2": 0.8, "6": 0.6, "21": 0.4, "51": 0.2, "101": 0.0, "0": 0.0}
    assert {k: pytest.approx(r.final) for k, r in got.items()} == want
    assert got["0"].bucket == "miss" and got["21"].bucket == "21-50"


def test_partial_scores(spark):
    df = spark.createDataFrame([("q", r, h) for r, h in ((1, 0.5), (3, 0.8), (15, 0.6))], "q string, rank int, hit double")
    assert score.final_scores(df, ["q"]).first().final == pytest.approx(0.74)
    assert DEPTHS == (1, 5, 20, 50, 100)


def test_lint(spark):
    df = spark.createDataFrame([("q", r, "v", min(r, 90)) for r in range(1, 121)], "query_id string, rank int, video_id string, frame_id long")
    r = score.lint(df).first()
    assert (r.answers, r.too_many, r.missing, r.repeated) == (120, 20, 0, 10)


def test_coverage(spark):
    data = [("a", f, 49) for f in (3, 10, 12, 40)]
    got = score.covered_share(spark.createDataFrame(data, "k string, f long, last long"), ["k"], "f", 5, "last").first().share
    want = sum(any(s <= f < s + 5 for _, f, _ in data) for s in range(50)) / 50
    assert got == pytest.approx(want)


def test_answers_of_all_collections_count(spark):
    frames = {"N1_V1": 7, "S1_V1": 5, "T1_V1": 1}
    k = spark.createDataFrame([(v, f"{v}_{i}", i * 50) for v, n in frames.items() for i in range(n)], "video_id string, keyframe_id string, frame_idx long")
    answers, truth = aggregates._answers(SimpleNamespace(kf=k))
    want = {}
    for v, n in frames.items():
        order = sorted(range(n), key=lambda i: hashlib.md5(f"{v}_{i}".encode()).hexdigest())
        for level, tol in (("tol5", 5), ("tol30", 30), ("tol90", 90)):
            want[v, level] = min(r for r, i in enumerate(order, 1) if abs(i - n // 2) * 50 <= tol)
    got = score.final_scores(score.judged(answers, truth), ["query_id", "level"]).collect()
    assert {(r.query_id, r.level): r.first_hit for r in got} == want
    some = score.judged(answers.where("query_id <> 'S1_V1'"), truth)
    rows = score.final_scores(some, ["query_id", "level"]).where("query_id = 'S1_V1'").collect()
    assert len(rows) == 3 and {(r.final, r.bucket, r.first_hit) for r in rows} == {(0.0, "miss", None)}
