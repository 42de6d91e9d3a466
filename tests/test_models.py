import numpy as np
import pytest
from pyspark.sql import functions as F

from filmstrip.functions import models
from filmstrip.functions.models import MeanEmbedder, Retries, ShiftFlow, embed_images, error_class, in_parallel, picture_size
from filmstrip.plans.rounds import refill


def test_error_classes():
    said = {"429 Too Many": "quota", "RESOURCE_EXHAUSTED": "quota", "403 permission denied": "refused", "400 API key not valid": "refused", "400 bad size": "passing", "503": "passing"}
    assert {m: error_class(m) for m in said} == said


def failing(*outcomes):
    left = list(outcomes)

    def ask(*_):
        x = left.pop(0)
        if isinstance(x, Exception):
            raise x
        return x

    return ask, left


def test_calls_are_tried_within_a_budget():
    slept = []
    r = Retries(3, sleep=slept.append)
    ask, left = failing(RuntimeError("503"), "", " ok ")
    assert r.call(ask) == "ok" and slept == [1.5] and not left
    ask, left = failing(RuntimeError("403 permission"), "ok")
    assert r.call(ask).startswith("[lỗi API: 403") and left == ["ok"]
    assert r.call(failing("", "", "")[0]) == "[rỗng]"
    slept.clear()
    assert r.call(failing(*[RuntimeError("429, retry in 4.5s")] * 3)[0]) == "[hết quota]" and slept == [5.5, 5.5]
    assert Retries(1).call(failing(RuntimeError("500 x"))[0]) == "[lỗi API: 500 x]"


def test_parallel_calls_with_a_fallback():
    quiet = Retries(1, sleep=lambda s: None)
    said, counts = in_parallel([1, 2, 3, 4], lambda n: f"clip {n}" if n % 2 else "", lambda n: "" if n == 4 else f"frames {n}", 2, quiet)
    assert said == ["clip 1", "frames 2", "clip 3", "[rỗng]"] and counts == {"first": 2, "fallback": 1, "failed": 1}
    assert in_parallel([], lambda n: "x")[0] == []


def test_pictures(spark):
    a, b = bytes(range(144)), bytes([7] * 144)
    v = MeanEmbedder().embed([a, b])
    assert np.linalg.norm(v[0]) == pytest.approx(1) and not v[1].any()
    got = {r.id: r.vector for r in embed_images(spark.createDataFrame([(1, bytearray(a)), (2, None), (3, bytearray())], "id int, image binary"), "id", "image", batch=1).collect()}
    assert np.allclose(got[1], v[0]) and got[2] is None and got[3] is None
    assert picture_size(a) > picture_size(b)
    rng = np.random.default_rng(1)
    still = rng.integers(0, 256, (6, 8))
    assert ShiftFlow().flow(still, np.roll(still, 1, 1))[:3] == (1.0, 0.0, 1.0) and ShiftFlow().flow(still, still) == (0.0, 0.0, 0.0, 0.0)
    with pytest.raises(ValueError, match="no captioner"):
        models.captioner("none")


def test_refill_stops_when_nothing_gets_better(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, ""), (4, None)], "id int, c string")
    tried = []

    def again(bad, n):
        tried.append(n)
        return bad.select("id", F.when((F.col("id") == 2) & F.lit(n == 2), F.lit("b")).alias("c"))

    out, report = refill(df, ["id"], "c", lambda c: c == "", again, rounds=9)
    assert {r.id: r.c for r in out.collect()} == {1: "a", 2: "b", 3: "", 4: None}
    assert tried == [1, 2, 3, 4, 5] and report == [(0, 3), (1, 2), (0, 2), (0, 2), (0, 2)]
    assert refill(df.where("id = 1"), ["id"], "c", lambda c: c == "", again)[1] == []
