import itertools
import random

import pytest
from pyspark.sql import functions as F

from filmstrip.operators import align


def table(spark, scenes):
    data = [(s, p, sims) for s, (pos, cols) in scenes.items() for p, sims in zip(pos, cols)]
    return spark.createDataFrame(data, "scene string, pos long, sims array<double>")


def result(spark, scenes, n, gap=1, lam=0.0):
    return {r.scene: (r.path, r.score) for r in align.align(table(spark, scenes), ["scene"], "pos", "sims", n, gap, lam).collect()}


def cols(matrix):
    return list(map(list, zip(*matrix)))


def test_known_cases(spark):
    diag = cols([[0.9 if i == j else 0.1 for j in range(4)] for i in range(3)])
    assert result(spark, {"d": (range(4), diag)}, 3)["d"][0] == [0, 1, 2]
    path, score = result(spark, {"t": (range(4), cols([[0.2, 0.3, 0.4, 0.95], [0.1, 0.90, 0.2, 0.30]]))}, 2)["t"]
    assert path == [0, 1] and score == pytest.approx(1.10)
    pos = [0, 3, 30, 33, 60]
    path, _ = result(spark, {"g": (pos, cols([[0.9, 0.8, 0.1, 0.1, 0.1], [0.1, 0.1, 0.85, 0.9, 0.1]]))}, 2, 10)["g"]
    assert path[1] - path[0] >= 10
    assert result(spark, {"x": (range(2), cols([[0.0] * 2] * 3))}, 3) == {}
    assert result(spark, {"o": (range(3), cols([[0.1, 0.5, 0.3]]))}, 1)["o"][0] == [1]


def test_penalty(spark):
    m = cols([[0.9, 0.1, 0.1, 0.1, 0.1, 0.1, 0.1], [0.1, 0.80, 0.1, 0.1, 0.1, 0.1, 0.82]])
    assert result(spark, {"p": (range(7), m)}, 2)["p"][0][1] == 6
    assert result(spark, {"p": (range(7), m)}, 2, lam=0.05)["p"][0][1] == 1


@pytest.mark.parametrize("n,gap", [(2, 1), (3, 2), (4, 1)])
def test_against_all_paths(spark, n, gap):
    rng = random.Random(n * 10 + gap)
    scenes = {}
    for s in range(25):
        t = rng.randrange(1 + (n - 1) * gap, 9 + n)
        scenes[str(s)] = (range(t), [[rng.random() for _ in range(n)] for _ in range(t)])
    got = result(spark, scenes, n, gap)
    for s, (pos, sims) in scenes.items():
        paths = [p for p in itertools.combinations(pos, n) if all(b - a >= gap for a, b in zip(p, p[1:]))]
        if not paths:
            assert s not in got
            continue
        assert got[s][1] == pytest.approx(max(sum(sims[f][i] for i, f in enumerate(p)) for p in paths), abs=1e-9)


def test_spread(spark):
    df = spark.createDataFrame([(1000, 995, 1005), (2000, 2500, 2600)], "f long, lo long, hi long")
    got = df.select(align.spread(F.col("f"), 4, 100).alias("a"), align.spread(F.col("f"), 1, 100, 8, 12, F.col("lo"), F.col("hi")).alias("b"), align.spread(F.col("f"), 2, 100, 8, 40).alias("c")).collect()
    assert got[0].a == [992, 1000, 1008] and got[0].b == [1000] and got[1].b == [2500] and len(got[0].c) == 10


def test_apex(spark):
    flow = spark.createDataFrame([("v", f, m) for f, m in zip((100, 103, 106, 109, 112), (0.2, 0.3, 2.5, 0.4, 0.1))], "v string, f long, m double")
    centres = spark.createDataFrame([("v", 104), ("v", 500), ("w", 104)], "v string, c long")
    got = {(r.v, r.c): r.apex for r in align.snap_to_apex(centres, flow, "v", "c", "f", "m", 5).collect()}
    assert got == {("v", 104): 106, ("v", 500): 500, ("w", 104): 104}


def test_fusion_prefers_the_weightier(spark):
    data = [("s", ch, i, x, w) for ch, xs, w in (("clip", (0.1, 0.9, 0.2), 3.0), ("e5", (0.9, 0.1, 0.2), 1.0)) for i, x in enumerate(xs)]
    df = spark.createDataFrame(data, "s string, ch string, cand long, sim double, w double")
    best = lambda d: max(d.collect(), key=lambda r: r.fused).cand
    assert best(align.reciprocal_fusion(df, ["s"], "ch", "cand", "sim", "w")) == 1
    assert best(align.weighted_fusion(df, ["s"], "ch", "cand", "sim", "w")) == 1
