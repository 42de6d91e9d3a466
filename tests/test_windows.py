import math
import random

from pyspark.sql import functions as F

from filmstrip.operators import windows as W

KEY = ["k"]


def series(spark, n=6):
    rng = random.Random(8)
    data = {k: [round(rng.random(), 3) for _ in range(rng.randrange(1, 14))] for k in range(n)}
    return data, spark.createDataFrame([(k, i, y) for k, ys in data.items() for i, y in enumerate(ys)], "k long, i long, y double")


def column(df, expr):
    out = {}
    for r in df.select("k", "i", expr.alias("x")).orderBy("k", "i").collect():
        out.setdefault(r.k, []).append(r.x)
    return out


def near(a, b):
    return all(len(a[k]) == len(b[k]) and all(math.isclose(x, y, abs_tol=1e-9) for x, y in zip(a[k], b[k])) for k in b)


def test_smoothing_repeats_the_ends(spark):
    data, df = series(spark)
    w = W.gaussian(1.0)
    want = {k: ys if len(ys) < 3 else [sum(g * ys[min(max(i + j - 3, 0), len(ys) - 1)] for j, g in enumerate(w)) for i in range(len(ys))] for k, ys in data.items()}
    assert near(column(df, W.smooth(F.col("y"), *W.over(KEY, "i"))), want)


def test_change_peaks_at_a_step_and_is_flat_elsewhere(spark):
    df = spark.createDataFrame([(0, i, float(i >= 10)) for i in range(20)], "k long, i long, y double")
    by, whole = W.over(KEY, "i")
    got = column(df, W.predictability([F.col("y")], by, whole, 3))[0]
    assert max(range(20), key=lambda i: got[i]) in (9, 10) and got[3] == got[16] == 0


def test_turning_sees_reversal_and_stop_but_not_noise(spark):
    rng = random.Random(0)
    by, _ = W.over(KEY, "i")
    rev = [(0.0, 0.0)] + [(1.0, 0.0)] * 10 + [(-1.0, 0.0)] * 10
    stop = [(0.0, 0.0)] + [(2.0, 0.0)] * 10 + [(0.0, 0.0)] * 10
    noise = [(0.0, 0.0)] + [(0.01 * math.cos(a), 0.01 * math.sin(a)) for a in (rng.random() * 6.28 for _ in range(30))]
    df = spark.createDataFrame([(k, i, x, y, math.hypot(x, y)) for k, s in enumerate((rev, stop, noise)) for i, (x, y) in enumerate(s)], "k long, i long, dx double, dy double, m double")
    got = column(df, W.turning(F.col("dx"), F.col("dy"), F.col("m"), F.col("i") > 0, by, 3))
    assert max(range(21), key=lambda i: got[0][i]) in range(9, 13) and max(range(21), key=lambda i: got[1][i]) in range(9, 13) and max(got[2]) < 0.05


def test_flat_data_stay_flat(spark):
    df = spark.createDataFrame([(0, i, 0.5 + 0.001 * (i % 2)) for i in range(8)], "k long, i long, y double")
    _, whole = W.over(KEY, "i")
    assert max(column(df, W.floor_normalised(F.col("y"), whole, 0.8))[0]) < 0.01
    assert max(column(df, W.min_max(F.col("y"), whole))[0]) == 1


def test_islands_and_ties(spark):
    df = spark.createDataFrame([("a", t) for t in (0.0, 5.0, 5.0, 50.0, 51.0, 200.0)], "k string, t double")
    assert sorted(r.s for r in W.islands(df, ["k"], "t", 30, "s").collect()) == [0, 0, 0, 1, 1, 2]


def test_steepest_of_one_and_two_samples(spark):
    df = spark.createDataFrame([("a", 0, 5.0), ("b", 0, 5.0), ("b", 1, 9.0)], "k string, i long, size double")
    assert {(r.k, r.i) for r in W.steepest(df, ["k"], "i", "size", 0.02, 10).collect()} == {("a", 0), ("b", 0)}


def test_segments_tile(spark):
    df = spark.createDataFrame([("a", c, 10, 49) for c in (5, 10, 20, 20, 35, 60)] + [("b", None, 0, 9)], "k string, cut long, s long, e long")
    got = sorted((r.k, r.ord, r.start, r.end, r.anchor) for r in W.segments(df, ["k"], "cut", "s", "e").collect())
    assert got == [("a", 0, 10, 19, 14), ("a", 1, 20, 34, 20), ("a", 2, 35, 49, 35), ("b", 0, 0, 9, 4)]
