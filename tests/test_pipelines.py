import numpy as np
from pyspark.sql import functions as F

from filmstrip.functions import pixels
from filmstrip.plans.localise import localise


def test_pictures(spark):
    red, blue = bytes([0, 0, 255] * 48), bytes([255, 0, 0] * 48)
    half = bytes([0, 0, 255] * 24 + [255, 0, 0] * 24)
    df = spark.createDataFrame([("v", 0, i, i, None if b is None else bytearray(b)) for i, b in enumerate((red, red, blue, half, None, red[:20]))], "v string, s int, f long, id long, image binary")
    got = {r.id: (r.brightness, r.colours) for r in pixels.looks(df, "id", "image").collect()}
    assert got[0] == (85.0, 1) and got[3] == (85.0, 2) and got[4] == got[5] == (None, None)
    assert {r.id for r in pixels.distinct_pictures(df, ["v", "s"], "f", "id", "image", 0.2).collect()} == {0, 2, 3}
    assert pixels.distinct_pictures(df.limit(0), ["v", "s"], "f", "id", "image", 0.2).count() == 0


def test_hue():
    h, s = pixels.hue_saturation(np.array([[[0, 0, 255], [0, 255, 0], [255, 0, 0], [7, 7, 7]]], np.uint8))
    assert h.tolist() == [0, 60, 120, 0] and s.tolist() == [255, 255, 255, 0]
    assert abs(np.linalg.norm(pixels.colour_histogram(np.zeros((2, 2, 3), np.uint8))) - 1) < 1e-9


def test_phases_are_found_in_order(spark):
    rng = np.random.default_rng(1)
    vecs = rng.normal(size=(30, 8))
    cands = spark.createDataFrame([("s", i * 10, v.tolist(), v.tolist()) for i, v in enumerate(vecs)], "scene string, pos long, clip array<double>, e5 array<double>")
    phases = spark.createDataFrame([("s", k, vecs[i].tolist(), vecs[i].tolist()) for k, i in enumerate((3, 11, 26))], "scene string, phase int, clip array<double>, e5 array<double>")
    args = ("scene", "pos", "phase", {"clip": 3.0, "e5": 1.0}, 3)
    assert localise(cands, phases, *args).first().path == [30, 110, 260]
    assert localise(cands.withColumn("e5", F.lit(None).cast("array<double>")), phases, *args).first().path == [30, 110, 260]
    assert localise(cands, phases.limit(0), *args).count() == 0
