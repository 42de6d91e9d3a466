from collections import defaultdict
from types import SimpleNamespace

import numpy as np

from filmstrip.catalog.pipelines import segmented_shots
from filmstrip.plans.segmentation import SegmentConfig, scenes, segment
from filmstrip.plans.strategies import keyframes

SAMPLES = "v string, shot int, i int, fidx long, dx double, dy double, mag double, real boolean, gray array<double>"


def shot(n, start, gray, flow, real=lambda i: i > 0):
    return [("v", 7, i, start + 5 * i, *flow(i), real(i), [float(g) for g in gray(i)]) for i in range(n)]


def run(spark, samples, start, end, c=SegmentConfig()):
    df = spark.createDataFrame(samples, SAMPLES)
    shots = spark.createDataFrame([("v", 7, start, end)], "v string, shot int, start_frame long, end_frame long")
    return sorted((r.ord, r.start, r.end, r.anchor) for r in segment(df, shots, ["v", "shot"], 30.0, c).collect())


def tiles(events, start, end):
    assert [e[0] for e in events] == list(range(len(events)))
    assert events[0][1] == start and events[-1][2] == end
    assert all(a[2] + 1 == b[1] for a, b in zip(events, events[1:]))
    assert all(e[1] <= e[3] <= e[2] for e in events)


def test_look_and_motion_change_together(spark):
    samples = shot(40, 1000, lambda i: [0.0 if i < 20 else 1.0] * 4, lambda i: (0.0, 0.0, 0.0) if i == 0 else (1.0 if i < 20 else -1.0, 0.0, 1.0))
    events = run(spark, samples, 1000, 1199)
    tiles(events, 1000, 1199)
    assert len(events) > 1 and any(abs(e[1] - 1100) <= 5 for e in events[1:])
    assert all(e[2] - e[1] + 1 >= 12 for e in events)


def test_short_flat_and_noisy_shots_are_one_event(spark):
    assert run(spark, shot(2, 0, lambda i: [0.0] * 4, lambda i: (0.0, 0.0, 0.0)), 0, 5) == [(0, 0, 5, 2)]
    assert len(run(spark, shot(40, 0, lambda i: [0.0] * 4, lambda i: (0.0, 0.0, 0.0)), 0, 199)) == 1
    rng = np.random.default_rng(7)
    noise = [(0.05 * np.cos(a), 0.05 * np.sin(a), 0.05) for a in rng.uniform(0, 6.28, 40)]
    gray = 120 / 255 + rng.normal(0, 2 / 255, (40, 16))
    assert len(run(spark, shot(40, 0, lambda i: gray[i], lambda i: tuple(map(float, noise[i]))), 0, 199)) == 1


def test_scenes(spark):
    rows = [("v", 0, 0.0, 4.0, [0.1] * 4), ("v", 1, 4.0, 8.0, [0.12] * 4), ("v", 2, 8.0, 12.0, [0.9] * 4)]
    df = spark.createDataFrame(rows, "v string, o int, start_time double, end_time double, look array<double>")
    got = {r.o: r.scene_id for r in scenes(df, "v", "o", "look").collect()}
    assert got[0] == got[1] != got[2]
    assert len({r.scene_id for r in scenes(df, "v", "o", "look", most_sec=5).collect()}) == 3
    assert [r.scene_id for r in scenes(df, "v", "o", "look", disabled=True).orderBy("o").collect()] == [0, 1, 2]


def test_strategies(spark):
    shots = spark.createDataFrame([("v", 0, 0, 100)], "video_id string, shot_index int, start_frame long, end_frame long")
    assert [r.frame_idx for r in keyframes("middle", shots).collect()] == [50]
    assert [r.frame_idx for r in keyframes("uniform", shots, step=40).collect()] == [0, 40, 80]


def test_each_shot_has_its_own_rate(spark):
    rng = np.random.default_rng(5)
    rates = {"a": 24.0, "b": 25.0, "c": 29.97, "d": 30.0, "e": None, "f": 0.0}
    drawn = [(i, 2 * i, float(rng.uniform(0, 3)), float(rng.uniform(0, 1))) for i in range(90)]
    ev = spark.createDataFrame([(v, 7, i, f, m, b) for v in rates for i, f, m, b in drawn], "video_id string, shot_index int, id long, anchor_frame long, mag_mean double, boundary_score double")

    def cut(fps):
        sh = spark.createDataFrame([(v, 7, 0, 179, r) for v, r in fps.items()], "video_id string, shot_index int, start_frame long, end_frame long, fps double")
        out = defaultdict(list)
        for r in segmented_shots(SimpleNamespace(ev=ev, sh=sh)).collect():
            out[r.video_id].append((r.ord, r.start_frame, r.end_frame))
        return {v: sorted(x) for v, x in out.items()}

    got = cut(rates)
    assert got["b"] == got["e"] == got["f"] != got["d"]
    for v, least in {"a": 10, "b": 10, "c": 12, "d": 12, "e": 10, "f": 10}.items():
        tiles([(*x, x[1]) for x in got[v]], 0, 179)
        assert len(got[v]) > 1 and all(e - s + 1 >= least for _, s, e in got[v])
    # as when all shots have that rate
    assert got["d"] == cut(dict.fromkeys(rates, 30.0))["d"]
    assert got["a"] == cut(dict.fromkeys(rates, 24.0))["a"]


def test_strategies_on_one_shot(spark):
    """Empty shots give their middle; the action strategy keeps the shot's end for half the threshold."""
    shots = spark.createDataFrame([("v", 0, 0, 99, 25.0), ("v", 1, 100, 150, None)], "video_id string, shot_index int, start_frame long, end_frame long, fps double")
    data = [(0, 0.0), (10, 0.1), (20, 0.5), (25, 1.0), (60, 0.9), (99, 0.8), (999, 5.0)]
    samples = spark.createDataFrame([("v", 0, f, y, [y, 1.0], y) for f, y in data], "video_id string, shot_index int, frame_idx long, y double, vector array<double>, size double")
    def picked(name, **more):
        return sorted((r.shot_index, r.frame_idx) for r in keyframes(name, shots, samples, **more).collect())
    by_y = {"apart": lambda a, b: abs_(a["y"] - b["y"]), "fields": ["y"]}
    from pyspark.sql.functions import abs as abs_
    assert picked("action", **by_y) == [(0, 0), (0, 20), (0, 60), (1, 125)]
    assert picked("action", **by_y, threshold=0.35, min_gap_sec=0.2) == [(0, 0), (0, 20), (0, 25), (0, 99), (1, 125)]
    assert picked("adaptive", **by_y, step=1) == [(0, 0), (0, 60), (1, 125)]
    assert picked("clip_reldiff", step=1) == [(0, 0), (0, 20), (0, 25), (1, 125)]
    assert picked("dake_per_shot", step=1, most=2) == [(0, 25), (0, 60), (1, 125)]
    with __import__("pytest").raises(ValueError, match="no strategy"):
        keyframes("best", shots)
