"""Shots to events and scenes: the composite of curves, peaks, suppression and tiling."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filmstrip.operators import folds
from filmstrip.operators import windows as W

DEFAULT_FPS = 25.0


@dataclass(frozen=True)
class SegmentConfig:
    """Parameters of event segmentation; samples are `stride` frames apart."""

    stride: int = 5
    min_sec: float = 0.4
    most: int = 8
    weight: float = 0.5
    threshold: float = 0.25
    sigma: float = 1.0
    window_sec: float = 0.5
    change_floor: float = 0.03
    turn_floor: float = 0.8


def boundary_curve(samples: DataFrame, key: list[str], halves: list[int], c: SegmentConfig) -> DataFrame:
    """samples (key, i, dx, dy, mag, real, gray as an array, __half) with score: change of look and turn of motion, each
    smoothed and set against its floor, weighted. __half, the same for all samples of a key, is one of `halves`."""
    by, whole = W.over(key, "i")
    width = samples.select(F.size("gray")).limit(1).first()
    size = width[0] if width else 0
    looks = [F.get("gray", F.lit(k)) for k in range(size)]

    def of_half(curve: Callable[[int], Column]) -> Column:
        return F.coalesce(*[F.when(F.col("__half") == h, curve(h)) for h in halves], F.lit(0.0))

    change = of_half(lambda h: W.predictability(looks, by, whole, h))
    turn = of_half(lambda h: W.turning(F.col("dx"), F.col("dy"), F.col("mag"), F.col("real"), by, h))
    rows = samples.withColumn("__c", change).withColumn("__t", turn)
    rows = rows.withColumn("__c", W.smooth(F.col("__c"), by, whole, c.sigma)).withColumn("__t", W.smooth(F.col("__t"), by, whole, c.sigma))
    score = c.weight * W.floor_normalised(F.col("__c"), whole, c.change_floor) + (1 - c.weight) * W.floor_normalised(F.col("__t"), whole, c.turn_floor)
    return rows.withColumn("score", score).drop("__c", "__t")


def segment(samples: DataFrame, shots: DataFrame, key: list[str], fps: float | str, c: SegmentConfig = SegmentConfig()) -> DataFrame:
    """key, ord, start, end, anchor: events that tile each shot (key, start_frame, end_frame). samples: key, i, fidx, dx,
    dy, mag, real, gray. Boundaries are peaks of the curve, the best first, none nearer to another or to an end of the
    shot than the least length; a shot with fewer than four samples or no boundary is one event.

    fps is a rate for all shots or the column of shots that has each one's own, 25 where that is null or 0. The curve is
    worked out for each size of half window that a rate gives."""
    rate = F.coalesce(F.nullif(F.col(fps).cast("double"), F.lit(0.0)), F.lit(DEFAULT_FPS)) if isinstance(fps, str) else F.lit(float(fps))
    half = F.greatest(F.lit(1), F.bround(c.window_sec * rate / c.stride)).cast("int")
    own = shots.groupBy(*key).agg(F.min("start_frame").alias("__s"), F.max("end_frame").alias("__e"), F.max(half).alias("__half"), F.max(F.ceil(c.min_sec * rate)).alias("__gap"))
    halves = sorted(r[0] for r in own.select("__half").distinct().collect())  # a row a size of window
    by, _ = W.over(key, "i")
    n = F.count(F.lit(1)).over(Window.partitionBy(*key))
    curve = boundary_curve(samples.join(own, key), key, halves, c).withColumn("peak", W.is_peak(F.col("score"), by, c.threshold) & (n >= 4)).where("peak")
    curve = curve.where((F.col("fidx") - F.col("__s") >= F.col("__gap")) & (F.col("__e") + 1 - F.col("fidx") >= F.col("__gap")))
    items = folds.collected(curve.select(*key, "__gap", (-F.col("score")).alias("worst"), "fidx"), [*key, "__gap"], ["worst", "fidx"], ["worst", "fidx"])
    cuts = folds.suppressed(items, lambda x: x["fidx"], F.col("__gap"), c.most - 1).select(*key, F.explode("kept").alias("k")).select(*key, F.col("k.fidx").alias("cut"))
    rows = shots.join(cuts, key, "left").withColumn("cut", F.coalesce("cut", F.col("start_frame")))
    return W.segments(rows, key, "cut", "start_frame", "end_frame")


def scenes(shots: DataFrame, video: str, order: str, look: str, threshold: float = 0.12, most_sec: float = 60.0, disabled: bool = False) -> DataFrame:
    """shots (video, order, start_time, end_time, look as an array of doubles) with scene_id: neighbours whose looks are
    nearer than threshold share a scene of most_sec at most; disabled, each shot is its own scene. One video's shots are
    a bounded sequence, folded in the JVM."""
    if disabled:
        return shots.select(video, order, F.col(order).alias("scene_id"))
    from filmstrip.functions.vectors import rms

    items = folds.collected(shots.select(video, order, "start_time", "end_time", look), [video], [order], [order, "start_time", "end_time", look])
    rows = folds.capped_groups(items, lambda a, b: rms(a[look], b[look]), threshold, lambda first, x: x["end_time"] - first["start_time"], most_sec)
    return rows.select(video, F.explode(F.arrays_zip("items", "labels")).alias("x")).select(video, F.col(f"x.items.{order}").alias(order), F.col("x.labels").alias("scene_id"))
