"""Keyframe strategies by name, over the sampled frames of shots."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filmstrip.functions.vectors import relative_change
from filmstrip.operators import folds
from filmstrip.operators import windows as W
from filmstrip.operators.joins import forward_clamped
from filmstrip.operators.search import top_per_key

SHOT = ["video_id", "shot_index"]
OUT = [*SHOT, "frame_idx"]
Apart = Callable[[Column, Column], Column]


def middle_of(shots: DataFrame) -> Column:
    return F.floor((shots["start_frame"] + shots["end_frame"]) / 2).cast("long")


def middle(shots: DataFrame, samples: DataFrame | None = None) -> DataFrame:
    """Each shot's middle frame."""
    return shots.select(*SHOT, middle_of(shots).alias("frame_idx"))


def uniform(shots: DataFrame, samples: DataFrame | None = None, step: int = 24) -> DataFrame:
    """Every `step`-th frame from the shot's first on; the first alone of a shot that ends before it."""
    every = F.when(F.col("end_frame") >= F.col("start_frame"), F.sequence("start_frame", "end_frame", F.lit(max(1, step)).cast("long"))).otherwise(F.array("start_frame"))
    return shots.select(*SHOT, F.explode(every).alias("frame_idx"))


def _on_grid(shots: DataFrame, samples: DataFrame, step: int | Column) -> DataFrame:
    """The samples inside their shot that lie on its grid of `step` frames, with the shot's bounds and rate."""
    rate = F.coalesce(F.nullif("fps", F.lit(0.0)), F.lit(25.0))
    bounds = shots.select(*SHOT, F.col("start_frame").alias("__a"), F.col("end_frame").alias("__b"), rate.alias("__fps"))
    rows = samples.join(bounds, SHOT).where(F.col("frame_idx").between(F.col("__a"), F.col("__b")))
    return rows.where((F.col("frame_idx") - F.col("__a")) % step == 0)


def _with_middles(shots: DataFrame, picked: DataFrame) -> DataFrame:
    """picked, and the middle frame of each shot of which nothing was."""
    empty = shots.join(picked.select(*SHOT).distinct(), SHOT, "left_anti")
    return picked.unionByName(empty.select(*SHOT, F.floor((F.col("start_frame") + F.col("end_frame")) / 2).cast("long").alias("frame_idx")))


def _folded(rows: DataFrame, fields: list[str], min_gap_sec: float = 0.0) -> DataFrame:
    """The samples of each shot as an array, with its middle frame and least gap in frames (1 at least)."""
    rows = rows.withColumn("__gap", F.greatest(F.lit(1), F.floor(min_gap_sec * F.col("__fps")))).withColumn("__mid", F.floor((F.col("__a") + F.col("__b")) / 2))
    return folds.collected(rows, [*SHOT, "__gap", "__mid"], ["frame_idx"], ["frame_idx", *fields])


def _frames(kept: DataFrame) -> DataFrame:
    return kept.select(*SHOT, F.explode(F.transform("kept", lambda x: x["frame_idx"])).alias("frame_idx"))


def _gap(a: Column, b: Column) -> Column:
    return b["frame_idx"] - a["frame_idx"]


def adaptive(shots: DataFrame, samples: DataFrame, apart: Apart, fields: list[str], most: int = 3, threshold: float = 0.35, min_gap_sec: float = 1.0, step: int | Column = 6) -> DataFrame:
    """The sample nearest to the shot's middle, and the ones least like all kept, if unlike enough and not too near."""
    items = _folded(_on_grid(shots, samples, step), fields, min_gap_sec)
    picks = folds.max_min_picks(items, apart, lambda x: x["frame_idx"], most, threshold, F.col("__gap"), F.col("__mid"))
    return _with_middles(shots, _frames(picks))


def dake(shots: DataFrame, samples: DataFrame, size: str = "size", ratio: float = 0.02, window_sec: float = 2.0, absolute: bool = False) -> DataFrame:
    """The samples of each video after which picture sizes rise most steeply, one at least in each window of time; each
    in the first shot that ends at or after it, or in the last. samples need no shot here."""
    rate = F.max(F.coalesce(F.nullif("fps", F.lit(0.0)), F.lit(25.0)))
    window = shots.groupBy("video_id").agg(F.greatest(F.lit(1), F.floor(window_sec * rate)).alias("__win"))
    rows = samples.dropna(subset=["video_id", "frame_idx", size]).join(window, "video_id")
    picks = W.steepest(rows, ["video_id"], "frame_idx", size, ratio, F.col("__win"), absolute).select("video_id", "frame_idx").distinct()
    named = picks.select("video_id", "frame_idx", F.struct("video_id", "frame_idx").alias("__id"))
    placed = forward_clamped(named, shots, "video_id", "frame_idx", "__id", "end_frame", "shot_index")
    return placed.select("__id.video_id", "shot_index", "__id.frame_idx")


def dake_per_shot(shots: DataFrame, samples: DataFrame, size: str = "size", most: int = 3, step: int | Column = 4) -> DataFrame:
    """The `most` largest pictures of each shot, ties to the later."""
    rows = _on_grid(shots, samples, step)
    return _with_middles(shots, top_per_key(rows, SHOT, [F.desc(size), F.desc("frame_idx")], most).select(*OUT))


def clip_reldiff(shots: DataFrame, samples: DataFrame, vector: str = "vector", threshold: float = 0.4, step: int | Column = 8) -> DataFrame:
    """The first sample of each shot and each whose vector is farther from the last one kept than a share of its length."""
    items = _folded(_on_grid(shots, samples, step), [vector])
    return _with_middles(shots, _frames(folds.changed_from_last(items, lambda a, b: relative_change(a[vector], b[vector]), threshold)))


def action(shots: DataFrame, samples: DataFrame, apart: Apart, fields: list[str], most: int = 10, threshold: float = 0.3, min_gap_sec: float = 0.4) -> DataFrame:
    """The first sample of each shot, those unlike the last one kept and not too near to it and, if there is room, the
    last sample, for which half the threshold will do. samples are as dense as they should be."""
    items = _folded(_on_grid(shots, samples, 1), fields, min_gap_sec)
    picks = folds.changed_from_last(items, apart, threshold, _gap, F.col("__gap"), most, end_share=0.5)
    return _with_middles(shots, _frames(picks))


STRATEGIES: dict[str, Callable[..., DataFrame]] = {"middle": middle, "uniform": uniform, "adaptive": adaptive, "dake": dake, "dake_per_shot": dake_per_shot, "clip_reldiff": clip_reldiff, "action": action}


def keyframes(name: str, shots: DataFrame, samples: DataFrame | None = None, **parameters: object) -> DataFrame:
    """video_id, shot_index, frame_idx of the frames that a strategy picks of shots (video_id, shot_index, start_frame,
    end_frame, fps), from samples (video_id, shot_index, frame_idx and what the strategy compares). A shot in which a
    strategy finds no sample gives its middle frame. Samples with nulls in these columns or outside their shot take no
    part; a shot that ends before it begins has no sample."""
    if name not in STRATEGIES:
        raise ValueError(f"no strategy {name!r}; there are {sorted(STRATEGIES)}")
    return STRATEGIES[name](shots, samples, **parameters)
