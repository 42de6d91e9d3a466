"""Shots of videos from samples of their frames, by detectors that have a name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from filmstrip.operators import folds
from filmstrip.operators import windows as W

OUT = ["video_id", "shot_index", "start_frame", "end_frame"]


def content(videos: DataFrame, samples: DataFrame, look: str = "look", threshold: float = 27.0, min_len: int = 15) -> DataFrame:
    """A cut is a sample whose look (an array) differs from the one before by `threshold` or more on average, if it is
    at least min_len frames after the last cut. A video without cuts is one shot."""
    by = Window.partitionBy("video_id").orderBy("frame_idx")
    before = F.lag(look).over(by)
    score = F.aggregate(F.zip_with(look, before, lambda a, b: F.abs(a - b)), F.lit(0.0), lambda s, x: s + x) / F.size(look)
    marked = samples.withColumn("__score", score).where(F.col("__score") >= threshold).select("video_id", "frame_idx")
    # the video's beginning counts as a cut; from there on each cut must be far enough from the last one
    begins = videos.select("video_id", F.lit(0).cast("long").alias("frame_idx"))
    items = folds.collected(begins.unionByName(marked.where("frame_idx > 0")), ["video_id"], ["frame_idx"], ["frame_idx"])
    kept = folds.changed_from_last(items, lambda a, b: b["frame_idx"] - a["frame_idx"], min_len - 1)
    cuts = kept.select("video_id", F.explode("kept").alias("k")).select("video_id", F.col("k.frame_idx").alias("cut"))
    whole = videos.join(cuts, "video_id").withColumn("__a", F.lit(0).cast("long")).withColumn("__b", F.col("n_frames") - 1)
    return W.segments(whole, ["video_id"], "cut", "__a", "__b").select("video_id", F.col("ord").alias("shot_index"), F.col("start").alias("start_frame"), F.col("end").alias("end_frame"))


def transitions(videos: DataFrame, samples: DataFrame, probability: str = "probability", threshold: float = 0.5) -> DataFrame:
    """Shots are what lies between samples whose probability of a transition, as a model gives it, is above the
    threshold; such samples are in no shot. A video of transitions alone, or without samples, is one shot."""
    by = Window.partitionBy("video_id").orderBy("frame_idx")
    on = F.col(probability) > threshold
    rows = samples.join(videos.select("video_id", "n_frames"), "video_id").where(F.col("frame_idx") < F.col("n_frames"))
    rows = rows.withColumn("__on", on).withColumn("__was", F.coalesce(F.lag(on).over(by), F.lit(False)))
    sides = rows.groupBy("video_id").agg(
        F.array_sort(F.collect_list(F.when(F.col("__was") & ~F.col("__on"), F.col("frame_idx")))).alias("__starts"),
        F.array_sort(F.collect_list(F.when(F.col("__on") & ~F.col("__was") & (F.col("frame_idx") > 0), F.col("frame_idx") - 1))).alias("__ends"),
        F.max(F.struct("frame_idx", "__on"))["__on"].alias("__last"),
    )
    none, last = F.array().cast("array<bigint>"), F.array(F.col("n_frames").cast("bigint") - 1)
    whole = videos.select("video_id", "n_frames").join(sides, "video_id", "left")
    starts = F.concat(F.array(F.lit(0).cast("bigint")), F.coalesce("__starts", none))
    ends = F.concat(F.coalesce("__ends", none), F.when(F.coalesce("__last", F.lit(False)), none).otherwise(last))
    found = F.filter(F.transform(starts, lambda a: F.struct(a.alias("a"), F.array_min(F.filter(ends, lambda z: z >= a)).alias("z"))), lambda x: x["z"].isNotNull())
    whole = whole.withColumn("__x", F.when(F.size(found) > 0, found).otherwise(F.array(F.struct(F.lit(0).cast("bigint").alias("a"), (F.col("n_frames").cast("bigint") - 1).alias("z")))))
    return whole.select("video_id", F.posexplode("__x").alias("shot_index", "x")).select("video_id", "shot_index", F.col("x.a").alias("start_frame"), F.col("x.z").alias("end_frame"))


#: Detectors by name. The two shot models of the field give probabilities, which transitions() turns into shots.
DETECTORS: dict[str, Callable[..., DataFrame]] = {"content": content, "transitions": transitions, "autoshot": transitions, "transnetv2": transitions}


def shots(name: str, videos: DataFrame, samples: DataFrame, **parameters: object) -> DataFrame:
    """video_id, shot_index, start_frame, end_frame of videos (video_id, n_frames, one row each) by a detector, from
    samples (video_id, frame_idx and what it looks at). A video's samples are a bounded sequence."""
    if name not in DETECTORS:
        raise ValueError(f"no detector {name!r}; there are {sorted(DETECTORS)}")
    return DETECTORS[name](videos, samples, **parameters)
