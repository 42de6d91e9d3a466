"""Checks of derived tables: nine invariants of events, and how distinct neighbouring keyframes are."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def check_events(events: DataFrame, shots: DataFrame, frame_limit: DataFrame, min_sec: float = 0.4) -> DataFrame:
    """rule, broken: how many rows break each rule. events has the event table's columns, shots the shots', frame_limit
    video_id and n_frames. Rules: frames exist, ends in order, anchor inside, shot is tiled, ord_in_shot counts from 0,
    event_ord counts from 0 in its scene, one fps a video, keyframes inside, shot exists, events last min_sec."""
    by_shot = Window.partitionBy("video_id", "shot_index").orderBy("ord_in_shot", "id")
    by_scene = Window.partitionBy("video_id", "scene_id").orderBy("event_ord", "id")
    e = events.join(frame_limit, "video_id", "left")
    e = e.withColumn("prev_end", F.lag("end_frame").over(by_shot)).withColumn("seat", F.row_number().over(by_shot) - 1).withColumn("scene_seat", F.row_number().over(by_scene) - 1)
    fps = events.groupBy("video_id").agg((F.countDistinct("fps") > 1).alias("x")).agg(F.count_if("x").alias("broken")).select(F.lit("one fps").alias("rule"), "broken")
    outside = F.exists("keyframe_frames", lambda f: (f < F.col("start_frame")) | (f > F.col("end_frame")))
    rules = {
        "frames exist": (F.col("start_frame") < 0) | (F.col("end_frame") >= F.col("n_frames")),
        "ends in order": F.col("end_frame") < F.col("start_frame"),
        "anchor inside": ~F.col("anchor_frame").between(F.col("start_frame"), F.col("end_frame")),
        "tiled": F.col("prev_end") + 1 != F.col("start_frame"),
        "ord_in_shot": F.col("ord_in_shot") != F.col("seat"),
        "event_ord": F.col("event_ord") != F.col("scene_seat"),
        "keyframes inside": outside,
        "long enough": F.col("end_frame") - F.col("start_frame") + 1 < min_sec * F.col("fps"),
    }
    counts = e.agg(*[F.count_if(F.coalesce(test, F.lit(False))).alias(name) for name, test in rules.items()])
    flat = counts.select(F.explode(F.map_from_arrays(F.array(*[F.lit(n) for n in rules]), F.array(*[F.col(f"`{n}`") for n in rules]))).alias("rule", "broken"))
    orphans = events.join(shots, ["video_id", "shot_index"], "left_anti").agg(F.count(F.lit(1)).alias("broken")).select(F.lit("shot exists").alias("rule"), "broken")
    return reduce(DataFrame.unionByName, [flat, fps, orphans])
