"""Writers of the stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filmstrip.functions import ids
from filmstrip.operators.joins import latest
from filmstrip.plans.ordered import chunked, positions, scan
from filmstrip.plans.skew import join_small
from filmstrip.session import cut


def json_lines(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A line a row, nulls written too."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def per_video(df: DataFrame, path: str, by: tuple[str, ...] = ("video_id",)) -> None:
    """Parquet in a folder a video (and collection); only the folders of the videos in df are replaced."""
    df.repartition(*by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def frame_maps(keyframes: DataFrame, path: str) -> None:
    """n, pts_time, fps, frame_idx of each video as CSV with a header, a folder a video."""
    rows = keyframes.select("video_id", "n", "pts_time", "fps", "frame_idx")
    rows.repartition("video_id").sortWithinPartitions("video_id", "n").write.mode("overwrite").option("header", True).partitionBy("video_id").csv(path)


def numbered(keyframes: DataFrame) -> DataFrame:
    """keyframes (video_id, shot_index, frame_idx, ...) with id over all in order, n in the video, keyframe_id, shot_id."""
    placed = cut(positions(chunked(keyframes, ["video_id"], ["frame_idx"], seats=True), "id"))
    first = placed.groupBy("video_id").agg(F.min("id").alias("__first"))
    rows = join_small(placed, first, ["video_id"]).withColumn("n", (F.col("id") - F.col("__first") + 1).cast("int")).drop("__first")
    return rows.withColumn("keyframe_id", ids.keyframe_id(F.col("video_id"), F.col("n"))).withColumn("shot_id", ids.shot_id(F.col("video_id"), F.col("shot_index")))


def finalize(keyframes: DataFrame, shots: DataFrame, events: DataFrame | None, path: str) -> None:
    """keyframes, shots and (if there are any) events as JSON lines, and the maps of frames, below a folder."""
    k = numbered(keyframes)
    json_lines(k, f"{path}/keyframes")
    json_lines(shots, f"{path}/shots")
    if events is not None and not events.isEmpty():
        json_lines(events, f"{path}/events")
    frame_maps(k, f"{path}/map-keyframes")


def packaged(keyframes: DataFrame, present: DataFrame) -> DataFrame:
    """n, name, old_name, shot_id, keyframe_id, frame_idx per video: pictures renumbered from 1 in order of frames. A
    picture that isn't there (present: video_id, name) keeps its number, so numbers may have holes."""
    rows = scan(chunked(keyframes, ["video_id"], ["frame_idx"]), ["video_id"], ["frame_idx"], sums={"__n": F.lit(1)})
    rows = rows.withColumn("n", F.col("__n")).withColumn("old_name", ids.basename(F.col("keyframe_path")))
    there = present.select("video_id", F.col("name").alias("old_name")).distinct()
    return rows.join(there, ["video_id", "old_name"], "left_semi").select("video_id", "n", F.format_string("%03d.jpg", "n").alias("name"), "old_name", "shot_id", "keyframe_id", "frame_idx")


def rewritten(df: DataFrame, path: str, dry_run: bool = True) -> int:
    """df's rows in place of a Parquet folder. They are written beside it (.new), the old folder is moved away, kept once
    as .bak and else as .old, the new one moved in its place, and .old deleted last: at every moment a whole table is
    there under one of these names, and the next call puts back one that was moved away and not replaced. A dry run only
    counts. Works on any file system that Spark can reach."""
    n = df.count()
    if dry_run:
        return n
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    new, at, bak, old = (jvm.org.apache.hadoop.fs.Path(path + s) for s in (".new", "", ".bak", ".old"))
    fs = at.getFileSystem(conf)
    df.write.mode("overwrite").parquet(path + ".new")
    if not fs.exists(at) and fs.exists(old):
        fs.rename(old, at)
    away = old if fs.exists(bak) else bak
    fs.delete(old, True)
    if fs.exists(at):
        fs.rename(at, away)
    fs.rename(new, at)
    fs.delete(old, True)
    return n


def put(index: DataFrame | None, docs: DataFrame, key: str = "id") -> DataFrame:
    """An index with documents put in by key; those with a key that is there replace it."""
    rows = docs.withColumn("__new", F.lit(1)) if index is None else index.withColumn("__new", F.lit(0)).unionByName(docs.withColumn("__new", F.lit(1)), allowMissingColumns=True)
    return latest(rows, [key], [F.col("__new")]).drop("__new")


def append(df: DataFrame, path: str) -> None:
    """Rows added to a table that a later run reads to go on."""
    df.write.mode("append").json(path)


def report(scores: DataFrame, path: str) -> None:
    """A small report as one JSON file."""
    scores.coalesce(1).write.mode("overwrite").json(path)
