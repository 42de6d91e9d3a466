"""Ids, names and paths of videos, shots and keyframes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def keyframe_id(video: Column, n: Column) -> Column:
    """video_kf000000 from the keyframe's number in its video, counted from 1."""
    return F.format_string("%s_kf%06d", video, n - 1)


def shot_id(video: Column, shot: Column) -> Column:
    return F.format_string("%s_shot%05d", video, shot)


def image_name(shot: Column, frame: Column) -> Column:
    return F.format_string("shot%04d_f%07d.jpg", shot, frame)


def numbered(prefix: str, number: Column, width: int = 3) -> Column:
    """prefix and the number with leading zeros, such as kis_007 or q012."""
    return F.format_string(f"{prefix}%0{width}d", number)


def collection(video: Column) -> Column:
    """What stands before the first underscore."""
    return F.split_part(video, F.lit("_"), F.lit(1))


def slashes(path: Column) -> Column:
    return F.regexp_replace(path, r"\\", "/")


def basename(path: Column) -> Column:
    return F.substring_index(slashes(path), "/", -1)


def stem(path: Column) -> Column:
    return F.regexp_replace(basename(path), r"\.[^.]*$", "")


def parse_image_path(path: Column) -> Column:
    """Struct of video_id (the folder), shot (shotN) and frame of a keyframe's path; raises on any other path, null stays null."""
    clean = slashes(path)
    pattern = r"([^/]+)/(shot\d+)_f(\d+)\.jpg$"
    got = F.struct(F.regexp_extract(clean, pattern, 1).alias("video_id"), F.regexp_extract(clean, pattern, 2).alias("shot"), F.regexp_extract(clean, pattern, 3).cast("long").alias("frame"))
    broken = F.raise_error(F.concat(F.lit("not a keyframe path: "), clean)).cast(got_type())
    return F.when(path.isNull(), None).when(clean.rlike(pattern), got).otherwise(broken)


def got_type() -> str:
    return "struct<video_id: string, shot: string, frame: bigint>"


def with_prefix(path: Column, old: str, new: str) -> Column:
    """path with the folder old replaced by new where it begins with it."""
    return F.when(path.startswith(old), F.concat(F.lit(new), F.substring(path, F.lit(len(old) + 1), F.length(path)))).otherwise(path)


def remap(path: Column, video: Column, root: str) -> Column:
    """root/collection/video/name for a path of any machine."""
    return F.concat_ws("/", F.lit(root), collection(video), video, basename(path))


def next_index(names: Column) -> Column:
    """An aggregate: one more than the greatest number at the end of the names (1 if there is none)."""
    return F.coalesce(F.max(F.regexp_extract(names, r"(\d+)$", 1).try_cast("int")), F.lit(0)) + 1


def duration_text(seconds: Column) -> Column:
    """1h02m03s, 2m03s or 3s."""
    s = F.floor(seconds).cast("long")
    h, m, r = F.floor(s / 3600), F.floor(F.pmod(s, F.lit(3600)) / 60), F.pmod(s, F.lit(60))
    return F.when(s >= 3600, F.format_string("%dh%02dm%02ds", h, m, r)).when(s >= 60, F.format_string("%dm%02ds", m, r)).otherwise(F.format_string("%ds", r))
