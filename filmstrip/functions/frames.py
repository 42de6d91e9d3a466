"""Frames, seconds and ranges around a frame."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What a video without a known rate gets.
DEFAULT_FPS = 25.0
#: Half widths in frames at which an answer is scored.
TOLERANCES = {"tol5": 5, "tol30": 30, "tol90": 90}


def rate(fps: Column) -> Column:
    return F.when(fps > 0, fps).otherwise(F.lit(DEFAULT_FPS))


def frame_count(start: Column, end: Column) -> Column:
    """Both ends are inclusive."""
    return end - start + 1


def start_time(start: Column, fps: Column) -> Column:
    return start / rate(fps)


def end_time(end: Column, fps: Column) -> Column:
    return (end + 1) / rate(fps)


def frames_of(seconds: float, fps: Column) -> Column:
    """Seconds as whole frames, cut off."""
    return (F.lit(seconds) * rate(fps)).cast("long")


def tolerance_ranges(frame: Column, before: Column, after: Column, last: Column) -> Column:
    """Map of range name to [first, last] around a frame, within [0, last]; kf_span reaches half way to the neighbours."""
    names = F.array(*[F.lit(n) for n in [*TOLERANCES, "kf_span"]])
    around = [F.array(F.greatest(frame - w, F.lit(0)), F.least(frame + w, last)) for w in TOLERANCES.values()]
    span = F.array(F.floor((before + frame) / 2), F.floor((frame + after) / 2))
    return F.map_from_arrays(names, F.array(*around, span))


def window_frames(seconds: float, fps: Column, stride: int, samples: Column) -> Column:
    """A window's half width in samples: at least 1, at most a third of the samples."""
    return F.least(F.greatest(F.lit(1), F.bround(F.lit(seconds) * fps / stride, 0)), F.greatest(F.lit(1), F.floor(samples / 3))).cast("int")


def gap_samples(seconds: float, fps: Column, stride: int) -> Column:
    """The least distance in samples that is at least `seconds`; rounded up, so the minimum holds at the ends too."""
    return F.greatest(F.lit(1), F.ceil(F.lit(seconds) * fps / stride)).cast("int")


def keyframe_budget(total: Column, step: float, most: Column) -> Column:
    """How many keyframes a motion path of length total is worth: one a step, two at least."""
    return F.greatest(F.lit(2), F.least(most, F.bround(1 + total / step, 0).cast("int")))


def scaled_side(side: Column, scale: Column) -> Column:
    return F.greatest(F.lit(2), F.bround(side * scale, 0).cast("int"))


def clip_times(start: Column, end: Column, fps: float, most: int) -> Column:
    """Evenly spread times of the frames to take from a clip, `most` at most."""
    n = F.least(F.lit(most), F.greatest(F.lit(1), F.bround(F.lit(fps) * (end - start), 0).cast("int")))
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: start + (end - start) * (i + 0.5) / n)
