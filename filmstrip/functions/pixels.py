"""Small pictures as raw bytes: brightness, histograms, and greedy de-duplication of a shot's pictures by them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Bins of hue (0..180) and saturation (0..256), and bits a channel of the colour histogram.
HUE, SATURATION, BITS = 50, 60, 3


def bgr(image: bytes, height: int, width: int) -> np.ndarray | None:
    """Pixels as height x width x 3; None for an image that is missing or cut off."""
    if image is None or len(image) != height * width * 3:
        return None
    return np.frombuffer(image, np.uint8).reshape(height, width, 3)


def hue_saturation(pixels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hue in half degrees (0..180) and saturation (0..255) of each pixel."""
    b, g, r = (pixels[..., k].astype(float).ravel() for k in range(3))
    top, low = np.maximum(np.maximum(r, g), b), np.minimum(np.minimum(r, g), b)
    span = np.where(top > low, top - low, 1)
    hue = np.where(top == r, (g - b) / span, np.where(top == g, 2 + (b - r) / span, 4 + (r - g) / span))
    hue = np.where(top > low, (hue * 30) % 180, 0)
    return hue, np.where(top > 0, (top - low) / np.maximum(top, 1) * 255, 0)


def hsv_histogram(pixels: np.ndarray) -> np.ndarray:
    """Counts of hue and saturation, scaled from 0 to 1."""
    h, s = hue_saturation(pixels)
    counts = np.histogram2d(h, s, bins=(HUE, SATURATION), range=((0, 180), (0, 256)))[0].ravel()
    span = counts.max() - counts.min()
    return (counts - counts.min()) / span if span else np.zeros_like(counts)


def colour_histogram(pixels: np.ndarray) -> np.ndarray:
    """Shares of pixels by the upper three bits of each channel (512 bins), of unit length."""
    p = pixels.reshape(-1, 3).astype(np.int64) >> (8 - BITS)
    counts = np.bincount((p[:, 2] << (2 * BITS)) | (p[:, 1] << BITS) | p[:, 0], minlength=1 << (3 * BITS)).astype(float)
    return counts / max(np.linalg.norm(counts), 1e-8)


def differs(a: np.ndarray, b: np.ndarray) -> float:
    """One minus the correlation of two histograms; a flat one correlates with nothing."""
    x, y = a - a.mean(), b - b.mean()
    n = np.sqrt((x @ x) * (y @ y))
    return 1 - (x @ y) / n if n > 1e-12 else 1.0


def looks(df: DataFrame, row_id: str, image: str, height: int = 6, width: int = 8) -> DataFrame:
    """row_id, brightness, deviation, colours (distinct bins) of each picture; nulls where the picture is unusable."""
    kind = df.schema[row_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for raw in b.column(1).to_pylist():
                p = bgr(raw, height, width)
                out.append((None, None, None) if p is None else (float(p.mean()), float(p.std()), int((colour_histogram(p) > 0).sum())))
            cols = list(zip(*out)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(cols[0], pa.float64()), pa.array(cols[1], pa.float64()), pa.array(cols[2], pa.int32())], [row_id, "brightness", "deviation", "colours"])

    return df.select(row_id, image).mapInArrow(run, f"`{row_id}` {kind}, brightness double, deviation double, colours int")


def distinct_pictures(df: DataFrame, key: list[str], at: str, row_id: str, image: str, threshold: float, height: int = 6, width: int = 8) -> DataFrame:
    """key, row_id of the pictures whose histogram differs from that of every one kept before by more than threshold, in
    the order of at. A key is one shot, whose few pictures are worked off together; unusable pictures are left out."""
    rows = df.select(*key, at, row_id, image).dropna()
    kinds = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in [*key, row_id])

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([(at, "ascending"), (row_id, "ascending")])
        kept, seats = [], []
        for i, raw in enumerate(group.column(image).to_pylist()):
            p = bgr(raw, height, width)
            if p is not None:
                h = hsv_histogram(p)
                if all(differs(h, k) > threshold for k in kept):
                    kept.append(h)
                    seats.append(i)
        return group.take(pa.array(seats, pa.int64())).select([*key, row_id])

    return rows.groupBy(*key).applyInArrow(run, kinds)
