"""Where models and decoders plug in, with stand-ins that give the same result everywhere."""

from __future__ import annotations

import re
import time
import zlib
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Protocol

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType


class Captioner(Protocol):
    """What a captioning backend offers; a batch is a list of encoded pictures."""

    def caption(self, pictures: list[bytes], hint: str = "") -> str: ...

    def caption_batch(self, pictures: list[bytes]) -> list[str]: ...


class MockCaptioner:
    """Says how many pictures it got, and of what brightness."""

    def caption(self, pictures: list[bytes], hint: str = "") -> str:
        light = [float(np.frombuffer(p, np.uint8).mean()) if p else 0.0 for p in pictures]
        return f"{len(pictures)} pictures, brightness {round(sum(light) / max(len(light), 1))}" + (f"; {hint}" if hint else "")

    def caption_batch(self, pictures: list[bytes]) -> list[str]:
        return [self.caption([p]) for p in pictures]


BACKENDS: dict[str, Callable[[], Captioner]] = {"mock": MockCaptioner}


def captioner(name: str) -> Captioner:
    """The backend of a name; more are added to BACKENDS. It is made once in each task that uses it."""
    if name not in BACKENDS:
        raise ValueError(f"no captioner {name!r}; there are {sorted(BACKENDS)}")
    return BACKENDS[name]()


def captions(df: DataFrame, row_id: str, image: str, backend: str = "mock", batch: int = 8) -> DataFrame:
    """row_id and caption of each image, `batch` images a call; null images get null."""
    make = BACKENDS[backend]
    kind = df.schema[row_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = make()
        for b in batches:
            images = b.column(1).to_pylist()
            there = [i for i, x in enumerate(images) if x is not None]
            said: list[str | None] = [None] * len(images)
            for k in range(0, len(there), batch):
                part = there[k : k + batch]
                for i, text in zip(part, model.caption_batch([images[i] for i in part])):
                    said[i] = text
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(said, pa.string())], [row_id, "caption"])

    return df.select(row_id, image).mapInArrow(run, f"`{row_id}` {kind}, caption string")


# What a call that failed gives in place of a caption, and what tells errors apart.
EMPTY_ANSWER, FAILED_ANSWER, NO_QUOTA = "[rỗng]", "[lỗi API: {}]", "[hết quota]"
QUOTA_WORDS, REFUSED_CODES, REFUSED_WORDS = ("429", "resource_exhausted", "quota"), ("400", "401", "403"), ("api_key", "api key", "permission", "invalid", "denied")


def error_class(message: str) -> str:
    """'quota', 'refused' (the access itself is bad, so trying again is of no use) or 'passing'."""
    low = message.lower()
    if any(w in low for w in QUOTA_WORDS):
        return "quota"
    if any(c in message for c in REFUSED_CODES) and any(w in low for w in REFUSED_WORDS):
        return "refused"
    return "passing"


@dataclass(frozen=True)
class Retries:
    """How often a request is tried and how long is waited: `tries` calls at most; after a quota error as long as the
    service says, else growing from a second by 1.7 to `most` seconds; after a passing one `pause` seconds."""

    tries: int = 3
    pause: float = 1.5
    most: float = 20.0
    sleep: Callable[[float], None] = time.sleep

    def wait(self, message: str, failures: int) -> float:
        said = re.search(r"retry in ([0-9.]+)s", message)
        return min(self.most, float(said[1]) + 1.0 if said else 1.7 ** min(failures, 6))

    def call(self, ask: Callable[[], str | None]) -> str:
        """ask()'s answer, or a text in brackets that says what went wrong: an empty answer, an error, or no quota."""
        for n in range(1, self.tries + 1):
            try:
                if text := (ask() or "").strip():
                    return text
                wrong = EMPTY_ANSWER
            except Exception as e:  # noqa: BLE001 - any error of a service is this request's alone
                kind = error_class(str(e))
                wrong = NO_QUOTA if kind == "quota" else FAILED_ANSWER.format(str(e)[:60])
                if kind == "refused":
                    return wrong
                if n < self.tries:
                    self.sleep(self.wait(str(e), n) if kind == "quota" else self.pause)
        return wrong


def in_parallel(requests: list, ask: Callable[[object], str | None], fallback: Callable[[object], str | None] | None = None, workers: int = 8, retries: Retries = Retries()) -> tuple[list[str], dict[str, int]]:
    """The answers to requests, in order, and how many came from the first way, from the fallback and from neither. The
    fallback (such as single frames in place of a clip) is tried for an answer that is an error; workers share a task."""

    def one(request: object) -> tuple[str, str]:
        said = retries.call(lambda: ask(request))
        if not said.startswith("[") or fallback is None:
            return said, "failed" if said.startswith("[") else "first"
        other = retries.call(lambda: fallback(request))
        return (said, "failed") if other.startswith("[") else (other, "fallback")

    with ThreadPoolExecutor(max(1, workers)) as pool:
        rows = list(pool.map(one, requests))
    counts = {k: sum(how == k for _, how in rows) for k in ("first", "fallback", "failed")}
    return [said for said, _ in rows], counts


class ImageEmbedder(Protocol):
    """What an image model offers: a unit vector for each encoded picture."""

    def embed(self, pictures: list[bytes]) -> np.ndarray: ...


class MeanEmbedder:
    """The means of `size` equal runs of a picture's bytes, centred, as a unit vector; a stand-in for an image model."""

    def __init__(self, size: int = 16) -> None:
        self.size = size

    def embed(self, pictures: list[bytes]) -> np.ndarray:
        rows = np.array([[part.mean() if len(part) else 0.0 for part in np.array_split(np.frombuffer(p, np.uint8).astype(float), self.size)] for p in pictures]).reshape(len(pictures), self.size)
        rows -= rows.mean(1, keepdims=True)
        return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-8)


EMBEDDERS: dict[str, Callable[[], ImageEmbedder]] = {"mean": MeanEmbedder}


def embed_images(df: DataFrame, row_id: str, image: str, backend: str = "mean", batch: int = 64) -> DataFrame:
    """row_id and vector of each image, `batch` images a call; null and empty images get null."""
    make = EMBEDDERS[backend]
    kind = df.schema[row_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = make()
        for b in batches:
            images = b.column(1).to_pylist()
            there = [i for i, x in enumerate(images) if x]
            out: list[list[float] | None] = [None] * len(images)
            for k in range(0, len(there), batch):
                part = there[k : k + batch]
                for i, v in zip(part, model.embed([images[i] for i in part]).tolist()):
                    out[i] = v
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.list_(pa.float64()))], [row_id, "vector"])

    return df.select(row_id, image).mapInArrow(run, f"`{row_id}` {kind}, vector array<double>")


class FlowModel(Protocol):
    """What an optical flow offers between two grey pictures: mean dx, dy and magnitude, and coherence from 0 to 1."""

    def flow(self, before: np.ndarray, after: np.ndarray) -> tuple[float, float, float, float]: ...


class ShiftFlow:
    """The whole shift of at most `reach` pixels that makes two pictures most alike, a stand-in for a dense flow; the
    coherence is how much of the difference it explains."""

    def __init__(self, reach: int = 2) -> None:
        self.reach = reach

    def flow(self, before: np.ndarray, after: np.ndarray) -> tuple[float, float, float, float]:
        a, b, r = before.astype(float), after.astype(float), self.reach
        h, w = a.shape

        def apart(dx: int, dy: int) -> float:
            mine = b[max(dy, 0) : h + min(dy, 0), max(dx, 0) : w + min(dx, 0)]
            return float(np.abs(mine - a[max(-dy, 0) : h + min(-dy, 0), max(-dx, 0) : w + min(-dx, 0)]).mean())

        shifts = [(apart(dx, dy), abs(dx) + abs(dy), dx, dy) for dx in range(-min(r, w - 1), min(r, w - 1) + 1) for dy in range(-min(r, h - 1), min(r, h - 1) + 1)]
        best, _, dx, dy = min(shifts)
        still = apart(0, 0)
        return float(dx), float(dy), float(np.hypot(dx, dy)), 1 - best / still if still else 0.0


def picture_size(image: bytes, level: int = 6) -> int:
    """How many bytes a picture takes when it is packed: a stand-in for the size of an encoded picture, which grows with
    its detail in the same way."""
    return len(zlib.compress(image, level))


TextModel = Callable[[list[str | None]], np.ndarray]


def hashed_words(size: int = 64, prefix: str = "") -> TextModel:
    """Gives texts' unit vectors of hashed words, in rows: a stand-in for a text model, in whose place it can be put.
    Blank texts get zeros."""
    import xxhash

    class Places(dict):
        """A word's place, beyond `size` if it counts down; each word is hashed once."""

        def __missing__(self, w: str) -> int:
            h = xxhash.xxh3_64_intdigest(w)
            self[w] = place = h % size + (0 if h >> 63 else size)
            return place

    places = Places()

    def run(texts: list[str | None]) -> np.ndarray:
        found, lengths = [], []
        for t in texts:
            words = (prefix + (t or "")).lower().split()
            found.extend(map(places.__getitem__, words))
            lengths.append(len(words))
        if len(places) > 200_000:
            places.clear()
        cells = np.repeat(np.arange(len(lengths)) * 2 * size, lengths) + np.array(found, np.int64)
        v = np.bincount(cells, minlength=len(lengths) * 2 * size).reshape(len(lengths), 2, size)
        v = (v[:, 0] - v[:, 1]).astype(float)
        n = np.linalg.norm(v, axis=1, keepdims=True)
        return v / np.where(n, n, 1)

    return run


def embed_text(text: str | Column, size: int = 64, prefix: str = "") -> Column:
    """The vectors of hashed_words."""

    @F.pandas_udf(ArrayType(DoubleType()))
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = hashed_words(size, prefix)
        for part in parts:
            yield pd.Series(list(model(part.tolist())))

    return run(F.col(text) if isinstance(text, str) else text)


class FrameDecoder(Protocol):
    """What a video decoder offers: frames of a file, in order, `step` apart, scaled to a long side."""

    def frames(self, path: str, step: int, long_side: int) -> Iterator[tuple[int, bytes]]: ...


def decode(files: DataFrame, path: str, decoder: Callable[[], FrameDecoder], step: int = 5, long_side: int = 192) -> DataFrame:
    """path, frame_idx, image of each file's frames; one file's failure leaves a row with frame_idx null and the error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["path", "frame_idx", "image", "error"]
        types = [pa.string(), pa.int64(), pa.binary(), pa.string()]
        made = decoder()
        for b in batches:
            for p in b.column(0).to_pylist():
                try:
                    for i, image in made.frames(p, step, long_side):
                        yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((p, i, image, None), types)], names)
                except Exception as e:  # noqa: BLE001 - any failure of a decoder is this file's alone
                    yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((p, None, None, f"{type(e).__name__}: {e}"), types)], names)

    return files.select(path).mapInArrow(run, "path string, frame_idx long, image binary, error string")
