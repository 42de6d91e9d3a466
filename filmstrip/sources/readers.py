"""Readers of the file formats the tables come in."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filmstrip.functions.ids import basename, collection, stem
from filmstrip.operators.joins import latest
from filmstrip.sources import schemas


def list_files(spark: SparkSession, root: str, extensions: tuple[str, ...] = schemas.VIDEOS) -> DataFrame:
    """path, name, stem, bytes, modified of all files with an extension below a folder; their content isn't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.{" + ",".join(extensions) + "}").load(root)
    return files.select("path", basename(F.col("path")).alias("name"), stem(F.col("path")).alias("stem"), F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


def inventory(spark: SparkSession, root: str) -> DataFrame:
    """collection, video_id, names (sorted) of the pictures in root/collection/video/."""
    files = list_files(spark, root, ("jpg", "png"))
    parts = F.split(F.col("path"), "/")
    return files.select(F.element_at(parts, -3).alias("collection"), F.element_at(parts, -2).alias("video_id"), "name").groupBy("collection", "video_id").agg(F.array_sort(F.collect_set("name")).alias("names"))


def json_lines(spark: SparkSession, path: str, schema: str, tolerant: bool = False) -> DataFrame:
    """One row a line, blank lines skipped. Malformed lines fail the read or, if tolerant, are left out."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED" if tolerant else "FAILFAST").json(path)


def last_lines(spark: SparkSession, path: str, schema: str, key: str) -> DataFrame:
    """The last good line of each key of an appended file or folder, by file and place in it."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block"), F.monotonically_increasing_id().alias("__line"))
    rows = lines.where(F.trim("value") != "").select("__file", "__block", "__line", F.from_json("value", schema, {"mode": "PERMISSIVE"}).alias("r")).where(F.col(f"r.{key}").isNotNull())
    return latest(rows.select("__file", "__block", "__line", "r.*"), [key], [F.col("__file"), F.col("__block"), F.col("__line")]).drop("__file", "__block", "__line")


def truth(spark: SparkSession, path: str) -> DataFrame:
    """The samples of a ground truth document, one row each."""
    doc = spark.read.schema(schemas.TRUTH).option("multiLine", True).json(path)
    return doc.select(F.explode("samples").alias("s")).select("s.*")


def truth_ranges(samples: DataFrame, with_unreviewed: bool = False) -> DataFrame:
    """query_id, gt_video, source, level, first, last of the samples that have a query and are reviewed."""
    kept = samples.where(F.trim("query") != "")
    if not with_unreviewed:
        kept = kept.where(~F.coalesce("needs_review", F.lit(False)))
    return kept.select("query_id", "gt_video", "source", F.explode("gt_ranges").alias("level", "r")).select("query_id", "gt_video", "source", "level", F.get("r", F.lit(0)).alias("first"), F.get("r", F.lit(1)).alias("last"))


def ranked_answers(spark: SparkSession, path: str) -> DataFrame:
    """query_id, rank, video_id, frame_id of a document {query: [[video, frame], ...]}, best first; answers that can't be
    read keep their rank with nulls."""
    doc = spark.read.text(path, wholetext=True).select(F.from_json("value", "map<string, array<array<string>>>").alias("m"))
    flat = doc.select(F.explode("m").alias("query_id", "list")).select("query_id", F.posexplode("list").alias("i", "a"))
    return flat.select("query_id", (F.col("i") + 1).alias("rank"), F.get("a", F.lit(0)).alias("video_id"), F.get("a", F.lit(1)).try_cast("long").alias("frame_id"))


def frame_map(spark: SparkSession, path: str) -> DataFrame:
    """A video's map of frames; rows with bad values are left out, empty cells are null."""
    return spark.read.schema(schemas.FRAME_MAP).option("header", True).option("mode", "DROPMALFORMED").csv(path)


def keyframe_records(df: DataFrame, style: str = "global") -> DataFrame:
    """Exported columns from records of any of the names in use: frame_idx, frame_index, frame; n or id + 1. style is
    'global' (ids as text) or 'numeric' (numbers in the video)."""

    def any_of(*names: str):  # noqa: ANN202
        there = [F.col(c) for c in names if c in df.columns]
        return F.coalesce(*there) if there else F.lit(None)

    n = any_of("n") if "n" in df.columns and "id" not in df.columns else F.coalesce(any_of("n"), any_of("id") + 1)
    keyframe = F.format_string("%s_kf%06d", "video_id", n - 1) if style == "global" else n.cast("int")
    shot = F.format_string("%s_shot%05d", "video_id", "shot_index") if style == "global" else F.col("shot_index").cast("int")
    return df.select("video_id", keyframe.alias("keyframe_id"), shot.alias("shot_id"), any_of("frame_idx", "frame_index", "frame").cast("long").alias("frame_idx"), any_of("fps").cast("double").alias("fps"), any_of("pts_time", "time_sec").cast("double").alias("pts_time"), F.regexp_replace(any_of("keyframe_path", "path").cast("string"), r"\\", "/").alias("keyframe_path"))


def matrices(spark: SparkSession, path: str) -> DataFrame:
    """file, row, vector of .npy matrices. A matrix is read whole by one task; large sets of vectors belong in Parquet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import io

        import numpy as np

        for b in batches:
            for name, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                m = np.atleast_2d(np.load(io.BytesIO(content), allow_pickle=False)).astype(np.float32)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(m)), pa.array(np.arange(len(m))), pa.array(m.tolist(), pa.list_(pa.float32()))], ["file", "row", "vector"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.npy").load(path)
    return files.select("path", "content").mapInArrow(run, "file string, row long, vector array<float>")


def search_hits(response: str = "response"):  # noqa: ANN201
    """Hits of a search service's answer: the list itself, or what is under results, hits, data or items."""
    lists = [F.get_json_object(response, f"$.{k}") for k in ("results", "hits", "data", "items")]
    body = F.when(F.trim(response).startswith("["), F.col(response)).otherwise(F.coalesce(*lists))
    hits = F.from_json(body, "array<struct<video_id: string, frame_idx: bigint, frame_id: bigint, frame: bigint, score: double>>")
    return F.transform(hits, lambda h: F.struct(h["video_id"].alias("video_id"), F.coalesce(h["frame_idx"], h["frame_id"], h["frame"]).alias("frame_id"), h["score"].alias("score")))


def overridden(config: dict, pairs: list[str]) -> dict:
    """A copy of a nested configuration with "a.b=value" set, the value in the old one's type."""
    import copy

    out = copy.deepcopy(config)
    for pair in pairs:
        path, _, text = pair.partition("=")
        *way, name = path.split(".")
        at = out
        for part in way:
            at = at.setdefault(part, {})
        old = at.get(name)
        at[name] = text.lower() in ("1", "true", "yes", "on") if isinstance(old, bool) else type(old)(text) if isinstance(old, (int, float)) else text
    return out


def with_collection(df: DataFrame) -> DataFrame:
    return df.withColumn("collection", collection(F.col("video_id")))
