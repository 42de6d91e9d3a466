"""Sources and sinks: whole tables written in a format, and read back from it. Files go to the shared work folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filmstrip.catalog.base import Tables, query
from filmstrip.session import work_folder
from filmstrip.sources import readers, writers

_K = "k AS (SELECT video_id, frame_idx, min(pts_time) AS pts_time, min(fps) AS fps, min(keyframe_path) AS keyframe_path, min(length(shot_id)) AS shot_index FROM kf WHERE video_id IS NOT NULL AND frame_idx IS NOT NULL GROUP BY 1, 2), n AS (SELECT *, row_number() OVER (ORDER BY video_id, frame_idx) - 1 AS id, row_number() OVER (PARTITION BY video_id ORDER BY frame_idx) AS n FROM k)"


def _path(t: Tables, name: str) -> str:
    return f"{work_folder(t.spark)}/files-{name}-{uuid.uuid4().hex}"


def _keyframes(t: Tables) -> DataFrame:
    """One keyframe for each frame of a video."""
    rows = t.kf.where("video_id is not null and frame_idx is not null")
    return rows.groupBy("video_id", "frame_idx").agg(F.min("pts_time").alias("pts_time"), F.min("fps").alias("fps"), F.min("keyframe_path").alias("keyframe_path"), F.min(F.length("shot_id")).alias("shot_index"))


@query("SELECT caption_id, video_id, shot_index, caption FROM ca")
def stored_lines(t: Tables) -> DataFrame:
    """Captions as JSON lines, with their line breaks and nulls, appended in two runs."""
    path, rows = _path(t, "lines"), t.ca.select("caption_id", "video_id", "shot_index", "caption")
    writers.append(rows.where("caption_id % 2 = 0"), path)
    writers.append(rows.where("coalesce(caption_id % 2, 1) <> 0"), path)
    return readers.json_lines(t.spark, path, "caption_id long, video_id string, shot_index int, caption string")


@query(f"WITH {_K} SELECT video_id, n, round(pts_time, 6) AS pts_time, fps, frame_idx FROM n")
def stored_frame_maps(t: Tables) -> DataFrame:
    """Each video's map of frames, as CSV in a folder of its own."""
    path = _path(t, "maps")
    writers.frame_maps(writers.numbered(_keyframes(t)), path)
    return readers.frame_map(t.spark, path).select("video_id", "n", F.round("pts_time", 6).alias("pts_time"), "fps", "frame_idx")


@query(f"WITH {_K} SELECT id, n, video_id, printf('%s_kf%06d', video_id, n - 1) AS keyframe_id, printf('%s_shot%05d', video_id, shot_index) AS shot_id, frame_idx FROM n")
def finalized_keyframes(t: Tables) -> DataFrame:
    """The keyframes of a finished run: numbered, named, and written with shots, events and maps."""
    path = _path(t, "final")
    writers.finalize(_keyframes(t), t.sh.select("id", "video_id", "shot_index"), t.ev.select("id", "video_id"), path)
    return t.spark.read.schema("id long, n int, video_id string, keyframe_id string, shot_id string, frame_idx long").json(f"{path}/keyframes")


@query(f"WITH {_K} SELECT video_id, n, printf('%03d.jpg', n) AS name, frame_idx FROM n WHERE frame_idx % 3 <> 0")
def packaged_pictures(t: Tables) -> DataFrame:
    """Pictures numbered from 1 in each video; one that isn't there leaves a hole."""
    k = writers.numbered(_keyframes(t)).withColumn("keyframe_path", F.concat(F.lit("a/"), F.col("frame_idx").cast("string"), F.lit(".jpg")))
    present = k.where("frame_idx % 3 <> 0").select("video_id", F.concat(F.col("frame_idx").cast("string"), F.lit(".jpg")).alias("name"))
    return writers.packaged(k, present).select("video_id", "n", "name", "frame_idx")


@query("SELECT id, video_id, CASE WHEN video_id IN (SELECT max(video_id) FROM vi) THEN 2 ELSE 1 END AS run FROM sh WHERE video_id IS NOT NULL")
def stored_by_video(t: Tables) -> DataFrame:
    """Shots in a folder a video, of which a second run replaces one."""
    path = _path(t, "videos")
    last = t.vi.agg(F.max("video_id").alias("video_id"))  # one row
    rows = t.sh.where("video_id is not null").select("id", "video_id")
    writers.per_video(rows.withColumn("run", F.lit(1)), path)
    writers.per_video(rows.join(F.broadcast(last), "video_id", "left_semi").withColumn("run", F.lit(2)), path)
    return t.spark.read.schema("id long, run int, video_id string").parquet(path).select("id", "video_id", "run")


@query("SELECT id, upper(video_id) AS video_id FROM sh")
def rewritten_table(t: Tables) -> DataFrame:
    """A table that is put in the place of an older one."""
    path = _path(t, "swap")
    rows = t.sh.select("id", "video_id")
    rows.write.parquet(path)
    writers.rewritten(rows.withColumn("video_id", F.upper("video_id")), path, dry_run=False)
    return t.spark.read.parquet(path)


@query("SELECT caption_id, CASE WHEN caption_id % 4 = 0 THEN 'new ' || model ELSE model END AS model FROM (SELECT DISTINCT caption_id, min(model) OVER (PARTITION BY caption_id) AS model FROM ca)")
def indexed_captions(t: Tables) -> DataFrame:
    """An index into which a part of the documents is put once more."""
    rows = t.ca.groupBy(F.col("caption_id").alias("id")).agg(F.min("model").alias("model"))
    again = rows.where("id % 4 = 0").withColumn("model", F.concat(F.lit("new "), "model"))
    return writers.put(writers.put(None, rows), again).select(F.col("id").alias("caption_id"), "model")


@query("SELECT source, count(*) AS queries FROM kis_queries GROUP BY 1")
def stored_report(t: Tables) -> DataFrame:
    """A report of a few rows as one JSON file."""
    path = _path(t, "report")
    writers.report(t.raw("kis_queries").groupBy("source").agg(F.count(F.lit(1)).alias("queries")).orderBy("source"), path)
    return t.spark.read.schema("source string, queries long").json(path)


@query("SELECT query_id, 'v' || query_id AS gt_video, source, level, first, last FROM (SELECT query_id, source, unnest([{'level': 'tol5', 'first': 5, 'last': 15}, {'level': 'tol30', 'first': 0, 'last': 40}], recursive := true) FROM kis_queries WHERE trim(query) <> '' AND query_id IS NOT NULL AND length(query) % 2 = 0)")
def stored_truth(t: Tables) -> DataFrame:
    """The evaluation queries, which are a fixed set, as one ground truth document with ranges."""
    path = _path(t, "truth")
    ranges = F.create_map(F.lit("tol5"), F.array(F.lit(5), F.lit(15)), F.lit("tol30"), F.array(F.lit(0), F.lit(40)))
    sample = F.struct("query_id", "query", F.concat(F.lit("v"), "query_id").alias("gt_video"), "source", ranges.alias("gt_ranges"), (F.length("query") % 2 != 0).alias("needs_review"))
    doc = t.raw("kis_queries").where("query_id is not null").agg(F.collect_list(sample).alias("samples"))
    doc.select(F.to_json(F.struct("samples")).alias("value")).coalesce(1).write.text(path)
    return readers.truth_ranges(readers.truth(t.spark, path)).select("query_id", "gt_video", "source", "level", F.col("first").cast("int").alias("first"), F.col("last").cast("int").alias("last"))


@query("SELECT query_id, rank, video_id, frame_id FROM (SELECT query_id, unnest([1, 2]) AS rank, unnest(['v' || query_id, 'w']) AS video_id, unnest([length(query_id), NULL]) AS frame_id FROM kis_queries WHERE query_id IS NOT NULL)")
def stored_answers(t: Tables) -> DataFrame:
    """Ranked answers to the evaluation queries, which are a fixed set, as one document; one answer has no number."""
    path = _path(t, "answers")
    answers = F.array(F.array(F.concat(F.lit("v"), "query_id"), F.length("query_id").cast("string")), F.array(F.lit("w"), F.lit("x")))
    doc = t.raw("kis_queries").where("query_id is not null").agg(F.map_from_entries(F.collect_list(F.struct("query_id", answers))).alias("m"))
    doc.select(F.to_json("m").alias("value")).coalesce(1).write.text(path)
    return readers.ranked_answers(t.spark, path)


@query("SELECT query_id, i AS place, 'v' || i AS video_id, i * 10 AS frame_id FROM kis_queries, range(2) r(i) WHERE query_id IS NOT NULL")
def service_hits(t: Tables) -> DataFrame:
    """Hits read from a search service's answers, in each of the forms they have."""
    hits = F.array(*[F.struct(F.lit(f"v{i}").alias("video_id"), F.lit(i * 10).alias("frame_idx")) for i in range(2)])
    other = F.array(*[F.struct(F.lit(f"v{i}").alias("video_id"), F.lit(i * 10).alias("frame")) for i in range(2)])
    form = F.length("query_id") % 3
    response = F.when(form == 0, F.to_json(hits)).when(form == 1, F.to_json(F.struct(hits.alias("results")))).otherwise(F.to_json(F.struct(other.alias("items"))))
    rows = t.raw("kis_queries").where("query_id is not null").select("query_id", response.alias("response"))
    return rows.select("query_id", F.posexplode(readers.search_hits()).alias("place", "h")).select("query_id", F.col("place").cast("long").alias("place"), F.col("h.video_id").alias("video_id"), F.col("h.frame_id").alias("frame_id"))
