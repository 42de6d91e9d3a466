"""The p queries of the problems tagged llm."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filmstrip.llm.leaks import leaks
from filmstrip.llm.levels import levels
from filmstrip.llm.mix import count_tokens, mix, report
from filmstrip.llm.nearest import nearest_pairs
from filmstrip.llm.residue import Linear, residue, train, validate
from filmstrip.llm.runs import collapse_runs, phrases, with_motion_class
from filmstrip.llm.subset import varied_subset
from filmstrip.operators.copies import first_copies
from filmstrip.session import cut, table


def motion_runs(spark: SparkSession, sf: str) -> DataFrame:
    events = first_copies(table(spark, sf, "video_events"), ["id", "video_id", "shot_index", "ord_in_shot", "motion", "start_frame", "end_frame"])
    return collapse_runs(with_motion_class(events, "motion", "means"), ["video_id", "shot_index"], ["ord_in_shot", "id"], "means", "start_frame", "end_frame")


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    runs = motion_runs(spark, sf).where("events >= 2")
    return runs.select("video_id", "shot_index", F.col("first_ord_in_shot").alias("first_ord"), F.col("last_ord_in_shot").alias("last_ord"))


def p1_collapsed(spark: SparkSession, sf: str) -> DataFrame:
    """The whole table with each run as one event."""
    return motion_runs(spark, sf)


def event_keyframes(spark: SparkSession, sf: str) -> DataFrame:
    events = first_copies(table(spark, sf, "video_events"), ["id", "video_id", "anchor_frame"])
    frames = first_copies(table(spark, sf, "keyframe_meta"), ["keyframe_id", "video_id", "frame_idx"])
    return nearest_pairs(events, frames, "video_id", "anchor_frame", "id", "video_id", "frame_idx", "keyframe_id", 40)


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    return event_keyframes(spark, sf).select(F.col("left_id").alias("event_id"), F.col("right_id").alias("keyframe_id"))


def hosted_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Captions and actions together; a text's host is its video."""
    captions = table(spark, sf, "captions").select(F.col("caption").alias("text"), F.col("video_id").alias("host"))
    actions = table(spark, sf, "video_events").select(F.col("action").alias("text"), F.col("video_id").alias("host"))
    return captions.unionByName(actions)


def residue_model(spark: SparkSession, sf: str) -> Linear:
    return train(hosted_texts(spark, sf), "text", "host")


def described(spark: SparkSession, sf: str) -> DataFrame:
    captions = first_copies(table(spark, sf, "captions"), ["caption_id", "caption"])
    actions = first_copies(table(spark, sf, "video_events").where("trim(action) <> ''"), ["id", "action"])
    return captions.select(F.lit("captions").alias("src_table"), F.col("caption_id").alias("row_id"), F.col("caption").alias("text")).unionByName(
        actions.select(F.lit("video_events").alias("src_table"), F.col("id").alias("row_id"), F.col("action").alias("text"))
    )


def p3_scored(spark: SparkSession, sf: str) -> DataFrame:
    """Every caption and action with its score; the tables without residue are the rows with is_residue false."""
    return residue(described(spark, sf), "row_id", "text", residue_model(spark, sf), keep=["src_table"])


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return p3_scored(spark, sf).where("is_residue").select("src_table", "row_id")


def p3_validation(spark: SparkSession, sf: str) -> DataFrame:
    """How the model does on parts of videos it has not seen, and on kinds of residue whose phrases it wasn't shown."""
    return validate(hosted_texts(spark, sf), "text", "host")


def p6_subset(spark: SparkSession, sf: str) -> DataFrame:
    frames = first_copies(table(spark, sf, "keyframes"), ["id", "keyframe_id", "video_id", "frame_index", "image"])
    videos = first_copies(table(spark, sf, "videos"), ["video_id", "pick_size"])
    return varied_subset(frames, videos, "video_id", "keyframe_id", "image", "frame_index", "pick_size")


def p7_leaks(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with passages of a query, in its own words or with other fillings of its numbers, units and names."""
    return leaks(table(spark, sf, "documents"), table(spark, sf, "kis_queries"), "doc_id", "text", "query_id", "query")


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    return p7_leaks(spark, sf).where("kind = 'words'").select("doc_id", "query_id")


def sized_documents(spark: SparkSession, sf: str) -> DataFrame:
    return cut(count_tokens(table(spark, sf, "documents"), "text", keep=["doc_id", "source"]))


def p8_mixture(spark: SparkSession, sf: str) -> DataFrame:
    return mix(sized_documents(spark, sf), table(spark, sf, "mix_targets"), "doc_id")


def p8_report(spark: SparkSession, sf: str) -> DataFrame:
    sized, targets = sized_documents(spark, sf), table(spark, sf, "mix_targets")
    return report(sized, targets, mix(sized, targets, "doc_id"))


def p9_levels(spark: SparkSession, sf: str) -> DataFrame:
    return levels(table(spark, sf, "documents"), table(spark, sf, "level_samples"), "doc_id", "text")


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    return p9_levels(spark, sf).where("words >= 40 and 2 * hard_words > words").select("doc_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"p1_found": p1_found, "p1_collapsed": p1_collapsed, "p2_found": p2_found, "p3_found": p3_found, "p3_scored": p3_scored, "p3_validation": p3_validation, "p6_subset": p6_subset, "p7_found": p7_found, "p7_leaks": p7_leaks, "p8_mixture": p8_mixture, "p8_report": p8_report, "p9_levels": p9_levels, "p9_found": p9_found}

_PHRASES = " UNION ALL ".join(f"SELECT regexp_replace(replace(strip_accents('{p}'), 'đ', 'd'), '[^a-z0-9]+', '', 'g') AS k" for p in phrases())
_MOTION = f"""m AS (SELECT motion, regexp_replace(replace(strip_accents(lower(motion)), 'đ', 'd'), '[^a-z0-9]+', '', 'g') AS bare FROM video_events WHERE motion IS NOT NULL GROUP BY ALL), p AS ({_PHRASES}),
    b AS (SELECT motion, bare, min(levenshtein(bare, k)) AS d, arg_min(k, printf('%04d', levenshtein(bare, k)) || k) AS k FROM m CROSS JOIN p GROUP BY 1, 2), c AS (SELECT motion, CASE WHEN bare = '' THEN NULL WHEN d <= greatest(2, floor(length(bare) / 6)) AND length(bare) >= 6 THEN k ELSE bare END AS means FROM b),
    e AS (SELECT v.*, means FROM (SELECT id, video_id, shot_index, ord_in_shot, motion, start_frame, end_frame FROM video_events WHERE video_id IS NOT NULL AND shot_index IS NOT NULL AND ord_in_shot IS NOT NULL GROUP BY ALL) v LEFT JOIN c USING (motion)),
    s AS (SELECT *, sum(coalesce((means <> prev)::INT, 1)) OVER w AS run FROM (SELECT *, lag(means) OVER (PARTITION BY video_id, shot_index ORDER BY ord_in_shot, id) AS prev FROM e) WINDOW w AS (PARTITION BY video_id, shot_index ORDER BY ord_in_shot, id ROWS UNBOUNDED PRECEDING)),
    r AS (SELECT video_id, shot_index, any_value(means) AS run_value, min(ord_in_shot) AS first_ord_in_shot, max(ord_in_shot) AS last_ord_in_shot, count(*) AS events, min(least(start_frame, end_frame)) AS first_frame, max(greatest(start_frame, end_frame)) AS last_frame FROM s GROUP BY video_id, shot_index, run)"""
SQL: dict[str, str] = {
    "p1_found": f"WITH {_MOTION} SELECT video_id, shot_index, first_ord_in_shot AS first_ord, last_ord_in_shot AS last_ord FROM r WHERE events >= 2",
    "p1_collapsed": f"WITH {_MOTION} SELECT *, last_frame - first_frame + 1 AS frames FROM r",
    "p2_found": """WITH e AS (SELECT id, video_id, anchor_frame FROM video_events WHERE video_id IS NOT NULL AND anchor_frame IS NOT NULL GROUP BY ALL), k AS (SELECT keyframe_id, video_id, frame_idx FROM keyframe_meta WHERE video_id IS NOT NULL AND frame_idx IS NOT NULL GROUP BY ALL)
    SELECT id AS event_id, arg_min(keyframe_id, abs(frame_idx - anchor_frame) * 100000000 + frame_idx) AS keyframe_id FROM e JOIN k USING (video_id) WHERE abs(frame_idx - anchor_frame) <= 40 GROUP BY 1""",
}
