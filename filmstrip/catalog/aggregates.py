"""Aggregates and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from filmstrip.catalog.base import Tables, query
from filmstrip.functions import labels
from filmstrip.operators import score
from filmstrip.operators.validate import check_events


@query("""SELECT video_id, shot_index, arg_min(keyframe_id, frame_index * 1000000 + n) AS first_id, count(*) AS n_keyframes, array_to_string(list(frame_index ORDER BY frame_index, n), ',') AS frames, round(min(time_sec), 6) AS start_time
    FROM ky WHERE frame_index IS NOT NULL GROUP BY 1, 2""")
def shots_from_keyframes(t: Tables) -> DataFrame:
    """Shots rebuilt from their keyframes, with an array of them."""
    k = t.ky.where("frame_index is not null")
    item = F.struct("frame_index", "n", "keyframe_id", "time_sec")
    shots = k.groupBy("video_id", "shot_index").agg(F.min_by("keyframe_id", F.struct("frame_index", "n")).alias("first_id"), F.count(F.lit(1)).alias("n_keyframes"), F.array_sort(F.collect_list(item)).alias("items"), F.min("time_sec").alias("t0"))
    return shots.select("video_id", "shot_index", "first_id", "n_keyframes", F.array_join(F.transform("items", lambda x: x["frame_index"].cast("string")), ",").alias("frames"), F.round("t0", 6).alias("start_time"))


@query("SELECT per_shot, count(*) AS shots FROM (SELECT count(*) AS per_shot FROM ev WHERE shot_index IS NOT NULL GROUP BY video_id, shot_index) GROUP BY 1")
def events_per_shot(t: Tables) -> DataFrame:
    """How many shots have how many events."""
    each = t.ev.where("shot_index is not null").groupBy("video_id", "shot_index").agg(F.count(F.lit(1)).alias("per_shot"))
    return each.groupBy("per_shot").agg(F.count(F.lit(1)).alias("shots"))


@query("""SELECT split_part(video_id, '_', 1) AS collection, count(DISTINCT video_id) AS videos, count(DISTINCT (video_id, shot_index)) AS shots, count(DISTINCT (video_id, scene_id)) AS scenes, count(*) FILTER (trim(action) <> '') AS labelled
    FROM ev WHERE video_id IS NOT NULL AND shot_index IS NOT NULL AND scene_id IS NOT NULL GROUP BY 1""")
def distinct_counts(t: Tables) -> DataFrame:
    """Distinct videos, shots and scenes, and labelled events, per collection."""
    e = t.ev.dropna(subset=["video_id", "shot_index", "scene_id"])
    return e.groupBy(F.split_part("video_id", F.lit("_"), F.lit(1)).alias("collection")).agg(F.countDistinct("video_id").alias("videos"), F.countDistinct("video_id", "shot_index").alias("shots"), F.countDistinct("video_id", "scene_id").alias("scenes"), F.count_if(F.trim("action") != "").alias("labelled"))


@query("""SELECT video_id, l[len(l) // 2 + 1] AS upper_median, l[1] AS least, l[-1] AS most FROM (SELECT video_id, list(end_frame - start_frame + 1 ORDER BY end_frame - start_frame + 1) AS l FROM ev WHERE start_frame IS NOT NULL AND end_frame >= start_frame GROUP BY 1)""")
def upper_medians(t: Tables) -> DataFrame:
    """The upper median length of each video's events."""
    n = F.col("end_frame") - F.col("start_frame") + 1
    return t.ev.where("start_frame is not null and end_frame >= start_frame").groupBy("video_id").agg(score.upper_median(n).alias("upper_median"), F.min(n).alias("least"), F.max(n).alias("most"))


@query("""SELECT fps, round(quantile_cont(boundary_score, 0.5), 6) AS median, round(quantile_cont(boundary_score, 0.9), 6) AS p90, max(boundary_score) AS top, count(*) FILTER (boundary_score >= 0.5) AS over50, count(*) FILTER (boundary_score >= 0.75) AS over75 FROM ev GROUP BY 1""")
def score_percentiles(t: Tables) -> DataFrame:
    """Exact percentiles and threshold counts of boundary scores by rate."""
    b = F.col("boundary_score")
    return t.ev.groupBy("fps").agg(F.round(F.percentile(b, 0.5), 6).alias("median"), F.round(F.percentile(b, 0.9), 6).alias("p90"), F.max(b).alias("top"), F.count_if(b >= 0.5).alias("over50"), F.count_if(b >= 0.75).alias("over75"))


@query("""SELECT CASE WHEN mag_mean < 0.2 THEN '<0.2' WHEN mag_mean < 0.5 THEN '<0.5' WHEN mag_mean < 1 THEN '<1' WHEN mag_mean < 2 THEN '<2' ELSE '>=2' END AS band, count(*) AS events, round(quantile_cont(boundary_score, 0.5), 6) AS p50, round(quantile_cont(boundary_score, 0.9), 6) AS p90 FROM ev WHERE mag_mean IS NOT NULL GROUP BY 1""")
def band_report(t: Tables) -> DataFrame:
    """Boundary scores by bands of motion."""
    m = F.col("mag_mean")
    band = F.when(m < 0.2, "<0.2").when(m < 0.5, "<0.5").when(m < 1, "<1").when(m < 2, "<2").otherwise(">=2").alias("band")
    return t.ev.where("mag_mean is not null").groupBy(band).agg(F.count(F.lit(1)).alias("events"), F.round(F.percentile("boundary_score", 0.5), 6).alias("p50"), F.round(F.percentile("boundary_score", 0.9), 6).alias("p90"))


def _answers(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Truth: the middle keyframe of each video at three widths; answers: its keyframes in an order drawn from their ids."""
    k = t.kf.dropna(subset=["video_id", "frame_idx"])
    w = Window.partitionBy("video_id")
    mid = k.withColumn("r", F.row_number().over(w.orderBy("frame_idx", "keyframe_id"))).withColumn("c", F.count(F.lit(1)).over(w)).where("r = floor(c / 2) + 1")
    levels = F.explode(F.create_map(*[F.lit(x) for kv in (("tol5", 5), ("tol30", 30), ("tol90", 90)) for x in kv])).alias("level", "tol")
    truth = mid.select(F.col("video_id").alias("query_id"), F.col("video_id").alias("gt_video"), "frame_idx", levels).select("query_id", "gt_video", "level", F.greatest(F.col("frame_idx") - F.col("tol"), F.lit(0)).alias("first"), (F.col("frame_idx") + F.col("tol")).alias("last"))
    rank = F.row_number().over(w.orderBy(F.md5("keyframe_id"), "keyframe_id"))
    answers = k.select(F.col("video_id").alias("query_id"), rank.alias("rank"), "video_id", F.col("frame_idx").alias("frame_id"))
    return answers, truth


_TRUTH = """k0 AS (SELECT * FROM kf WHERE video_id IS NOT NULL AND frame_idx IS NOT NULL), tr AS (SELECT video_id AS query_id, level, greatest(frame_idx - tol, 0) AS first, frame_idx + tol AS last FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY frame_idx, keyframe_id) AS r, count(*) OVER (PARTITION BY video_id) AS c FROM k0)
    CROSS JOIN (VALUES ('tol5', 5), ('tol30', 30), ('tol90', 90)) x(level, tol) WHERE r = c // 2 + 1), an AS (SELECT video_id AS query_id, frame_idx AS frame_id, row_number() OVER (PARTITION BY video_id ORDER BY md5(keyframe_id), keyframe_id) AS rank FROM k0 WHERE video_id LIKE 'N%'),
    ju AS (SELECT tr.query_id, level, rank, CASE WHEN frame_id BETWEEN first AND last THEN 1.0::DOUBLE ELSE 0 END AS hit FROM tr LEFT JOIN an ON tr.query_id = an.query_id AND rank <= 100),
    fs AS (SELECT query_id, level, coalesce(max(hit) FILTER (rank <= 1), 0) AS r1, coalesce(max(hit) FILTER (rank <= 5), 0) AS r5, coalesce(max(hit) FILTER (rank <= 20), 0) AS r20, coalesce(max(hit) FILTER (rank <= 50), 0) AS r50, coalesce(max(hit) FILTER (rank <= 100), 0) AS r100, min(rank) FILTER (hit > 0) AS fh FROM ju GROUP BY 1, 2)"""
_BUCKET = "CASE WHEN fh IS NULL THEN 'miss' WHEN fh = 1 THEN '1' WHEN fh <= 5 THEN '2-5' WHEN fh <= 20 THEN '6-20' WHEN fh <= 50 THEN '21-50' WHEN fh <= 100 THEN '51-100' ELSE 'beyond' END"


@query(f"WITH {_TRUTH} SELECT query_id, level, fh AS first_hit, {_BUCKET} AS bucket, round((r1 + r5 + r20 + r50 + r100) / 5, 6) AS final FROM fs")
def rank_scores(t: Tables) -> DataFrame:
    """Final score, first hit and its bucket per query and width; queries without answers score 0."""
    answers, truth = _answers(t)
    return score.final_scores(score.judged(answers, truth), ["query_id", "level"]).select("query_id", "level", "first_hit", "bucket", F.round("final", 6).alias("final"))


@query(f"""WITH {_TRUTH} SELECT level, round(avg((r1 + r5 + r20 + r50 + r100) / 5), 6) AS mean_final, count(*) FILTER ({_BUCKET} = '1') AS first, count(*) FILTER ({_BUCKET} = '2-5') AS to5, count(*) FILTER ({_BUCKET} = '6-20') AS to20, count(*) FILTER ({_BUCKET} = 'miss') AS miss FROM fs GROUP BY 1""")
def rank_report(t: Tables) -> DataFrame:
    """Mean score and buckets per width."""
    answers, truth = _answers(t)
    rows = score.final_scores(score.judged(answers, truth), ["query_id", "level"])
    return rows.groupBy("level").agg(F.round(F.avg("final"), 6).alias("mean_final"), *[F.count_if(F.col("bucket") == b).alias(n) for b, n in (("1", "first"), ("2-5", "to5"), ("6-20", "to20"), ("miss", "miss"))])


@query(f"WITH {_TRUTH} SELECT split_part(query_id, '_', 1) AS source, level, round(avg((r1 + r5 + r20 + r50 + r100) / 5), 6) AS mean_final, count(*) AS queries FROM fs GROUP BY ROLLUP (1, 2)")
def source_means(t: Tables) -> DataFrame:
    """Mean score per source and width, with totals."""
    answers, truth = _answers(t)
    rows = score.final_scores(score.judged(answers, truth), ["query_id", "level"]).withColumn("source", F.split_part("query_id", F.lit("_"), F.lit(1)))
    return rows.rollup("source", "level").agg(F.round(F.avg("final"), 6).alias("mean_final"), F.count(F.lit(1)).alias("queries"))


@query("""WITH an AS (SELECT video_id AS query_id, frame_idx AS f, row_number() OVER (PARTITION BY video_id ORDER BY md5(keyframe_id || CAST(written_at AS VARCHAR)), keyframe_id, written_at) AS rank FROM (SELECT video_id, keyframe_id, frame_idx, epoch_us(written_at) AS written_at FROM keyframe_meta WHERE video_id IS NOT NULL AND frame_idx IS NOT NULL))
    SELECT query_id, count(*) AS answers, greatest(count(*) - 100, 0) AS too_many, greatest(100 - count(*), 0) AS missing, count(*) FILTER (rank <= 100) - count(DISTINCT CASE WHEN rank <= 100 THEN f END) AS repeated FROM an GROUP BY 1""")
def submission_lint(t: Tables) -> DataFrame:
    """How submissions miss their form; delivered copies stand for repeated answers."""
    k = t.raw("keyframe_meta").dropna(subset=["video_id", "frame_idx"]).withColumn("us", F.unix_micros("written_at"))
    w = Window.partitionBy("video_id").orderBy(F.md5(F.concat("keyframe_id", F.col("us").cast("string"))), "keyframe_id", "us")
    return score.lint(k.select(F.col("video_id").alias("query_id"), F.row_number().over(w).alias("rank"), "video_id", F.col("frame_idx").alias("frame_id")))


@query("""SELECT model, count(*) AS served, count(*) FILTER (failed) AS failed, round(count(*) FILTER (NOT failed) * 100.0::DOUBLE / count(*), 6) AS success, round(avg(chars), 6) AS mean_chars, row_number() OVER (ORDER BY count(*) FILTER (NOT failed) DESC, model) AS place
    FROM (SELECT model, length(caption) AS chars, coalesce(regexp_matches(caption, '^\\s*(\\[|\\z)'), true) AS failed FROM ca) GROUP BY 1""")
def served_ranking(t: Tables) -> DataFrame:
    """Captioners by how much they served and how often they failed."""
    rows = t.ca.select("model", F.length("caption").alias("chars"), labels.is_error_text(F.col("caption")).alias("failed"))
    each = rows.groupBy("model").agg(F.count(F.lit(1)).alias("served"), F.count_if("failed").alias("failed"), F.avg("chars").alias("m"))
    good = F.col("served") - F.col("failed")
    return each.select("model", "served", "failed", F.round(good * 100.0 / F.col("served"), 6).alias("success"), F.round("m", 6).alias("mean_chars"), F.row_number().over(Window.orderBy(good.desc(), "model")).alias("place"))


@query("""SELECT 'api' || coalesce('/' || CASE WHEN h LIKE '%429%' THEN '429' WHEN h LIKE '%503%' THEN '503' WHEN h LIKE '%500%' THEN '500' WHEN h LIKE '%403%' THEN '403' WHEN h LIKE '%401%' THEN '401' WHEN h LIKE '%400%' THEN '400' END, '') AS kind, count(*) AS errors FROM (SELECT substr(caption, 1, 200) AS h FROM ca WHERE starts_with(caption, '[')) GROUP BY 1""")
def error_kinds(t: Tables) -> DataFrame:
    """Failed captions by the code in their message."""
    rows = t.ca.where(F.col("caption").startswith("["))
    return rows.groupBy(labels.error_kind(F.lit("api"), F.col("caption")).alias("kind")).agg(F.count(F.lit(1)).alias("errors"))


@query("""SELECT b AS distinct_score, count(q.query_id) AS queries FROM range(6) r(b) LEFT JOIN kis_queries q ON least(greatest(coalesce(distinct_score, 0), 0), 5) = b GROUP BY 1""")
def distinctness_histogram(t: Tables) -> DataFrame:
    """Queries by how distinct they are, with the empty grades."""
    s = F.least(F.greatest(F.coalesce("distinct_score", F.lit(0)), F.lit(0)), F.lit(5)).cast("long")
    counts = t.raw("kis_queries").groupBy(s.alias("distinct_score")).agg(F.count("query_id").alias("queries"))
    return t.spark.range(6).withColumnRenamed("id", "distinct_score").join(counts, "distinct_score", "left").fillna(0, ["queries"])


@query("""SELECT source, count(*) AS queries, min(w) AS least, round(avg(w), 6) AS mean, max(w) AS most FROM (SELECT source, len(list_filter(string_split_regex(query, '\\s+'), lambda x: x <> '')) AS w FROM kis_queries WHERE query IS NOT NULL) GROUP BY 1""")
def query_lengths(t: Tables) -> DataFrame:
    """Words per query by source."""
    rows = t.raw("kis_queries").where("query is not null").select("source", labels.word_count(F.col("query")).alias("w"))
    return rows.groupBy("source").agg(F.count(F.lit(1)).alias("queries"), F.min("w").alias("least"), F.round(F.avg("w"), 6).alias("mean"), F.max("w").alias("most"))


@query("""SELECT label, i, round(avg(x), 6) AS mean FROM (SELECT label, generate_subscripts(embedding, 1) - 1 AS i, unnest(embedding)::DOUBLE AS x FROM embeddings) GROUP BY 1, 2""")
def mean_vectors(t: Tables) -> DataFrame:
    """Each label's mean vector, an element a row."""
    e = t.raw("embeddings").select("label", F.col("embedding").cast("array<double>").alias("v"))
    return score.mean_array(e, ["label"], "v", "m").select("label", F.posexplode("m").alias("i", "x")).select("label", "i", F.round("x", 6).alias("mean"))


@query("""SELECT event_type, count(*) AS requests, round(quantile_cont(value, 0.5), 6) AS median, round(count(*) * 60.0::DOUBLE / nullif(epoch(max(ts)) - epoch(min(ts)), 0), 6) AS per_minute FROM events GROUP BY 1""")
def latency_report(t: Tables) -> DataFrame:
    """Median value and rate by type of event."""
    seconds = F.unix_micros(F.max("ts")) / 1e6 - F.unix_micros(F.min("ts")) / 1e6
    return t.raw("events").groupBy("event_type").agg(F.count(F.lit(1)).alias("requests"), F.round(F.percentile("value", 0.5), 6).alias("median"), F.round(F.count(F.lit(1)) * 60.0 / F.nullif(seconds, F.lit(0.0)), 6).alias("per_minute"))


@query("""SELECT video_id, count(*) AS moved, quantile_cont(abs(d), 0.5) AS median, quantile_cont(abs(d), 0.9) AS p90, count(*) FILTER (d > 0) AS later, count(*) FILTER (d < 0) AS earlier, count(*) FILTER (abs(d) >= 40) AS far FROM (SELECT video_id, anchor_frame - (start_frame + end_frame) // 2 AS d FROM ev WHERE start_frame >= 0 AND end_frame >= start_frame AND anchor_frame IS NOT NULL) WHERE d <> 0 GROUP BY 1""")
def shift_stats(t: Tables) -> DataFrame:
    """How far anchors lie from their events' middles, and on which side."""
    d = t.ev.where("start_frame >= 0 and end_frame >= start_frame and anchor_frame is not null").select("video_id", (F.col("anchor_frame") - F.floor((F.col("start_frame") + F.col("end_frame")) / 2)).alias("d")).where("d <> 0")
    a = F.abs("d")
    return d.groupBy("video_id").agg(F.count(F.lit(1)).alias("moved"), F.percentile(a, 0.5).alias("median"), F.percentile(a, 0.9).alias("p90"), F.count_if(F.col("d") > 0).alias("later"), F.count_if(F.col("d") < 0).alias("earlier"), F.count_if(a >= 40).alias("far"))


@query("""SELECT v.video_id, round((SELECT count(DISTINCT s) FROM (SELECT unnest(range(greatest(0, frame_idx - 149), least(frame_idx, v.n_frames - 1) + 1)) AS s FROM kf WHERE kf.video_id = v.video_id AND frame_idx IS NOT NULL)) / v.n_frames::DOUBLE, 9) AS share
    FROM (SELECT DISTINCT video_id, n_frames FROM vi) v SEMI JOIN (SELECT video_id FROM kf WHERE frame_idx IS NOT NULL) k USING (video_id)""")
def window_coverage(t: Tables) -> DataFrame:
    """The share of 150-frame windows that hold a keyframe."""
    rows = t.kf.where("frame_idx is not null").join(t.vi.select("video_id", (F.col("n_frames") - 1).alias("last")).distinct(), "video_id")
    return score.covered_share(rows, ["video_id"], "frame_idx", 150, "last").select("video_id", F.round("share", 9).alias("share"))


@query("""SELECT level, count(*) AS phases, count(*) FILTER (d = 0) AS exact, count(*) FILTER (d <= 10) AS within10, count(*) FILTER (d <= 30) AS within30 FROM (SELECT caption_level AS level, (SELECT min(abs(frame_idx - e.anchor_frame)) FROM kf WHERE kf.video_id = e.video_id) AS d FROM ev e WHERE anchor_frame IS NOT NULL) GROUP BY 1""")
def recovery_report(t: Tables) -> DataFrame:
    """How near to events' anchors keyframes lie, by level."""
    from filmstrip.operators.joins import nearest_in_pool

    e = t.ev.where("anchor_frame is not null").withColumn("own", F.array().cast("array<bigint>"))
    rep = nearest_in_pool(e, t.kf, "video_id", "anchor_frame", "own", "frame_idx", "id")
    pool = t.kf.where("frame_idx is not null").select("video_id").distinct().withColumn("has", F.lit(True))
    d = F.when(F.col("has"), F.abs(F.col("rep_frame") - F.col("anchor_frame")))
    rows = e.join(rep, "id").join(pool, "video_id", "left").select(F.col("caption_level").alias("level"), d.alias("d"))
    return rows.groupBy("level").agg(F.count(F.lit(1)).alias("phases"), F.count_if(F.col("d") == 0).alias("exact"), F.count_if(F.col("d") <= 10).alias("within10"), F.count_if(F.col("d") <= 30).alias("within30"))


_CHECKED = """e AS (SELECT ev.*, n_frames, lag(end_frame) OVER s AS pe, row_number() OVER s - 1 AS seat, row_number() OVER c - 1 AS scene_seat FROM ev LEFT JOIN (SELECT DISTINCT video_id, n_frames FROM vi) l USING (video_id)
    WINDOW s AS (PARTITION BY video_id, shot_index ORDER BY ord_in_shot, id), c AS (PARTITION BY video_id, scene_id ORDER BY event_ord, id)), f AS (SELECT DISTINCT id, start_frame, end_frame, keyframe_frames FROM video_events)"""


@query(f"""WITH {_CHECKED} SELECT 'frames exist' AS rule, count(*) FILTER (start_frame < 0 OR end_frame >= n_frames) AS broken FROM e UNION ALL SELECT 'ends in order', count(*) FILTER (end_frame < start_frame) FROM e
    UNION ALL SELECT 'anchor inside', count(*) FILTER (NOT anchor_frame BETWEEN start_frame AND end_frame) FROM e UNION ALL SELECT 'tiled', count(*) FILTER (pe + 1 <> start_frame) FROM e
    UNION ALL SELECT 'ord_in_shot', count(*) FILTER (ord_in_shot <> seat) FROM e UNION ALL SELECT 'event_ord', count(*) FILTER (event_ord <> scene_seat) FROM e
    UNION ALL SELECT 'long enough', count(*) FILTER (end_frame - start_frame + 1 < 0.4::DOUBLE * fps) FROM e UNION ALL SELECT 'one fps', count(*) FROM (SELECT video_id FROM ev GROUP BY 1 HAVING count(DISTINCT fps) > 1)
    UNION ALL SELECT 'shot exists', count(*) FROM ev ANTI JOIN sh USING (video_id, shot_index)
    UNION ALL SELECT 'keyframes inside', count(*) FILTER (len(list_filter(keyframe_frames, lambda x: x < start_frame OR x > end_frame)) > 0) FROM f""")
def event_checks(t: Tables) -> DataFrame:
    """How many events break each rule of the event table."""
    events = t.ev.join(t.raw("video_events").select("id", "keyframe_frames").distinct(), "id")
    return check_events(events, t.sh, t.vi.select("video_id", "n_frames").distinct())
