"""Composite queries, and pictures."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from filmstrip.catalog.base import Tables, query
from filmstrip.functions import frames, labels, pixels
from filmstrip.operators import folds
from filmstrip.operators.joins import nearest_in_pool, value_at
from filmstrip.plans.detection import shots
from filmstrip.plans.localise import localise
from filmstrip.plans.ordered import chunked, scan
from filmstrip.plans.ordinals import ordinals
from filmstrip.plans.segmentation import segment


@query("""SELECT e.id, (SELECT arg_min(keyframe_id, abs(frame_idx - e.anchor_frame) * 100000000 + frame_idx) FROM kf WHERE kf.video_id = e.video_id AND frame_idx IS NOT NULL) AS rep_keyframe_id FROM ev e WHERE anchor_frame IS NOT NULL AND video_id IS NOT NULL
    AND EXISTS (SELECT 1 FROM kf WHERE kf.video_id = e.video_id AND frame_idx IS NOT NULL)""")
def event_rep_keyframe(t: Tables) -> DataFrame:
    """The id of the keyframe nearest to each event's anchor in its video."""
    e = t.ev.where("anchor_frame is not null and video_id is not null").withColumn("own", F.array().cast("array<bigint>"))
    rep = nearest_in_pool(e, t.kf, "video_id", "anchor_frame", "own", "frame_idx", "id")
    k = t.kf.where("frame_idx is not null").groupBy("video_id", F.col("frame_idx").alias("rep_frame")).agg(F.min("keyframe_id").alias("rep_keyframe_id"))
    return e.select("id", "video_id").join(rep, "id").join(k, ["video_id", "rep_frame"]).select("id", "rep_keyframe_id")


@query("""SELECT e.id, list_sum(v) AS total, len(v) AS size FROM (SELECT e.id, (SELECT arg_min([frame_idx::DOUBLE, fps], abs(frame_idx - e.anchor_frame) * 100000000 + frame_idx) FROM kf WHERE kf.video_id = e.video_id AND frame_idx IS NOT NULL) AS v FROM ev e WHERE anchor_frame IS NOT NULL AND video_id IS NOT NULL) e WHERE v IS NOT NULL""")
def event_vectors(t: Tables) -> DataFrame:
    """The vector of the frame at each event's anchor or, if that frame has none, of the nearest one that does."""
    pool = t.kf.select("video_id", "frame_idx", F.array(F.col("frame_idx").cast("double"), "fps").alias("v"))
    got = value_at(t.ev, pool, "video_id", "anchor_frame", "id", "frame_idx", "v")
    return got.select("id", F.aggregate("v", F.lit(0.0), lambda a, x: a + x).alias("total"), F.size("v").alias("size"))


@query("""SELECT video_id, w AS window_start, least(w + 74, n_frames - 1) AS keep_end, greatest(w - 25, 0) AS read_start, least(w + 74 + 25, n_frames - 1) AS read_end FROM (SELECT DISTINCT video_id, n_frames, unnest(range(0, n_frames, 50)) AS w FROM vi)""")
def model_windows(t: Tables) -> DataFrame:
    """Overlapping windows of frames for a shot model, whose middle part is kept."""
    v = t.vi.select("video_id", "n_frames").distinct().where("n_frames > 0")
    w = v.select("video_id", "n_frames", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_frames") - 1, F.lit(50).cast("long"))).alias("w"))
    last = F.col("n_frames") - 1
    return w.select("video_id", F.col("w").alias("window_start"), F.least(F.col("w") + 74, last).alias("keep_end"), F.greatest(F.col("w") - 25, F.lit(0)).alias("read_start"), F.least(F.col("w") + 99, last).alias("read_end"))


@query("""SELECT s.id, 'Label ' || greatest(n_keyframes, 1) || ' pictures, one line each.' || CASE WHEN motion_hint <> '' THEN chr(10) || 'Motion: ' || motion_hint ELSE '' END || CASE WHEN c <> '' THEN chr(10) || 'Before: ' || c ELSE '' END AS prompt FROM
    (SELECT id, n_keyframes, motion_hint, lag(motion_hint) OVER (PARTITION BY video_id ORDER BY shot_index, id) AS c FROM sh WHERE video_id IS NOT NULL) s""")
def prompts(t: Tables) -> DataFrame:
    """A labelling prompt per shot, with its motion and that of the shot before."""
    order = ["shot_index", "id"]
    rows = scan(chunked(t.sh.where("video_id is not null"), ["video_id"], order), ["video_id"], order, prior={"c": F.col("motion_hint")})
    return rows.select("id", labels.prompt(F.greatest("n_keyframes", F.lit(1)), F.col("motion_hint"), F.col("c")).alias("prompt"))


@query("""SELECT id, n, round(a + (b - a) * 0.5::DOUBLE / n, 6) AS first_time, round(a + (b - a) * (n - 0.5::DOUBLE) / n, 6) AS last_time FROM (SELECT id, a, b, least(8, greatest(1, CAST(round_even(2.0::DOUBLE * (b - a), 0) AS INTEGER))) AS n FROM (SELECT id, start_frame / fps AS a, (end_frame + 1) / fps AS b FROM sh WHERE fps > 0 AND end_frame >= start_frame))""")
def clip_grids(t: Tables) -> DataFrame:
    """The times of the frames that a captioner gets of each shot."""
    a, b = F.col("start_frame") / F.col("fps"), (F.col("end_frame") + 1) / F.col("fps")
    rows = t.sh.where("fps > 0 and end_frame >= start_frame").select("id", frames.clip_times(a, b, 2.0, 8).alias("g"))
    return rows.select("id", F.size("g").alias("n"), F.round(F.element_at("g", 1), 6).alias("first_time"), F.round(F.element_at("g", -1), 6).alias("last_time"))


@query("""WITH k AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY frame_idx, keyframe_id) - 1 AS pos, count(*) OVER (PARTITION BY video_id) AS n FROM kf WHERE frame_idx IS NOT NULL AND video_id IS NOT NULL),
    p AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY md5('42' || keyframe_id), keyframe_id) AS r FROM k WHERE n >= 20 AND pos >= floor(0.1::DOUBLE * n) AND pos < floor(0.9::DOUBLE * n))
    SELECT printf('kis_%03d', row_number() OVER (ORDER BY video_id) - 1) AS query_id, video_id AS gt_video, frame_idx AS gt_frame, greatest(frame_idx - 30, 0) AS first, least(frame_idx + 30, n_frames - 1) AS last FROM p JOIN (SELECT DISTINCT video_id, n_frames FROM vi) v USING (video_id) WHERE r = 1""")
def ground_truth(t: Tables) -> DataFrame:
    """One keyframe a video, not from its ends, as a known answer; a video that has too few gives none."""
    from filmstrip.functions.ids import numbered
    from filmstrip.plans.ordered import chunked, positions

    k = ordinals(t.kf.dropna(subset=["frame_idx", "video_id"]), ["video_id"], ["frame_idx", "keyframe_id"], "pos", "n")
    drawn = F.struct(F.md5(F.concat(F.lit("42"), "keyframe_id")).alias("h"), "keyframe_id", "frame_idx")
    k = k.where("n >= 20 and pos >= floor(0.1D * n) and pos < floor(0.9D * n)").groupBy("video_id").agg(F.min(drawn)["frame_idx"].alias("frame_idx"))
    rows = k.join(t.vi.select("video_id", "n_frames").distinct(), "video_id").select("video_id", "frame_idx", "n_frames")
    placed = positions(chunked(rows, [], ["video_id"], seats=True), "i")
    return placed.select(numbered("kis_", F.col("i")).alias("query_id"), F.col("video_id").alias("gt_video"), F.col("frame_idx").alias("gt_frame"), F.greatest(F.col("frame_idx") - 30, F.lit(0)).alias("first"), F.least(F.col("frame_idx") + 30, F.col("n_frames") - 1).alias("last"))


_CUTS = """s AS (SELECT video_id, anchor_frame AS f, max(mag_mean) * 20 AS y FROM ev WHERE video_id IS NOT NULL AND anchor_frame IS NOT NULL AND mag_mean IS NOT NULL GROUP BY 1, 2), b AS (SELECT video_id, min(n_frames) AS n FROM vi WHERE n_frames > 0 GROUP BY 1)"""


@query(f"""WITH {_CUTS}, c AS (SELECT video_id, f, row_number() OVER (PARTITION BY video_id ORDER BY f) AS rn FROM (SELECT video_id, f, abs(y - lag(y) OVER (PARTITION BY video_id ORDER BY f)) AS d FROM s) WHERE d >= 27),
    r AS (SELECT video_id, 0::BIGINT AS rn, 0::BIGINT AS last, []::BIGINT[] AS cuts FROM b UNION ALL SELECT r.video_id, r.rn + 1, CASE WHEN c.f - r.last >= 15 THEN c.f ELSE r.last END, CASE WHEN c.f - r.last >= 15 THEN list_append(cuts, c.f) ELSE cuts END FROM r JOIN c ON c.video_id = r.video_id AND c.rn = r.rn + 1),
    k AS (SELECT video_id, n, list_prepend(0, list_filter(cuts, lambda x: x < n)) AS l FROM r JOIN b USING (video_id) QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY rn DESC) = 1)
    SELECT video_id, i AS shot_index, l[i + 1] AS start_frame, coalesce(l[i + 2] - 1, n - 1) AS end_frame FROM (SELECT *, unnest(range(len(l))) AS i FROM k)""", recursive=True)
def detected_shots(t: Tables) -> DataFrame:
    """Shots of each video, cut where neighbouring samples differ much; a video without a cut is one shot."""
    e = t.ev.dropna(subset=["video_id", "anchor_frame", "mag_mean"]).groupBy("video_id", F.col("anchor_frame").alias("frame_idx")).agg((F.max("mag_mean") * 20).alias("y"))
    videos = t.vi.where("n_frames > 0 and video_id is not null").groupBy("video_id").agg(F.min("n_frames").alias("n_frames"))
    return shots("content", videos, e.withColumn("look", F.array("y")))


@query(f"""WITH {_CUTS}, p AS (SELECT video_id, f, y > 15 AS on_, coalesce(lag(y > 15) OVER (PARTITION BY video_id ORDER BY f), false) AS was FROM s JOIN b USING (video_id) WHERE f < n), k AS (SELECT video_id, n, list_prepend(0, coalesce(list_sort(list(f) FILTER (was AND NOT on_)), [])) AS starts FROM b LEFT JOIN p USING (video_id) GROUP BY 1, 2),
    e AS (SELECT video_id, coalesce(list_sort(list(f - 1) FILTER (on_ AND NOT was AND f > 0)), []) AS ends, arg_max(on_, f) AS last FROM p GROUP BY 1), x AS (SELECT video_id, n, starts, CASE WHEN coalesce(last, false) THEN ends ELSE list_append(coalesce(ends, []), n - 1) END AS ends FROM k LEFT JOIN e USING (video_id)), z AS (SELECT video_id, unnest(starts) AS a, n FROM x), w AS (SELECT video_id, unnest(ends) AS z FROM x),
    m AS (SELECT z.video_id, a, min(w.z) AS t FROM z JOIN w ON w.video_id = z.video_id AND w.z >= z.a GROUP BY 1, 2), u AS (SELECT video_id, a, t FROM m UNION ALL SELECT video_id, 0, n - 1 FROM b WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.video_id = b.video_id)) SELECT video_id, row_number() OVER (PARTITION BY video_id ORDER BY a) - 1 AS shot_index, a AS start_frame, t AS end_frame FROM u""")
def predicted_shots(t: Tables) -> DataFrame:
    """Shots of each video, parted by the samples to which a model gives a transition."""
    e = t.ev.dropna(subset=["video_id", "anchor_frame", "mag_mean"]).groupBy("video_id", F.col("anchor_frame").alias("frame_idx")).agg((F.max("mag_mean") * 20).alias("y"))
    videos = t.vi.where("n_frames > 0 and video_id is not null").groupBy("video_id").agg(F.min("n_frames").alias("n_frames"))
    return shots("transitions", videos, e.withColumn("probability", F.col("y") / 30))


@query()
def localised_phases(t: Tables) -> DataFrame:
    """Three phases of each label, found again among its rows in order. Tested on a known answer."""
    e = t.raw("embeddings").select("label", "vec_id", F.col("embedding").alias("clip"), F.col("embedding").alias("e5"))
    placed = ordinals(e, ["label"], ["vec_id"], "i", "n")
    share = F.col("i") / F.greatest(F.lit(1), F.col("n") - 1)
    first = placed.withColumn("phase", F.floor(F.least(share, F.lit(0.999)) * 3).cast("int"))
    first = first.groupBy("label", "phase").agg(F.min(F.struct("vec_id", "clip", "e5")).alias("x")).select("label", "phase", "x.clip", "x.e5")
    out = localise(e, first.select("label", "phase", "clip", "e5"), "label", "vec_id", "phase", {"clip": 3.0, "e5": 1.0}, 3, 1)
    return out.select("label", F.array_join(F.col("path").cast("array<string>"), ",").alias("path"), F.round("score", 6).alias("score"))


@query()
def segmented_shots(t: Tables) -> DataFrame:
    """Shots cut where look and motion change, at each shot's own rate, over samples made of their events. Tested
    on synthetic signals."""
    key = ["video_id", "shot_index"]
    e = t.ev.dropna(subset=[*key, "mag_mean", "anchor_frame"])
    i = F.row_number().over(Window.partitionBy(*key).orderBy("anchor_frame", "id")) - 1
    x, y = (F.col("id") * 37 % 201 - 100) / 50.0, (F.col("id") * 91 % 201 - 100) / 50.0
    samples = e.select(*key, i.alias("i"), F.col("anchor_frame").alias("fidx"), x.alias("dx"), y.alias("dy"), F.col("mag_mean").alias("mag"), (i > 0).alias("real"), F.array(F.col("boundary_score"), F.col("boundary_score")).alias("gray"))
    return segment(samples, t.sh.select(*key, "start_frame", "end_frame", "fps"), key, "fps").select(*key, "ord", F.col("start").alias("start_frame"), F.col("end").alias("end_frame"), "anchor")


@query()
def motion_keyframes(t: Tables) -> DataFrame:
    """Frames at equal parts of each scene's motion, and between them more where too much time would pass. Its parts are
    tested against plain loops."""
    from filmstrip.catalog.folds import scenes

    cumulative = F.aggregate("items", F.array().cast("array<double>"), lambda acc, x: F.concat(acc, F.array(F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0.0)) + x["y"])))
    rows = scenes(t).withColumn("cum", cumulative).withColumn("all", F.array_distinct(F.transform("items", lambda x: x["f"])))
    n = frames.keyframe_budget(F.element_at("cum", -1), 1.0, F.lit(60))
    at = F.array_sort(F.array_distinct(F.transform(folds.arc_targets(F.col("cum"), n, 1), lambda i: F.get("items", i)["f"])))
    rows = rows.withColumn("at", at)
    return rows.select("video_id", "scene_id", F.array_join(folds.fill_gaps(F.col("at"), F.col("all"), 30).cast("array<string>"), ",").alias("frames"))


@query()
def picture_looks(t: Tables) -> DataFrame:
    """Brightness and colours of every keyframe. Tested on known pictures."""
    rows = t.raw("keyframes").select("id", "image").groupBy("id", "image").agg(F.lit(1).alias("one"))
    looks = pixels.looks(rows, "id", "image")
    return looks.select("id", F.round("brightness", 4).alias("brightness"), F.round("deviation", 4).alias("deviation"), "colours")


@query()
def distinct_pictures(t: Tables) -> DataFrame:
    """Each shot's keyframes whose picture differs from all kept before. Tested on known pictures."""
    rows = t.raw("keyframes").groupBy("video_id", "shot_index", "frame_index", "id", "image").agg(F.lit(1).alias("one"))
    return pixels.distinct_pictures(rows, ["video_id", "shot_index"], "frame_index", "id", "image", 0.35)
