"""Window and sequence operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from filmstrip.catalog.base import Tables, query
from filmstrip.functions.vectors import dot
from filmstrip.operators import windows as W
from filmstrip.plans.ordered import chunked, scan

#: Samples of a shot for curves: its events in order, with known motion.
_S = "s AS (SELECT id, video_id, shot_index, mag_mean AS y, boundary_score AS b, anchor_frame AS f, row_number() OVER (PARTITION BY video_id, shot_index ORDER BY ord_in_shot, id) AS i FROM ev WHERE video_id IS NOT NULL AND shot_index IS NOT NULL AND mag_mean IS NOT NULL AND anchor_frame IS NOT NULL)"
_KEY = ["video_id", "shot_index"]


def samples(t: Tables) -> DataFrame:
    rows = t.ev.dropna(subset=[*_KEY, "mag_mean", "anchor_frame"])
    i = F.row_number().over(Window.partitionBy(*_KEY).orderBy("ord_in_shot", "id"))
    return rows.select("id", *_KEY, F.col("mag_mean").alias("y"), F.col("boundary_score").alias("b"), F.col("anchor_frame").alias("f"), i.alias("i"))


@query("SELECT id, row_number() OVER (PARTITION BY video_id, scene_id ORDER BY start_frame, shot_index, ord_in_shot, id) - 1 AS event_ord FROM ev WHERE start_frame IS NOT NULL AND shot_index IS NOT NULL")
def scene_event_ord(t: Tables) -> DataFrame:
    """The order of events in their scenes, across shots."""
    w = Window.partitionBy("video_id", "scene_id").orderBy("start_frame", "shot_index", "ord_in_shot", "id")
    return t.ev.where("start_frame is not null and shot_index is not null").select("id", (F.row_number().over(w) - 1).alias("event_ord"))


@query(f"WITH {_S} SELECT id, round(sum(y) OVER (PARTITION BY video_id, shot_index ORDER BY i), 6) AS motion, round(coalesce(f - lag(f) OVER (PARTITION BY video_id, shot_index ORDER BY i), 0), 6) AS gap FROM s")
def cumulative_motion(t: Tables) -> DataFrame:
    """Motion summed up along each shot, and the way from sample to sample."""
    by, _ = W.over(_KEY, "i")
    return samples(t).select("id", F.round(F.sum("y").over(by.rowsBetween(Window.unboundedPreceding, 0)), 6).alias("motion"), F.coalesce(F.col("f") - F.lag("f").over(by), F.lit(0)).cast("double").alias("gap"))


@query(f"""WITH {_S} SELECT id, round(coalesce(abs(am - bm) + CASE WHEN na >= 1e-6 AND nb >= 1e-6 THEN 1 - (ax * bx + ay * by1) / (na * nb) ELSE 0 END * least(am, bm), 0), 6) AS turn FROM (SELECT *, sqrt(ax * ax + ay * ay) AS na, sqrt(bx * bx + by1 * by1) AS nb FROM
    (SELECT id, avg(dx) OVER p AS bx, avg(dx) OVER n AS ax, avg(dy) OVER p AS by1, avg(dy) OVER n AS ay, avg(y) OVER p AS bm, avg(y) OVER n AS am FROM (SELECT *, ((id * 37) % 201 - 100) / 50.0::DOUBLE AS dx, ((id * 91) % 201 - 100) / 50.0::DOUBLE AS dy FROM s)
    WINDOW p AS (PARTITION BY video_id, shot_index ORDER BY i ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING), n AS (PARTITION BY video_id, shot_index ORDER BY i ROWS BETWEEN CURRENT ROW AND 1 FOLLOWING)))""")
def turn_curve(t: Tables) -> DataFrame:
    """How much the motion turns or changes at each sample."""
    by, _ = W.over(_KEY, "i")
    dx, dy = (F.col("id") * 37 % 201 - 100) / 50.0, (F.col("id") * 91 % 201 - 100) / 50.0
    s = samples(t).withColumn("dx", dx).withColumn("dy", dy)
    return s.select("id", F.round(W.turning(F.col("dx"), F.col("dy"), F.col("y"), F.lit(True), by, 2), 6).alias("turn"))


@query(f"""WITH {_S} SELECT id, CASE WHEN n < 3 THEN 0 ELSE round(coalesce((pow(py - ny, 2) + pow(pb - nb, 2)) / 2, 0), 6) END AS change FROM (SELECT id, count(*) OVER (PARTITION BY video_id, shot_index) AS n, avg(y) OVER p AS py, avg(y) OVER f2 AS ny, avg(b) OVER p AS pb, avg(b) OVER f2 AS nb FROM s
    WINDOW p AS (PARTITION BY video_id, shot_index ORDER BY i ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING), f2 AS (PARTITION BY video_id, shot_index ORDER BY i ROWS BETWEEN CURRENT ROW AND 1 FOLLOWING))""")
def change_curve(t: Tables) -> DataFrame:
    """How badly what came before tells what follows."""
    by, whole = W.over(_KEY, "i")
    return samples(t).select("id", F.round(W.predictability([F.col("y"), F.col("b")], by, whole, 2), 6).alias("change"))


def _smooth_sql() -> str:
    terms = []
    for k, w in zip(range(-3, 4), W.gaussian(1.0)):
        v = "y" if not k else f"coalesce({'lag' if k < 0 else 'lead'}(y, {abs(k)}) OVER o, {'first' if k < 0 else 'last'}_value(y) OVER a)"
        terms.append(f"{w!r}::DOUBLE * {v}")
    return " + ".join(terms)


@query(f"""WITH {_S} SELECT id, round(CASE WHEN count(*) OVER a < 3 THEN y ELSE {_smooth_sql()} END, 6) AS smooth FROM s WINDOW o AS (PARTITION BY video_id, shot_index ORDER BY i), a AS (PARTITION BY video_id, shot_index ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""")
def smoothed(t: Tables) -> DataFrame:
    """Motion under a bell curve whose ends repeat the first and last value."""
    by, whole = W.over(_KEY, "i")
    return samples(t).select("id", F.round(W.smooth(F.col("y"), by, whole, 1.0), 6).alias("smooth"))


@query(f"""WITH {_S} SELECT id, round(CASE WHEN hi > lo THEN (y - lo) / (hi - lo) ELSE 0 END, 6) AS plain, round(least(greatest((y - lo) / greatest(hi - lo, 0.8::DOUBLE), 0), 1), 6) AS floored FROM (SELECT id, y, min(y) OVER w AS lo, max(y) OVER w AS hi FROM s WINDOW w AS (PARTITION BY video_id, shot_index))""")
def normalised_motion(t: Tables) -> DataFrame:
    """Motion from 0 to 1 by range, and by a range of at least a floor."""
    _, whole = W.over(_KEY, "i")
    y = F.col("y")
    return samples(t).select("id", F.round(W.min_max(y, whole), 6).alias("plain"), F.round(W.floor_normalised(y, whole, 0.8), 6).alias("floored"))


@query(f"""WITH {_S} SELECT id FROM (SELECT id, b, lag(b) OVER w AS p, lead(b) OVER w AS n FROM s WINDOW w AS (PARTITION BY video_id, shot_index ORDER BY i)) WHERE b >= 0.25 AND b > p AND b >= n""")
def boundary_peaks(t: Tables) -> DataFrame:
    """Samples whose boundary score is a peak."""
    by, _ = W.over(_KEY, "i")
    return samples(t).withColumn("peak", W.is_peak(F.col("b"), by, 0.25)).where("peak").select("id")


_STEEP = """r AS (SELECT *, row_number() OVER o - 1 AS i, count(*) OVER (PARTITION BY video_id) AS m, greatest(max(size) OVER (PARTITION BY video_id), 1e-12) AS top,
    lead(size, 1) OVER o AS s1, lead(size, 2) OVER o AS s2, lead(size, 3) OVER o AS s3 FROM g WINDOW o AS (PARTITION BY video_id ORDER BY frame_idx)), s AS (SELECT *, (coalesce(a1 / sqrt(1 + a1 * a1 + 1e-12::DOUBLE), 0) + coalesce(a2 / sqrt(4 + a2 * a2 + 1e-12::DOUBLE), 0) + coalesce(a3 / sqrt(9 + a3 * a3 + 1e-12::DOUBLE), 0)) / nullif((s1 IS NOT NULL)::INT + (s2 IS NOT NULL)::INT + (s3 IS NOT NULL)::INT, 0) AS st
    FROM (SELECT *, (s1 - size) * 100.0::DOUBLE / top AS a1, (s2 - size) * 100.0::DOUBLE / top AS a2, (s3 - size) * 100.0::DOUBLE / top AS a3 FROM r)), k AS (SELECT *, CASE WHEN m > 2 THEN row_number() OVER (PARTITION BY video_id ORDER BY st DESC NULLS LAST, i) <= greatest(1, floor(0.02::DOUBLE * (m - 1))) AND st IS NOT NULL ELSE i = 0 END AS steep, i // {win} AS win FROM s),
    c AS (SELECT *, max(steep::INT) OVER (PARTITION BY video_id, win) AS has, row_number() OVER (PARTITION BY video_id, win ORDER BY st DESC NULLS LAST, i) AS wr FROM k), picks AS (SELECT video_id, frame_idx, CASE WHEN steep THEN 'steep' ELSE 'cover' END AS pick FROM c WHERE steep OR (has = 0 AND wr = 1 AND m > 2 AND st IS NOT NULL))"""


@query(f"""WITH g AS (SELECT video_id, keyframe_id, frame_idx, length(keyframe_path) * 1000 + frame_idx % 997 AS size FROM kf WHERE video_id IS NOT NULL AND frame_idx IS NOT NULL), {_STEEP.replace('{win}', '20')} SELECT video_id, frame_idx, pick FROM picks""")
def steep_keyframes(t: Tables) -> DataFrame:
    """The samples where sizes change most, and one in each window without any."""
    g = t.kf.dropna(subset=["video_id", "frame_idx"]).select("video_id", "frame_idx", (F.length("keyframe_path") * 1000 + F.col("frame_idx") % 997).cast("double").alias("size"))
    return W.steepest(g, ["video_id"], "frame_idx", "size", 0.02, 20)


@query("""SELECT event_id, sum(n) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS visit FROM (SELECT event_id, user_id, ts, coalesce((epoch_us(ts) / 1e6::DOUBLE - epoch_us(lag(ts) OVER w) / 1e6::DOUBLE > 86400)::INT, 0) AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts))""")
def visits(t: Tables) -> DataFrame:
    """Sessions of users, parted by a day without an event."""
    e = t.raw("events").select("event_id", "user_id", (F.unix_micros("ts") / 1e6).alias("at"))
    return W.islands(e, ["user_id"], "at", 86400, "visit").select("event_id", "visit")


@query("""SELECT vec_id, label, round(list_dot_product(v, p), 6) AS similarity FROM (SELECT vec_id, label, v, lag(v) OVER (PARTITION BY label ORDER BY vec_id) AS p FROM (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings)) WHERE p IS NOT NULL""")
def adjacent_similarity(t: Tables) -> DataFrame:
    """How like each row is to the one before it in its group."""
    return _neighbouring(t).select("vec_id", "label", F.round("s", 6).alias("similarity"))


def _neighbouring(t: Tables) -> DataFrame:
    """vec_id, label, s: how like each row is to the one before it in its label, whose rows may lie in many chunks."""
    e = t.raw("embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))
    rows = scan(chunked(e, ["label"], ["vec_id"]), ["label"], ["vec_id"], prior={"p": F.col("v")}).where("p is not null")
    return rows.select("vec_id", "label", dot(F.col("v"), F.col("p")).alias("s"))


@query("""SELECT label, median, p90, alike, n FROM (SELECT label, round(quantile_cont(s, 0.5), 6) AS median, round(quantile_cont(s, 0.9), 6) AS p90, count(*) FILTER (s >= 0.5) AS alike, count(*) AS n FROM (SELECT label, list_dot_product(v, lag(v) OVER (PARTITION BY label ORDER BY vec_id)) AS s FROM (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings)) WHERE s IS NOT NULL GROUP BY 1)""")
def distinctness_report(t: Tables) -> DataFrame:
    """How distinct neighbouring rows of a group are."""
    s = _neighbouring(t)
    return s.groupBy("label").agg(F.round(F.percentile("s", 0.5), 6).alias("median"), F.round(F.percentile("s", 0.9), 6).alias("p90"), F.count_if(F.col("s") >= 0.5).alias("alike"), F.count(F.lit(1)).alias("n"))


@query(f"WITH {_S} SELECT video_id, shot_index, coalesce(bool_and(ok), true) AS ordered, count(*) FILTER (NOT ok) AS violations FROM (SELECT video_id, shot_index, f > lag(f) OVER (PARTITION BY video_id, shot_index ORDER BY i) AS ok FROM s) GROUP BY 1, 2")
def order_checks(t: Tables) -> DataFrame:
    """Whether anchors rise along each shot."""
    by, _ = W.over(_KEY, "i")
    s = samples(t).withColumn("ok", F.col("f") > F.lag("f").over(by))
    return s.groupBy(*_KEY).agg(F.coalesce(F.bool_and("ok"), F.lit(True)).alias("ordered"), F.count_if(~F.col("ok")).alias("violations"))


@query("""SELECT video_id, coalesce(max(g), 0) AS widest, round(coalesce(avg(g), 0), 6) AS mean FROM (SELECT video_id, lead(frame_idx) OVER (PARTITION BY video_id ORDER BY frame_idx) - frame_idx AS g FROM kf WHERE frame_idx IS NOT NULL AND video_id IS NOT NULL) GROUP BY 1""")
def frame_gaps(t: Tables) -> DataFrame:
    """Gaps between neighbouring keyframes."""
    order = ["frame_idx", "keyframe_id"]
    rows = scan(chunked(t.kf.where("frame_idx is not null and video_id is not null"), ["video_id"], order), ["video_id"], order, after={"next": F.col("frame_idx")})
    g = F.col("next") - F.col("frame_idx")
    return rows.groupBy("video_id").agg(F.coalesce(F.max(g), F.lit(0)).alias("widest"), F.round(F.coalesce(F.avg(g), F.lit(0)), 6).alias("mean"))


@query(f"WITH {_S} SELECT video_id, shot_index, part, count(*) AS steps, round(avg(y), 6) AS mean FROM (SELECT *, least(2, (i - 1) * 3 // count(*) OVER (PARTITION BY video_id, shot_index)) AS part FROM s) GROUP BY 1, 2, 3")
def three_parts(t: Tables) -> DataFrame:
    """Each shot's motion in three parts of equal length."""
    _, whole = W.over(_KEY, "i")
    s = samples(t).withColumn("part", F.least(F.lit(2), F.floor((F.col("i") - 1) * 3 / F.count(F.lit(1)).over(whole))))
    return s.groupBy(*_KEY, "part").agg(F.count(F.lit(1)).alias("steps"), F.round(F.avg("y"), 6).alias("mean"))


@query("""WITH c AS (SELECT e.video_id, e.shot_index, s.start_frame AS a, s.end_frame AS b, e.start_frame AS cut FROM ev e JOIN sh s ON e.video_id = s.video_id AND e.shot_index = s.shot_index WHERE e.start_frame IS NOT NULL),
    m AS (SELECT video_id, shot_index, min(a) AS a, max(b) AS b, list_prepend(min(a), list_sort(list(DISTINCT cut) FILTER (cut > a AND cut <= b))) AS l FROM c GROUP BY 1, 2), x AS (SELECT video_id, shot_index, b, coalesce(l, [a]) AS l FROM m),
    u AS (SELECT video_id, shot_index, b, l, unnest(range(len(l))) AS ord FROM x) SELECT video_id, shot_index, ord, l[ord + 1] AS start_frame, coalesce(l[ord + 2] - 1, b) AS end_frame, CASE WHEN ord = 0 THEN (l[1] + coalesce(l[2] - 1, b)) // 2 ELSE l[ord + 1] END AS anchor FROM u""")
def tiled_segments(t: Tables) -> DataFrame:
    """Segments that tile each shot, cut at its events' beginnings."""
    e = t.ev.where("start_frame is not null").select(*_KEY, F.col("start_frame").alias("cut"))
    rows = e.join(t.sh.select(*_KEY, F.col("start_frame").alias("a"), F.col("end_frame").alias("b")), _KEY)
    return W.segments(rows, _KEY, "cut", "a", "b").select(*_KEY, "ord", F.col("start").alias("start_frame"), F.col("end").alias("end_frame"), "anchor")


@query("""SELECT event_id, count(*) OVER (PARTITION BY event_type ORDER BY s RANGE BETWEEN 60 PRECEDING AND CURRENT ROW) AS last_minute, coalesce(s - lag(s) OVER (PARTITION BY event_type ORDER BY s, event_id), 0) AS spacing FROM (SELECT event_id, event_type, epoch_us(ts) // 1000000 AS s FROM events)""")
def request_rate(t: Tables) -> DataFrame:
    """Requests of the last minute at each request, and the seconds since the one before."""
    e = t.raw("events").select("event_id", "event_type", F.floor(F.unix_micros("ts") / 1000000).alias("s")).where("event_type is not null")
    return W.request_rates(e, "event_type", "s", "event_id")
