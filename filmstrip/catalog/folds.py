"""Greedy folds over the events of a scene and over labelled vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filmstrip.catalog.base import Tables, query
from filmstrip.functions.vectors import dot, relative_change
from filmstrip.operators import folds

_KEY = ["video_id", "scene_id"]
_S = "s AS (SELECT video_id, scene_id, id, anchor_frame AS f, mag_mean AS y, boundary_score AS b, fps, row_number() OVER (PARTITION BY video_id, scene_id ORDER BY anchor_frame, id) AS rn FROM ev WHERE video_id IS NOT NULL AND anchor_frame IS NOT NULL AND mag_mean IS NOT NULL)"
_STEP = "JOIN s ON s.video_id = r.video_id AND s.scene_id = r.scene_id AND s.rn = r.rn + 1"
_LAST = "QUALIFY row_number() OVER (PARTITION BY video_id, scene_id ORDER BY rn DESC) = 1"


def scenes(t: Tables) -> DataFrame:
    """The events of each scene in the order of their anchors, as arrays; a scene is a minute at most."""
    rows = t.ev.where("video_id is not null and anchor_frame is not null and mag_mean is not null")
    rows = rows.select(*_KEY, "id", F.col("anchor_frame").alias("f"), F.col("mag_mean").alias("y"), F.col("boundary_score").alias("b"), "fps")
    return folds.collected(rows, _KEY, ["f", "id"], ["f", "id", "y", "b", "fps"])


def _apart(a: Column, b: Column) -> Column:
    return F.abs(a["y"] - b["y"])


def _ids(kept: str = "kept") -> Column:
    return F.array_join(F.transform(kept, lambda x: x["id"].cast("string")), ",")


@query(f"""WITH {_S}, r AS (SELECT video_id, scene_id, rn, [y] AS ys, [id] AS ids FROM s WHERE rn = 1 UNION ALL SELECT s.video_id, s.scene_id, s.rn, CASE WHEN ok THEN list_append(ys, y) ELSE ys END, CASE WHEN ok THEN list_append(ids, id) ELSE ids END
    FROM (SELECT r.ys, r.ids, s.*, list_min(list_transform(r.ys, lambda x: abs(x - s.y))) > 0.15::DOUBLE AS ok FROM r {_STEP}) s) SELECT video_id, scene_id, array_to_string(ids, ',') AS kept FROM r {_LAST}""", recursive=True)
def deduplicated(t: Tables) -> DataFrame:
    """Events that move unlike all events kept before."""
    return folds.distinct_from_all(scenes(t), _apart, 0.15).select(*_KEY, _ids().alias("kept"))


@query(f"""WITH {_S}, r AS (SELECT video_id, scene_id, rn, f AS lf, y AS ly, [id] AS ids FROM s WHERE rn = 1 UNION ALL SELECT video_id, scene_id, rn, CASE WHEN ok THEN f ELSE lf END, CASE WHEN ok THEN y ELSE ly END, CASE WHEN ok THEN list_append(ids, id) ELSE ids END
    FROM (SELECT r.lf, r.ly, r.ids, s.*, abs(s.y - r.ly) > 0.3::DOUBLE AND s.f - r.lf >= 25 AND len(r.ids) < 8 AS ok FROM r {_STEP}) s) SELECT video_id, scene_id, array_to_string(ids, ',') AS kept FROM r {_LAST}""", recursive=True)
def changed_events(t: Tables) -> DataFrame:
    """Events that move unlike the last one kept, a second after it or later, eight a scene."""
    return folds.changed_from_last(scenes(t), _apart, 0.3, lambda a, b: b["f"] - a["f"], 25, 8).select(*_KEY, _ids().alias("kept"))


_V = "s AS (SELECT label, vec_id // 64 AS part, vec_id, embedding::DOUBLE[] AS v, row_number() OVER (PARTITION BY label, vec_id // 64 ORDER BY vec_id) AS rn FROM embeddings)"
_VSTEP = "JOIN s ON s.label = r.label AND s.part = r.part AND s.rn = r.rn + 1"
_VLAST = "QUALIFY row_number() OVER (PARTITION BY label, part ORDER BY rn DESC) = 1"
SEQUENCE = ["label", "part"]


def sequences(t: Tables) -> DataFrame:
    """The vectors of each label in sequences of 64 ids, as arrays: bounded, however many vectors a label has."""
    e = t.raw("embeddings").select("label", F.floor(F.col("vec_id") / 64).alias("part"), F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("v"))
    return folds.collected(e, SEQUENCE, ["id"], ["id", "v"])


@query(f"""WITH {_V}, r AS (SELECT label, part, rn, v, [vec_id] AS ids FROM s WHERE rn = 1 UNION ALL
    SELECT label, part, rn, CASE WHEN ok THEN v ELSE lv END, CASE WHEN ok THEN list_append(ids, vec_id) ELSE ids END FROM (SELECT r.v AS lv, r.ids, s.*, list_distance(r.v, s.v) / greatest(sqrt(list_dot_product(r.v, r.v)), 1e-8) > 1.2::DOUBLE AS ok FROM r {_VSTEP}) s)
    SELECT label, part, array_to_string(ids, ',') AS kept FROM r {_VLAST}""", recursive=True)
def relative_changes(t: Tables) -> DataFrame:
    """Vectors far from the last one kept, by its length."""
    rows = folds.changed_from_last(sequences(t), lambda a, b: relative_change(a["v"], b["v"]), 1.2)
    return rows.select(*SEQUENCE, _ids().alias("kept"))


@query(f"""WITH {_S}, r AS (SELECT video_id, scene_id, rn, f AS ff, y AS ly, [0] AS ls FROM s WHERE rn = 1 UNION ALL SELECT video_id, scene_id, rn, CASE WHEN ok THEN ff ELSE f END, y, list_append(ls, ls[-1] + CASE WHEN ok THEN 0 ELSE 1 END)
    FROM (SELECT r.ff, r.ly, r.ls, s.*, abs(s.y - r.ly) < 0.4::DOUBLE AND (s.f - r.ff) / s.fps <= 10 AS ok FROM r {_STEP}) s) SELECT video_id, scene_id, array_to_string(ls, ',') AS labels FROM r {_LAST}""", recursive=True)
def capped_scenes(t: Tables) -> DataFrame:
    """Neighbours alike in groups of ten seconds at most."""
    rows = folds.capped_groups(scenes(t), _apart, 0.4, lambda a, b: (b["f"] - a["f"]) / b["fps"], 10)
    return rows.select(*_KEY, F.array_join(F.col("labels").cast("array<string>"), ",").alias("labels"))


@query(f"""WITH {_V}, r AS (SELECT label, part, rn, v, [0] AS ls FROM s WHERE rn = 1 UNION ALL
    SELECT label, part, rn, CASE WHEN ok THEN v ELSE lv END, list_append(ls, ls[-1] + CASE WHEN ok THEN 1 ELSE 0 END) FROM (SELECT r.v AS lv, r.ls, s.*, 1 - list_dot_product(r.v, s.v) > 0.7::DOUBLE AS ok FROM r {_VSTEP}) s)
    SELECT label, part, array_to_string(ls, ',') AS labels FROM r {_VLAST}""", recursive=True)
def running_clusters(t: Tables) -> DataFrame:
    """Clusters of neighbours like the cluster's first row."""
    rows = folds.clusters(sequences(t), lambda a, b: 1 - dot(a["v"], b["v"]), 0.7)
    return rows.select(*SEQUENCE, F.array_join(F.col("labels").cast("array<string>"), ",").alias("labels"))


@query(f"""WITH {_S.replace('ORDER BY anchor_frame, id', 'ORDER BY -boundary_score, anchor_frame, id')}, r AS (SELECT video_id, scene_id, rn, [f] AS fs FROM s WHERE rn = 1 UNION ALL SELECT video_id, scene_id, rn, CASE WHEN ok THEN list_append(fs, f) ELSE fs END
    FROM (SELECT r.fs, s.*, len(r.fs) < 7 AND list_min(list_transform(r.fs, lambda x: abs(x - s.f))) >= 50 AS ok FROM r {_STEP}) s) SELECT video_id, scene_id, array_to_string(list_sort(fs), ',') AS frames FROM r {_LAST}""", recursive=True)
def suppressed_boundaries(t: Tables) -> DataFrame:
    """The best boundaries of each scene, none near a better one."""
    rows = t.ev.where("video_id is not null and anchor_frame is not null and mag_mean is not null").select(*_KEY, (-F.col("boundary_score")).alias("nb"), F.col("anchor_frame").alias("f"), "id")
    kept = folds.suppressed(folds.collected(rows, _KEY, ["nb", "f", "id"], ["nb", "f", "id"]), lambda x: x["f"], 50, 7)
    return kept.select(*_KEY, F.array_join(F.array_sort(F.transform("kept", lambda x: x["f"])).cast("array<string>"), ",").alias("frames"))


@query()
def filled_gaps(t: Tables) -> DataFrame:
    """Keyframes that differ, and between them further ones where more than two seconds would be left empty. Tested
    against a plain loop."""
    rows = folds.distinct_from_all(scenes(t), _apart, 0.5)
    filled = folds.fill_gaps(F.col("kept"), F.col("items"), 60, lambda x: x["f"], _apart, 0.02, anchor_last=True)
    return rows.select(*_KEY, F.array_join(F.transform(filled, lambda x: x["f"].cast("string")), ",").alias("frames"))


@query(f"""WITH {_S}, c AS (SELECT video_id, scene_id, list_reduce(list([y] ORDER BY rn), lambda a, x: list_append(a, a[-1] + x[1])) AS cum FROM s GROUP BY 1, 2),
    f AS (SELECT *, list_transform(range(5), lambda k: [len(list_filter(cum, lambda v: v < cum[-1] * k / 4))]) AS found FROM c), g AS (SELECT *, list_reduce(found, lambda a, x: CASE WHEN x[1] - a[-1] >= 2 THEN list_append(a, x[1]) ELSE a END) AS thin FROM f)
    SELECT video_id, scene_id, array_to_string(list_sort(list_distinct(list_append(thin, len(cum) - 1))), ',') AS picks FROM g""")
def arc_keyframes(t: Tables) -> DataFrame:
    """Samples at equal parts of each scene's motion."""
    cumulative = F.aggregate("items", F.array().cast("array<double>"), lambda acc, x: F.concat(acc, F.array(F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0.0)) + x["y"])))
    rows = scenes(t).withColumn("cum", cumulative)
    return rows.select(*_KEY, F.array_join(folds.arc_targets(F.col("cum"), F.lit(5), 2).cast("array<string>"), ",").alias("picks"))


@query(f"""WITH {_S}, m AS (SELECT *, count(*) OVER (PARTITION BY video_id, scene_id) AS n FROM s), r AS (SELECT video_id, scene_id, 1 AS rn, [f] AS fs, [y] AS ys, [id] AS ids FROM m WHERE m.rn = n // 2 + 1
    UNION ALL SELECT video_id, scene_id, rn + 1, list_append(fs, f), list_append(ys, y), list_append(ids, id) FROM (SELECT r.*, s.f, s.y, s.id FROM r JOIN s ON s.video_id = r.video_id AND s.scene_id = r.scene_id WHERE r.rn < 3 AND list_min(list_transform(r.fs, lambda x: abs(x - s.f))) >= 25
    QUALIFY row_number() OVER (PARTITION BY r.video_id, r.scene_id ORDER BY list_min(list_transform(r.ys, lambda x: abs(x - s.y))) DESC, s.f, s.id DESC) = 1) WHERE list_min(list_transform(ys, lambda x: abs(x - y))) >= 0.35::DOUBLE),
    z AS (SELECT * FROM r {_LAST}), u AS (SELECT video_id, scene_id, unnest(fs) AS f, unnest(ids) AS id FROM z) SELECT video_id, scene_id, string_agg(id, ',' ORDER BY f) AS kept FROM u GROUP BY 1, 2""", recursive=True)
def diverse_events(t: Tables) -> DataFrame:
    """Up to three unlike events of each scene, apart in time."""
    return folds.max_min_picks(scenes(t), _apart, lambda x: x["f"], 3, 0.35, 25).select(*_KEY, _ids().alias("kept"))
