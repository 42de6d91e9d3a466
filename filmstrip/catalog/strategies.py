"""Keyframe strategies over samples made of each shot's events: their anchors, motion and boundary score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filmstrip.catalog.base import Tables, query
from filmstrip.catalog.windows import _STEEP
from filmstrip.plans.strategies import SHOT, keyframes

_FPS = "coalesce(nullif(fps, 0), 25)"
_B = f"""b AS (SELECT video_id, shot_index, start_frame, end_frame, {_FPS} AS rate, (start_frame + end_frame) // 2 AS mid FROM sh WHERE video_id IS NOT NULL AND shot_index IS NOT NULL),
    e AS (SELECT video_id, shot_index, anchor_frame AS f, max(mag_mean) AS y, max(boundary_score) AS z FROM ev WHERE video_id IS NOT NULL AND shot_index IS NOT NULL AND anchor_frame IS NOT NULL AND mag_mean IS NOT NULL AND boundary_score IS NOT NULL GROUP BY ALL)"""
_S = f"""{_B}, s AS (SELECT e.*, rate, mid, row_number() OVER (PARTITION BY video_id, shot_index ORDER BY f) AS rn, count(*) OVER (PARTITION BY video_id, shot_index) AS n FROM e JOIN b USING (video_id, shot_index) WHERE f BETWEEN start_frame AND end_frame AND (f - start_frame) % {{step}} = 0)"""
_NEXT = "JOIN s ON s.video_id = r.video_id AND s.shot_index = r.shot_index AND s.rn = r.rn + 1"
_ENDS = "QUALIFY row_number() OVER (PARTITION BY video_id, shot_index ORDER BY rn DESC) = 1"
_REST = "UNION ALL SELECT video_id, shot_index, mid FROM b WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.video_id = b.video_id AND s.shot_index = b.shot_index)"


def _shots(t: Tables) -> DataFrame:
    return t.sh.dropna(subset=SHOT).select(*SHOT, "start_frame", "end_frame", "fps")


def _samples(t: Tables) -> DataFrame:
    e = t.ev.dropna(subset=[*SHOT, "anchor_frame", "mag_mean", "boundary_score"])
    rows = e.groupBy(*SHOT, F.col("anchor_frame").alias("frame_idx")).agg(F.max("mag_mean").alias("y"), F.max("boundary_score").alias("z"))
    return rows.withColumn("vector", F.array("y", "z")).withColumn("size", F.floor(F.col("y") * 1000) + F.col("frame_idx") % 7)


def _apart(a: Column, b: Column) -> Column:
    return F.abs(a["y"] - b["y"])


@query("SELECT video_id, shot_index, (start_frame + end_frame) // 2 AS frame_idx FROM sh WHERE video_id IS NOT NULL AND shot_index IS NOT NULL")
def middle_keyframes(t: Tables) -> DataFrame:
    """The strategy that takes each shot's middle."""
    return keyframes("middle", _shots(t))


@query("SELECT video_id, shot_index, unnest(CASE WHEN end_frame >= start_frame THEN range(start_frame, end_frame + 1, 24) ELSE [start_frame] END) AS frame_idx FROM sh WHERE video_id IS NOT NULL AND shot_index IS NOT NULL")
def uniform_keyframes(t: Tables) -> DataFrame:
    """The strategy that takes every 24th frame of each shot."""
    return keyframes("uniform", _shots(t))


@query(f"""WITH {_S.format(step=1)}, r AS (SELECT video_id, shot_index, 1 AS rn, mid, [arg_min(f, abs(f - mid) * 1e9::DOUBLE + f)] AS fs, [arg_min(y, abs(f - mid) * 1e9::DOUBLE + f)] AS ys, any_value(rate) AS rate FROM s GROUP BY 1, 2, 3, 4
    UNION ALL SELECT video_id, shot_index, rn + 1, mid, list_append(fs, f), list_append(ys, y), rate FROM (SELECT r.*, s.f, s.y FROM r JOIN s ON s.video_id = r.video_id AND s.shot_index = r.shot_index WHERE r.rn < 3
    AND list_min(list_transform(r.fs, lambda x: abs(x - s.f))) >= greatest(1, floor(r.rate)) QUALIFY row_number() OVER (PARTITION BY r.video_id, r.shot_index ORDER BY list_min(list_transform(r.ys, lambda x: abs(x - s.y))) DESC, s.f) = 1) WHERE list_min(list_transform(ys, lambda x: abs(x - y))) >= 0.35::DOUBLE)
    SELECT video_id, shot_index, unnest(fs) AS frame_idx FROM (SELECT * FROM r {_ENDS}) {_REST}""", recursive=True)
def adaptive_keyframes(t: Tables) -> DataFrame:
    """The strategy that takes up to three unlike samples of each shot, apart in time."""
    return keyframes("adaptive", _shots(t), _samples(t), apart=_apart, fields=["y"], step=1)


@query(f"""WITH {_B}, w AS (SELECT video_id, greatest(1, floor(2.0::DOUBLE * max(rate))) AS win0 FROM b GROUP BY 1), g AS (SELECT video_id, f AS frame_idx, max(floor(y * 1000) + f % 7) AS size, max(win0)::BIGINT AS win0 FROM e JOIN w USING (video_id) GROUP BY 1, 2),
    {_STEEP.replace('{win}', 'win0')} SELECT p.video_id, coalesce((SELECT arg_min(shot_index, end_frame * 100000 + shot_index) FROM b WHERE b.video_id = p.video_id AND end_frame >= frame_idx), (SELECT arg_max(shot_index, end_frame * 100000 - shot_index) FROM b WHERE b.video_id = p.video_id)) AS shot_index, frame_idx FROM picks p""")
def dake_keyframes(t: Tables) -> DataFrame:
    """The strategy that takes the samples of each video after which sizes rise most steeply."""
    samples = _samples(t).groupBy("video_id", "frame_idx").agg(F.max("size").alias("size"))
    return keyframes("dake", _shots(t), samples)


@query(f"""WITH {_S.format(step=2)} SELECT video_id, shot_index, f AS frame_idx FROM (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY video_id, shot_index ORDER BY floor(y * 1000) + f % 7 DESC, f DESC) <= 3) {_REST}""")
def dake_per_shot_keyframes(t: Tables) -> DataFrame:
    """The strategy that takes the three largest pictures of each shot."""
    return keyframes("dake_per_shot", _shots(t), _samples(t), step=2)


@query(f"""WITH {_S.format(step=1)}, r AS (SELECT video_id, shot_index, rn, y AS ly, z AS lz, [f] AS fs FROM s WHERE rn = 1 UNION ALL SELECT video_id, shot_index, rn, CASE WHEN ok THEN y ELSE ly END, CASE WHEN ok THEN z ELSE lz END, CASE WHEN ok THEN list_append(fs, f) ELSE fs END
    FROM (SELECT r.ly, r.lz, r.fs, s.*, sqrt((s.y - r.ly) * (s.y - r.ly) + (s.z - r.lz) * (s.z - r.lz)) / greatest(sqrt(r.ly * r.ly + r.lz * r.lz), 1e-8) > 0.4::DOUBLE AS ok FROM r {_NEXT}) s) SELECT video_id, shot_index, unnest(fs) AS frame_idx FROM (SELECT * FROM r {_ENDS}) {_REST}""", recursive=True)
def clip_keyframes(t: Tables) -> DataFrame:
    """The strategy that takes samples whose vector is far from the last one kept, by its length."""
    return keyframes("clip_reldiff", _shots(t), _samples(t), step=1)


@query(f"""WITH {_S.format(step=1)}, r AS (SELECT video_id, shot_index, rn, f AS lf, y AS ly, [f] AS fs FROM s WHERE rn = 1 UNION ALL SELECT video_id, shot_index, rn, CASE WHEN ok OR fin THEN f ELSE lf END, CASE WHEN ok OR fin THEN y ELSE ly END, CASE WHEN ok OR fin THEN list_append(fs, f) ELSE fs END
    FROM (SELECT r.lf, r.ly, r.fs, s.*, abs(s.y - r.ly) > 0.3::DOUBLE AND s.f - r.lf >= greatest(1, floor(0.4::DOUBLE * s.rate)) AND len(r.fs) < 4 AS ok, s.rn = s.n AND len(r.fs) < 4 AND abs(s.y - r.ly) > 0.15::DOUBLE AS fin FROM r {_NEXT}) s) SELECT video_id, shot_index, unnest(fs) AS frame_idx FROM (SELECT * FROM r {_ENDS}) {_REST}""", recursive=True)
def action_keyframes(t: Tables) -> DataFrame:
    """The strategy that takes samples unlike the last one kept, and the shot's end for half as much."""
    return keyframes("action", _shots(t), _samples(t), apart=_apart, fields=["y"], most=4)
