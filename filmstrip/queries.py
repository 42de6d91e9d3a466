"""The p queries of the general problems; the reference operators' queries are in filmstrip.catalog."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filmstrip import catalog
from filmstrip.operators.copies import first_copies
from filmstrip.operators.intervals import sweep
from filmstrip.operators.orphans import REF, Orphans, references, replay, targets
from filmstrip.session import cut, table


def event_periods(spark: SparkSession, sf: str) -> DataFrame:
    events = first_copies(table(spark, sf, "video_events"), ["id", "video_id", "shot_index", "start_frame", "end_frame"])
    return sweep(events, ["video_id", "shot_index"], "start_frame", "end_frame")


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    rows = event_periods(spark, sf).where("kind = 'gap' or depth >= 2")
    kind = F.when(F.col("kind") == "gap", "gap").otherwise("merged").alias("kind")
    return rows.select(kind, "video_id", "shot_index", F.col("start").alias("start_frame"), F.col("end").alias("end_frame"))


def p4_periods(spark: SparkSession, sf: str) -> DataFrame:
    """All continuous periods and gaps of every shot, with the most events that cover one frame."""
    return event_periods(spark, sf).select("kind", "video_id", "shot_index", F.col("start").alias("start_frame"), F.col("end").alias("end_frame"), "depth")


def event_orphans(spark: SparkSession, sf: str) -> Orphans:
    events = first_copies(table(spark, sf, "video_events"), ["id", "video_id", "shot_index"])
    captions = first_copies(table(spark, sf, "captions"), ["caption_id", "video_id", "shot_index"])
    videos = first_copies(table(spark, sf, "videos"), ["video_id", "deleted_at"])
    shots = first_copies(table(spark, sf, "shots"), ["id", "video_id", "shot_index", "deleted_at"])
    shot_key = ["video_id", "shot_index"]
    refs = [references(events, "video_events", "id", "video_id", ["video_id"]), references(events, "video_events", "id", "shot_index", shot_key), references(captions, "captions", "caption_id", "shot_index", shot_key)]
    refs = cut(reduce(DataFrame.unionByName, refs))
    parents = cut(targets(videos, ["video_id"], "video_id").unionByName(targets(shots, shot_key, "id")))
    quarters = refs.select(F.date_trunc("quarter", "ref_at").alias("q")).distinct().orderBy("q").collect()  # as many as quarters
    return replay(refs, parents, [r.q for r in quarters[1:]])


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return event_orphans(spark, sf).waiting.select(*REF)


def p5_report(spark: SparkSession, sf: str) -> DataFrame:
    """Orphans per table, field and month of the referring row, as they stood at the end of each quarter and (as_of
    null) stand at the end of the tables."""
    return event_orphans(spark, sf).report(spark)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = catalog.QUERIES | {"p4_found": p4_found, "p4_periods": p4_periods, "p5_found": p5_found, "p5_report": p5_report}

_EVENTS = "(SELECT id, video_id, shot_index, start_frame, end_frame FROM video_events GROUP BY ALL)"
_PERIODS = f"""e AS (SELECT * FROM {_EVENTS} WHERE video_id IS NOT NULL AND shot_index IS NOT NULL AND start_frame IS NOT NULL AND end_frame >= start_frame),
    b AS (SELECT *, max(end_frame) OVER (PARTITION BY video_id, shot_index ORDER BY start_frame, end_frame, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM e),
    g AS (SELECT *, sum((reach IS NULL OR start_frame > reach + 1)::INT) OVER (PARTITION BY video_id, shot_index ORDER BY start_frame, end_frame, id ROWS UNBOUNDED PRECEDING) AS period FROM b),
    p AS (SELECT video_id, shot_index, period, min(start_frame) AS s, max(end_frame) AS t, bool_or(reach >= start_frame) AS shared FROM g GROUP BY 1, 2, 3)"""
_TARGETS = """e AS (SELECT id, video_id, shot_index, min(written_at) AS w FROM video_events GROUP BY ALL), c AS (SELECT caption_id, video_id, shot_index, min(written_at) AS w FROM captions GROUP BY ALL),
    v AS (SELECT video_id, deleted_at, min(written_at) AS w FROM videos GROUP BY ALL), s AS (SELECT id, video_id, shot_index, deleted_at, min(written_at) AS w FROM shots GROUP BY ALL),
    q AS (SELECT DISTINCT date_trunc('quarter', w) AS b FROM (SELECT w FROM e WHERE video_id IS NOT NULL UNION ALL SELECT w FROM c WHERE video_id IS NOT NULL AND shot_index IS NOT NULL)),
    g AS (SELECT b FROM q WHERE b > (SELECT min(b) FROM q) UNION ALL SELECT NULL)"""


def _orphans(at: str) -> str:
    """SQL of the orphans known at each time of `at` (all of them where it is null)."""
    times = f"(SELECT {at} AS b)" if at == "NULL::TIMESTAMP" else at

    def of(child: str, field: str, table: str, row_id: str, target: str, test: str, keys: str) -> str:
        return f"""SELECT g.b AS as_of, '{table}' AS child_table, {row_id} AS child_id, '{field}' AS ref_field, {child}.w FROM {child}, {times} AS g WHERE {keys} AND (g.b IS NULL OR {child}.w < g.b) AND NOT EXISTS
    (SELECT 1 FROM {target} t WHERE {test} AND (g.b IS NULL OR t.w < g.b) AND t.w <= {child}.w + INTERVAL 48 HOUR AND (t.deleted_at IS NULL OR t.deleted_at > {child}.w))"""

    shot = "t.video_id = {0}.video_id AND t.shot_index = {0}.shot_index"
    both = "{0}.video_id IS NOT NULL AND {0}.shot_index IS NOT NULL"
    parts = [of("e", "video_id", "video_events", "id", "v", "t.video_id = e.video_id", "e.video_id IS NOT NULL")]
    parts += [of(k, "shot_index", table, row_id, "s", shot.format(k), both.format(k)) for k, table, row_id in (("e", "video_events", "id"), ("c", "captions", "caption_id"))]
    return " UNION ALL ".join(parts)


SQL: dict[str, str] = catalog.SQL | {
    "p4_found": f"""WITH {_PERIODS} SELECT 'merged' AS kind, video_id, shot_index, s AS start_frame, t AS end_frame FROM p WHERE shared
    UNION ALL SELECT 'gap', video_id, shot_index, t + 1, n - 1 FROM (SELECT *, lead(s) OVER (PARTITION BY video_id, shot_index ORDER BY s) AS n FROM p) WHERE n IS NOT NULL""",
    "p4_periods": f"""WITH e AS (SELECT * FROM {_EVENTS} WHERE video_id IS NOT NULL AND shot_index IS NOT NULL AND start_frame IS NOT NULL AND end_frame >= start_frame),
    d AS (SELECT video_id, shot_index, pos, sum(d) AS d FROM (SELECT video_id, shot_index, start_frame AS pos, 1 AS d FROM e UNION ALL SELECT video_id, shot_index, end_frame + 1, -1 FROM e) GROUP BY 1, 2, 3 HAVING sum(d) <> 0),
    n AS (SELECT *, sum(d) OVER w AS n FROM d WINDOW w AS (PARTITION BY video_id, shot_index ORDER BY pos)), k AS (SELECT *, sum((n = d AND d > 0)::INT) OVER (PARTITION BY video_id, shot_index ORDER BY pos) AS period, lead(pos) OVER (PARTITION BY video_id, shot_index ORDER BY pos) AS nx FROM n)
    SELECT 'period' AS kind, video_id, shot_index, min(pos) AS start_frame, max(pos) - 1 AS end_frame, max(n) AS depth FROM k GROUP BY video_id, shot_index, period UNION ALL SELECT 'gap', video_id, shot_index, pos, nx - 1, 0 FROM k WHERE n = 0 AND nx IS NOT NULL""",
    "p5_found": f"WITH {_TARGETS} SELECT child_table, child_id, ref_field FROM ({_orphans('NULL::TIMESTAMP')})",
    "p5_report": f"WITH {_TARGETS} SELECT as_of, child_table, ref_field, date_trunc('month', w) AS month, count(*) AS orphans FROM ({_orphans('g')}) GROUP BY ALL",
}
