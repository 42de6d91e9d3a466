"""The register of queries, and the test tables without their copies."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from filmstrip.operators.copies import first_copies
from filmstrip.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

COLUMNS = {
    "ev": ("video_events", "id video_id scene_id shot_index event_ord ord_in_shot start_frame end_frame anchor_frame fps boundary_score motion mag_mean action caption_level"),
    "sh": ("shots", "id video_id shot_id shot_index start_frame end_frame fps n_keyframes motion_hint scene_id deleted_at"),
    "kf": ("keyframe_meta", "video_id keyframe_id shot_id frame_idx fps pts_time keyframe_path"),
    "ky": ("keyframes", "id keyframe_id video_id shot_index n frame_index time_sec fps path"),
    "ca": ("captions", "caption_id video_id shot_index caption model"),
    "vi": ("videos", "video_id collection title fps n_frames width height pick_size deleted_at"),
}


class Tables:
    """t.ev, t.sh, ...: a table of COLUMNS with its copies as one row; t.raw(name) a whole table."""

    def __init__(self, spark: SparkSession, sf: str) -> None:
        self.spark, self.sf = spark, sf

    def raw(self, name: str) -> DataFrame:
        rows = table(self.spark, self.sf, name)
        return rows.withColumns({c: rows[c].cast("timestamp") for c, kind in rows.dtypes if kind == "timestamp_ntz"})

    def __getattr__(self, name: str) -> DataFrame:
        if name not in COLUMNS:
            raise AttributeError(name)
        source, columns = COLUMNS[name]
        return first_copies(self.raw(source), columns.split())


def query(sql: str | None = None, recursive: bool = False) -> Callable:
    """Registers a function of Tables under its name; ev, sh, ... in its SQL stand for the tables without copies."""

    def register(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[f.__name__] = lambda spark, sf: f(Tables(spark, sf))
        if sql:
            used = [k for k in COLUMNS if f" {k} " in f" {sql} ".replace("\n", " ").replace("(", " ").replace(")", " ").replace(",", " ")]
            tables = [f"{k} AS (SELECT {', '.join(COLUMNS[k][1].split())}, min(written_at) AS written_at FROM {COLUMNS[k][0]} GROUP BY ALL)" for k in used]
            body = sql.strip()
            if tables:
                head = "WITH RECURSIVE " if recursive else "WITH "
                body = head + ", ".join(tables) + (", " + body[5:] if body[:5].upper() == "WITH " else " " + body)
            elif recursive:
                body = "WITH RECURSIVE " + body[5:]
            SQL[f.__name__] = body
        return f

    return register
