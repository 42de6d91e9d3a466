"""Streams over the events table, run to their end."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filmstrip.catalog.base import Tables, query
from filmstrip.functions.models import captions, embed_images
from filmstrip.plans.rounds import refill
from filmstrip.session import table
from filmstrip.streaming import windows


def _events(t: Tables) -> DataFrame:
    schema = table(t.spark, t.sf, "events").schema
    return windows.read_files(t.spark, f"{t.sf}/events.parquet*", schema)


@query("""SELECT epoch_us(ts) // 3600000000 * 3600 AS hour_start, event_type, count(*) AS n FROM events GROUP BY 1, 2""")
def streamed_rates(t: Tables) -> DataFrame:
    """Events per hour and type, from a stream of the table's files."""
    out = windows.to_files(windows.rates(_events(t), "ts", "event_type", width="1 hour"), "streamed_rates")
    return out.select((F.unix_seconds("start")).alias("hour_start"), "event_type", "n")


@query("""SELECT user_id, count(*) AS sessions, sum(n) AS events, max(n) AS longest FROM (SELECT user_id, visit, count(*) AS n FROM (SELECT user_id, sum(x) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS visit FROM (SELECT user_id, ts, (ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) >= INTERVAL 1 DAY)::INT AS x0, coalesce(x0, 0) AS x FROM events)) GROUP BY 1, 2) GROUP BY 1""")
def streamed_sessions(t: Tables) -> DataFrame:
    """Sessions of each user, from a stream of the table's files."""
    out = windows.to_files(windows.sessions(_events(t), "ts", "user_id", gap="1 day"), "streamed_sessions")
    return out.groupBy("user_id").agg(F.count(F.lit(1)).alias("sessions"), F.sum("n").alias("events"), F.max("n").alias("longest"))


@query("""SELECT id, '1 pictures, brightness ' || CASE WHEN octet_length(image) = 0 THEN 0 ELSE round_even(list_avg(list_transform(range(octet_length(image)), lambda i: instr('0123456789ABCDEF', substr(hex(image), (2 * i + 1)::INT, 1)) * 16 + instr('0123456789ABCDEF', substr(hex(image), (2 * i + 2)::INT, 1)) - 17)), 0)::INT END AS caption FROM (SELECT DISTINCT id, image FROM keyframes)""")
def mock_captions(t: Tables) -> DataFrame:
    """Every keyframe's caption by the stand-in model."""
    rows = t.raw("keyframes").select("id", "image").groupBy("id", "image").agg(F.lit(1).alias("one"))
    return captions(rows, "id", "image")


@query("""SELECT caption_id, CASE WHEN caption IS NULL OR trim(caption) = '' THEN 'round ' || (caption_id % 5 + 1) ELSE caption END AS caption FROM ca""")
def refilled_captions(t: Tables) -> DataFrame:
    """Captions, the blank ones made again in rounds by a stand-in that serves another part of them in each."""
    rows = t.ca.select("caption_id", F.when(F.trim("caption") != "", F.col("caption")).alias("caption"))
    said = lambda bad, n: bad.select("caption_id", F.when(F.col("caption_id") % 5 == n - 1, F.lit(f"round {n}")).alias("caption"))
    return refill(rows, ["caption_id"], "caption", lambda c: F.coalesce(F.trim(c) == "", F.lit(True)), said)[0]


@query("""SELECT id, octet_length(image) AS bytes, image IS NOT NULL AND octet_length(image) > 0 AS embedded FROM (SELECT id, any_value(image) AS image FROM keyframes GROUP BY id)""")
def picture_vectors(t: Tables) -> DataFrame:
    """Every keyframe's vector by the stand-in model: which pictures have one. Its values are tested on a few pictures."""
    rows = t.raw("keyframes").dropDuplicates(["id"]).select("id", "image")
    vectors = embed_images(rows.where("octet_length(image) > 0"), "id", "image")
    return rows.join(vectors, "id", "left").select("id", F.octet_length("image").cast("long").alias("bytes"), F.coalesce(F.size("vector") == 16, F.lit(False)).alias("embedded"))
