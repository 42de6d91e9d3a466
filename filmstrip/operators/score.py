"""Scoring of ranked answers, and reports on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Depths at which a ranked list is scored; the final score is the mean over them.
DEPTHS = (1, 5, 20, 50, 100)


def bucket(rank: Column) -> Column:
    return F.when(rank.isNull(), "miss").when(rank == 1, "1").when(rank <= 5, "2-5").when(rank <= 20, "6-20").when(rank <= 50, "21-50").when(rank <= 100, "51-100").otherwise("beyond")


def judged(answers: DataFrame, truth: DataFrame) -> DataFrame:
    """query_id, level, rank, hit for each truth row (query_id, gt_video, level, first, last) and answer (query_id, rank,
    video_id, frame_id) of its query: hit if the video is equal and the frame in range, nulls don't hit. A query without
    answers has one row of rank null and hit 0. Only the first hundred answers count."""
    a = answers.where(F.col("rank") <= max(DEPTHS))
    hit = F.coalesce(((F.col("video_id") == F.col("gt_video")) & F.col("frame_id").between(F.col("first"), F.col("last"))).cast("double"), F.lit(0.0))
    return truth.join(a, "query_id", "left").select("query_id", "level", "rank", hit.alias("hit"))


def final_scores(rows: DataFrame, key: list[str]) -> DataFrame:
    """key, r_at_<depth>, final, first_hit, bucket from rank and hit: the best hit within each depth and their mean."""
    best = [F.coalesce(F.max(F.when(F.col("rank") <= k, F.col("hit"))), F.lit(0.0)).alias(f"r_at_{k}") for k in DEPTHS]
    out = rows.groupBy(*key).agg(*best, F.min(F.when(F.col("hit") > 0, F.col("rank"))).alias("first_hit"))
    mean = sum((F.col(f"r_at_{k}") for k in DEPTHS[1:]), F.col(f"r_at_{DEPTHS[0]}")) / len(DEPTHS)
    return out.withColumn("final", mean).withColumn("bucket", bucket(F.col("first_hit")))


def lint(answers: DataFrame, limit: int = 100) -> DataFrame:
    """query_id, answers, too_many, missing, repeated: how a submission misses the form of up to `limit` distinct answers."""
    first = F.when(F.col("rank") <= limit, F.struct("video_id", "frame_id"))
    out = answers.groupBy("query_id").agg(F.count(F.lit(1)).alias("answers"), (F.count(first) - F.countDistinct(first)).alias("repeated"))
    return out.select("query_id", "answers", F.greatest(F.col("answers") - limit, F.lit(0)).alias("too_many"), F.greatest(limit - F.col("answers"), F.lit(0)).alias("missing"), "repeated")


def covered_share(frames: DataFrame, key: list[str], frame: str, window: int, last: str) -> DataFrame:
    """key and share: of the windows of `window` frames that begin at 0..last, those that hold a frame. Starts covered by
    neighbouring frames overlap; each frame counts the starts that no frame before it covers, so nothing is unrolled."""
    from pyspark.sql import Window

    w = Window.partitionBy(*key).orderBy(frame)
    lo = F.greatest(F.lit(0), F.col(frame) - window + 1, F.coalesce(F.lag(frame).over(w) + 1, F.lit(0)))
    hi = F.least(F.col(frame), F.col(last))
    rows = frames.select(*key, frame, last).distinct().withColumn("__n", F.greatest(F.lit(0), hi - lo + 1))
    return rows.groupBy(*key).agg((F.sum("__n") / (F.max(last) + 1)).alias("share"))


def upper_median(x: Column) -> Column:
    """The upper of two middle values."""
    values = F.array_sort(F.collect_list(x))
    return F.element_at(values, (F.floor(F.size(values) / 2) + 1).cast("int"))


def mean_array(df: DataFrame, key: list[str], array: str, out: str) -> DataFrame:
    """Element-wise means of a group's arrays; elements are averaged before the shuffle."""
    each = df.select(*key, F.posexplode(array).alias("i", "x")).groupBy(*key, "i").agg(F.avg("x").alias("m"))
    return each.groupBy(*key).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias(out))
