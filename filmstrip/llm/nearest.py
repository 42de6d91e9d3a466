"""Pairs of records of the same entity that are nearest in time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filmstrip.plans.ordered import chunked, scan


def nearest_pairs(left: DataFrame, right: DataFrame, left_key: str, left_at: str, left_id: str, right_key: str, right_at: str, right_id: str, within: int) -> DataFrame:
    """left_id, right_id, distance for each left row with a right row of its key at most `within` away in time.

    Of two equally near the earlier one is taken, of several at one time the one with the least id. Rows with a null in
    a column named here take no part; a left row that occurs twice gives two rows. Other columns are ignored, so names
    may clash.

    Both tables are laid in one order of (key, time). The last right row before and the next one after are carried onto
    each left row, over the borders of the parts into which the order is split; no key needs to fit one task.
    """
    a = left.select(F.col(left_key).alias("k"), F.col(left_at).cast("long").alias("at"), F.lit(1).alias("side"), F.col(left_id).alias("lid"), F.lit(None).cast(right.schema[right_id].dataType).alias("rid")).dropna(subset=["k", "at", "lid"])
    a = a.groupBy("k", "at", "side", "lid", "rid").agg(F.count(F.lit(1)).alias("n"))  # repeated rows travel once
    b = right.select(F.col(right_key).alias("k"), F.col(right_at).cast("long").alias("at"), F.col(right_id).alias("rid")).dropna()
    b = b.groupBy("k", "at").agg(F.min("rid").alias("rid")).select("k", "at", F.lit(0).alias("side"), F.lit(None).cast(left.schema[left_id].dataType).alias("lid"), "rid", F.lit(1).cast("long").alias("n"))
    point = F.when(F.col("side") == 0, F.struct("at", "rid"))
    order = ["at", "side", "lid"]
    both = scan(chunked(a.unionByName(b), ["k"], order), ["k"], order, last={"prev": point}, following={"next": point}).where("side = 1")
    back, ahead = F.col("at") - F.col("prev.at"), F.col("next.at") - F.col("at")
    best = F.when(ahead.isNull() | (back <= ahead), F.struct(back.alias("d"), F.col("prev.rid").alias("rid"))).otherwise(F.struct(ahead.alias("d"), F.col("next.rid").alias("rid")))
    found = both.withColumn("best", best).where(F.col("best.d") <= within)
    return found.select(F.col("lid").alias("left_id"), F.col("best.rid").alias("right_id"), F.col("best.d").alias("distance"), F.explode(F.sequence(F.lit(1).cast("long"), "n"))).drop("col")
