"""Continuous periods of overlapping intervals and the gaps between them, by a sweep over their boundaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filmstrip.plans.ordered import chunked, scan


def sweep(df: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """One row per period or gap of each entity: keys, kind ('period' or 'gap'), start, end (inclusive), depth.

    Each interval adds 1 at its start and takes 1 away after its end; equal boundaries are summed before they are
    shuffled. The running sum over an entity's boundaries is the number of intervals that cover what follows. A period
    reaches from a sum above 0 to the next 0, so intervals that share points or follow each other without a missing
    point are one period; a gap is what lies between. depth is the most intervals that cover one point (0 in a gap).

    Rows with a null in a key, start or end, and rows that end before they start, take no part; an entity without any
    other row has no result. Repeated rows count as often as they occur. Other columns are ignored.
    """
    names = [f"__k{i}" for i in range(len(keys))]
    rows = df.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col(start).cast("long").alias("__a"), F.col(end).cast("long").alias("__b"))
    rows = rows.dropna().where("__b >= __a")
    bounds = rows.select(*names, F.explode(F.array(F.struct(F.col("__a").alias("at"), F.lit(1).alias("d")), F.struct((F.col("__b") + 1).alias("at"), F.lit(-1).alias("d")))).alias("x"))
    deltas = bounds.groupBy(*names, F.col("x.at").alias("__at")).agg(F.sum("x.d").alias("__d")).where("__d <> 0")
    opens, closes = (F.col("__n") == F.col("__d")) & (F.col("__d") > 0), F.col("__n") == 0
    # boundaries at which nothing changes are gone, so the one after a close opens the next period
    spans = scan(chunked(deltas, names, ["__at"]), names, ["__at"], sums={"__n": F.col("__d")}, last={"__from": F.when(opens, F.col("__at"))}, after={"__to": F.col("__at")})
    out_keys = [F.col(n).alias(k) for k, n in zip(keys, names)]

    def row(kind: str, a: Column, b: Column, depth: Column) -> list[Column]:
        return [*out_keys, F.lit(kind).alias("kind"), a.alias("start"), b.alias("end"), depth.cast("long").alias("depth")]

    periods = spans.groupBy(*names, "__from").agg(F.max("__at").alias("__last"), F.max("__n").alias("__depth"))
    gaps = spans.where(closes & F.col("__to").isNotNull())
    return periods.select(*row("period", F.col("__from"), F.col("__last") - 1, F.col("__depth"))).unionByName(
        gaps.select(*row("gap", F.col("__at"), F.col("__to") - 1, F.lit(0)))
    )
