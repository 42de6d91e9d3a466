"""Order-constrained alignment of the phases of a query to a timeline, and what is done with its result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filmstrip.operators.joins import bins
from filmstrip.plans.ordered import chunked, scan
from filmstrip.plans.skew import join_small


def align(df: DataFrame, key: list[str], pos: str, sims: str, phases: int, min_gap: int = 1, penalty: float = 0.0) -> DataFrame:
    """key, path, score: positions, one per phase and each at least min_gap after the last, with the greatest sum of
    sims[phase] less penalty times the way from position to position. Ties go to the lower positions.

    sims is an array per candidate; positions are distinct within a key. One window of a range frame per phase after the
    first, all over one partitioning and sort. Keys in which no path fits have no row; so have nulls in key or pos.
    """
    at = F.col(pos).cast("long")
    rows = df.dropna(subset=[*key, pos]).select(*key, at.alias("__at"), F.col(sims).cast("array<double>").alias("__s"))
    rows = rows.withColumn("__v", F.get("__s", F.lit(0))).withColumn("__p", F.array("__at"))
    for i in range(1, phases):
        w = Window.partitionBy(*key).orderBy("__at").rangeBetween(Window.unboundedPreceding, -min_gap)
        best = F.max(F.struct((F.col("__v") + penalty * F.col("__at")).alias("v"), (-F.col("__at")).alias("n"), F.col("__p").alias("p"))).over(w)
        rows = rows.withColumn("__b", best).where("__b is not null")
        rows = rows.withColumn("__v", F.get("__s", F.lit(i)) - penalty * F.col("__at") + F.col("__b.v")).withColumn("__p", F.concat("__b.p", F.array("__at"))).drop("__b")
    top = F.max(F.struct(F.col("__v").alias("v"), (-F.col("__at")).alias("n"), F.col("__p").alias("p"))).alias("__t")
    return rows.where("__v is not null").groupBy(*key).agg(top).select(*key, F.col("__t.p").alias("path"), F.col("__t.v").alias("score"))


def snap_to_apex(centres: DataFrame, flow: DataFrame, key: str, centre: str, frame: str, mag: str, radius: int) -> DataFrame:
    """centres with apex: the frame of the greatest magnitude within radius (the first of several), or the centre itself.
    Joined by key and bin of twice the radius, so a centre meets only the flow of two bins or three."""
    width = 2 * radius + 1
    f = flow.select(F.col(key).alias("__k"), F.col(frame).alias("__f"), F.col(mag).alias("__m"), F.floor(F.col(frame) / width).alias("__fbin")).dropna()
    lo, hi = F.col(centre) - radius, F.col(centre) + radius
    c = centres.withColumn("__row", F.monotonically_increasing_id()).withColumn("__bin", F.explode_outer(bins(lo, hi, width)))
    near = c.join(f, (F.col(key) == F.col("__k")) & (F.col("__bin") == F.col("__fbin")) & F.col("__f").between(lo, hi), "left")
    best = F.max(F.when(F.col("__m").isNotNull(), F.struct("__m", (-F.col("__f")).alias("n"))))
    return near.groupBy("__row", *centres.columns).agg(best.alias("__b")).select(*centres.columns, F.coalesce(-F.col("__b.n"), F.col(centre)).alias("apex"))


def spread(frame: Column, phases: int, budget: int = 100, stride: int = 8, half_span: int = 12, low: Column | None = None, high: Column | None = None) -> Column:
    """Sorted answer frames around a frame: as many offsets 0, +stride, -stride, ... within half_span as the budget allows
    each of the phases, within [low, high]; if none is, the frame clamped to it."""
    k = max(1, int(budget ** (1 / phases)))
    offsets = [0]
    step = stride
    while len(offsets) < k and step <= half_span:
        offsets += [step, -step]
        step += stride
    frames = F.array_sort(F.array_distinct(F.array(*[frame + o for o in offsets[:k]])))
    lo, hi = low if low is not None else F.lit(0), high if high is not None else F.lit((1 << 62))
    inside = F.filter(frames, lambda f: (f >= lo) & (f <= hi))
    return F.when(F.size(inside) > 0, inside).otherwise(F.array(F.least(F.greatest(frame, lo), hi)))


def _ranked(df: DataFrame, key: list[str], channel: str, cand: str, sim: str, best: bool) -> DataFrame:
    """The rows with a similarity and __rank, from 0 for the lowest (or, with best, the highest) of its key and channel,
    ties by cand. A key's rows are ranked over chunks, so it may have any number of them."""
    known = df.where(F.col(sim).isNotNull()).withColumn("__by", -F.col(sim) if best else F.col(sim))
    group, order = [*key, channel], ["__by", cand]
    return scan(chunked(known, group, order), group, order, sums={"__n": F.lit(1)}).withColumn("__rank", F.col("__n") - 1)


def weighted_fusion(df: DataFrame, key: list[str], channel: str, cand: str, sim: str, weight: str) -> DataFrame:
    """key, cand, fused: the weighted mean of the channels' rank shares, from 0 for the lowest to 1 for the highest (a
    sole row has 0); channels without a similarity are left out."""
    ranked = _ranked(df, key, channel, cand, sim, best=False)
    sizes = ranked.groupBy(*key, channel).agg(F.count(F.lit(1)).alias("__all"))
    share = F.col("__rank") / F.greatest(F.lit(1), F.col("__all") - 1)
    rows = join_small(ranked, sizes, [*key, channel]).withColumn("__r", share)
    return rows.groupBy(*key, cand).agg((F.sum(F.col("__r") * F.col(weight)) / F.sum(weight)).alias("fused"))


def reciprocal_fusion(df: DataFrame, key: list[str], channel: str, cand: str, sim: str, weight: str, k: int = 60) -> DataFrame:
    """key, cand, fused: the sum over channels of weight / (k + rank), ranks from 0 for the best."""
    rows = _ranked(df, key, channel, cand, sim, best=True)
    return rows.groupBy(*key, cand).agg(F.sum(F.col(weight) / (k + F.col("__rank"))).alias("fused"))
