"""Curves over the ordered samples of a shot: smoothing, turns, predictability, floors, maxima, steepness."""

from __future__ import annotations

from math import exp

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from filmstrip.plans.ordered import chunked, scan


def gaussian(sigma: float) -> list[float]:
    """Weights of a normalised bell curve, of radius three sigma (1 at least)."""
    r = max(1, round(3 * sigma))
    w = [exp(-(k * k) / (2 * sigma * sigma)) for k in range(-r, r + 1)]
    return [x / sum(w) for x in w]


def smooth(y: Column, by: WindowSpec, whole: WindowSpec, sigma: float = 1.0) -> Column:
    """y under a bell curve whose ends repeat the first and last value; y itself for fewer than three samples."""
    if sigma <= 0:
        return y
    weights = gaussian(sigma)
    r = len(weights) // 2
    first, last = F.first(y).over(whole), F.last(y).over(whole)
    parts = []
    for k, w in zip(range(-r, r + 1), weights):
        v = F.coalesce(F.lag(y, -k).over(by), first) if k < 0 else F.coalesce(F.lead(y, k).over(by), last) if k else y
        parts.append(v * w)
    return F.when(F.count(F.lit(1)).over(whole) < 3, y).otherwise(sum(parts[1:], parts[0]))


def over(key: list[str], at: str) -> tuple[WindowSpec, WindowSpec]:
    """The window of a key in order, and its whole."""
    by = Window.partitionBy(*key).orderBy(at)
    return by, by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def min_max(y: Column, whole: WindowSpec) -> Column:
    lo, hi = F.min(y).over(whole), F.max(y).over(whole)
    return F.when(hi > lo, (y - lo) / (hi - lo)).otherwise(0.0)


def floor_normalised(y: Column, whole: WindowSpec, floor: float) -> Column:
    """From 0 to 1 over the range of y or, if that is less, over `floor`, so that flat data stay flat."""
    lo, hi = F.min(y).over(whole), F.max(y).over(whole)
    return F.least(F.greatest((y - lo) / F.greatest(hi - lo, F.lit(floor)), F.lit(0.0)), F.lit(1.0))


def is_peak(y: Column, by: WindowSpec, threshold: float) -> Column:
    """At least the threshold, above the sample before and not below the one after; ends are no peaks."""
    return F.coalesce((y >= threshold) & (y > F.lag(y).over(by)) & (y >= F.lead(y).over(by)), F.lit(False))


def predictability(features: list[Column], by: WindowSpec, whole: WindowSpec, w: int) -> Column:
    """Squared distance, a dimension, between the means of the w samples before and the w from here on."""
    ahead, behind = by.rowsBetween(0, w - 1), by.rowsBetween(-w, -1)
    parts = [F.pow(F.avg(f).over(behind) - F.avg(f).over(ahead), 2) for f in features]
    return F.when(F.count(F.lit(1)).over(whole) < 3, 0.0).otherwise(F.coalesce(sum(parts[1:], parts[0]) / len(features), F.lit(0.0)))


def turning(dx: Column, dy: Column, mag: Column, real: Column, by: WindowSpec, w: int) -> Column:
    """Change of the mean magnitude plus change of direction (0 to 2) times the lesser magnitude, between the w steps
    before and the w from here on; steps that aren't real (padding) don't count, nor do directions of almost no motion."""
    ahead, behind = by.rowsBetween(0, w - 1), by.rowsBetween(-w, -1)

    def mean(c: Column, at: WindowSpec) -> Column:
        return F.avg(F.when(real, c)).over(at)

    ax, ay, am, bx, by_, bm = (mean(c, at) for at in (behind, ahead) for c in (dx, dy, mag))
    na, nb = F.sqrt(ax * ax + ay * ay), F.sqrt(bx * bx + by_ * by_)
    turn = F.when((na >= 1e-6) & (nb >= 1e-6), 1 - (ax * bx + ay * by_) / (na * nb)).otherwise(0.0)
    return F.when(real, F.coalesce(F.abs(bm - am) + turn * F.least(am, bm), F.lit(0.0))).otherwise(0.0)


def steepness(size: Column, by: WindowSpec, whole: WindowSpec, absolute: bool = False) -> Column:
    """Mean over the next three samples of how steeply sizes rise (or fall, which is negative): the share of the greatest
    size, in hundredths, over the length of the step. With absolute, rises and falls count alike. Null for the last."""
    top = F.greatest(F.max(size).over(whole), F.lit(1e-12))
    steps = []
    for k in (1, 2, 3):
        a = (F.lead(size, k).over(by) - size) * 100.0 / top
        steps.append(a / F.sqrt(k * k + a * a + 1e-12))
    known = [F.when(s.isNotNull(), 1).otherwise(0) for s in steps]
    mean = sum((F.coalesce(s, F.lit(0.0)) for s in steps[1:]), F.coalesce(steps[0], F.lit(0.0))) / F.nullif(known[0] + known[1] + known[2], F.lit(0))
    return F.abs(mean) if absolute else mean


def steepest(df: DataFrame, key: list[str], at: str, size: str, ratio: float, window: int | Column, absolute: bool = False) -> DataFrame:
    """df's key and at with pick ('steep' or 'cover'): the steepest share of a group's samples (one at least), and for
    each tumbling window of `window` samples without one, its steepest. Ties go to the earlier sample. The last sample
    has no steepness and is never picked, but a group of one or two gives its first."""
    by, whole = over(key, at)
    rows = df.select(*key, at, size, (window if isinstance(window, Column) else F.lit(window)).alias("w"))
    rows = rows.withColumn("i", F.row_number().over(by) - 1).withColumn("m", F.count(F.lit(1)).over(whole)).withColumn("s", steepness(F.col(size), by, whole, absolute))
    most = F.greatest(F.lit(1), F.floor(F.lit(ratio) * (F.col("m") - 1)))
    best = [F.desc_nulls_last("s"), "i"]
    rows = rows.withColumn("r", F.row_number().over(Window.partitionBy(*key).orderBy(*best))).withColumn("steep", F.when(F.col("m") > 2, (F.col("r") <= most) & F.col("s").isNotNull()).otherwise(F.col("i") == 0))
    rows = rows.withColumn("win", F.floor(F.col("i") / F.col("w")))
    each = Window.partitionBy(*key, "win")
    rows = rows.withColumn("has", F.max(F.col("steep").cast("int")).over(each)).withColumn("wr", F.row_number().over(each.orderBy(*best)))
    cover = (F.col("has") == 0) & (F.col("wr") == 1) & (F.col("m") > 2) & F.col("s").isNotNull()
    return rows.where(F.col("steep") | cover).select(*key, at, F.when(F.col("steep"), "steep").otherwise("cover").alias("pick"))


def request_rates(df: DataFrame, key: str, at: str, row_id: str, width: int = 60) -> DataFrame:
    """row_id, last_minute (rows of the key in the `width` seconds up to each row, its own second included) and spacing
    (seconds since the row before; 0 for the first). Rows with nulls take no part.

    A key may hold most rows: counts are made within (key, span of `width` seconds), for which each row is also laid into
    the span after its own, and neighbours are carried over chunks.
    """
    rows = df.select(key, at, row_id).dropna()
    spans = rows.select(key, at, row_id, F.explode(F.array(F.struct(F.lit(True).alias("own"), F.floor(F.col(at) / width).alias("n")), F.struct(F.lit(False).alias("own"), (F.floor(F.col(at) / width) + 1).alias("n")))).alias("x"))
    by = Window.partitionBy(key, "x.n").orderBy(at).rangeBetween(-width, 0)
    counts = spans.withColumn("last_minute", F.count(F.lit(1)).over(by)).where("x.own").select(row_id, "last_minute")
    near = scan(chunked(rows, [key], [at, row_id]), [key], [at, row_id], prior={"__before": F.col(at)})
    return counts.join(near.select(row_id, F.coalesce(F.col(at) - F.col("__before"), F.lit(0)).alias("spacing")), row_id)


def islands(df: DataFrame, key: list[str], at: str, gap: float, out: str) -> DataFrame:
    """df with the number of its session within the key, from 0: a new one begins when more than gap passes. Times that
    tie are in one session."""
    by = Window.partitionBy(*key).orderBy(at)
    apart = F.coalesce((F.col(at) - F.lag(at).over(by) > gap).cast("int"), F.lit(0))
    return df.withColumn("__new", apart).withColumn(out, F.sum("__new").over(by.rangeBetween(Window.unboundedPreceding, 0))).drop("__new")


def segments(df: DataFrame, key: list[str], cut: str, start: str, end: str) -> DataFrame:
    """key, ord, start, end, anchor for cuts (first frames of segments after the first) within start..end: segments tile
    the shot; the first is anchored in its middle and the others at their beginnings."""
    whole = df.groupBy(*key).agg(F.min(start).alias("__s"), F.max(end).alias("__e"), F.array_sort(F.collect_set(F.when((F.col(cut) > F.col(start)) & (F.col(cut) <= F.col(end)), F.col(cut)))).alias("__c"))
    marks = F.concat(F.array("__s"), F.col("__c"))
    rows = whole.select(*key, "__e", F.posexplode(F.arrays_zip(marks.alias("a"), F.transform(F.col("__c"), lambda c: c - 1).alias("b"))).alias("ord", "x"))
    e = F.coalesce(F.col("x.b"), F.col("__e"))
    return rows.select(*key, "ord", F.col("x.a").alias("start"), e.alias("end"), F.when(F.col("ord") == 0, F.floor((F.col("x.a") + e) / 2)).otherwise(F.col("x.a")).alias("anchor"))
