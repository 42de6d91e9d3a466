"""Greedy passes that compare with what was kept, as folds over a group's ordered array.

Each group is one bounded sequence (a shot or a video's candidates); `collected` builds the array, and the fold runs
inside the JVM. lag() would compare with the row before, which is another result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def collected(df: DataFrame, key: list[str], order: list[str], fields: list[str]) -> DataFrame:
    """key and `items`: the group's rows as an array of structs in order; rows with a null in order are left out."""
    rest = [f for f in fields if f not in order]
    return df.dropna(subset=order).groupBy(*key).agg(F.array_sort(F.collect_list(F.struct(*order, *rest))).alias("items"))


def _keep(items: Column, kind: str, differs: Callable[[Column, Column], Column]) -> Column:
    """Items for which differs(kept so far, item); the first always is."""
    start = F.array().cast(f"array<{kind}>")
    return F.aggregate(items, start, lambda kept, x: F.when((F.size(kept) == 0) | differs(kept, x), F.concat(kept, F.array(x))).otherwise(kept))


def kind_of(df: DataFrame, column: str = "items") -> str:
    return df.schema[column].dataType.elementType.simpleString()


def distinct_from_all(df: DataFrame, apart: Callable[[Column, Column], Column], threshold: float) -> DataFrame:
    """df with kept: the items farther than threshold from every item kept before."""
    return df.withColumn("kept", _keep(F.col("items"), kind_of(df), lambda kept, x: F.forall(kept, lambda y: apart(y, x) > threshold)))


def changed_from_last(df: DataFrame, apart: Callable[[Column, Column], Column], threshold: float, gap: Callable[[Column, Column], Column] | None = None, min_gap: float | Column = 0, most: int | None = None, end_share: float | None = None) -> DataFrame:
    """df with kept: the items farther than threshold from the last one kept and, with gap, at least min_gap after it;
    `most` items at most, if given. With end_share, the last item is kept too, if there is room and it is farther than
    that share of the threshold from the last one kept, however near in time."""

    def differs(kept: Column, x: Column) -> Column:
        last = F.try_element_at(kept, F.lit(-1))
        test = apart(last, x) > threshold
        if gap is not None:
            test &= gap(last, x) >= min_gap
        return test if most is None else test & (F.size(kept) < most)

    out = df.withColumn("kept", _keep(F.col("items"), kind_of(df), differs))
    if end_share is None:
        return out
    last, end = F.try_element_at("kept", F.lit(-1)), F.try_element_at("items", F.lit(-1))
    adds = (last != end) & (apart(last, end) > threshold * end_share)
    if most is not None:
        adds &= F.size("kept") < most
    return out.withColumn("kept", F.when(adds, F.concat("kept", F.array(end))).otherwise(F.col("kept")))


def clusters(df: DataFrame, apart: Callable[[Column, Column], Column], threshold: float) -> DataFrame:
    """df with labels: for each item the number of its cluster from 0; a new one begins when an item is farther than
    threshold from the current cluster's first item."""
    item = kind_of(df)
    zero = F.struct(F.get(F.col("items"), F.lit(0)).alias("rep"), F.lit(0).alias("n"), F.array().cast("array<int>").alias("labels"))

    def step(s: Column, x: Column) -> Column:
        new = apart(s["rep"], x) > threshold
        n = s["n"] + F.when(new, 1).otherwise(0)
        return F.struct(F.when(new, x).otherwise(s["rep"]).cast(item).alias("rep"), n.cast("int").alias("n"), F.concat(s["labels"], F.array(n.cast("int"))).alias("labels"))

    return df.withColumn("labels", F.aggregate("items", zero, step, lambda s: s["labels"]))


def capped_groups(df: DataFrame, apart: Callable[[Column, Column], Column], threshold: float, span: Callable[[Column, Column], Column], most: float) -> DataFrame:
    """df with labels: an item joins the group of the item before it if they are nearer than threshold and the group's
    first item and it span no more than `most`; else it begins the next group."""
    item = kind_of(df)
    zero = F.struct(F.get(F.col("items"), F.lit(0)).alias("first"), F.get(F.col("items"), F.lit(0)).alias("last"), F.lit(-1).alias("n"), F.array().cast("array<int>").alias("labels"))

    def step(s: Column, x: Column) -> Column:
        joins = (s["n"] >= 0) & (apart(s["last"], x) < threshold) & (span(s["first"], x) <= most)
        n = (s["n"] + F.when(joins, 0).otherwise(1)).cast("int")
        return F.struct(F.when(joins, s["first"]).otherwise(x).cast(item).alias("first"), x.alias("last"), n.alias("n"), F.concat(s["labels"], F.array(n)).alias("labels"))

    return df.withColumn("labels", F.aggregate("items", zero, step, lambda s: s["labels"]))


def suppressed(df: DataFrame, at: Callable[[Column], Column], min_gap: float | Column, most: int) -> DataFrame:
    """df with kept: items in their given order (best first) that are at least min_gap from all kept, `most` at most."""

    def differs(kept: Column, x: Column) -> Column:
        return (F.size(kept) < most) & F.forall(kept, lambda y: F.abs(at(y) - at(x)) >= min_gap)

    return df.withColumn("kept", F.when(F.lit(most) > 0, _keep(F.col("items"), kind_of(df), differs)).otherwise(F.array().cast(f"array<{kind_of(df)}>")))


def fill_gaps(kept: Column, candidates: Column, max_gap: Column | float, at: Callable[[Column], Column] = lambda x: x, apart: Callable[[Column, Column], Column] | None = None, min_diff: float = 0.0, anchor_last: bool = False) -> Column:
    """Sorted array: kept with candidates put in, so that no gap is wider than max_gap where a candidate allows it.

    In a gap, the candidate nearest to the last item plus max_gap is put in (the lower of two), again and again; only
    candidates inside the gap and after the last item count. With apart, a gap is left as it is once that candidate
    differs from the last item by no more than min_diff. With anchor_last, the last candidate is kept, however alike, if
    it is more than max_gap after the last kept item. at gives an item's position.
    """
    none = F.slice(candidates, 1, 0)
    if anchor_last:
        end = F.try_element_at(candidates, F.lit(-1))
        kept = F.when(at(end) - at(F.try_element_at(kept, F.lit(-1))) > max_gap, F.concat(kept, F.array(end))).otherwise(kept)

    def between(a: Column, b: Column) -> Column:
        """Items put in between a and b."""
        inside = F.filter(candidates, lambda c: (at(c) > at(a)) & (at(c) < at(b)))

        def step(out: Column, _: Column) -> Column:
            last = F.coalesce(F.try_element_at(out, F.lit(-1)), a)
            rest = F.filter(inside, lambda c: at(c) > at(last))
            best = F.array_min(F.transform(rest, lambda c: F.struct(F.abs(at(c) - at(last) - max_gap).alias("d"), at(c).alias("p"), c.alias("c"))))["c"]
            wide = (at(b) - at(last) > max_gap) & best.isNotNull()
            if apart is not None:
                wide &= F.coalesce(apart(last, best) > min_diff, F.lit(False))
            return F.when(wide, F.concat(out, F.array(best))).otherwise(out)

        return F.aggregate(inside, none, step)

    pairs = F.sequence(F.lit(1), F.size(kept))
    return F.flatten(F.transform(pairs, lambda i: F.concat(F.array(F.element_at(kept, i)), F.when(i < F.size(kept), between(F.element_at(kept, i), F.element_at(kept, i + 1))).otherwise(none))))


def arc_targets(cumulative: Column, n: Column, min_gap: Column | float) -> Column:
    """Indexes (from 0) of the samples where a path first reaches k of n - 1 equal parts of its length, thinned so that
    each is at least min_gap after the one before it; the last sample is always taken."""
    total = F.element_at(cumulative, -1)
    size = F.size(cumulative)
    targets = F.transform(F.sequence(F.lit(0), n - 1), lambda k: total * k / F.greatest(n - 1, F.lit(1)))
    found = F.transform(targets, lambda t: F.size(F.filter(cumulative, lambda c: c < t)))
    thin = F.aggregate(found, F.array().cast("array<int>"), lambda kept, i: F.when((i < size) & ((F.size(kept) == 0) | (i - F.try_element_at(kept, F.lit(-1)) >= min_gap)), F.concat(kept, F.array(i))).otherwise(kept))
    return F.array_sort(F.array_distinct(F.concat(thin, F.array(size - 1))))


def max_min_picks(df: DataFrame, apart: Callable[[Column, Column], Column], at: Callable[[Column], Column], most: int, threshold: float, min_gap: float | Column, middle: Column | None = None) -> DataFrame:
    """df with kept: the middle item (the one whose position is nearest to `middle`, if given), then again and again the item least like all kept ones, if that is at least
    min_gap from each of them and unlike by threshold or more; `most` items at most, in order of position."""
    item = kind_of(df)
    items = F.col("items")

    def step(kept: Column, _: Column) -> Column:
        free = F.filter(items, lambda x: F.forall(kept, lambda y: F.abs(at(y) - at(x)) >= min_gap))
        scored = F.transform(free, lambda x: F.struct(F.array_min(F.transform(kept, lambda y: apart(y, x))).alias("d"), (-at(x)).alias("p"), x.alias("x")))
        best = F.array_max(scored)
        return F.when(best["d"] >= threshold, F.concat(kept, F.array(best["x"]))).otherwise(kept)

    if middle is None:
        seed = F.element_at(items, (F.floor(F.size(items) / 2) + 1).cast("int"))
    else:
        seed = F.array_min(F.transform(items, lambda x: F.struct(F.abs(at(x) - middle).alias("d"), at(x).alias("p"), x.alias("x"))))["x"]
    first = F.array(seed).cast(f"array<{item}>")
    picks = F.aggregate(F.sequence(F.lit(2), F.lit(most)), first, step) if most > 1 else first
    return df.withColumn("kept", F.array_sort(picks, lambda a, b: F.when(at(a) < at(b), -1).when(at(a) > at(b), 1).otherwise(0)))
