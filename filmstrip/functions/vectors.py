"""Vectors as arrays of doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def doubles(v: Column) -> Column:
    return v.cast("array<double>")


def total(v: Column) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda a, x: a + x)


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x * y))


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def normalised(v: Column) -> Column:
    """Unit length; vectors shorter than 1e-8 are divided by that."""
    return F.transform(v, lambda x: x / F.greatest(norm(v), F.lit(1e-8)))


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (F.greatest(norm(a), F.lit(1e-8)) * F.greatest(norm(b), F.lit(1e-8)))


def distance(a: Column, b: Column) -> Column:
    return F.sqrt(total(F.zip_with(a, b, lambda x, y: (x - y) * (x - y))))


def relative_change(a: Column, b: Column) -> Column:
    """How far b is from a, as a share of a's length."""
    return distance(a, b) / F.greatest(norm(a), F.lit(1e-8))


def rms(a: Column, b: Column) -> Column:
    return distance(a, b) / F.sqrt(F.size(a))


def mean(v: Column) -> Column:
    return total(v) / F.size(v)


def deviation(v: Column) -> Column:
    """Of the whole population."""
    return F.sqrt(F.greatest(mean(F.transform(v, lambda x: x * x)) - mean(v) * mean(v), F.lit(0.0)))


def histogram_difference(a: Column, b: Column) -> Column:
    """One minus the correlation of two histograms; a flat one correlates with nothing (difference 1)."""
    ab, aa, bb = dot(a, b) - F.size(a) * mean(a) * mean(b), dot(a, a) - F.size(a) * mean(a) * mean(a), dot(b, b) - F.size(a) * mean(b) * mean(b)
    return 1 - F.when((aa > 1e-12) & (bb > 1e-12), ab / F.sqrt(aa * bb)).otherwise(0.0)


def blend(a: Column, b: Column, share: float) -> Column:
    """share of a and the rest of b."""
    return F.zip_with(a, b, lambda x, y: x * share + y * (1 - share))


def pooled(rows: Column, mask: Column) -> Column:
    """The unit-length mean of the rows (arrays) whose mask isn't 0."""
    kept = F.filter(F.arrays_zip(rows.alias("r"), mask.alias("m")), lambda x: x["m"] != 0)
    n = F.greatest(F.size(kept), F.lit(1))
    summed = F.aggregate(kept, F.transform(F.try_element_at(rows, F.lit(1)), lambda x: F.lit(0.0)), lambda acc, x: F.zip_with(acc, x["r"], lambda p, q: p + q))
    return normalised(F.transform(summed, lambda x: x / n))
