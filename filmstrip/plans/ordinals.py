"""A row's place within its key and the number of the key's rows, for keys that may hold most rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filmstrip.plans.ordered import chunked, scan
from filmstrip.plans.skew import join_small
from filmstrip.session import cut


def ordinals(df: DataFrame, keys: list[str], order: list[str], place: str, size: str) -> DataFrame:
    """df with `place`, counted from 0 in the given order of each key, and `size`, the rows of the key. (keys, order)
    must be unique; rows with a null key take no part."""
    rows = cut(scan(chunked(df.dropna(subset=keys), keys, order), keys, order, sums={place: F.lit(1)}).withColumn(place, F.col(place) - 1))
    return join_small(rows, rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(size)), keys)
