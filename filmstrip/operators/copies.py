"""Rows that were delivered more than once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_copies(df: DataFrame, columns: list[str], written_at: str = "written_at") -> DataFrame:
    """One row for each set of copies, that is rows equal in `columns`, with the earliest written_at (null if all are).

    Grouping by all columns keeps the aggregate hash-based and combines copies before the shuffle, however many there are.
    """
    return df.groupBy(*columns).agg(F.min(written_at).alias(written_at))
