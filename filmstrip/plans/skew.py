"""Joins that hold when one key has a third of all rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filmstrip.session import broadcast_limit, cut

SALT, SALTS = "__salt", "__salts"


def fits(df: DataFrame) -> bool:
    """Whether df has few enough rows to be broadcast; it is counted up to the session's limit."""
    limit = broadcast_limit(df.sparkSession)
    return df.limit(limit + 1).count() <= limit


@dataclass
class HotKeys:
    """Keys of more than so many rows, with the salts that each is split into; None if there is none."""

    rows: DataFrame | None
    small: bool = True


def hot_keys(left: DataFrame, on: list[str], rows: int = 200_000) -> HotKeys:
    """Counts left's keys in a pass of its own, combined before its shuffle."""
    hot = left.groupBy(*on).agg(F.count(F.lit(1)).alias("__rows")).where(F.col("__rows") > rows)
    hot = cut(hot.select(*on, F.ceil(F.col("__rows") / rows).cast("int").alias(SALTS)))
    return HotKeys(None) if hot.isEmpty() else HotKeys(hot, fits(hot))


def salted_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner", condition: Column | None = None, rows: int = 200_000, hot: HotKeys | None = None) -> DataFrame:
    """Joins on equal keys, with left's hot keys (more than `rows` rows) split into salts and right's rows of them repeated.

    how: inner, left, left_semi or left_anti; condition may name left columns by "l.x" and right ones by "r.x". Left's
    hot keys are counted, unless `hot` gives them, as of a table that left is a part of. If none is hot, the join is a
    plain one. The hot keys are at most (rows of left) / `rows`; their table is broadcast if it is within the session's
    limit, so that left isn't shuffled by key to learn its salts, and joined like any other table beyond it.
    """
    hot = hot or hot_keys(left, on, rows)
    a, b, keys = left, right, list(on)
    if hot.rows is not None:
        spread = F.broadcast(hot.rows) if hot.small else hot.rows
        some_salt = F.pmod(F.xxhash64(*left.columns), F.coalesce(SALTS, F.lit(1))).cast("int")
        all_salts = F.explode(F.sequence(F.lit(0), F.coalesce(SALTS, F.lit(1)) - 1))
        a = left.join(spread, on, "left").withColumn(SALT, some_salt).drop(SALTS)
        b = right.join(spread, on, "left").withColumn(SALT, all_salts).drop(SALTS)
        keys.append(SALT)
    a, b = a.alias("l"), b.alias("r")
    test = condition
    for k in keys:
        equal = F.col(f"l.{k}") == F.col(f"r.{k}")
        test = equal if test is None else equal & test
    joined = a.join(b, test, how)
    mine = [F.col(f"l.{c}") for c in left.columns]
    if how in ("left_semi", "left_anti"):
        return joined.select(*mine)
    return joined.select(*mine, *[F.col(f"r.{c}") for c in right.columns if c not in on])


def join_small(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """right is counted: up to the session's limit it is broadcast, beyond it the join is a salted one."""
    return left.join(F.broadcast(right), on, how) if fits(right) else salted_join(left, right, on, how)
