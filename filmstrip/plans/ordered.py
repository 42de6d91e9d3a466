"""Running sums and carried values in a global order, split by range and not by key.

A window partitioned by a key puts a hot key in one task. Here rows are range-partitioned by (keys, order), so a hot
key spreads over as many chunks as its size asks for; windows run within (chunk, key), and what earlier or later chunks
owe to a chunk is carried over in a table of at most two rows a chunk, the only thing that is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filmstrip.session import cut, partitions

CHUNK, SEAT = "__chunk", "__seat"


def chunked(df: DataFrame, keys: list[str], order: list[str], seats: bool = False) -> DataFrame:
    """df with its chunk's number, chunks in the order of (keys, order); with seats, also the row's place in its chunk.

    (keys, order) must be unique. With seats the result is read from a checkpoint; without, scan() cuts it where it
    needs a chunk's number twice.
    """
    spread = df.repartitionByRange(partitions(df.sparkSession), *keys, *order)
    if seats:
        gid = F.monotonically_increasing_id()
        spread = spread.sortWithinPartitions(*keys, *order).withColumn(SEAT, gid)
        return cut(spread.withColumn(CHUNK, F.shiftright(SEAT, 33).cast("int")).withColumn(SEAT, F.col(SEAT).bitwiseAND((1 << 33) - 1)))
    return spread.withColumn(CHUNK, F.spark_partition_id())


def positions(df: DataFrame, out: str) -> DataFrame:
    """A chunked table with seats gets the row's place in the whole order, counted from 0."""
    sizes = df.groupBy(CHUNK).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)  # one row a chunk
    starts = sizes.select(CHUNK, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    return df.join(F.broadcast(starts), CHUNK).withColumn(out, F.col("__start") + F.col(SEAT)).drop("__start", SEAT, CHUNK)


def _edges(totals: DataFrame, keys: list[str]) -> DataFrame:
    """Of a table with a row for each (chunk, key), those whose key may go on in another chunk: two a chunk at most."""
    key = F.struct(*keys)
    outer = totals.groupBy(CHUNK).agg(F.min(key).alias("__lo"), F.max(key).alias("__hi"))  # one row a chunk
    return totals.join(F.broadcast(outer), CHUNK).where((key == F.col("__lo")) | (key == F.col("__hi")))


def scan(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    sums: dict[str, Column] | None = None,
    last: dict[str, Column] | None = None,
    following: dict[str, Column] | None = None,
    prior: dict[str, Column] | None = None,
    after: dict[str, Column] | None = None,
) -> DataFrame:
    """Adds columns to a chunked table, each within its key: running sums up to and with a row; the last value that
    isn't null up to and with it; the first that isn't null from it on; the value of the row before; that of the row
    after. All but the sums may be made of the sums.

    One shuffle by (chunk, key) and one cut; the sums of whole chunks, which need no order, are known before it.
    """
    sums, last, following, prior, after = (x or {} for x in (sums, last, following, prior, after))
    on = [CHUNK, *keys]
    ordered, reverse = Window.partitionBy(*on).orderBy(*order), Window.partitionBy(*on).orderBy(*[F.desc(c) for c in order])
    so_far = (Window.unboundedPreceding, 0)
    earlier, later = Window.partitionBy(*keys).orderBy(CHUNK), Window.partitionBy(*keys).orderBy(F.desc(CHUNK))
    if sums:
        df = cut(df)
        totals = df.groupBy(*on).agg(*[F.sum(v).alias(f"__c_{k}") for k, v in sums.items()])
        owed = _edges(totals, keys).select(*on, *[F.sum(f"__c_{k}").over(earlier.rowsBetween(Window.unboundedPreceding, -1)).alias(f"__c_{k}") for k in sums])
        df = df.join(F.broadcast(owed), on, "left")
        df = df.select("*", *[(F.sum(v).over(ordered.rowsBetween(*so_far)) + F.coalesce(f"__c_{k}", F.lit(0))).alias(k) for k, v in sums.items()]).drop(*[f"__c_{k}" for k in sums])
    if not (last or following or prior or after):
        return df
    ends = [F.lag(F.lit(1)).over(ordered).isNull().alias("__first"), F.lead(F.lit(1)).over(ordered).isNull().alias("__final")]
    here = cut(
        df.select(
            "*",
            *ends,
            *[F.last(v, ignorenulls=True).over(ordered.rowsBetween(*so_far)).alias(k) for k, v in last.items()],
            *[F.last(v, ignorenulls=True).over(reverse.rowsBetween(*so_far)).alias(k) for k, v in following.items()],
            *[F.lag(v).over(ordered).alias(k) for k, v in prior.items()],
            *[F.lead(v).over(ordered).alias(k) for k, v in after.items()],
            *[v.alias(f"__v_{k}") for k, v in (prior | after).items()],
        )
    )

    def at(flag: str, columns: list[str]) -> list[Column]:
        """The columns' values on the row of the flag, of which each (chunk, key) has one."""
        return [F.max(F.when(F.col(flag), F.struct(*columns))).alias(flag)] if columns else []

    ended, begun = [*last, *(f"__v_{k}" for k in prior)], [*following, *(f"__v_{k}" for k in after)]
    totals = here.where("__first or __final").groupBy(*on).agg(*at("__final", ended), *at("__first", begun))
    owed = _edges(totals, keys).select(
        *on,
        *[F.last(f"__final.{k}", ignorenulls=True).over(earlier.rowsBetween(Window.unboundedPreceding, -1)).alias(f"__c_{k}") for k in last],
        *[F.last(f"__first.{k}", ignorenulls=True).over(later.rowsBetween(Window.unboundedPreceding, -1)).alias(f"__c_{k}") for k in following],
        *[F.lag(f"__final.__v_{k}").over(earlier).alias(f"__c_{k}") for k in prior],
        *[F.lag(f"__first.__v_{k}").over(later).alias(f"__c_{k}") for k in after],
    )
    both = here.join(F.broadcast(owed), on, "left")
    filled = {k: F.coalesce(k, f"__c_{k}") for k in (*last, *following)}
    filled |= {k: F.when(F.col("__first"), F.col(f"__c_{k}")).otherwise(F.col(k)) for k in prior}
    filled |= {k: F.when(F.col("__final"), F.col(f"__c_{k}")).otherwise(F.col(k)) for k in after}
    own = [c for c in df.columns if c not in filled]
    return both.select(*own, *[v.alias(k) for k, v in filled.items()])
