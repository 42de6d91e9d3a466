"""Work that partly fails, done again in rounds until nothing is left or nothing gets better."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filmstrip.session import cut


def refill(df: DataFrame, key: list[str], column: str, bad: Callable[[Column], Column], again: Callable[[DataFrame, int], DataFrame], rounds: int = 10, idle: int = 3, wait: float = 0.0, sleep: Callable[[float], None] = time.sleep) -> tuple[DataFrame, list[tuple[int, int]]]:
    """df with its bad values of `column` made again, and for each round how many were filled and how many stayed bad.

    again(rows, round) gives the key and a new `column` for the bad rows; what is still bad then keeps its old value and
    is tried in the next round. It ends when no bad row is left, after `rounds`, or after `idle` rounds that filled none.
    Only the bad rows take part in a round, and what a round filled is written before the next one begins, so a run that
    breaks off loses one round. The key is that of a row.
    """
    test = F.coalesce(bad(F.col(column)), F.lit(True))
    open_, done, report, empty = cut(df.where(test)), [df.where(~test)], [], 0
    left = open_.count()
    for n in range(1, rounds + 1):
        if not left or empty >= idle:
            break
        if n > 1 and wait:
            sleep(wait)
        made = again(open_, n).select(*key, F.col(column).alias("__new"))
        tried = cut(open_.join(made, key, "left").withColumn("__ok", ~F.coalesce(bad(F.col("__new")), F.lit(True))))
        done.append(tried.where("__ok").withColumn(column, F.col("__new")).select(*df.columns))
        open_ = tried.where(~F.col("__ok")).select(*df.columns)
        before, left = left, open_.count()
        report.append((before - left, left))
        empty = empty + 1 if before == left else 0
    out = open_
    for part in done:
        out = out.unionByName(part)
    return out, report
