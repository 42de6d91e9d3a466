"""Interval, nearest, as-of and upsert joins. All carry the entity's key, so they are equi joins with a residual test."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filmstrip.plans.ordered import chunked, scan


BIN = 1024


def bins(low: Column, high: Column, width: int = BIN) -> Column:
    """The numbers of the bins of `width` that low..high touches; none if high is below low or one of them is null."""
    touched = F.sequence(F.floor(low / width), F.floor(high / width))
    return F.when((low <= high), touched).otherwise(F.array().cast("array<bigint>"))


def in_interval(points: DataFrame, intervals: DataFrame, key: str, at: str, start: str, end: str, how: str = "inner", width: int = BIN) -> DataFrame:
    """Pairs of a point and each interval of its key that holds it (ends inclusive).

    how: inner drops points outside every interval, left keeps them with nulls. Nulls never match. Clashing names: the
    intervals' columns other than key get the prefix i_ where points has them too.

    Both sides are joined by key and bin of `width`, so that a key with very many rows is many small groups and not one
    in which all points meet all intervals; an interval is repeated once for each bin it touches.
    """
    right = intervals.select(F.col(key), *[F.col(c).alias(f"i_{c}" if c in points.columns else c) for c in intervals.columns if c != key])
    s, e = (f"i_{c}" if c in points.columns else c for c in (start, end))
    p = points.withColumn("__bin", F.floor(F.col(at) / width)).alias("p")
    i = right.withColumn("__bin", F.explode(bins(F.col(s), F.col(e), width))).alias("i")
    test = (F.col(f"p.{key}") == F.col(f"i.{key}")) & (F.col("p.__bin") == F.col("i.__bin")) & F.col(f"p.{at}").between(F.col(f"i.{s}"), F.col(f"i.{e}"))
    return p.join(i, test, how).select(*[F.col(f"p.{c}") for c in points.columns], *[F.col(f"i.{c}") for c in right.columns if c != key])


def forward_clamped(points: DataFrame, intervals: DataFrame, key: str, at: str, point_id: str, end: str, value: str) -> DataFrame:
    """point_id and value of the first interval of the key that ends at or after the point; points after all get the last.

    One pass over both tables in the order of time: the next interval end is carried back onto each point, and the last
    one forward. Points with nulls take no part; keys without intervals give no row.
    """
    a = points.select(F.col(key).alias("k"), F.col(at).cast("long").alias("t"), F.lit(0).alias("side"), F.col(point_id).alias("id"), F.lit(None).cast(intervals.schema[value].dataType).alias("v")).dropna(subset=["k", "t", "id"])
    b = intervals.select(F.col(key).alias("k"), F.col(end).cast("long").alias("t"), F.lit(1).alias("side"), F.lit(None).cast(points.schema[point_id].dataType).alias("id"), F.col(value).alias("v")).dropna(subset=["k", "t", "v"])
    b = b.groupBy("k", "t", "side").agg(F.min("v").alias("v")).select("k", "t", "side", F.lit(None).cast(points.schema[point_id].dataType).alias("id"), "v")
    order = ["t", "side", "id"]
    both = scan(chunked(a.unionByName(b), ["k"], order), ["k"], order, last={"before": F.col("v")}, following={"after": F.col("v")})
    return both.where("side = 0").select(F.col("id").alias(point_id), F.coalesce("after", "before").alias(value)).dropna()


def nearest_in_pool(events: DataFrame, pool: DataFrame, key: str, at: str, own: str, frame: str, event_id: str) -> DataFrame:
    """event_id and rep_frame: the frame nearest to the event's time (the lower of two) among its own frames (an array)
    or, if it has none, among its key's pool; an event without any frame gets its own time, rounded down to a frame.

    Only events without own frames meet the pool, by the carried neighbours of an ordered scan and not by pairs."""
    nearer = F.array_min(F.transform(F.col(own), lambda f: F.struct(F.abs(f - F.col(at)).alias("d"), f.alias("f"))))["f"]
    with_own = events.where(F.size(own) > 0).select(event_id, nearer.cast("long").alias("rep_frame"))
    rest = events.where(F.coalesce(F.size(own), F.lit(0)) <= 0)
    a = rest.select(F.col(key).alias("k"), F.col(at).cast("long").alias("t"), F.lit(1).alias("side"), F.col(event_id).alias("id")).dropna()
    b = pool.select(F.col(key).alias("k"), F.col(frame).cast("long").alias("t")).dropna().distinct().select("k", "t", F.lit(0).alias("side"), F.lit(None).cast(events.schema[event_id].dataType).alias("id"))
    order, point = ["t", "side", "id"], F.when(F.col("side") == 0, F.col("t"))
    both = scan(chunked(a.unionByName(b), ["k"], order), ["k"], order, last={"prev": point}, following={"next": point}).where("side = 1")
    best = F.when(F.col("next").isNull() | (F.col("t") - F.col("prev") <= F.col("next") - F.col("t")), F.col("prev")).otherwise(F.col("next"))
    found = both.select(F.col("id").alias(event_id), F.coalesce(best, "t").cast("long").alias("rep_frame"))
    unplaced = rest.where(F.col(key).isNull() | F.col(at).isNull()).select(event_id, F.col(at).cast("long").alias("rep_frame"))
    return with_own.unionByName(found).unionByName(unplaced)


def value_at(points: DataFrame, pool: DataFrame, key: str, at: str, point_id: str, frame: str, value: str) -> DataFrame:
    """point_id and value of the pool's row of the same key whose frame is the point's or, if there is none, nearest to
    it (the lower of two; of several at one frame the least value). Points of keys without frames give no row."""
    own = points.select(point_id, key, at).dropna().withColumn("__own", F.array().cast("array<bigint>"))
    rep = nearest_in_pool(own, pool, key, at, "__own", frame, point_id)
    values = pool.dropna(subset=[key, frame]).groupBy(key, F.col(frame).cast("long").alias("rep_frame")).agg(F.min(value).alias(value))
    return own.select(point_id, key).join(rep, point_id).join(values, [key, "rep_frame"]).select(point_id, value)


def collected_in_interval(events: DataFrame, points: DataFrame, keys: list[str], start: str, end: str, at: str, out: str, width: int = BIN) -> DataFrame:
    """events with a sorted array of the points of its keys inside each interval, empty for none. Joined by bin, as in
    in_interval; events with equal values in all columns stay separate rows."""
    e = events.withColumn("__row", F.monotonically_increasing_id())
    e = e.withColumn("__bin", F.explode_outer(bins(F.col(start), F.col(end), width)))
    p = points.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col(at).alias("__at"), F.floor(F.col(at) / width).alias("__pbin"))
    test = (F.col("__bin") == F.col("__pbin")) & F.col("__at").between(F.col(start), F.col(end))
    for k in keys:
        test &= F.col(k) == F.col(f"__{k}")
    inside = e.join(p, test, "left").groupBy("__row", *events.columns).agg(F.array_sort(F.collect_list("__at")).alias(out))
    return inside.drop("__row")


def upsert(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """The rows of new, and those of old whose key new doesn't have; `state` says new, updated or kept. Of several rows
    with one key in new all stay; a null key is a key of its own and never matches."""
    keys_old, keys_new = old.select(*key).distinct(), new.select(*key).distinct()
    kept = old.join(keys_new, key, "left_anti").withColumn("state", F.lit("kept"))
    there = keys_old.withColumn("__there", F.lit(True))
    fresh = new.join(there, key, "left").withColumn("state", F.when(F.col("__there"), "updated").otherwise("new")).drop("__there")
    return kept.unionByName(fresh, allowMissingColumns=True)


def latest(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The last row of each key in the given order."""
    w = Window.partitionBy(*key).orderBy(*[c.desc() for c in order])
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def remaining(everything: DataFrame, done: DataFrame, key: list[str]) -> DataFrame:
    """What isn't done yet, for a run that goes on after a break."""
    return everything.join(done.select(*key).distinct(), key, "left_anti")


def neighbours(df: DataFrame, key: str, at: str, row_id: str) -> DataFrame:
    """df with before and after: the neighbouring times of the same key; 0 before the first, the last itself after it.
    (key, at, row_id) must be unique; carried over chunks, so a key may have any number of rows."""
    order = [at, row_id]
    rows = scan(chunked(df, [key], order), [key], order, prior={"before": F.col(at)}, after={"after": F.col(at)})
    return rows.withColumn("before", F.coalesce("before", F.lit(0))).withColumn("after", F.coalesce("after", F.col(at)))
