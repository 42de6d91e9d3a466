"""References whose target is missing, late or deleted, kept up to date batch by batch."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from filmstrip.plans.skew import HotKeys, hot_keys, salted_join
from filmstrip.session import cut

REF = ["child_table", "child_id", "ref_field"]


def references(df: DataFrame, child_table: str, child_id: str, ref_field: str, keys: list[str], written_at: str = "written_at") -> DataFrame:
    """The references of a table: child_table, child_id, ref_field, key (a string), ref_at; rows with a null in a key
    or the time are none. Key parts are joined by a character that no printed key has, so equal keys stay equal."""
    return df.dropna(subset=[*keys, written_at]).select(
        F.lit(child_table).alias("child_table"), F.col(child_id).cast("long").alias("child_id"), F.lit(ref_field).alias("ref_field"), key_of(keys).alias("key"), F.col(written_at).alias("ref_at")
    )


def key_of(keys: list[str]) -> Column:
    return F.concat_ws("\x1f", F.lit("/".join(keys)), *[F.col(k).cast("string") for k in keys])


def targets(df: DataFrame, keys: list[str], target_id: str, written_at: str = "written_at", deleted_at: str = "deleted_at") -> DataFrame:
    """What the references may point at: key, target_id (as a string), from_at (when it arrived), until_at (when it was
    deleted, or null)."""
    return df.dropna(subset=[*keys, written_at]).select(key_of(keys).alias("key"), F.col(target_id).cast("string").alias("target_id"), F.col(written_at).alias("from_at"), F.col(deleted_at).alias("until_at"))


@dataclass
class Segment:
    """The references of one batch: those between two times, all of them until they are forgotten, those that wait for
    a target, and the counts of these."""

    lo: datetime
    hi: datetime
    refs: DataFrame | None
    waiting: DataFrame
    counts: list[Row]


class Orphans:
    """State: the parent index, and by batches of references those seen and those that wait for a target.

    A reference is satisfied by a target of its key that arrived no more than `grace` hours after it and was not
    deleted up to it. apply() takes a batch of new references, arriving targets and deletions, in any order:
    new references probe the index; arriving targets resolve waiting references of their keys; deletions reopen the
    references that only they had satisfied. A target that arrives again counts as one more.

    The index is a log of arrivals and deletions, to which batches are added; nothing in it is written again. Each
    segment knows the times of its references, so an arrival meets only segments that end no more than `grace` hours
    before it, and a deletion only those that end after it; only these are written again. forget() drops the satisfied
    references of segments that no later deletion can reach, so the state holds as many of them as deletions may be
    late. Hot keys are salted; if they are known for all batches (hot_keys), they aren't counted for each. Empty batches
    leave the state as it is.
    """

    def __init__(self, grace: int = 48, hot: HotKeys | None = None) -> None:
        self.grace, self.hot = grace, hot
        self.arrivals: list[DataFrame] = []
        self.deletions: list[DataFrame] = []
        self.segments: list[Segment] = []
        self.snapshots: list[tuple[datetime | None, list[Row]]] = []

    def _serves(self) -> Column:
        late = F.col("r.from_at") > F.col("l.ref_at") + F.make_dt_interval(hours=F.lit(self.grace))
        gone = F.col("r.until_at") <= F.col("l.ref_at")
        return ~(late | F.coalesce(gone, F.lit(False)))

    def _open(self, refs: DataFrame, parents: DataFrame) -> DataFrame:
        return salted_join(refs, parents, ["key"], "left_anti", self._serves(), hot=self.hot)

    def index(self) -> DataFrame | None:
        """key, target_id, from_at, until_at of all targets; a deletion ends the target that arrived at its from_at."""
        if not self.arrivals:
            return None
        log = reduce(DataFrame.unionByName, self.arrivals)
        if not self.deletions:
            return log
        ends = reduce(DataFrame.unionByName, self.deletions).withColumn("arrived", F.lit(False))
        both = log.withColumn("arrived", F.lit(True)).unionByName(ends)
        one = both.groupBy("key", "target_id", "from_at").agg(F.min("until_at").alias("until_at"), F.max("arrived").alias("arrived"))
        return one.where("arrived").drop("arrived")

    def _put(self, segment: Segment, waiting: DataFrame) -> None:
        segment.waiting = cut(waiting)
        month = F.date_trunc("month", "ref_at").alias("month")
        # tables, fields and months: the rows of a report
        segment.counts = segment.waiting.groupBy("child_table", "ref_field", month).agg(F.count(F.lit(1)).alias("orphans")).collect()

    def apply(self, refs: DataFrame | None = None, arrived: DataFrame | None = None, deleted: DataFrame | None = None) -> Orphans:
        """refs as references() gives them; arrived and deleted as targets() does, target_id being optional."""
        if arrived is not None:
            arrived = cut(_named(arrived))
            first = arrived.agg(F.min("from_at")).first()[0]
            if first is not None:
                self.arrivals.append(arrived)
                for s in self.segments:
                    if s.hi >= first - timedelta(hours=self.grace):
                        self._put(s, self._open(s.waiting, arrived))
        if deleted is not None:
            deleted = cut(_named(deleted))
            first = deleted.agg(F.min("until_at")).first()[0]
            if first is not None:
                self.deletions.append(deleted)
                touched = deleted.groupBy("key").agg(F.min("until_at").alias("__first"))
                for s in self.segments:
                    if s.hi >= first and s.refs is not None:
                        again = salted_join(s.refs, touched, ["key"], "left_semi", F.col("l.ref_at") >= F.col("r.__first"), hot=self.hot)
                        self._put(s, s.waiting.unionByName(self._open(again, self.index())).dropDuplicates(REF))
        if refs is not None:
            lo, hi = refs.agg(F.min("ref_at"), F.max("ref_at")).first()
            if lo is not None:
                index = self.index()
                segment = Segment(lo, hi, refs, refs, [])
                self._put(segment, refs if index is None else self._open(refs, index))
                self.segments.append(segment)
        return self

    def forget(self, before: datetime) -> None:
        """No deletion dated before this time will come any more: references that are older can't be reopened."""
        for s in self.segments:
            if s.hi < before:
                s.refs = None

    @property
    def waiting(self) -> DataFrame | None:
        """All references that wait for a target; None before the first."""
        return reduce(DataFrame.unionByName, [s.waiting for s in self.segments]) if self.segments else None

    def snapshot(self, as_of: datetime | None = None) -> None:
        """Keeps the counts of now, under a time; segments that didn't change since the last one aren't read."""
        self.snapshots.append((as_of, [r for s in self.segments for r in s.counts]))

    def report(self, spark: SparkSession) -> DataFrame:
        """as_of, child_table, ref_field, month of the reference and orphans, for each snapshot."""
        total: dict[tuple, int] = {}
        for as_of, counts in self.snapshots:
            for r in counts:
                group = (as_of, r.child_table, r.ref_field, r.month)
                total[group] = total.get(group, 0) + r.orphans
        return spark.createDataFrame([(*k, n) for k, n in total.items()], "as_of timestamp, child_table string, ref_field string, month timestamp, orphans long")


def _named(parents: DataFrame) -> DataFrame:
    return parents if "target_id" in parents.columns else parents.withColumn("target_id", F.lit("")).select("key", "target_id", "from_at", "until_at")


def replay(refs: DataFrame, parents: DataFrame, cuts: Iterable[datetime], grace: int = 48) -> Orphans:
    """Feeds whole tables to the state in the order of time, one batch up to each cut and a last one after them, and
    takes a snapshot after each: as_of the cut, or null after the last.

    refs and parents are read once for each batch, so they should be stored or checkpointed with the time as a filter.
    """
    state = Orphans(grace, hot_keys(refs, ["key"]))
    edges = [None, *sorted(cuts), None]
    for a, b in zip(edges, edges[1:]):

        def within(at: str, a: datetime | None = a, b: datetime | None = b) -> Column:
            test = F.col(at).isNotNull()
            if a is not None:
                test &= F.col(at) >= F.lit(a)
            return test if b is None else test & (F.col(at) < F.lit(b))

        known = F.when(F.col("until_at") < F.lit(b), F.col("until_at")) if b is not None else F.col("until_at")
        arrived = parents.where(within("from_at")).withColumn("until_at", known)
        deleted = parents.where(within("until_at") & (F.lit(False) if a is None else F.col("from_at") < F.lit(a)))
        if a is not None:
            state.forget(a)
        state.apply(arrived=arrived, deleted=deleted if a is not None else None)
        state.apply(refs=refs.where(within("ref_at")))
        state.snapshot(b)
    return state
