"""Runs of consecutive events that say the same, by pointer doubling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filmstrip.functions import labels
from filmstrip.functions.fold import squeeze
from filmstrip.plans.ordered import chunked, positions
from filmstrip.plans.skew import join_small
from filmstrip.session import cut

WAYS = (labels.UP, labels.DOWN, labels.LEFT, labels.RIGHT, *(f"{x}/{y}" for x in (labels.LEFT, labels.RIGHT) for y in (labels.UP, labels.DOWN)))
LEVELS = (labels.LIGHT, labels.MEDIUM, labels.STRONG)


def phrases() -> list[str]:
    """How every movement is written in full."""
    return [labels.STILL, *(f"{labels.IN_PLACE} ({v})" for v in LEVELS), *(f"{m} {w} ({v})" for m in (labels.CAMERA, labels.SUBJECT) for w in WAYS for v in LEVELS)]


def _bare(text: str) -> str:
    from unicodedata import combining, normalize

    return "".join(c for c in normalize("NFKD", text.lower().replace("đ", "d")) if c.isalnum() and not combining(c))


def motion_class(motion: Column) -> Column:
    """What a motion text means: a known phrase, however it is written, else its own letters and digits.

    Case, accents, spacing and punctuation don't count. A text that is no known phrase but within a sixth of its length
    (two at least) in edits of one is that phrase, the nearest one; so a letter lost or two exchanged do no harm, while
    another direction or strength is another phrase. Null, blank and punctuation-only texts have no class (null).
    """
    known = list(dict.fromkeys(_bare(p) for p in phrases()))
    bare = squeeze(motion)
    near = F.array_min(F.array(*[F.struct(F.levenshtein(bare, F.lit(k)).alias("d"), F.lit(k).alias("k")) for k in known]))
    allowed = F.greatest(F.lit(2), F.floor(F.length(bare) / 6))
    fuzzy = F.when((near["d"] <= allowed) & (F.length(bare) >= 6), near["k"]).otherwise(bare)
    return F.when(bare.isNull() | (bare == ""), None).when(bare.isin(known), bare).otherwise(fuzzy)


def with_motion_class(df: DataFrame, motion: str, out: str) -> DataFrame:
    """df with motion_class of a column. Each different text is classified once, as texts are far fewer than rows; their
    classes are broadcast if they are counted to be few, and joined with hot texts salted if not."""
    texts = df.select(motion).where(F.col(motion).isNotNull()).distinct()
    return join_small(df, cut(texts.withColumn(out, motion_class(F.col(motion)))), [motion], "left")


def collapse_runs(df: DataFrame, keys: list[str], order: list[str], same: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """One row per longest run of neighbouring rows of a key whose `same` values are equal.

    Columns: keys, run_value, first_<order[0]>, last_<order[0]>, events, and, with start and end, first_frame, last_frame
    and frames (the span from the least start to the greatest end, both inclusive; null if none is known).

    (keys, order) must identify a row. Rows with a null in keys or order[0] are left out; a row with a null `same` is a
    run of its own with run_value null, and parts the runs beside it. Empty input gives no rows.

    All rows get their place in one global order. A row whose predecessor has the same key and value points to it, and
    log2(longest run) self-joins replace pointers by their pointers' pointers until each is the start of its run. A row
    that points to a start leaves the joins, so no pointer value occurs twice in them: a run that holds a third of all
    rows is spread like any other.
    """
    extra = {"__s": start, "__e": end}
    rows = df.dropna(subset=[*keys, order[0]]).select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
        *[F.col(c).alias(f"__o{i}") for i, c in enumerate(order)],
        F.col(same).alias("__v"),
        *[(F.col(c).cast("long") if c else F.lit(None).cast("long")).alias(n) for n, c in extra.items()],
    )
    ks, os = [f"__k{i}" for i in range(len(keys))], [f"__o{i}" for i in range(len(order))]
    seated = cut(positions(chunked(rows, ks, os, seats=True), "__pos"))
    before = seated.select((F.col("__pos") + 1).alias("__pos"), F.struct(*ks).alias("__pk"), F.col("__v").alias("__pv"))
    linked = seated.join(before, "__pos").where((F.struct(*ks) == F.col("__pk")) & (F.col("__v") == F.col("__pv")))
    nodes = cut(linked.select("__pos", (F.col("__pos") - 1).alias("__to")))
    # a pointer is done if where it points doesn't point on
    ends = nodes.select(F.col("__pos").alias("__to"), F.lit(True).alias("__on"))
    nodes = cut(nodes.join(ends, "__to", "left").select("__pos", "__to", F.col("__on").isNull().alias("__done")))
    while not nodes.where("not __done").isEmpty():
        there = nodes.select(F.col("__pos").alias("__to"), F.col("__to").alias("__next"), F.col("__done").alias("__ended"))
        hops = nodes.where("not __done").join(there, "__to").select("__pos", F.col("__next").alias("__to"), F.col("__ended").alias("__done"))
        nodes = cut(nodes.where("__done").unionByName(hops))
    runs = seated.join(nodes.select("__pos", "__to"), "__pos", "left").withColumn("__run", F.coalesce("__to", "__pos"))
    least, most = F.min(F.least("__s", "__e")), F.max(F.greatest("__s", "__e"))
    spans = [least.alias("first_frame"), most.alias("last_frame"), (most - least + 1).alias("frames")] if start and end else []
    return runs.groupBy("__run", *ks).agg(F.first("__v", ignorenulls=True).alias("run_value"), F.min("__o0").alias(f"first_{order[0]}"), F.max("__o0").alias(f"last_{order[0]}"), F.count(F.lit(1)).alias("events"), *spans).select(
        *[F.col(n).alias(k) for n, k in zip(ks, keys)], "run_value", f"first_{order[0]}", f"last_{order[0]}", "events", *[c for c in ("first_frame", "last_frame", "frames") if spans]
    )
