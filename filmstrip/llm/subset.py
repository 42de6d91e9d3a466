"""A varied subset per group: farthest-first selection in blocks, whose picks are pooled and selected from again."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filmstrip.plans.ordered import chunked, scan
from filmstrip.plans.skew import salted_join
from filmstrip.session import cut

#: Rows of a key that one task measures against its pivots; they are read once for each so many rows.
ASSIGNED = 8192


def farthest_first(x: np.ndarray, k: int, near: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The first k rows in farthest-first order, and how far each was from those before it (infinite for the first).

    The row nearest to the mean begins, as the look of most; then always the row farthest from all chosen ones, the
    first of several. With near, rows are that far from ones chosen elsewhere, and the farthest of them begins. No row
    comes twice, even if all are equal.
    """
    k = min(k, len(x))
    order, radius = np.zeros(k, np.int64), np.full(k, np.inf)
    if not k:
        return order, radius
    sq = np.einsum("ij,ij->i", x, x)
    mean = x.mean(0)
    left = np.full(len(x), np.inf) if near is None else np.square(near, dtype=np.float64)
    now = int(np.argmin(sq - 2 * (x @ mean))) if np.isinf(left).all() else int(np.argmax(left))
    for i in range(k):
        order[i] = now
        radius[i] = np.sqrt(max(left[now], 0.0))
        left = np.minimum(left, np.maximum(sq + sq[now] - 2 * (x @ x[now]), 0))
        left[order[: i + 1]] = -1
        now = int(np.argmax(left))
    return order, radius


def image_sizes(rows: DataFrame, share: float = 0.05) -> list[int]:
    """The lengths in bytes that at least `share` of all images have: 1 / share at most."""
    sizes = rows.groupBy(F.octet_length("image").alias("size")).agg(F.count(F.lit(1)).alias("n")).where("size > 0")
    return sorted(r.size for r in sizes.join(F.broadcast(sizes.agg(F.sum("n").alias("all"))), F.col("n") >= share * F.col("all")).select("size").collect())


def bright_images(df: DataFrame, image: str, dark: float) -> DataFrame:
    """Rows whose image, which isn't empty, has a mean byte of at least `dark`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = batch.column(image).cast(pa.binary())
            if not len(held):
                continue
            ends = np.frombuffer(held.buffers()[1], np.int32)[held.offset : held.offset + len(held) + 1]
            sums = np.add.reduceat(np.frombuffer(held.buffers()[2], np.uint8), ends[:-1], dtype=np.int64)
            yield batch.filter(pa.array(sums >= dark * np.diff(ends)))

    return df.mapInArrow(run, df.schema)


def usable_images(rows: DataFrame, dark: float, image_bytes: int | None) -> DataFrame:
    """Rows (key, image and more) whose image is whole and not dark. Whole images have image_bytes bytes or, if that is
    None, the commonest length of their key, out of those that a twentieth of all images have."""
    sizes = [image_bytes] if image_bytes else image_sizes(rows)
    rows = rows.where(F.octet_length("image").isin(sizes)) if sizes else rows.limit(0)
    if len(sizes) > 1:
        counts = rows.groupBy("key", F.octet_length("image").alias("size")).agg(F.count(F.lit(1)).alias("n"))
        common = counts.groupBy("key").agg(F.max(F.struct("n", "size"))["size"].alias("size"))
        rows = salted_join(rows, common, ["key"], "left_semi", F.octet_length("l.image") == F.col("r.size"))
    return bright_images(rows, "image", dark)


def varied_subset(df: DataFrame, sizes: DataFrame, key: str, row_id: str, image: str, at: str, wanted: str, image_bytes: int | None = None, dark: float = 12.0, time_weight: float = 0.15, block: int = 1024) -> DataFrame:
    """key, row_id, at, pick, radius: per key the `wanted` rows (of sizes) that cover the variety of its images and times.

    Rows are apart by the root mean square of their images' differences (0 to 1), and by their distance in time, of
    which the whole span of the key counts time_weight. Farthest-first selection takes the row that is farthest from
    those chosen, so one look is taken again only when no other is left that is farther off. pick counts from 1; radius
    is the distance to the rows picked before (null for the first).

    Left out are rows with a null in key, row_id, image or at, with an image that isn't whole (see usable_images) or is
    darker than `dark` on average; a key with no more rows than wanted gets them all, with null pick and radius; one
    that is not in sizes or wants none gets nothing. row_id should be unique; equal images at different times are
    different rows. Other columns are ignored.

    No task selects from more than about `block` rows of a key. A key with more is hashed into blocks, each block gives
    a quarter of a block of picks, these are pooled, again if need be, and the last selection is made from the pool. If
    a key wants more than these pivots, its rows are measured against them and fall into cells, each row to its nearest
    pivot; selection goes on within the cells, from the distances to the pivots, in the same way again in a cell of more
    than a block; and the rows with the greatest radius over all cells are picked, after the pivots of greater radius.
    A cell that keeps more than half of its rows, because they are nearer to their old pivot than to any new one, is
    hashed into parts that are selected from each on its own: as new picks don't come nearer to such rows than the old
    pivot is, the parts' picks would hardly change each other's radii. Rows equal to a pivot have radius 0 and come last.
    """
    rows = df.select(F.col(key).alias("key"), F.col(row_id).alias("row_id"), F.col(image).alias("image"), F.col(at).cast("long").alias("at")).dropna()
    rows = cut(usable_images(rows, dark, image_bytes))
    need = sizes.select(F.col(key).alias("key"), F.col(wanted).cast("long").alias("k")).dropna().groupBy("key").agg(F.max("k").alias("k")).where("k > 0")
    facts = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("lo"), F.max("at").alias("hi")).join(need, "key")
    rows = salted_join(rows, cut(facts), ["key"])
    few = F.col("k") >= F.col("n")
    pivots_of = max(block // 4, 1)
    row = {c: rows.schema[c].dataType.simpleString() for c in ("key", "row_id")} | {"image": "binary", "at": "long", "lo": "long", "hi": "long", "k": "long", "cell": "string", "near": "double", "n": "long"}
    picked = {c: row[c] for c in ("key", "row_id", "at", "k")} | {"pick": "long", "radius": "double"}

    def schema(of: dict[str, str]) -> str:
        return ", ".join(f"{c} {t}" for c, t in of.items())

    def points(group: pa.Table) -> np.ndarray:
        pixels = np.frombuffer(b"".join(group.column("image").to_pylist()), np.uint8).reshape(len(group), -1)
        lo, hi = (group.column(c)[0].as_py() for c in ("lo", "hi"))
        times = (group.column("at").to_numpy() - lo) / max(hi - lo, 1) * time_weight
        return np.column_stack([pixels / np.float32(255 * np.sqrt(pixels.shape[1])), times]).astype(np.float32)

    def distances(group: pa.Table) -> np.ndarray:
        return group.column("near").to_numpy(zero_copy_only=False).astype(np.float64)

    def select(count: Callable[[int, int], int], out: dict[str, str]) -> Callable[[pa.Table], pa.Table]:
        """Picks from a group as many rows as count(wanted, rows of the group) says."""

        def run(group: pa.Table) -> pa.Table:
            group = group.sort_by([("at", "ascending"), ("row_id", "ascending")])
            order, radius = farthest_first(points(group), count(group.column("k")[0].as_py(), len(group)), distances(group))
            chosen = group.take(pa.array(order))
            if "pick" in out:
                chosen = chosen.append_column("pick", pa.array(np.arange(1, len(order) + 1))).append_column("radius", pa.array(radius))
            return chosen.select(list(out))

        return run

    def assign(group: pa.Table, pivots: pa.Table) -> pa.Table:
        """The rows that are no pivots, each in the cell of the nearest pivot or, if those are farther, of its old one."""
        group = group.filter(pc.invert(pc.is_in(group.column("row_id"), pivots.column("row_id").combine_chunks())))
        if not len(group):
            return group.select(list(row))
        x, p = points(group), points(pivots)
        apart = np.einsum("ij,ij->i", x, x)[:, None] + np.einsum("ij,ij->i", p, p) - 2 * (x @ p.T)
        nearest = apart.argmin(1)
        to = np.linalg.norm(x - p[nearest], axis=1).astype(np.float64)  # exactly 0 for equal rows
        was = distances(group)
        number = np.where(was <= to, 0, pivots.column("pick").to_numpy()[nearest])
        cell = [f"{c}.{i}" for c, i in zip(group.column("cell").to_pylist(), number.tolist())]
        new = {"cell": pa.array(cell, pa.string()), "near": pa.array(np.minimum(was, to))}
        return pa.table({c: new.get(c, group.column(c)) for c in row})

    def hashed(d: DataFrame, size: int) -> DataFrame:
        return d.withColumn("part", F.pmod(F.xxhash64("row_id", F.col("n")), F.ceil(F.col("n") / size)).cast("int"))

    def counted(d: DataFrame) -> DataFrame:
        """d with n, the rows of its cell, and was, its n before."""
        d = cut(d.withColumnRenamed("n", "was"))
        return cut(salted_join(d, d.groupBy("key", "cell").agg(F.count(F.lit(1)).alias("n")), ["key", "cell"]))

    all_of_it = rows.where(few).select("key", "row_id", "at", F.lit(None).cast("long").alias("pick"), F.lit(None).cast("double").alias("radius"))
    cells = rows.where(~few).withColumn("cell", F.lit("")).withColumn("near", F.lit(float("inf"))).select(*row)
    done, deep, top = [], [], True
    while True:
        ends = cells.where(F.col("n") <= block).groupBy("key", "cell").applyInArrow(select(lambda k, m: k, picked), schema(picked))
        (done if top else deep).append(ends)
        large = cells.where(F.col("n") > block)
        if large.isEmpty():
            break
        pool = large
        while not (over := pool.where(F.col("n") > block)).isEmpty():
            some = hashed(over, block).groupBy("key", "cell", "part").applyInArrow(select(lambda k, m: pivots_of, row), schema(row))
            pool = counted(pool.where(F.col("n") <= block).select(*row).unionByName(some))
        full = picked | {c: row[c] for c in ("image", "lo", "hi", "cell")}
        pivots = cut(pool.groupBy("key", "cell").applyInArrow(select(lambda k, m: min(k, pivots_of), full), schema(full)))
        if top:
            done.append(pivots.where(F.col("k") <= pivots_of).select(*picked))
            large, pivots, top = large.where(F.col("k") > pivots_of), pivots.where(F.col("k") > pivots_of), False
        deep.append(pivots.select(*picked))
        split = hashed(large, ASSIGNED)
        copies = split.groupBy("key", "cell").agg(F.max("part").alias("last")).select("key", "cell", F.explode(F.sequence(F.lit(0), "last")).alias("part"))
        by = ["key", "cell", "part"]
        rest = counted(split.groupBy(*by).cogroup(pivots.join(copies, ["key", "cell"]).groupBy(*by)).applyInArrow(assign, schema(row)))
        deep.append(rest.where("near = 0").select("key", "row_id", "at", "k", F.lit(0).cast("long").alias("pick"), F.lit(0.0).alias("radius")))
        stuck = (F.col("n") > block) & (2 * F.col("n") > F.col("was"))
        part = F.pmod(F.xxhash64("row_id"), F.ceil(F.col("n") / block)).cast("string")
        rest = rest.where("near > 0").withColumn("cell", F.when(stuck, F.concat("cell", F.lit("#"), part)).otherwise(F.col("cell")))
        cells = rest.withColumn("n", F.when(stuck, F.lit(block).cast("long")).otherwise(F.col("n"))).select(*row)
    out = reduce(DataFrame.unionByName, done).select("key", "row_id", "at", "pick", F.when(F.col("radius") < float("inf"), F.col("radius")).alias("radius"))
    if deep:
        order = ["nearness", "row_id"]
        ranked = reduce(DataFrame.unionByName, deep).select("key", "row_id", "at", "k", "radius", (-F.col("radius")).alias("nearness"))
        placed = scan(chunked(ranked, ["key"], order), ["key"], order, sums={"pick": F.lit(1)}).where("pick <= k")
        out = out.unionByName(placed.select("key", "row_id", "at", F.col("pick").cast("long").alias("pick"), F.when(F.col("radius") < float("inf"), F.col("radius")).alias("radius")))
    return out.unionByName(all_of_it).select(F.col("key").alias(key), F.col("row_id").alias(row_id), F.col("at").alias(at), "pick", "radius")
