"""Text and vector search: an inverted index with BM25, exact cosine top-k, and their fusion."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filmstrip.functions.vectors import doubles, normalised
from filmstrip.operators.align import reciprocal_fusion
from filmstrip.plans.skew import fits
from filmstrip.session import broadcast_limit, cut, partitions

K1, B = 1.2, 0.75


def terms(text: Column) -> Column:
    """Lower-case words: runs of letters and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def inverted_index(docs: DataFrame, doc_id: str, fields: list[str]) -> DataFrame:
    """field, term, doc_id, tf, len: one row per term of a document's field, with the field's length in terms."""
    parts = [docs.select(F.lit(f).alias("field"), F.col(doc_id).alias("doc_id"), terms(F.col(f)).alias("t")) for f in fields]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    rows = rows.where(F.size("t") > 0)
    return rows.select("field", "doc_id", F.size("t").alias("len"), F.explode("t").alias("term")).groupBy("field", "term", "doc_id", "len").agg(F.count(F.lit(1)).alias("tf"))


def bm25(docs: DataFrame, queries: DataFrame, doc_id: str, fields: list[str], query_id: str, query: str, top: int | None, keep: Column | None = None) -> DataFrame:
    """query_id, doc_id, score, rank: the `top` best documents for each query by the best of their fields' BM25 scores
    (ties to the lower id); without top, all documents with a word of the query, and no rank. With keep, a test of
    docs' columns (such as a keyword's equality), only documents that pass it are answers.

    Texts are split once: terms that no query has leave the scan as one row a document, which tells its length. The
    queries' terms are counted and broadcast up to the session's limit, else joined. Frequencies are of all documents,
    also of those that `keep` leaves out.
    """
    asked = queries.select(F.col(query_id).alias("query_id"), F.explode(F.array_distinct(terms(F.col(query)))).alias("term"))
    small = fits(asked)
    words = asked.select("term").distinct().withColumn("asked", F.lit(True))
    kept = F.coalesce(keep, F.lit(False)) if keep is not None else F.lit(True)
    parts = reduce(DataFrame.unionByName, [docs.select(F.lit(f).alias("field"), F.col(doc_id).alias("doc_id"), kept.alias("kept"), terms(F.col(f)).alias("t")) for f in fields]).where(F.size("t") > 0)
    flat = parts.select("field", "doc_id", "kept", F.size("t").alias("len"), F.explode(F.array_append("t", F.lit(""))).alias("term"))  # no term is empty
    flat = flat.join(F.broadcast(words) if small else words, "term", "left").withColumn("term", F.when(F.col("asked"), F.col("term")))
    tf = cut(flat.groupBy("field", "term", "doc_id", "kept", "len").agg(F.count(F.lit(1)).alias("tf")))
    stats = tf.where("term is null").groupBy("field").agg(F.count(F.lit(1)).alias("n_docs"), F.avg("len").alias("avg_len"))  # a row a field
    tf = tf.where("term is not null")
    df = tf.groupBy("field", "term").agg(F.count(F.lit(1)).alias("df"))
    weighed = tf.where("kept").join(F.broadcast(df) if small else df, ["field", "term"]).join(F.broadcast(stats), "field")
    idf = F.log(1 + (F.col("n_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    gain = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("len") / F.col("avg_len")))
    weighed = weighed.select("field", "term", "doc_id", gain.alias("gain"))
    scored = weighed.join(F.broadcast(asked) if small else asked, "term").groupBy("query_id", "field", "doc_id").agg(F.sum("gain").alias("s"))
    best = scored.groupBy("query_id", "doc_id").agg(F.max("s").alias("score"))
    if top is None:
        return best
    return top_per_key(best, ["query_id"], [F.desc(F.round("score", 9)), F.asc("doc_id")], top)  # sums differ in their last digits


def top_per_key(df: DataFrame, key: list[str], order: list[Column], top: int) -> DataFrame:
    """df's `top` first rows of each key with their rank. Spark keeps `top` rows a key before the shuffle."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where(F.col("rank") <= top)


def cosine_top(rows: DataFrame, queries: DataFrame, row_id: str, vector: str, query_id: str, query_vector: str, top: int | None, same: bool = False) -> DataFrame:
    """query_id, row_id, score, rank: the exact `top` nearest rows of each query by cosine (ties, to twelve places, to the
    lower id); with same, a row may be its own answer. Without top, every row with each query, and no rank. Null vectors
    take no part, nor do rows whose vector is of another length than the queries'.

    The queries are a stated set; blocks of at most the session's broadcast limit of them go to all rows, so a larger set
    is more passes and never a larger broadcast. In a pass, each batch of rows is multiplied with the block as a matrix,
    and only what may be among the `top` of a query leaves the batch.
    """
    q = queries.select(F.col(query_id).alias("query_id"), normalised(doubles(F.col(query_vector))).alias("q")).dropna()
    r = rows.select(F.col(row_id).alias("row_id"), normalised(doubles(F.col(vector))).alias("v")).dropna()
    limit = max(1, broadcast_limit(rows.sparkSession) // 4)
    blocks = max(1, -(-q.count() // limit))
    schema = f"query_id {q.schema['query_id'].dataType.simpleString()}, row_id {r.schema['row_id'].dataType.simpleString()}, score double"
    out = None
    for k in range(blocks):
        mine = q.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == k) if blocks > 1 else q
        held = mine.toArrow()  # a block
        size = held.column("q").combine_chunks().value_lengths()[0].as_py() if len(held) else 0
        pairs = r.where(F.size("v") == size).mapInArrow(_products(held.filter(pc.equal(pc.list_value_length(held.column("q")), size)), size, top, same), schema)
        part = pairs if top is None else top_per_key(pairs, ["query_id"], [F.desc(F.round("score", 12)), F.asc("row_id")], top)
        out = part if out is None else out.unionByName(part)
    return out


def _products(held: pa.Table, size: int, top: int | None, same: bool):  # noqa: ANN202
    ids = held.column("query_id").combine_chunks()
    names = ids.to_numpy(zero_copy_only=False)[None, :]
    matrix = held.column("q").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(held), size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = b.column("v").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, size)
            score = v @ matrix.T
            own = np.zeros(score.shape, bool) if same else b.column("row_id").to_numpy(zero_copy_only=False)[:, None] == names
            score[own] = -np.inf
            keep = ~own
            if top is not None and b.num_rows > top:
                keep &= score >= np.partition(score, b.num_rows - top, axis=0)[b.num_rows - top] - 1e-11
            i, j = np.nonzero(keep)
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(j)), b.column("row_id").take(pa.array(i)), pa.array(score[i, j])], ["query_id", "row_id", "score"])

    return run


def hybrid(ranked: list[tuple[DataFrame, float]], top: int, k: int = 60) -> DataFrame:
    """query_id, cand, fused, rank: lists of (query_id, cand, score) with weights, fused by reciprocal rank. What
    is missing from a list gets no share of it, so whole lists give the exact result. They are shuffled once, by query."""
    rows = None
    for i, (df, weight) in enumerate(ranked):
        part = df.select("query_id", "cand", "score", F.lit(i).alias("channel"), F.lit(float(weight)).alias("weight"))
        rows = part if rows is None else rows.unionByName(part)
    rows = rows.repartition(partitions(rows.sparkSession), "query_id")
    return top_per_key(reciprocal_fusion(rows, ["query_id"], "channel", "cand", "score", "weight", k), ["query_id"], [F.desc("fused"), F.asc("cand")], top)
