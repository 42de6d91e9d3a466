"""A mixture of sources with given shares of all tokens, by systematic sampling."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filmstrip.plans.ordered import chunked, scan
from filmstrip.plans.skew import join_small

TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: how byte-level BPE vocabularies of this family part a text before merging.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def count_tokens(df: DataFrame, text: str, out: str = "tokens", tokenizer: str = TOKENIZER, keep: list[str] | None = None) -> DataFrame:
    """Columns `keep` (all but text if None) and the number of tokens of each text; 0 for null and empty texts.

    tokenizer is the path of a vocabulary with one base64 token and rank a line; every task reads it, so on a cluster it
    must be on each machine or in a shared folder. Texts of any length are counted whole.
    """
    keep = keep if keep is not None else [c for c in df.columns if c != text]
    rows = df.select(*keep, F.col(text).alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "__text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        lines = Path(tokenizer).read_bytes().splitlines()
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        for batch in batches:
            counts = [len(encoding.encode_ordinary(t)) if t else 0 for t in batch.column("__text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(counts, pa.int64())], [*keep, out])

    return rows.mapInArrow(run, f"{schema}, `{out}` long")


def shares(sized: DataFrame, targets: DataFrame, total: int | None = None) -> DataFrame:
    """One row per target source: source, target_share, max_repeats, documents, available (tokens), share (of the
    sources that have tokens), rate (copies expected of each document).

    The mixture is as large as the caps allow, or `total` tokens if that is less. A source without tokens can't
    contribute; the others keep their proportions, so each share is target_share over the sum of those present. Targets
    that are null or not above 0, and sources without a target, contribute nothing.
    """
    have = sized.where("tokens > 0").groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.sum("tokens").alias("available"))
    wanted = targets.groupBy("source").agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats")).dropna(subset=["source"])
    one = wanted.join(have, "source", "left")
    one = one.fillna(0, ["documents", "available", "target_share", "max_repeats"])
    usable = (F.col("available") > 0) & (F.col("target_share") > 0) & (F.col("max_repeats") > 0)
    sums = one.agg(F.sum(F.when(usable, F.col("target_share"))).alias("all"))
    one = one.crossJoin(sums).withColumn("share", F.when(usable, F.col("target_share") / F.col("all")).otherwise(F.lit(0.0))).drop("all")
    most = one.agg(F.min(F.when(usable, F.col("max_repeats") * F.col("available") / F.col("share"))).alias("size"))
    size = F.col("size") if total is None else F.least("size", F.lit(float(total)))
    rate = F.when(usable, F.least(F.col("share") * size / F.col("available"), F.col("max_repeats").cast("double"))).otherwise(F.lit(0.0))
    return one.crossJoin(most).withColumn("rate", rate).drop("size")


def mix(sized: DataFrame, targets: DataFrame, doc_id: str, source: str = "source", tokens: str = "tokens", total: int | None = None, seed: int = 7) -> DataFrame:
    """doc_id, source, tokens, copies for each selected document, copies being at least 1 and at most max_repeats.

    sized has a row per document with its tokens. Within a source, documents lie in the order of their size (ties in an
    order drawn from seed and id) and each takes as much of a line as copies of it are expected; after one offset,
    drawn from seed and source, a document is emitted once for each integer boundary within its part. Neighbours on the
    line are of one size, so a source's tokens miss its share by little more than a document. Documents with a null id
    or source or without tokens take no part. A doc_id that occurs twice counts as two documents.
    """
    rows = sized.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.col(tokens).cast("long").alias("tokens")).dropna().where("tokens > 0")
    rates = shares(rows, targets, total).select("source", "rate", "max_repeats").where("rate > 0")  # a row per target source
    line = join_small(rows, rates, ["source"]).withColumn("mix", F.xxhash64(F.lit(seed), "doc_id")).withColumn("again", F.monotonically_increasing_id())
    order = ["tokens", "mix", "doc_id", "again"]
    # counts are prefix-summed, which is exact; the rate is the same within a source
    placed = scan(chunked(line, ["source"], order), ["source"], order, sums={"n": F.lit(1)})
    offset = F.pmod(F.xxhash64(F.lit(seed), "source"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    crossed = F.floor(F.col("n") * F.col("rate") + offset) - F.floor((F.col("n") - 1) * F.col("rate") + offset)
    copies = F.least(crossed, F.col("max_repeats").cast("long")).alias("copies")
    return placed.select("doc_id", "source", "tokens", copies).where("copies > 0")


def report(sized: DataFrame, targets: DataFrame, mixed: DataFrame, total: int | None = None) -> DataFrame:
    """shares() with what mix() reached: copies, reached_tokens and reached_share of all tokens of the mixture."""
    got = mixed.groupBy("source").agg(F.sum("copies").alias("copies"), F.sum(F.col("copies") * F.col("tokens")).alias("reached_tokens"))
    rows = shares(sized, targets, total).join(got, "source", "left").fillna(0, ["copies", "reached_tokens"])
    everything = rows.agg(F.sum("reached_tokens").alias("all"))
    return rows.crossJoin(everything).withColumn("reached_share", F.coalesce(F.col("reached_tokens") / F.nullif(F.col("all"), F.lit(0)), F.lit(0.0))).drop("all")
