"""Where the phases of a query happen in a scene: similarities by channel, fused ranks, ordered alignment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filmstrip.functions.vectors import cosine, doubles
from filmstrip.operators.align import align, weighted_fusion


def localise(candidates: DataFrame, phases: DataFrame, scene: str, pos: str, phase: str, channels: dict[str, float], count: int, min_gap: int = 8, penalty: float = 0.0) -> DataFrame:
    """scene, path, score. candidates have scene, pos and a vector column a channel; phases have scene, phase (0 to
    count - 1) and the same columns; channels gives their weights. Pairs are made within a scene, whose candidates and
    few phases are bounded. A channel that is null on either side is left out; a scene without any has no row."""
    p = phases.select(F.col(scene).alias("__scene"), F.col(phase).cast("int").alias("phase"), *[doubles(F.col(c)).alias(f"__{c}") for c in channels])
    pairs = candidates.join(p, F.col(scene) == F.col("__scene"))
    sims = F.array(*[F.struct(F.lit(c).alias("channel"), F.lit(float(w)).alias("weight"), cosine(doubles(F.col(c)), F.col(f"__{c}")).alias("sim")) for c, w in channels.items()])
    flat = pairs.select(F.col(scene), F.col(pos).alias("pos"), "phase", F.explode(sims).alias("x")).select(scene, "pos", "phase", "x.*")
    fused = weighted_fusion(flat, [scene, "phase"], "channel", "pos", "sim", "weight")
    wide = fused.groupBy(scene, "pos").agg(*[F.max(F.when(F.col("phase") == i, F.col("fused"))).alias(f"__{i}") for i in range(count)])
    rows = wide.select(scene, "pos", F.array(*[f"__{i}" for i in range(count)]).alias("sims")).dropna(subset=["pos"]).where(F.forall("sims", lambda x: x.isNotNull()))
    return align(rows, [scene], "pos", "sims", count, min_gap, penalty)
