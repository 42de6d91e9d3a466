"""The orphan state fed by a stream's micro-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame

from filmstrip.operators.orphans import Orphans


def follow(state: Orphans, kind: str):  # noqa: ANN201
    """A function for foreachBatch that feeds references, arrived or deleted targets (kind) to the state."""
    if kind not in ("refs", "arrived", "deleted"):
        raise ValueError(kind)

    def each(batch: DataFrame, _: int) -> None:
        state.apply(**{kind: batch})

    return each
