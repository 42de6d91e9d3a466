"""Daily quotas and cooldowns as keyed state of a stream."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

DAY = 86_400.0


def grant(requests: pd.DataFrame, first: float, used: int, until: float, limit: int, cooldown: float) -> tuple[list[bool], tuple[float, int, float]]:
    """Which of the requests (at, failed; in order) are granted, and the state after them: the day's first request, those
    granted since, and the end of the cooldown. A day begins with the first request after the last day's end."""
    out = []
    for at, failed in zip(requests["at"], requests["failed"]):
        if first < 0 or at - first >= DAY:
            first, used = at, 0
        ok = used < limit and at >= until
        used += ok
        if ok and failed:
            until = at + cooldown
        out.append(bool(ok))
    return out, (first, used, until)


def quota(stream: DataFrame, key: str, limit: int, cooldown: float = 60.0) -> DataFrame:
    """key, request_id, granted for a stream of key, request_id, at (seconds), failed. A key has `limit` requests a day
    and pauses for `cooldown` seconds after one that failed. Keys are clients, whose requests are bounded by quotas."""

    def run(k: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        first, used, until = state.get if state.exists else (-1.0, 0, 0.0)
        rows = pd.concat(list(parts)).sort_values(["at", "request_id"])
        ok, after = grant(rows, first, used, until, limit, cooldown)
        state.update(after)
        yield pd.DataFrame({key: k[0], "request_id": rows["request_id"].to_numpy(), "granted": ok})

    kind = stream.schema[key].dataType.simpleString()
    return stream.groupBy(key).applyInPandasWithState(run, f"{key} {kind}, request_id long, granted boolean", "first double, used long, until double", "append", GroupStateTimeout.NoTimeout)


def rest(base: float, now: float, served: float, before: float) -> float:
    """How long to rest before the next wave: half as long again (six times the base at most) after a productive wave of
    which less than 30 % was served now, about a third of the base if nothing was productive."""
    if before <= 0:
        return 0.35 * base
    return min(6 * base, 1.5 * now) if served < 0.3 else base
