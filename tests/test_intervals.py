import random

from filmstrip.operators.intervals import sweep

SCHEMA = "k string, s long, e long, start string"


def brute(data):
    """Periods with depth and gaps, frame by frame."""
    out = set()
    for k in {r[0] for r in data if r[0] is not None}:
        spans = [(a, b) for key, a, b in data if key == k and a is not None and b is not None and b >= a]
        if not spans:
            continue
        lo, hi = min(a for a, _ in spans), max(b for _, b in spans)
        depth = [sum(a <= f <= b for a, b in spans) for f in range(lo, hi + 1)]
        f = 0
        while f < len(depth):
            g = f
            while g + 1 < len(depth) and (depth[g + 1] > 0) == (depth[f] > 0):
                g += 1
            out.add((k, "period" if depth[f] else "gap", lo + f, lo + g, max(depth[f : g + 1])))
            f = g + 1
    return out


def run(spark, data):
    df = spark.createDataFrame([(k, s, e, "clash") for k, s, e in data], SCHEMA)
    return [tuple(r) for r in sweep(df, ["k"], "s", "e").select("k", "kind", "start", "end", "depth").collect()]


def test_sweep_against_frames(spark):
    rng = random.Random(3)
    data = [(rng.choice("abc") if rng.random() < 0.95 else None, (s := rng.randrange(200)), s + rng.randrange(-3, 9) if rng.random() < 0.95 else None) for _ in range(150)]
    data += [("hot", s, s + 1) for s in range(0, 600, 3)] + [("hot", 5, 9)] * 40
    got = run(spark, data)
    assert len(got) == len(set(got)) and set(got) == brute(data)


def test_touching_nested_and_repeated(spark):
    assert set(run(spark, [("a", 0, 9), ("a", 10, 19), ("b", 0, 9), ("b", 2, 3), ("b", 11, 11), ("c", 4, 4), ("c", 4, 4)])) == {
        ("a", "period", 0, 19, 1), ("b", "period", 0, 9, 2), ("b", "gap", 10, 10, 0), ("b", "period", 11, 11, 1), ("c", "period", 4, 4, 2)}


def test_empty_and_invalid(spark):
    assert run(spark, []) == []
    assert run(spark, [(None, 1, 2), ("a", 5, 4), ("a", None, 3), ("a", 1, None)]) == []
