import random

from pyspark.sql import functions as F

from filmstrip.operators import folds


def groups(spark, n=25, size=12, seed=2):
    rng = random.Random(seed)
    data = {g: sorted({rng.randrange(300): round(rng.random(), 3) for _ in range(rng.randrange(1, size))}.items()) for g in range(n)}
    df = spark.createDataFrame([(g, f, y) for g, items in data.items() for f, y in items], "g long, f long, y double")
    return data, folds.collected(df, ["g"], ["f"], ["f", "y"])


def apart(a, b):
    return F.abs(a["y"] - b["y"])


def got(df, expr):
    return {r.g: [tuple(x) if not isinstance(x, (int, float)) else x for x in r.x] for r in df.select("g", expr.alias("x")).collect()}


def test_distinct_from_all(spark):
    data, df = groups(spark)
    want = {}
    for g, items in data.items():
        kept = []
        for f, y in items:
            if not kept or all(abs(y - z) > 0.2 for _, z in kept):
                kept.append((f, y))
        want[g] = kept
    assert got(folds.distinct_from_all(df, apart, 0.2), F.col("kept")) == want


def test_suppression(spark):
    data, df = groups(spark)
    df = df.withColumn("items", F.array_sort(F.transform("items", lambda x: F.struct((-x["y"]).alias("w"), x["f"].alias("f"), x["y"].alias("y")))))
    want = {}
    for g, items in data.items():
        kept = []
        for y, f in sorted((-y, f) for f, y in items):
            if len(kept) < 3 and all(abs(f - k) >= 40 for k in kept):
                kept.append(f)
        want[g] = kept
    assert got(folds.suppressed(df, lambda x: x["f"], 40, 3), F.transform("kept", lambda x: x["f"])) == want
    assert all(not v for v in got(folds.suppressed(df, lambda x: x["f"], 40, 0), F.transform("kept", lambda x: x["f"])).values())


def test_fill_gaps(spark):
    data, df = groups(spark, size=20)
    want = {}
    for g, items in data.items():
        frames = [f for f, _ in items]
        kept = frames[:: max(1, len(frames) // 3)]
        out = []
        for i, a in enumerate(kept):
            out.append(a)
            if i + 1 < len(kept):
                b, last = kept[i + 1], a
                while b - last > 30:
                    rest = [c for c in frames if last < c < b]
                    if not rest:
                        break
                    last = min(rest, key=lambda c: (abs(c - last - 30), c))
                    out.append(last)
        want[g] = out
    frames = F.transform("items", lambda x: x["f"])
    n = F.greatest(F.lit(1), F.floor(F.size("items") / 3).cast("int"))
    kept = F.filter(frames, lambda x, i: i % n == 0)
    assert got(df, folds.fill_gaps(kept, frames, 30)) == want


def test_arc_targets(spark):
    data, df = groups(spark)
    want = {}
    for g, items in data.items():
        cum, total = [], 0.0
        for _, y in items:
            total += y
            cum.append(total)
        out = []
        for k in range(5):
            i = next((j for j, c in enumerate(cum) if c >= total * k / 4), None)
            if i is not None and (not out or i - out[-1] >= 2):
                out.append(i)
        want[g] = sorted({*out, len(cum) - 1})
    cum = F.aggregate("items", F.array().cast("array<double>"), lambda a, x: F.concat(a, F.array(F.coalesce(F.try_element_at(a, F.lit(-1)), F.lit(0.0)) + x["y"])))
    assert got(df.withColumn("cum", cum), folds.arc_targets(F.col("cum"), F.lit(5), 2)) == want


def test_max_min(spark):
    data, df = groups(spark)
    want = {}
    for g, items in data.items():
        kept = [items[len(items) // 2]]
        while len(kept) < 3:
            free = [x for x in items if all(abs(x[0] - k[0]) >= 20 for k in kept)]
            best = max(free, key=lambda x: (min(abs(x[1] - k[1]) for k in kept), -x[0]), default=None)
            if best is None or min(abs(best[1] - k[1]) for k in kept) < 0.25:
                break
            kept.append(best)
        want[g] = sorted(kept)
    assert got(folds.max_min_picks(df, apart, lambda x: x["f"], 3, 0.25, 20), F.col("kept")) == want


def test_fill_gaps_stops_at_likeness_and_anchors_the_end(spark):
    data, df = groups(spark, size=20, seed=9)
    want = {}
    for g, items in data.items():
        kept = []
        for x in items:
            if not kept or all(abs(x[1] - k[1]) > 0.3 for k in kept):
                kept.append(x)
        if items[-1][0] - kept[-1][0] > 30:
            kept.append(items[-1])
        out = []
        for i, a in enumerate(kept):
            out.append(a)
            last = a
            while i + 1 < len(kept) and kept[i + 1][0] - last[0] > 30:
                rest = [c for c in items if last[0] < c[0] < kept[i + 1][0]]
                best = min(rest, key=lambda c: (abs(c[0] - last[0] - 30), c[0]), default=None)
                if best is None or abs(best[1] - last[1]) <= 0.1:
                    break
                out.append(best)
                last = best
        want[g] = out
    rows = folds.distinct_from_all(df, apart, 0.3)
    assert got(rows, folds.fill_gaps(F.col("kept"), F.col("items"), 30, lambda x: x["f"], apart, 0.1, anchor_last=True)) == want
