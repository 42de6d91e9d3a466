import random

from filmstrip.operators import joins


def test_forward_clamped(spark):
    rng = random.Random(4)
    shots = {v: sorted(rng.sample(range(0, 300), 8)) for v in "ab"}
    points = [(f"{v}{i}", v, rng.randrange(330)) for v in "abz" for i in range(40)] + [("n", None, 3), ("m", "a", None)]
    ends = spark.createDataFrame([(v, e, e * 10) for v, es in shots.items() for e in es], "v string, e long, s long")
    got = {r.id: r.s for r in joins.forward_clamped(spark.createDataFrame(points, "id string, v string, t long"), ends, "v", "t", "id", "e", "s").collect()}
    assert got == {i: next((e for e in shots[v] if e >= t), shots[v][-1]) * 10 for i, v, t in points if v in shots and t is not None}


def test_nearest_in_pool(spark):
    events = spark.createDataFrame([(1, "a", 10, [7, 13, 30]), (2, "a", 10, []), (3, "b", 10, None), (4, "a", None, [])], "id long, v string, t long, own array<long>")
    pool = spark.createDataFrame([("a", 8), ("a", 12), ("a", 12), (None, 10), ("a", None)], "v string, f long")
    got = {r.id: r.rep_frame for r in joins.nearest_in_pool(events, pool, "v", "t", "own", "f", "id").collect()}
    assert got == {1: 7, 2: 8, 3: 10, 4: None}


def test_in_interval_keeps_clashing_names(spark):
    p = spark.createDataFrame([("a", 5, 1), ("a", 50, 2)], "v string, t long, start long")
    i = spark.createDataFrame([("a", 0, 9), ("a", 5, 5)], "v string, start long, e long")
    assert joins.in_interval(p, i, "v", "t", "start", "e").count() == 2
    assert joins.in_interval(p, i, "v", "t", "start", "e", "left").count() == 3


def test_upsert(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "k string, x long")
    new = spark.createDataFrame([("b", 3), ("c", 4)], "k string, x long")
    assert {tuple(r) for r in joins.upsert(old, new, ["k"]).select("k", "x", "state").collect()} == {("a", 1, "kept"), ("b", 3, "updated"), ("c", 4, "new")}
    assert joins.remaining(old, new, ["k"]).count() == 1


def test_bins_lose_and_repeat_nothing(spark):
    """Long, short and reversed intervals over many bins, against all pairs."""
    rng = random.Random(6)
    points = [("hot" if rng.random() < 0.7 else rng.choice(["a", None]), rng.randrange(-50, 500) if rng.random() < 0.95 else None, i) for i in range(200)]
    spans = [("hot" if rng.random() < 0.7 else "a", (s := rng.randrange(-50, 500)), s + rng.choice([-3, 0, 5, 70, 300]), i) for i in range(60)]
    p = spark.createDataFrame(points, "k string, t long, id long")
    i = spark.createDataFrame(spans, "k string, s long, e long, n long")
    pairs = sorted((pi, n) for k, t, pi in points for q, s, e, n in spans if k == q and t is not None and s <= t <= e)
    assert sorted((r.id, r.n) for r in joins.in_interval(p, i, "k", "t", "s", "e", width=32).collect()) == pairs
    left = joins.in_interval(p, i, "k", "t", "s", "e", "left", width=32).collect()
    assert sorted((r.id, r.n) for r in left if r.n is not None) == pairs and len(left) == len(pairs) + len(points) - len({a for a, _ in pairs})
    got = {r.n: r.inside for r in joins.collected_in_interval(i, p, ["k"], "s", "e", "t", "inside", width=32).collect()}
    assert got == {n: sorted(t for k, t, _ in points if k == q and t is not None and s <= t <= e) for q, s, e, n in spans}
