import random

from filmstrip.llm.nearest import nearest_pairs


def run(spark, left, right, within=40):
    a = spark.createDataFrame([(*r, "clash") for r in left], "id long, v string, t long, rid string")
    b = spark.createDataFrame([(*r, 1) for r in right], "kid string, v string, t long, side int")
    return sorted(tuple(r) for r in nearest_pairs(a, b, "v", "t", "id", "v", "t", "kid", within).collect())


def test_against_all_pairs(spark):
    rng = random.Random(2)
    pick = lambda: rng.choice(["hot"] * 3 + ["a", "b", None])
    left = [(i if rng.random() < 0.97 else None, pick(), rng.randrange(3000) if rng.random() < 0.97 else None) for i in range(300)]
    right = [(f"k{i:03d}" if rng.random() < 0.97 else None, pick(), rng.randrange(3000) if rng.random() < 0.97 else None) for i in range(150)]
    want = []
    for i, v, t in left:
        near = [(abs(f - t), f, k) for k, w, f in right if None not in (i, v, t, k, f) and w == v and abs(f - t) <= 40]
        if near:
            d, _, k = min(near)
            want.append((i, k, d))
    assert run(spark, left, right) == sorted(want)


def test_ties_repeats_and_empty(spark):
    right = [("b", "x", 10), ("a", "x", 10), ("c", "x", 30)]
    assert run(spark, [(1, "x", 20), (1, "x", 20), (2, "x", 71), (3, "x", 70)], right) == [(1, "a", 10), (1, "a", 10), (3, "c", 40)]
    assert run(spark, [], right) == [] and run(spark, [(1, "x", 20)], []) == []
