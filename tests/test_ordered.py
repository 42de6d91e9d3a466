import random

from pyspark.sql import functions as F

from filmstrip.plans.ordered import chunked, positions, scan


def test_scan_over_a_hot_key(spark):
    rng = random.Random(5)
    data = [("hot" if rng.random() < 0.6 else rng.choice("abcd"), i, rng.randrange(9), rng.randrange(5) if rng.random() < 0.3 else None) for i in range(500)]
    df = spark.createDataFrame(data, "k string, i long, x long, v long")
    out = scan(chunked(df, ["k"], ["i"]), ["k"], ["i"], sums={"s": F.col("x")}, last={"l": F.col("v")}, following={"n": F.col("v")}).collect()
    assert len(out) == len(data) and len({r["__chunk"] for r in out if r.k == "hot"}) > 1
    for r in out:
        own = sorted(d for d in data if d[0] == r.k)
        before, after = [d for d in own if d[1] <= r.i], [d for d in own if d[1] >= r.i]
        assert r.s == sum(d[2] for d in before)
        assert r.l == next((d[3] for d in reversed(before) if d[3] is not None), None)
        assert r.n == next((d[3] for d in after if d[3] is not None), None)


def test_positions(spark):
    df = spark.createDataFrame([(i * 7 % 101,) for i in range(101)], "i long")
    assert all(r.i == r.p for r in positions(chunked(df, [], ["i"], seats=True), "p").collect())
    assert positions(chunked(df.limit(0), [], ["i"], seats=True), "p").count() == 0
