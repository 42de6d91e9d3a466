import random
from datetime import datetime, timedelta

from filmstrip.operators.orphans import REF, Orphans, replay
from filmstrip.plans.skew import salted_join
from filmstrip.streaming.orphans import follow

T0 = datetime(2025, 1, 1)
REFS = "child_table string, child_id long, ref_field string, key string, ref_at timestamp"
TARGETS = "key string, from_at timestamp, until_at timestamp"


def at(h):
    return None if h is None else T0 + timedelta(hours=h)


def expected(refs, targets, grace=48):
    served = lambda key, t: any(k == key and f <= t + grace and (u is None or u > t) for k, f, u in targets)
    return {i for i, key, t in refs if not served(key, t)}


def frames(spark, refs, targets):
    r = spark.createDataFrame([("c", i, "k", key, at(t)) for i, key, t in refs], REFS)
    return r, spark.createDataFrame([(k, at(f), at(u)) for k, f, u in targets], TARGETS)


def test_replay_equals_direct_test(spark):
    rng = random.Random(1)
    refs = [(i, rng.choice(["hot"] * 4 + list("abcdef")), rng.randrange(2000)) for i in range(300)]
    targets = [(k, f := rng.randrange(2000), f + rng.randrange(500) if rng.random() < 0.5 else None) for k in ["hot", *"abcde"]] + [("hot", 1500, None)]
    r, t = frames(spark, refs, targets)
    state = replay(r, t, [at(500), at(1000), at(1500)])
    assert {x.child_id for x in state.waiting.collect()} == expected(refs, targets)
    counts = state.report(spark).collect()
    for cut in (500, 1000, 1500, None):
        known = [x for x in refs if cut is None or x[2] < cut]
        there = [(k, f, u if u is not None and (cut is None or u < cut) else None) for k, f, u in targets if cut is None or f < cut]
        assert sum(c.orphans for c in counts if c.as_of == at(cut)) == len(expected(known, there))
    assert state.segments[0].refs is None and state.segments[-1].refs is not None


def test_only_segments_in_reach_are_written_again(spark):
    r, t = frames(spark, [(1, "a", 10), (2, "b", 500)], [("b", 520, None)])
    state = Orphans().apply(refs=r.where("child_id = 1")).apply(refs=r.where("child_id = 2"))
    old = state.segments[0].waiting
    state.apply(arrived=t)
    assert state.segments[0].waiting is old and {x.child_id for x in state.waiting.collect()} == {1}
    state.apply(deleted=spark.createDataFrame([("b", at(520), at(499))], TARGETS))
    assert state.segments[0].waiting is old and {x.child_id for x in state.waiting.collect()} == {1, 2}


def test_arrival_resolves_and_deletion_reopens(spark):
    refs, targets = [(1, "a", 10), (2, "a", 100), (3, "b", 10)], []
    r, t = frames(spark, refs, [("a", 40, None), ("b", 90, None)])
    state = Orphans().apply(refs=r)
    assert {x.child_id for x in state.waiting.collect()} == {1, 2, 3}
    state.apply(arrived=t)
    assert {x.child_id for x in state.waiting.collect()} == {3}  # b came after more than 48 hours
    gone = spark.createDataFrame([("a", at(40), at(60))], TARGETS)
    state.apply(deleted=gone)
    assert {x.child_id for x in state.waiting.collect()} == {2, 3}
    state.apply(arrived=spark.createDataFrame([("a", at(99), None)], TARGETS))
    assert {x.child_id for x in state.waiting.collect()} == {3}
    assert state.waiting.select(*REF).columns == REF


def test_empty_batches(spark):
    r, t = frames(spark, [], [])
    state = Orphans().apply(refs=r, arrived=t).apply(deleted=t)
    assert state.waiting is None and state.report(spark).count() == 0


def test_stream_batches_feed_the_state(spark, tmp_path):
    r, t = frames(spark, [(1, "a", 10), (2, "z", 10)], [("a", 5, None)])
    state = Orphans()
    follow(state, "arrived")(t, 0)
    follow(state, "refs")(r, 0)
    assert {x.child_id for x in state.waiting.collect()} == {2}


def test_salted_join_equals_plain(spark):
    left = spark.createDataFrame([("hot", i) for i in range(60)] + [("a", 1), (None, 2), ("zz", 3)], "k string, i long")
    right = spark.createDataFrame([("hot", "x"), ("a", "y"), (None, "n"), ("a", "y2")], "k string, v string")
    for how in ("inner", "left", "left_semi", "left_anti"):
        got = sorted(map(tuple, salted_join(left, right, ["k"], how, rows=7).collect()), key=str)
        want = sorted(map(tuple, left.join(right, "k", how).select(*(["k", "i"] if "_" in how else ["k", "i", "v"])).collect()), key=str)
        assert got == want, how
