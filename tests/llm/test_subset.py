import numpy as np
import pytest

from filmstrip.llm.subset import farthest_first, varied_subset

SCHEMA = "v string, id string, image binary, f long, n long, pick string"


def pictures(spark, rows):
    return spark.createDataFrame([(v, i, bytearray(b) if b is not None else None, f, 5, "clash") for v, i, b, f in rows], SCHEMA)


def look(rng, base):
    return bytes(np.clip(base + rng.integers(-4, 5, 144), 0, 255).astype(np.uint8))


def run(spark, rows, sizes, **more):
    s = spark.createDataFrame(sizes, "v string, k int")
    return varied_subset(pictures(spark, rows), s, "v", "id", "image", "f", "k", **more).collect()


def test_farthest_first_is_within_twice_the_best_radius():
    import itertools

    rng = np.random.default_rng(1)
    for _ in range(20):
        x = rng.random((9, 2)).astype(np.float32)
        d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
        best = min(d[:, list(c)].min(1).max() for c in itertools.combinations(range(9), 3))
        order, radius = farthest_first(x, 3)
        assert len(set(order)) == 3 and d[:, order].min(1).max() <= 2 * best + 1e-6
        assert all(a >= b for a, b in zip(radius, radius[1:]))
    assert sorted(farthest_first(np.zeros((4, 2), np.float32), 9)[0]) == [0, 1, 2, 3]


@pytest.mark.parametrize("block,k", [(1024, 12), (64, 12), (64, 100)])
def test_every_look_is_covered_and_the_commonest_not_crowded(spark, block, k):
    """One look has nine tenths of the rows; in one block, in many whose picks are pooled, and with a large number wanted."""
    rng = np.random.default_rng(2)
    bases = [rng.integers(40, 216, 144) for _ in range(10)]
    rows, which = [], {}
    for i in range(800):
        w = 0 if i % 10 else 1 + (i // 10) % 9
        which[f"k{i}"] = w
        rows.append(("hot", f"k{i}", look(rng, bases[w]), i * 3))
    got = run(spark, rows, [("hot", k)], block=block)
    assert len(got) == k == len({r.id for r in got}) and sorted(r.pick for r in got) == list(range(1, k + 1))
    looks = [which[r.id] for r in got]
    assert set(looks) == set(range(10)) and looks.count(0) / k < 0.6


def cover(x, picks):
    return max(min(float(((a - x[p]) ** 2).sum()) for p in picks) for a in x) ** 0.5


@pytest.mark.parametrize("k", [20, 150])
def test_small_blocks_cover_as_well_as_one(spark, k):
    """Looks of very unlike frequency; one block against many, with fewer and with more wanted than a block has pivots."""
    rng = np.random.default_rng(4)
    bases = [rng.integers(40, 216, 144) for _ in range(40)]
    rows = [("hot", f"k{i:04}", look(rng, bases[min(int(rng.exponential(6)), 39)]), i) for i in range(900)]
    x = np.array([[*(b / np.float32(255 * 12) for b in r[2]), r[3] / 899 * 0.15] for r in rows])
    seat = {r[1]: i for i, r in enumerate(rows)}
    one, many = (cover(x, [seat[r.id] for r in run(spark, rows, [("hot", k)], block=b)]) for b in (1024, 64))
    assert many <= 1.3 * one


def test_equal_images_and_several_sizes(spark):
    """Cells of equal rows can't be split further by distance; a key's images are as long as most of its own are."""
    same, other = bytes([100] * 144), bytes([90] * 60)
    rows = [("a", f"{i}", same, 5) for i in range(200)] + [("b", f"{i}", other, i) for i in range(100)] + [("b", "odd", same, 7), ("a", "cut", same[:60], 7)]
    got = run(spark, rows, [("a", 90), ("b", 10)], block=64)
    assert len({(r.v, r.id) for r in got}) == len(got) == 100 and not {"odd", "cut"} & {r.id for r in got}


def test_unusable_rows_and_sizes(spark):
    ok = bytes([100] * 144)
    rows = [("a", "1", ok, 1), ("a", "2", ok, 1), ("a", "3", None, 2), ("a", "4", ok[:50], 3), ("a", "5", bytes([3] * 144), 4), ("a", "6", ok, None), ("b", "7", ok, 1), (None, "8", ok, 1), ("c", "9", ok, 1), ("d", None, ok, 1)]
    rows += [("e", f"e{i}", ok, i) for i in range(20)]
    got = {(r.v, r.id) for r in run(spark, rows, [("a", 5), ("b", 0), ("z", 3), ("d", None), (None, 2)])}
    assert got == {("a", "1"), ("a", "2")}
    assert len(run(spark, rows, [("a", 1)])) == 1 and run(spark, [], [("a", 1)]) == [] and run(spark, rows, []) == []


def test_repeatable(spark):
    rng = np.random.default_rng(3)
    rows = [("a", f"k{i}", look(rng, rng.integers(40, 216, 144)), i) for i in range(200)]
    one, two = ({(r.id, r.pick) for r in run(spark, r, [("a", 7)], block=50)} for r in (rows, rows[::-1]))
    assert one == two
