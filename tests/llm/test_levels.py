import numpy as np
import pytest

from filmstrip.llm.levels import Bands, Levels, isotonic, levels

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def graded(spark):
    return [(r.text, r.band) for r in spark.read.parquet(f"{SF}/level_samples.parquet").orderBy("sample_id").collect()]


def test_held_out_samples_get_their_band(graded):
    fitted = Levels(graded)
    x, y = fitted.held
    assert len(x) == len(graded) and np.mean(np.round(fitted.level(x)) == y) > 0.97
    assert (np.diff(fitted.to) >= 0).all() and np.isnan(fitted.level(np.array([np.nan]))[0])


def test_gists_are_of_whole_sentences(graded):
    """Surprisals of the sentence's known words under each band, against a plain loop."""
    m = Bands(graded)
    text = f"{graded[0][0]} zzqx {graded[-1][0]}"
    line = m.codes(text)
    (state,), _, (gist,) = m.decode([line])
    cost, seats = m.surprisal(line >> 1), line >> 1
    a = 0
    for i in range(1, len(line) + 1):
        if i == len(line) or state[i] != state[a]:
            own = [cost[j] for j in range(a, i) if 0 <= seats[j] < len(m.ids)]
            weight = np.exp(-np.mean(own, 0))
            assert gist[a:i] == pytest.approx((weight * np.array(m.bands)).sum() / weight.sum(), rel=1e-9)
            a = i
    assert len(set(gist)) > 1


def test_probabilities_sum_to_one(graded):
    m = Bands(graded[:40])
    n = len(m.ids)
    prev = int(m.pairs[len(m.pairs) // 2] // (n + 1))
    out = [np.exp(-m.surprisal(np.array([prev, w]))[1]) for w in range(n)]
    assert np.allclose(np.sum(out, axis=0), 1, atol=1e-6)


def test_decoding_equals_the_best_path(graded):
    """The vectorised decoder against a plain loop over one text."""
    from filmstrip.llm.levels import AT_END, WITHIN

    m = Bands(graded)
    lines = [np.array([m.piece(p) for p in t.split()[:60]], np.int64) for t, _ in graded[::9]]
    states, _, _ = m.decode(lines)
    for line, state in zip(lines, states):
        cost = m.surprisal(line >> 1)
        total = lambda s: sum(cost[i, b] for i, b in enumerate(s)) + sum((AT_END if line[i] & 1 else WITHIN) for i in range(len(s) - 1) if s[i] != s[i + 1])  # noqa: E731, B023
        score = cost[0].copy()
        for t in range(1, len(line)):
            gate = AT_END if line[t - 1] & 1 else WITHIN
            score = np.minimum(score, score.min() + gate) + cost[t]
        assert total(state) == pytest.approx(score.min(), rel=1e-4)


def test_mixtures_are_measured_by_words(spark, graded):
    """Texts put together from held-out samples of two bands: the share of the hardest band's words."""
    held = graded[::4]
    rest = [g for i, g in enumerate(graded) if i % 4]
    hard, easy = ([t for t, b in held if b == k] for k in (4, 1))
    docs, want = [], {}
    for i, (h, e) in enumerate(zip(hard, easy)):
        for k, share in enumerate((0.3, 0.7)):
            a, b = h.split()[: int(200 * share)], e.split()[: int(200 * (1 - share))]
            docs.append((10 * i + k, " ".join(b + a)))
            want[10 * i + k] = len(a) / (len(a) + len(b))
    got = {r.doc_id: r.top_share for r in levels(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(rest, "text string, band int"), "doc_id", "text").collect()}
    assert np.mean([(got[i] > 0.5) == (w > 0.5) for i, w in want.items()]) == 1
    assert max(abs(got[i] - w) for i, w in want.items()) < 0.15


def test_isotonic():
    at, to = isotonic(np.array([1.0, 2, 3, 4, 4]), np.array([1.0, 3, 2, 4, 6]))
    assert np.interp([1, 2, 3, 4], at, to).tolist() == [1, 2.5, 2.5, 5]


def test_odd_texts(spark, graded):
    g = spark.createDataFrame(graded, "text string, band int").withColumnRenamed("text", "graded_text")
    df = spark.createDataFrame([(1, None), (2, ""), (3, " \n "), (4, "— … 00:14"), (5, "con mèo. " * 20000), (None, "con mèo"), (6, "zzqx wwvk")], "doc_id long, text string")
    got = {r.doc_id: r for r in levels(df, g, "doc_id", "text", "graded_text").collect()}
    assert len(got) == 7 and got[1].words == 0 and got[1].level is None and got[4].level is None
    assert got[5].words == 40000 and got[5].level == pytest.approx(1, abs=0.2)
    assert levels(df.limit(0), g, "doc_id", "text", "graded_text").count() == 0
    with pytest.raises(ValueError, match="no graded samples"):
        levels(df, g.limit(0), "doc_id", "text", "graded_text")
