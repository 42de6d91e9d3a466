import math
import re
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pytest
import xxhash

from filmstrip.catalog import retrieval
from filmstrip.operators import search

DOCS = [(1, "Một con mèo, con chó", "OPEN"), (2, "con mèo ngủ", None), (3, "", ""), (4, None, "mèo mèo"), (5, "xe đạp", "mèo"), (6, "con mèo ngủ", None)]
QUERIES = [("a", "con mèo"), ("b", "xe"), ("c", ""), ("d", None)]


def brute(fields, top):
    out = {}
    words = lambda t: [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]
    for q, text in QUERIES:
        best = defaultdict(float)
        for f in fields:
            docs = {d[0]: words(d[1 + f]) for d in DOCS if words(d[1 + f])}
            mean = sum(map(len, docs.values())) / len(docs)
            df = Counter(w for ws in docs.values() for w in set(ws))
            for i, ws in docs.items():
                tf, s = Counter(ws), 0.0
                for w in set(words(text)) & set(ws):
                    s += math.log(1 + (len(docs) - df[w] + 0.5) / (df[w] + 0.5)) * tf[w] * 2.2 / (tf[w] + 1.2 * (0.25 + 0.75 * len(ws) / mean))
                if s:
                    best[i] = max(best[i], s)
        out[q] = sorted(best.items(), key=lambda x: (-round(x[1], 9), x[0]))[:top]
    return {q: r for q, r in out.items() if r}


@pytest.mark.parametrize("rows", ["20000", "0"])
def test_bm25_over_two_fields(spark, rows):
    d = spark.createDataFrame(DOCS, "id long, caption string, seen string")
    q = spark.createDataFrame(QUERIES, "q string, t string")
    spark.conf.set("filmstrip.broadcastRows", rows)
    try:
        got = defaultdict(list)
        for r in search.bm25(d, q, "id", ["caption", "seen"], "q", "t", 3).orderBy("query_id", "rank").collect():
            got[r.query_id].append((r.doc_id, pytest.approx(r.score)))
    finally:
        spark.conf.unset("filmstrip.broadcastRows")
    assert dict(got) == brute((0, 1), 3)
    assert search.bm25(d.limit(0), q, "id", ["caption"], "q", "t", 3).count() == 0


@pytest.mark.parametrize("rows", ["20000", "20"])
def test_cosine_in_blocks_equals_numpy(spark, rows):
    x = np.random.default_rng(1).normal(size=(40, 6))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    u = x / np.linalg.norm(x, axis=1)[:, None]
    want = {(i, int(j)) for i in range(12) for j in [k for k in np.argsort(-(u @ u[i]), kind="stable") if k != i][:4]}
    spark.conf.set("filmstrip.broadcastRows", rows)
    try:
        got = {(r.query_id, r.row_id) for r in search.cosine_top(df, df.where("id < 12"), "id", "v", "id", "v", 4).collect()}
    finally:
        spark.conf.unset("filmstrip.broadcastRows")
    assert got == want


def test_hybrid_rewards_agreement(spark):
    a = spark.createDataFrame([("q", 1, 3.0), ("q", 2, 2.0), ("q", 3, 1.0)], "query_id string, cand long, score double")
    b = spark.createDataFrame([("q", 2, 0.9), ("q", 4, 0.8)], "query_id string, cand long, score double")
    assert [r.cand for r in search.hybrid([(a, 1.0), (b, 1.0)], 2).orderBy("rank").collect()] == [2, 1]


def test_hybrid_search_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    docs = [(i, " ".join(f"w{k}" for k in rng.integers(0, 40, rng.integers(3, 30)))) for i in range(150)]
    asked = [(f"q{i}", " ".join(f"w{k}" for k in rng.integers(0, 40, 4))) for i in range(4)]

    def vector(text):
        v = np.zeros(64)
        for w in text.split():
            h = xxhash.xxh3_64_intdigest(w)
            v[h % 64] += 1.0 if h >> 63 else -1.0
        return v / max(np.linalg.norm(v), 1e-8)

    tables = {"documents": spark.createDataFrame(docs, "doc_id long, text string"), "kis_queries": spark.createDataFrame(asked, "query_id string, query string")}
    got = defaultdict(list)
    for r in retrieval.hybrid_search(SimpleNamespace(raw=tables.get)).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.cand, round(r.fused, 12)))
    mean, df = sum(len(t.split()) for _, t in docs) / len(docs), Counter(w for _, t in docs for w in set(t.split()))
    want = {}
    for q, text in asked:
        words, near, fused = {}, {}, defaultdict(float)
        for i, t in docs:
            tf = Counter(t.split())
            s = sum(math.log(1 + (len(docs) - df[w] + 0.5) / (df[w] + 0.5)) * tf[w] * 2.2 / (tf[w] + 1.2 * (0.25 + 0.75 * len(t.split()) / mean)) for w in set(text.split()) & set(tf))
            if s:
                words[i] = s
            near[i] = float(vector(t) @ vector(text))
        for channel in (words, near):
            for r, i in enumerate(sorted(channel, key=lambda i: (-round(channel[i], 9), i))):
                fused[i] += 1 / (60 + r)
        want[q] = [(i, round(s, 12)) for i, s in sorted(fused.items(), key=lambda x: (-x[1], x[0]))[:10]]
    assert dict(got) == want
