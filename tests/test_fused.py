import math
import os
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pytest

from filmstrip.catalog import retrieval
from filmstrip.functions.models import hashed_words
from filmstrip.operators.fused import fused_top
from filmstrip.session import work_folder


def used(folder):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(folder.removeprefix("file:")) for f in files)


def test_hybrid_search_keeps_no_pairs_of_query_and_document(spark):
    rng = np.random.default_rng(5)
    text = lambda n: " ".join(f"w{k}" for k in rng.integers(0, 40, n))
    tables = {"documents": spark.createDataFrame([(i, text(12)) for i in range(1500)], "doc_id long, text string"), "kis_queries": spark.createDataFrame([(f"q{i}", text(6)) for i in range(40)], "query_id string, query string")}
    before = used(work_folder(spark))
    hits = retrieval.hybrid_search(SimpleNamespace(raw=tables.get))
    assert hits.count() == 400
    assert used(work_folder(spark)) - before < 40 * 1500 * 10  # 10 bytes a pair


def brute(docs, asked, vectors, top):
    """Places are counted over all documents, from scores of nine places."""
    split = {i: t.split() for i, t in docs}
    worded = [t for t in split.values() if t]
    mean, df = sum(map(len, worded)) / len(worded), Counter(w for t in worded for w in set(t))
    want = {}
    for q, text in asked:
        words, near, fused = {}, {}, defaultdict(float)
        for i, t in split.items():
            if i is None:
                continue
            tf = Counter(t)
            s = sum(math.log(1 + (len(worded) - df[w] + 0.5) / (df[w] + 0.5)) * tf[w] * 2.2 / (tf[w] + 1.2 * (0.25 + 0.75 * len(t) / mean)) for w in sorted(set((text or "").split()) & set(tf)))
            if s:
                words[i] = s
            if vectors.get(i) is not None:
                near[i] = float(np.dot(vectors[i], vectors[q]))
        for channel in (words, near):
            for r, i in enumerate(sorted(channel, key=lambda i: (-round(channel[i], 9), i))):
                fused[i] += 1 / (60 + r)
        want[q] = [(i, round(s, 12)) for i, s in sorted(fused.items(), key=lambda x: (-x[1], x[0]))[:top]]
    return {q: x for q, x in want.items() if x}


@pytest.mark.parametrize("rows, ids", [("20000", "long"), ("80", "long"), ("20000", "string")])
def test_fused_top_equals_whole_lists(spark, rows, ids):
    """Few words, so that hundreds of documents tie; blocks of two queries or one of all; a query without words; a
    document without an id; vectors of NaN."""
    rng = np.random.default_rng(7)
    name = (lambda i: i) if ids == "long" else (lambda i: f"é{i}")
    docs = [(name(i), " ".join(f"w{k}" for k in rng.integers(0, 9, rng.integers(1, 5)))) for i in rng.permutation(700).tolist()]
    docs += [(None, "w1 w2"), (name(900), "..."), (name(901), "w1 nothing")]
    asked = [("a", "w1"), ("b", "w2 w3 w3"), ("c", None), ("d", "w0 w1 w2 w4 w5 w6"), ("e", "unknown")]
    d, q = spark.createDataFrame(docs, f"doc_id {ids}, text string"), spark.createDataFrame(asked, "query_id string, query string")
    model = lambda: lambda texts: np.where([["nothing" in (t or "")] for t in texts], np.nan, hashed_words(8)(texts)) if len(texts) else np.zeros((0, 8))
    vectors = {i: v for (i, t), v in zip(docs + asked, model()([t for _, t in docs + asked])) if not np.isnan(v).any()}
    spark.conf.set("filmstrip.broadcastRows", rows)
    try:
        got = defaultdict(list)
        for r in fused_top(d.repartition(5), q, "doc_id", "text", "query_id", "query", model, 10).orderBy("query_id", "rank").collect():
            got[r.query_id].append((r.cand, round(r.fused, 12)))
        assert fused_top(d.limit(0), q, "doc_id", "text", "query_id", "query", model, 10).count() == 0
        assert fused_top(d, q.limit(0), "doc_id", "text", "query_id", "query", model, 10).count() == 0
    finally:
        spark.conf.unset("filmstrip.broadcastRows")
    plain = [(i, t.replace("...", "")) for i, t in docs]
    assert dict(got) == brute(plain, asked, vectors, 10)
