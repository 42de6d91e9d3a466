import pytest
from pyspark.sql import functions as F

from filmstrip.llm.mix import count_tokens, mix, report, shares


def sized(spark, n=3000):
    """A hot source with a third of all documents, a small one, one without target, one absent."""
    return spark.range(n).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 30 == 1, "small").when(F.col("id") % 30 == 2, F.lit(None)).otherwise("rest").alias("source"), (F.pmod(F.xxhash64("id"), F.lit(400)) + 1).alias("tokens"))


def targets(spark):
    return spark.createDataFrame([("hot", 0.5, 2), ("small", 0.2, 4), ("rest", 0.2, 1), ("absent", 0.1, 5)], "source string, target_share double, max_repeats int")


def test_shares_are_met_and_caps_hold(spark):
    df = sized(spark)
    m = mix(df, targets(spark), "doc_id")
    got = {r.source: r for r in report(df, targets(spark), m).collect()}
    for s, share in (("hot", 0.5), ("small", 0.2), ("rest", 0.2)):
        assert got[s].reached_share == pytest.approx(share / 0.9, abs=0.002)
    assert got["absent"].reached_share == 0 and got["absent"].documents == 0
    caps = {r.source: r.c for r in m.groupBy("source").agg(F.max("copies").alias("c")).collect()}
    assert caps["small"] == 4 and caps["hot"] <= 2 and caps["rest"] <= 1
    assert max(r.rate / r.max_repeats for r in got.values()) == pytest.approx(1)  # as large as the caps allow


def test_copies_are_the_boundaries_crossed(spark):
    """Each document of a source gets the rate's whole part or one more, and a source's copies miss n * rate by one at most."""
    df = sized(spark)
    rates = {r.source: r for r in shares(df, targets(spark)).collect()}
    for r in mix(df, targets(spark), "doc_id").groupBy("source").agg(F.sum("copies").alias("n"), F.min("copies").alias("lo"), F.max("copies").alias("hi")).collect():
        rate = rates[r.source].rate
        assert abs(r.n - rate * rates[r.source].documents) <= 1 and r.hi <= -(-rate // 1)


def test_repeatable_and_seeded(spark):
    df = sized(spark, 300)
    one, two, other = ({tuple(r) for r in mix(df, targets(spark), "doc_id", seed=s).select("doc_id", "copies").collect()} for s in (7, 7, 8))
    assert one == two != other


def test_smaller_total(spark):
    df = sized(spark)
    total = mix(df, targets(spark), "doc_id", total=30_000).agg(F.sum(F.col("copies") * F.col("tokens"))).first()[0]
    assert total == pytest.approx(30_000, rel=0.05)


def test_nulls_empty_and_repeats(spark):
    schema = "doc_id long, source string, tokens long"
    t = spark.createDataFrame([("a", 1.0, 1), (None, 0.5, 2), ("b", None, 1)], "source string, target_share double, max_repeats int")
    df = spark.createDataFrame([(1, "a", 5), (1, "a", 5), (None, "a", 5), (2, None, 5), (3, "a", 0), (4, "b", 5)], schema)
    assert sorted(tuple(r) for r in mix(df, t, "doc_id").collect()) == [(1, "a", 5, 1), (1, "a", 5, 1)]
    assert mix(spark.createDataFrame([], schema), t, "doc_id").count() == 0 and mix(df, t.limit(0), "doc_id").count() == 0


def test_token_counts(spark):
    tokenizers = pytest.importorskip("tokenizers")
    import public_tokenizers as P

    texts = ["", None, "xin chào các bạn", "a" * 30000, "Don't stop!  \n\n  it's 12 ｏ'clock — 😀", "  "]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "id long, text string, tokens int")
    got = {r.id: r.n for r in count_tokens(df, "text", "n", tokenizer=P.path("byte_bpe_50k.tiktoken")).collect()}
    plain = tokenizers.Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    plain.encode_special_tokens = True
    assert got == {i: len(plain.encode(t, add_special_tokens=False).ids) if t else 0 for i, t in enumerate(texts)}
