"""Search, fusion, alignment, selection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filmstrip.catalog.base import Tables, query
from filmstrip.functions.vectors import cosine, doubles
from filmstrip.operators import align, search
from filmstrip.operators.fused import fused_top
from filmstrip.plans.ordinals import ordinals


@query("""WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e, sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))) AS n FROM embeddings) SELECT query_id, row_id, round(score, 6) AS score, rank FROM
    (SELECT q.vec_id AS query_id, r.vec_id AS row_id, list_dot_product(q.e, r.e) / q.n / r.n AS score, row_number() OVER (PARTITION BY q.vec_id ORDER BY round(list_dot_product(q.e, r.e) / q.n / r.n, 12) DESC, r.vec_id) AS rank FROM v q JOIN v r ON q.vec_id <> r.vec_id WHERE q.vec_id % 50 = 0) WHERE rank <= 10""")
def cosine_topk(t: Tables) -> DataFrame:
    """The ten nearest rows, out of all, of every row whose id is divisible by fifty (the stated set of searches)."""
    e = t.raw("embeddings")
    return search.cosine_top(e, e.where("vec_id % 50 = 0"), "vec_id", "embedding", "vec_id", "embedding", 10).withColumn("score", F.round("score", 6))


_BM = """q AS (SELECT query_id, unnest(list_distinct(list_filter(string_split_regex(lower(query), '[^\\p{L}\\p{N}]+'), lambda x: x <> ''))) AS term FROM kis_queries), d AS (SELECT doc_id, list_filter(string_split_regex(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS t FROM documents WHERE text IS NOT NULL),
    d1 AS (SELECT * FROM d WHERE len(t) > 0), st AS (SELECT count(*) AS n, avg(len(t)) AS al FROM d1), tf AS (SELECT doc_id, l, term, count(*) AS tf FROM (SELECT doc_id, len(t) AS l, unnest(t) AS term FROM d1) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
    df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1), sc AS (SELECT query_id, doc_id, sum(ln(1 + (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * tf * 2.2::DOUBLE / (tf + 1.2::DOUBLE * (1 - 0.75::DOUBLE + 0.75::DOUBLE * l / al))) AS s FROM tf JOIN df USING (term) JOIN q USING (term) CROSS JOIN st GROUP BY 1, 2)"""


@query(f"WITH {_BM} SELECT query_id, doc_id, round(s, 4) AS score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(s, 9) DESC, doc_id) AS rank FROM sc) WHERE rank <= 10")
def bm25_topk(t: Tables) -> DataFrame:
    """The ten best documents for each query by their words."""
    docs = t.raw("documents").where("text is not null")
    hits = search.bm25(docs, t.raw("kis_queries"), "doc_id", ["text"], "query_id", "query", 10)
    return hits.select("query_id", "doc_id", F.round("score", 4).alias("score"), "rank")


_TERMS = "list_filter(string_split_regex(lower({0}), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '')"


@query(f"""WITH q AS (SELECT query_id, unnest(list_distinct({_TERMS.format('query')})) AS term FROM kis_queries), p AS (SELECT caption_id, model, string_split(caption, chr(10) || 'TEXT:') AS p FROM ca WHERE caption IS NOT NULL),
    d AS (SELECT 'said' AS field, caption_id, model, {_TERMS.format('p[1]')} AS t FROM p UNION ALL SELECT 'seen', caption_id, model, {_TERMS.format('p[2]')} FROM p WHERE len(p) > 1), d1 AS (SELECT * FROM d WHERE len(t) > 0), st AS (SELECT field, count(*) AS n, avg(len(t)) AS al FROM d1 GROUP BY 1),
    tf AS (SELECT field, caption_id, model, l, term, count(*) AS tf FROM (SELECT field, caption_id, model, len(t) AS l, unnest(t) AS term FROM d1) WHERE term IN (SELECT term FROM q) GROUP BY ALL), df AS (SELECT field, term, count(*) AS df FROM tf GROUP BY 1, 2),
    sc AS (SELECT query_id, field, caption_id, sum(ln(1 + (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * tf * 2.2::DOUBLE / (tf + 1.2::DOUBLE * (1 - 0.75::DOUBLE + 0.75::DOUBLE * l / al))) AS s FROM tf JOIN df USING (field, term) JOIN q USING (term) JOIN st USING (field) WHERE model = (SELECT min(model) FROM ca) GROUP BY 1, 2, 3),
    b AS (SELECT query_id, caption_id, max(s) AS s FROM sc GROUP BY 1, 2) SELECT query_id, caption_id, round(s, 4) AS score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(s, 9) DESC, caption_id) AS rank FROM b) WHERE rank <= 10""")
def caption_search(t: Tables) -> DataFrame:
    """The ten best captions of one captioner for each query, by what is said or by the words seen on screen, whichever
    fits better."""
    parts = F.split("caption", "\nTEXT:")
    first = t.ca.agg(F.min("model")).first()[0]
    docs = t.ca.where("caption is not null").select("caption_id", "model", F.get(parts, F.lit(0)).alias("said"), F.get(parts, F.lit(1)).alias("seen"))
    hits = search.bm25(docs, t.raw("kis_queries"), "caption_id", ["said", "seen"], "query_id", "query", 10, keep=F.col("model") == first)
    return hits.select("query_id", F.col("doc_id").alias("caption_id"), F.round("score", 4).alias("score"), "rank")


def _channels(t: Tables) -> DataFrame:
    """Similarities of each label's rows to two of its rows."""
    e = t.raw("embeddings").select("label", "vec_id", doubles(F.col("embedding")).alias("v"))
    ends = e.groupBy("label").agg(F.min(F.struct("vec_id", "v")).alias("a"), F.max(F.struct("vec_id", "v")).alias("b"))  # a row a label
    rows = e.join(ends, "label").select("label", "vec_id", F.explode(F.create_map(F.lit("clip"), cosine(F.col("v"), F.col("a.v")), F.lit("e5"), cosine(F.col("v"), F.col("b.v")))).alias("channel", "sim"))
    return rows.withColumn("sim", F.round("sim", 9)).withColumn("weight", F.when(F.col("channel") == "clip", 3.0).otherwise(1.0))


_CH = """e AS (SELECT label, vec_id, embedding::DOUBLE[] AS v FROM embeddings), n AS (SELECT label, arg_min(v, vec_id) AS a, arg_max(v, vec_id) AS b FROM e GROUP BY 1), ch AS (SELECT label, vec_id, 'clip' AS channel, 3.0::DOUBLE AS weight, round(list_cosine_similarity(v, a), 9) AS sim FROM e JOIN n USING (label) UNION ALL
    SELECT label, vec_id, 'e5', 1, round(list_cosine_similarity(v, b), 9) FROM e JOIN n USING (label))"""


@query(f"WITH {_CH} SELECT label, vec_id, round(sum(r * weight) / sum(weight), 6) AS fused FROM (SELECT *, (row_number() OVER (PARTITION BY label, channel ORDER BY sim, vec_id) - 1)::DOUBLE / greatest(1, count(*) OVER (PARTITION BY label, channel) - 1) AS r FROM ch) GROUP BY 1, 2")
def fused_by_weight(t: Tables) -> DataFrame:
    """Two channels' ranks, weighted."""
    return align.weighted_fusion(_channels(t), ["label"], "channel", "vec_id", "sim", "weight").withColumn("fused", F.round("fused", 6))


@query(f"WITH {_CH} SELECT label, vec_id, round(sum(weight / (60 + r)), 9) AS fused FROM (SELECT *, row_number() OVER (PARTITION BY label, channel ORDER BY sim DESC, vec_id) - 1 AS r FROM ch) GROUP BY 1, 2")
def fused_by_reciprocal(t: Tables) -> DataFrame:
    """Two channels' ranks, by their reciprocals."""
    return align.reciprocal_fusion(_channels(t), ["label"], "channel", "vec_id", "sim", "weight").withColumn("fused", F.round("fused", 9))


@query()
def hybrid_search(t: Tables) -> DataFrame:
    """Documents for each query by words and by hashed embeddings, fused by reciprocal rank over both whole lists. Tested
    against brute force on a small set."""
    from filmstrip.functions.models import hashed_words

    docs = t.raw("documents").where("text is not null and trim(text) <> ''")
    return fused_top(docs, t.raw("kis_queries"), "doc_id", "text", "query_id", "query", hashed_words, 10)


_AL = """c AS (SELECT video_id, scene_id, f, arg_min(y, id) AS y, arg_min(b, id) AS b FROM (SELECT video_id, scene_id, anchor_frame AS f, mag_mean AS y, boundary_score AS b, id FROM ev WHERE video_id IS NOT NULL AND anchor_frame IS NOT NULL AND mag_mean IS NOT NULL) GROUP BY 1, 2, 3)"""


def _w(v: str) -> str:
    return f"max({v}) OVER (PARTITION BY video_id, scene_id ORDER BY f RANGE BETWEEN UNBOUNDED PRECEDING AND 8 PRECEDING)"


@query(f"""WITH {_AL}, p1 AS (SELECT *, {_w('y')} AS w1 FROM c), p2 AS (SELECT *, b + w1 AS d1 FROM p1), p3 AS (SELECT *, {_w('d1')} AS w2 FROM p2), p4 AS (SELECT *, (y + b) / 2 + w2 AS d2 FROM p3) SELECT video_id, scene_id, round(max(d2), 6) AS score FROM p4 WHERE d2 IS NOT NULL GROUP BY 1, 2""")
def aligned_phases(t: Tables) -> DataFrame:
    """The best score of three phases in order along each scene, eight frames apart or more."""
    rows = t.ev.where("video_id is not null and anchor_frame is not null and mag_mean is not null")
    c = rows.groupBy("video_id", "scene_id", F.col("anchor_frame").alias("f")).agg(F.min_by("mag_mean", "id").alias("y"), F.min_by("boundary_score", "id").alias("b"))
    sims = c.withColumn("sims", F.array("y", "b", (F.col("y") + F.col("b")) / 2))
    return align.align(sims, ["video_id", "scene_id"], "f", "sims", 3, 8).select("video_id", "scene_id", F.round("score", 6).alias("score"))


@query("""SELECT e.id, coalesce((SELECT arg_max(frame_idx, pts_time * 1000 + 0) FROM (SELECT frame_idx, frame_idx % 17 AS pts_time FROM kf k WHERE k.video_id = e.video_id AND frame_idx BETWEEN e.anchor_frame - 60 AND e.anchor_frame + 60 ORDER BY frame_idx)), e.anchor_frame) AS apex FROM ev e WHERE e.anchor_frame IS NOT NULL AND e.video_id IS NOT NULL""")
def apex_frames(t: Tables) -> DataFrame:
    """Anchors moved to the strongest frame nearby (the first of several), or left."""
    flow = t.kf.select("video_id", "frame_idx", (F.col("frame_idx") % 17).alias("mag"))
    centres = t.ev.where("anchor_frame is not null and video_id is not null").select("id", "video_id", "anchor_frame")
    return align.snap_to_apex(centres, flow, "video_id", "anchor_frame", "frame_idx", "mag", 60).select("id", "apex")


@query("""SELECT id, array_to_string(CASE WHEN len(l) > 0 THEN l ELSE [least(greatest(anchor_frame, start_frame), end_frame)] END, ',') AS frames FROM (SELECT *, list_filter([anchor_frame - 8, anchor_frame, anchor_frame + 8], lambda f: f >= start_frame AND f <= end_frame) AS l FROM ev WHERE anchor_frame IS NOT NULL AND start_frame IS NOT NULL AND end_frame >= start_frame)""")
def spread_answers(t: Tables) -> DataFrame:
    """Answer frames around each anchor within its event, as a budget of a hundred for three phases allows."""
    e = t.ev.where("anchor_frame is not null and start_frame is not null and end_frame >= start_frame")
    frames = align.spread(F.col("anchor_frame"), 3, 100, 8, 12, F.col("start_frame"), F.col("end_frame"))
    return e.select("id", F.array_join(frames.cast("array<string>"), ",").alias("frames"))


@query("""SELECT video_id, shot_index, id FROM (SELECT *, row_number() OVER (PARTITION BY video_id, shot_index ORDER BY time_sec DESC, frame_index DESC, id DESC) AS r FROM ky WHERE frame_index IS NOT NULL) WHERE r <= 2""")
def last_two_in_shot(t: Tables) -> DataFrame:
    """The top two keyframes of each shot, ties to the later."""
    return search.top_per_key(t.ky.where("frame_index is not null"), ["video_id", "shot_index"], [F.desc("time_sec"), F.desc("frame_index"), F.desc("id")], 2).select("video_id", "shot_index", "id")


@query("""SELECT a, b, round(s, 6) AS similarity FROM (SELECT lag(vec_id) OVER w AS a, vec_id AS b, list_dot_product(v, lag(v) OVER w) AS s FROM (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings) WINDOW w AS (ORDER BY vec_id)) WHERE s IS NOT NULL ORDER BY round(s, 12) DESC, b LIMIT 5""")
def most_alike_pairs(t: Tables) -> DataFrame:
    """The five pairs of neighbours most alike."""
    from filmstrip.plans.ordered import chunked, positions

    e = t.raw("embeddings").select("vec_id", doubles(F.col("embedding")).alias("v"))
    p = positions(chunked(e, [], ["vec_id"], seats=True), "pos")
    pairs = p.alias("x").join(p.alias("y"), F.col("y.pos") == F.col("x.pos") + 1)
    s = F.aggregate(F.zip_with("x.v", "y.v", lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
    rows = pairs.select(F.col("x.vec_id").alias("a"), F.col("y.vec_id").alias("b"), s.alias("s"))
    return rows.orderBy(F.desc("s"), "b").limit(5).select("a", "b", F.round("s", 6).alias("similarity"))


@query("""SELECT video_id, array_to_string(CASE WHEN n <= 4 THEN l ELSE list_transform(range(4), lambda i: l[CAST(round_even(i * (n - 1) / 3.0::DOUBLE, 0) AS INTEGER) + 1]) END, ',') AS frames FROM (SELECT video_id, list(frame_idx ORDER BY frame_idx) AS l, count(*) AS n FROM kf WHERE frame_idx IS NOT NULL GROUP BY 1)""")
def even_frames(t: Tables) -> DataFrame:
    """Four of each video's keyframes, evenly spread."""
    rows = ordinals(t.kf.where("frame_idx is not null"), ["video_id"], ["frame_idx", "keyframe_id"], "i", "n")
    wanted = F.when(F.col("n") <= 4, F.array("i")).otherwise(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda k: F.bround(k * (F.col("n") - 1) / 3, 0).cast("long")))
    four = rows.where(F.array_contains(wanted, F.col("i"))).groupBy("video_id").agg(F.array_sort(F.collect_list("frame_idx")).alias("l"))  # four at most
    return four.select("video_id", F.array_join(F.col("l").cast("array<string>"), ",").alias("frames"))


@query("""SELECT video_id, keyframe_id FROM (SELECT video_id, keyframe_id, row_number() OVER (PARTITION BY video_id ORDER BY md5('42' || keyframe_id), keyframe_id) AS r FROM kf) WHERE r = 1""")
def one_per_video(t: Tables) -> DataFrame:
    """A keyframe of each video, drawn by a seed."""
    return search.top_per_key(t.kf, ["video_id"], [F.md5(F.concat(F.lit("42"), "keyframe_id")), F.col("keyframe_id")], 1).select("video_id", "keyframe_id")


@query("""SELECT id, f FROM (SELECT id, unnest(range(start_frame, end_frame + 1, 24)) AS f FROM sh WHERE end_frame >= start_frame) UNION ALL SELECT -id - 1, (start_frame + end_frame) // 2 FROM sh""")
def uniform_picks(t: Tables) -> DataFrame:
    """Every 24th frame of each shot, and (under a negative id) its middle."""
    every = t.sh.where("end_frame >= start_frame").select("id", F.explode(F.sequence("start_frame", "end_frame", F.lit(24).cast("long"))).alias("f"))
    return every.unionByName(t.sh.select((-F.col("id") - 1).alias("id"), F.floor((F.col("start_frame") + F.col("end_frame")) / 2).alias("f")))


@query("""SELECT caption_id FROM (SELECT caption_id, row_number() OVER (PARTITION BY model ORDER BY caption_id) - 1 AS i, count(*) OVER (PARTITION BY model) AS n FROM ca WHERE coalesce(regexp_matches(caption, '^\\s*(\\[|\\z)'), true)) WHERE ((i - 80) % n + n) % n < 40""")
def retry_batch(t: Tables) -> DataFrame:
    """The third batch of forty failed captions of each model, in a rotating order."""
    from filmstrip.functions.labels import is_error_text

    bad = ordinals(t.ca.where(is_error_text(F.col("caption"))), ["model"], ["caption_id"], "i", "n")
    return bad.where(F.pmod(F.col("i") - 80, F.col("n")) < 40).select("caption_id")


@query("""SELECT field, count(*) AS postings, count(DISTINCT term) AS terms, sum(tf) AS tokens FROM (SELECT field, term, caption_id, count(*) AS tf FROM (SELECT 'caption' AS field, caption_id, unnest(list_filter(string_split_regex(lower(caption), '[^\\p{L}\\p{N}]+'), lambda x: x <> '')) AS term FROM ca WHERE caption IS NOT NULL) GROUP BY ALL) GROUP BY 1""")
def index_size(t: Tables) -> DataFrame:
    """The size of the captions' inverted index."""
    index = search.inverted_index(t.ca, "caption_id", ["caption"])
    return index.groupBy("field").agg(F.count(F.lit(1)).alias("postings"), F.countDistinct("term").alias("terms"), F.sum("tf").alias("tokens"))
