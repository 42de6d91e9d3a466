"""Joins, upserts, set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from filmstrip.catalog.base import Tables, query
from filmstrip.functions import ids
from filmstrip.functions.frames import tolerance_ranges
from filmstrip.operators import joins
from filmstrip.operators.folds import clusters, collected


@query("""SELECT k.keyframe_id, s.id AS shot FROM kf k JOIN sh s ON k.video_id = s.video_id AND k.frame_idx BETWEEN s.start_frame AND s.end_frame""")
def frames_in_shots(t: Tables) -> DataFrame:
    """Keyframes with the shots that hold them; frames outside every shot are dropped."""
    shots = t.sh.select("video_id", F.col("id").alias("shot"), "start_frame", "end_frame")
    return joins.in_interval(t.kf.select("video_id", "keyframe_id", "frame_idx"), shots, "video_id", "frame_idx", "start_frame", "end_frame").select("keyframe_id", "shot")


@query("""SELECT k.keyframe_id, coalesce(min(s.id) FILTER (s.end_frame = n.e), any_value(l.last_id)) AS id FROM kf k
    JOIN (SELECT video_id, arg_max(id, end_frame * 100000000 - id) AS last_id FROM sh GROUP BY 1) l ON k.video_id = l.video_id
    LEFT JOIN LATERAL (SELECT min(end_frame) AS e FROM sh x WHERE x.video_id = k.video_id AND x.end_frame >= k.frame_idx) n ON true
    JOIN sh s ON s.video_id = k.video_id WHERE k.frame_idx IS NOT NULL GROUP BY k.keyframe_id""")
def frames_to_next_shot(t: Tables) -> DataFrame:
    """Each keyframe with its shot; frames between shots go to the next one, those after all to the last."""
    return joins.forward_clamped(t.kf, t.sh.select("video_id", "end_frame", "id"), "video_id", "frame_idx", "keyframe_id", "end_frame", "id")


@query("""SELECT id, coalesce(CASE WHEN len(own) > 0 THEN list_min(list_transform(own, lambda f: {'d': abs(f - anchor_frame), 'f': f})).f END, (SELECT arg_min(frame_idx, abs(frame_idx - e.anchor_frame) * 100000000 + frame_idx) FROM kf WHERE kf.video_id = e.video_id AND frame_idx IS NOT NULL), anchor_frame) AS rep_frame
    FROM (SELECT id, video_id, anchor_frame, keyframe_frames AS own FROM video_events GROUP BY ALL) e WHERE anchor_frame IS NOT NULL""")
def event_rep_frame(t: Tables) -> DataFrame:
    """The keyframe that stands for an event: the nearest of its own, else of its video, else its anchor."""
    events = t.raw("video_events").select("id", "video_id", "anchor_frame", "keyframe_frames").distinct().where("anchor_frame is not null")
    return joins.nearest_in_pool(events, t.kf, "video_id", "anchor_frame", "keyframe_frames", "frame_idx", "id")


@query("""SELECT e.id, coalesce(array_to_string(list_sort(list(k.frame_idx) FILTER (k.frame_idx IS NOT NULL)), ','), '') AS frames, count(k.frame_idx) AS n FROM ev e
    LEFT JOIN kf k ON e.video_id = k.video_id AND k.frame_idx BETWEEN e.start_frame AND e.end_frame GROUP BY e.id""")
def event_keyframes(t: Tables) -> DataFrame:
    """Events with the keyframes inside them."""
    e = t.ev.select("id", "video_id", "start_frame", "end_frame")
    rows = joins.collected_in_interval(e, t.kf, ["video_id"], "start_frame", "end_frame", "frame_idx", "inside")
    return rows.select("id", F.array_join(F.col("inside").cast("array<string>"), ",").alias("frames"), F.size("inside").alias("n"))


@query("""SELECT k.id, s.id AS shot, s.scene_id, k.frame_index - s.start_frame AS into_shot FROM ky k JOIN sh s ON k.video_id = s.video_id AND k.shot_index = s.shot_index""")
def keyframes_with_shot(t: Tables) -> DataFrame:
    """Keyframes and their shots by key."""
    s = t.sh.select("video_id", "shot_index", F.col("id").alias("shot"), "scene_id", "start_frame")
    return t.ky.join(s, ["video_id", "shot_index"]).select("id", "shot", "scene_id", (F.col("frame_index") - F.col("start_frame")).alias("into_shot"))


@query("""WITH o AS (SELECT video_id, shot_index, max(caption_id) AS caption_id FROM ca WHERE model = 'vlm-a' GROUP BY 1, 2), b AS (SELECT video_id, shot_index, max(caption_id) AS caption_id FROM ca WHERE model = 'vlm-b' GROUP BY 1, 2),
    ok AS (SELECT * FROM o WHERE video_id IS NOT NULL AND shot_index IS NOT NULL), bk AS (SELECT * FROM b WHERE video_id IS NOT NULL AND shot_index IS NOT NULL)
    SELECT ok.*, 'kept' AS state FROM ok ANTI JOIN bk USING (video_id, shot_index) UNION ALL SELECT bk.*, CASE WHEN EXISTS (SELECT 1 FROM ok WHERE ok.video_id = bk.video_id AND ok.shot_index = bk.shot_index) THEN 'updated' ELSE 'new' END FROM bk""")
def upsert_captions(t: Tables) -> DataFrame:
    """One model's captions, replaced by another's where that has the shot."""

    def of(model: str) -> DataFrame:
        return t.ca.where(F.col("model") == model).dropna(subset=["video_id", "shot_index"]).groupBy("video_id", "shot_index").agg(F.max("caption_id").alias("caption_id"))

    return joins.upsert(of("vlm-a"), of("vlm-b"), ["video_id", "shot_index"])


@query("SELECT id FROM sh ANTI JOIN ca USING (video_id, shot_index)")
def remaining_shots(t: Tables) -> DataFrame:
    """Shots without a caption yet."""
    return joins.remaining(t.sh, t.ca, ["video_id", "shot_index"]).select("id")


@query("SELECT id FROM ev ANTI JOIN sh USING (video_id, shot_index)")
def events_without_shot(t: Tables) -> DataFrame:
    """Events whose shot is not in the table at all."""
    return t.ev.join(t.sh, ["video_id", "shot_index"], "left_anti").select("id")


@query("""WITH inv AS (SELECT DISTINCT replace(path, '\\', '/') AS p FROM ky), m AS (SELECT split_part(video_id, '_', 1) AS coll, replace(keyframe_path, '\\', '/') AS p FROM kf)
    SELECT coll AS collection, count(*) AS paths, count(*) FILTER (p IN (SELECT p FROM inv WHERE p IS NOT NULL)) AS hits FROM m GROUP BY ROLLUP (coll)""")
def path_hits(t: Tables) -> DataFrame:
    """How many exported paths exist, per collection and in all."""
    inventory = t.ky.select(ids.slashes(F.col("path")).alias("p")).distinct().withColumn("there", F.lit(1))
    rows = t.kf.select(ids.collection(F.col("video_id")).alias("collection"), ids.slashes(F.col("keyframe_path")).alias("p")).join(inventory, "p", "left")
    return rows.rollup("collection").agg(F.count(F.lit(1)).alias("paths"), F.count("there").alias("hits"))


@query("""SELECT video_id, shot_index, caption_id, model FROM (SELECT *, row_number() OVER (PARTITION BY video_id, shot_index ORDER BY written_at DESC, caption_id DESC) AS r FROM ca
    WHERE video_id IS NOT NULL AND shot_index IS NOT NULL) WHERE r = 1""")
def latest_captions(t: Tables) -> DataFrame:
    """The last caption of each shot."""
    rows = t.ca.dropna(subset=["video_id", "shot_index"])
    return joins.latest(rows, ["video_id", "shot_index"], [F.col("written_at"), F.col("caption_id")]).select("video_id", "shot_index", "caption_id", "model")


@query("""SELECT d.doc_id, v.title, coalesce(d.source, 'none') AS source, v.video_id IS NOT NULL AS known FROM documents d LEFT JOIN (SELECT DISTINCT video_id, title FROM vi) v USING (video_id) WHERE d.video_id IS NOT NULL""")
def documents_with_video(t: Tables) -> DataFrame:
    """Documents with their video's title, whether that is known or not."""
    v = t.vi.select("video_id", "title").distinct().withColumn("known", F.lit(True))
    rows = t.raw("documents").where("video_id is not null").join(v, "video_id", "left")
    return rows.select("doc_id", "title", F.coalesce("source", F.lit("none")).alias("source"), F.coalesce("known", F.lit(False)).alias("known"))


@query("SELECT query_id FROM kis_queries SEMI JOIN (SELECT printf('kis_%03d', n) AS query_id FROM (SELECT DISTINCT n FROM ky)) USING (query_id)")
def known_queries(t: Tables) -> DataFrame:
    """Queries whose id occurs among the numbers given out."""
    given = t.ky.select(ids.numbered("kis_", F.col("n")).alias("query_id")).distinct()
    return t.raw("kis_queries").join(given, "query_id", "left_semi").select("query_id")


@query("""SELECT k.keyframe_id, b, a, greatest(frame_idx - 5, 0) AS lo5, least(frame_idx + 5, v.n_frames - 1) AS hi5, greatest(frame_idx - 90, 0) AS lo90, least(frame_idx + 90, v.n_frames - 1) AS hi90, (b + frame_idx) // 2 AS span_lo, (frame_idx + a) // 2 AS span_hi
    FROM (SELECT keyframe_id, video_id, frame_idx, coalesce(lag(frame_idx) OVER w, 0) AS b, coalesce(lead(frame_idx) OVER w, frame_idx) AS a FROM kf WHERE frame_idx IS NOT NULL AND video_id IS NOT NULL
    WINDOW w AS (PARTITION BY video_id ORDER BY frame_idx, keyframe_id)) k JOIN (SELECT DISTINCT video_id, n_frames FROM vi) v USING (video_id)""")
def answer_ranges(t: Tables) -> DataFrame:
    """Ranges of frames that count as an answer around each keyframe."""
    k = joins.neighbours(t.kf.where("frame_idx is not null and video_id is not null"), "video_id", "frame_idx", "keyframe_id").join(t.vi.select("video_id", "n_frames").distinct(), "video_id")
    r = tolerance_ranges(F.col("frame_idx"), F.col("before"), F.col("after"), F.col("n_frames") - 1)
    rows = k.select("keyframe_id", F.col("before").alias("b"), F.col("after").alias("a"), r.alias("r"))
    return rows.select("keyframe_id", "b", "a", *[F.col("r")[name][i].alias(out) for name, i, out in (("tol5", 0, "lo5"), ("tol5", 1, "hi5"), ("tol90", 0, "lo90"), ("tol90", 1, "hi90"), ("kf_span", 0, "span_lo"), ("kf_span", 1, "span_hi"))])


@query("""WITH s AS (SELECT label, vec_id // 64 AS part, vec_id, embedding::DOUBLE[] AS v, row_number() OVER (PARTITION BY label, vec_id // 64 ORDER BY vec_id) AS rn FROM embeddings), r AS (SELECT label, part, rn, vec_id, v, 0 AS n FROM s WHERE rn = 1 UNION ALL
    SELECT s.label, s.part, s.rn, s.vec_id, CASE WHEN 1 - list_dot_product(r.v, s.v) > 0.8 THEN s.v ELSE r.v END, CASE WHEN 1 - list_dot_product(r.v, s.v) > 0.8 THEN r.n + 1 ELSE r.n END FROM r JOIN s ON s.label = r.label AND s.part = r.part AND s.rn = r.rn + 1)
    SELECT vec_id, label, part, n AS cluster, 'text ' || min(vec_id) OVER (PARTITION BY label, part, n) AS caption FROM r""", recursive=True)
def captions_by_cluster(t: Tables) -> DataFrame:
    """One representative's caption for each cluster of neighbours alike, given to all of its members."""
    from filmstrip.catalog.folds import SEQUENCE, sequences
    from filmstrip.functions.vectors import dot

    rows = clusters(sequences(t), lambda a, b: 1 - dot(a["v"], b["v"]), 0.8)
    flat = rows.select(*SEQUENCE, F.explode(F.arrays_zip("items", "labels")).alias("x")).select(*SEQUENCE, F.col("x.items.id").alias("vec_id"), F.col("x.labels").alias("cluster"))
    first = F.min("vec_id").over(Window.partitionBy(*SEQUENCE, "cluster"))
    return flat.select("vec_id", *SEQUENCE, "cluster", F.concat(F.lit("text "), first).alias("caption"))


@query("""SELECT video_id, list_count AS n FROM (SELECT video_id, count(*) AS list_count FROM (SELECT video_id, frame_idx AS f FROM kf WHERE frame_idx IS NOT NULL UNION SELECT video_id, anchor_frame FROM ev WHERE anchor_frame IS NOT NULL) GROUP BY 1)""")
def united_frames(t: Tables) -> DataFrame:
    """Distinct frames of keyframes and anchors together."""
    a = t.kf.where("frame_idx is not null").select("video_id", F.col("frame_idx").alias("f"))
    b = t.ev.where("anchor_frame is not null").select("video_id", F.col("anchor_frame").alias("f"))
    return a.union(b).distinct().groupBy("video_id").agg(F.count(F.lit(1)).alias("n"))


@query("""(SELECT video_id, shot_index, 'no caption' AS side FROM (SELECT video_id, shot_index FROM sh EXCEPT SELECT video_id, shot_index FROM ca)) UNION ALL
    (SELECT video_id, shot_index, 'both' FROM (SELECT video_id, shot_index FROM sh INTERSECT SELECT video_id, shot_index FROM ca))""")
def shot_sets(t: Tables) -> DataFrame:
    """Shots with and without captions, as set operations."""
    a, b = t.sh.select("video_id", "shot_index"), t.ca.select("video_id", "shot_index")
    return a.subtract(b).withColumn("side", F.lit("no caption")).union(a.intersect(b).withColumn("side", F.lit("both")))


@query("SELECT keyframe_id, count(*) AS times FROM keyframe_meta GROUP BY 1 HAVING count(*) > 1")
def repeated_keys(t: Tables) -> DataFrame:
    """Keys delivered more than once."""
    return t.raw("keyframe_meta").groupBy("keyframe_id").agg(F.count(F.lit(1)).alias("times")).where("times > 1")


@query("""SELECT video_id, array_to_string(list_sort(list(DISTINCT anchor_frame)), ',') AS anchors FROM ev WHERE anchor_frame IS NOT NULL GROUP BY 1""")
def sorted_anchors(t: Tables) -> DataFrame:
    """Each video's distinct anchors in order."""
    return t.ev.where("anchor_frame is not null").groupBy("video_id").agg(F.array_join(F.array_sort(F.collect_set("anchor_frame")).cast("array<string>"), ",").alias("anchors"))


@query("""SELECT 'keyframes' AS src, id, video_id FROM ky UNION ALL SELECT 'shots', id, video_id FROM sh UNION ALL SELECT 'events', id, video_id FROM ev""")
def concatenated(t: Tables) -> DataFrame:
    """Rows of all tables, one after the other."""
    parts = [d.select(F.lit(n).alias("src"), "id", "video_id") for n, d in (("keyframes", t.ky), ("shots", t.sh), ("events", t.ev))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("""SELECT v.video_id, coalesce(nullif(e.fps, 0), nullif(k.fps, 0), v.fps, 25) AS fps FROM (SELECT DISTINCT video_id, fps FROM vi) v LEFT JOIN (SELECT video_id, min(fps) AS fps FROM ev GROUP BY 1) e USING (video_id)
    LEFT JOIN (SELECT video_id, min(fps) AS fps FROM kf GROUP BY 1) k USING (video_id)""")
def fps_chain(t: Tables) -> DataFrame:
    """A video's rate from its events, else its keyframes, else itself."""
    e, k = (d.groupBy("video_id").agg(F.min("fps").alias(n)) for d, n in ((t.ev, "e"), (t.kf, "k")))
    rows = t.vi.select("video_id", F.col("fps").alias("v")).distinct().join(e, "video_id", "left").join(k, "video_id", "left")
    return rows.select("video_id", F.coalesce(F.expr("nullif(e, 0D)"), F.expr("nullif(k, 0D)"), "v", F.lit(25.0)).alias("fps"))
