"""Projections, filters, and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from filmstrip.catalog.base import Tables, query
from filmstrip.functions import frames, ids, labels, vectors
from filmstrip.plans.ordered import chunked, positions, scan
from filmstrip.plans.ordinals import ordinals


@query("""SELECT id, video_id, round(start_frame / fps, 6) AS start_time, round((end_frame + 1) / fps, 6) AS end_time,
    round(anchor_frame / fps, 6) AS anchor_time, end_frame - start_frame + 1 AS n_frames FROM ev""")
def event_records(t: Tables) -> DataFrame:
    """Derived times and frame counts of events."""
    fps = F.col("fps")
    return t.ev.select("id", "video_id", F.round(frames.start_time(F.col("start_frame"), fps), 6).alias("start_time"), F.round(frames.end_time(F.col("end_frame"), fps), 6).alias("end_time"), F.round(F.col("anchor_frame") / fps, 6).alias("anchor_time"), frames.frame_count(F.col("start_frame"), F.col("end_frame")).alias("n_frames"))


@query("""SELECT video_id, frame_idx, n, printf('%s_kf%06d', video_id, n - 1) AS made_id, printf('kis_%03d', n) AS query_id FROM
    (SELECT video_id, frame_idx, row_number() OVER (PARTITION BY video_id ORDER BY frame_idx, keyframe_id) AS n FROM kf WHERE frame_idx IS NOT NULL AND video_id IS NOT NULL)""")
def keyframe_ids(t: Tables) -> DataFrame:
    """Numbers and ids of the keyframes of each video."""
    order = ["frame_idx", "keyframe_id"]
    rows = scan(chunked(t.kf.where("frame_idx is not null and video_id is not null"), ["video_id"], order), ["video_id"], order, sums={"n": F.lit(1)})
    return rows.select("video_id", "frame_idx", "n", ids.keyframe_id(F.col("video_id"), F.col("n")).alias("made_id"), ids.numbered("kis_", F.col("n")).alias("query_id"))


@query("""SELECT keyframe_id, row_number() OVER (ORDER BY video_id, frame_idx, keyframe_id) - 1 AS global_id FROM kf
    WHERE frame_idx IS NOT NULL AND video_id IS NOT NULL""")
def global_ids(t: Tables) -> DataFrame:
    """Ids from 0 over all videos in order, by range partitions and their offsets, not by one task."""
    rows = t.kf.where("frame_idx is not null and video_id is not null").select("video_id", "frame_idx", "keyframe_id")
    return positions(chunked(rows, ["video_id"], ["frame_idx", "keyframe_id"], seats=True), "global_id").select("keyframe_id", "global_id")


@query("""SELECT keyframe_id, clean, split_part(clean, '/', -1) AS name, replace(split_part(clean, '/', -1), '.jpg', '') AS stem,
    split_part(video_id, '_', 1) AS collection, split_part(clean, '/', -2) AS path_video, regexp_extract(clean, '(shot[0-9]+)_f([0-9]+)\\.jpg$', 1) AS shot,
    CAST(regexp_extract(clean, '(shot[0-9]+)_f([0-9]+)\\.jpg$', 2) AS BIGINT) AS frame,
    CASE WHEN starts_with(clean, 'out/') THEN 'store/' || substr(clean, 5) ELSE clean END AS moved,
    'root/' || split_part(video_id, '_', 1) || '/' || video_id || '/' || split_part(clean, '/', -1) AS remapped
    FROM (SELECT *, replace(keyframe_path, '\\', '/') AS clean FROM kf WHERE keyframe_path IS NOT NULL)""")
def paths_parsed(t: Tables) -> DataFrame:
    """Paths with one kind of slash, taken apart and moved to other folders."""
    path = F.col("keyframe_path")
    got = ids.parse_image_path(path)
    clean = ids.slashes(path)
    return t.kf.where("keyframe_path is not null").select("keyframe_id", clean.alias("clean"), ids.basename(path).alias("name"), ids.stem(path).alias("stem"), ids.collection(F.col("video_id")).alias("collection"), got["video_id"].alias("path_video"), got["shot"].alias("shot"), got["frame"].alias("frame"), ids.with_prefix(clean, "out/", "store/").alias("moved"), ids.remap(path, F.col("video_id"), "root").alias("remapped"))


@query("SELECT keyframe_id, frame_idx FROM kf WHERE frame_idx % 5 = 0")
def stride_frames(t: Tables) -> DataFrame:
    """Every fifth frame, as a decoder that strides would give it."""
    return t.kf.where(F.col("frame_idx") % 5 == 0).select("keyframe_id", "frame_idx")


@query("""SELECT keyframe_id, video_id, pos FROM (SELECT keyframe_id, video_id, row_number() OVER (PARTITION BY video_id ORDER BY frame_idx, keyframe_id) - 1 AS pos,
    count(*) OVER (PARTITION BY video_id) AS n FROM kf WHERE frame_idx IS NOT NULL) WHERE n >= 20 AND pos >= floor(0.1::DOUBLE * n) AND pos < floor(0.9::DOUBLE * n)""")
def edge_trim(t: Tables) -> DataFrame:
    """Keyframes of videos with twenty or more, without the first and last tenth."""
    rows = ordinals(t.kf.where("frame_idx is not null"), ["video_id"], ["frame_idx", "keyframe_id"], "pos", "n")
    return rows.where("n >= 20 and pos >= floor(0.1D * n) and pos < floor(0.9D * n)").select("keyframe_id", "video_id", "pos")


@query("""SELECT vec_id, round(m, 6) AS mean, round(sqrt(greatest(q - m * m, 0)), 6) AS deviation FROM (SELECT vec_id,
    list_sum(list_transform(embedding, lambda x: x::DOUBLE)) / 64 AS m, list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE)) / 64 AS q FROM embeddings)
    WHERE sqrt(greatest(q - m * m, 0)) >= 0.12 AND m BETWEEN -0.02 AND 0.02""")
def quality_vectors(t: Tables) -> DataFrame:
    """Rows whose values vary enough and are neither too low nor too high on average."""
    v = vectors.doubles(F.col("embedding"))
    rows = t.raw("embeddings").select("vec_id", vectors.mean(v).alias("m"), vectors.deviation(v).alias("d"))
    return rows.where("d >= 0.12D and m between -0.02D and 0.02D").select("vec_id", F.round("m", 6).alias("mean"), F.round("d", 6).alias("deviation"))


@query("""SELECT caption_id, coalesce(regexp_matches(caption, '^\\s*(\\[|\\z)'), true) AS failed FROM ca""")
def error_captions(t: Tables) -> DataFrame:
    """Captions that failed: null, blank or beginning with a bracket."""
    return t.ca.select("caption_id", labels.is_error_text(F.col("caption")).alias("failed"))


@query("""SELECT caption_id, regexp_matches(lower(caption), '(ban đầu|lúc đầu|đầu tiên|rồi |sau đó|tiếp theo|tiếp đó|cuối cùng|trước khi|sau khi|khi đó|dần dần|liền |ngay sau|đang[^\n\r]{0,30}thì)') AS tells_order,
    regexp_matches(lower(caption), 'người|đàn ông|phụ nữ|cô gái|chàng trai|cụ ông|cụ bà') AS has_person,
    len(list_filter(string_split_regex(caption, '\\s+'), lambda x: x <> '')) AS words, substr(caption, 1, 40) AS head FROM ca WHERE caption IS NOT NULL""")
def caption_flags(t: Tables) -> DataFrame:
    """Which captions tell an order or a person, and how long they are."""
    c = F.col("caption")
    return t.ca.where(c.isNotNull()).select("caption_id", labels.has_any(c, labels.SEQUENCE_WORDS).alias("tells_order"), labels.has_any(c, labels.PERSON_WORDS).alias("has_person"), labels.word_count(c).alias("words"), F.substring(c, 1, 40).alias("head"))


@query("SELECT video_id, n_frames FROM vi WHERE starts_with(video_id, 'N00')")
def prefix_videos(t: Tables) -> DataFrame:
    """Videos by the beginning of their id, which a Parquet scan can push down."""
    return t.vi.where(F.col("video_id").startswith("N00")).select("video_id", "n_frames")


@query("""SELECT video_id, shot_index, id, k FROM (SELECT video_id, shot_index, id, row_number() OVER w AS k, count(*) OVER (PARTITION BY video_id, shot_index) AS n
    FROM ev WHERE video_id IS NOT NULL AND shot_index IS NOT NULL WINDOW w AS (PARTITION BY video_id, shot_index ORDER BY ord_in_shot, id)) WHERE n >= 2 AND k <= 6""")
def phase_sets(t: Tables) -> DataFrame:
    """The first six events of shots with two or more."""
    w = Window.partitionBy("video_id", "shot_index")
    rows = t.ev.dropna(subset=["video_id", "shot_index"]).withColumn("k", F.row_number().over(w.orderBy("ord_in_shot", "id"))).withColumn("n", F.count(F.lit(1)).over(w))
    return rows.where("n >= 2 and k <= 6").select("video_id", "shot_index", "id", "k")


@query("""SELECT id FROM ev SEMI JOIN (SELECT video_id, shot_index FROM ev WHERE video_id IS NOT NULL AND shot_index IS NOT NULL GROUP BY ALL
    HAVING count(*) > 1 AND count(*) > count(CASE WHEN trim(action) <> '' THEN 1 END)) g USING (video_id, shot_index)""")
def unfinished_labels(t: Tables) -> DataFrame:
    """Events of shots with more than one event of which not all have an action."""
    groups = t.ev.dropna(subset=["video_id", "shot_index"]).groupBy("video_id", "shot_index").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.trim("action") != "").alias("done"))
    return t.ev.join(groups.where("n > 1 and n > done"), ["video_id", "shot_index"], "left_semi").select("id")


@query("""SELECT v.video_id, coalesce(k.n, 0) AS images, coalesce(m.n, 0) AS exported, coalesce(s.n, 0) AS shots, coalesce(k.n, 0) = coalesce(m.n, 0) AND coalesce(k.n, 0) > 0 AND coalesce(s.n, 0) > 0 AS complete
    FROM (SELECT DISTINCT video_id FROM vi) v LEFT JOIN (SELECT video_id, count(*) AS n FROM ky GROUP BY 1) k USING (video_id)
    LEFT JOIN (SELECT video_id, count(*) AS n FROM kf GROUP BY 1) m USING (video_id) LEFT JOIN (SELECT video_id, count(*) AS n FROM sh GROUP BY 1) s USING (video_id)""")
def complete_videos(t: Tables) -> DataFrame:
    """Whether a video has all its outputs, for a run that resumes."""

    def n(d: DataFrame, name: str) -> DataFrame:
        return d.groupBy("video_id").agg(F.count(F.lit(1)).alias(name))

    rows = t.vi.select("video_id").distinct().join(n(t.ky, "images"), "video_id", "left").join(n(t.kf, "exported"), "video_id", "left").join(n(t.sh, "shots"), "video_id", "left").fillna(0, ["images", "exported", "shots"])
    return rows.withColumn("complete", F.expr("images = exported and images > 0 and shots > 0"))


@query("""SELECT video_id, max(written_at) AS newest FROM ev WHERE video_id IS NOT NULL GROUP BY 1 HAVING max(written_at) >= (SELECT max(written_at) FROM ev) - INTERVAL 30 DAY""")
def recently_written(t: Tables) -> DataFrame:
    """Videos with a row of the last thirty days of the table."""
    newest = t.ev.groupBy("video_id").agg(F.max("written_at").alias("newest")).where("video_id is not null")
    end = t.ev.agg(F.max("written_at").alias("end"))  # one row
    return newest.join(F.broadcast(end), F.expr("newest >= end - interval 30 days")).select("video_id", "newest")


@query("""SELECT s.id, s.n_keyframes AS expected, count(k.id) AS decoded, count(k.id) < 0.9::DOUBLE * s.n_keyframes AS fallback FROM sh s
    LEFT JOIN ky k ON s.video_id = k.video_id AND s.shot_index = k.shot_index GROUP BY s.id, s.n_keyframes""")
def decode_guard(t: Tables) -> DataFrame:
    """Shots of which too few frames were decoded, which then take another way."""
    got = t.ky.groupBy("video_id", "shot_index").agg(F.count(F.lit(1)).alias("decoded"))
    rows = t.sh.join(got, ["video_id", "shot_index"], "left").fillna(0, ["decoded"])
    return rows.select("id", F.col("n_keyframes").alias("expected"), "decoded", F.expr("decoded < 0.9D * n_keyframes").alias("fallback"))


_RAW = "concat_ws(chr(10), 'Đây là nhãn:', '2 | ' || coalesce(action, ''), '9 | x', '1. ' || coalesce(motion, ''))"


_LINE = "'^\\s*[-*•]?\\s*([0-9]{1,2})\\s*[|.):-]\\s*(.+?)\\s*$'"


def _slot(k: int) -> str:
    return f"coalesce(regexp_extract(list_filter(numbered, lambda x: regexp_extract(x, {_LINE}, 1)::INT = {k})[1], {_LINE}, 2), '') AS slot{k}"


@query(f"""WITH r AS (SELECT id, {_RAW} AS raw FROM ev), l AS (SELECT id, raw, list_filter(list_transform(string_split_regex(raw, '[\n\r]+'), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: x <> '') AS lines FROM r),
    k AS (SELECT id, raw, list_filter(lines, lambda x: regexp_matches(x, {_LINE})) AS numbered FROM l)
    SELECT id, {_slot(1)}, {_slot(2)}, {_slot(3)}, md5(raw) AS raw_md5 FROM k""")
def label_slots(t: Tables) -> DataFrame:
    """Labels from numbered lines of an answer to each event, also where its texts are null, blank, untrimmed or of
    several lines: the order of lines doesn't matter, numbers out of range are ignored."""
    raw = F.concat_ws("\n", F.lit("Đây là nhãn:"), F.concat(F.lit("2 | "), F.coalesce("action", F.lit(""))), F.lit("9 | x"), F.concat(F.lit("1. "), F.coalesce("motion", F.lit(""))))
    slots = t.ev.select("id", labels.label_slots(raw, F.lit(3)).alias("s"), F.md5(raw).alias("raw_md5"))
    return slots.select("id", *[F.get("s", F.lit(k)).alias(f"slot{k + 1}") for k in range(3)], "raw_md5")


@query("""SELECT query_id, trim(query) AS query, least(greatest(coalesce(distinct_score, 0), 0), 5) AS distinct_score, coalesce(note, '') AS note FROM kis_queries WHERE trim(query) <> ''""")
def fenced_queries(t: Tables) -> DataFrame:
    """Queries read back from answers with JSON in a fence."""
    q = t.raw("kis_queries")
    answer = F.concat(F.lit("Here:\n```json\n"), F.to_json(F.struct("query", F.col("distinct_score").alias("distinct"), "note")), F.lit("\n```"))
    got = q.select("query_id", labels.fenced_query(answer).alias("g")).where("g is not null")
    return got.select("query_id", F.col("g.query").alias("query"), F.col("g.distinct").alias("distinct_score"), F.col("g.note").alias("note"))


_MESSAGE = """'Quota exceeded for metric: svc/v1/requests_per_' || event_type || CASE event_type WHEN 'click' THEN '_per_day' WHEN 'view' THEN 'PerDay' ELSE '' END || ', limit: ' || user_id || ', model: m. Please retry in ' || (event_id % 400) || '.5s. 429'"""


@query(f"""SELECT event_id, regexp_extract(m, 'retry in ([0-9.]+)s', 1)::DOUBLE AS retry_seconds, string_split(split_part(split_part(m, 'metric: ', 2), ',', 1), '/')[-1] AS metric, split_part(split_part(m, 'limit: ', 2), ',', 1)::INT AS quota_limit,
    event_type IN ('click', 'view') OR user_id >= 1000 OR event_id % 400 >= 300 AS daily, 'Busy/429' AS kind FROM (SELECT *, {_MESSAGE} AS m FROM events)""")
def quota_messages(t: Tables) -> DataFrame:
    """What a service's quota messages say, in the form that such messages have."""
    day = F.when(F.col("event_type") == "click", "_per_day").when(F.col("event_type") == "view", "PerDay").otherwise("")
    message = F.format_string("Quota exceeded for metric: svc/v1/requests_per_%s%s, limit: %d, model: m. Please retry in %d.5s. 429", F.col("event_type"), day, F.col("user_id"), F.col("event_id") % 400)
    q = labels.quota_message(message)
    return t.raw("events").select("event_id", q["retry_seconds"].alias("retry_seconds"), q["metric"].alias("metric"), q["limit"].alias("quota_limit"), q["daily"].alias("daily"), labels.error_kind(F.lit("Busy"), message).alias("kind"))


_DX, _DY, _CO = "((id * 37) % 201 - 100) / 50.0::DOUBLE", "((id * 91) % 201 - 100) / 50.0::DOUBLE", "((id * 17) % 11) / 10.0::DOUBLE"


@query(f"""SELECT id, CASE WHEN mag < 0.5 THEN 'gần như tĩnh' WHEN NOT (across OR along) THEN 'chuyển động tại chỗ (' || lvl || ')'
    WHEN co > 0.5 THEN 'camera lia sang ' || concat_ws('/', CASE WHEN across THEN CASE WHEN dx > 0 THEN 'trái' ELSE 'phải' END END, CASE WHEN along THEN CASE WHEN dy > 0 THEN 'lên' ELSE 'xuống' END END) || ' (' || lvl || ')'
    ELSE 'chủ thể/vật di chuyển sang ' || concat_ws('/', CASE WHEN across THEN CASE WHEN dx > 0 THEN 'phải' ELSE 'trái' END END, CASE WHEN along THEN CASE WHEN dy > 0 THEN 'xuống' ELSE 'lên' END END) || ' (' || lvl || ')' END AS phrase
    FROM (SELECT *, abs(dx) >= 0.1 AND abs(dx) >= 0.6 * abs(dy) AS across, abs(dy) >= 0.1 AND abs(dy) >= 0.6 * abs(dx) AS along, CASE WHEN mag > 1.6 THEN 'mạnh' WHEN mag > 0.8 THEN 'vừa' ELSE 'nhẹ' END AS lvl
    FROM (SELECT id, {_DX} AS dx, {_DY} AS dy, {_CO} AS co, mag_mean AS mag FROM ev WHERE mag_mean IS NOT NULL))""")
def motion_phrases(t: Tables) -> DataFrame:
    """Motion in words from a flow vector, its magnitude and coherence."""
    i = F.col("id")
    dx, dy, co = ((i * 37) % 201 - 100) / 50.0, ((i * 91) % 201 - 100) / 50.0, ((i * 17) % 11) / 10.0
    return t.ev.where("mag_mean is not null").select("id", labels.motion_phrase(dx, dy, F.col("mag_mean"), co).alias("phrase"))


_ENDS = "'^\\s+|\\s+$', '', 'g'"


@query(f"""SELECT caption_id, regexp_replace(regexp_replace(caption, '\\nTEXT:[\\s\\S]*$', ''), {_ENDS}) AS said, CASE WHEN seen = '(không có)' THEN '' ELSE seen END AS seen
    FROM (SELECT *, regexp_replace(regexp_extract(caption, '\\nTEXT:([\\s\\S]*)$', 1), {_ENDS}) AS seen FROM ca)""")
def caption_parts(t: Tables) -> DataFrame:
    """All captions and the words seen on screen, taken apart, also null ones and those that begin or end with a line
    break."""
    c = labels.split_caption(F.col("caption"), labels.stripped)
    return t.ca.select("caption_id", c["caption"].alias("said"), c["seen"].alias("seen"))


@query("""SELECT video_id, s AS seconds, CASE WHEN s >= 3600 THEN printf('%dh%02dm%02ds', s // 3600, s % 3600 // 60, s % 60) WHEN s >= 60 THEN printf('%dm%02ds', s // 60, s % 60) ELSE printf('%ds', s) END AS text
    FROM (SELECT video_id, CAST(floor(n_frames / fps) AS BIGINT) AS s FROM vi)""")
def durations(t: Tables) -> DataFrame:
    """Lengths of videos as text."""
    s = F.floor(F.col("n_frames") / F.col("fps"))
    return t.vi.select("video_id", s.alias("seconds"), ids.duration_text(s).alias("text"))


@query("SELECT collection, max(CAST(regexp_extract(video_id, '([0-9]+)$', 1) AS INTEGER)) + 1 AS next_number FROM vi GROUP BY 1")
def next_numbers(t: Tables) -> DataFrame:
    """The next free number in each collection."""
    return t.vi.groupBy("collection").agg(ids.next_index(F.col("video_id")).alias("next_number"))


@query("""SELECT id, least(greatest(1, CAST(round_even(0.5::DOUBLE * fps / 5, 0) AS INTEGER)), greatest(1, (end_frame - start_frame + 1) // 3)) AS half_window, greatest(1, CAST(ceil(0.4::DOUBLE * fps / 5) AS INTEGER)) AS min_gap,
    CAST(trunc(1.2::DOUBLE * fps) AS BIGINT) AS max_gap, greatest(2, least(60, CAST(round_even(1 + coalesce(mag_mean, 0) / 0.25::DOUBLE, 0) AS INTEGER))) AS budget FROM ev
    WHERE start_frame IS NOT NULL AND end_frame >= start_frame""")
def frame_math(t: Tables) -> DataFrame:
    """Windows, gaps and budgets in samples and frames."""
    fps, n = F.col("fps"), frames.frame_count(F.col("start_frame"), F.col("end_frame"))
    return t.ev.where("start_frame is not null and end_frame >= start_frame").select("id", frames.window_frames(0.5, fps, 5, n).alias("half_window"), frames.gap_samples(0.4, fps, 5).alias("min_gap"), frames.frames_of(1.2, fps).alias("max_gap"), frames.keyframe_budget(F.coalesce("mag_mean", F.lit(0.0)), 0.25, F.lit(60)).alias("budget"))


@query("""SELECT video_id, greatest(2, CAST(round_even(width * 192.0::DOUBLE / greatest(width, height), 0) AS INTEGER)) AS w, greatest(2, CAST(round_even(height * 192.0::DOUBLE / greatest(width, height), 0) AS INTEGER)) AS h FROM vi""")
def scaled_sizes(t: Tables) -> DataFrame:
    """Pictures' sizes with a long side of 192."""
    scale = F.lit(192.0) / F.greatest("width", "height")
    return t.vi.select("video_id", frames.scaled_side(F.col("width"), scale).alias("w"), frames.scaled_side(F.col("height"), scale).alias("h"))


@query("""SELECT id, round(c, 6) AS cosine, round(d, 6) AS distance, round(d / 8, 6) AS rms FROM (SELECT a.vec_id AS id, list_dot_product(a.v, b.v) / sqrt(list_dot_product(a.v, a.v)) / sqrt(list_dot_product(b.v, b.v)) AS c, list_distance(a.v, b.v) AS d
    FROM (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings) a JOIN (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings) b ON b.vec_id = a.vec_id + 1)""")
def vector_math(t: Tables) -> DataFrame:
    """Cosine, distance and root mean square difference of each vector and the next."""
    e = t.raw("embeddings").select("vec_id", vectors.doubles(F.col("embedding")).alias("v"))
    pairs = e.alias("a").join(e.alias("b"), F.col("b.vec_id") == F.col("a.vec_id") + 1)
    a, b = F.col("a.v"), F.col("b.v")
    return pairs.select(F.col("a.vec_id").alias("id"), F.round(vectors.cosine(a, b), 6).alias("cosine"), F.round(vectors.distance(a, b), 6).alias("distance"), F.round(vectors.rms(a, b), 6).alias("rms"))


@query("""SELECT id, round(1 - cov / sqrt(va * vb), 6) AS difference, round(list_distance(mixed, av) , 6) AS noise FROM (SELECT id, av, list_dot_product(av, bv) - 64 * list_avg(av) * list_avg(bv) AS cov, list_dot_product(av, av) - 64 * list_avg(av) * list_avg(av) AS va,
    list_dot_product(bv, bv) - 64 * list_avg(bv) * list_avg(bv) AS vb, list_transform(list_zip(av, bv), lambda p: p[1] * 0.6::DOUBLE + p[2] * 0.4::DOUBLE) AS mixed FROM (SELECT a.vec_id AS id, a.embedding::DOUBLE[] AS av, b.embedding::DOUBLE[] AS bv FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1))""")
def histogram_math(t: Tables) -> DataFrame:
    """One minus the correlation of each vector and the next, and how far their blend is from the first."""
    e = t.raw("embeddings").select("vec_id", vectors.doubles(F.col("embedding")).alias("v"))
    pairs = e.alias("a").join(e.alias("b"), F.col("b.vec_id") == F.col("a.vec_id") + 1)
    a, b = F.col("a.v"), F.col("b.v")
    return pairs.select(F.col("a.vec_id").alias("id"), F.round(vectors.histogram_difference(a, b), 6).alias("difference"), F.round(vectors.distance(vectors.blend(a, b, 0.6), a), 6).alias("noise"))
