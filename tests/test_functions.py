import pytest
from pyspark.sql import functions as F

from filmstrip.functions import frames, ids, labels, vectors
from filmstrip.functions.fold import fold, squeeze
from filmstrip.functions.models import BACKENDS, captioner, captions, decode, embed_text


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "raw,n,want",
    [
        ("1 | người đi\n2 | xe chạy", 2, ["người đi", "xe chạy"]),
        ("Đây là:\n1. một\n2. hai\n3. ba", 3, ["một", "hai", "ba"]),
        ("một\nhai", 3, ["một", "hai", ""]),
        ("[hết quota]", 3, ["", "", ""]),
        (" [lỗi api] 429", 1, [""]),
        ("• 1. chạy\n- 2) nhảy\n* 3: bơi", 3, ["chạy", "nhảy", "bơi"]),
        ("[1] chạy\nnhảy", 2, ["[1] chạy", "nhảy"]),
        ("123. chạy", 1, ["123. chạy"]),
        ("1 | a\r\n2 | b\u20283 | c", 3, ["a", "b", "c"]),
        ("1 | a\n5 | b", 3, ["a", "", ""]),
        (None, 2, ["", ""]),
        ("", 1, [""]),
        ("1 | a\n1 | b", 1, ["a"]),
    ],
)
def test_label_slots(spark, raw, n, want):
    assert one(spark, labels.label_slots(F.lit(raw).cast("string"), F.lit(n))) == want


def test_quota_message(spark):
    say = lambda text: tuple(one(spark, labels.quota_message(F.lit(text))))
    assert say("Quota exceeded for metric: generativelanguage.example/requests, limit: 30, model: m. Please retry in 39.8s.") == (39.8, "requests", 30, False)
    assert say("metric: a/b_per_day, limit: 5. retry in 2s") == (2.0, "b_per_day", 5, True)
    assert say("metric: x, limit: 1000") == (None, "x", 1000, True) and say("retry in 300.5s") == (300.5, "unknown", None, True)
    assert say("busy") == (None, "unknown", None, False)


def test_error_kind_and_order_words(spark):
    kind = lambda text: one(spark, labels.error_kind(F.lit("Busy"), F.lit(text)))
    assert kind("503 then 429") == "Busy/429" and kind("x" * 200 + "429") == "Busy" and kind("failed") == "Busy"
    tells = lambda text: one(spark, labels.has_any(F.lit(text), labels.SEQUENCE_WORDS))
    assert all(map(tells, ["Đầu tiên anh chạy", "chạy rồi ngã", "đang ngồi thì đứng", "liền nhảy", "dần dần"])) and not any(map(tells, ["rồi", "đang ngồi"]))


def test_motion_phrase(spark):
    say = lambda dx, dy, m, c: one(spark, labels.motion_phrase(F.lit(dx), F.lit(dy), F.lit(m), F.lit(c)))
    assert say(1.0, 0.0, 0.2, 0.9) == "gần như tĩnh"
    assert say(0.05, 0.05, 1.0, 0.9) == "chuyển động tại chỗ (vừa)"
    assert say(1.0, 0.2, 2.0, 0.9) == "camera lia sang trái (mạnh)"
    assert say(1.0, 0.9, 0.7, 0.1) == "chủ thể/vật di chuyển sang phải/xuống (nhẹ)"


def test_fold(spark):
    import unicodedata

    for text in ("Gần Như TĨNH", unicodedata.normalize("NFD", "gần như tĩnh"), "ｇần như tĩnh"):
        assert one(spark, fold(F.lit(text))) == "gan nhu tinh"
    assert one(spark, squeeze(F.lit("Đi - (nhẹ)"))) == "dinhe"
    assert one(spark, fold(F.lit(None).cast("string"))) is None


def test_paths(spark):
    got = one(spark, ids.parse_image_path(F.lit("a\\L01_V001\\shot0003_f0000120.jpg")))
    assert (got.video_id, got.shot, got.frame) == ("L01_V001", "shot0003", 120)
    with pytest.raises(Exception, match="not a keyframe path"):
        one(spark, ids.parse_image_path(F.lit("a/b.png")))
    assert one(spark, ids.duration_text(F.lit(3725.9))) == "1h02m05s"


def test_ranges(spark):
    got = one(spark, frames.tolerance_ranges(F.lit(10), F.lit(4), F.lit(21), F.lit(12)))
    assert got == {"tol5": [5, 12], "tol30": [0, 12], "tol90": [0, 12], "kf_span": [7, 15]}


def test_vectors(spark):
    arr = lambda *x: F.array(*[F.lit(float(v)) for v in x])
    assert one(spark, vectors.cosine(arr(1, 0), arr(2, 0))) == 1 and one(spark, vectors.cosine(arr(1, 0), arr(0, 3))) == 0
    assert one(spark, vectors.histogram_difference(arr(1, 1), arr(1, 2))) == 1
    assert one(spark, vectors.rms(arr(0, 0), arr(1, 1))) == 1


def test_stand_in_models(spark):
    df = spark.createDataFrame([(1, bytearray(b"\x0a\x0a")), (2, None)], "id long, image binary")
    got = {r.id: r.caption for r in captions(df, "id", "image").collect()}
    assert got == {1: "1 pictures, brightness 10", 2: None}
    with pytest.raises(ValueError, match="no captioner"):
        captioner("nobody")
    assert set(BACKENDS) == {"mock"}
    v = spark.createDataFrame([("a b",), (None,)], "t string").select(embed_text("t").alias("v")).collect()
    assert sum(x * x for x in v[0].v) == pytest.approx(1) and not any(v[1].v)


class Decoder:
    def frames(self, path, step, long_side):
        if "bad" in path:
            raise OSError("broken")
        for i in range(0, 10, step):
            yield i, bytes([i])


def test_decoding_isolates_failures(spark):
    got = decode(spark.createDataFrame([("a.mp4",), ("bad.mp4",)], "path string"), "path", Decoder).collect()
    assert [(r.path, r.frame_idx) for r in got if r.error is None] == [("a.mp4", 0), ("a.mp4", 5)]
    assert [r.error for r in got if r.error] == ["OSError: broken"]
