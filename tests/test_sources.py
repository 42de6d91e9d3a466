import json

import numpy as np
import pytest

from filmstrip.sources import readers, schemas, writers


def test_json_lines(spark, tmp_path):
    path = str(tmp_path / "q.jsonl")
    lines = [{"query_id": "a", "query": "x", "distinct": 1}, {"query_id": "a", "query": "y", "distinct": 2}, {"query_id": "b", "query": "z"}]
    with open(path, "w") as f:
        f.write("\n\n".join(map(json.dumps, lines)) + "\n{broken\n")
    assert readers.json_lines(spark, path, schemas.QUERIES, tolerant=True).count() == 3
    with pytest.raises(Exception):
        readers.json_lines(spark, path, schemas.QUERIES).collect()
    assert {r.query_id: r.query for r in readers.last_lines(spark, path, schemas.QUERIES, "query_id").collect()} == {"a": "y", "b": "z"}


def test_truth_and_answers(spark, tmp_path):
    sample = {"query_id": "k", "query": "q", "gt_video": "v", "source": "s", "gt_ranges": {"tol5": [1, 9]}, "needs_review": False}
    (tmp_path / "gt.json").write_text(json.dumps({"meta": {}, "samples": [sample, sample | {"query_id": "r", "needs_review": True}]}, indent=1))
    rows = readers.truth_ranges(readers.truth(spark, str(tmp_path / "gt.json"))).collect()
    assert [(r.query_id, r.level, r.first, r.last) for r in rows] == [("k", "tol5", 1, 9)]
    (tmp_path / "a.json").write_text(json.dumps({"k": [["v", 3], ["w", "x"]]}))
    got = readers.ranked_answers(spark, str(tmp_path / "a.json")).collect()
    assert [(r.rank, r.video_id, r.frame_id) for r in got] == [(1, "v", 3), (2, "w", None)]


def test_matrices_and_maps(spark, tmp_path):
    np.save(tmp_path / "m.npy", np.eye(3, dtype=np.float32))
    assert {(r.row, tuple(r.vector)) for r in readers.matrices(spark, str(tmp_path)).collect()} == {(i, tuple(np.eye(3)[i])) for i in range(3)}
    (tmp_path / "m.csv").write_text("n,pts_time,fps,frame_idx\n1,0.5,25,12\nx,1,25,3\n2,,25,50\n")
    assert [(r.n, r.pts_time) for r in readers.frame_map(spark, str(tmp_path / "m.csv")).collect()] == [(1, 0.5), (2, None)]


def test_inventory_and_records(spark, tmp_path):
    (tmp_path / "L01" / "L01_V1").mkdir(parents=True)
    (tmp_path / "L01" / "L01_V1" / "001.jpg").write_bytes(b"x")
    (tmp_path / "a.mp4").write_bytes(b"abc")
    assert [(r.video_id, r.names) for r in readers.inventory(spark, str(tmp_path)).collect()] == [("L01_V1", ["001.jpg"])]
    assert [(r.stem, r.bytes) for r in readers.list_files(spark, str(tmp_path)).collect()] == [("a", 3)]
    df = spark.createDataFrame([("v", 3, 0, 7, 25.0, 0.28, "a\\b.jpg")], "video_id string, shot_index int, id long, frame_index long, fps double, time_sec double, path string")
    r = readers.keyframe_records(df).first()
    assert (r.keyframe_id, r.shot_id, r.frame_idx, r.keyframe_path) == ("v_kf000000", "v_shot00003", 7, "a/b.jpg")
    assert readers.keyframe_records(df, "numeric").first().keyframe_id == 1


def test_search_hits(spark):
    df = spark.createDataFrame([('{"hits": [{"video_id": "v", "frame": 3}]}',), ('[{"video_id": "w", "frame_idx": 4}]',), ("{}",)], "response string")
    got = [r.h for r in df.select(readers.search_hits().alias("h")).collect()]
    assert [[(h.video_id, h.frame_id) for h in (x or [])] for x in got] == [[("v", 3)], [("w", 4)], []]


def test_overrides():
    old = {"a": {"n": 1, "x": 0.5, "on": False}, "s": "t"}
    assert readers.overridden(old, ["a.n=3", "a.x=2", "a.on=true", "s=u", "b.c=z"]) == {"a": {"n": 3, "x": 2.0, "on": True}, "s": "u", "b": {"c": "z"}}
    assert old["a"]["n"] == 1


def test_finalize(spark, tmp_path):
    k = spark.createDataFrame([("b", 0, 5, 0.2, 25.0, "p"), ("a", 1, 9, 0.3, 25.0, "p"), ("a", 0, 2, 0.1, 25.0, "p")], "video_id string, shot_index int, frame_idx long, pts_time double, fps double, keyframe_path string")
    shots = spark.createDataFrame([("a", 0)], "video_id string, shot_index int")
    writers.finalize(k, shots, None, str(tmp_path / "out"))
    rows = {r.keyframe_id: (r.id, r.n) for r in spark.read.json(str(tmp_path / "out" / "keyframes")).collect()}
    assert rows == {"a_kf000000": (0, 1), "a_kf000001": (1, 2), "b_kf000000": (2, 1)}
    assert not (tmp_path / "out" / "events").exists()
    packed = writers.packaged(writers.numbered(k.withColumn("keyframe_path", k.keyframe_path)), spark.createDataFrame([("a", "p")], "video_id string, name string"))
    assert {(r.video_id, r.name) for r in packed.collect()} == {("a", "001.jpg"), ("a", "002.jpg")}


def test_rewrite_keeps_one_backup(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    assert writers.rewritten(spark.range(5), path) == 5 and spark.read.parquet(path).count() == 3
    writers.rewritten(spark.range(5), path, dry_run=False)
    writers.rewritten(spark.range(7), path, dry_run=False)
    assert spark.read.parquet(path).count() == 7 and spark.read.parquet(path + ".bak").count() == 3


def test_put(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "id long, t string")
    b = spark.createDataFrame([(2, "z"), (3, "w")], "id long, t string")
    assert {tuple(r) for r in writers.put(a, b).collect()} == {(1, "x"), (2, "z"), (3, "w")} and writers.put(None, b).count() == 2


def test_writing_replaces_only_its_videos(spark, tmp_path):
    path = str(tmp_path / "v")
    writers.per_video(spark.createDataFrame([("a", 1), ("b", 2)], "video_id string, x long"), path)
    writers.per_video(spark.createDataFrame([("b", 3)], "video_id string, x long"), path)
    assert {(r.video_id, r.x) for r in spark.read.parquet(path).collect()} == {("a", 1), ("b", 3)}
