from datetime import datetime, timedelta

import pandas as pd
import pytest

from filmstrip.streaming import quota, windows

T0 = datetime(2025, 1, 1)


def files(spark, path, batches):
    for b in batches:
        spark.createDataFrame(b, "k string, ts timestamp").coalesce(1).write.mode("append").parquet(path)


def test_rates_equal_the_batch(spark, tmp_path):
    path = str(tmp_path / "in")
    data = [("a", T0 + timedelta(seconds=20 * i)) for i in range(30)] + [("b", T0)]
    files(spark, path, [data[:15], data[15:]])
    s = windows.read_files(spark, path, spark.read.parquet(path).schema, 1)
    got = {(r.k, r.start): r.n for r in windows.to_files(windows.rates(s, "ts", "k"), "rates_test").collect()}
    assert got == {**{("a", T0 + timedelta(minutes=m)): 3 for m in range(10)}, ("b", T0): 1}


def test_sessions(spark, tmp_path):
    path = str(tmp_path / "in")
    files(spark, path, [[("a", T0), ("a", T0 + timedelta(minutes=10)), ("a", T0 + timedelta(hours=2))]])
    s = windows.read_files(spark, path, spark.read.parquet(path).schema)
    assert sorted(r.n for r in windows.to_files(windows.sessions(s, "ts", "k"), "sessions_test").collect()) == [1, 2]


def test_batches_resume(spark, tmp_path):
    path, seen = str(tmp_path / "in"), []
    files(spark, path, [[("a", T0)]])
    schema = spark.read.parquet(path).schema
    windows.run_available(windows.read_files(spark, path, schema), lambda df, i: seen.append(df.count()), str(tmp_path / "ck"))
    files(spark, path, [[("b", T0), ("c", T0)]])
    windows.run_available(windows.read_files(spark, path, schema), lambda df, i: seen.append(df.count()), str(tmp_path / "ck"))
    assert seen == [1, 2]


def test_grant():
    r = pd.DataFrame({"at": [0.0, 1.0, 2.0, 70.0, 90_000.0], "failed": [False, True, False, False, False]})
    ok, state = quota.grant(r, -1.0, 0, 0.0, 2, 60.0)
    assert ok == [True, True, False, False, True] and state[:2] == (90_000.0, 1)


def test_quota_stream(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.createDataFrame([("a", i, float(i), False) for i in range(5)] + [("b", 9, 0.0, False)], "k string, request_id long, at double, failed boolean").coalesce(1).write.parquet(path)
    s = windows.read_files(spark, path, spark.read.parquet(path).schema)
    got = windows.to_files(quota.quota(s, "k", 3), "quota_test", "append").collect()
    assert {r.request_id: r.granted for r in got} == {0: True, 1: True, 2: True, 3: False, 4: False, 9: True}


def test_rest():
    assert quota.rest(10, 10, 0.1, 0.9) == 15 and quota.rest(10, 50, 0.1, 0.9) == 60
    assert quota.rest(10, 40, 0.5, 0.9) == 10 and quota.rest(10, 10, 0, 0) == pytest.approx(3.5)
