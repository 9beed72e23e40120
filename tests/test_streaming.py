"""The stream of events gives what the batch gives, and leaves late rows out."""

from datetime import datetime, timedelta

from millrace.streaming.counters import daily_counts, drain, q13_daily_stream

SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def test_stream_equals_batch(spark, tmp_path):
    day = datetime(2024, 1, 1)
    rows = [(i, day + timedelta(hours=7 * i), i % 3, "error" if i % 4 == 0 else "view", 1.0, None) for i in range(40)]
    df = spark.createDataFrame(rows, SCHEMA)
    df.coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    want = {tuple(r) for r in daily_counts(df).collect()}
    assert {(r.day, r.n_success, r.n_fail) for r in q13_daily_stream(spark, str(tmp_path)).collect()} == want


def test_late_rows(spark, tmp_path):
    for k, (day, n) in enumerate(((datetime(2024, 3, 1), 2), (datetime(2024, 1, 1), 5))):
        spark.createDataFrame([(i, day, 1, "view", 1.0, None) for i in range(n)], SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / f"part{k}"))
    stream = spark.readStream.schema(spark.read.parquet(str(tmp_path / "part0")).schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/part*")
    days = {r.day for r in drain(spark, daily_counts(stream)).collect()}
    assert "20240301" in days


def test_stream_equals_batch_over_many_files(spark, tmp_path):
    day = datetime(2024, 1, 1)
    for k in (9, 4, 7, 0, 5, 2, 8, 1, 6, 3):  # more files than one batch takes, in no order of time
        rows = [(100 * k + i, day + timedelta(days=3 * k, hours=7 * i), 1, "error" if i % 4 == 0 else "view", 1.0, None) for i in range(20)]
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "events.parquet"))
    want = {tuple(r) for r in daily_counts(spark.read.parquet(str(tmp_path / "events.parquet"))).collect()}
    got = [(r.day, r.n_success, r.n_fail) for r in q13_daily_stream(spark, str(tmp_path)).collect()]
    assert len(got) == len(want) and set(got) == want and sum(a + b for _, a, b in got) == 200
