"""Late, repeated and timeless readings, and state that survives replays."""

import datetime as dt

from pyspark.sql import functions as F

from skywell.schema import LIVE_WINDOWS
from skywell.sources.files import read_batch
from skywell.streaming import event_time
from skywell.streaming.stateful import run_last_n

START = dt.datetime(2024, 1, 1)


def readings(spark, rows):
    return spark.createDataFrame([(i, None if h is None else START + dt.timedelta(hours=h)) for i, h in rows], "id long, event_time timestamp")


def ids(spark, out, table, batch):
    return sorted(r.id for r in read_batch(spark, f"{out}/{table}", batch).collect())


def test_batches_are_judged_by_those_before(spark, tmp_path):
    out = str(tmp_path)
    event_time.sort_out(readings(spark, [(1, None)]), 0, out, "10 hours")
    event_time.sort_out(readings(spark, [(2, 5), (3, 50), (4, 0)]), 1, out, "10 hours")  # nothing is late before a watermark
    event_time.sort_out(readings(spark, [(5, 41), (6, 40), (7, 30), (8, None)]), 2, out, "10 hours")
    event_time.sort_out(readings(spark, []), 3, out, "10 hours")
    event_time.sort_out(readings(spark, [(9, 40), (10, 45)]), 4, out, "10 hours")
    for _ in range(2):  # a repeated batch changes nothing
        assert [ids(spark, out, "on_time", i) for i in range(5)] == [[], [2, 3, 4], [5], [], [10]]
        assert [ids(spark, out, "late", i) for i in range(5)] == [[1], [], [6, 7, 8], [], [9]]
        event_time.sort_out(readings(spark, [(5, 41), (6, 40), (7, 30), (8, None)]), 2, out, "10 hours")
    reasons = {r.id: r.late_reason for r in spark.read.parquet(f"{out}/late").collect()}
    assert reasons == {1: "NO_EVENT_TIME", 8: "NO_EVENT_TIME", 6: "LATE", 7: "LATE", 9: "LATE"}


def test_engine_state_after_late_and_replayed_readings(spark, tmp_path):
    base = str(tmp_path)
    kind = "k string, ts timestamp_ntz, co_gt double, nox_gt double, no2_gt double, c6h6_gt double"
    rows = [(k, START + dt.timedelta(hours=i), float(i), None if i % 3 else 1.0, 2.0, i % 7 + 0.5) for k in "ab" for i in range(300)]
    parts = [rows[200:500], rows[:250], rows[100:350], rows[450:] + [(None, START, 1.0, 1.0, 1.0, 1.0), ("a", None, 9.0, 9.0, 9.0, 9.0)]]
    for p in parts:
        spark.createDataFrame(p, kind).coalesce(1).write.mode("append").parquet(f"{base}/in")
    stream = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    run_last_n(stream, f"{base}/stats", f"{base}/offsets", "ts", ["k"]).awaitTermination()
    stats = spark.read.parquet(f"{base}/stats")
    newest = stats.groupBy("k", "window", "channel").agg(F.max_by(F.struct("count", "mean", "min", "max"), "batch_id").alias("s"))
    got = {(r.k, r.window, r.channel): r.s for r in newest.collect()}
    for k in "ab":
        for window, n in LIVE_WINDOWS.items():
            held = range(max(300 - n, 0), 300)
            s = got[k, window, "co_gt"]
            assert (s["count"], s["min"], s["max"], s["mean"]) == (len(held), min(held), 299.0, sum(held) / len(held))
            assert got[k, window, "nox_gt"]["count"] == sum(i % 3 == 0 for i in held)
    assert got[None, "hourly", "co_gt"]["count"] == 1
