"""Micro-batches without rows for one of their tables, and what the engine observes."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from skywell.operators.metrics import batch_metrics, error_counts
from skywell.plans import fixtures
from skywell.sources.files import read_batch
from skywell.sources.messages import decode, keyed, read_messages, write_messages
from skywell.streaming.ingest import ProgressLog, ingest_batch, run_ingest
from skywell.streaming.live import refresh
from tests.test_queries import SF


def messages(spark, condition):
    return decode(keyed(fixtures.raw_messages(spark, SF).filter(condition)))


GOOD = "event_id % 89 <> 0 AND event_id % 97 <> 0 AND event_id % 101 <> 0"


def test_batches_without_excluded_without_clean_and_without_any_rows(spark, tmp_path):
    out = str(tmp_path)
    good = messages(spark, GOOD + " AND event_id < 60")
    ingest_batch(good, 0, out, as_of="2024-02-01")
    n = read_batch(spark, f"{out}/excluded", 0).count()
    kept = read_batch(spark, f"{out}/clean", 0).count()
    assert kept + n == good.count() > 0
    ingest_batch(messages(spark, "event_id % 101 = 0"), 1, out, as_of="2024-02-01")
    assert read_batch(spark, f"{out}/clean", 1).count() == 0 < read_batch(spark, f"{out}/excluded", 1).count()
    ingest_batch(good.limit(0), 2, out, as_of="2024-02-01")
    rows = {r.batch_id: r for r in spark.read.parquet(f"{out}/metrics").collect()}
    assert rows[2].messages == rows[2].total_records == rows[1].total_records == 0 and rows[0].messages == good.count()
    assert spark.read.parquet(f"{out}/clean").count() == kept


def test_a_healthy_feed_has_no_excluded_row(spark, tmp_path):
    out = str(tmp_path)
    good = messages(spark, GOOD + " AND event_id < 400").join(spark.range(1)).drop("id")
    ingest_batch(good, 0, out)
    refused = read_batch(spark, f"{out}/excluded", 0).select("timestamp", "source").distinct()
    clean = good.select("*", F.col("metadata.source").alias("source")).join(refused, ["timestamp", "source"], "left_anti").drop("source")
    ingest_batch(clean.limit(40), 1, out)
    assert read_batch(spark, f"{out}/excluded", 1).count() == 0 < read_batch(spark, f"{out}/clean", 1).count()


def test_observed_metrics_are_those_of_the_written_rows(spark, tmp_path):
    out = str(tmp_path)
    raw = messages(spark, "event_id < 500")
    ingest_batch(raw, 0, out, as_of="2024-02-01")
    clean = read_batch(spark, f"{out}/clean", 0)
    total = spark.createDataFrame([(0, raw.count(), 0.0, dt.datetime(2024, 2, 1))], "batch_id bigint, messages bigint, seconds double, batch_time timestamp")
    want = batch_metrics(clean, "batch_id", total).first().asDict()
    got = read_batch(spark, f"{out}/metrics", 0).first().asDict()
    assert set(got) == set(want)
    assert all(abs(got[c] - want[c]) < 1e-9 for c in want if c not in ("seconds", "batch_time"))


def test_no_anomaly_in_the_last_batch_and_no_usable_time(spark, tmp_path):
    start = dt.datetime(2024, 1, 1)
    names = "ts timestamp_ntz, co_gt double, nox_gt double, no2_gt double, c6h6_gt double"
    out = str(tmp_path)
    refresh(spark.createDataFrame([(None, 1.0, 1.0, 1.0, 1.0)], names), 0, out, "ts")
    assert read_batch(spark, f"{out}/state", 0).count() == 0
    spike = [(start + dt.timedelta(hours=i), 100.0 if i == 23 else 1.0 + i % 2, 1.0 + i % 3, 2.0, 3.0) for i in range(24)]
    refresh(spark.createDataFrame(spike, names), 1, out, "ts")
    calm = [(start + dt.timedelta(hours=24 + i), 1.0 + i % 2, 1.0 + i % 3, 2.0, 3.0) for i in range(24)]
    refresh(spark.createDataFrame(calm, names), 2, out, "ts")
    assert [read_batch(spark, f"{out}/anomalies", i).count() for i in range(3)] == [0, 1, 0]


def test_the_engines_progress_and_errors_are_logged_and_counted(spark, tmp_path):
    """a table that can't be written, the restart that can, and what each micro-batch took in."""
    out = tmp_path / "out"
    write_messages(fixtures.raw_messages(spark, SF).filter("event_id < 300"), "json", str(tmp_path / "topic"))
    stream = read_messages(spark, "json", str(tmp_path / "topic"))
    log = ProgressLog(spark, "feed", f"{out}/progress", f"{out}/errors")
    spark.streams.addListener(log)
    try:
        out.mkdir()
        blocked = {"excluded": "EXCLUDED_SAVE_ERROR", "clean": "SAVE_ERROR"}
        for name in blocked:  # a file stands where the table's folder should
            (out / name).write_text("x")
        for name in ("clean", "excluded", None):
            job = run_ingest(stream, str(out), str(tmp_path / "offsets"), as_of="2024-02-01", name="feed")
            if name is None:
                job.awaitTermination()
            else:
                with pytest.raises(Exception):
                    job.awaitTermination()
                (out / name).unlink()
        for _ in range(100):
            if (out / "progress").exists() and spark.read.json(f"{out}/errors").count() == 4:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(log)
    counted = {r.type: r.n for r in error_counts(spark.read.json(f"{out}/errors")).collect()}
    assert counted == {"SAVE_ERROR": 1, "EXCLUDED_SAVE_ERROR": 1, "CONSUMPTION_ERROR": 2}
    done = spark.read.json(f"{out}/progress").collect()
    assert [r.batch_id for r in done] == [0] and done[0].rows >= 300 and done[0].milliseconds > 0
    assert spark.read.parquet(f"{out}/metrics").first().messages == 300
