"""Streams published in sets that many tasks write, rows of a series typed and windowed once."""

import datetime as dt
import glob
import os

import pyspark.sql.functions as F
import pytest

from skywell.operators import clean, grid
from skywell.plans import stream_queries
from skywell.plans.pipeline import process_batch
from skywell.schema import SENSORS
from skywell.session import checkpoint_dir
from skywell.sources.messages import decode, keyed
from skywell.streaming import event_time
from skywell.streaming.ingest import ingest_batch

START = dt.datetime(2024, 1, 1)
KINDS = ["click", "error", "purchase", "signup", "view"]


def tables(spark, folder, rows=400, step=60):
    """Readings in four files, a minute apart."""
    made = [(i, START + dt.timedelta(seconds=i * step), i % 9, KINDS[i % 5], float(i % 40), "{}") for i in range(rows)]
    kind = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    for i in range(4):
        spark.createDataFrame(made[i::4], kind).coalesce(1).write.mode("append").parquet(f"{folder}/events.parquet")
    return str(folder)


@pytest.fixture
def one_file_a_task(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "4096")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def written(folder, ending):
    return [f for f in glob.glob(f"{folder}/*.{ending}") if os.path.getsize(f)]


def settled(spark):
    return set(glob.glob(f"{checkpoint_dir(spark)}/settled-*"))


def test_a_day_of_messages_is_published_by_many_tasks(spark, tmp_path, one_file_a_task):
    out = stream_queries.ingested(spark, tables(spark, tmp_path))
    assert len(written(f"{os.path.dirname(out)}/topic", "json")) >= 4
    assert spark.read.parquet(f"{out}/metrics").agg(F.sum("messages"), F.max("batch_id")).first()[:] == (400, 2)


def test_a_batch_types_its_messages_once_and_leaves_no_files(spark, tmp_path, monkeypatch):
    spark.range(1).count()
    before, calls = settled(spark), []
    from skywell.streaming import ingest

    monkeypatch.setattr(ingest, "settle", lambda df, settle=ingest.settle: calls.append(df.columns) or settle(df))
    from skywell.plans import fixtures

    ingest_batch(decode(keyed(fixtures.raw_messages(spark, tables(spark, tmp_path / "t")))), 0, str(tmp_path / "out"))
    assert len(calls) == 1 and "exclusion_reason" in calls[0]
    assert settled(spark) == before
    assert sum(spark.read.parquet(f"{tmp_path}/out/{t}").count() for t in ("clean", "excluded")) == 400


@pytest.mark.parametrize("fill", ["impute", "ffill", "interpolate"])
def test_fills_read_the_rows_of_a_series_once(spark, tmp_path, fill):
    """What is filled comes from the windowed rows as written, not from the source again."""
    spark.range(60).select(
        "id", (F.col("id") % 2).alias("k"), *[F.when(F.col("id") % 7 > 2, F.col("id") + i).cast("double").alias(c) for i, c in enumerate(SENSORS)]
    ).write.parquet(f"{tmp_path}/source")
    rows = spark.read.parquet(f"{tmp_path}/source")
    make = {
        "impute": lambda w: clean.impute(rows, ["k"], "id", w),
        "ffill": lambda w: grid.ffill(rows, SENSORS, ["k"], "id", w),
        "interpolate": lambda w: grid.interpolate(rows, SENSORS, ["k"], "id", by="row", widths=w),
    }[fill]
    done = make((8, 2))
    assert not [f for f in done.inputFiles() if "/source/" in f]
    plain = lambda df: sorted(str([round(v, 9) if isinstance(v, float) else v for v in r]) for r in df.collect())
    assert plain(done) == plain(make(()))


def test_each_arrival_is_written_by_many_tasks_and_is_one_batch(spark, tmp_path, one_file_a_task):
    base = stream_queries.delivered(spark, tables(spark, tmp_path, step=3600))
    assert len(written(f"{base}/topic", "parquet")) > stream_queries.ARRIVALS
    batches = spark.read.parquet(f"{base}/out/on_time").select("batch_id").distinct().count()
    assert batches == stream_queries.ARRIVALS


def test_sessions_are_merged_before_they_are_shuffled(spark, tmp_path):
    spark.range(200).select(
        F.timestamp_add("MINUTE", F.col("id"), F.lit(START)).alias("event_time"), F.lit(1).alias("station")
    ).write.parquet(f"{tmp_path}/rows")
    rows = spark.readStream.schema("event_time timestamp, station int").parquet(f"{tmp_path}/rows").withWatermark("event_time", "1 hour")
    job = event_time.run_table(
        event_time.sessions(rows, "10 minutes", ["station"], n=F.count("*")), f"{tmp_path}/out", f"{tmp_path}/offsets"
    )
    job.awaitTermination()
    below = job._jsq.explainInternal(False).split("Exchange hashpartitioning(station")[-1]
    assert "MergingSessions" in below or "UpdatingSessions" in below
    assert spark.conf.get(event_time.MERGED, "false") == "false"


def test_bounded_fills_and_means_share_one_shuffle(spark):
    rows = spark.range(40).select(
        "id", F.expr("id div 10").alias("b"), F.lit("2024-01-01T00:00:00").alias("timestamp"), F.lit("01/01/2024").alias("date"),
        F.lit("00.00.00").alias("time"), F.lit("s").alias("source"), F.lit(True).alias("simulation"),
        *[F.when(F.col("id") % 3 == 0, "-200").otherwise(F.col("id").cast("string")).alias(c) for c in SENSORS],
    )
    excluded = process_batch(rows, ["b"], "id", ())[1]
    excluded.collect()
    assert excluded._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("Exchange hashpartitioning") == 1
