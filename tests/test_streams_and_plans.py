"""Replay of micro-batches, the live state, and the shape of physical plans."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from skywell.operators import clean, features, grid, live, outliers
from skywell.operators.ordered import fitted_widths
from skywell.plans import fixtures
from skywell.sources.messages import decode, keyed, read_messages, write_messages
from skywell.streaming.ingest import ingest_batch, run_ingest
from skywell.streaming.live import refresh
from tests.test_queries import SF

START = dt.datetime(2024, 1, 1)


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(spark, path, *drop):
    """The rows of a table without what depends on the clock."""
    rows = map(str, spark.read.parquet(path).drop(*drop).collect())
    return sorted(r for r in rows if "HIGH_PROCESSING_TIME" not in r)


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    messages = decode(keyed(fixtures.raw_messages(spark, SF).limit(200)))
    out = str(tmp_path / "out")
    ingest_batch(messages, 0, out, as_of="2024-02-01")
    ingest_batch(messages.limit(50), 1, out, as_of="2024-02-01")
    before = {t: rows_of(spark, f"{out}/{t}", "seconds") for t in ("clean", "excluded", "metrics", "alerts")}
    ingest_batch(messages, 0, out, as_of="2024-02-01")
    assert before == {t: rows_of(spark, f"{out}/{t}", "seconds") for t in before}
    total = spark.read.parquet(f"{out}/metrics").agg(F.sum("messages")).first()[0]
    assert total == len(before["clean"]) + len(before["excluded"]) == 250


def test_stream_equals_batch(spark, tmp_path):
    raw = fixtures.raw_messages(spark, SF)
    write_messages(raw, "json", str(tmp_path / "topic"))
    stream = read_messages(spark, "json", str(tmp_path / "topic"))
    run_ingest(stream, str(tmp_path / "a"), str(tmp_path / "offsets"), as_of="2024-02-01").awaitTermination()
    ingest_batch(decode(keyed(raw)), 0, str(tmp_path / "b"), widths=(86_400, 5), as_of="2024-02-01")
    for t in ("clean", "excluded"):
        digits = lambda p: sorted(
            str([round(v, 8) if isinstance(v, float) else v for v in r]) for r in spark.read.parquet(p).drop("batch_id").collect()
        )
        assert digits(f"{tmp_path}/a/{t}") == digits(f"{tmp_path}/b/{t}")
    again = run_ingest(stream, str(tmp_path / "a"), str(tmp_path / "offsets"))
    again.awaitTermination()
    assert not spark.read.parquet(f"{tmp_path}/a/clean").filter("batch_id > 0").count()


def test_a_failed_batch_is_recorded_and_raised(spark, tmp_path):
    write_messages(fixtures.raw_messages(spark, SF).limit(5), "json", str(tmp_path / "topic"))
    stream = read_messages(spark, "json", str(tmp_path / "topic"))
    job = run_ingest(stream, str(tmp_path / "out"), str(tmp_path / "offsets"), scope=("absent",))
    with pytest.raises(Exception):
        job.awaitTermination()
    assert spark.read.json(f"{tmp_path}/out/errors").first().type == "BATCH_PROCESSING_ERROR"


def test_live_state_is_the_newest_rows_in_any_order(spark, tmp_path):
    rows = [(START + dt.timedelta(hours=i), float(i), 1.0, 2.0, i % 7 + 0.5) for i in range(300)]
    names = "ts timestamp_ntz, co_gt double, nox_gt double, no2_gt double, c6h6_gt double"
    out = str(tmp_path / "live")
    for i, part in enumerate([rows[200:], rows[:150], rows[100:210]]):  # late and repeated rows
        refresh(spark.createDataFrame(part, names), i, out, "ts", identity=["ts"])
    refresh(spark.createDataFrame(rows[100:210], names), 2, out, "ts", identity=["ts"])  # the last batch again
    state = spark.read.parquet(f"{out}/state").filter("batch_id = 2")
    assert state.count() == 300
    stats = spark.read.parquet(f"{out}/stats").filter("batch_id = 2 AND window = 'hourly' AND channel = 'co_gt'").first()
    assert (stats["min"], stats["max"], stats["count"]) == (276.0, 299.0, 24)


def test_live_state_keeps_readings_of_one_time_and_the_latest_update(spark, tmp_path):
    rows = [(START + dt.timedelta(hours=i // 2), float(i), 1.0, 2.0, i % 7 + 0.5) for i in range(100)]  # two stations, no key
    names = "ts timestamp_ntz, co_gt double, nox_gt double, no2_gt double, c6h6_gt double"
    out = str(tmp_path / "live")
    for i, part in enumerate([rows[60:], rows[:60]]):
        refresh(spark.createDataFrame(part, names), i, out, "ts")
    assert spark.read.parquet(f"{out}/state").filter("batch_id = 1").count() == 100
    seen = spark.read.parquet(f"{out}/summary").filter("batch_id = 1").first()
    assert (seen.total_records, seen.last_update, seen.daily) == (100, rows[-1][0], 100)


def test_dense_sources_get_narrow_buckets(spark):
    df = spark.range(4000).select(F.lit("s").alias("k"), F.timestamp_add("SECOND", F.col("id"), F.lit(START).cast("timestamp_ntz")).alias("ts"))
    assert fitted_widths(df, ["k"], "ts", rows=100)[0] == 100
    assert fitted_widths(df, ["k"], "ts")[0] == 250_000


def orders_without_partition(text):
    """The order columns of windows that have no partition columns."""
    specs = re.findall(r"windowspecdefinition\((.*?), specifiedwindowframe", text)
    return [s for s in specs if re.match(r"^\S+ (ASC|DESC)", s)]


def test_long_series_never_meet_in_one_task(spark):
    """Rows of a keyless series are windowed per time bucket; only bucket summaries are not."""
    df = fixtures.hourly(spark, SF).select("ts", "nox_gt", "co_gt")
    gridded = plan(grid.regular_grid(df, ["nox_gt"], [], "ts", widths=(86_400 * 5, 10), fill=3))
    assert "windowspecdefinition(_b2" in gridded
    assert all(s.startswith("_b1") for s in orders_without_partition(gridded))
    lagged = plan(features.build_features(df, "ts"))
    assert "windowspecdefinition(_bucket" in lagged and not orders_without_partition(lagged)


def test_outliers_without_keys_do_not_shuffle_rows(spark):
    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    text = plan(outliers.zscore_outliers(lines, ["l_tax"], "l_shipdate", 1.0))
    main = text.split("Subquery")[0]
    assert "Exchange hashpartitioning" not in text and "Join" not in main


def test_small_summaries_are_broadcast_large_ones_joined(spark, monkeypatch):
    from skywell.functions import attach as module

    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    run = lambda: outliers.zscore_outliers(lines, ["l_tax"], "l_shipdate", 1.5, keys=["l_returnflag"])
    small = sorted(map(str, run().collect()))
    assert "BroadcastHashJoin" in plan(run())
    monkeypatch.setattr(module, "BROADCAST_GROUPS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in plan(run())
        assert sorted(map(str, run().collect())) == small
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_scans_read_only_what_is_needed(spark):
    events = fixtures.events(spark, SF)
    text = plan(live.latest_rows(events.select("ts", "event_id", "value"), 5, "ts", "event_id"))
    assert "TakeOrderedAndProject" in text and "props" not in text
    recent = clean.filter_last(events, "ts", "1 DAY").select("event_id")
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan(recent)
