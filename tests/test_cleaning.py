"""Cleaning, imputation, derived columns and quality on literal rows."""

import datetime as dt
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from skywell.functions.scalars import parse_locale_number, season
from skywell.operators import clean, derive, grid, metrics, quality
from skywell.plans.pipeline import process_batch
from skywell.schema import CLEAN_RANGES, FLAT_COLUMNS, MESSAGE_SCHEMA, SENSORS, legacy_ranges
from skywell.sources.files import load_table, read_sensor_csv, require_columns
from skywell.sources.messages import decode, keyed, time_range, to_messages

# Ten readings of one evening and their published indices
# (CO, NOx, NO2, temperature, humidity, air quality index, comfort index).
PUBLISHED = [
    (2.6, 166.0, 113.0, 13.6, 48.9, 96.74037361799466, 82.32, 1.0),
    (2.0, 103.0, 92.0, 13.3, 47.7, 71.35729786797268, 80.76, 1.0),
    (2.2, 131.0, 114.0, 11.9, 54.0, 84.72777794070208, 76.6, 1.0),
    (2.2, 172.0, 122.0, 11.0, 60.0, 93.84615384615384, 70.0, 1.0),
    (1.6, 131.0, 116.0, 11.2, 59.6, 75.98881198862136, 70.72, 1.0),
    (1.2, 89.0, 96.0, 11.2, 59.2, 57.59135165254112, 71.03999999999999, 0.9),
    (1.2, 62.0, 77.0, 11.3, 56.8, 48.20991817941875, 73.16, 0.9),
    (1.0, 62.0, 76.0, 10.7, 60.0, 44.88709346315141, 69.39999999999999, 0.9),
    (0.9, 45.0, 60.0, 10.7, 59.7, 36.44908941611191, 69.63999999999999, 0.9),
    (0.6, 45.0, 60.0, 10.3, 60.2, 31.83370480072729, 68.44000000000001, 0.9),
]


def message(ts, source="a", **sensors):
    data = {c: sensors.get(c) for c in SENSORS}
    return (ts, "d", "t", data, {"source": source, "simulation": True, "original_timestamp": ts})


def flat(spark, messages):
    rows = [(i, *m) for i, m in enumerate(messages)]
    schema = "n long, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in MESSAGE_SCHEMA)
    return clean.flatten_messages(spark.createDataFrame(rows, schema))


def test_published_indices(spark):
    rows = [message(f"2004-03-10T{18 + i if i < 6 else i - 6:02d}:00:00", co_gt=str(r[0]).replace(".", ","), nox_gt=str(r[1]),
                    no2_gt=str(r[2]), temperature=str(r[3]), relative_humidity=str(r[4]), absolute_humidity="0,7")
            for i, r in enumerate(PUBLISHED)]
    rows = [(ts, d, t, {**s, **{c: s[c] or "1" for c in SENSORS}}, m) for ts, d, t, s, m in rows]
    done, excluded = process_batch(flat(spark, rows).withColumn("b", F.lit(1)), ["b"], "n", ())
    got = {r.n: r for r in done.collect()}
    assert excluded.count() == 0
    for i, want in enumerate(PUBLISHED):
        assert got[i].air_quality_index == want[5]
        assert got[i].comfort_index == pytest.approx(want[6], abs=1e-12)
        assert got[i].quality_score == pytest.approx(want[7], abs=1e-12)
    assert done.columns[2:] == [*FLAT_COLUMNS, "hour", "day_of_week", "month", "season", "air_quality_index", "comfort_index", "quality_score"]


def test_numbers_and_seasons(spark):
    texts = [("1,5", 1.5), ("-200", -200.0), ("abc", None), (None, None), ("x-3.25y7", -3.25), ("7.", 7.0), ("", None)]
    df = spark.createDataFrame(texts, "t string, want double")
    assert [r.got for r in df.select(parse_locale_number("t").alias("got")).collect()] == [w for _, w in texts]
    months = spark.range(1, 13).select(season(F.col("id")).alias("s"))
    assert [r.s for r in months.collect()] == ["Winter"] * 2 + ["Spring"] * 3 + ["Summer"] * 3 + ["Autumn"] * 3 + ["Winter"]


def test_exclusions_in_order_with_texts(spark):
    rows = [
        message("2004-03-10"), message(None), message("nonsense"),
        message("2004-03-10T01:00:00", **{c: "-200" for c in SENSORS}),
        message("2004-03-10T02:00:00", co_gt="60", nox_gt="1052"),
        message("2004-03-10T03:00:00", nox_gt="1052"), message("2004-03-10T04:00:00", c6h6_gt="63,7"),
        message("2004-03-10T05:00:00", relative_humidity="-1"), message("2004-03-10T06:00:00", temperature="-40"),
    ]
    got = {r.n: (r.exclusion_reason, r.exclusion_details) for r in clean.classify_exclusions(flat(spark, rows)).collect()}
    assert [got[i][0] for i in range(9)] == [
        "timestamp_incomplete", "timestamp_invalid", "timestamp_invalid", "completely_empty", "co_gt_out_of_range",
        "nox_gt_out_of_range", "c6h6_gt_out_of_range", "relative_humidity_out_of_range", None,
    ]
    assert got[5][1] == "nox_gt outside range [0, 1000]"
    assert got[7][1] == "relative_humidity outside range [0, ∞)"
    legacy = clean.classify_exclusions(flat(spark, rows), legacy_ranges(CLEAN_RANGES)).filter("n = 6").first()
    assert legacy.exclusion_reason is None


def series(seed, n, keys, hot):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rnd.random() < hot else rnd.choice(keys)
        rows.append((i, key, None if rnd.random() < 0.6 else round(rnd.uniform(0, 9), 2), None if rnd.random() < 0.7 else rnd.random()))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_bucketed_fills_equal_pandas(spark, seed):
    """One key holds more than a third; gaps and whole empty buckets cross the bucket edges."""
    rows = [r if not 40 < r[0] < 110 else (*r[:2], None, None) for r in series(seed, 300, ["a", "b", None], 0.4)]
    df = spark.createDataFrame(rows, "n long, k string, x double, y double")
    pdf = pd.DataFrame(rows, columns=["n", "k", "x", "y"]).assign(k=lambda d: d.k.fillna("none"))
    want_x = pdf.groupby("k").x.ffill()
    want_y = pdf.groupby("k").y.transform(lambda s: s.interpolate())
    want_mean = pdf.assign(x=want_x).groupby("k").x.transform(lambda s: s.fillna(s.mean()))
    for widths in [(), (7, 3)]:
        filled = grid.ffill(df, ["x"], ["k"], "n", widths)
        mean = grid.fill_mean(filled.withColumn("m", F.col("x")), ["m"], ["k"], bounded=not widths)
        got = grid.interpolate(mean, ["y"], ["k"], "n", by="row", widths=widths).toPandas().sort_values("n")
        np.testing.assert_allclose(got.x.to_numpy(float), want_x.to_numpy(float))
        np.testing.assert_allclose(got.m.to_numpy(float), want_mean.to_numpy(float))
        np.testing.assert_allclose(got.y.to_numpy(float), want_y.to_numpy(float))


def test_time_grid_equals_pandas(spark):
    rnd = random.Random(5)
    start = dt.datetime(2024, 1, 1)
    rows = [(k, start + dt.timedelta(hours=h), rnd.random() if rnd.random() < 0.8 else None)
            for k in ("a", "b") for h in range(400) if rnd.random() < 0.5 and not 100 < h < 180]
    rows.append(("a", start + dt.timedelta(hours=200, minutes=30), 9.0))  # off the grid
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, x double")
    for widths in [(), (20 * 3600, 4)]:
        got = grid.regular_grid(df, ["x"], ["k"], "ts", widths=widths, fill=3).toPandas()
        for k in ("a", "b"):
            s = pd.DataFrame([r[1:] for r in rows if r[0] == k], columns=["ts", "x"]).set_index("ts").x.sort_index().asfreq("h")
            mine = got[got.k == k].sort_values("ts")
            assert list(mine.ts) == list(s.index)
            np.testing.assert_allclose(mine.x.to_numpy(float), s.interpolate(method="time", limit=3).to_numpy(float))


def test_seasonal_fill_falls_back_to_the_median(spark):
    start = dt.datetime(2024, 1, 1)
    rows = [(start + dt.timedelta(hours=h), None if h in (5, 29, 30) else float(h)) for h in range(48)]
    got = {r.ts.hour + 24 * (r.ts.day - 1): r.x for r in grid.seasonal_fill(spark.createDataFrame(rows, "ts timestamp_ntz, x double"), ["x"], [], "ts").collect()}
    assert got[30] == 6.0  # the only other 06:00
    assert got[5] == got[29] == np.median([h for h in range(48) if h not in (5, 29, 30)])


def test_dedupe_keeps_the_first(spark):
    df = spark.createDataFrame([("a", 1, 2, 5.0), ("a", 1, 1, None), ("b", 1, 0, 7.0)], "k string, ts int, tie int, x double")
    assert sorted(map(tuple, grid.dedupe_time(df, ["k"], "ts", "tie").collect()), key=str) == [("a", 1, 1, None), ("b", 1, 0, 7.0)]


def test_empty_batch_verdict(spark):
    df = spark.createDataFrame([], ", ".join(f"{c} double" for c in SENSORS) + ", quality_score double")
    r = quality.validate(df).first()
    assert (r.total_records, r.valid_records, r.average_quality_score, r.completeness_score, r.poor) == (0, 0, 0.0, 0.0, 0)


def test_alert_texts_and_severity(spark):
    m = spark.createDataFrame(
        [(1, 100, 12.5, 80, 60, 0.4, 7)],
        "batch_id long, messages long, seconds double, total_records long, valid_records long, average_quality_score double, range_violations long",
    ).withColumn("batch_time", F.lit("2024-01-01").cast("timestamp"))
    got = {r.type: (r.message, r.severity) for r in metrics.alerts(m).collect()}
    assert got == {
        "HIGH_PROCESSING_TIME": ("Batch processing took 12.50s", "WARNING"),
        "LOW_DATA_QUALITY": ("Average quality score: 0.400", "CRITICAL"),
        "HIGH_ERROR_RATE": ("Error rate: 20/100", "CRITICAL"),
        "HIGH_RANGE_VIOLATIONS": ("Range violations: 7/100", "WARNING"),
    }
    assert spark.range(1).select(metrics.severity(F.lit("OTHER")).alias("s")).first().s == "INFO"


def test_raw_file_to_messages_and_back(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text("Date;Time;CO(GT);PT08.S1(CO);C6H6(GT);NOx(GT);T\n10/03/2004;18.00.00;2,6;1360;11,9;166;13,6\n11/03/2004;bad;1;2;3;4;5\n")
    raw = read_sensor_csv(spark, str(path))
    assert raw.filter("datetime IS NULL").count() == 1
    sent = keyed(to_messages(raw.filter("datetime IS NOT NULL"), "station"))
    assert sent.first().key == "1078941600.0"
    row = clean.flatten_messages(decode(sent)).first()
    assert (row.timestamp, row.co_gt, row.temperature, row.relative_humidity, row.source) == ("2004-03-10T18:00:00", "2,6", "13,6", None, "station")
    assert time_range(decode(sent), "2004-03-10T18:00:00", "2004-03-10T19:00:00").count() == 1
    assert time_range(decode(sent), "2004-03-10T19:00:00").count() == 0
    with pytest.raises(ValueError, match="NOx"):
        require_columns(raw.drop("NOx(GT)"), ["Date", "NOx(GT)"])


def test_messages_without_fields_and_broken_json(spark):
    values = [('{"timestamp":"2024-01-01T00:00:00","sensor_data":{"co_gt":2.5,"benzene_gt":1},"metadata":{}}',), ("not json",)]
    rows = clean.flatten_messages(decode(spark.createDataFrame(values, "value string"))).collect()
    assert rows[0].co_gt == "2.5" and rows[0].nox_gt is None and rows[0].source is None
    assert rows[1].timestamp is None


def test_tables_round_trip(spark, tmp_path):
    from skywell.sources.files import append_json, export_csv

    df = spark.createDataFrame([("2024-01-01 01:00:00", 1.0), ("bad", 2.0)], "timestamp string, x double")
    export_csv(df, str(tmp_path / "out.csv"))
    assert load_table(spark, str(tmp_path / "out.csv")).count() == 1
    append_json(df, str(tmp_path / "log"))
    append_json(df, str(tmp_path / "log"))
    assert spark.read.json(str(tmp_path / "log")).count() == 4


def test_legacy_scope_of_index_is_the_batch(spark):
    df = spark.createDataFrame([(1, 2.0, 1.0, 1.0), (1, 1.0, 1.0, 1.0), (2, 5.0, 0.0, None)], "b int, co_gt double, nox_gt double, no2_gt double")
    for bounded in (False, True):
        got = sorted(r.air_quality_index for r in derive.air_quality_index(df, ["b"], bounded=bounded).collect())
        assert got == pytest.approx([40.0, 80.0, 100.0])
    assert not math.isnan(got[0])
