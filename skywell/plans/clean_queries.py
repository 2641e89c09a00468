"""Queries over the raw messages: cleaning, imputation, derived columns, quality, metrics."""

from pyspark.sql import DataFrame, functions as F

from skywell.operators import clean, derive, grid, metrics, quality
from skywell.plans import ctes, fixtures
from skywell.plans.pipeline import process_batch
from skywell.plans.registry import final, query, rounded
from skywell.schema import CARRIED, DERIVED_COLUMNS, FLAT_COLUMNS, INTERPOLATED, SENSORS
from skywell.session import settle
from skywell.sources.messages import decode, keyed

BATCH, ORDER = ["batch_id"], "event_id"
SERIES_BUCKETS = (5_000, 1_000)  # event ids per bucket, buckets per second-level bucket


def flat(spark, sf_dir) -> DataFrame:
    return clean.flatten_messages(fixtures.raw_messages(spark, sf_dir))


def usable(spark, sf_dir) -> DataFrame:
    return clean.only(clean.type_columns(flat(spark, sf_dir)), F.col("exclusion_reason").isNull())


def cleaned(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    return process_batch(flat(spark, sf_dir), BATCH, ORDER, ())


TEXT_SENSORS = [
    f"CASE WHEN {fixtures.sentinel_test(i)} THEN -200 ELSE {x} END AS {c}"
    for i, (c, x) in enumerate(fixtures.READINGS.items())
]


@query(
    final(
        "", "events",
        ["event_id", "strftime(ts, '%d/%m/%Y') AS date", "strftime(ts, '%H.%M.%S') AS time",
         f"'station_' || (user_id % {fixtures.STATIONS}) AS source", "true AS simulation",
         """CASE WHEN event_id % 97 = 0 THEN strftime(ts, '%Y-%m-%d') WHEN event_id % 101 = 0 THEN 'garbage'
            ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS timestamp""",
         """CASE WHEN event_id % 97 = 0 THEN (epoch(date_trunc('day', ts))::BIGINT)::VARCHAR || '.0'
            WHEN event_id % 101 = 0 THEN NULL
            ELSE (epoch(date_trunc('second', ts))::BIGINT)::VARCHAR || '.0' END AS key"""],
        TEXT_SENSORS,
    )
)
def flatten_messages(spark, sf_dir):
    """Publish as keyed JSON, decode, flatten, read the numbers."""
    sent = keyed(fixtures.raw_messages(spark, sf_dir), keep=["event_id"]).withColumn("sent_key", F.col("key"))
    rows = clean.flatten_messages(decode(sent))
    return rounded(
        rows.select(
            "event_id", "date", "time", "source", "simulation", "timestamp", F.col("sent_key").alias("key"),
            *[clean.parse_locale_number(c).alias(c) for c in SENSORS],
        )
    )


@query(final(ctes.TYPED, "typed", ["event_id"], SENSORS))
def null_sentinels(spark, sf_dir):
    """B4, B5."""
    rows = flat(spark, sf_dir)
    return rounded(rows.select("event_id", *[clean.null_sentinel(clean.parse_locale_number(c)).alias(c) for c in SENSORS]))


@query(
    "SELECT " + " + ".join(f"count(*) FILTER ({fixtures.sentinel_test(i)})" for i in range(len(SENSORS)))
    + " AS sentinel_cells FROM events"
)
def count_sentinels(spark, sf_dir):
    """B5."""
    rows = flat(spark, sf_dir)
    return clean.count_sentinels(rows.select(*[clean.parse_locale_number(c).alias(c) for c in SENSORS]))


JUDGED = f"{ctes.TYPED}, judged AS (SELECT event_id, timestamp, coalesce(reason, {ctes.RANGE_REASON}) AS exclusion_reason FROM typed)"
DETAILS = "CASE exclusion_reason " + " ".join(
    f"WHEN '{k}' THEN '{v}'"
    for k, v in {
        "timestamp_incomplete": "Timestamp missing time component (YYYY-MM-DD)",
        "timestamp_invalid": "Unparseable timestamp format",
        "completely_empty": "All values are missing sentinel values",
        "co_gt_out_of_range": "co_gt outside range [0, 50]",
        "nox_gt_out_of_range": "nox_gt outside range [0, 1000]",
        "no2_gt_out_of_range": "no2_gt outside range [0, 500]",
        "c6h6_gt_out_of_range": "c6h6_gt outside range [0, 50]",
        "relative_humidity_out_of_range": "relative_humidity outside range [0, ∞)",
        "absolute_humidity_out_of_range": "absolute_humidity outside range [0, ∞)",
    }.items()
) + " END AS exclusion_details"


@query(final(JUDGED, "judged", ["event_id", "timestamp", "exclusion_reason", DETAILS]))
def classify_exclusions(spark, sf_dir):
    """B2-B7 without imputation."""
    return clean.classify_exclusions(flat(spark, sf_dir)).select(
        "event_id", "timestamp", "exclusion_reason", "exclusion_details"
    )


@query(
    f"WITH {JUDGED} SELECT exclusion_reason, count(*) AS n, round(count(*) / (SELECT count(*) FROM judged), 10) AS rate "
    "FROM judged WHERE exclusion_reason IS NOT NULL GROUP BY 1"
)
def exclusion_summary(spark, sf_dir):
    """B9."""
    return rounded(clean.exclusion_summary(clean.classify_exclusions(flat(spark, sf_dir))))


@query(final(ctes.imputed("batch_id"), "imputed", ["event_id", "batch_id"], SENSORS))
def impute_batch(spark, sf_dir):
    """C1-C3 within each micro-batch of ten messages."""
    typed = usable(spark, sf_dir)
    return rounded(clean.impute(typed, BATCH, ORDER, ()).select("event_id", "batch_id", *SENSORS))


@query(final(ctes.imputed("source"), "imputed", ["event_id", "source"], SENSORS))
def impute_series(spark, sf_dir):
    """C1-C3 over each station's whole series, in buckets with carried edges."""
    typed = usable(spark, sf_dir)
    return rounded(clean.impute(typed, ["source"], ORDER, SERIES_BUCKETS).select("event_id", "source", *SENSORS))


@query(
    final(
        f"{ctes.imputed('source')}, c AS (SELECT event_id, "
        + ", ".join(
            f"last_value({c} IGNORE NULLS) OVER (PARTITION BY source ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {c}"
            for c in CARRIED
        )
        + ", source FROM numbered), m AS (SELECT event_id, "
        + ", ".join(f"coalesce({c}, avg({c}) OVER (PARTITION BY source)) AS {c}" for c in CARRIED)
        + " FROM c)",
        "m", ["event_id"], CARRIED,
    )
)
def ffill_mean(spark, sf_dir):
    """C1."""
    typed = usable(spark, sf_dir).select("event_id", "source", *CARRIED)
    carried = grid.ffill(typed, CARRIED, ["source"], ORDER, SERIES_BUCKETS)
    return rounded(grid.fill_mean(carried, CARRIED, ["source"]).select("event_id", *CARRIED))


@query(final(ctes.imputed("source"), "lined", ["event_id"], INTERPOLATED))
def interpolate_row(spark, sf_dir):
    """C2 by row position over each station's whole series."""
    typed = usable(spark, sf_dir).select("event_id", "source", *INTERPOLATED)
    lined = grid.interpolate(typed, INTERPOLATED, ["source"], ORDER, by="row", widths=SERIES_BUCKETS)
    return rounded(lined.select("event_id", *INTERPOLATED))


CLEAN_PLAIN = ["event_id", "batch_id", "timestamp", "date", "time", "source", "simulation", "hour", "day_of_week", "month", "season"]
CLEAN_DOUBLES = [*SENSORS, "air_quality_index", "comfort_index", "quality_score"]


@query(final(ctes.clean("batch_id"), "clean", CLEAN_PLAIN, CLEAN_DOUBLES))
def process_batch_clean(spark, sf_dir):
    """The clean table, micro-batch scope."""
    return rounded(cleaned(spark, sf_dir)[0])


@query(
    f"WITH {ctes.imputed('batch_id')} SELECT event_id, batch_id, timestamp, reason AS exclusion_reason FROM typed WHERE reason IS NOT NULL "
    f"UNION ALL SELECT event_id, batch_id, timestamp, {ctes.RANGE_REASON} FROM imputed WHERE {ctes.RANGE_REASON} IS NOT NULL"
)
def process_batch_excluded(spark, sf_dir):
    """The quarantined rows, micro-batch scope."""
    return cleaned(spark, sf_dir)[1].select("event_id", "batch_id", "timestamp", "exclusion_reason")


@query(
    final(
        f"{ctes.TYPED}, once AS (SELECT source, date_trunc('minute', timestamp) AS ts, min_by(co_gt, event_id) AS co_gt, "
        "min(event_id) AS event_id FROM typed WHERE co_gt IS NOT NULL AND timestamp IS NOT NULL GROUP BY 1, 2)",
        "once", ["source", "ts", "event_id"], ["co_gt"],
    )
)
def dedupe_time(spark, sf_dir):
    """The first reading of each station and minute."""
    typed = clean.type_columns(flat(spark, sf_dir)).filter("co_gt IS NOT NULL AND timestamp IS NOT NULL")
    rows = typed.select("source", F.date_trunc("minute", "timestamp").cast("timestamp_ntz").alias("ts"), "event_id", "co_gt")
    return rounded(grid.dedupe_time(rows, ["source"], "ts", "event_id"))


@query(
    "SELECT event_id, hour(ts) AS hour, isodow(ts) - 1 AS day_of_week, month(ts) AS month, "
    + ctes.SEASON.replace("timestamp", "ts") + " AS season FROM events"
)
def calendar_features(spark, sf_dir):
    """D1, D2."""
    rows = derive.calendar_features(fixtures.events(spark, sf_dir).select("event_id", "ts"), "ts")
    return rounded(rows.drop("ts"))


@query(
    f"SELECT o_orderkey, month(o_orderdate) AS month, {ctes.SEASON.replace('timestamp', 'o_orderdate')} AS season FROM orders"
)
def season(spark, sf_dir):
    """D2 over dates of several years."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_orderdate")
    return rounded(derive.calendar_features(orders, "o_orderdate").select("o_orderkey", "month", "season"))


@query(final(f"{ctes.HOURLY}, d AS (SELECT ts, {ctes.aqi('')} AS air_quality_index FROM hourly)", "d", ["ts"], ["air_quality_index"]))
def air_quality_index(spark, sf_dir):
    """D3 with the maxima of the whole table."""
    return rounded(derive.air_quality_index(fixtures.hourly(spark, sf_dir)).select("ts", "air_quality_index"))


@query(final(f"{ctes.TYPED}, d AS (SELECT event_id, {ctes.COMFORT} AS comfort_index FROM typed)", "d", ["event_id"], ["comfort_index"]))
def comfort_index(spark, sf_dir):
    """D4."""
    return rounded(derive.with_comfort_index(clean.type_columns(flat(spark, sf_dir))).select("event_id", "comfort_index"))


@query(
    "SELECT event_id, round(sin(hour(ts) * (2.0::DOUBLE * pi()) / 24), 10) AS sin_hour, "
    "round(cos(hour(ts) * (2.0::DOUBLE * pi()) / 24), 10) AS cos_hour FROM events"
)
def cyclic_encode(spark, sf_dir):
    """D5."""
    return rounded(derive.cyclic_encode(fixtures.events(spark, sf_dir).select("event_id", "ts"), "ts").drop("ts"))


@query(
    final(
        f"{ctes.clean('batch_id')}, r AS ({ctes.range_counts('clean')})", "r",
        ["channel", "below_min", "above_max", "below_min + above_max AS total_violations"], ["min_value", "max_value"],
    )
)
def range_profile(spark, sf_dir):
    """E1."""
    return rounded(quality.range_profile(cleaned(spark, sf_dir)[0]))


@query(
    f"WITH {ctes.clean('batch_id')}, c AS ("
    + " UNION ALL ".join(
        f"SELECT '{n}' AS \"check\", '{text}' AS description, count(*) FILTER ({test}) AS violations FROM clean"
        for n, text, test in ctes.CONSISTENCY
    )
    + ") SELECT * FROM c WHERE violations > 0"
)
def consistency_profile(spark, sf_dir):
    """E2."""
    return quality.consistency_profile(cleaned(spark, sf_dir)[0])


CELLS = " + ".join(f"count({c})" for c in SENSORS)


@query(
    f"WITH {ctes.TYPED} SELECT count(*) * {len(SENSORS)} - ({CELLS}) AS missing_cells, count(*) * {len(SENSORS)} AS total_cells, "
    f"round(({CELLS}) / (count(*) * {len(SENSORS)}), 10) AS score FROM typed"
)
def completeness(spark, sf_dir):
    """E3 of the typed sensor columns."""
    return rounded(quality.completeness(clean.type_columns(flat(spark, sf_dir)), SENSORS))


@query(final(ctes.clean("batch_id"), "clean", ["event_id"], ["quality_score"]))
def quality_score(spark, sf_dir):
    """E4."""
    return rounded(cleaned(spark, sf_dir)[0].select("event_id", "quality_score"))


CLASSES = (
    "count(*) FILTER (quality_score >= 0.9) AS excellent, count(*) FILTER (quality_score >= 0.7 AND quality_score < 0.9) AS good, "
    "count(*) FILTER (quality_score >= 0.5 AND quality_score < 0.7) AS fair, count(*) FILTER (quality_score < 0.5) AS poor"
)


@query(f"WITH {ctes.clean('batch_id')} SELECT {CLASSES} FROM clean")
def quality_distribution(spark, sf_dir):
    """E5."""
    return quality.quality_distribution(cleaned(spark, sf_dir)[0])


SCORED = [*FLAT_COLUMNS, *DERIVED_COLUMNS]
PRESENT = " + ".join(f"count({c})" for c in SCORED)
FAILED_CHECKS = " + ".join(f"CASE WHEN count(*) FILTER ({test}) > 0 THEN 1 ELSE 0 END" for _, _, test in ctes.CONSISTENCY)
VERDICT = (
    "count(*) AS total_records, count(*) FILTER (quality_score >= 0.7) AS valid_records, "
    f"{ctes.VIOLATIONS} AS range_violations, ({FAILED_CHECKS})::BIGINT AS consistency_violations, "
    f"({PRESENT}) / (count(*) * {len(SCORED)}) AS completeness_score, avg(quality_score) AS average_quality_score, {CLASSES}"
)
VERDICT_PLAIN = ["total_records", "valid_records", "range_violations", "consistency_violations", "excellent", "good", "fair", "poor"]


@query(
    final(f"{ctes.clean('batch_id')}, v AS (SELECT {VERDICT} FROM clean)", "v", VERDICT_PLAIN,
          ["completeness_score", "average_quality_score"])
)
def validate(spark, sf_dir):
    """E6 of the whole clean table."""
    return rounded(quality.validate(cleaned(spark, sf_dir)[0], ignore=["event_id", "batch_id"]).drop("range_details"))


@query(
    f"WITH {ctes.clean('batch_id')} SELECT count(*) AS total_records, "
    + " + ".join(f"count(*) FILTER ({c} = -200)" for c in SENSORS)
    + " AS remaining_sentinels, 6::BIGINT AS derived_columns, 19::BIGINT AS numeric_columns FROM clean"
)
def preprocessing_stats(spark, sf_dir):
    """F8."""
    rows = cleaned(spark, sf_dir)[0].drop("event_id", "batch_id")
    return metrics.preprocessing_stats(rows)


def batches(spark, sf_dir) -> DataFrame:
    """One metrics row per micro-batch; its seconds are a reading of the batch's own events.

    As in the ingest job, verdicts are taken on the written clean rows.
    """
    written = settle(cleaned(spark, sf_dir)[0])
    events = fixtures.events(spark, sf_dir)
    arrived = events.groupBy(F.expr("event_id div 10").alias("batch_id")).agg(
        F.count("*").alias("messages"), (F.max("value") / 20).alias("seconds"), F.max("ts").alias("batch_time")
    )
    return metrics.batch_metrics(written, "batch_id", arrived, ignore=["event_id"])


FILLED = ", ".join(f"coalesce(v.{c}, 0) AS {c}" for c in [*VERDICT_PLAIN, "completeness_score", "average_quality_score"])
METRICS = f"""{ctes.clean('batch_id')}, v AS (SELECT batch_id, {VERDICT} FROM clean GROUP BY batch_id),
    arrived AS (SELECT event_id // 10 AS batch_id, count(*) AS messages, max(value) / 20 AS seconds, max(ts) AS batch_time FROM events GROUP BY 1),
    metrics AS (SELECT a.batch_id, a.messages, a.seconds, a.batch_time, {FILLED} FROM arrived a LEFT JOIN v ON a.batch_id = v.batch_id)"""


@query(
    final(METRICS, "metrics", ["batch_id", "messages", "batch_time", *VERDICT_PLAIN],
          ["seconds", "completeness_score", "average_quality_score"])
)
def batch_metrics(spark, sf_dir):
    """F1 per batch."""
    return rounded(batches(spark, sf_dir))


@query(
    f"WITH {METRICS} SELECT sum(messages)::BIGINT AS total_messages, count(*) AS total_batches, round(sum(seconds), 6) AS total_seconds, "
    "round(sum(messages) / count(*), 6) AS average_batch_size, round(sum(seconds) / count(*), 6) AS average_seconds_per_batch FROM metrics"
)
def metrics_totals(spark, sf_dir):
    """F1 totals."""
    return rounded(metrics.metrics_totals(batches(spark, sf_dir)), 6)


@query(
    f"WITH {METRICS} SELECT sum(total_records)::BIGINT AS total_records, sum(valid_records)::BIGINT AS valid_records, "
    "sum(range_violations)::BIGINT AS range_violations, sum(consistency_violations)::BIGINT AS consistency_violations, "
    "round(sum(average_quality_score * total_records) / sum(total_records), 10) AS average_quality_score FROM metrics"
)
def quality_totals(spark, sf_dir):
    """F2."""
    return rounded(metrics.quality_totals(batches(spark, sf_dir)))


SO_FAR = "OVER (ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


@query(
    f"WITH {METRICS}, s AS (SELECT batch_id, (sum(total_records) {SO_FAR})::BIGINT AS records_so_far, "
    f"(sum(valid_records) {SO_FAR})::BIGINT AS valid_so_far, "
    f"coalesce(sum(average_quality_score * total_records) {SO_FAR} / nullif(sum(total_records) {SO_FAR}, 0), 0) AS q FROM metrics) "
    "SELECT batch_id, records_so_far, valid_so_far, round(q, 9) AS quality_so_far FROM s"
)
def running_quality(spark, sf_dir):
    """F2 after each batch."""
    return rounded(metrics.running_quality(batches(spark, sf_dir), "batch_id", (200, 10)), 9)


ALERTS = f"""{METRICS}, alerts AS (
    SELECT batch_id, batch_time, 'HIGH_PROCESSING_TIME' AS type, 'WARNING' AS severity FROM metrics WHERE seconds > 10.0
    UNION ALL SELECT batch_id, batch_time, 'LOW_DATA_QUALITY', 'CRITICAL' FROM metrics WHERE average_quality_score < 0.5
    UNION ALL SELECT batch_id, batch_time, 'HIGH_ERROR_RATE', 'CRITICAL' FROM metrics WHERE total_records - valid_records > messages * 0.1
    UNION ALL SELECT batch_id, batch_time, 'HIGH_RANGE_VIOLATIONS', 'WARNING' FROM metrics WHERE range_violations > messages * 0.05)"""


@query(f"WITH {ALERTS} SELECT batch_id, batch_time, type, severity FROM alerts")
def alerts(spark, sf_dir):
    """F3, F4."""
    return metrics.alerts(batches(spark, sf_dir)).select("batch_id", "batch_time", "type", "severity")


@query(f"WITH {ALERTS} SELECT batch_id, batch_time, type, severity FROM alerts WHERE batch_time > (SELECT max(ts) FROM events) - INTERVAL 24 HOURS")
def recent_alerts(spark, sf_dir):
    """F7 as of the newest event."""
    as_of = fixtures.events(spark, sf_dir).agg(F.max("ts")).scalar()
    raised = metrics.alerts(batches(spark, sf_dir)).select("batch_id", "batch_time", "type", "severity")
    return metrics.recent_alerts(raised, as_of)


@query(f"WITH {ALERTS} SELECT batch_id, batch_time, type, severity FROM alerts ORDER BY batch_time DESC, type LIMIT 5")
def latest_alerts(spark, sf_dir):
    """the status line's five."""
    raised = metrics.alerts(batches(spark, sf_dir)).select("batch_id", "batch_time", "type", "severity")
    return metrics.latest_alerts(raised)


@query(f"WITH {ALERTS} SELECT type, count(*) AS n FROM alerts GROUP BY type")
def error_counts(spark, sf_dir):
    """the same count over alert rows, which the ingest job logs like errors."""
    return metrics.error_counts(metrics.alerts(batches(spark, sf_dir)))


@query(
    f"WITH {METRICS}, t AS (SELECT sum(messages)::BIGINT AS total_messages, "
    "(epoch_us(max(batch_time)) - epoch_us(min(batch_time))) // 1000000 AS uptime_seconds FROM metrics) "
    "SELECT total_messages, uptime_seconds, round(total_messages / uptime_seconds, 10) AS messages_per_second FROM t"
)
def throughput(spark, sf_dir):
    """F6."""
    return rounded(metrics.throughput(batches(spark, sf_dir)))
