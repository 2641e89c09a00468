"""Queries that run a bounded stream over the given tables and read what it wrote."""

import uuid

from pyspark.sql import DataFrame, functions as F

from skywell.functions.scalars import parse_locale_number
from skywell.operators.clean import flatten_messages
from skywell.plans import clean_queries, ctes, explore_queries, fixtures
from skywell.plans.registry import final, query, rounded
from skywell.schema import POLLUTANTS, SENSOR_HEADERS, SENSORS
from skywell.session import checkpoint_dir
from skywell.sources.files import export_csv, load_table, read_batch, read_sensor_csv
from skywell.sources.messages import decode, keyed, read_messages, to_messages
from skywell.streaming.ingest import read_ingested, run_ingest
from skywell.streaming import event_time
from skywell.streaming.live import run_live_analytics, tail_clean
from skywell.streaming.stateful import run_last_n

ROWS_PER_FILE = 1_000_000
LEAST_FILES, BATCHES = 6, 3
DAY_SCOPE = ["source", "date"]


def files_of(rows: DataFrame) -> tuple[int, int]:
    """How many files a table is published in, and how many of them make a micro-batch."""
    files = max(LEAST_FILES, -(-rows.count() // ROWS_PER_FILE))
    return files, -(-files // BATCHES)


def folder(spark) -> str:
    return f"{checkpoint_dir(spark)}/stream-{uuid.uuid4()}"


def once(make):
    """Run a stream once for a session and a set of tables; the queries on what it wrote share its folder."""
    made: dict = {}

    def shared(spark, sf_dir):
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in made:
            made[key] = make(spark, sf_dir)
        return made[key]

    return shared


@once
def ingested(spark, sf_dir) -> str:
    """Publish every message, whole days at a time, and ingest what has come in a micro-batch each time."""
    base = folder(spark)
    raw = fixtures.raw_messages(spark, sf_dir)
    for i in range(BATCHES):  # a day may fill many files, and no file is written by one task alone
        days = raw.filter(F.pmod(F.hash("date"), F.lit(BATCHES)) == i)
        keyed(days).write.mode("append").json(f"{base}/topic")
        run_ingest(read_messages(spark, "json", f"{base}/topic"), f"{base}/out", f"{base}/offsets", scope=DAY_SCOPE).awaitTermination()
    return f"{base}/out"


@query(
    final(
        "", "events",
        ["strftime(ts, '%d/%m/%Y') AS date", "strftime(ts, '%H.%M.%S') AS time", "strftime(ts, '%Y-%m-%dT%H:%M:%S') AS timestamp",
         "'file' AS source"],
        clean_queries.TEXT_SENSORS,
    )
)
def sensor_file_roundtrip(spark, sf_dir):
    """A `;` file of every event is read, sent as messages, decoded, exported as CSV and read again."""
    base = folder(spark)
    raw = fixtures.raw_messages(spark, sf_dir)
    lines = raw.select(
        F.col("date").alias("Date"), F.col("time").alias("Time"), *[F.col(f"sensor_data.{c}").alias(h) for h, c in SENSOR_HEADERS.items()]
    )
    lines.write.option("sep", ";").option("header", True).csv(f"{base}/raw")
    messages = to_messages(read_sensor_csv(spark, f"{base}/raw"), "file")
    export_csv(flatten_messages(decode(keyed(messages))), f"{base}/export.csv")
    rows = load_table(spark, f"{base}/export.csv")
    return rounded(rows.select("date", "time", "timestamp", "source", *[parse_locale_number(c).alias(c) for c in SENSORS]))


# The stream orders a day's messages by time and has no arrival number; event ids follow time.
DAY_CLEAN = ctes.clean("source, date")


@query(
    final(DAY_CLEAN, "clean", ["timestamp", "date", "time", "source", "simulation", "hour", "day_of_week", "month", "season"],
          [*SENSORS, "air_quality_index", "comfort_index", "quality_score"])
)
def run_ingest_clean(spark, sf_dir):
    """The clean table a file stream leaves, filled per station and day."""
    return rounded(read_ingested(spark, ingested(spark, sf_dir), "clean").drop("batch_id"))


@query(
    f"WITH {DAY_CLEAN} SELECT reason AS exclusion_reason, count(*) AS n FROM (SELECT reason FROM typed WHERE reason IS NOT NULL "
    f"UNION ALL SELECT {ctes.RANGE_REASON} FROM imputed WHERE {ctes.RANGE_REASON} IS NOT NULL) GROUP BY 1"
)
def run_ingest_excluded(spark, sf_dir):
    """A10: the quarantine the same stream leaves, counted by reason."""
    rows = read_ingested(spark, ingested(spark, sf_dir), "excluded")
    return rows.groupBy("exclusion_reason").agg(F.count("*").alias("n"))


@query(
    f"WITH {DAY_CLEAN} SELECT (SELECT count(*) FROM events) AS messages, count(*) AS total_records, "
    "count(*) FILTER (quality_score >= 0.7) AS valid_records, "
    f"{ctes.VIOLATIONS} AS range_violations FROM clean"
)
def run_ingest_metrics(spark, sf_dir):
    """The metrics rows of all micro-batches, summed."""
    rows = read_ingested(spark, ingested(spark, sf_dir), "metrics")
    return rows.agg(*[F.sum(c).alias(c) for c in ("messages", "total_records", "valid_records", "range_violations")])


@once
def live_output(spark, sf_dir) -> tuple[str, int]:
    """Feed the hourly table as files to the live job; the folder and its last batch."""
    base = folder(spark)
    rows = fixtures.hourly(spark, sf_dir).select("ts", *POLLUTANTS)
    files, per_batch = files_of(rows)
    rows.repartition(files, "ts").write.parquet(f"{base}/clean")
    stream = tail_clean(spark, f"{base}/clean", rows.schema, per_batch)
    job = run_live_analytics(stream, f"{base}/out", f"{base}/offsets", "ts")
    job.awaitTermination()
    return f"{base}/out", job.lastProgress["batchId"]


def latest(spark, sf_dir, table: str) -> DataFrame:
    """What the job's last batch left, which may be no row."""
    out, last = live_output(spark, sf_dir)
    return read_batch(spark, f"{out}/{table}", last).drop("batch_id")


@query(
    final(
        explore_queries.windows_cte() + ", s AS ("
        + explore_queries.per_channel(POLLUTANTS, explore_queries.WINDOW_STATS, "w", '"window"') + ")",
        "s", ['"window"', "channel", '"count"'], ["mean", "std", "min", "max"], 'WHERE "count" > 0',
    )
)
def run_live_stats(spark, sf_dir):
    """After the stream has drained, its last window statistics."""
    return rounded(latest(spark, sf_dir, "stats"))


@query(explore_queries.corr_sql(explore_queries.windows_cte() + ", ", POLLUTANTS, "w", '"window"'))
def run_live_correlations(spark, sf_dir):
    """G3 of the same stream."""
    return rounded(latest(spark, sf_dir, "correlations"))


@query(explore_queries.SHORTEST_OUTLIERS)
def run_live_anomalies(spark, sf_dir):
    """G4 of the same stream, by its own threshold."""
    return rounded(latest(spark, sf_dir, "anomalies"))


@query(explore_queries.LIVE_PATTERNS)
def run_live_patterns(spark, sf_dir):
    """G5 of the same stream."""
    return rounded(latest(spark, sf_dir, "patterns"))


@query(
    explore_queries.SHORTEST_OUTLIERS.split(" SELECT ts, channel, 'z_score'")[0]
    + f" SELECT count(*) AS total_records, max(ts) AS last_update, {explore_queries.FILL}, "
    "(SELECT count(*) FROM z WHERE score > 3) AS recent_anomalies FROM hourly"
)
def run_live_summary(spark, sf_dir):
    """G7 of the same stream, all columns."""
    return rounded(latest(spark, sf_dir, "summary"))


@query(
    final(
        explore_queries.windows_cte("station") + ", s AS ("
        + explore_queries.per_channel(POLLUTANTS, explore_queries.WINDOW_STATS, "w", 'station, "window"') + ")",
        "s", ["station", '"window"', "channel", '"count"'], ["mean", "std", "min", "max"], 'WHERE "count" > 0',
    )
)
def run_live_stateful(spark, sf_dir):
    """G1, G2 as engine state: what the last batch that touched a station left for it."""
    base = folder(spark)
    rows = fixtures.hourly(spark, sf_dir, station=True).select("station", "ts", *POLLUTANTS)
    files, per_batch = files_of(rows)
    rows.repartition(files, "ts").write.parquet(f"{base}/clean")
    stream = tail_clean(spark, f"{base}/clean", rows.schema, per_batch)
    run_last_n(stream, f"{base}/stats", f"{base}/offsets", "ts", ["station"]).awaitTermination()
    stats = spark.read.parquet(f"{base}/stats")
    newest = stats.groupBy("station", "window", "channel").agg(F.max_by(F.struct("count", "mean", "std", "min", "max"), "batch_id").alias("s"))
    return rounded(newest.select("station", "window", "channel", "s.*"))


ARRIVALS, DELAY = 6, "3 days"
# When a reading arrives: in order of time, some much later, some twice.
ARRIVAL = f"least({ARRIVALS - 1}, event_id * {ARRIVALS} // (SELECT max(event_id) + 1 FROM events) + CASE WHEN event_id % 50 = 7 THEN 2 ELSE 0 END)"
DELIVERED = (
    f"e AS (SELECT event_id, ts, user_id % {fixtures.STATIONS} AS station, value, {ARRIVAL} AS arrival FROM events), "
    f"d AS (SELECT * FROM e UNION ALL SELECT event_id, ts, station, value, least(arrival + 1, {ARRIVALS - 1}) FROM e WHERE event_id % 40 = 3), "
    "m AS (SELECT arrival + 1 AS arrival, max(max(ts)) OVER (ORDER BY arrival) - INTERVAL 3 DAY AS mark FROM d GROUP BY arrival), "
    "j AS (SELECT d.*, coalesce(d.ts <= m.mark, false) AS late FROM d LEFT JOIN m ON m.arrival = d.arrival), "
    "kept AS (SELECT DISTINCT event_id, ts, station, value FROM j WHERE NOT late), "
    "closed AS (SELECT max(ts) - INTERVAL 3 DAY AS mark FROM kept)"
)


@once
def delivered(spark, sf_dir) -> str:
    """Publish readings in the order of their arrival, and sort out the late ones of what has come each time."""
    base = folder(spark)
    events = fixtures.events(spark, sf_dir)
    last = events.agg(F.max("event_id")).first()[0]
    arrival = F.expr(f"least({ARRIVALS - 1}, event_id * {ARRIVALS} div {last + 1} + CASE WHEN event_id % 50 = 7 THEN 2 ELSE 0 END)")
    station = (F.col("user_id") % fixtures.STATIONS).alias("station")
    rows = events.select("event_id", F.col("ts").cast("string").alias("timestamp"), station, "value", arrival.alias("arrival"))
    again = rows.filter("event_id % 40 = 3").withColumn("arrival", F.least(F.col("arrival") + 1, F.lit(ARRIVALS - 1)))
    rows = rows.unionByName(again)
    kind = rows.drop("arrival").schema
    for i in range(ARRIVALS):  # one set of files makes a batch, however many tasks write it
        rows.filter(F.col("arrival") == i).drop("arrival").write.mode("append").parquet(f"{base}/topic")
        stream = spark.readStream.schema(kind).parquet(f"{base}/topic")
        stream = stream.withColumn(event_time.AT, event_time.as_event_time("timestamp"))
        event_time.run_sort_out(stream, f"{base}/out", f"{base}/offsets", DELAY).awaitTermination()
    return base


def in_time(spark, base: str) -> DataFrame:
    schema = read_batch(spark, f"{base}/out/on_time", 0).drop("batch_id").schema
    return event_time.on_time(spark, f"{base}/out", schema, DELAY, ["event_id"])


@query(f"WITH {DELIVERED} SELECT event_id, arrival AS batch_id, 'LATE' AS late_reason FROM j WHERE late")
def stream_late(spark, sf_dir):
    """Readings that came after the watermark had passed them, with the batch that refused them."""
    rows = spark.read.parquet(f"{delivered(spark, sf_dir)}/out/late")
    return rows.select("event_id", F.col("batch_id").cast("bigint").alias("batch_id"), "late_reason")


@query(f"WITH {DELIVERED} SELECT event_id, station, value FROM kept")
def stream_on_time(spark, sf_dir):
    """Readings that came in time, each once however often it was delivered."""
    base = delivered(spark, sf_dir)
    event_time.run_table(in_time(spark, base), f"{base}/kept", f"{base}/kept_offsets").awaitTermination()
    return spark.read.parquet(f"{base}/kept").select("event_id", "station", "value")


@query(
    f"WITH {DELIVERED} SELECT station, date_trunc('day', ts) AS start, count(*) AS n, round(avg(value), 10) AS mean FROM kept "
    "GROUP BY 1, 2 HAVING date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT mark FROM closed)"
)
def stream_daily(spark, sf_dir):
    """Days of every station that the watermark has closed."""
    base = delivered(spark, sf_dir)
    rows = event_time.tumbling(in_time(spark, base), "1 day", ["station"], n=F.count("*"), mean=F.avg("value"))
    event_time.run_table(rows, f"{base}/daily", f"{base}/daily_offsets").awaitTermination()
    return rounded(spark.read.parquet(f"{base}/daily").select("station", "start", "n", "mean"))


@query(
    f"WITH {DELIVERED}, g AS (SELECT *, coalesce(ts - lag(ts) OVER w > INTERVAL 2 HOUR, true)::INT AS cut FROM kept WINDOW w AS (PARTITION BY station ORDER BY ts)), "
    "s AS (SELECT *, sum(cut) OVER (PARTITION BY station ORDER BY ts, event_id) AS part FROM g) "
    "SELECT station, min(ts) AS start, max(ts) + INTERVAL 2 HOUR AS \"end\", count(*) AS n, max(value) AS peak FROM s "
    "GROUP BY station, part HAVING max(ts) + INTERVAL 2 HOUR <= (SELECT mark FROM closed)"
)
def stream_sessions(spark, sf_dir):
    """Stretches of readings of a station without a gap of two hours, once closed."""
    base = delivered(spark, sf_dir)
    rows = event_time.sessions(in_time(spark, base), "2 hours", ["station"], n=F.count("*"), peak=F.max("value"))
    event_time.run_table(rows, f"{base}/sessions", f"{base}/sessions_offsets").awaitTermination()
    return rounded(spark.read.parquet(f"{base}/sessions").select("station", "start", "end", "n", "peak"))
