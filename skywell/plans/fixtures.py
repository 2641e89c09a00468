"""The sensor tables, derived from the driver's `events` at any scale."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from skywell.functions.scalars import epoch_seconds, from_epoch
from skywell.operators.ordered import HOUR

# Which event type stands for which channel.
CHANNEL_OF = {
    "click": "co_gt", "error": "nox_gt", "purchase": "no2_gt", "signup": "c6h6_gt", "view": "temperature",
}
CHANNELS = list(CHANNEL_OF.values())
STATIONS = 4
# Raw sensor readings of an event, as expressions that Spark and plain SQL share.
READINGS = {
    "co_gt": "value / 5",
    "pt08_s1_co": "value + 1000",
    "nmhc_gt": "value * 2",
    "c6h6_gt": "value / 6",
    "pt08_s2_nmhc": "value + 900",
    "nox_gt": "value * 5",
    "pt08_s3_nox": "value + 800",
    "no2_gt": "value * 3",
    "pt08_s4_no2": "value + 1500",
    "pt08_s5_o3": "value + event_id % 7",
    "temperature": "value - 30",
    "relative_humidity": "value / 2",
    "absolute_humidity": "value / 10",
}


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def hour_of(ts: str):
    seconds = epoch_seconds(ts)
    return (seconds - F.pmod(seconds, F.lit(HOUR))).alias("_hour_s")


def hourly(spark: SparkSession, sf_dir: str, station: bool = False) -> DataFrame:
    """Mean value per hour (and station) and channel; absent hours have no row."""
    keys = [(F.col("user_id") % STATIONS).alias("station")] if station else []
    rows = events(spark, sf_dir).select("event_type", "value", *keys, hour_of("ts"))
    names = ["station"] if station else []
    return (
        rows.groupBy(*names, "_hour_s")
        .agg(*[F.avg(F.when(F.col("event_type") == e, F.col("value"))).alias(c) for e, c in CHANNEL_OF.items()])
        .select(*names, from_epoch("_hour_s").alias("ts"), *CHANNELS)
    )


def sentinel_test(position: int) -> str:
    return f"event_id % 89 = 0 OR (event_id + {3 * position}) % 10 = 0"


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested messages, one per event, with broken timestamps, sentinels and decimal commas.

    `batch_id` and `event_id` (arrival order) ride along.
    """
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    stamp = (
        F.when(F.expr("event_id % 97 = 0"), F.date_format("ts", "yyyy-MM-dd"))
        .when(F.expr("event_id % 101 = 0"), "garbage").otherwise(iso)
    )
    readings = [
        F.when(F.expr(sentinel_test(i)), "-200")
        .otherwise(F.replace(F.expr(x).cast("string"), F.lit("."), F.lit(","))).alias(c)
        for i, (c, x) in enumerate(READINGS.items())
    ]
    return events(spark, sf_dir).select(
        "event_id", F.expr("event_id div 10").alias("batch_id"),
        stamp.alias("timestamp"),
        F.date_format("ts", "dd/MM/yyyy").alias("date"), F.date_format("ts", "HH.mm.ss").alias("time"),
        F.struct(*readings).alias("sensor_data"),
        F.struct(
            F.concat(F.lit("station_"), (F.col("user_id") % STATIONS).cast("string")).alias("source"),
            F.lit(True).alias("simulation"), iso.alias("original_timestamp"),
        ).alias("metadata"),
    )
