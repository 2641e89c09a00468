"""Sensor messages over Kafka or files."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from skywell.schema import MESSAGE_SCHEMA, SENSOR_HEADERS

KAFKA = "kafka"


def to_messages(raw: DataFrame, source: str, simulation: bool = True) -> DataFrame:
    """A4: raw file rows (with `datetime`) to nested message columns."""
    stamp = F.date_format("datetime", "yyyy-MM-dd'T'HH:mm:ss")
    sensors = [(F.col(f"`{h}`") if h in raw.columns else F.lit(None).cast("string")).alias(c) for h, c in SENSOR_HEADERS.items()]
    return raw.select(
        stamp.alias("timestamp"), F.col("Date").alias("date"), F.col("Time").alias("time"),
        F.struct(*sensors).alias("sensor_data"),
        F.struct(
            F.lit(source).alias("source"), F.lit(simulation).alias("simulation"), stamp.alias("original_timestamp")
        ).alias("metadata"),
    )


def keyed(messages: DataFrame, keep=()) -> DataFrame:
    """A5: `key` (epoch seconds as text) and JSON `value`, after the columns to `keep`."""
    event = F.col("timestamp").try_cast("timestamp_ntz")
    seconds = F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), event)
    return messages.select(
        *keep,
        F.concat(seconds.cast("string"), F.lit(".0")).alias("key"),
        F.to_json(F.struct("timestamp", "date", "time", "sensor_data", "metadata")).alias("value"),
    )


def time_range(messages: DataFrame, start=None, end=None) -> DataFrame:
    """A5: the part of a replay between two times, the end excluded."""
    t = F.col("timestamp").try_cast("timestamp_ntz")
    if start is not None:
        messages = messages.filter(t >= F.lit(start).cast("timestamp_ntz"))
    return messages if end is None else messages.filter(t < F.lit(end).cast("timestamp_ntz"))


def write_messages(messages: DataFrame, format: str = KAFKA, path: str | None = None, **options) -> None:
    """A5: publish a batch of messages, to a topic or to files with the same two columns."""
    writer = keyed(messages).write.format(format).options(**options)
    writer.save() if path is None else writer.mode("append").save(path)


def decode(values: DataFrame) -> DataFrame:
    """JSON `value` to message columns; text that is no message gives NULL fields."""
    message = F.from_json(F.col("value").cast("string"), MESSAGE_SCHEMA)
    kept = [c for c in values.columns if c not in ("key", "value")]
    return values.select(*kept, message.alias("_m")).select(*kept, "_m.*")


def read_messages(spark: SparkSession, format: str = KAFKA, path: str | None = None, **options) -> DataFrame:
    """The message stream from its earliest offset. Files hold `key` and `value` columns."""
    reader = spark.readStream.format(format)
    if format == KAFKA:
        options = {"startingOffsets": "earliest"} | options
    else:
        reader = reader.schema("key string, value string")
    reader = reader.options(**options)
    return decode(reader.load() if path is None else reader.load(path))
