"""Readings by their event time: late ones to quarantine, repeated ones dropped, tumbling and session windows.

A batch is judged by the watermark of the batches before it, the latest time seen less the allowed delay. Late readings and those
without a usable time are kept apart with a reason, which the engine's own watermark would drop without a
trace; it then drops repeats and closes windows of what came in time.
"""

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from skywell.sources.files import read_batch, write_by_batch

AT = "event_time"
MERGED = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"
LATE, NO_TIME = "LATE", "NO_EVENT_TIME"


def sort_out(batch: DataFrame, batch_id: int, out: str, delay: str) -> None:
    """One micro-batch to `on_time` and `late` (with `late_reason`); batch n reads only the watermark of n - 1.

    Every output is a folder of its batch id, so a repeated batch replaces itself.
    """
    spark = batch.sparkSession
    before = read_batch(spark, f"{out}/watermark", batch_id - 1).first().latest if batch_id else None
    limit = F.lit(before).cast("timestamp") - F.expr(f"INTERVAL {delay}")
    late = F.coalesce(F.col(AT) <= limit, F.lit(False))
    reason = F.when(F.col(AT).isNull(), NO_TIME).when(late, LATE)
    batch = batch.withColumn("late_reason", reason).persist()
    try:
        seen = Observation()
        kept = batch.filter("late_reason IS NULL").drop("late_reason")
        write_by_batch(kept.observe(seen, F.max(AT).alias("latest")), f"{out}/on_time", batch_id)
        write_by_batch(batch.filter("late_reason IS NOT NULL"), f"{out}/late", batch_id)
    finally:
        batch.unpersist()
    found = [t for t in (before, seen.get["latest"]) if t is not None]
    write_by_batch(spark.createDataFrame([(max(found, default=None),)], "latest timestamp"), f"{out}/watermark", batch_id)


def run_sort_out(readings: DataFrame, out: str, checkpoint: str, delay: str, once: bool = True, interval: str = "10 seconds") -> StreamingQuery:
    """`readings` has the column `event_time`, null where the time text does not parse."""
    return started(readings.writeStream.foreachBatch(lambda batch, i: sort_out(batch, i, out, delay)), checkpoint, once, interval)


def started(writer, checkpoint: str, once: bool, interval: str) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)).start()


def on_time(spark: SparkSession, out: str, schema, delay: str, identity) -> DataFrame:
    """The stream of readings that came in time, each once: a repeat within the delay is dropped by `identity`.

    What has come is read whole: a number of files might cut a batch, and its later part be late for its earlier one.
    """
    rows = spark.readStream.schema(schema).parquet(f"{out}/on_time")
    return rows.withWatermark(AT, delay).dropDuplicatesWithinWatermark(list(identity))


def tumbling(readings: DataFrame, width: str, keys, **aggregates: Column) -> DataFrame:
    """One row per key and window of a fixed width, once the watermark has passed its end."""
    return readings.groupBy(F.window(AT, width).alias("w"), *keys).agg(*[c.alias(n) for n, c in aggregates.items()]).select(
        *keys, F.col("w.start").alias("start"), F.col("w.end").alias("end"), *aggregates
    )


def sessions(readings: DataFrame, gap: str, keys, **aggregates: Column) -> DataFrame:
    """One row per key and stretch of readings with no gap of that length, once the watermark has passed its end."""
    return readings.groupBy(F.session_window(AT, gap).alias("w"), *keys).agg(*[c.alias(n) for n, c in aggregates.items()]).select(
        *keys, F.col("w.start").alias("start"), F.col("w.end").alias("end"), *aggregates
    )


def run_table(rows: DataFrame, out: str, checkpoint: str, once: bool = True, interval: str = "10 seconds") -> StreamingQuery:
    """Write what a stream emits, a folder for each batch. Session windows are merged before rows are shuffled by their key."""
    spark = rows.sparkSession
    before = spark.conf.get(MERGED, None)
    spark.conf.set(MERGED, "true")
    try:
        return started(rows.writeStream.outputMode("append").foreachBatch(lambda batch, i: write_by_batch(batch, out, i)), checkpoint, once, interval)
    finally:
        spark.conf.unset(MERGED) if before is None else spark.conf.set(MERGED, before)


def as_event_time(text: str) -> Column:
    """A reading's time text as event time, null where it does not parse."""
    return F.col(text).try_cast("timestamp")
