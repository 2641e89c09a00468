"""Live analytics over the growing clean table."""

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from skywell.operators import live
from skywell.schema import LIVE_WINDOWS, POLLUTANTS
from skywell.sources.files import drop_batch, read_batch, write_by_batch


def tail_clean(spark: SparkSession, path: str, schema, files_per_batch: int | None = None) -> DataFrame:
    """Rows added to the clean table since the last run, tracked by the checkpoint."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def _previous(spark: SparkSession, path: str, schema, batch_id: int) -> DataFrame:
    """A table's rows of the batch before this one; none on the first."""
    return spark.createDataFrame([], schema) if batch_id == 0 else read_batch(spark, path, batch_id - 1, schema).drop("batch_id")


def refresh(batch: DataFrame, batch_id: int, out: str, ts: str, keys=(), cols=POLLUTANTS, identity=()) -> None:
    """Fold a batch into the last-N state, then recompute G2-G5 and G7 on the state.

    State and results are folders by batch id, and batch n reads only state n - 1: a repeated
    batch gives the same tables. The state holds at most max(LIVE_WINDOWS) rows per key. Every
    reading counts, also several of one time; where a source may deliver a reading twice, `identity`
    names the columns that tell readings of a key apart.
    """
    spark, keys = batch.sparkSession, list(keys)
    cols = list(cols)
    state_schema = batch.select(*keys, ts, *cols).schema
    held = _previous(spark, f"{out}/state", state_schema, batch_id)
    fresh = batch.select(*keys, ts, *cols).filter(F.col(ts).isNotNull())
    merged = fresh.unionByName(held).withColumn("_tie", F.xxhash64(*cols))
    if identity:
        merged = merged.groupBy(*dict.fromkeys([*keys, *identity])).agg(F.max_by(F.struct(*merged.columns), "_tie").alias("r")).select("r.*")
    newest = live.latest_rows(merged, max(LIVE_WINDOWS.values()), ts, "_tie", keys).drop("age", "_tie")
    write_by_batch(newest, f"{out}/state", batch_id)
    drop_batch(spark, f"{out}/state", batch_id - 2)  # only the last batch can come again, and it reads the one before

    state = read_batch(spark, f"{out}/state", batch_id, state_schema).drop("batch_id")
    windows = live.last_n_windows(state, ts, ts, keys)
    found = live.zscore_anomalies(windows, ts, cols=cols, keys=keys)
    write_by_batch(live.window_stats(windows, cols, keys), f"{out}/stats", batch_id)
    write_by_batch(live.window_correlations(windows, cols, keys), f"{out}/correlations", batch_id)
    write_by_batch(found, f"{out}/anomalies", batch_id)
    write_by_batch(live.live_patterns(windows, ts, cols, keys), f"{out}/patterns", batch_id)
    summary = live.live_summary(batch, windows, found, ts)
    kind = dict(summary.dtypes)["last_update"]
    before = _previous(spark, f"{out}/summary", f"total_records bigint, last_update {kind}", batch_id)
    summary = summary.withColumns({
        "total_records": F.col("total_records") + F.coalesce(before.agg(F.sum("total_records")).scalar(), F.lit(0)),
        "last_update": F.greatest("last_update", before.agg(F.max("last_update")).scalar()),
    })
    write_by_batch(summary, f"{out}/summary", batch_id)


def run_live_analytics(
    rows: DataFrame, out: str, checkpoint: str, ts: str = "timestamp", keys=(), cols=POLLUTANTS,
    once: bool = True, interval: str = "5 seconds", identity=(),
) -> StreamingQuery:
    """G6 over a stream of clean rows."""
    writer = rows.writeStream.foreachBatch(
        lambda batch, batch_id: refresh(batch, batch_id, out, ts, keys, cols, identity)
    ).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)
    return writer.start()
