"""The ingest stream: messages to clean, excluded, metrics and error tables."""

import datetime
import json
import time

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from skywell.operators.clean import flatten_messages, type_columns
from skywell.operators.metrics import alerts
from skywell.operators.ordered import fitted_widths
from skywell.operators.quality import scored_columns, verdict
from skywell.plans.pipeline import process_typed
from skywell.schema import FLAT_COLUMNS
from skywell.session import scratch, settle
from skywell.sources.files import append_json, write_by_batch

TIE = "_tie"
METRICS = (
    "batch_id bigint, messages bigint, seconds double, batch_time timestamp, total_records bigint, valid_records bigint, "
    "range_violations bigint, consistency_violations bigint, completeness_score double, average_quality_score double, "
    "excellent bigint, good bigint, fair bigint, poor bigint"
)


# Types of errors.
SAVE, EXCLUDED_SAVE, BATCH, CONSUMPTION = "SAVE_ERROR", "EXCLUDED_SAVE_ERROR", "BATCH_PROCESSING_ERROR", "CONSUMPTION_ERROR"
ERRORS = "type string, message string, batch_id bigint"


class IngestError(Exception):
    """A failure with the type it is logged and counted under."""

    def __init__(self, kind: str, cause: Exception):
        super().__init__(str(cause))
        self.kind = kind


def saved(kind: str, df: DataFrame, path: str, batch_id: int) -> None:
    try:
        write_by_batch(df, path, batch_id)
    except Exception as cause:
        raise IngestError(kind, cause) from cause


def ingest_batch(
    messages: DataFrame, batch_id: int, out: str, scope=("source",), widths=None, as_of=None
) -> None:
    """One micro-batch. Every output is a folder of its batch id, so a repeat replaces it.

    Messages are decoded and typed once, into files that go with the batch; what the metrics need is
    observed as the rows are written. Any table may get no row. Without
    `widths` the buckets that long series are cut into are sized from the batch's own density, so that no source can
    fill one task.
    """
    spark, started = messages.sparkSession, time.time()
    flat = flatten_messages(messages).withColumn(TIE, F.xxhash64(*FLAT_COLUMNS))
    kept, refused = Observation(), Observation()
    with scratch():
        typed = settle(type_columns(flat))
        if widths is None:
            widths = fitted_widths(typed.filter("timestamp IS NOT NULL"), scope, "timestamp")
        clean, excluded = process_typed(typed, list(scope), ["timestamp", TIE], widths)
        clean = clean.drop(TIE)
        saved(SAVE, clean.observe(kept, *verdict(scored_columns(clean))), f"{out}/clean", batch_id)
        saved(EXCLUDED_SAVE, excluded.drop(TIE).observe(refused, F.count("*").alias("n")), f"{out}/excluded", batch_id)
    seen = kept.get
    at = datetime.datetime.fromisoformat(as_of) if isinstance(as_of, str) else as_of or datetime.datetime.now()
    row = {"batch_id": batch_id, "messages": seen["total_records"] + refused.get["n"], "seconds": time.time() - started, "batch_time": at, **seen}
    metrics = spark.createDataFrame([row], METRICS)
    write_by_batch(metrics, f"{out}/metrics", batch_id)
    write_by_batch(alerts(metrics), f"{out}/alerts", batch_id)


class ProgressLog(StreamingQueryListener):
    """F5, F6 by the engine's own account: a JSON row per micro-batch of the named query, and one where it ends in an error."""

    def __init__(self, spark: SparkSession, query: str, progress: str, errors: str):
        self.spark, self.query, self.progress, self.errors, self.runs = spark, query, progress, errors, set()

    def onQueryStarted(self, event) -> None:
        if event.name == self.query:
            self.runs.add(str(event.runId))

    def onQueryProgress(self, event) -> None:
        p = json.loads(event.progress.json)
        if p["name"] == self.query and p["numInputRows"]:
            row = [(p["batchId"], p["timestamp"], p["numInputRows"], float(p.get("processedRowsPerSecond", 0.0)), p["durationMs"].get("triggerExecution", 0))]
            kind = "batch_id bigint, started string, rows bigint, rows_per_second double, milliseconds bigint"
            append_json(self.spark.createDataFrame(row, kind), self.progress)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) in self.runs and event.exception:
            append_json(self.spark.createDataFrame([(CONSUMPTION, event.exception, None)], ERRORS), self.errors)


def run_ingest(
    messages: DataFrame, out: str, checkpoint: str, scope=("source",), widths=None,
    once: bool = True, interval: str = "10 seconds", as_of=None, name: str | None = None,
) -> StreamingQuery:
    """Run the batch body over a message stream; the checkpoint holds the source offsets.

    `once` drains what is available and stops. A failed batch is recorded and then retried by
    the restarted query, not skipped.
    """

    def body(batch: DataFrame, batch_id: int) -> None:
        try:
            ingest_batch(batch, batch_id, out, scope, widths, as_of)
        except Exception as failure:
            row = [(getattr(failure, "kind", BATCH), str(failure), batch_id)]
            append_json(batch.sparkSession.createDataFrame(row, ERRORS), f"{out}/errors")
            raise

    writer = messages.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint)
    writer = writer if name is None else writer.queryName(name)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)
    return writer.start()


def read_ingested(spark: SparkSession, out: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{out}/{table}")
