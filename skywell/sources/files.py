"""File sources and sinks."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from skywell.schema import RAW_SCHEMA, REQUIRED_HEADERS

RAW_TIME_FORMAT = "dd/MM/yyyy HH.mm.ss"  # fixed value: date and time of the raw file


def read_sensor_csv(spark: SparkSession, path: str, required=tuple(REQUIRED_HEADERS)) -> DataFrame:
    """A1-A3: the `;`-separated sensor file as text columns with an event time.

    Column names come from the header line; nothing is inferred, so decimal commas survive.
    """
    df = spark.read.option("sep", ";").option("header", True).option("inferSchema", False).csv(path)
    require_columns(df, required)
    return with_event_time(df.select(*[F.col(f"`{c}`") for c in RAW_SCHEMA.names if c in df.columns]))


def require_columns(df: DataFrame, names) -> DataFrame:
    """A2: fail, without a job, when a column is absent."""
    absent = [c for c in names if c not in df.columns]
    if absent:
        raise ValueError(f"required columns not found: {', '.join(absent)}")
    return df


def with_event_time(df: DataFrame) -> DataFrame:
    """A3: `datetime` from the date and time texts; NULL where they do not parse."""
    text = F.concat_ws(" ", "Date", "Time")
    return df.withColumn("datetime", F.try_to_timestamp(text, F.lit(RAW_TIME_FORMAT)).cast("timestamp_ntz"))


def write_by_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Replace one batch's folder, so a repeated batch leaves the table unchanged.

    A batch without rows leaves a folder that holds the schema.
    """
    df.drop("batch_id").write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def read_batch(spark: SparkSession, path: str, batch_id: int, schema=None) -> DataFrame:
    """One batch's rows of a table with their `batch_id`; the folders of other batches are not listed."""
    rows = (spark.read if schema is None else spark.read.schema(schema)).parquet(f"{path}/batch_id={batch_id}")
    return rows.withColumn("batch_id", F.lit(batch_id).cast("bigint"))


def drop_batch(spark: SparkSession, path: str, batch_id: int) -> None:
    """Remove one batch's folder, if it is there."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/batch_id={batch_id}")
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def append_json(df: DataFrame, path: str) -> None:
    """Metrics snapshots as JSON lines."""
    df.write.mode("append").json(path)


def load_table(spark: SparkSession, path: str, ts: str = "timestamp") -> DataFrame:
    """A clean table, Parquet or CSV, with a usable event time."""
    df = spark.read.option("header", True).csv(path) if path.endswith(".csv") else spark.read.parquet(path)
    require_columns(df, [ts])
    return df.withColumn("datetime", F.col(ts).cast("string").try_cast("timestamp_ntz")).filter("datetime IS NOT NULL")


def export_csv(df: DataFrame, path: str) -> None:
    """Rows as CSV files with a header."""
    df.write.mode("overwrite").option("header", True).csv(path)
