"""Session helpers: where lineage is cut, and how."""

import contextlib
import contextvars
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names; a private one only in local mode."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="skywell-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


_made: contextvars.ContextVar = contextvars.ContextVar("made", default=None)


@contextlib.contextmanager
def scratch():
    """Delete what is settled inside once the block ends: for a job that runs on and on, whose results are written by then."""
    token = _made.set([])
    try:
        yield
    finally:
        for folder, files in _made.get():
            files.delete(folder, True)
        _made.reset(token)


def settle(df: DataFrame) -> DataFrame:
    """Write `df` once to the shared checkpoint folder and read it back, so that later passes and lost executors start from there.

    The rows are counted as they are written: `rows_of` gives their number without a job. The files
    go when the session's file system is closed, or at the end of the `scratch` they were made in.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/settled-{uuid.uuid4().hex}"
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.deleteOnExit(folder)
    if _made.get() is not None:
        _made.get().append((folder, files))
    seen = Observation()
    df.observe(seen, F.count("*").alias("n")).write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.rows_written = seen.get["n"]
    return out


def rows_of(settled: DataFrame) -> int:
    """The number of rows of a settled table; others are counted."""
    known = getattr(settled, "rows_written", None)
    return settled.count() if known is None else known
