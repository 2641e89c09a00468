"""What the operators of this package share: tables, hold-out rows, written intermediates, batches."""

import gc
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from skywell.session import checkpoint_dir

#: Rows of one Arrow batch: bounds a worker's memory where texts are long.
BATCH_ROWS = 256
QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    """Register a `(spark, sf_dir) -> DataFrame` under its name, with its SQL if it has one."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Arrow batches of few rows, and few rows of a file decoded at a time: texts may be long.

    Plans made from here on use the settings.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(BATCH_ROWS))


def held_out(key: str, modulus: int, remainder: int) -> Column:
    """Whether a row is held out of learning; a row without a key is not."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % modulus == remainder, F.lit(False))


def fresh(name: str, taken) -> str:
    """`name`, or a longer form of it that none of the columns `taken` has in any case."""
    lower = {c.lower() for c in taken}
    while name.lower() in lower:
        name = f"_{name}"
    return name


def mapped(df: DataFrame, text: str, keep, out: str, function) -> DataFrame:
    """`keep` columns of every row plus what `function(texts)` makes of a batch's texts.

    `function` gets a list (null: None) and returns one list per column of the schema string
    `out`. Names in `out` that `keep` has too are left to the caller to avoid. Rows stay where
    they are: nothing is shuffled.
    """
    small_batches(df.sparkSession)
    keep = list(keep)
    at = keep.index(text) if text in keep else len(keep)  # a text that is kept is sent once
    rows = df.select(*[F.col(f"`{c}`") for c in keep], *([] if text in keep else [F.col(f"`{text}`").alias(fresh("text_", keep))]))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[: len(keep)])
    made = T._parse_datatype_string(out)
    kinds = [to_arrow_type(f.dataType) for f in made.fields]

    def apply(batches):
        for b in batches:
            columns = function(b.column(at).to_pylist())
            arrays = [b.column(i) for i in range(len(keep))]
            arrays += [pa.array(c, k) for c, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, [*keep, *made.names])

    return rows.mapInArrow(apply, f"{fields}, {out}" if fields else out)


def together(batches, column: int, size: int = 4 << 20):
    """Batches put together until the texts of one column make up about `size` bytes: what a call costs whatever its rows is paid less often."""
    held, held_size = [], 0
    for b in batches:
        held.append(b)
        held_size += b.column(column).nbytes
        if held_size >= size:
            yield pa.concat_batches(held)
            held, held_size = [], 0
    if held:
        yield pa.concat_batches(held)


def written(df: DataFrame, *by: str) -> DataFrame:
    """`df`, written once as Parquet to the shared checkpoint folder and read back from there, in folders by the columns `by`.

    Later passes read the files, whatever happens to the executors that wrote them. The files go
    with `discard`, or when the session's file system is closed.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/skywell-{uuid.uuid4().hex}"
    df.write.partitionBy(*by).parquet(path)
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def discard(df: DataFrame | None) -> None:
    """Delete the files of a written table after its last reader is done."""
    path = getattr(df, "written_to", None) if df is not None else None
    if path is not None:
        spark = df.sparkSession
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished jobs now, not when the driver next runs out of room."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def sampled(key: Column, rows: int, wanted: int, seed: int) -> Column:
    """Whether a row is in a repeatable sample of about `wanted` of `rows` rows, chosen by hash."""
    share = min(1.0, wanted / max(rows, 1))
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of unsigned 64-bit numbers that spreads every bit (splitmix64's finisher)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def runs(ids: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Bounds of the runs of equal `(ids, values)` in sorted arrays, with the end appended."""
    if not len(ids):
        return np.zeros(1, np.int64)
    new = np.flatnonzero((ids[1:] != ids[:-1]) | (values[1:] != values[:-1])) + 1
    return np.concatenate(([0], new, [len(ids)]))


_BASE, _FOLD = np.uint64(0x9E3779B97F4A7C15 | 1), {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2^64, at least `n` of them."""
    if len(_FOLD.get("up", ())) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for name, b in (("up", _BASE), ("down", inverse)):
            out = np.full(size, b, np.uint64)
            out[0] = 1
            _FOLD[name] = np.cumprod(out, dtype=np.uint64)
        _FOLD["bytes"] = mixed(np.arange(1, 257, dtype=np.uint64) * _BASE)
    return _FOLD["up"], _FOLD["down"]


#: Bytes that separate words: blanks, control characters and ASCII punctuation; letters and digits stay.
_SEPARATE = bytes(b if chr(b).isalnum() or b >= 0x80 else 0x20 for b in range(256))
LONGEST = 1 << 20  # bytes hashed at a time


def word_hashes(text: str | None) -> np.ndarray:
    """A 64-bit hash of each word of the lower-case text, in order; punctuation separates words.

    One pass of array operations: prefix sums of a polynomial give every word's hash.
    """
    raw = (text or "").lower().encode("utf-8", "surrogatepass").translate(_SEPARATE)
    out, at = [], 0
    while at < len(raw):
        end = min(at + LONGEST, len(raw))
        if end < len(raw):  # a piece ends at a blank; a longer word is hashed whole
            cut = raw.rfind(b" ", at, end)
            end = cut if cut > at else (raw.find(b" ", end) % (len(raw) + 1))
        piece = np.frombuffer(raw, np.uint8, end - at, at)
        out.append(_piece_hashes(piece))
        at = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _piece_hashes(piece: np.ndarray) -> np.ndarray:
    up, down = _powers(len(piece) + 1)
    inside = np.zeros(len(piece) + 2, np.int8)
    inside[1:-1] = piece != 0x20
    edges = np.diff(inside)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    sums = np.zeros(len(piece) + 1, np.uint64)
    np.cumsum(_FOLD["bytes"][piece] * up[: len(piece)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts])


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of `size` words; of all words together where there are fewer, none of none."""
    if not len(words):
        return words
    n = min(size, len(words))
    out = np.zeros(len(words) - n + 1, np.uint64)
    for i in range(n):
        out = mixed(out * np.uint64(0xD6E8FEB86659FD93) + words[i : len(words) - n + 1 + i])
    return out
