"""Nearest neighbours by cross-polytope hashing.

A pseudo-rotation, three rounds of random signs and a fast Hadamard transform, turns a unit vector; its
hash is the signed axis nearest to it. Every row stands in one bucket of each table. A query visits the buckets of
its several nearest axes in each table, and everything found there is ranked by its exact inner
product. Buckets are split into cells of a few hundred rows, so one that holds a third of all rows
is many cells; the queries that visit it visit each. What a cell returns is the best few rows for each query.

Rows are dealt to bands of nearly one length, each with its own buckets, and hashed by direction alone. The score of
the last row a query found, over the longest length of a band, is the least cosine at which a row of the band can
still be among the nearest. Where the tables would miss too many rows at that cosine, as in bands of few long rows, the query
is compared with the whole band.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from skywell.llm.common import fresh, mixed, query, small_batches, table, written

TABLES = 20
PROBES = 5
CELL = 512  # rows
BAND = 1.1  # longest to shortest row of a band
FOUND = 0.95  # least probability that the tables find a row that can be among the nearest


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of each row, scaled to keep lengths."""
    n, size = x.shape
    h = 1
    while h < size:
        x = x.reshape(n, size // (2 * h), 2, h)
        x = np.stack((x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]), axis=2)
        h *= 2
    return x.reshape(n, size) / np.sqrt(size)


def signs(tables: int, size: int, seed: int) -> np.ndarray:
    """Random signs of the three rounds of each table, from a hash of their places."""
    at = np.arange(tables * 3 * size, dtype=np.uint64) + np.uint64(seed << 40)
    return np.where(mixed(mixed(at)) >> np.uint64(63), 1.0, -1.0).reshape(tables, 3, size)


def sides(x: np.ndarray, flips: np.ndarray) -> np.ndarray:
    """How near each row's rotation is to every signed axis: first the positive ends, then the negative."""
    for d in flips:
        x = hadamard(x * d)
    return np.concatenate((x, -x), axis=1)


def widened(x: np.ndarray) -> np.ndarray:
    """Unit rows of a power of two of coordinates."""
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    return np.pad(x, ((0, 0), (0, (1 << max(x.shape[1] - 1, 1).bit_length()) - x.shape[1])))


def least_cosine(dims: int, tables: int, probes: int, draws: int = 2000) -> float:
    """The cosine from which a row is found with probability `FOUND`, by drawing rotated pairs; 2 if none is enough."""
    size = 1 << max(dims - 1, 1).bit_length()
    r = np.random.default_rng(size)
    a, b = r.normal(size=(2, draws, size))
    a, b = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in (a, b))
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.maximum(np.linalg.norm(b, axis=1, keepdims=True), 1e-300)
    ends = np.concatenate((a, -a), axis=1)
    for cosine in np.arange(98, -1, -2) / 100:
        x = cosine * a + np.sqrt(1 - cosine**2) * b
        code = np.concatenate((x, -x), axis=1).argmax(axis=1)
        rank = (ends > ends[np.arange(draws), code][:, None]).sum(axis=1)
        if 1 - (rank >= probes).mean() ** tables < FOUND:
            return float(cosine + 0.02) if cosine < 0.98 else 2.0
    return 0.0


def products(q: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Inner products of paired rows; each depends on its own two rows alone, so copies tie."""
    return (q * m).sum(axis=1)


def best(q: np.ndarray, m: np.ndarray, q_ids, m_ids, wanted: int):
    """`(query row, member row, score)` of the best members of each query, ties to the smaller id."""
    rough = q @ m.T
    n = min(wanted + 1, m.shape[0])  # the query itself may be among them
    floor = -np.partition(-rough, n - 1, axis=1)[:, n - 1] - 1e-9 * (1 + np.abs(rough).max(axis=1))
    a, b = np.nonzero(rough >= floor[:, None])
    keep = q_ids[a] != m_ids[b]
    a, b = a[keep], b[keep]
    score = products(q[a], m[b])
    order = np.lexsort((m_ids[b], -score, a))
    a, b, score = a[order], b[order], score[order]
    rank = np.arange(len(a)) - np.searchsorted(a, a)
    return a[rank < wanted], b[rank < wanted], score[rank < wanted]


def matrix(column) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


def nearest(
    df: DataFrame, is_query, key: str = "vec_id", vector: str = "embedding", wanted: int = 20,
    tables: int = TABLES, probes: int = PROBES, seed: int = 2,
) -> DataFrame:
    """`query_id`, `rank` from 1, the key and `score` of the nearest rows found for each query.

    `is_query` is a condition on `key`. Rows with a null key or vector, a null or non-finite component or
    only zeros take no part; of rows with one key the least vector counts; vectors of another dimension are
    compared among themselves. A query that finds fewer than it wants is compared with
    all rows, and one whose last score lets a band hold nearer rows than the tables surely find with all
    rows of that band. Other columns are not read.
    """
    spark = df.sparkSession
    small_batches(spark)
    usable = F.expr("size(v) > 0 and forall(v, x -> x is not null and x = x and abs(x) < double('infinity')) and exists(v, x -> x <> 0)")
    rows = written(
        df.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
        .filter(F.col("id").isNotNull() & F.col("v").isNotNull()).filter(usable)
        .groupBy("id").agg(F.min("v").alias("v")).withColumn("size", F.size("v"))
    )
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    spans = {r["size"]: r for r in rows.groupBy("size").agg(F.min(length).alias("least"), F.max(length).alias("most"), F.count("*").alias("n")).collect()}
    # bands start at the least length of a dimension, so rows of one length are one band
    least = F.create_map(*[F.lit(x) for d, r in spans.items() for x in (d, r.least)]) if spans else None
    band = F.floor(F.log(length / F.element_at(least, F.col("size"))) / np.log(BAND) + 1e-9).cast("int") if spans else F.lit(0)
    rows = written(rows.withColumn("length", length).withColumn("band", band))
    bands = written(rows.groupBy("size", "band").agg(F.max("length").alias("longest")))
    trusted = {d: least_cosine(d, tables, probes) for d in spans}

    def hashed(query: bool, every: bool = False):
        def apply(batches):
            for b in batches:
                dims = b.column("size").to_numpy()
                for d in np.unique(dims):
                    part = b.filter(pa.array(dims == d))
                    x = widened(matrix(part.column("v")))
                    flips = signs(tables, x.shape[1], seed)
                    for t in range(1 if every else tables):
                        near = sides(x, flips[t])
                        if every:
                            codes = np.tile(np.arange(near.shape[1]), (len(near), 1))
                        elif query:
                            codes = np.argsort(-near, axis=1, kind="stable")[:, :probes]
                        else:
                            codes = near.argmax(axis=1)[:, None]
                        take = pa.array(np.repeat(np.arange(len(x)), codes.shape[1]))
                        yield pa.RecordBatch.from_arrays(
                            [part.column("id").take(take), part.column("v").take(take),
                             pa.array((codes.ravel() + (t << 32)).astype(np.int64)), part.column("size").take(take),
                             part.column("band").take(take)],
                            ["id", "v", "code", "size", "band"],
                        )

        return apply

    schema = "id long, v array<double>, code long, size int, band int"
    member_rows = rows.select("id", "v", "size", "band")
    members = written(member_rows.mapInArrow(hashed(False), schema))
    bucket = ["size", "band", "code"]
    cells = F.ceil(F.col("n") / CELL).cast("int")
    counted = written(members.groupBy(*bucket).agg(F.count("*").alias("n")).withColumn("cells", cells).drop("n"))
    placed = members.join(counted, bucket).withColumn("cell", F.pmod(F.xxhash64("id"), F.col("cells")).cast("int"))

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        empty = [pa.array([], t) for t in (pa.int64(), pa.int64(), pa.float64())]
        if not left.num_rows or not right.num_rows:
            return pa.table(empty, ["q", "m", "score"])
        q_ids, m_ids = left.column("id").to_numpy(), right.column("id").to_numpy()
        q, m = matrix(left.column("v")), matrix(right.column("v"))
        out = []
        for first in range(0, len(q), 256):
            a, b, score = best(q[first : first + 256], m, q_ids[first : first + 256], m_ids, wanted)
            out.append((q_ids[first : first + 256][a], m_ids[b], score))
        return pa.table([pa.array(np.concatenate(c)) for c in zip(*out)], ["q", "m", "score"])

    def search(queries: DataFrame, members: DataFrame, key: list[str]) -> DataFrame:
        """Every query against the buckets that agree with it in `key`, in whatever band where that is not in it."""
        asked = [f"q_{c}" for c in bucket]
        split = counted.select(*[F.col(c).alias(a) for c, a in zip(bucket, asked)], F.sequence(F.lit(0), F.col("cells") - 1).alias("all_cells"))
        visits = queries.select("id", "v", *[F.col(c).alias(f"q_{c}") for c in key]).join(split, [f"q_{c}" for c in key])
        visits = visits.withColumn("q_cell", F.explode("all_cells"))
        both = visits.select("id", "v", *asked, "q_cell").groupBy(*asked, "q_cell").cogroup(members.groupBy(*bucket, "cell"))
        found = both.applyInArrow(compare, "q long, m long, score double")
        return found.distinct()

    def ranked(found: DataFrame) -> DataFrame:
        order = W.partitionBy("q").orderBy(F.desc("score"), "m")
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= wanted)

    asking = rows.filter(is_query(F.col("id")))
    found = written(ranked(search(asking.select("id", "v", "size", "band").mapInArrow(hashed(True), schema), placed, ["size", "code"])))
    last = found.filter(F.col("rank") == wanted).select("q", F.col("score").alias("last"))
    sure = F.element_at(F.create_map(*[F.lit(x) for d, c in trusted.items() for x in (d, c)]), F.col("size")) if spans else F.lit(0.0)
    cosine = F.col("last") / (F.col("length") * F.col("longest"))  # of a row that would be the last
    left = asking.drop("band").join(last, asking.id == last.q, "left").join(F.broadcast(bands), "size")
    left = written(left.filter(F.col("last").isNull() | ((cosine < sure) & (cosine <= 1 + 1e-9))).select("id", "v", "size", "band"))
    if not left.isEmpty():
        first = placed.filter(F.shiftright("code", 32) == 0)
        rest = search(left.mapInArrow(hashed(True, every=True), schema), first, bucket)
        found = ranked(found.select("q", "m", "score").union(rest).distinct())
    names = ["query_id", "rank", fresh(key, ["query_id", "rank", "score"]), "score"]
    return found.select("q", "rank", "m", "score").toDF(*names)


@query()
def op2_neighbours(spark, sf_dir):
    """The nearest rows of every twentieth vector."""
    return nearest(table(spark, sf_dir, "embeddings"), lambda key: key % 20 == 0)
