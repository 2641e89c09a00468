"""Run named queries beside their SQL and compare the rows.

`python -m tests.compare [sf_dir] [name ...]` prints one line per query.
"""

import datetime
import math
import sys
import time
import traceback

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def session(cpus: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("skywell")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    return spark


def database(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v + 0.0
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(repr([plain(r[i]) for i in order]) for r in rows)


def difference(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    ours = table(df.columns, df.collect())
    cursor = con.execute(sql)
    theirs = table([c[0] for c in cursor.description], cursor.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} != {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"rows {len(ours[1])} != {len(theirs[1])}"
    wrong = [(a, b) for a, b in zip(*(ours[1], theirs[1])) if a != b]
    return f"{len(wrong)} of {len(ours[1])} rows: {wrong[0][0]} != {wrong[0][1]}" if wrong else None


def main(args):
    sys.path.insert(0, ".")
    from __spark_entry__ import oracle_sql, queries

    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:] or list(queries())
    spark, con = session(), database(sf_dir)
    for name in names:
        started = time.time()
        try:
            df = queries()[name](spark, sf_dir)
            if name in oracle_sql():
                found = difference(df, con, oracle_sql()[name])
                word = "equal" if found is None else f"DIFFERENT {found[:600]}"
            else:
                word = f"rows {df.count()}"
        except Exception as e:
            word = f"FAILED {type(e).__name__} {str(e)[:700]}"
            if "-v" in args:
                traceback.print_exc()
        print(f"{name:28s} {time.time() - started:6.1f}s {word}", flush=True)


if __name__ == "__main__":
    main(sys.argv[1:])
