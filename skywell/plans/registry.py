"""The table of named queries and the SQL each one is checked against."""

from pyspark.sql import DataFrame, functions as F

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    """Register a `(spark, sf_dir) -> DataFrame` under its name, with its SQL if it has one."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def rounded(df: DataFrame, digits: int = 10) -> DataFrame:
    """The final projection: doubles rounded once, whole numbers as bigint, zone-less times."""
    out = []
    for f in df.schema:
        kind = f.dataType.typeName()
        if kind == "double":
            out.append(F.round(f.name, digits).alias(f.name))
        elif kind in ("integer", "short", "byte"):
            out.append(F.col(f.name).cast("bigint").alias(f.name))
        elif kind == "timestamp":
            out.append(F.col(f.name).cast("timestamp_ntz").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def final(ctes: str, source: str, plain=(), doubles=(), where: str = "", digits: int = 10) -> str:
    """SQL for the same final projection; items may be `expression AS name`."""

    def name_of(item):
        return item.rsplit(" AS ", 1) if " AS " in item else (item, item)

    columns = list(plain)
    for item in doubles:
        expr, name = name_of(item)
        columns.append(f"round({expr}, {digits}) AS {name}")
    head = f"WITH {ctes} " if ctes else ""
    return f"{head}SELECT {', '.join(columns)} FROM {source} {where}"
