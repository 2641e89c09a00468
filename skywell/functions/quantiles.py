"""Exact quantiles that never gather a group's values in one place."""

from functools import reduce

from pyspark.sql import DataFrame, Window as W, functions as F

from skywell.functions.attach import attach, melt, null_safe_join, written_groups
from skywell.functions.scalars import count_where

CELLS = 1024  # equal widths that a bracket is cut into


def exact_quantiles(df: DataFrame, cols, probs, keys=(), accuracy: int = 20_000) -> DataFrame:
    """Linearly interpolated quantiles: rows of `(keys, channel, n, q)`, q an array by `probs`.

    Pass 1 sketches a bracket of rank width 8/accuracy around each probability (one small row
    per group). Pass 2 counts what lies below each bracket and keeps only the distinct values
    inside one, so every other row collapses map-side. Of the bracket values, about `8 n / accuracy`
    per probability at most and fewer when values repeat, one cell in CELLS is ranked. A hot value
    is one row. The values next to each bracket cover ranks just outside it; if a sketch ever
    missed by more, the query fails instead of guessing.
    """
    keys, probs = list(keys), [float(p) for p in probs]
    slack, k = 4.0 / accuracy, len(probs)
    edges = [max(0.0, p - slack) for p in probs] + [min(1.0, p + slack) for p in probs]
    sketch = df.groupBy(*keys).agg(
        *[
            F.struct(
                F.count(c).alias("n"),
                F.percentile_approx(F.col(c).cast("double"), edges, accuracy).alias("e"),
            ).alias(c)
            for c in cols
        ]
    )
    brackets = written_groups(
        melt(
            sketch, cols,
            lambda c: [F.col(c)["n"].alias("n"), *[F.col(c)["e"][i].alias(f"e{i}") for i in range(2 * k)]],
            keys,
        )
    )
    own = [*keys, "channel"]
    long = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(keys, list(cols), "channel", "v")
    rows = attach(long.filter("v IS NOT NULL"), brackets, own, "_s", written=True)
    low = lambda i: F.col("_s")[f"e{i}"]
    high = lambda i: F.col("_s")[f"e{k + i}"]
    inside = [F.col("v").between(low(i), high(i)) for i in range(k)]
    kept = rows.groupBy(*own, F.when(reduce(lambda a, b: a | b, inside), F.col("v")).alias("bv")).agg(
        F.count("*").alias("cnt"),
        *[count_where(F.col("v") < low(i)).alias(f"b{i}") for i in range(k)],
        *[F.max(F.when(F.col("v") < low(i), F.col("v"))).alias(f"p{i}") for i in range(k)],
        *[F.min(F.when(F.col("v") > high(i), F.col("v"))).alias(f"s{i}") for i in range(k)],
    )
    kept = attach(kept, brackets, own, "_s", written=True).select("*", "_s.*").drop("_s")
    return _ranked(kept, own, probs).select(*keys, "channel", "n", "q")


def _ranked(kept: DataFrame, own: list[str], probs: list[float]) -> DataFrame:
    """The quantiles of each group from its bracket rows.

    Each bracket is cut into CELLS equal widths. Sums per cell, at most CELLS + 1 rows per group and
    probability, tell which cells hold the two target ranks; only the rows of those are ranked.
    """
    k = len(probs)

    def bracket(i):
        within = (F.col("bv") >= F.col(f"e{i}")) & (F.col("bv") <= F.col(f"e{k + i}"))
        return F.struct(
            F.lit(i).alias("i"), F.lit(probs[i]).alias("p"), F.col(f"b{i}").alias("b"), F.col(f"p{i}").alias("before"),
            F.col(f"s{i}").alias("after"), F.when(within, F.col("bv")).alias("x"), F.when(within, F.col("cnt")).otherwise(0).alias("c"),
            F.col(f"e{i}").alias("low"), (F.col(f"e{k + i}") - F.col(f"e{i}")).alias("width"),
        )

    parts = kept.select(*own, "n", F.inline(F.array(*[bracket(i) for i in range(k)])))
    spread = (F.col("width") > 0) & (F.col("width") < float("inf"))
    place = F.least(F.floor((F.col("x") - F.col("low")) / F.col("width") * CELLS), F.lit(CELLS - 1).cast("bigint"))
    parts = parts.withColumn("cell", F.when(F.col("x").isNull(), F.lit(-1)).when(spread, place).otherwise(0))
    one, cell = [*own, "i"], [*own, "i", "cell"]
    whole = W.partitionBy(*one)
    cells = parts.groupBy(*cell).agg(
        *[F.max(c).alias(c) for c in ("n", "p", "before")], F.min("after").alias("after"), *[F.sum(c).alias(c) for c in ("b", "c")]
    ).withColumns({
        "below": F.sum("b").over(whole),
        "upto": F.sum("b").over(whole) + F.sum("c").over(whole.orderBy("cell").rowsBetween(W.unboundedPreceding, W.currentRow)),
        "want": (F.col("n") - 1) * F.col("p"),
    })
    ranks = {"l": F.floor("want"), "h": F.ceil("want")}
    start = F.col("upto") - F.col("c")
    holds = [(F.col("cell") >= 0) & (r >= start) & (r < F.col("upto")) for r in ranks.values()]
    chosen = cells.filter(holds[0] | holds[1]).select(*cell, start.alias("start"), "want")
    inner = null_safe_join(parts.filter("x IS NOT NULL").select(*cell, "x", "c"), chosen, cell, "inner").withColumn(
        "end", F.col("start") + F.sum("c").over(W.partitionBy(*cell).orderBy("x").rowsBetween(W.unboundedPreceding, W.currentRow))
    )
    hit = {s: F.max(F.when((r < F.col("end")) & (r >= F.col("end") - F.col("c")), F.col("x"))).alias(s) for s, r in ranks.items()}
    edges = cells.groupBy(*one).agg(
        *[F.max(c).alias(c) for c in ("n", "want", "below", "upto", "before")], F.min("after").alias("after")
    )
    found = null_safe_join(edges, inner.groupBy(*one).agg(*hit.values()), one)
    value = {
        s: F.when(F.col(s).isNotNull(), F.col(s))
        .when(r == F.col("below") - 1, F.col("before"))
        .when(r == F.col("upto"), F.col("after"))
        .otherwise(F.raise_error(F.lit("quantile bracket missed")).cast("double"))
        for s, r in ranks.items()
    }
    found = found.withColumn("v", value["l"] + (value["h"] - value["l"]) * (F.col("want") - F.floor("want")))
    return found.groupBy(*own).agg(
        F.max("n").alias("n"), F.array(*[F.max(F.when(F.col("i") == i, F.col("v"))) for i in range(k)]).alias("q")
    )
