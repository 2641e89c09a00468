"""Connected components of a large graph, and joins whose small side has a checked size."""

from pyspark.sql import DataFrame, functions as F

from skywell.llm.common import written

#: Rows of one narrow key column that may be sent to every task: about 32 MB.
SENT_ROWS = 1_000_000


def sent_if_small(keys: DataFrame, rows: int | None = None) -> DataFrame:
    """A written set of narrow keys, marked for broadcast when it has few rows; else Spark shuffles it."""
    return F.broadcast(keys) if (keys.count() if rows is None else rows) <= SENT_ROWS else keys


def components(edges: DataFrame) -> DataFrame:
    """`node`, `label` for every node of the written table `edges` (`a`, `b`): the least node it is connected to.

    Each round takes the least label among a node and its neighbours, then follows labels to their own labels,
    so paths shorten by more than half; rounds go on until none changes anything. Sums are combined
    before they are shuffled and joins may be split, so a node with very many edges is no single task.
    """
    both = written(edges.select("a", "b").union(edges.select("b", "a")).filter("a <> b").distinct())
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")))
    while True:
        near = (
            both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
            .join(labels, "node").select("node", F.least("near", "label").alias("label"), F.col("label").alias("was"))
        )
        near = written(near)
        step = near.select(F.col("node").alias("label"), F.col("label").alias("next"))
        moved = written(near.join(step, "label").select("node", F.col("next").alias("label"), "was"))
        labels = moved.select("node", "label")
        if moved.filter("label <> was").isEmpty():
            return labels
