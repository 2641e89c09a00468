"""Isolation forest (H12): trees built from small samples, all rows scored on executors."""

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from skywell.functions.quantiles import exact_quantiles
from skywell.session import settle

TREES, SAMPLE = 100, 256  # fixed values: the usual forest size
MIN_ROWS = 10  # fixed value: fewer complete rows are not judged


def path_correction(n):
    """Mean depth of an unsuccessful search among n points."""
    n = np.asarray(n, dtype=float)
    safe = np.maximum(n, 2.0)
    return np.where(n > 2, 2 * (np.log(safe - 1) + np.euler_gamma) - 2 * (safe - 1) / safe, np.where(n == 2, 1.0, 0.0))


def grow_tree(points: np.ndarray, seed: int) -> list[tuple]:
    """Nodes `(feature, cut, left, right, leaf value)` of one tree; feature -1 marks a leaf."""
    rng, nodes = np.random.default_rng(seed), []
    limit = math.ceil(math.log2(max(len(points), 2)))
    todo = [(points, 0, None, None)]
    while todo:
        part, depth, parent, side = todo.pop()
        at = len(nodes)
        if parent is not None:
            nodes[parent][side] = at
        low, high = part.min(axis=0), part.max(axis=0)
        open_features = np.flatnonzero(high > low)
        if depth >= limit or len(part) <= 1 or not len(open_features):
            nodes.append([-1, 0.0, -1, -1, depth + float(path_correction(len(part)))])
            continue
        feature = int(rng.choice(open_features))
        cut = float(rng.uniform(low[feature], high[feature]))
        nodes.append([feature, cut, -1, -1, 0.0])
        goes_left = part[:, feature] <= cut
        todo.append((part[~goes_left], depth + 1, at, 3))
        todo.append((part[goes_left], depth + 1, at, 2))
    return [tuple(n) for n in nodes]


def standardized(stats: dict[str, tuple[float, float]]) -> list[Column]:
    """`_z_` columns from means and deviations; a column without spread is only centred."""
    return [((F.col(c).cast("double") - m) / (s or 1.0)).alias(f"_z_{c}") for c, (m, s) in stats.items()]


@dataclass
class Forest:
    """A fitted forest: at most `TREES * (2 * SAMPLE - 1)` nodes, whatever the data size."""

    cols: list[str]
    row_id: str
    stats: dict[str, tuple[float, float]]  # mean and deviation of each column
    nodes: list[list[tuple]]
    sample: int

    def score(self, df: DataFrame) -> DataFrame:
        """The complete rows of `df` with `anomaly` in (0, 1]; higher is more isolated."""
        scaled = df.dropna(subset=self.cols).select("*", *standardized(self.stats))
        trees = [tuple(np.array(x) for x in zip(*t)) for t in self.nodes]
        norm = float(path_correction(self.sample))

        @F.pandas_udf("double")
        def anomaly(*columns: pd.Series) -> pd.Series:
            x = np.column_stack([c.to_numpy(dtype=float) for c in columns])
            total, rows = np.zeros(len(x)), np.arange(len(x))
            for feature, cut, left, right, leaf in trees:
                at = np.zeros(len(x), dtype=int)
                while True:
                    f = feature[at]
                    inner = f >= 0
                    if not inner.any():
                        break
                    step = np.where(x[rows, np.maximum(f, 0)] <= cut[at], left[at], right[at])
                    at = np.where(inner, step, at)
                total += leaf[at]
            return pd.Series(np.power(2.0, -total / len(trees) / norm))

        return scaled.withColumn("anomaly", anomaly(*[F.col(f"_z_{c}") for c in self.cols])).drop(
            *[f"_z_{c}" for c in self.cols]
        )

    def flag(self, scored: DataFrame, contamination: float) -> DataFrame:
        """Rows beyond the exact contamination quantile, with `decision` below 0."""
        kept = settle(scored.withColumn("_low", -F.col("anomaly")))
        cut = exact_quantiles(kept, ["_low"], [contamination]).select(F.col("q")[0]).scalar()
        return kept.withColumn("decision", F.col("_low") - cut).filter("decision < 0").drop("_low")


def fit_forest(df: DataFrame, cols, row_id: str, trees: int = TREES, sample: int = SAMPLE, seed: int = 42) -> Forest | None:
    """Grow each tree on its own sample of `sample` rows, chosen by hash so a retry repeats it.

    A first hash thins the table to a pool whose size does not depend on it and deals every row of
    it to a tree, or to several trees where the table is smaller than the pool; each tree then
    takes the rows with its smallest hashes. Returns None below two columns or ten rows.
    """
    cols = list(cols)
    complete = df.dropna(subset=cols)
    if len(cols) < 2:
        return None
    scale = complete.agg(
        F.count("*").alias("n"),
        *[F.avg(F.col(c).cast("double")).alias(f"m_{c}") for c in cols],
        *[F.stddev_pop(F.col(c).cast("double")).alias(f"s_{c}") for c in cols],
    ).first()
    total = scale.n
    if total < MIN_ROWS:
        return None
    stats = {c: (scale[f"m_{c}"], scale[f"s_{c}"]) for c in cols}
    sample = min(sample, total)

    def share(column, wanted, of):
        """True for about `wanted` of `of` rows, by a hash that is uniform on [0, 1)."""
        return (F.pmod(column, F.lit(1 << 40)) / F.lit(float(1 << 40))) < min(1.0, wanted / of)

    pool_size = 4 * trees * sample
    names = [f"_z_{c}" for c in cols]
    pool = complete.filter(share(F.xxhash64(F.col(row_id), F.lit(seed)), pool_size, total)).select(
        F.col(row_id).alias("_id"), *standardized(stats)
    )
    times = min(trees, math.ceil(pool_size / min(pool_size, total)))
    turn = F.explode(F.sequence(F.lit(0), F.lit(times - 1)))
    dealt = F.col("_turn") if times == trees else F.pmod(F.xxhash64("_id", "_turn", F.lit(seed)), F.lit(trees))
    drawn = (
        pool.withColumn("_turn", turn).withColumn("_tree", dealt.cast("int"))
        .withColumn("_h", F.xxhash64(F.col("_id"), F.col("_tree"), F.lit(seed))).drop("_turn").distinct()
    )

    def build(part: pd.DataFrame) -> pd.DataFrame:
        tree = int(part["_tree"].iloc[0])
        chosen = part.sort_values(["_h", "_id"]).head(sample)
        nodes = grow_tree(chosen[names].to_numpy(dtype=float), seed * 1_000 + tree)
        out = pd.DataFrame(nodes, columns=["feature", "cut", "left_node", "right_node", "leaf"])
        out.insert(0, "tree", tree)
        out.insert(1, "node", range(len(out)))
        return out

    grown = drawn.groupBy("_tree").applyInPandas(
        build, "tree int, node int, feature int, cut double, left_node int, right_node int, leaf double"
    )
    per_tree: dict[int, list] = {}
    for r in grown.orderBy("tree", "node").collect():  # bounded by trees * (2 * sample - 1) rows
        per_tree.setdefault(r.tree, []).append((r.feature, r.cut, r.left_node, r.right_node, r.leaf))
    return Forest(cols, row_id, stats, [per_tree[t] for t in sorted(per_tree)], sample)
