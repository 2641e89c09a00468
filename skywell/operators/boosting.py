"""Boosted regression trees on binned features.

Bin edges are quantiles of the training rows, found once. Rows are kept as blocks of bin numbers. A tree level needs only
the sums of residuals by node, feature and bin: every block adds up its own, the sums are merged on the
executors, and the driver picks the splits. All settings grow in lock step, one job a level. Rows that make up one
block need no merging, so there the same loop runs inside one task for each setting.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from skywell.schema import BOOSTED_CANDIDATES
from skywell.session import settle

BINS = 64
BLOCK_ROWS = 50_000
SHRINK = 1.0  # added to a leaf's row count
LINEAGE = 10  # trees whose predictions are recomputed before they are written


@dataclass
class Tree:
    """A full binary tree in heap order; `feature` is -1 where a node is a leaf."""

    feature: np.ndarray
    cut: np.ndarray  # rows of bins up to the cut go left
    value: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        n = (2 << depth) - 1
        return cls(np.full(n, -1, np.int16), np.zeros(n, np.int16), np.zeros(n))

    def node_of(self, bins: np.ndarray, levels: int) -> np.ndarray:
        """The node each row of `bins` is in after `levels` steps."""
        node, row = np.zeros(len(bins), np.int64), np.arange(len(bins))
        for _ in range(levels):
            f = self.feature[node]
            node = np.where(f >= 0, 2 * node + 1 + (bins[row, f] > self.cut[node]), node)
        return node

    def grow(self, level: int, sums: np.ndarray) -> bool:
        """Split the nodes of a level by `sums` (node, feature, bin, [rows, residuals]); whether any was."""
        first = (1 << level) - 1
        left = np.cumsum(sums, axis=2)
        total = left[:, :1, -1:, :]
        right = total - left
        score = lambda s: s[..., 1] ** 2 / (s[..., 0] + SHRINK)
        gain = score(left) + score(right) - score(total)
        gain[(left[..., 0] < 1) | (right[..., 0] < 1)] = 0.0
        flat = gain.reshape(len(sums), -1)
        best = flat.argmax(axis=1)
        for i in np.flatnonzero(flat[np.arange(len(sums)), best] > 1e-9):
            f, b = divmod(int(best[i]), sums.shape[2])
            node = first + i
            self.feature[node], self.cut[node] = f, b
            for child, side in ((2 * node + 1, left), (2 * node + 2, right)):
                self.value[child] = side[i, f, b, 1] / (side[i, f, b, 0] + SHRINK)
        if level == 0:
            self.value[0] = total[0, 0, 0, 1] / (total[0, 0, 0, 0] + SHRINK)
        return bool((self.feature[first : first + len(sums)] >= 0).any())


def level_sums(bins: np.ndarray, residual: np.ndarray, tree: Tree, level: int) -> np.ndarray:
    """Rows and residuals by node of the level, feature and bin."""
    width = bins.shape[1]
    node = tree.node_of(bins, level) - ((1 << level) - 1)
    here = node >= 0  # the others ended in a leaf above
    at = ((node[here, None] * width + np.arange(width)) * BINS + bins[here]).ravel()
    size = (1 << level) * width * BINS
    sums = [np.bincount(at, minlength=size), np.bincount(at, np.repeat(residual[here], width), size)]
    return np.stack(sums, axis=-1).reshape(1 << level, width, BINS, 2)


def grown(settings: dict, sums_of, keep) -> None:
    """Grow trees for all `settings` (`number: (trees, rate, depth)`) in lock step.

    `sums_of(trees, level)` gives the sums of a level for each tree; `keep(trees)` takes a finished round.
    """
    for t in range(max(s[0] for s in settings.values())):
        trees = {c: Tree.empty(depth) for c, (n, _, depth) in settings.items() if t < n}
        open_ = dict(trees)
        for level in range(max(settings[c][2] for c in trees)):
            open_ = {c: tree for c, tree in open_.items() if level < settings[c][2]}
            if not open_:
                break
            sums = sums_of(open_, level)
            open_ = {c: tree for c, tree in open_.items() if tree.grow(level, sums[c])}
        keep(trees)


@dataclass
class Block:
    """Rows as bin numbers, with what is predicted for them by each setting."""

    bins: np.ndarray
    y: np.ndarray
    learn: np.ndarray

    @classmethod
    def of(cls, width: int, row: dict) -> Block:
        bins = np.frombuffer(row["bins"], np.uint8).reshape(-1, width)
        return cls(bins, np.frombuffer(row["y"]), np.frombuffer(row["learn"], np.bool_))


def fitted_in_task(block: Block, setting: tuple, base: float) -> tuple[list[Tree], float]:
    """The trees of one setting over one block, and the squared error of the rows not learnt from."""
    guess = np.full(len(block.y), base)
    bins, out = np.ascontiguousarray(block.bins[block.learn]), []

    def sums_of(trees, level):
        return {0: level_sums(bins, block.y[block.learn] - guess[block.learn], trees[0], level)}

    def keep(trees):
        out.append(trees[0])
        guess[:] += setting[1] * trees[0].value[trees[0].node_of(block.bins, setting[2])]

    grown({0: setting}, sums_of, keep)
    return out, float(((block.y - guess)[~block.learn] ** 2).sum())


def fitted(blocks: DataFrame, width: int, settings: dict, base: float) -> dict:
    """`number: (trees, squared error of the rows not learnt from)` over written blocks."""
    if blocks.count() == 1:
        def fit(batches):
            for b in batches:
                for row in b.to_pylist():
                    trees, error = fitted_in_task(Block.of(width, row), settings[row["c"]], base)
                    made = [np.concatenate([getattr(t, x) for t in trees]).tobytes() for x in ("feature", "cut", "value")]
                    columns = [pa.array([row["c"]], pa.int32()), *(pa.array([x], pa.binary()) for x in made), pa.array([error])]
                    yield pa.RecordBatch.from_arrays(columns, ["c", "feature", "cut", "value", "error"])

        each = blocks.withColumn("c", F.explode(F.lit(list(settings)))).repartitionByRange(len(settings), "c")
        out = {}
        for r in each.mapInArrow(fit, "c int, feature binary, cut binary, value binary, error double").collect():
            n = settings[r.c][0]
            arrays = zip(*(np.frombuffer(x, k).reshape(n, -1) for x, k in ((r.feature, np.int16), (r["cut"], np.int16), (r.value, float))))
            out[r.c] = [Tree(*a) for a in arrays], r.error
        return out
    return fitted_by_level(blocks, width, settings, base)


def fitted_by_level(blocks: DataFrame, width: int, settings: dict, base: float) -> dict:
    """The same with a job a level; predictions of finished trees are written every few trees."""
    forests: dict = {c: [] for c in settings}
    numbers = list(settings)
    start = settle(blocks.withColumn("guess", F.lit(None).cast("binary")))
    state = {"rows": start, "done": 0}

    def guessed(row, block, trees_from):
        guess = np.frombuffer(row["guess"]).reshape(len(numbers), -1).copy() if row["guess"] else np.full((len(numbers), len(block.y)), base)
        for i, c in enumerate(numbers):
            for tree in forests[c][trees_from:]:
                guess[i] += settings[c][1] * tree.value[tree.node_of(block.bins, settings[c][2])]
        return guess

    def sums_of(trees, level):
        done = state["done"]

        def add(batches):
            total: dict = {}
            for b in batches:
                for row in b.to_pylist():
                    block = Block.of(width, row)
                    guess = guessed(row, block, done)
                    for c, tree in trees.items():
                        residual = (block.y - guess[numbers.index(c)])[block.learn]
                        sums = level_sums(block.bins[block.learn], residual, tree, level)
                        total[c] = total[c] + sums if c in total else sums
            if total:
                yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([s.tobytes() for s in total.values()], pa.binary())], ["c", "sums"])

        def merge(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = 0.0
            for b in batches:
                for s in b.column("sums").to_pylist():
                    total = total + np.frombuffer(s)
            yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["c", "sums"])

        merged = state["rows"].mapInArrow(add, "c int, sums binary").groupBy("c").applyInArrow(merge, "c int, sums binary")
        return {r.c: np.frombuffer(r.sums).reshape(1 << level, width, BINS, 2) for r in merged.collect()}

    def keep(trees):
        for c, tree in trees.items():
            forests[c].append(tree)
        longest = max(map(len, forests.values()))
        if longest - state["done"] >= LINEAGE:
            state["rows"] = settle(advanced(state["done"]))
            state["done"] = longest

    def advanced(done):
        def put(batches):
            for b in batches:
                rows = b.to_pylist()
                guess = [guessed(r, Block.of(width, r), done).tobytes() for r in rows]
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(guess, pa.binary())], b.schema.names)

        return state["rows"].mapInArrow(put, state["rows"].schema)

    grown(settings, sums_of, keep)
    done = state["done"]

    def error(batches):
        for b in batches:
            for row in b.to_pylist():
                block = Block.of(width, row)
                off = ((block.y - guessed(row, block, done)) ** 2)[:, ~block.learn].sum(axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array(off)], ["c", "e"])

    errors = {r.c: r.e for r in state["rows"].mapInArrow(error, "c int, e double").groupBy("c").agg(F.sum("e").alias("e")).collect()}
    return {c: (forests[c], errors[c]) for c in numbers}


def binned(rows: DataFrame, edges: np.ndarray, features: list[str], target: str, learn: tuple, blocks: int) -> DataFrame:
    """Written blocks of rows: bin numbers, targets, and whether a row is learnt from (its split is in `learn`)."""

    def put(batches):
        parts, size = [], 0
        for b in batches:
            parts.append(b)
            size += b.num_rows
            if size >= BLOCK_ROWS:
                yield block_of(parts)
                parts, size = [], 0
        if size:
            yield block_of(parts)

    def block_of(parts):
        t = pa.Table.from_batches(parts)
        x = np.column_stack([np.searchsorted(e, t.column(i).to_numpy(), "left") for i, e in enumerate(edges)]).astype(np.uint8)
        y = t.column(len(edges)).to_numpy().astype(float)
        known = np.isin(np.array(t.column(len(edges) + 1).to_pylist(), object), learn)
        return pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in (x, y, known)], ["bins", "y", "learn"])

    chosen = rows.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)], F.col(target).cast("double").alias("y"), "split")
    return settle(chosen.coalesce(blocks).mapInArrow(put, "bins binary, y binary, learn binary"))


@dataclass
class Boosted:
    """Boosted trees with their feature order and bin edges."""

    base: float
    trees: list[Tree]
    edges: list[np.ndarray]
    features: list[str]
    params: tuple
    val_rmse: float | None

    def predict(self, df: DataFrame, into: str = "prediction") -> DataFrame:
        """Rows with all features and their prediction."""
        model = self

        @F.pandas_udf("double")
        def predicted(x):
            values = np.stack(x.to_numpy()) if len(x) else np.zeros((0, len(model.features)))
            bins = np.column_stack([np.searchsorted(e, values[:, i], "left") for i, e in enumerate(model.edges)])
            out = np.full(len(values), model.base)
            for tree in model.trees:
                out += model.params[1] * tree.value[tree.node_of(bins, model.params[2])]
            import pandas as pd

            return pd.Series(out)

        rows = df.dropna(subset=self.features)
        return rows.withColumn(into, predicted(F.array(*[F.col(c).cast("double") for c in self.features])))

    def save(self, path: str) -> None:
        """The trees as rows, and one row about the model."""
        spark = SparkSession.active()
        nodes = [(i, j, int(t.feature[j]), int(t.cut[j]), float(t.value[j])) for i, t in enumerate(self.trees) for j in range(len(t.feature))]
        spark.createDataFrame(nodes, "tree int, node int, feature int, cut int, value double").coalesce(1).write.mode("overwrite").parquet(f"{path}/trees")
        about = [(self.base, self.features, list(map(float, self.params)), self.val_rmse, [e.tolist() for e in self.edges])]
        spark.createDataFrame(about, ABOUT).coalesce(1).write.mode("overwrite").json(f"{path}/about")

    @classmethod
    def load(cls, path: str) -> Boosted:
        spark = SparkSession.active()
        about = spark.read.schema(ABOUT).json(f"{path}/about").first()
        trees, rate, depth = about.params
        made = [Tree.empty(int(depth)) for _ in range(int(trees))]
        for r in spark.read.parquet(f"{path}/trees").collect():
            t = made[r.tree]
            t.feature[r.node], t.cut[r.node], t.value[r.node] = r.feature, r["cut"], r.value
        edges = [np.array(e, float) for e in about.edges]
        return cls(about.base, made, edges, about.features, (int(trees), rate, int(depth)), about.val_rmse)


ABOUT = "base double, features array<string>, params array<double>, val_rmse double, edges array<array<double>>"


def select_boosted(
    parts: DataFrame, features: list[str], target: str = "y", candidates=tuple(BOOSTED_CANDIDATES), block_rows: int = BLOCK_ROWS,
) -> Boosted:
    """Fit each setting on train, keep the lowest validation RMSE, refit on train + val.

    Rows that lack a feature or the target are left out. Of equal errors the first setting wins.
    """
    rows = settle(parts.filter("split IN ('train', 'val')").select("split", target, *features).dropna(subset=[target, *features]))
    train = F.col("split") == "train"
    shares = [i / BINS for i in range(1, BINS)]
    about = rows.agg(
        F.count("*").alias("n"), F.avg(F.when(train, F.col(target))).alias("base"), F.avg(target).alias("all"),
        F.count(F.when(~train, 1)).alias("held"),
        *[F.percentile_approx(F.when(train, F.col(c)), shares, 10_000).alias(f"q{i}") for i, c in enumerate(features)],
    ).first()
    edges = [np.unique(np.array(about[f"q{i}"] or [], float)) for i in range(len(features))]
    blocks = max(1, -(-about.n // block_rows))
    settings = dict(enumerate(candidates))
    first = fitted(binned(rows, edges, features, target, ("train",), blocks), len(features), settings, about.base)
    best = min(settings, key=lambda c: (first[c][1], c))
    both = binned(rows, edges, features, target, ("train", "val"), blocks)
    trees = fitted(both, len(features), {0: settings[best]}, about["all"])[0][0]
    error = float(np.sqrt(first[best][1] / about.held)) if about.held else None
    return Boosted(about["all"], trees, edges, features, settings[best], error)
