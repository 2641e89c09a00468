"""Linear models.

The linear family is chosen from sufficient statistics: one pass finds each feature's mean,
one more the shifted cross products of every part. Nine candidates, their validation errors
and the refit on train + validation all follow from those few numbers, for every series at
once; the feature table is never read again.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from skywell.functions.attach import attach
from skywell.schema import LINEAR_CANDIDATES


def cross_moments(df: DataFrame, names: list[str], by, centre: DataFrame, keys) -> DataFrame:
    """Per group: row count, sums and cross products of `names`, shifted by `centre`."""
    shifted = attach(df, centre, keys, "_c").select(
        *by, *[(F.col(c) - F.col(f"_c.{c}")).alias(f"_{i}") for i, c in enumerate(names)]
    )
    k = len(names)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    return shifted.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.array(*[F.sum(f"_{i}") for i in range(k)]).alias("s1"),
        F.array(*[F.sum(F.col(f"_{i}") * F.col(f"_{j}")) for i, j in pairs]).alias("s2"),
    )


@dataclass
class Moments:
    """Numbers of one part: `n` rows, `s1` sums, `s2` cross products, all about `centre`."""

    n: float
    s1: np.ndarray
    s2: np.ndarray

    @classmethod
    def of(cls, n, s1, s2):
        k = len(s1)
        full = np.zeros((k, k))
        full[np.triu_indices(k)] = s2
        return cls(float(n), np.array(s1, dtype=float), full + np.triu(full, 1).T)

    def __add__(self, other):
        return Moments(self.n + other.n, self.s1 + other.s1, self.s2 + other.s2)

    def spread(self):
        mean = self.s1 / self.n
        return mean, self.s2 / self.n - np.outer(mean, mean)

    def squared_error(self, intercept: float, coef: np.ndarray) -> float:
        """Sum of squared residuals of a line given about the same centre; the target is last."""
        a = np.append(-coef, 1.0)
        return max(float(a @ self.s2 @ a - 2 * intercept * (a @ self.s1) + self.n * intercept**2), 0.0)


def solve_line(m: Moments, algorithm: str, alpha: float | None) -> tuple[float, np.ndarray]:
    """Intercept and coefficients about the centre, fitted on features scaled to unit variance."""
    mean, cov = m.spread()
    scale = np.sqrt(np.maximum(np.diag(cov)[:-1], 0.0))
    scale[scale == 0] = 1.0
    gram, target = cov[:-1, :-1] / np.outer(scale, scale), cov[:-1, -1] / scale
    if algorithm == "linear":
        beta = np.linalg.lstsq(gram, target, rcond=None)[0]
    elif algorithm == "ridge":
        beta = np.linalg.solve(gram + alpha / m.n * np.eye(len(target)), target)
    else:
        beta = np.zeros(len(target))
        for _ in range(10_000):
            before = beta.copy()
            for j in range(len(beta)):
                if gram[j, j] <= 0:
                    continue
                pull = target[j] - gram[j] @ beta + gram[j, j] * beta[j]
                beta[j] = np.sign(pull) * max(abs(pull) - alpha, 0.0) / gram[j, j]
            if np.max(np.abs(beta - before)) <= 1e-12 * max(1.0, np.max(np.abs(beta))):
                break
    coef = beta / scale
    return float(mean[-1] - coef @ mean[:-1]), coef


MODEL_FIELDS = (
    "algorithm string, alpha double, val_rmse double, test_rmse double, test_r2 double, "
    "intercept double, coef array<double>, "
    "candidates array<struct<algorithm string, alpha double, val_rmse double>>"
)


def fit_linear(
    parts: DataFrame, features: list[str], target: str = "y", keys=(), candidates=tuple(LINEAR_CANDIDATES)
) -> DataFrame:
    """One row per series with the selected, refitted model.

    `parts` has `split` in train / val / test. The lowest validation RMSE wins, the first on a
    tie; the winner is refitted on train + val. Without a val part the first candidate is fitted.
    """
    keys = list(keys)
    names = [*features, target]
    data = parts.dropna(subset=names)
    centre = data.groupBy(*keys).agg(*[F.avg(c).alias(c) for c in names])
    moments = cross_moments(data, names, [*keys, "split"], centre, keys)
    per_series = attach(
        moments.groupBy(*keys).agg(F.collect_list(F.struct("split", "n", "s1", "s2")).alias("parts")),
        centre.select(*keys, F.array(*names).alias("centre")), keys, "_c",
    ).select(*keys, "parts", F.col("_c.centre").alias("centre"))
    schema = T.StructType([parts.schema[k] for k in keys] + list(T.StructType.fromDDL(MODEL_FIELDS)))

    def choose(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for r in frame.to_dict("records"):
                found = {p["split"]: Moments.of(p["n"], p["s1"], p["s2"]) for p in r["parts"]}
                centre_of = np.array(r["centre"], dtype=float)
                if "train" not in found:
                    continue
                tried, best = [], None
                for algorithm, alpha in candidates:
                    line = solve_line(found["train"], algorithm, alpha)
                    val = found.get("val")
                    rmse = float(np.sqrt(val.squared_error(*line) / val.n)) if val else None
                    tried.append({"algorithm": algorithm, "alpha": alpha, "val_rmse": rmse})
                    if best is None or (rmse is not None and rmse < best["val_rmse"]):
                        best = tried[-1]
                both = found["train"] + found["val"] if "val" in found else found["train"]
                shift, coef = solve_line(both, best["algorithm"], best["alpha"])
                out = {k: r[k] for k in keys} | best | {"test_rmse": None, "test_r2": None, "candidates": tried}
                if "test" in found:
                    test = found["test"]
                    sse, sst = test.squared_error(shift, coef), test.spread()[1][-1, -1] * test.n
                    out["test_rmse"] = float(np.sqrt(sse / test.n))
                    out["test_r2"] = 1 - sse / sst if sst > 0 else None
                out["intercept"] = shift + float(centre_of[-1] - coef @ centre_of[:-1])
                out["coef"] = coef.tolist()
                rows.append(out)
            yield pd.DataFrame(rows, columns=schema.names)

    return per_series.mapInPandas(choose, schema)


def predict_linear(df: DataFrame, model: DataFrame, features: list[str], keys=(), into: str = "prediction") -> DataFrame:
    """Apply each series' model; a NULL feature gives a NULL prediction."""
    total = F.col("_m.intercept")
    for i, c in enumerate(features):
        total = total + F.col(c) * F.col("_m.coef")[i]
    return attach(df, model.select(*keys, "intercept", "coef"), keys, "_m").withColumn(into, total).drop("_m")


def save_table(model: DataFrame, path: str) -> None:
    """A14 for model and metrics tables."""
    model.write.mode("overwrite").parquet(path)


def load_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
