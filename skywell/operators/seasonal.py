"""Seasonal ARMA models by two-stage regression, for many series at once.

A long autoregression on the seasonally differenced series estimates its shocks; each candidate
order is then an ordinary regression on lags of the series and of the shocks. Both stages are
sums over lag columns, computed in time buckets with a halo. Only per-series sums, 80-row tails
and coefficients are handled in Python.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F, types as T

from skywell.functions.attach import attach, null_safe_join
from skywell.operators.features import chronological_split, series_bounds
from skywell.operators.ordered import DAY, HOUR, halo
from skywell.schema import SEASONAL_CANDIDATES
from skywell.session import settle

SEASON = 24
LONG_LAGS = [1, 2, 3, 4, 5, 6, 24, 25, 26, 48, 49, 72]
MODEL_LAGS = [1, 2, 24, 25, 26]
TAIL = 80  # rows of history a forecast starts from
REACH = SEASON + 1 + max(LONG_LAGS) + max(MODEL_LAGS)
PATH_CHUNK = 10_000
Z95 = 1.959963984540054  # fixed value: 97.5 % point of the normal distribution


def _products(names):
    return F.array(*[F.sum(F.col(a) * F.col(b)) for i, a in enumerate(names) for b in names[i:]])


def _square(flat, k):
    full = np.zeros((k, k))
    full[np.triu_indices(k)] = flat
    return full + np.triu(full, 1).T


def _columns(d):
    return [f"z{d}_{k}" for k in MODEL_LAGS] + [f"e{d}_{k}" for k in MODEL_LAGS] + [f"z{d}"]


def candidate_lags(order, seasonal):
    """Lags of the series and of the shocks that an order's expanded polynomials reach."""
    p, _, q = order
    big_p, _, big_q, s = seasonal
    lags = lambda n, big: [k + s * j for j in range(big + 1) for k in range(n + 1) if k + s * j]
    return lags(p, big_p), lags(q, big_q)


def seasonal_rows(df: DataFrame, ts: str, target: str, keys, width: int = 30 * DAY) -> DataFrame:
    """The dense series with both differencings, their shocks and all lag columns."""
    keys = list(keys)
    w = W.partitionBy(*keys, "_bucket").orderBy(ts)
    lag = lambda c, k: F.lag(c, k).over(w)
    rows = halo(df.select(*keys, ts, F.col(target).alias("y")), ts, REACH * HOUR, 0, width)
    rows = rows.withColumn("z0", F.col("y") - lag("y", SEASON)).withColumn("z1", F.col("z0") - lag("z0", 1))
    rows = rows.withColumns({f"z{d}_{k}": lag(f"z{d}", k) for d in (0, 1) for k in LONG_LAGS})

    longs = {d: [f"z{d}_{k}" for k in LONG_LAGS] + [f"z{d}"] for d in (0, 1)}
    parts = chronological_split(rows.filter("_core"), ts, keys, series_bounds(df, ts, keys))
    sums = (
        parts.filter("split = 'train'").dropna(subset=[*longs[0], *longs[1]]).groupBy(*keys)
        .agg(*[_products(longs[d]).alias(f"s{d}") for d in (0, 1)])
    )
    schema = T.StructType(
        [df.schema[k] for k in keys] + [T.StructField(f"a{d}", T.ArrayType(T.DoubleType())) for d in (0, 1)]
    )

    def long_fit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = frame[keys].copy()
            for d in (0, 1):
                grams = [None if g is None else _square(g, len(LONG_LAGS) + 1) for g in frame[f"s{d}"]]
                out[f"a{d}"] = [
                    None if g is None or not np.isfinite(g).all()
                    else np.linalg.lstsq(g[:-1, :-1], g[:-1, -1], rcond=None)[0].tolist()
                    for g in grams
                ]
            yield out

    rows = attach(rows, sums.mapInPandas(long_fit, schema), keys, "_a")
    for d in (0, 1):
        fitted = sum((F.col(f"_a.a{d}")[i] * F.col(f"z{d}_{k}") for i, k in enumerate(LONG_LAGS)), F.lit(0.0))
        rows = rows.withColumn(f"e{d}", F.col(f"z{d}") - fitted)
    rows = rows.withColumns({f"e{d}_{k}": lag(f"e{d}", k) for d in (0, 1) for k in MODEL_LAGS})
    kept = dict.fromkeys([*keys, ts, "y", "e0", "e1", *_columns(0), *_columns(1)])
    return rows.filter("_core").select(*kept)


def forecast_path(ys, shocks, model, steps, impulse=False):
    """Yield the next values of a series from its recent `ys` and `shocks` (latest last)."""
    d = model["d"]
    ys, es = list(ys[-TAIL:]), list(shocks[-TAIL:])
    first = [a - b for a, b in zip(ys[SEASON:], ys[:-SEASON])]
    zs = [b - a for a, b in zip(first[:-1], first[1:])] if d else first
    es = [0.0 if e is None or e != e else e for e in es]
    for step in range(steps):
        shock = 1.0 if impulse and step == 0 else 0.0
        z = shock + sum(c * zs[-k] for k, c in zip(model["ar_lags"], model["ar"]))
        z += sum(c * es[-k] for k, c in zip(model["ma_lags"], model["ma"]))
        y = z + ys[-SEASON] + (ys[-1] - ys[-SEASON - 1] if d else 0.0)
        for series, value in ((zs, z), (es, shock), (ys, y)):
            series.append(value)
            del series[: max(0, len(series) - 2 * TAIL)]
        yield y


MODEL_FIELDS = (
    "candidate int, part string, orders string, d int, ar_lags array<int>, ar array<double>, "
    "ma_lags array<int>, ma array<double>, sigma double, n bigint"
)


def _fit_candidates(rows: DataFrame, keys, candidates) -> DataFrame:
    """Every candidate fitted on train and on train + val, from one aggregation."""
    used = rows.filter("split <> 'test'").dropna(subset=[*_columns(0), *_columns(1)])
    sums = used.groupBy(*keys, "split").agg(
        F.count("*").alias("n"), *[_products(_columns(d)).alias(f"s{d}") for d in (0, 1)]
    )
    packed = sums.groupBy(*keys).agg(F.collect_list(F.struct("split", "n", "s0", "s1")).alias("parts"))
    schema = T.StructType([rows.schema[k] for k in keys] + list(T.StructType.fromDDL(MODEL_FIELDS)))
    width = 2 * len(MODEL_LAGS) + 1

    def fit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for r in frame.to_dict("records"):
                for part, names in (("train", {"train"}), ("all", {"train", "val"})):
                    have = [p for p in r["parts"] if p["split"] in names]
                    if not have:
                        continue
                    n = sum(p["n"] for p in have)
                    grams = [sum(_square(p[f"s{d}"], width) for p in have) for d in (0, 1)]
                    for i, (order, seasonal) in enumerate(candidates):
                        d, (ar, ma) = order[1], candidate_lags(order, seasonal)
                        at = [MODEL_LAGS.index(k) for k in ar] + [len(MODEL_LAGS) + MODEL_LAGS.index(k) for k in ma]
                        g = grams[d]
                        xx, xy = g[np.ix_(at, at)], g[at, -1]
                        beta = np.linalg.lstsq(xx, xy, rcond=None)[0]
                        sse = max(float(g[-1, -1] - 2 * beta @ xy + beta @ xx @ beta), 0.0)
                        out.append(
                            {k: r[k] for k in keys}
                            | {
                                "candidate": i, "part": part, "orders": f"{order}x{seasonal}", "d": d,
                                "ar_lags": ar, "ar": beta[: len(ar)].tolist(), "ma_lags": ma,
                                "ma": beta[len(ar):].tolist(),
                                "sigma": (sse / max(n - len(at), 1)) ** 0.5, "n": n,
                            }
                        )
            yield pd.DataFrame(out, columns=schema.names)

    return packed.mapInPandas(fit, schema)


def tails(rows: DataFrame, ts: str, keys) -> DataFrame:
    """The last TAIL rows of each dense series as arrays, with its end time: bounded per series."""
    keys = list(keys)
    ends = rows.groupBy(*keys).agg(F.max(ts).alias("t1"))
    recent = attach(rows, ends, keys, "_e").filter(F.col(ts) > F.col("_e.t1") - F.expr(f"INTERVAL {TAIL} HOURS"))
    return recent.groupBy(*keys).agg(
        F.max(ts).alias("model_end"),
        F.array_sort(F.collect_list(F.struct(F.col(ts).alias("t"), "y", "e0", "e1"))).alias("tail"),
    )


def forecast(models: DataFrame, ends: DataFrame, keys, ts: str, extra=(), interval: bool = True) -> DataFrame:
    """Path and 95 % interval, stamped from the model's own end; NULLs where a series is too short.

    `models` has a `steps` column; `extra` columns are carried through. Paths leave in chunks.
    """
    keys, extra = list(keys), list(extra)
    held = attach(models, ends, keys, "_t").select(
        *keys, *extra, "steps", "d", "ar_lags", "ar", "ma_lags", "ma", "sigma",
        F.col("_t.model_end").alias("model_end"), F.col("_t.tail.y").alias("ys"),
        F.when(F.col("d") == 0, F.col("_t.tail.e0")).otherwise(F.col("_t.tail.e1")).alias("shocks"),
    )
    stamp = T.StructType([T.StructField(ts, T.TimestampNTZType())])
    schema = T.StructType(
        [held.schema[c] for c in [*keys, *extra]] + list(stamp) + list(T.StructType.fromDDL("mean double, lo double, hi double"))
    )

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for r in frame.to_dict("records"):
                if len(r["ys"]) <= SEASON + 1 + max(MODEL_LAGS):  # too short to start from: its hours come without values
                    rows = [[r[c] for c in [*keys, *extra]] + [r["model_end"] + pd.Timedelta(hours=h), None, None, None] for h in range(1, int(r["steps"]) + 1)]
                    if rows:
                        yield pd.DataFrame(rows, columns=schema.names).astype({c: "float64" for c in ("mean", "lo", "hi")})
                    continue
                path = forecast_path(r["ys"], r["shocks"], r, r["steps"])
                echo = forecast_path([0.0] * TAIL, [0.0] * TAIL, r, r["steps"], impulse=True)
                variance, chunk = 0.0, []
                for h, (y, psi) in enumerate(zip(path, echo), 1):
                    variance += psi * psi
                    band = Z95 * r["sigma"] * variance**0.5 if interval else None
                    row = [r[c] for c in [*keys, *extra]]
                    row += [r["model_end"] + pd.Timedelta(hours=h), y]
                    row += [y - band, y + band] if interval else [None, None]
                    chunk.append(row)
                    if len(chunk) == PATH_CHUNK:
                        yield pd.DataFrame(chunk, columns=schema.names)
                        chunk = []
                if chunk:
                    yield pd.DataFrame(chunk, columns=schema.names)

    return held.mapInPandas(run, schema)


def fit_seasonal_ar(
    df: DataFrame, ts: str, target: str = "nox_gt", keys=(), candidates=tuple(SEASONAL_CANDIDATES)
) -> tuple[DataFrame, DataFrame]:
    """The chosen model of each series and the tails its forecasts start from.

    Every candidate forecasts the whole validation part from the end of train; the lowest RMSE
    wins, the first on a tie, and its train + val fit is returned with `val_rmse`. The lag table
    is written once, since fitting, trial and tails all read it.
    """
    keys = list(keys)
    rows = settle(
        chronological_split(seasonal_rows(df, ts, target, keys), ts, keys, series_bounds(df, ts, keys))
    )
    fitted = _fit_candidates(rows, keys, candidates)
    sizes = rows.filter("split = 'val'").groupBy(*keys).agg(F.count("*").cast("int").alias("steps"))
    trial = attach(fitted.filter("part = 'train'"), sizes, keys, "_s").withColumn("steps", F.col("_s.steps")).drop("_s")
    paths = forecast(trial.filter("steps > 0"), tails(rows.filter("split = 'train'"), ts, keys), keys, ts, ["candidate"], False)
    actual = rows.filter("split = 'val'").select(*keys, ts, "y")
    scores = (
        null_safe_join(paths, actual, [*keys, ts], "inner").groupBy(*keys, "candidate")
        .agg(F.sqrt(F.avg((F.col("y") - F.col("mean")) ** 2)).alias("val_rmse"))
        .filter(F.col("val_rmse") < float("inf"))
    )
    best = scores.groupBy(*keys).agg(F.min(F.struct("val_rmse", "candidate")).alias("best"))
    chosen = attach(fitted.filter("part = 'all'"), best.select(*keys, "best.*"), keys, "_b")
    models = chosen.filter(F.col("candidate") == F.col("_b.candidate")).withColumn("val_rmse", F.col("_b.val_rmse")).drop("_b", "part")
    return models, tails(rows.filter("split <> 'test'"), ts, keys)
