"""Baselines, error metrics, significance and run selection."""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from skywell.functions.attach import attach
from skywell.functions.scalars import epoch_seconds
from skywell.functions.tdist import t_pvalue
from skywell.operators.ordered import HOUR
from skywell.schema import HORIZON


def constant_baseline(split_rows: DataFrame, ts: str, target: str, keys=(), back: int = HORIZON, step: int = HOUR) -> DataFrame:
    """The value `back` steps before the end of a dense split (0: the last known value)."""
    keys = list(keys)
    if back == 0:
        known = F.when(F.col(target).isNotNull(), F.col(ts))
        return split_rows.groupBy(*keys).agg(F.max_by(target, known).alias("baseline"))
    ends = split_rows.groupBy(*keys).agg(F.max(ts).alias("t1"))
    at = epoch_seconds("_e.t1") - back * step
    return (
        attach(split_rows, ends, keys, "_e").filter(epoch_seconds(ts) == at).groupBy(*keys)
        .agg(F.max(target).alias("baseline"))
    )


def _errors(y: Column, pred: Column) -> dict[str, Column]:
    e = y - pred
    scale = F.abs(y) + F.abs(pred)
    # Fixed value: stand-in for a zero denominator.
    return {
        "mae": F.avg(F.abs(e)),
        "rmse": F.sqrt(F.avg(e * e)),
        "smape": F.avg(F.abs(e) / F.when(scale == 0, F.lit(1e-12)).otherwise(scale)) * 200,
        "sse": F.sum(e * e),
    }


def forecast_metrics(df: DataFrame, y: str, pred: str, by=()) -> DataFrame:
    """MAE, RMSE, sMAPE and R2 in one aggregation."""
    known = df.filter(F.col(y).isNotNull() & F.col(pred).isNotNull())
    return (
        known.groupBy(*by)
        .agg(
            F.count("*").alias("n"),
            *[c.alias(n) for n, c in _errors(F.col(y), F.col(pred)).items()],
            (F.var_pop(y) * F.count(y)).alias("sst"),
        )
        .withColumn("r2", F.when(F.col("sst") > 0, 1 - F.col("sse") / F.col("sst")))
        .drop("sse", "sst")
    )


def paired_difference(df: DataFrame, y: str, model: str, baseline: str, by=()) -> DataFrame:
    """The t statistic of I16: baseline error minus model error, pair by pair."""
    d = F.abs(F.col(y) - F.col(baseline)) - F.abs(F.col(y) - F.col(model))
    return (
        df.withColumn("_d", d)
        .groupBy(*by)
        .agg(F.count("_d").alias("n_samples"), F.avg("_d").alias("_m"), F.stddev_samp("_d").alias("_s"))
        .withColumn("t_statistic", F.when(F.col("n_samples") >= 2, F.try_divide("_m", F.col("_s") / F.sqrt("n_samples"))))
        .drop("_m", "_s")
    )


def paired_ttest(df: DataFrame, y: str, model: str, baseline: str, by=()) -> DataFrame:
    """I16: paired t-test, significant when p < 0.05."""
    return (
        paired_difference(df, y, model, baseline, by)
        .withColumn("p_value", t_pvalue(F.col("t_statistic"), F.col("n_samples") - 1))
        .withColumn("significant", F.coalesce(F.col("p_value") < 0.05, F.lit(False)))
    )


def model_metrics(df: DataFrame, y: str, model: str, baseline: str, by=()) -> DataFrame:
    """The metrics document of a model: I15 of it and of its baseline, I16 between them, I23."""
    by = list(by)
    errors = forecast_metrics(df, y, model, by)
    base = forecast_metrics(df, y, baseline, by).select(*by, F.col("mae").alias("mae_baseline"), F.col("rmse").alias("rmse_baseline"))
    test = paired_ttest(df, y, model, baseline, by).drop("n_samples")
    return improvement(errors.join(base, by).join(test, by))


def best_run(runs: DataFrame) -> DataFrame:
    """The finished run with the smallest positive test RMSE; ties by run id."""
    usable = runs.filter((F.col("status") == "FINISHED") & (F.col("metrics")["test_rmse"] > 0))
    return usable.orderBy(F.col("metrics")["test_rmse"], "run_id").limit(1)


def run_record(run_id: Column, algorithm: Column, metrics: dict[str, Column], status="FINISHED") -> list[Column]:
    """The columns of a runs table row."""
    pairs = reduce(lambda a, kv: a + [F.lit(kv[0]), kv[1]], metrics.items(), [])
    return [
        run_id.alias("run_id"), F.lit(status).alias("status"),
        F.create_map(F.lit("algorithm"), algorithm).alias("params"), F.create_map(*pairs).alias("metrics"),
    ]


def merge_forecasts(forecasts: list[DataFrame], ts: str, keys=()) -> DataFrame:
    """Full outer merge of forecast tables on their time."""
    return reduce(lambda a, b: a.join(b, [*keys, ts], "full"), forecasts)


def improvement(metrics: DataFrame) -> DataFrame:
    """What the model gains on its baseline."""
    return metrics.withColumns(
        {
            "mae_gain": F.col("mae_baseline") - F.col("mae"),
            "rmse_gain": F.col("rmse_baseline") - F.col("rmse"),
        }
    )
