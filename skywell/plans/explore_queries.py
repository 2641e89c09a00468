"""Queries over the hourly channels and the line items: exploration, outliers, live windows."""

from pyspark.sql import DataFrame, functions as F

from skywell.operators import clean, explore, live, outliers
from skywell.plans import ctes, fixtures
from skywell.plans.fixtures import CHANNELS, hourly
from skywell.plans.registry import final, query, rounded
from skywell.schema import LIVE_WINDOWS, POLLUTANTS

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
VOLUME_DIGITS = 4  # sums over all line items keep fewer stable digits than hourly ones
QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def lineitem(spark, sf_dir) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet")


def line_rows(spark, sf_dir) -> DataFrame:
    return lineitem(spark, sf_dir).select("l_orderkey", "l_linenumber", F.col("l_shipdate").alias("ts"), *MEASURES)


def per_channel(cols, body: str, source="hourly", by="") -> str:
    """`body` for every channel, with {c} for its name."""
    head, tail = (f"{by}, ", f" GROUP BY {by}") if by else ("", "")
    return " UNION ALL ".join(
        f"SELECT {head}'{c}' AS channel, {body.format(c=c)} FROM {source}{tail}" for c in cols
    )


DESCRIBED = (
    "count({c}) AS \"count\", avg({c}) AS mean, quantile_cont({c}, 0.5) AS median, stddev_samp({c}) AS std, "
    "var_samp({c}) AS variance, min({c}) AS min, max({c}) AS max, quantile_cont({c}, 0.25) AS q1, "
    "quantile_cont({c}, 0.75) AS q3, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS iqr, "
    "skewness({c}) AS skewness, kurtosis({c}) AS kurtosis, max({c}) - min({c}) AS value_range, "
    "CASE WHEN avg({c}) <> 0 THEN stddev_samp({c}) / avg({c}) * 100 ELSE 0 END AS cv_percent"
)
DESCRIBED_DOUBLES = [
    "mean", "median", "std", "variance", "min", "max", "q1", "q3", "iqr", "skewness", "kurtosis", "value_range", "cv_percent",
]


@query(final(ctes.HOURLY, "hourly", ["ts"], CHANNELS))
def hourly_channels(spark, sf_dir):
    """The hourly table itself."""
    return rounded(hourly(spark, sf_dir))


def pattern_sql(part: str, expr: str) -> str:
    return final(
        f"{ctes.HOURLY}, p AS ({per_channel(CHANNELS, expr + ' AS part, avg({c}) AS mean, count({c}) AS n', by='').replace(' FROM hourly', ' FROM hourly GROUP BY ' + expr)})",
        "p", ["channel", "part", "n"], ["mean"],
    )


PARTS = {"hour": "hour(ts)", "weekday": "isodow(ts) - 1", "month": "month(ts)"}


def one_pattern(spark, sf_dir, part: str) -> DataFrame:
    rows = explore.temporal_patterns(hourly(spark, sf_dir), CHANNELS, "ts", (part,))
    return rounded(rows.select("channel", "part", "n", "mean"))


@query(pattern_sql("hour", PARTS["hour"]))
def hourly_pattern(spark, sf_dir):
    """H4."""
    return one_pattern(spark, sf_dir, "hour")


@query(pattern_sql("weekday", PARTS["weekday"]))
def weekday_pattern(spark, sf_dir):
    """H5."""
    return one_pattern(spark, sf_dir, "weekday")


@query(pattern_sql("month", PARTS["month"]))
def monthly_pattern(spark, sf_dir):
    """H6."""
    return one_pattern(spark, sf_dir, "month")


ALL_PARTS = " UNION ALL ".join(
    f"SELECT '{p}' AS pattern, {e} AS part, '{c}' AS channel, avg({c}) AS mean, count({c}) AS n FROM hourly GROUP BY {e}"
    for p, e in PARTS.items() for c in CHANNELS
)


@query(final(f"{ctes.HOURLY}, p AS ({ALL_PARTS})", "p", ["pattern", "part", "channel", "n"], ["mean"]))
def temporal_patterns(spark, sf_dir):
    """G5, H4-H6 at once."""
    return rounded(explore.temporal_patterns(hourly(spark, sf_dir), CHANNELS, "ts"))


WEEKDAY_NAMES = "CASE isodow(ts) " + " ".join(f"WHEN {i + 1} THEN '{d}'" for i, d in enumerate(explore.WEEKDAYS)) + " END"


@query(
    f"SELECT {WEEKDAY_NAMES} AS weekday, count(*) AS n, round(avg(value), 8) AS mean FROM events GROUP BY 1"
)
def weekday_labels(spark, sf_dir):
    """H5 with its labels, straight from the events."""
    rows = explore.temporal_patterns(fixtures.events(spark, sf_dir), ["value"], "ts", ("weekday",))
    return rounded(rows.select(explore.weekday_label(F.col("part")).alias("weekday"), "n", "mean"), 8)


@query(final(f"{ctes.HOURLY}, d AS ({per_channel(CHANNELS, DESCRIBED)})", "d", ["channel", '"count"'], DESCRIBED_DOUBLES))
def describe_columns(spark, sf_dir):
    """H1, H3."""
    return rounded(explore.describe_columns(hourly(spark, sf_dir), CHANNELS))


@query(
    final(f"d AS ({per_channel(MEASURES, DESCRIBED, 'lineitem', 'l_returnflag')})", "d", ["l_returnflag", "channel", '"count"'],
          DESCRIBED_DOUBLES, digits=VOLUME_DIGITS)
)
def describe_volume(spark, sf_dir):
    """H1 per group, over every line item."""
    rows = lineitem(spark, sf_dir).select("l_returnflag", *MEASURES)
    return rounded(explore.describe_columns(rows, MEASURES, ["l_returnflag"]), VOLUME_DIGITS)


def fences(cols, source="hourly") -> str:
    body = ", ".join(f"quantile_cont({{c}}, {p}) AS {n}" for n, p in QUARTILES.items())
    return f"q AS ({per_channel(cols, 'count({c}) AS n, ' + body, source)})"


IN_FENCE = "value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)"


def box_sql(prefix, cols, source="hourly", keep="ts", digits=10) -> str:
    return final(
        f"{prefix}{fences(cols, source)}, v AS ({ctes.long(cols, source, keep)}), b AS (SELECT channel, any_value(n) AS \"count\", "
        "any_value(q1) AS q1, any_value(median) AS median, any_value(q3) AS q3, "
        f"min(value) FILTER ({IN_FENCE}) AS whisker_low, max(value) FILTER ({IN_FENCE}) AS whisker_high, "
        f"count(*) FILTER (NOT ({IN_FENCE})) AS outliers FROM v JOIN q USING (channel) GROUP BY channel)",
        "b", ["channel", '"count"', "outliers"], ["q1", "median", "q3", "whisker_low", "whisker_high"], digits=digits,
    )


@query(box_sql(ctes.HOURLY + ", ", CHANNELS))
def box_stats(spark, sf_dir):
    """H2."""
    return rounded(explore.box_stats(hourly(spark, sf_dir), CHANNELS))


@query(box_sql("", MEASURES, "lineitem", "l_orderkey", VOLUME_DIGITS))
def box_volume(spark, sf_dir):
    """H2 over every line item."""
    return rounded(explore.box_stats(lineitem(spark, sf_dir).select(*MEASURES), MEASURES), VOLUME_DIGITS)


@query(
    final(
        f"{fences(['value'], 'events')}, v AS ({ctes.long(['value'], 'events', 'event_id')}), "
        f"o AS (SELECT event_id, channel, value FROM v JOIN q USING (channel) WHERE NOT ({IN_FENCE}))",
        "o", ["event_id", "channel"], ["value"],
    )
)
def box_outliers(spark, sf_dir):
    """H2: the points beyond the whiskers, over every event."""
    return rounded(explore.box_outliers(fixtures.events(spark, sf_dir), ["value"], ids=["event_id"]))


def pairs(cols):
    return [(x, y) for i, x in enumerate(cols) for y in cols[i + 1:]]


def corr_sql(prefix: str, cols, source: str, by: str = "", digits=10) -> str:
    head, tail = (f"{by}, ", f" GROUP BY {by}") if by else ("", "")
    whole = " AND ".join(f"{c} IS NOT NULL" for c in cols)
    body = " UNION ALL ".join(
        f"SELECT {head}'{x}' AS x, '{y}' AS y, count(*) AS n, corr({x}, {y}) AS corr FROM {source} WHERE {whole}{tail}"
        for x, y in pairs(cols)
    )
    return final(f"{prefix}r AS ({body})", "r", [*([by] if by else []), "x", "y", "n"], ["corr"], "WHERE n > 1", digits)


@query(corr_sql(ctes.HOURLY + ", ", POLLUTANTS, "hourly"))
def correlation_matrix(spark, sf_dir):
    """H7."""
    return rounded(explore.correlation_matrix(hourly(spark, sf_dir), POLLUTANTS))


@query(corr_sql("", MEASURES, "lineitem", "l_linestatus", 8))
def correlation_volume(spark, sf_dir):
    """H7 per group, over every line item."""
    rows = lineitem(spark, sf_dir).select("l_linestatus", *MEASURES)
    return rounded(explore.correlation_matrix(rows, MEASURES, ["l_linestatus"]), 8)


@query()
def correlation_pvalues(spark, sf_dir):
    """H8, H9: the matrix with exact p-values and their q-values."""
    tested = explore.with_pvalues(explore.correlation_matrix(hourly(spark, sf_dir), POLLUTANTS))
    return rounded(explore.fdr_bh(tested, order=["x", "y"]))


FDR = """t AS (SELECT *, 2 / (1 + exp(1.702 * abs(atanh(corr) * sqrt(n - 3)))) AS p FROM r WHERE n > 3),
    k AS (SELECT *, row_number() OVER (PARTITION BY station ORDER BY p, x, y) AS rank, count(*) OVER (PARTITION BY station) AS m FROM t),
    f AS (SELECT station, x, y, p, least(1.0, min(p * m / rank) OVER (PARTITION BY station ORDER BY rank DESC
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS q FROM k)"""


@query(
    corr_sql(ctes.STATION_HOURLY + ", ", POLLUTANTS, "hourly", "station").split(" SELECT station, x, y, n, round(corr")[0]
    + f", {FDR} SELECT station, x, y, round(p, 9) AS p, round(q, 9) AS q FROM f"
)
def fdr_bh(spark, sf_dir):
    """H9 with one family per station; p from a logistic approximation that SQL can state."""
    corr = explore.correlation_matrix(hourly(spark, sf_dir, station=True), POLLUTANTS, ["station"]).filter("n > 3")
    z = F.abs(F.atanh("corr") * F.sqrt(F.col("n") - 3))
    tested = corr.withColumn("p", F.lit(2.0) / (F.exp(z * 1.702) + 1))
    return rounded(explore.fdr_bh(tested, family=["station"], order=["x", "y"]).select("station", "x", "y", "p", "q"), 9)


def z_sql(prefix, cols, source, keep, spread="stddev_pop", threshold=3, digits=10, ids=()) -> str:
    stats = per_channel(cols, f"count({{c}}) AS n, avg({{c}}) AS m, {spread}({{c}}) AS s", source)
    return final(
        f"{prefix}v AS ({ctes.long(cols, source, keep)}), s AS ({stats}), "
        f"z AS (SELECT v.*, abs(value - m) / s AS score FROM v JOIN s USING (channel) WHERE n >= 10 AND s > 0)",
        "z", [*ids, "ts", "channel", "'z_score' AS method"], ["value", "score"], f"WHERE score > {threshold}", digits,
    )


@query(z_sql(ctes.HOURLY + ", ", POLLUTANTS, "hourly", "ts"))
def zscore_outliers(spark, sf_dir):
    """H10."""
    return rounded(outliers.zscore_outliers(hourly(spark, sf_dir), POLLUTANTS, "ts"))


LINE_IDS = ["l_orderkey", "l_linenumber"]


@query(
    z_sql("", ["l_extendedprice"], "lineitem", "l_orderkey, l_linenumber, l_shipdate AS ts", threshold=2.5, digits=8, ids=LINE_IDS)
)
def zscore_volume(spark, sf_dir):
    """H10 over every line item: one aggregate row and a filter, without a shuffle of the rows."""
    return rounded(outliers.zscore_outliers(line_rows(spark, sf_dir), ["l_extendedprice"], "ts", 2.5, ids=LINE_IDS), 8)


@query(z_sql("", ["value"], "events", "event_id, ts", ids=["event_id"]))
def zscore_events(spark, sf_dir):
    """H10 over every event: values that are really beyond three deviations."""
    rows = fixtures.events(spark, sf_dir).select("event_id", "ts", "value")
    return rounded(outliers.zscore_outliers(rows, ["value"], "ts", ids=["event_id"]))


def iqr_sql(prefix, cols, source, keep, ids=(), digits=10) -> str:
    return final(
        f"{prefix}{fences(cols, source)}, v AS ({ctes.long(cols, source, keep)}), o AS (SELECT v.*, "
        "CASE WHEN q3 > q1 THEN (value - q1) / (q3 - q1) ELSE 0 END AS score FROM v JOIN q USING (channel) "
        f"WHERE n >= 10 AND NOT ({IN_FENCE}))",
        "o", [*ids, "ts", "channel", "'iqr' AS method"], ["value", "score"], digits=digits,
    )


@query(iqr_sql(ctes.HOURLY + ", ", POLLUTANTS, "hourly", "ts"))
def iqr_outliers(spark, sf_dir):
    """H11."""
    return rounded(outliers.iqr_outliers(hourly(spark, sf_dir), POLLUTANTS, "ts"))


@query(iqr_sql("", ["value"], "events", "event_id, ts", ["event_id"]))
def iqr_volume(spark, sf_dir):
    """H11 over every event."""
    return rounded(outliers.iqr_outliers(fixtures.events(spark, sf_dir), ["value"], "ts", ids=["event_id"]))


@query(z_sql(ctes.HOURLY + ", ", CHANNELS, "hourly", "ts", threshold=2))
def detect_outliers(spark, sf_dir):
    """H16 by name."""
    return rounded(outliers.detect_outliers(hourly(spark, sf_dir), "z_score", CHANNELS, "ts", threshold=2.0))


@query()
def isolation_forest(spark, sf_dir):
    """H12 on the hourly pollutants."""
    found = outliers.detect_outliers(
        hourly(spark, sf_dir), "isolation_forest", POLLUTANTS, "ts", multivariate=True, row_id="ts"
    )
    return rounded(found)


@query()
def isolation_forest_volume(spark, sf_dir):
    """H12 on every line item."""
    rows = line_rows(spark, sf_dir).withColumn("row_id", F.xxhash64(*LINE_IDS, "ts"))
    return rounded(outliers.forest_outliers(rows, MEASURES, "ts", "row_id", 0.01, ids=LINE_IDS))


@query(
    final(
        f"{ctes.HOURLY}, v AS ({ctes.long(POLLUTANTS)}), s AS ({per_channel(POLLUTANTS, 'count({c}) AS n, avg({c}) AS m, stddev_pop({c}) AS s')}), "
        "o AS (SELECT ts, channel, value, abs(value - m) / s AS z FROM v JOIN s USING (channel))",
        "o", ["ts", "channel", "z > 3 AS is_outlier"], ["value", "CASE WHEN z > 3 THEN z END AS score"],
    )
)
def overlay_outliers(spark, sf_dir):
    """H14."""
    rows = hourly(spark, sf_dir)
    found = outliers.zscore_outliers(rows, POLLUTANTS, "ts")
    return rounded(outliers.overlay_outliers(rows, found, POLLUTANTS, "ts"))


PROFILE = (
    "count({c}) AS \"count\", min({c}) AS min, max({c}) AS max, avg({c}) AS mean, stddev_samp({c}) AS std, "
    "greatest(max({c}) - avg({c}), avg({c}) - min({c})) / stddev_samp({c}) AS max_z, "
    "quantile_cont({c}, 0.25) - 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS iqr_low, "
    "quantile_cont({c}, 0.75) + 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS iqr_high"
)


@query(
    final(f"{ctes.HOURLY}, d AS ({per_channel(CHANNELS, PROFILE)})", "d", ["channel", '"count"'],
          ["min", "max", "mean", "std", "max_z", "iqr_low", "iqr_high"])
)
def outlier_profile(spark, sf_dir):
    """H15."""
    return rounded(explore.outlier_profile(hourly(spark, sf_dir), CHANNELS))


@query(
    final(ctes.HOURLY, "hourly", ["ts"],
          [f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS {c}" for c in POLLUTANTS], digits=9)
)
def standardize(spark, sf_dir):
    """H13."""
    return rounded(explore.standardize(hourly(spark, sf_dir).select("ts", *POLLUTANTS), POLLUTANTS), 9)


def last_sql(span: str, cols) -> str:
    return final(ctes.HOURLY, "hourly", ["ts"], cols, f"WHERE ts >= (SELECT max(ts) FROM hourly) - INTERVAL {span}")


@query(last_sql("7 DAYS", CHANNELS))
def filter_last_7d(spark, sf_dir):
    """B10."""
    return rounded(clean.filter_last(hourly(spark, sf_dir), "ts", "7 DAYS"))


@query(last_sql("48 HOURS", ["nox_gt"]))
def recent_48h(spark, sf_dir):
    """B12."""
    return rounded(clean.filter_last(hourly(spark, sf_dir), "ts", "48 HOURS").select("ts", "nox_gt"))


@query("SELECT event_id, ts, value FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAYS")
def view_last_7_days(spark, sf_dir):
    """B10 by the name of a view."""
    return clean.filter_view(fixtures.events(spark, sf_dir).select("event_id", "ts", "value"), "ts", "Last 7 days")


@query("SELECT event_id, ts, value FROM events WHERE ts IS NOT NULL")
def view_all_data(spark, sf_dir):
    """B10 without a bound."""
    return clean.filter_view(fixtures.events(spark, sf_dir).select("event_id", "ts", "value"), "ts", "All data")


@query("SELECT event_id, ts, value FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 1 DAY")
def filter_last_raw(spark, sf_dir):
    """B10 on the raw table: the bound reaches the scan."""
    return clean.filter_last(fixtures.events(spark, sf_dir), "ts", "1 DAY").select("event_id", "ts", "value")


LONG_ALL = " UNION ALL ".join(f"SELECT ts, '{c}' AS channel, {c} AS value FROM hourly" for c in POLLUTANTS)


@query(final(f"{ctes.HOURLY}, v AS ({LONG_ALL})", "v", ["ts", "channel"], ["value"]))
def long_series(spark, sf_dir):
    """B14."""
    return rounded(clean.long_series(hourly(spark, sf_dir), POLLUTANTS, "ts"))


@query(final(ctes.HOURLY, "hourly", ["ts"], ["co_gt", "NULL::DOUBLE AS pm10", "temperature"]))
def align_columns(spark, sf_dir):
    """An absent channel arrives as NULL."""
    rows = hourly(spark, sf_dir)
    return rounded(clean.align_columns(rows, ["ts", "co_gt", "pm10", "temperature"]))


def windows_cte(by: str = "") -> str:
    part = f"PARTITION BY {by} " if by else ""
    first = ctes.STATION_HOURLY if by else ctes.HOURLY
    sizes = " UNION ALL ".join(f"SELECT *, '{w}' AS \"window\" FROM aged WHERE age <= {n}" for w, n in LIVE_WINDOWS.items())
    return f"{first}, aged AS (SELECT *, row_number() OVER ({part}ORDER BY ts DESC) AS age FROM hourly), w AS ({sizes})"


def live_windows(spark, sf_dir, keys=()) -> DataFrame:
    return live.last_n_windows(hourly(spark, sf_dir, station=bool(keys)), "ts", "ts", keys)


@query(final(windows_cte(), "w", ["ts", "age", '"window"'], POLLUTANTS))
def last_n_windows(spark, sf_dir):
    """G1."""
    return rounded(live_windows(spark, sf_dir).select("ts", "age", "window", *POLLUTANTS))


@query(final(windows_cte("station"), "w", ["station", "ts", "age", '"window"'], POLLUTANTS))
def last_n_by_station(spark, sf_dir):
    """G1 per station."""
    return rounded(live_windows(spark, sf_dir, ["station"]).select("station", "ts", "age", "window", *POLLUTANTS))


WINDOW_STATS = "avg({c}) AS mean, stddev_samp({c}) AS std, min({c}) AS min, max({c}) AS max, count({c}) AS \"count\""


@query(
    final(
        windows_cte("station") + ", s AS (" + per_channel(POLLUTANTS, WINDOW_STATS, "w", 'station, "window"') + ")",
        "s", ["station", '"window"', "channel", '"count"'], ["mean", "std", "min", "max"], 'WHERE "count" > 0',
    )
)
def window_stats(spark, sf_dir):
    """G2 per station."""
    return rounded(live.window_stats(live_windows(spark, sf_dir, ["station"]), POLLUTANTS, ["station"]))


@query(corr_sql(windows_cte() + ", ", POLLUTANTS, "w", '"window"'))
def window_correlations(spark, sf_dir):
    """G3."""
    return rounded(live.window_correlations(live_windows(spark, sf_dir)))


@query(
    z_sql(windows_cte() + ", h AS (SELECT * FROM w WHERE \"window\" = 'hourly'), ", POLLUTANTS, "h", "ts", "stddev_samp", 2)
)
def zscore_anomalies(spark, sf_dir):
    """G4 with a threshold of 2."""
    return rounded(live.zscore_anomalies(live_windows(spark, sf_dir), "ts", 2.0))


SHORTEST_OUTLIERS = z_sql(windows_cte() + ", h AS (SELECT * FROM w WHERE \"window\" = 'hourly'), ", POLLUTANTS, "h", "ts", "stddev_samp", 3)

LIVE_PARTS = " UNION ALL ".join(
    f"SELECT '{p}' AS pattern, {PARTS[p]} AS part, '{c}' AS channel, avg({c}) AS mean, count({c}) AS n FROM d GROUP BY {PARTS[p]}"
    for p in ("hour", "weekday") for c in POLLUTANTS
)


LIVE_PATTERNS = final(
    f"{windows_cte()}, d AS (SELECT * FROM w WHERE \"window\" = 'daily'), p AS ({LIVE_PARTS})", "p",
    ["pattern", "part", "channel", "n"], ["mean"],
)


@query(LIVE_PATTERNS)
def live_patterns(spark, sf_dir):
    """G5 on the 168-row window."""
    return rounded(live.live_patterns(live_windows(spark, sf_dir), "ts"))


FILL = ", ".join(f"(SELECT count(*) FROM w WHERE \"window\" = '{w}') AS {w}" for w in LIVE_WINDOWS)


@query(
    z_sql(windows_cte() + ", h AS (SELECT * FROM w WHERE \"window\" = 'hourly'), ", POLLUTANTS, "h", "ts", "stddev_samp", 2)
    .split(" SELECT ts, channel, 'z_score'")[0]
    + f" SELECT count(*) AS total_records, max(ts) AS last_update, {FILL}, (SELECT count(*) FROM z WHERE score > 2) AS recent_anomalies FROM hourly"
)
def live_summary(spark, sf_dir):
    """G7."""
    windows = live_windows(spark, sf_dir)
    found = live.zscore_anomalies(windows, "ts", 2.0)
    return rounded(live.live_summary(hourly(spark, sf_dir), windows, found, "ts"))
