"""Queries on dependence, drift, correlation breaks and alert episodes."""

from pyspark.sql import functions as F

from skywell.operators import dependence, drift
from skywell.plans import ctes, fixtures
from skywell.plans.forecast_queries import STATION, by_station
from skywell.plans.registry import final, query, rounded
from skywell.schema import ALERT_LEVELS, LEVEL_NAMES

LAGS_SHOWN = 30
WIDTH = 5 * 86_400  # small buckets, so that even this month of data crosses their edges
_LEVELLED = " UNION ALL ".join(f"SELECT station, ts, '{c}' AS channel, {c} AS v FROM hourly WHERE {c} IS NOT NULL" for c in ("nox_gt", "co_gt"))
_CENTRED = (
    f"{ctes.STATION_HOURLY}, v AS ({_LEVELLED}), c AS (SELECT station, channel, ts, v - avg(v) OVER (PARTITION BY station, channel) AS d FROM v), "
    "t AS (SELECT station, channel, sum(d * d) AS s0, count(*) AS n FROM c GROUP BY ALL), "
    f"k AS (SELECT unnest(range(0, {LAGS_SHOWN} + 1)) AS lag), "
    "p AS (SELECT a.station, a.channel, k.lag, sum(a.d * b.d) AS s FROM c a CROSS JOIN k JOIN c b ON a.station = b.station "
    "AND a.channel = b.channel AND b.ts = a.ts - to_hours(k.lag::INT) GROUP BY ALL)"
)


@query(
    f"WITH {_CENTRED} SELECT t.station, t.channel, k.lag, round(coalesce(s, 0) / s0, 10) AS acf, n, "
    "abs(coalesce(s, 0) / s0) * sqrt(n) > 1.96 AS significant FROM t CROSS JOIN k "
    "LEFT JOIN p ON p.station = t.station AND p.channel = t.channel AND p.lag = k.lag"
)
def autocorrelation(spark, sf_dir):
    """Autocorrelation of every station's hourly series; pairs of known hours only."""
    return rounded(dependence.autocorrelation(by_station(spark, sf_dir), ["nox_gt", "co_gt"], STATION, "ts", LAGS_SHOWN, width=WIDTH))


@query()
def partial_autocorrelation(spark, sf_dir):
    """The partial coefficients of the same lags."""
    return rounded(dependence.partial_autocorrelation(by_station(spark, sf_dir), ["nox_gt", "co_gt"], STATION, "ts", LAGS_SHOWN, width=WIDTH))


@query()
def bootstrap_mean(spark, sf_dir):
    """The mean NOx of every station with its 95 % interval from days drawn whole."""
    return rounded(dependence.bootstrap_mean(by_station(spark, sf_dir), "nox_gt", STATION, "ts"))


_PARTS = (
    f"{ctes.HOURLY}, a AS (SELECT ts, temperature AS v, epoch(ts)::BIGINT AS t FROM hourly), "
    "w AS (SELECT *, CASE WHEN count(v) OVER i = 23 THEN (sum(v) OVER i + 0.5::DOUBLE * first_value(v) OVER b + 0.5::DOUBLE * first_value(v) OVER f) / 24 END AS trend "
    "FROM a WINDOW i AS (ORDER BY t RANGE BETWEEN 39600 PRECEDING AND 39600 FOLLOWING), "
    "b AS (ORDER BY t RANGE BETWEEN 43200 PRECEDING AND 43200 PRECEDING), f AS (ORDER BY t RANGE BETWEEN 43200 FOLLOWING AND 43200 FOLLOWING)), "
    "h AS (SELECT hour(ts) AS h, avg(v - trend) AS m FROM w GROUP BY 1), "
    "s AS (SELECT h, m - (SELECT avg(m) FROM h) AS season FROM h), "
    "parts AS (SELECT ts, v AS value, trend, season, v - trend - season AS residual FROM w JOIN s ON hour(ts) = s.h)"
)


@query(final(_PARTS, "parts", ["ts"], ["value", "trend", "season", "residual"], digits=8))
def decomposition(spark, sf_dir):
    """Trend, daily season and residual of the mean of all stations."""
    rows = fixtures.hourly(spark, sf_dir).select("ts", "temperature")
    return rounded(dependence.decompose(rows, "temperature", [], "ts", width=WIDTH), 8)


_H = 6
_LOSS = (
    f"{ctes.HOURLY}, d AS (SELECT a.ts, pow(a.temperature - b.temperature, 2) - pow(a.temperature - c.temperature, 2) AS l FROM hourly a "
    f"JOIN hourly b ON b.ts = a.ts - INTERVAL {_H} HOUR JOIN hourly c ON c.ts = a.ts - INTERVAL 24 HOUR), "
    "e AS (SELECT ts, l, l - avg(l) OVER () AS x FROM d WHERE l IS NOT NULL), t AS (SELECT count(*) AS n, avg(l) AS m FROM e), "
    f"g AS (SELECT k, sum(a.x * b.x) * CASE WHEN k = 0 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE * (1 - k / {_H}) END AS s FROM e a CROSS JOIN (SELECT unnest(range(0, {_H})) AS k) "
    "JOIN e b ON b.ts = a.ts - to_hours(k::INT) GROUP BY k), "
    "v AS (SELECT n, m, (SELECT sum(s) FROM g) / n AS v FROM t)"
)


@query(
    f"WITH {_LOSS} SELECT n, round(m, 8) AS mean_difference, round(m / sqrt(v / n) * sqrt((n + 1 - {2 * _H} + {_H * (_H - 1)} / n) / n), 8) AS statistic FROM v"
)
def diebold_mariano(spark, sf_dir):
    """Whether the value of six hours ago forecasts as well as that of a day ago; the p-value is tested apart."""
    hours = fixtures.hourly(spark, sf_dir).select("ts", "temperature")
    ago = lambda h, c: hours.select((F.col("ts") + F.expr(f"INTERVAL {h} HOURS")).alias("ts"), F.col("temperature").alias(c))
    rows = hours.join(ago(_H, "near"), "ts").join(ago(24, "day"), "ts")
    return rounded(dependence.diebold_mariano(rows, "temperature", "near", "day", [], "ts", _H, width=WIDTH).drop("p_value"), 8)


LATER = "l_shipdate >= TIMESTAMP '1995-06-17 00:00:00'"
_SPLIT_LINES = f"x AS (SELECT l_returnflag, l_extendedprice AS v, ({LATER}) AS after FROM lineitem WHERE l_extendedprice IS NOT NULL)"


@query(
    f"WITH {_SPLIT_LINES}, n AS (SELECT l_returnflag, count(*) FILTER (NOT after) AS a, count(*) FILTER (after) AS b FROM x GROUP BY 1), "
    "c AS (SELECT l_returnflag, v, count(*) FILTER (NOT after) AS a, count(*) FILTER (after) AS b FROM x GROUP BY 1, 2), "
    "r AS (SELECT l_returnflag, sum(a) OVER w AS a, sum(b) OVER w AS b FROM c WINDOW w AS (PARTITION BY l_returnflag ORDER BY v)) "
    "SELECT n.l_returnflag, n.a AS n_before, n.b AS n_after, round(max(CASE WHEN n.a > 0 AND n.b > 0 THEN abs(r.a / n.a - r.b / n.b) END), 10) AS distance "
    "FROM r JOIN n USING (l_returnflag) GROUP BY 1, 2, 3"
)
def ks_drift(spark, sf_dir):
    """Kolmogorov-Smirnov distance of the prices before and after a date, for each return flag; the p-value is tested apart."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    found = drift.ks_drift(lines, "l_extendedprice", F.expr(LATER), ["l_returnflag"], widths=(500.0, 100))
    return rounded(found.drop("p_value"))


_SHARES = ", ".join(f"count(*) FILTER (NOT after AND bin = {i}) / count(*) FILTER (NOT after) AS p{i}, count(*) FILTER (after AND bin = {i}) / count(*) FILTER (after) AS q{i}" for i in range(10))
_TERMS = " + ".join(f"(greatest(q{i}, 0.0001::DOUBLE) - greatest(p{i}, 0.0001::DOUBLE)) * ln(greatest(q{i}, 0.0001::DOUBLE) / greatest(p{i}, 0.0001::DOUBLE))" for i in range(10))


@query(
    f"WITH {_SPLIT_LINES}, e AS (SELECT l_returnflag, quantile_cont(v, [{', '.join(str(i / 10) for i in range(1, 10))}]) AS q FROM x WHERE NOT after GROUP BY 1), "
    "b AS (SELECT x.*, len(list_filter(e.q, lambda z: z < x.v)) AS bin FROM x JOIN e USING (l_returnflag)), "
    f"s AS (SELECT l_returnflag, count(*) FILTER (NOT after) AS n_before, count(*) FILTER (after) AS n_after, {_SHARES} FROM b GROUP BY 1) "
    f"SELECT l_returnflag, n_before, n_after, round({_TERMS}, 8) AS psi FROM s WHERE n_after > 0"
)
def population_stability(spark, sf_dir):
    """The stability index of the same prices."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return rounded(drift.population_stability(lines, "l_extendedprice", F.expr(LATER), ["l_returnflag"]), 8)


@query(
    f"WITH {ctes.STATION_HOURLY}, k AS (SELECT station, ts::DATE AS day, nox_gt AS x, co_gt AS y FROM hourly WHERE nox_gt IS NOT NULL AND co_gt IS NOT NULL), "
    "b AS (SELECT station, corr(x, y) AS baseline FROM k GROUP BY 1), d AS (SELECT DISTINCT station, day FROM k), "
    "r AS (SELECT d.station, d.day, count(*) AS n, corr(x, y) AS correlation FROM d JOIN k ON k.station = d.station AND k.day BETWEEN d.day - 6 AND d.day GROUP BY ALL), "
    "z AS (SELECT r.station, r.day, n, correlation, baseline, CASE WHEN n >= 10 AND abs(correlation) < 1 THEN (atanh(correlation) - atanh(baseline)) * sqrt(n - 3) END AS z "
    "FROM r JOIN b USING (station)) "
    "SELECT station, day, n, round(CASE WHEN n > 1 THEN correlation END, 7) AS correlation, round(baseline, 7) AS baseline, round(z, 6) AS z, "
    "coalesce(abs(z) > 1.5, false) AS broken FROM z WHERE n > 2"
)
def correlation_breaks(spark, sf_dir):
    """Days at whose end a week's correlation of NOx and CO has left that of its station."""
    found = drift.correlation_breaks(by_station(spark, sf_dir), "nox_gt", "co_gt", STATION, "ts", limit=1.5).filter("n > 2")
    return found.select("station", "day", "n", F.round("correlation", 7).alias("correlation"), F.round("baseline", 7).alias("baseline"), F.round("z", 6).alias("z"), "broken")


_LEVEL = "CASE WHEN c6h6_gt > {} THEN 3 WHEN c6h6_gt > {} THEN 2 WHEN c6h6_gt > {} THEN 1 ELSE 0 END".format(*reversed(ALERT_LEVELS["c6h6_gt"]))
_NAME = "[" + ", ".join(f"'{n}'" for n in LEVEL_NAMES) + "][level + 1]"


@query(
    f"WITH {ctes.STATION_HOURLY}, l AS (SELECT station, ts, c6h6_gt AS v, {_LEVEL} AS level FROM hourly WHERE c6h6_gt IS NOT NULL), "
    "n AS (SELECT *, (level IS DISTINCT FROM lag(level) OVER w)::INT AS new FROM l WINDOW w AS (PARTITION BY station ORDER BY ts)), "
    "e AS (SELECT *, sum(new) OVER (PARTITION BY station ORDER BY ts) AS episode FROM n) "
    f"SELECT station, 'c6h6_gt' AS channel, {_NAME} AS level, min(ts) AS start, max(ts) AS \"end\", count(*) AS readings, round(max(v), 10) AS peak "
    "FROM e GROUP BY station, episode, level"
)
def alert_episodes(spark, sf_dir):
    """Episodes of benzene at every station, by level."""
    rows = fixtures.hourly(spark, sf_dir, station=True).select("station", "ts", "c6h6_gt")
    return rounded(drift.alert_episodes(rows, "c6h6_gt", STATION, "ts", widths=(WIDTH, 3)))
