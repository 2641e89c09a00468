"""Common table expressions that derive the sensor tables in plain SQL."""

from skywell.plans.fixtures import CHANNEL_OF, READINGS, STATIONS, sentinel_test
from skywell.schema import (
    AVERAGED, CARRIED, CLEAN_RANGES, DERIVED_COLUMNS, FLAT_COLUMNS, INTERPOLATED, SENSORS, VALID_RANGES,
)

_MEANS = ", ".join(f"avg(value) FILTER (event_type = '{e}') AS {c}" for e, c in CHANNEL_OF.items())
HOURLY = f"hourly AS (SELECT date_trunc('hour', ts) AS ts, {_MEANS} FROM events GROUP BY 1)"
STATION_HOURLY = (
    f"hourly AS (SELECT user_id % {STATIONS} AS station, date_trunc('hour', ts) AS ts, {_MEANS} "
    "FROM events GROUP BY 1, 2)"
)


def long(cols, source="hourly", keep="ts"):
    """One row per channel of the non-null cells."""
    return " UNION ALL ".join(
        f"SELECT {keep}, '{c}' AS channel, {c} AS value FROM {source} WHERE {c} IS NOT NULL" for c in cols
    )


_SENSORS = ", ".join(
    f"CASE WHEN {sentinel_test(i)} THEN NULL ELSE {x} END AS {c}" for i, (c, x) in enumerate(READINGS.items())
)
TYPED = f"""typed AS (SELECT event_id, event_id // 10 AS batch_id,
    CASE WHEN event_id % 97 = 0 THEN date_trunc('day', ts) WHEN event_id % 101 = 0 THEN NULL ELSE ts END AS timestamp,
    strftime(ts, '%d/%m/%Y') AS date, strftime(ts, '%H.%M.%S') AS time,
    'station_' || (user_id % {STATIONS}) AS source, true AS simulation,
    CASE WHEN event_id % 97 = 0 THEN 'timestamp_incomplete' WHEN event_id % 101 = 0 THEN 'timestamp_invalid'
         WHEN event_id % 89 = 0 THEN 'completely_empty' END AS reason,
    {_SENSORS} FROM events)"""


def _range_test(c, low, high):
    sides = ([f"{c} < {low}"] if low is not None else []) + ([f"{c} > {high}"] if high is not None else [])
    return "(" + " OR ".join(sides) + ")"


RANGE_REASON = "CASE " + " ".join(
    f"WHEN {_range_test(c, low, high)} THEN '{c}_out_of_range'" for c, (low, high) in CLEAN_RANGES.items()
) + " END"


def imputed(scope: str) -> str:
    """TYPED, then the fills within `scope`, as the table `imputed`."""
    back = f"PARTITION BY {scope} ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    ahead = f"PARTITION BY {scope} ORDER BY event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING"
    base = "event_id, batch_id, timestamp, date, time, source, simulation"
    carried = ", ".join(f"last_value({c} IGNORE NULLS) OVER ({back}) AS {c}" for c in CARRIED)
    ends = ", ".join(
        f"{c}, last_value({c} IGNORE NULLS) OVER ({back}) AS p_{c}, "
        f"last_value(CASE WHEN {c} IS NOT NULL THEN rn END IGNORE NULLS) OVER ({back}) AS i_{c}, "
        f"first_value({c} IGNORE NULLS) OVER ({ahead}) AS n_{c}, "
        f"first_value(CASE WHEN {c} IS NOT NULL THEN rn END IGNORE NULLS) OVER ({ahead}) AS j_{c}"
        for c in INTERPOLATED
    )
    lines = ", ".join(
        f"CASE WHEN {c} IS NOT NULL THEN {c} WHEN j_{c} IS NULL THEN p_{c} "
        f"ELSE p_{c} + (n_{c} - p_{c}) * ((rn - i_{c}) / (j_{c} - i_{c})) END AS {c}"
        for c in INTERPOLATED
    )
    means = ", ".join(f"coalesce({c}, avg({c}) OVER (PARTITION BY {scope})) AS {c}" for c in SENSORS)
    return f"""{TYPED},
    numbered AS (SELECT *, row_number() OVER (PARTITION BY {scope} ORDER BY event_id) AS rn FROM typed WHERE reason IS NULL),
    ended AS (SELECT {base}, rn, {', '.join(AVERAGED)}, {carried}, {ends} FROM numbered),
    lined AS (SELECT {base}, {', '.join(AVERAGED)}, {', '.join(CARRIED)}, {lines} FROM ended),
    imputed AS (SELECT {base}, {means} FROM lined)"""


SEASON = (
    "CASE WHEN month(timestamp) IN (12, 1, 2) THEN 'Winter' WHEN month(timestamp) IN (3, 4, 5) THEN 'Spring' "
    "WHEN month(timestamp) IN (6, 7, 8) THEN 'Summer' ELSE 'Autumn' END"
)
COMFORT = "((1 - abs(temperature - 22) / 30) * 0.6 + (1 - abs(relative_humidity - 50) / 50) * 0.4) * 100"


def aqi(scope: str) -> str:
    over = f"OVER (PARTITION BY {scope})" if scope else "OVER ()"
    term = lambda c, w: f"CASE WHEN max({c}) {over} > 0 THEN {c} / max({c}) {over} ELSE 0 END * {w}"
    return f"({term('co_gt', 0.4)} + {term('nox_gt', 0.3)} + {term('no2_gt', 0.3)}) * 100"


def clean(scope: str) -> str:
    """`imputed`, then the rows in range with derived columns and score, as the table `clean`."""
    scored = [*FLAT_COLUMNS, *DERIVED_COLUMNS]
    missing = " + ".join(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in scored)
    ranges = " ".join(
        f"- CASE WHEN {_range_test(c, low, high)} THEN 0.2::DOUBLE ELSE 0 END" for c, (low, high) in VALID_RANGES.items()
    )
    return f"""{imputed(scope)},
    kept AS (SELECT * FROM imputed WHERE {RANGE_REASON} IS NULL),
    derived AS (SELECT *, hour(timestamp) AS hour, isodow(timestamp) - 1 AS day_of_week, month(timestamp) AS month,
        {SEASON} AS season, {aqi(scope)} AS air_quality_index, {COMFORT} AS comfort_index FROM kept),
    clean AS (SELECT *, least(greatest(1.0::DOUBLE - ({missing}) / {len(scored)}.0::DOUBLE * 0.3 {ranges}
        - CASE WHEN nox_gt < no2_gt THEN 0.1::DOUBLE ELSE 0 END, 0.0::DOUBLE), 1.0::DOUBLE) AS quality_score FROM derived)"""


def range_counts(source: str, by: str = "") -> str:
    """Per column violations and extremes, long."""
    head = f"{by}, " if by else ""
    tail = f" GROUP BY {by}" if by else ""
    return " UNION ALL ".join(
        f"SELECT {head}'{c}' AS channel, count(*) FILTER ({c} < {low}) AS below_min, "
        f"count(*) FILTER ({c} > {high}) AS above_max, min({c}) AS min_value, max({c}) AS max_value FROM {source}{tail}"
        for c, (low, high) in VALID_RANGES.items()
    )


VIOLATIONS = " + ".join(
    f"count(*) FILTER ({c} < {low}) + count(*) FILTER ({c} > {high})" for c, (low, high) in VALID_RANGES.items()
)
CONSISTENCY = [
    ("nox_no2_consistency", "NOx should be >= NO2", "nox_gt < no2_gt"),
    ("temp_humidity_consistency", "Very low temperature with high humidity", "temperature < 0 AND relative_humidity > 90"),
    ("all_parameters_zero", "All air quality parameters are zero", "co_gt = 0 AND nox_gt = 0 AND c6h6_gt = 0"),
]
