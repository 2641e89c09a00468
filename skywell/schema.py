"""Schemas, channel names, ranges and thresholds shared by all operators."""

from pyspark.sql import types as T

# Raw file header -> flat sensor name, in file order.
SENSOR_HEADERS = {
    "CO(GT)": "co_gt",
    "PT08.S1(CO)": "pt08_s1_co",
    "NMHC(GT)": "nmhc_gt",
    "C6H6(GT)": "c6h6_gt",
    "PT08.S2(NMHC)": "pt08_s2_nmhc",
    "NOx(GT)": "nox_gt",
    "PT08.S3(NOx)": "pt08_s3_nox",
    "NO2(GT)": "no2_gt",
    "PT08.S4(NO2)": "pt08_s4_no2",
    "PT08.S5(O3)": "pt08_s5_o3",
    "T": "temperature",
    "RH": "relative_humidity",
    "AH": "absolute_humidity",
}
SENSORS = list(SENSOR_HEADERS.values())
REQUIRED_HEADERS = ["Date", "Time", "CO(GT)", "NOx(GT)", "C6H6(GT)"]
POLLUTANTS = ["co_gt", "nox_gt", "no2_gt", "c6h6_gt"]
SENTINEL = -200.0

# How a missing sensor value is filled, by column (all others: the mean).
CARRIED = ["co_gt", "nox_gt", "no2_gt"]
INTERPOLATED = ["temperature", "relative_humidity", "absolute_humidity"]
AVERAGED = [c for c in SENSORS if c not in CARRIED + INTERPOLATED]

RAW_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in ["Date", "Time", *SENSOR_HEADERS]]
)
MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("time", T.StringType()),
        T.StructField(
            "sensor_data", T.StructType([T.StructField(c, T.StringType()) for c in SENSORS])
        ),
        T.StructField(
            "metadata",
            T.StructType(
                [
                    T.StructField("source", T.StringType()),
                    T.StructField("simulation", T.BooleanType()),
                    T.StructField("original_timestamp", T.StringType()),
                ]
            ),
        ),
    ]
)
FLAT_COLUMNS = ["timestamp", "date", "time", *SENSORS, "source", "simulation"]
DERIVED_COLUMNS = [
    "hour", "day_of_week", "month", "season", "air_quality_index", "comfort_index",
]

# Closed ranges of the cleaning step, tested in this order; None is an open side.
CLEAN_RANGES = {
    "co_gt": (0, 50),
    "nox_gt": (0, 1000),
    "no2_gt": (0, 500),
    "c6h6_gt": (0, 50),
    "relative_humidity": (0, None),
    "absolute_humidity": (0, None),
}
# Closed ranges of the validation step, stricter for the environment channels.
VALID_RANGES = {
    "co_gt": (0, 50),
    "nox_gt": (0, 1000),
    "no2_gt": (0, 500),
    "c6h6_gt": (0, 50),
    "temperature": (-20, 50),
    "relative_humidity": (0, 100),
    "absolute_humidity": (0, 10),
}


def legacy_ranges(ranges: dict) -> dict:
    """The ranges as first written, where the benzene rule named a column that never arrives."""
    return {c: r for c, r in ranges.items() if c != "c6h6_gt"}


# Sizes, in rows, of the live windows.
LIVE_WINDOWS = {"hourly": 24, "daily": 168, "weekly": 720, "monthly": 2160}

# Look-back ranges, in days, of the exploratory views.
VIEW_RANGES = {"Today": 1, "Last 7 days": 7, "Last 30 days": 30, "Last 365 days": 365, "All data": None}

# Alert limits and severities.
ALERT_SECONDS, ALERT_QUALITY, ALERT_ERRORS, ALERT_VIOLATIONS = 10.0, 0.5, 0.1, 0.05
SEVERITY = {
    "HIGH_PROCESSING_TIME": "WARNING",
    "LOW_DATA_QUALITY": "CRITICAL",
    "HIGH_ERROR_RATE": "CRITICAL",
    "HIGH_RANGE_VIOLATIONS": "WARNING",
}

# Feature lags in hours, trailing mean, horizon, split and candidate settings.
LAGS = [1, 3, 6, 12, 18, 24, 48]
TRAILING_ROWS, TRAILING_MIN = 24, 6
HORIZON = 6
TRAIN_SHARE, VAL_SHARE = 0.7, 0.15
LINEAR_CANDIDATES = [
    ("linear", None),
    ("ridge", 0.01), ("ridge", 0.1), ("ridge", 1.0), ("ridge", 10.0),
    ("lasso", 0.0001), ("lasso", 0.001), ("lasso", 0.01), ("lasso", 0.1),
]
BOOSTED_CANDIDATES = [(200, 0.05, 4), (300, 0.1, 5), (500, 0.05, 6)]  # trees, rate, depth
SEASONAL_CANDIDATES = [
    ((1, 0, 1), (1, 1, 1, 24)),
    ((2, 0, 2), (1, 1, 1, 24)),
    ((1, 1, 1), (1, 1, 0, 24)),
    ((1, 0, 2), (0, 1, 1, 24)),
]

# Above which a pollutant is at the level of caution, alert and critical.
ALERT_LEVELS = {
    "co_gt": (3.0, 6.0, 8.0),
    "nox_gt": (400.0, 600.0, 800.0),
    "no2_gt": (200.0, 250.0, 300.0),
    "c6h6_gt": (20.0, 40.0, 50.0),
}
LEVEL_NAMES = ["normal", "caution", "alert", "critical"]
