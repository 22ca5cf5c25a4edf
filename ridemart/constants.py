"""Fixed values that results depend on.

These must stay equal to the behaviour being reproduced; they are stated here
once, in natural order, and imported everywhere else.
"""

# ---- fixed values -----------------------------------------------------------

# Raw file column prefix per fleet.
FLEET_PREFIX = {"yellow": "tpep", "green": "lpep"}

# Raw file name pattern: {fleet}_tripdata_{month}.parquet
RAW_FILE_PATTERN = "{fleet}_tripdata_{month}.parquet"

# Fleet dimension rows: (fleet, fleet_name, color).
FLEET_ROWS = [
    ("yellow", "Yellow", "#F2A900"),
    ("green", "Green", "#2E7D32"),
]

# Pickup hours counted as rush hour.
RUSH_HOURS = (7, 8, 9, 16, 17, 18, 19)

# Day parts: an hour below the bound gets the label; the rest is "Night".
DAY_PARTS = ((6, "Overnight"), (10, "Morning"), (16, "Midday"), (20, "Evening"))
LAST_DAY_PART = "Night"

# Borough centroid fallback (lat, lng) and the city default.
BOROUGH_CENTROID = {
    "Manhattan": (40.7831, -73.9712),
    "Brooklyn": (40.6782, -73.9442),
    "Queens": (40.7282, -73.7949),
    "Bronx": (40.8448, -73.8648),
    "Staten Island": (40.5795, -74.1502),
    "EWR": (40.6895, -74.1745),
}
CITY_CENTROID = (40.7128, -74.0060)

# Valid location ids in the contract.
LOCATION_ID_RANGE = (1, 265)

# Anomaly rules, in reporting order: name -> thresholds used in operators/anomaly.py.
ANOMALY_RULES = (
    "zero_distance",           # trip_distance <= 0
    "zero_fare",               # fare_amount <= 0
    "implausible_speed",       # avg_speed_mph > 80
    "fare_distance_mismatch",  # fare_amount > 60 and trip_distance < 1
    "tip_exceeds_fare",        # tip_amount > 1.5 * fare_amount
)
MAX_PLAUSIBLE_SPEED_MPH = 80.0
MISMATCH_MIN_FARE = 60.0
MISMATCH_MAX_DISTANCE = 1.0
TIP_TO_FARE_LIMIT = 1.5

# Anomaly feature columns, in model order.
ANOMALY_FEATURES = (
    "trip_distance",
    "fare_amount",
    "tip_amount",
    "total_amount",
    "trip_duration_min",
    "avg_speed_mph",
)

# Forecasting: one season is a week of hours; lags are one and two seasons.
WEEK_HOURS = 24 * 7
LAGS = (WEEK_HOURS, 2 * WEEK_HOURS)
DAILY_FOURIER = (24, 4, "d")    # period, harmonics, prefix
WEEKLY_FOURIER = (168, 6, "w")
INTERVAL_Z = 1.96
SMAPE_EPS = 1e-9

# Distance bands (miles, left-closed): label per lower edge.
DISTANCE_BANDS = ((0.0, "<1"), (1.0, "1-3"), (3.0, "3-5"), (5.0, "5-10"), (10.0, "10+"))

# Isolation forest: Euler-Mascheroni constant in the average path length c(n).
EULER_GAMMA = 0.5772156649015329
