"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

The driver registers the test tables as views; every query below starts from
the same fixture projection as ``ridemart.sources.fixtures`` and spells the
same semantics in DuckDB's dialect: NULLS FIRST stated where Spark's default
is relied on, DuckDB's own ``round``, BIGINT for hour-like columns,
microsecond differences for durations.  The rules (contract, cleaning bounds,
anomaly rules, dimension labels) are written out here and not taken from the
library.
"""

from __future__ import annotations

from ridemart.settings import Settings, fixture_settings


def _num(x: float) -> str:
    return repr(float(x))


def base_ctes(s: Settings | None = None) -> str:
    """raw -> clean -> fact (no id) -> dim_zone -> dim_date, as CTEs."""
    s = s or fixture_settings()
    c, w = s.cleaning, s.window
    return f"""
e AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events),
raw AS (
  SELECT CASE WHEN event_type IN ('view','click','purchase') THEN 'yellow' ELSE 'green' END AS fleet,
         ts AS pickup_datetime,
         ts + to_minutes(k*2) AS dropoff_datetime,
         CAST(user_id % 27 + 1 AS INT) AS pickup_location_id,
         CAST((event_id * 7) % 27 + 1 AS INT) AS dropoff_location_id,
         CASE WHEN event_id % 10 = 9 THEN NULL ELSE CAST(event_id % 8 AS DOUBLE) END AS passenger_count,
         CASE WHEN event_id % 50 = 0 THEN CAST(0 AS DOUBLE)
              WHEN event_id % 37 = 0 THEN CAST(0.5 AS DOUBLE)
              ELSE CAST(floor(value) AS DOUBLE) / 4 END AS trip_distance,
         CAST(floor(value * 4) AS DOUBLE) / 4 AS fare_amount,
         CAST(floor(value * 4) AS DOUBLE) / 4 * (k % 8) / 4 AS tip_amount,
         CAST(floor(value * 4) AS DOUBLE) / 4 * (k % 8 + 4) / 4 + 1 AS total_amount,
         k % 6 AS payment_type
  FROM e),
feat AS (
  SELECT r.*, CAST(pickup_datetime AS DATE) AS pickup_date, c.h AS pickup_hour, c.wd AS pickup_weekday,
         dayname(pickup_datetime) AS pickup_day_name, c.wd >= 5 AS is_weekend,
         c.h IN (7, 8, 9, 16, 17, 18, 19) AS is_rush_hour,
         CAST(date_diff('microsecond', pickup_datetime, dropoff_datetime) AS DOUBLE) / 60000000.0
           AS trip_duration_min
  FROM raw r, LATERAL (SELECT CAST(hour(r.pickup_datetime) AS BIGINT) AS h,
                              CAST(isodow(r.pickup_datetime) - 1 AS BIGINT) AS wd) c),
keep AS (
  SELECT *,
         pickup_datetime >= TIMESTAMP '{w.start}' AND pickup_datetime < TIMESTAMP '{w.end}'
         AND dropoff_datetime > pickup_datetime
         AND fare_amount BETWEEN {_num(c.min_fare)} AND {_num(c.max_fare)}
         AND trip_distance BETWEEN {_num(c.min_distance)} AND {_num(c.max_distance)}
         AND trip_duration_min BETWEEN {_num(c.min_duration_min)} AND {_num(c.max_duration_min)}
         AND coalesce(passenger_count, 1) BETWEEN 1 AND {c.max_passengers} AS kept
  FROM feat),
clean AS (
  SELECT fleet, pickup_datetime, dropoff_datetime, pickup_location_id, dropoff_location_id,
         passenger_count, trip_distance, fare_amount, tip_amount, total_amount, payment_type,
         pickup_date, pickup_hour, pickup_weekday, pickup_day_name, is_weekend, is_rush_hour,
         trip_duration_min,
         trip_distance / NULLIF(trip_duration_min / 60.0, 0) AS avg_speed_mph
  FROM keep WHERE kept),
fact AS (
  SELECT CAST(year(pickup_date) * 10000 + month(pickup_date) * 100 + day(pickup_date) AS INTEGER) AS date_key,
         pickup_hour, fleet,
         pickup_location_id, dropoff_location_id, passenger_count, trip_distance, fare_amount,
         tip_amount, total_amount, trip_duration_min, avg_speed_mph, is_weekend, is_rush_hour
  FROM clean),
dim_zone AS (
  SELECT l.location_id, l.zone, l.borough, l.service_zone,
         coalesce(c.lat, b.lat, 40.7128) AS lat, coalesce(c.lng, b.lng, -74.0060) AS lng
  FROM (SELECT n_nationkey + 1 AS location_id, n_name AS zone, r_name AS borough,
               'Boro Zone' AS service_zone
        FROM nation JOIN region ON n_regionkey = r_regionkey) l
  LEFT JOIN (SELECT n_nationkey + 1 AS location_id, 40.5 + n_nationkey / CAST(64 AS DOUBLE) AS lat,
                    -74.25 + n_nationkey / CAST(64 AS DOUBLE) AS lng
             FROM nation WHERE n_nationkey % 2 = 0) c ON l.location_id = c.location_id
  LEFT JOIN (SELECT r_name AS borough, 40.0 + r_regionkey AS lat, -74.0 - r_regionkey AS lng
             FROM region WHERE r_regionkey < 4) b ON l.borough = b.borough),
dim_date AS (
  SELECT CAST(year(date) * 10000 + month(date) * 100 + day(date) AS INTEGER) AS date_key, date,
         CAST(year(date) AS BIGINT) AS year, CAST(month(date) AS BIGINT) AS month, monthname(date) AS month_name,
         CAST(day(date) AS BIGINT) AS day, wd AS weekday, dayname(date) AS weekday_name, wd >= 5 AS is_weekend,
         CAST(date - CAST(wd AS INTEGER) AS DATE) AS week_start
  FROM (SELECT date, CAST(isodow(date) - 1 AS BIGINT) AS wd
        FROM (SELECT CAST(unnest(generate_series(DATE '{w.start}', DATE '{w.end}' - INTERVAL 1 DAY,
                                                 INTERVAL 1 DAY)) AS DATE) AS date) g) days)
"""


def r2(x: str) -> str:
    return f"round({x}, 2)"


def r4(x: str) -> str:
    return f"round({x}, 4)"


def with_base(body: str, extra_ctes: str = "", s: Settings | None = None) -> str:
    ctes = base_ctes(s) + (("," + extra_ctes) if extra_ctes else "")
    return f"WITH {ctes}\n{body}"


FACT_ORDER = ("date_key, pickup_hour, fleet, pickup_location_id, dropoff_location_id, "
              "passenger_count NULLS FIRST, trip_distance NULLS FIRST, fare_amount NULLS FIRST, "
              "tip_amount NULLS FIRST, total_amount NULLS FIRST, trip_duration_min NULLS FIRST, "
              "avg_speed_mph NULLS FIRST, is_weekend, is_rush_hour")

# The marts in the same shape as the Spark plans: aggregate the fact on ids,
# then join the dimensions to the (small) aggregate.

ZONE_DEMAND = f"""
SELECT location_id, z.zone, z.borough, z.lat, z.lng, a.pickups,
       {r2('a.rev')} AS total_revenue, {r2('a.fare')} AS avg_fare,
       {r2('a.dist')} AS avg_distance, {r2('a.dur')} AS avg_duration_min
FROM (SELECT pickup_location_id AS location_id, count(*) AS pickups, sum(total_amount) AS rev,
             avg(fare_amount) AS fare, avg(trip_distance) AS dist, avg(trip_duration_min) AS dur
      FROM fact GROUP BY pickup_location_id) a
JOIN dim_zone z USING (location_id)"""

HOURLY_VOLUME = f"""
per_hour AS (SELECT fleet, date_key, pickup_hour, count(*) AS n FROM fact
             GROUP BY fleet, date_key, pickup_hour),
dated AS (SELECT p.fleet, p.pickup_hour, p.n, d.date, d.weekday, d.weekday_name
          FROM per_hour p JOIN dim_date d ON p.date_key = d.date_key),
ride_days AS (SELECT fleet, weekday, count(DISTINCT date) AS n_days FROM dated GROUP BY fleet, weekday),
hourly AS (SELECT x.fleet, x.weekday, x.weekday_name, x.pickup_hour AS hour,
                  CAST(sum(x.n) AS BIGINT) AS rides, r.n_days,
                  {r2('CAST(sum(x.n) AS DOUBLE) / r.n_days')} AS avg_rides_per_day
           FROM dated x JOIN ride_days r ON x.fleet = r.fleet AND x.weekday = r.weekday
           GROUP BY x.fleet, x.weekday, x.weekday_name, x.pickup_hour, r.n_days)"""

DAILY_VOLUME = f"""
daily AS (SELECT a.fleet, d.date, d.weekday_name, d.is_weekend, a.rides,
                 {r2('a.rev')} AS revenue, {r2('a.fare')} AS avg_fare, {r2('a.dist')} AS avg_distance
          FROM (SELECT fleet, date_key, count(*) AS rides, sum(total_amount) AS rev,
                       avg(fare_amount) AS fare, avg(trip_distance) AS dist
                FROM fact GROUP BY fleet, date_key) a
          JOIN dim_date d ON a.date_key = d.date_key)"""

ROUTE_FLOWS = f"""
SELECT a.fleet, a.pickup_location_id, a.dropoff_location_id,
       p.zone AS pickup_zone, q.zone AS dropoff_zone, p.borough AS pickup_borough, q.borough AS dropoff_borough,
       p.lat AS pickup_lat, p.lng AS pickup_lng, q.lat AS dropoff_lat, q.lng AS dropoff_lng,
       a.trips, {r2('a.fare')} AS avg_fare, {r2('a.dist')} AS avg_distance
FROM (SELECT fleet, pickup_location_id, dropoff_location_id, count(*) AS trips,
             avg(fare_amount) AS fare, avg(trip_distance) AS dist
      FROM fact WHERE pickup_location_id <> dropoff_location_id
      GROUP BY fleet, pickup_location_id, dropoff_location_id
      HAVING count(*) >= 5) a
JOIN dim_zone p ON p.location_id = a.pickup_location_id
JOIN dim_zone q ON q.location_id = a.dropoff_location_id
ORDER BY a.trips DESC, a.fleet, a.pickup_location_id, a.dropoff_location_id
LIMIT 500"""


def rn(x: str, digits: int) -> str:
    return f"round({x}, {digits}) + 0.0"  # no negative zero


#: The trip contract: column, type, nullable, check label, condition.
CONTRACT = [
    ("fleet", "string", False, "isin(yellow,green)", "fleet IN ('yellow', 'green')"),
    ("pickup_datetime", "timestamp_ntz", False, None, None),
    ("dropoff_datetime", "timestamp_ntz", False, None, None),
    ("pickup_location_id", "int", False, "in_range(1,265)", "pickup_location_id BETWEEN 1 AND 265"),
    ("dropoff_location_id", "int", False, "in_range(1,265)", "dropoff_location_id BETWEEN 1 AND 265"),
    ("passenger_count", "double", True, "ge(0)", "passenger_count >= 0"),
    ("trip_distance", "double", False, "in_range(0.0,100.0)", "trip_distance BETWEEN 0 AND 100"),
    ("fare_amount", "double", False, "in_range(0.0,500.0)", "fare_amount BETWEEN 0 AND 500"),
    ("trip_duration_min", "double", False, "in_range(1.0,180.0)", "trip_duration_min BETWEEN 1 AND 180"),
    ("avg_speed_mph", "double", True, "ge(0)", "avg_speed_mph >= 0"),
    ("pickup_hour", "long", False, "in_range(0,23)", "pickup_hour BETWEEN 0 AND 23"),
    ("pickup_weekday", "long", False, "in_range(0,6)", "pickup_weekday BETWEEN 0 AND 6"),
]

#: Raw trips with the engineered columns, before cleaning.
FEATURED = """featured AS (
  SELECT *, trip_distance / NULLIF(trip_duration_min / 60.0, 0) AS avg_speed_mph FROM feat)"""


def contract_sql() -> str:
    """The raw columns are typed, so no value can fail to coerce."""
    parts = []
    for column, kind, nullable, label, condition in CONTRACT:
        parts.append(f"SELECT '{column}' AS column_name, 'coerce({kind})' AS check_name, CAST(0 AS BIGINT) AS failures")
        if not nullable:
            parts.append(f"SELECT '{column}', 'not_nullable', CAST(count(*) - count({column}) AS BIGINT) FROM featured")
        if label:
            parts.append(f"SELECT '{column}', '{label}', CAST(count(*) FILTER (WHERE NOT ({condition})) AS BIGINT) FROM featured")
    return "\nUNION ALL ".join(parts)


def sample_sql(n: int = 1000, seed: int = 7) -> str:
    """The smallest md5 prefixes of the '|'-joined key, first 15 hex digits."""
    keys = ["fleet", "_pickup_us", "pickup_location_id", "dropoff_location_id", "payment_type"]
    text = "concat_ws('|', '%d', %s)" % (seed, ", ".join(f"CAST({k} AS VARCHAR)" for k in keys))
    staged = ("fleet pickup_datetime dropoff_datetime pickup_location_id dropoff_location_id passenger_count trip_distance "
              "fare_amount tip_amount total_amount payment_type pickup_date pickup_hour pickup_weekday pickup_day_name "
              "is_weekend is_rush_hour trip_duration_min avg_speed_mph").split()
    order = keys + [c for c in staged if c not in keys]
    cols = ", ".join(staged)
    return f"""
SELECT {cols} FROM (
  SELECT *, CAST(('0x' || substr(md5({text}), 1, 15)) AS BIGINT) AS _h
  FROM (SELECT *, epoch_us(pickup_datetime) AS _pickup_us FROM clean) k) h
ORDER BY _h, {", ".join(f"{c} NULLS FIRST" for c in order)}
LIMIT {n}"""


def series_ctes(s: Settings) -> str:
    w, fc = s.window, s.forecast
    fleets = ", ".join(f"'{f}'" for f in fc.fleets)
    test = fc.test_days * 24
    return f"""
counts AS (SELECT fleet, date_trunc('hour', pickup_datetime) AS ds, count(*) AS n FROM clean
           WHERE fleet IN ({fleets}) AND pickup_datetime >= TIMESTAMP '{w.start}'
             AND pickup_datetime < TIMESTAMP '{w.end}'
           GROUP BY ALL),
bounds AS (SELECT fleet, min(ds) AS lo, max(ds) AS hi FROM counts GROUP BY fleet),
spine AS (SELECT fleet, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS ds FROM bounds),
series AS (SELECT s.fleet, s.ds, CAST(coalesce(c.n, 0) AS DOUBLE) AS y
           FROM spine s LEFT JOIN counts c USING (fleet, ds)),
pos AS (SELECT *, row_number() OVER (PARTITION BY fleet ORDER BY ds) - 1 AS t,
               count(*) OVER (PARTITION BY fleet) AS n,
               lag(y, 168) OVER (PARTITION BY fleet ORDER BY ds) AS yhat
        FROM series),
elig AS (SELECT * FROM pos WHERE n >= {test} + 336),
naive AS (SELECT fleet, ds, y AS y_actual, yhat FROM elig WHERE t >= n - {test}),
folds AS (SELECT fleet, fold, n - ({fc.folds} - fold) * {fc.horizon} AS cut
          FROM (SELECT DISTINCT fleet, n FROM elig) x, range(0, {fc.folds}) r(fold)
          WHERE n - ({fc.folds} - fold) * {fc.horizon} > 336)"""


def metrics_sql(y: str = "y_actual", yhat: str = "yhat") -> str:
    err = f"({yhat} - {y})"
    return (f"avg(abs({err})) AS MAE, sqrt(avg({err} * {err})) AS RMSE, "
            f"avg(CASE WHEN {y} > 0 THEN abs({err} / {y}) END) * 100 AS MAPE, "
            f"avg(2 * abs({err}) / (abs({y}) + abs({yhat}) + 1e-9)) * 100 AS sMAPE")


def fold_mean(m: str) -> str:
    """Mean over folds, summed in fold order."""
    return (f"list_reduce(list({m} ORDER BY fold) FILTER (WHERE {m} IS NOT NULL), "
            f"lambda a, b: a + b) / count({m}) AS {m}")


def fourier_sql(v: str, period: int, k: int, name: str) -> str:
    cols = []
    for i in range(1, k + 1):
        arg = f"2 * pi() * {i} * {v} / {period}"
        cols += [f"{rn(f'sin({arg})', 6)} AS {name}_sin{i}", f"{rn(f'cos({arg})', 6)} AS {name}_cos{i}"]
    return ", ".join(cols)


RULES_SQL = {
    "zero_distance": "trip_distance <= 0",
    "zero_fare": "fare_amount <= 0",
    "implausible_speed": "avg_speed_mph > 80.0",
    "fare_distance_mismatch": "fare_amount > 60.0 AND trip_distance < 1.0",
    "tip_exceeds_fare": "tip_amount > fare_amount * 1.5",
}
FEATURES_SQL = "trip_distance, fare_amount, tip_amount, total_amount, trip_duration_min, avg_speed_mph"
FEATURES_NOT_NULL = " AND ".join(f"{c.strip()} IS NOT NULL" for c in FEATURES_SQL.split(","))


def hash_sql(text: str) -> str:
    """The first 15 hex digits of the text's md5 as BIGINT."""
    return f"CAST(('0x' || substr(md5({text}), 1, 15)) AS BIGINT)"


def path_sql(n: str) -> str:
    """c(n): average path length of an unsuccessful search among n points."""
    return f"CASE WHEN {n} <= 1 THEN 0.0::DOUBLE WHEN {n} = 2 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE * (ln({n} - 1) + 0.5772156649015329::DOUBLE) - 2.0::DOUBLE * ({n} - 1) / {n} END"


def forest_ctes(s: Settings, names: list[str], source: str) -> str:
    """The isolation forest level by level, and every row's walk through all trees: ``forest(trip_id, anomaly_score)``.

    Heap numbering of nodes: the root is 0, node k has children 2k+1 and 2k+2.
    """
    a = s.anomaly
    levels = (a.max_samples - 1).bit_length()
    span, unit = 1 << 60, 1 << 44

    def ranges(fn: str) -> str:
        return "[" + ", ".join(f"{fn}(x[{i + 1}])" for i in range(len(names))) + "]"

    def draw(purpose: str) -> str:
        return hash_sql(f"concat_ws('|', '{purpose}', '{a.seed}', tree, node)")

    parts = [f"""
inp AS MATERIALIZED (SELECT trip_id, [{', '.join(f'CAST({c} AS DOUBLE)' for c in names)}] AS x FROM {source}),
sizes AS (SELECT count(*) AS n, least({a.max_samples}, count(*)) AS psi FROM inp),
wish AS (SELECT *, CAST(1.5 AS DOUBLE) * {a.trees} * psi / n AS wanted FROM sizes),
share AS (SELECT *, wanted / copies AS part FROM (SELECT *, least({a.trees}, greatest(1, CAST(ceil(wanted) AS BIGINT))) AS copies FROM wish) w),
drawn AS (SELECT x, own, (own % {a.trees} + c) % {a.trees} AS tree
          FROM (SELECT x, {hash_sql(f"concat_ws('|', '{a.seed}', trip_id)")} AS own FROM inp) o, share, range(0, {a.trees}) r(c) WHERE c < copies),
hashed AS (SELECT *, {hash_sql(f"concat_ws('|', 'sample', '{a.seed}', own, tree)")} AS h FROM drawn),
l0 AS MATERIALIZED (
  SELECT tree, CAST(0 AS BIGINT) AS node, x
  FROM (SELECT tree, x, psi, row_number() OVER (PARTITION BY tree ORDER BY h, own, x) AS place FROM hashed, share
        WHERE h < CAST(floor(least(part, 1.0::DOUBLE) * {span}) AS BIGINT)) p
  WHERE place <= psi),
w0 AS (SELECT trip_id, x, tree, CAST(0 AS BIGINT) AS node FROM inp, (SELECT DISTINCT tree FROM l0) t)"""]
    for d in range(levels):
        parts.append(f"""
g{d} AS (SELECT tree, node, count(*) AS size, {ranges('min')} AS lo, {ranges('max')} AS hi FROM l{d} GROUP BY tree, node),
v{d} AS (SELECT *, list_filter(range(1, {len(names) + 1}), lambda i: hi[i] > lo[i]) AS varying FROM g{d}),
f{d} AS (SELECT tree, node, lo, hi, varying[1 + {draw('feature')} % len(varying)] AS feature FROM v{d}, share
         WHERE size > 1 AND len(varying) > 0 AND {d} < ceil(log2(greatest(psi, 2)))),
t{d} AS (SELECT tree, node, feature, lo[feature] AS low, hi[feature] AS high,
                least(lo[feature] + CAST({draw('threshold')} + 1 AS DOUBLE) / CAST({span} AS DOUBLE) * (hi[feature] - lo[feature]), hi[feature]) AS cut FROM f{d}),
q{d} AS MATERIALIZED (SELECT tree, node, feature, CASE WHEN cut > low THEN cut ELSE high END AS threshold FROM t{d}),
l{d + 1} AS MATERIALIZED (
  SELECT tree, CASE WHEN feature IS NULL THEN node WHEN x[feature] < threshold THEN 2 * node + 1 ELSE 2 * node + 2 END AS node, x
  FROM l{d} LEFT JOIN q{d} USING (tree, node)),
w{d + 1} AS (
  SELECT trip_id, x, tree, CASE WHEN feature IS NULL THEN node WHEN x[feature] < threshold THEN 2 * node + 1 ELSE 2 * node + 2 END AS node
  FROM w{d} LEFT JOIN q{d} USING (tree, node))""")
    parts.append(f"""
leaves AS (SELECT tree, node, CAST(round((floor(log2(node + 1)) + {path_sql('size')}) * {unit}) AS BIGINT) AS units
           FROM (SELECT tree, node, count(*) AS size FROM l{levels} GROUP BY tree, node) z),
forest AS (SELECT trip_id, pow(2.0::DOUBLE, -(CAST(sum(units) AS DOUBLE) / CAST({unit} AS DOUBLE) / count(*)) / (SELECT {path_sql('psi')} FROM share)) AS anomaly_score
           FROM w{levels} JOIN leaves USING (tree, node) GROUP BY trip_id)""")
    return ",".join(parts)


def oracle_queries() -> dict[str, str]:
    s = fixture_settings()
    shown = s.replace(window={"start": "2024-01-01", "end": "2024-01-30"})  # F1 on a window that ends before the table
    q: dict[str, str] = {}
    q["clean_trips"] = with_base("SELECT * FROM clean", s=shown)
    q["clean_summary"] = with_base(f"""
SELECT count(*) AS rows_raw, CAST(count_if(coalesce(kept, false)) AS BIGINT) AS rows_clean,
       CAST(count(*) - count_if(coalesce(kept, false)) AS BIGINT) AS rows_removed,
       CASE WHEN count(*) > 0
            THEN {r2('(count(*) - count_if(coalesce(kept, false))) / count(*) * 100')}
            ELSE 0.0 END AS removed_pct
FROM keep""", s=shown)
    q["dim_zone"] = with_base("SELECT * FROM dim_zone")
    q["fact_trip"] = with_base(f"""
SELECT row_number() OVER (ORDER BY {FACT_ORDER}) AS trip_id, * FROM fact""")
    q["mart_zone_demand"] = with_base(ZONE_DEMAND + "\nORDER BY pickups DESC")
    q["mart_hourly_volume"] = with_base("SELECT * FROM hourly ORDER BY fleet, weekday, hour",
                                        HOURLY_VOLUME)
    q["mart_daily_volume"] = with_base("SELECT * FROM daily ORDER BY fleet, date", DAILY_VOLUME)
    q["mart_route_flows"] = with_base(ROUTE_FLOWS)

    hours = ", ".join(f"coalesce(max(CASE WHEN hour = {h} THEN avg_rides_per_day END), 0.0) AS h{h:02d}"
                      for h in range(24))
    q["heatmap_grid"] = with_base(f"SELECT weekday, weekday_name, {hours} FROM hourly "
                                  f"WHERE fleet = 'yellow' GROUP BY weekday, weekday_name ORDER BY weekday",
                                  HOURLY_VOLUME)
    q["daily_trend"] = with_base("SELECT fleet, date, rides FROM daily ORDER BY date, fleet", DAILY_VOLUME)
    zd = f"zd AS ({ZONE_DEMAND})"
    q["top_zones"] = with_base("SELECT zone, pickups FROM zd ORDER BY pickups DESC, location_id LIMIT 12", zd)
    q["zone_map_points"] = with_base("SELECT zone, borough, lat, lng, pickups, avg_fare FROM zd", zd)

    nulls = ", ".join(
        f"CASE WHEN count(*) > 0 THEN {r4(f'count_if({c} IS NULL) / count(*)')} ELSE 0.0 END AS null_rate_{c}"
        for c in ["passenger_count", "pickup_location_id", "dropoff_location_id", "trip_distance",
                  "fare_amount", "tip_amount", "total_amount", "trip_duration_min", "avg_speed_mph"])
    ranges = ", ".join(
        f"CAST(min({c}) AS DOUBLE) AS min_{c}, CAST(max({c}) AS DOUBLE) AS max_{c}"
        for c in ["trip_distance", "fare_amount", "tip_amount", "total_amount",
                  "trip_duration_min", "avg_speed_mph"])
    dup_key = "fleet, pickup_datetime, pickup_location_id, dropoff_location_id, fare_amount"
    q["quality_metrics"] = with_base(f"""
SELECT count(*) AS row_count, min(pickup_date) AS date_min, max(pickup_date) AS date_max, {nulls}, {ranges},
       (SELECT count(*) FROM (SELECT {dup_key} FROM clean GROUP BY ALL HAVING count(*) > 1)) AS duplicate_groups
FROM clean""")
    q["duplicate_groups"] = with_base(
        "SELECT fleet, pickup_location_id, dropoff_location_id, fare_amount, count(*) AS n FROM featured GROUP BY ALL HAVING count(*) > 1",
        FEATURED)
    q["contract_failures"] = with_base(contract_sql(), FEATURED)
    q["contract_errors"] = with_base(
        "SELECT check_name, CAST(sum(failures) AS BIGINT) AS n FROM (" + contract_sql() + ") c "
        "WHERE failures > 0 GROUP BY check_name", FEATURED)
    q["landed_trips"] = with_base("""
SELECT fleet, pickup_datetime, dropoff_datetime, pickup_location_id, dropoff_location_id, passenger_count, trip_distance,
       fare_amount, tip_amount, total_amount, payment_type
FROM raw""")
    raw_columns = ("fleet, pickup_datetime, dropoff_datetime, pickup_location_id, dropoff_location_id, passenger_count, trip_distance, "
                   "fare_amount, tip_amount, total_amount, payment_type")
    landed = f"""
landed AS (SELECT {raw_columns}, CASE WHEN pickup_datetime < TIMESTAMP '2024-01-16' THEN '2024-01' ELSE '2024-02' END AS landed_month FROM raw),
filed AS (SELECT *, row_number() OVER (PARTITION BY fleet, landed_month ORDER BY pickup_datetime, dropoff_datetime, pickup_location_id, dropoff_location_id,
                                       passenger_count NULLS FIRST, trip_distance, fare_amount, tip_amount, total_amount, payment_type) - 1 AS place,
                 count(*) OVER (PARTITION BY fleet, landed_month) AS n
          FROM landed),
steps AS (SELECT n, min(step) AS step
          FROM (SELECT n, unnest(range(greatest(1, CAST(floor(n * 0.6180339887498949::DOUBLE) AS BIGINT)), n + 2)) AS step FROM (SELECT DISTINCT n FROM filed) d) c
          WHERE gcd(step, n) = 1 GROUP BY n)"""
    q["landed_sample"] = with_base(f"SELECT {raw_columns}, landed_month FROM filed JOIN steps USING (n) WHERE place * step % n < 400", landed)
    q["landing_manifest"] = with_base("""
SELECT fleet, landed_month AS month, fleet || '_tripdata_' || landed_month || '.parquet' AS file, 'landing' AS source, count(*) AS rows, true AS has_bytes
FROM landed GROUP BY fleet, landed_month""", landed)
    q["staged_window"] = with_base("SELECT * FROM clean")
    q["export_manifest"] = with_base("""
SELECT 'daily' AS "table", count(*) AS rows, 'fleet,date,weekday_name,is_weekend,rides,revenue,avg_fare,avg_distance' AS columns, 'parquet,csv' AS formats FROM daily
UNION ALL SELECT 'hourly', count(*), 'fleet,weekday,weekday_name,hour,rides,n_days,avg_rides_per_day', 'parquet' FROM hourly
UNION ALL SELECT 'zones', count(*), 'location_id,zone,borough,lat,lng,pickups,total_revenue,avg_fare,avg_distance,avg_duration_min', 'parquet,csv' FROM zones""",
                                   HOURLY_VOLUME + "," + DAILY_VOLUME + f", zones AS ({ZONE_DEMAND})")
    q["exported_daily"] = with_base("SELECT * FROM daily", DAILY_VOLUME)
    q["catalog_counts"] = with_base("""
SELECT 'shown_daily' AS "table", count(*) AS rows FROM daily UNION ALL SELECT 'shown_zones', count(*) FROM zones""", DAILY_VOLUME + f", zones AS ({ZONE_DEMAND})")
    q["calendar_rollup"] = with_base("""
SELECT CASE fleet WHEN 'yellow' THEN 'Yellow' WHEN 'green' THEN 'Green' END AS fleet_name, year, month_name, week_start,
       CASE WHEN pickup_hour < 6 THEN 'Overnight' WHEN pickup_hour < 10 THEN 'Morning' WHEN pickup_hour < 16 THEN 'Midday'
            WHEN pickup_hour < 20 THEN 'Evening' ELSE 'Night' END AS day_part,
       is_rush_hour, count(*) AS rides, sum(total_amount) AS revenue
FROM fact JOIN dim_date USING (date_key)
GROUP BY ALL""")
    q["sampled_trips"] = with_base(sample_sql())

    sc = series_ctes(s)
    q["hourly_series"] = with_base("SELECT fleet, ds, y FROM series", sc)
    q["design_matrix"] = with_base(f"""
SELECT fleet, ds, y, CAST(hour(ds) AS BIGINT) AS hour, CAST(isodow(ds) - 1 AS BIGINT) AS dow,
       CAST(isodow(ds) >= 6 AS BIGINT) AS is_weekend,
       CAST(date_diff('hour', min(ds) OVER (PARTITION BY fleet), ds) AS DOUBLE) AS trend,
       {fourier_sql('hour(ds)', 24, 4, 'd')},
       {fourier_sql('((isodow(ds) - 1) * 24 + hour(ds))', 168, 6, 'w')},
       lag(y, 168) OVER (PARTITION BY fleet ORDER BY ds) AS lag_168,
       lag(y, 336) OVER (PARTITION BY fleet ORDER BY ds) AS lag_336
FROM series""", sc)
    q["seasonal_naive"] = with_base("SELECT * FROM naive", sc)
    q["naive_metrics"] = with_base(
        f"SELECT fleet, 'seasonal_naive' AS model, {metrics_sql()} FROM naive GROUP BY fleet", sc)
    q["naive_backtest"] = with_base(f"""
SELECT fleet, 'seasonal_naive' AS model, {', '.join(fold_mean(m) for m in ('MAE', 'RMSE', 'MAPE', 'sMAPE'))}
FROM (SELECT p.fleet, f.fold, {metrics_sql('y', 'yhat')}
      FROM elig p JOIN folds f ON p.fleet = f.fleet AND p.t >= f.cut AND p.t < f.cut + {s.forecast.horizon}
      GROUP BY p.fleet, f.fold) per_fold
GROUP BY fleet""", sc)

    reasons = ", ".join(f"CASE WHEN coalesce({p}, false) THEN '{n}' END" for n, p in RULES_SQL.items())
    q["anomaly_rules"] = with_base(f"""
SELECT fleet, pickup_location_id, dropoff_location_id, {FEATURES_SQL}, concat_ws(',', {reasons}) AS rules
FROM featured WHERE {FEATURES_NOT_NULL}""", FEATURED)
    q["anomaly_rule_summary"] = with_base("\nUNION ALL ".join(
        f"SELECT '{n}' AS rule, CAST(count_if(coalesce({p}, false)) AS BIGINT) AS count FROM featured "
        f"WHERE {FEATURES_NOT_NULL}"
        for n, p in RULES_SQL.items()), FEATURED)

    # The model-side tables from a model and a score that SQL can repeat.
    test = s.forecast.test_days * 24
    plain = sc + f""",
mean2 AS (SELECT *, (lag(y, 168) OVER w + lag(y, 336) OVER w) / 2 AS p2 FROM elig WINDOW w AS (PARTITION BY fleet ORDER BY ds)),
spread AS (SELECT fleet, stddev_pop(y - p2) AS sigma FROM mean2 WHERE t < n - {test} AND p2 IS NOT NULL GROUP BY fleet),
pf AS (SELECT m.fleet, ds, y AS y_actual, greatest(p2, 0.0) AS yhat, greatest(greatest(p2, 0.0) - 1.96 * sigma, 0.0) AS yhat_lower,
              greatest(p2, 0.0) + 1.96 * sigma AS yhat_upper
       FROM mean2 m JOIN spread USING (fleet) WHERE t >= n - {test}),
pm AS (SELECT fleet, 'two_week_mean' AS model, {metrics_sql()} FROM pf GROUP BY fleet
       UNION ALL SELECT fleet, 'seasonal_naive', {metrics_sql()} FROM naive GROUP BY fleet),
tested AS (SELECT p.fleet, f.fold, p.y, p.yhat, greatest(p.p2, 0.0) AS p2
           FROM mean2 p JOIN folds f ON p.fleet = f.fleet AND p.t >= f.cut AND p.t < f.cut + {s.forecast.horizon}),
per_fold AS (SELECT fleet, 'two_week_mean' AS model, fold, {metrics_sql('y', 'p2')} FROM tested GROUP BY fleet, fold
             UNION ALL SELECT fleet, 'seasonal_naive', fold, {metrics_sql('y', 'yhat')} FROM tested GROUP BY fleet, fold)"""
    band = f"fleet, ds, y_actual, yhat, {rn('yhat_lower', 6)} AS yhat_lower, {rn('yhat_upper', 6)} AS yhat_upper"
    q["plain_forecast"] = with_base(f"SELECT {band} FROM pf", plain)
    q["plain_forecast_band"] = with_base(f"SELECT {band} FROM pf WHERE fleet = 'yellow' ORDER BY ds", plain)
    q["plain_forecast_metrics"] = with_base("SELECT * FROM pm", plain)
    q["plain_forecast_backtest"] = with_base(
        f"SELECT fleet, model, {', '.join(fold_mean(m) for m in ('MAE', 'RMSE', 'MAPE', 'sMAPE'))} FROM per_fold GROUP BY fleet, model", plain)
    q["plain_best_model"] = with_base("""
SELECT fleet, model, RMSE, MAPE FROM (SELECT *, row_number() OVER (PARTITION BY fleet ORDER BY RMSE, model) AS place FROM pm) r
WHERE place = 1""", plain)
    q["plain_forecast_error"] = with_base("""
SELECT fleet, avg(abs(yhat - y_actual)) AS MAE, avg(CASE WHEN y_actual > 0 THEN abs((yhat - y_actual) / y_actual) END) * 100 AS MAPE,
       avg(yhat - y_actual) AS bias
FROM pf GROUP BY fleet""", plain)

    names = [c.strip() for c in FEATURES_SQL.split(",")]
    zs = ", ".join(f"abs(({c} - avg({c}) OVER ()) / CASE WHEN stddev_pop({c}) OVER () = 0 THEN 1 ELSE stddev_pop({c}) OVER () END)" for c in names)
    numbered = f"""
numbered AS (SELECT row_number() OVER (ORDER BY {FACT_ORDER}) AS trip_id, * FROM fact),
usable AS (SELECT * FROM numbered WHERE {FEATURES_NOT_NULL})"""
    flags = f"""
scores AS (SELECT trip_id, fleet, pickup_location_id, dropoff_location_id, {FEATURES_SQL}, anomaly_score, concat_ws(',', {reasons}) AS rules FROM rated),
marked AS (SELECT *, anomaly_score > (SELECT quantile_cont(anomaly_score, 0.99) FROM scores) AS iso_outlier FROM scores),
flagged AS (SELECT *, iso_outlier OR rules <> '' AS is_anomaly FROM marked)"""
    scored = numbered + f",\nrated AS (SELECT *, greatest({zs}) AS anomaly_score FROM usable)," + flags
    forest = numbered + "," + forest_ctes(s, names, "usable") + ",\nrated AS (SELECT * FROM usable JOIN forest USING (trip_id))," + flags
    mart = (f"SELECT trip_id, fleet, pickup_location_id, dropoff_location_id, {FEATURES_SQL}, {rn('anomaly_score', 6)} AS anomaly_score, "
            "rules, iso_outlier, is_anomaly FROM flagged WHERE is_anomaly")
    scatter = f"SELECT trip_id, fleet, trip_distance, fare_amount, {rn('anomaly_score', 6)} AS anomaly_score, rules FROM flagged WHERE is_anomaly"
    summary = f"""
SELECT count(*) AS sampled, CAST(count_if(is_anomaly) AS BIGINT) AS anomalies, {r4('count_if(is_anomaly) / count(*)')} AS anomaly_rate,
       (SELECT count(*) FROM fact) AS fact_rows, count_if(is_anomaly) / (SELECT count(*) FROM fact) AS anomaly_rate_of_fact
FROM flagged"""
    q["plain_anomalies"] = with_base(mart, scored)
    q["plain_top_anomalies"] = with_base(mart + " ORDER BY flagged.anomaly_score DESC, trip_id LIMIT 100", scored)
    q["plain_anomaly_scatter"] = with_base(scatter, scored)
    q["plain_anomaly_summary"] = with_base(summary, scored)
    q["plain_anomaly_rules"] = with_base("\nUNION ALL ".join(
        f"SELECT '{n}' AS rule, CAST(count_if(coalesce({p}, false)) AS BIGINT) AS count FROM flagged" for n, p in RULES_SQL.items()), scored)
    q["mart_trip_anomalies"] = with_base(mart, forest)
    q["anomaly_scatter"] = with_base(scatter, forest)
    q["anomaly_summary"] = with_base(summary, forest)

    q["kpis"] = with_base("""
SELECT count(*) AS total_trips, sum(total_amount) AS total_revenue,
       sum(tip_amount) / NULLIF(sum(fare_amount), 0) AS tip_rate,
       avg(CAST(is_rush_hour AS INTEGER)) AS rush_hour_share
FROM fact""")
    fleets = ", ".join(f"'{f}'" for f in s.ingest.fleets)
    q["week_over_week"] = with_base(f"""
SELECT fleet, date, rides, rides_7d,
       lag(rides_7d, 7) OVER (PARTITION BY fleet ORDER BY date) AS rides_prev_7d,
       CAST(rides_7d AS DOUBLE) / NULLIF(lag(rides_7d, 7) OVER (PARTITION BY fleet ORDER BY date), 0) - 1
         AS wow_change
FROM (SELECT fleet, date, rides,
             CAST(sum(rides) OVER (PARTITION BY fleet ORDER BY date
                                   ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS BIGINT) AS rides_7d
      FROM (SELECT sp.fleet, sp.date, coalesce(dn.n, 0) AS rides
            FROM (SELECT unnest([{fleets}]) AS fleet, date_key, date FROM dim_date) sp
            LEFT JOIN (SELECT fleet, date_key, count(*) AS n FROM fact GROUP BY ALL) dn
              USING (fleet, date_key)) s) w""")
    q["distance_bands"] = with_base("""
SELECT distance_band, band_min_miles, count(*) AS trips, count(*) / sum(count(*)) OVER () AS share
FROM (SELECT CASE WHEN trip_distance < 1 THEN '<1' WHEN trip_distance < 3 THEN '1-3'
                  WHEN trip_distance < 5 THEN '3-5' WHEN trip_distance < 10 THEN '5-10'
                  WHEN trip_distance >= 10 THEN '10+' END AS distance_band,
             CASE WHEN trip_distance < 1 THEN 0.0 WHEN trip_distance < 3 THEN 1.0
                  WHEN trip_distance < 5 THEN 3.0 WHEN trip_distance < 10 THEN 5.0
                  WHEN trip_distance >= 10 THEN 10.0 END::DOUBLE AS band_min_miles
      FROM fact) b
GROUP BY ALL""")
    q["net_flow"] = with_base(f"""
SELECT coalesce(z.location_id, f.location_id) AS location_id, z.zone, z.borough,
       coalesce(f.pickups, 0) AS pickups, coalesce(f.dropoffs, 0) AS dropoffs,
       coalesce(f.pickups, 0) - coalesce(f.dropoffs, 0) AS net_flow,
       {r2('f.fare')} AS avg_dropoff_fare
FROM dim_zone z FULL JOIN (
  SELECT location_id, CAST(sum(p) AS BIGINT) AS pickups, CAST(sum(d) AS BIGINT) AS dropoffs,
         avg(fare) AS fare
  FROM (SELECT pickup_location_id AS location_id, 1 AS p, 0 AS d, CAST(NULL AS DOUBLE) AS fare FROM fact
        UNION ALL
        SELECT dropoff_location_id, 0, 1, fare_amount FROM fact) r
  GROUP BY location_id) f ON z.location_id = f.location_id""")
    return q
