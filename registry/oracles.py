"""SQL the registered queries are checked with.

Written for DuckDB on the plain test tables.  The formulas of the adapter and
of every operator are stated here a second time, independently of the Spark
code, as a chain of common table expressions.
"""

from __future__ import annotations

from registry.adapter import AS_OF, DAY_SHIFT

# Federal holidays by calendar date, stated independently of the engine.
_HOLIDAYS = [
    "2025-01-01", "2025-01-20", "2025-02-17", "2025-05-26", "2025-06-19", "2025-07-04",
    "2025-09-01", "2025-10-13", "2025-11-11", "2025-11-27", "2025-12-25",
    "2026-01-01", "2026-01-19", "2026-02-16", "2026-05-25", "2026-06-19", "2026-07-04",
    "2026-09-07", "2026-10-12", "2026-11-11", "2026-11-26", "2026-12-25",
    "2027-01-01", "2027-01-18", "2027-02-15", "2027-05-31", "2027-06-19", "2027-07-04",
    "2027-09-06", "2027-10-11", "2027-11-11", "2027-11-25", "2027-12-25",
]

# name -> (tables it reads, SQL body); insertion order is dependency order.
_VIEWS: dict[str, str] = {}


def _double(text: str) -> str:
    return f"CAST('{text}' AS DOUBLE)"


def exact_round(x: str, digits: int) -> str:
    """Half-even rounding of the exact binary value of ``x``."""
    s = f"1e{digits}"
    product, head = f"({x}) * {s}", f"(({x}) * 134217729e0 - (({x}) * 134217729e0 - ({x})))"
    error = f"(({head} * {s} - {product}) + (({x}) - {head}) * {s})"
    tie = f"{product} - floor({product}) = 0.5e0"
    return (
        f"(CASE WHEN {tie} AND {error} > 0 THEN floor({product}) + 1e0 "
        f"WHEN {tie} AND {error} < 0 THEN floor({product}) "
        f"ELSE round_even({product}, 0) END / {s})"
    )


def scaled_round(x: str, digits: int) -> str:
    return f"(round_even(({x}) * 1e{digits}, 0) / 1e{digits})"


def comparable(x: str, digits: int = 9) -> str:
    return f"({scaled_round(x, digits)} + 0e0)"


# Adapter

_LAT = "((({s}) % 200 + 4050) / 100e0)"
_LNG = "((({s}) // 200 - 7400) / 100e0)"


def _lat(s: str) -> str:
    return _LAT.format(s=s)


def _lng(s: str) -> str:
    return _LNG.format(s=s)


_VIEWS["ev"] = f"""
SELECT event_id AS e, user_id AS u, event_type, ts + INTERVAL {DAY_SHIFT} DAY AS started FROM events"""

_VIEWS["ends"] = """
SELECT *,
  CASE WHEN e % 50 = 0 THEN NULL WHEN e % 5 = 2 THEN u + 20 ELSE u % 20 END AS ss,
  CASE WHEN e % 50 = 25 THEN NULL WHEN e % 5 = 3 THEN u + 20 ELSE (u * 7 + e) % 20 END AS es
FROM ev"""

_VIEWS["copies"] = """
SELECT ends.*, started + to_seconds(c.copy) AS t0, started + to_seconds(c.copy) + to_seconds(e % 3600) AS t1
FROM ends JOIN (VALUES (0), (1)) c(copy) ON c.copy = 0 OR e % 40 = 1"""

_TRIP_REST = f"""
  'Station ' || ss AS start_station_name, ss || '.10' AS start_station_id,
  'Station ' || es AS end_station_name, es || '.10' AS end_station_id,
  {_lat('ss')} AS start_lat, {_lng('ss')} AS start_lng,
  {_lat('es')} AS end_lat, {_lng('es')} AS end_lng,
  CASE WHEN u % 3 = 0 THEN 'casual' ELSE 'member' END AS member_casual
FROM copies"""

_KIND = "CASE WHEN event_type = 'click' THEN 'electric_bike' ELSE 'classic_bike' END AS rideable_type"

_VIEWS["raw_text"] = f"""
SELECT CAST(e AS VARCHAR) AS ride_id, {_KIND},
  CASE WHEN e % 250 = 99 THEN strftime(t0, '%Y-%m-%d %H:%M') ELSE strftime(t0, '%Y-%m-%d %H:%M:%S.%g') END AS started_at,
  CASE WHEN e % 250 = 33 THEN 'unknown' ELSE strftime(t1, '%Y-%m-%d %H:%M:%S.%g') END AS ended_at,
{_TRIP_REST}"""

_VIEWS["raw"] = f"""
SELECT CAST(e AS VARCHAR) AS ride_id, {_KIND},
  CASE WHEN e % 250 = 99 THEN NULL ELSE date_trunc('millisecond', t0) END AS started_at,
  CASE WHEN e % 250 = 33 THEN NULL ELSE date_trunc('millisecond', t1) END AS ended_at,
{_TRIP_REST}"""

_VIEWS["dedup"] = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY ride_id ORDER BY started_at NULLS LAST, ended_at NULLS LAST,
    start_station_id NULLS LAST, end_station_id NULLS LAST, rideable_type, member_casual) AS rn
  FROM raw) WHERE rn = 1"""

_VIEWS["clean"] = """
SELECT * FROM dedup WHERE start_station_id IS NOT NULL AND end_station_id IS NOT NULL"""

_VIEWS["station"] = """
SELECT station_id, min(name) AS name, min(latitude) AS latitude, min(longitude) AS longitude FROM (
  SELECT start_station_id AS station_id, start_station_name AS name, start_lat AS latitude, start_lng AS longitude FROM clean
  UNION ALL
  SELECT end_station_id, end_station_name, end_lat, end_lng FROM clean)
GROUP BY station_id"""

_VIEWS["trip_event"] = """
SELECT started_at AS event_time, start_station_id AS station_id,
  CAST(1 AS INTEGER) AS bike_departure, CAST(0 AS INTEGER) AS bike_arrival,
  CAST(CASE WHEN rideable_type = 'electric_bike' THEN 1 ELSE 0 END AS INTEGER) AS is_electric,
  CAST(CASE WHEN member_casual = 'member' THEN 1 ELSE 0 END AS INTEGER) AS is_member,
  CAST(floor(epoch(ended_at)) - floor(epoch(started_at)) AS DOUBLE) AS trip_duration_sec
FROM clean
UNION ALL
SELECT ended_at, end_station_id, 0, 1, 0, 0, 0e0 FROM clean"""

_VIEWS["hourly_sum"] = """
SELECT station_id, date_trunc('hour', event_time) AS event_hour,
  CAST(sum(bike_departure) AS BIGINT) AS bike_demand, CAST(sum(bike_arrival) AS BIGINT) AS dock_demand,
  CAST(sum(is_electric) AS BIGINT) AS electric_count, CAST(sum(is_member) AS BIGINT) AS member_count,
  sum(trip_duration_sec) AS total_duration_sec
FROM trip_event WHERE event_time IS NOT NULL GROUP BY ALL"""

_VIEWS["hourly"] = """
SELECT station_id, event_hour, bike_demand, dock_demand,
  CASE WHEN bike_demand > 0 THEN CAST(electric_count AS DOUBLE) / bike_demand ELSE 0e0 END AS electric_ratio,
  CASE WHEN bike_demand > 0 THEN CAST(member_count AS DOUBLE) / bike_demand ELSE 0e0 END AS member_ratio,
  CASE WHEN bike_demand > 0 THEN total_duration_sec / bike_demand / 60e0 ELSE 0e0 END AS avg_trip_duration_min
FROM hourly_sum"""

_VIEWS["feed_all"] = f"""
WITH s AS (SELECT DISTINCT unnest([ss, es]) AS s FROM ends),
base AS (
  SELECT s, 'F' || lpad(CAST(s AS VARCHAR), 7, '0') AS code, 'Dock ' || s AS name,
    {_lat('s')} + CASE s % 4 WHEN 1 THEN 5e-4 WHEN 3 THEN 5e-3 ELSE 0e0 END AS lat,
    {_lng('s')} + CASE s % 4 WHEN 2 THEN 95e-5 ELSE 0e0 END AS lon,
    CASE WHEN s % 8 <> 0 THEN s % 6 + 2 END AS capacity
  FROM s WHERE s IS NOT NULL)
SELECT code AS feed_id, name, lat, lon, capacity FROM base
UNION ALL SELECT code || 'b', name, lat, lon, 9 FROM base WHERE s % 5 = 0
UNION ALL SELECT code || 'c', name, lat + 3e-4, lon, 11 FROM base WHERE s % 5 = 1
UNION ALL SELECT code || 'd', name, 0e0, lon, 5 FROM base WHERE s % 10 = 3"""

_VIEWS["feed"] = """
SELECT feed_id, name, lat, lon, CAST(coalesce(capacity, 0) AS INTEGER) AS capacity
FROM feed_all WHERE lat IS NOT NULL AND lon IS NOT NULL AND lat <> 0 AND lon <> 0"""

_VIEWS["weather"] = """
SELECT date, CAST(day(date) - 5 AS DOUBLE) AS temp_c, CAST(day(date) % 4 AS DOUBLE) AS precip_mm,
  CAST(day(date) % 9 + 10 AS DOUBLE) AS wind_kmh
FROM (SELECT DISTINCT CAST(started AS DATE) AS date FROM ev) WHERE day(date) % 7 <> 0"""


def haversine(lat1: str, lng1: str, lat2: str, lng2: str) -> str:
    a = (
        f"(pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) "
        f"* pow(sin(radians({lng2} - {lng1}) / 2), 2))"
    )
    return f"(asin(sqrt({a})) * 12742000e0)"


# The nearest feed station by brute force over all of them.
_VIEWS["match"] = f"""
WITH ranked AS (
  SELECT s.station_id, f.*, sqrt((f.lat - s.latitude) * (f.lat - s.latitude)
      + (f.lon - s.longitude) * (f.lon - s.longitude)) AS deg,
    {haversine('s.latitude', 's.longitude', 'f.lat', 'f.lon')} AS metres,
    row_number() OVER (PARTITION BY s.station_id ORDER BY sqrt((f.lat - s.latitude) * (f.lat - s.latitude)
      + (f.lon - s.longitude) * (f.lon - s.longitude)), f.feed_id) AS rn
  FROM station s CROSS JOIN feed f)
SELECT s.station_id, CAST(coalesce(r.capacity, 0) AS INTEGER) AS capacity, r.station_id IS NOT NULL AS matched
FROM station s LEFT JOIN ranked r
  ON r.station_id = s.station_id AND r.rn = 1 AND r.deg <= 100e0 / 111000e0 AND r.metres <= 100e0"""

_VIEWS["holiday"] = "SELECT * FROM (VALUES " + ", ".join(f"(DATE '{d}')" for d in _HOLIDAYS) + ") h(holiday_date)"

_CALENDAR = """
  CAST(year(event_hour) AS INTEGER) AS year, CAST(month(event_hour) AS INTEGER) AS month,
  CAST(day(event_hour) AS INTEGER) AS day, CAST(dayofweek(event_hour) + 1 AS INTEGER) AS weekday,
  CAST(weekofyear(event_hour) AS INTEGER) AS weekofyear, CAST(dayofyear(event_hour) AS INTEGER) AS dayofyear,
  CAST(hour(event_hour) AS INTEGER) AS hour,
  CAST(CASE WHEN dayofweek(event_hour) IN (0, 6) THEN 1 ELSE 0 END AS INTEGER) AS is_weekend,
  CAST(CASE WHEN hour(event_hour) IN (7, 8, 9, 17, 18, 19) THEN 1 ELSE 0 END AS INTEGER) AS is_rush_hour"""

_ANGLES = {
    "hour_sin": "sin(2 * pi() * hour(event_hour) / 24)",
    "hour_cos": "cos(2 * pi() * hour(event_hour) / 24)",
    "weekday_sin": "sin(2 * pi() * (dayofweek(event_hour) + 1) / 7)",
    "weekday_cos": "cos(2 * pi() * (dayofweek(event_hour) + 1) / 7)",
}
_CYCLES = ", ".join(f"{comparable(x)} AS {name}" for name, x in _ANGLES.items())
_CYCLES_FULL = ", ".join(f"{x} AS {name}" for name, x in _ANGLES.items())

_SILVER = """
SELECT h.*, {calendar}, {cycles},
  CAST(CASE WHEN d.holiday_date IS NULL THEN 0 ELSE 1 END AS INTEGER) AS is_holiday,
  coalesce(m.capacity, 0) AS capacity, w.temp_c, w.precip_mm, w.wind_kmh
FROM hourly h
LEFT JOIN holiday d ON CAST(h.event_hour AS DATE) = d.holiday_date
LEFT JOIN match m ON m.station_id = h.station_id
LEFT JOIN weather w ON w.date = CAST(h.event_hour AS DATE)"""
_VIEWS["silver"] = _SILVER.format(calendar=_CALENDAR, cycles=_CYCLES_FULL)

# Pricing

_STOCK = """
  CAST(CASE WHEN capacity <= 0 THEN 15 ELSE greatest(1, capacity // 2) END AS INTEGER) AS available_bikes,
  CAST(CASE WHEN capacity <= 0 THEN 15
    ELSE greatest(1, capacity - greatest(1, capacity // 2)) END AS INTEGER) AS available_docks"""


def multiplier(both_short: str) -> str:
    return f"""CASE
    WHEN b < -0.5e0 AND d < -0.5e0 THEN least({both_short}, 2e0)
    WHEN b < -0.3e0 THEN least(1e0 + abs(b) * 0.6e0, 1.5e0)
    WHEN d < -0.3e0 THEN least(1e0 + abs(d) * 0.4e0, 1.3e0)
    WHEN b > 0.5e0 AND d > 0.5e0 THEN greatest(1e0 - least(b, d) * 0.25e0, 0.7e0)
    WHEN b > 0.5e0 THEN greatest(1e0 - b * 0.15e0, 0.8e0)
    ELSE 1e0 END"""


_RATIO = """
  CAST(bike_gap AS DOUBLE) / greatest(available_bikes, 1) AS b,
  CAST(dock_gap AS DOUBLE) / greatest(available_docks, 1) AS d"""

_VIEWS["priced"] = f"""
WITH stock AS (SELECT station_id, event_hour, bike_demand, dock_demand, capacity, {_STOCK} FROM silver),
gap AS (SELECT *, available_bikes - bike_demand AS bike_gap, available_docks - dock_demand AS dock_gap FROM stock),
ratio AS (SELECT *, {_RATIO} FROM gap),
factor AS (SELECT *, {multiplier('1.3e0 + (abs(b) + abs(d)) * 0.5e0')} AS m FROM ratio),
priced AS (SELECT * EXCLUDE (b, d, m), {exact_round('m', 2)} AS pricing_multiplier FROM factor)
SELECT *, {scaled_round('pricing_multiplier * 4.49e0', 2)} AS suggested_price,
  CASE WHEN pricing_multiplier > 1.2e0 THEN 'Surge' WHEN pricing_multiplier > 1e0 THEN 'Mild Surge'
    WHEN pricing_multiplier < 0.9e0 THEN 'Discount' ELSE 'Normal' END AS pricing_zone
FROM priced"""


def decision(source: str, columns: str, extra: str = "") -> str:
    """The decision rule over a table with predicted demand p, q and stock."""

    def number(x: str) -> str:
        return f"CAST(CAST(round_even({x}, 0) AS BIGINT) AS VARCHAR)"

    return f"""
WITH gap AS (SELECT *, available_bikes - p AS bike_gap, available_docks - q AS dock_gap FROM {source}),
ratio AS (SELECT *, {_RATIO} FROM gap),
factor AS (SELECT *, {multiplier('1.3e0 + abs(b + d) / 2 * 0.7e0')} AS m FROM ratio),
final AS (SELECT *, {exact_round('m', 2)} AS pricing_multiplier FROM factor),
decided AS (SELECT * EXCLUDE (bike_gap, dock_gap),
  {exact_round('p', 1)} AS predicted_bike_demand, {exact_round('q', 1)} AS predicted_dock_demand,
  CAST(round_even(bike_gap, 0) AS BIGINT) AS bike_gap, CAST(round_even(dock_gap, 0) AS BIGINT) AS dock_gap,
  {exact_round('4.49e0 * pricing_multiplier', 2)} AS suggested_price_usd,
  CASE WHEN b < -0.3e0 THEN 'Surge' WHEN d < -0.3e0 THEN 'Mild Surge'
    WHEN b > 0.5e0 THEN 'Discount' ELSE 'Normal' END AS pricing_zone,
  CASE
    WHEN b < -0.5e0 AND d < -0.5e0 THEN 'Double shortage: bikes ' || {number('-bike_gap')} || ' short, docks '
      || {number('-dock_gap')} || ' short. Heavy surge applied.'
    WHEN b < -0.3e0 THEN 'Bike shortage: predicted demand exceeds supply by ' || {number('-bike_gap')}
      || '. Surge applied to encourage nearby station use.'
    WHEN d < -0.3e0 THEN 'Dock congestion: predicted returns exceed empty docks by ' || {number('-dock_gap')}
      || '. Mild surge to discourage returns here.'
    WHEN b > 0.5e0 AND d > 0.5e0
      THEN 'Double surplus: bikes and docks both abundant. Discount applied to attract riders.'
    WHEN b > 0.5e0 THEN 'Bike surplus: ' || {number('bike_gap')} || ' extra bikes. Mild discount to encourage use.'
    ELSE 'Supply and demand balanced. Standard pricing.' END AS reason
  FROM final)
SELECT {columns} FROM decided {extra}"""


# Serving

_VIEWS["request"] = """
SELECT e AS request_id,
  CASE WHEN e % 3 = 0 THEN '7.10' WHEN e % 10 = 4 THEN 'nowhere' ELSE (u * 3 % 23) || '.10' END AS station_id,
  CASE WHEN e % 97 = 5 THEN 'tomorrow' WHEN e % 3 = 0 THEN '2026-01-15 08:00'
    WHEN e % 101 = 7 THEN strftime(started + INTERVAL 1 HOUR, '%Y-%-m-%-d %-H:%-M')
    ELSE strftime(started + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M') END AS timestamp,
  CASE WHEN e % 97 = 5 THEN NULL WHEN e % 3 = 0 THEN TIMESTAMP '2026-01-15 08:00:00'
    ELSE date_trunc('minute', started + INTERVAL 1 HOUR) END AS asked_at,
  CAST(CASE WHEN e % 20 = 19 THEN 15 ELSE e % 20 END AS INTEGER) AS available_bikes,
  CAST(CASE WHEN e // 3 % 17 = 16 THEN 15 ELSE e // 3 % 17 END AS INTEGER) AS available_docks
FROM ev"""

_VIEWS["by_hour"] = """
SELECT hour(event_hour) AS hour_of_day, avg(bike_demand) AS hour_bikes, avg(dock_demand) AS hour_docks
FROM hourly GROUP BY ALL"""

_VIEWS["forecast_request"] = """
SELECT DISTINCT u AS request_id, CASE WHEN u % 9 = 4 THEN 'nowhere' ELSE (u % 25) || '.10' END AS station_id,
  CASE WHEN u % 13 = 5 THEN 50 ELSE u % 30 + 10 END AS capacity,
  CASE WHEN u % 18 = 17 THEN 15 ELSE u % 18 END AS start_bikes, CAST(15 AS BIGINT) AS start_docks
FROM ev"""

_LEVEL = "CASE WHEN hour({t}) IN (7, 8, 9, 17, 18, 19) THEN 25e0 ELSE 10e0 END"


def heuristic(t: str) -> str:
    level = _LEVEL.format(t=t)
    return f"(CASE WHEN dayofweek({t}) IN (0, 6) THEN ({level}) * 0.6e0 ELSE {level} END)"


def lookup(source: str) -> str:
    """p and q for a table with station_id and asked_at."""
    guess = heuristic("r.asked_at")
    return f"""
SELECT r.*, coalesce(CAST(x.bike_demand AS DOUBLE), y.hour_bikes, {guess}) AS p,
  coalesce(CAST(x.dock_demand AS DOUBLE), y.hour_docks, {guess} * 0.9e0) AS q
FROM {source} r
LEFT JOIN hourly x ON x.station_id = r.station_id AND x.event_hour = date_trunc('hour', r.asked_at)
LEFT JOIN by_hour y ON y.hour_of_day = hour(r.asked_at)"""


def walk(source: str, key: str) -> str:
    """Stock before each hour, one row after the other."""
    return f"""
WITH RECURSIVE numbered AS (
  SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY event_hour) AS rn FROM {source}),
walked AS (
  SELECT *, CAST(start_bikes AS BIGINT) AS bikes, CAST(start_docks AS BIGINT) AS docks FROM numbered WHERE rn = 1
  UNION ALL
  SELECT n.*, least(n.capacity, greatest(0, w.bikes - CAST(trunc(w.p) AS BIGINT) + CAST(trunc(w.q) AS BIGINT))),
    n.capacity - least(n.capacity, greatest(0, w.bikes - CAST(trunc(w.p) AS BIGINT) + CAST(trunc(w.q) AS BIGINT)))
  FROM walked w JOIN numbered n ON n.{key} = w.{key} AND n.rn = w.rn + 1)
SELECT *, bikes AS available_bikes, docks AS available_docks FROM walked"""


_VIEWS["forecast_hour"] = f"""
SELECT r.*, h.asked_at, h.asked_at AS event_hour FROM forecast_request r
CROSS JOIN (SELECT unnest(generate_series(date_trunc('hour', TIMESTAMP '{AS_OF}'),
  date_trunc('hour', TIMESTAMP '{AS_OF}') + INTERVAL 23 HOUR, INTERVAL 1 HOUR)) AS asked_at) h"""
_VIEWS["forecast_demand"] = lookup("forecast_hour")
_VIEWS["forecast_walk"] = walk("forecast_demand", "request_id")

_VIEWS["series"] = """
SELECT h.station_id, h.event_hour, h.bike_demand, h.dock_demand, CAST(h.bike_demand AS DOUBLE) AS p,
  CAST(h.dock_demand AS DOUBLE) AS q, CAST(coalesce(nullif(m.capacity, 0), 50) AS BIGINT) AS capacity,
  CAST(coalesce(nullif(m.capacity, 0), 50) // 2 AS BIGINT) AS start_bikes,
  CAST(coalesce(nullif(m.capacity, 0), 50) - coalesce(nullif(m.capacity, 0), 50) // 2 AS BIGINT) AS start_docks
FROM hourly h LEFT JOIN match m ON m.station_id = h.station_id"""
_VIEWS["series_walk"] = walk("series", "station_id")

_VIEWS["station_stat"] = """
SELECT station_id,
  CAST(sum(CAST(round_even(suggested_price * 100e0, 0) AS BIGINT)) AS DOUBLE) / count(*) / 100e0 AS avg_price,
  CAST(sum(CAST(round_even(pricing_multiplier * 100e0, 0) AS BIGINT)) AS DOUBLE) / count(*) / 100e0 AS avg_multiplier,
  CAST(count(*) FILTER (pricing_zone = 'Surge') AS DOUBLE) / count(*) * 100e0 AS surge_pct
FROM priced GROUP BY station_id"""

_KEY_TEXT = "station_id || '|' || strftime(event_hour, '%Y-%m-%d %H:%M:%S')"

_GOLD_FEATURES = [
    "electric_ratio", "member_ratio", "avg_trip_duration_min",
    "month", "day", "weekday", "weekofyear", "dayofyear", "hour", "is_weekend", "is_rush_hour",
    "hour_sin", "hour_cos", "weekday_sin", "weekday_cos", "is_holiday", "capacity",
    "temp_c", "precip_mm", "wind_kmh",
]
_TRAINING_FEATURES = [c for c in _GOLD_FEATURES if c != "capacity"]

_VIEWS["fitted"] = "SELECT *, CASE WHEN md5({key}) < 'cccd' THEN 'train' WHEN md5({key}) < 'e666' THEN 'validation' " \
    "ELSE 'test' END AS part, CASE WHEN md5({key}) < 'cccd' THEN 'train' ELSE 'validation' END AS search_part " \
    "FROM silver WHERE ".format(key=_KEY_TEXT) + " AND ".join(f"{c} IS NOT NULL" for c in _TRAINING_FEATURES)

_VIEWS["assembled"] = "SELECT * FROM silver WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in _GOLD_FEATURES)


_CATEGORY_PLACES = f"""WITH trained AS (SELECT * FROM silver WHERE md5({_KEY_TEXT}) < 'cccd'),
counted AS (
  SELECT 'station_id' AS "column", station_id AS category, count(*) AS rows FROM trained GROUP BY ALL
  UNION ALL SELECT 'hour', CAST(hour AS VARCHAR), count(*) FROM trained GROUP BY ALL),
placed AS (
  SELECT *, CAST(CASE WHEN rows >= 25 THEN row_number() OVER (PARTITION BY "column" ORDER BY rows DESC, category) - 1
    ELSE count(*) FILTER (rows >= 25) OVER (PARTITION BY "column") END AS INTEGER) AS place
  FROM counted)"""


def _using(body: str) -> str:
    """Prefix ``body`` with the views; unused ones cost nothing."""
    views = ",\n".join(f"{name} AS ({sql})" for name, sql in _VIEWS.items())
    if body.lstrip().startswith("WITH "):
        body = f"SELECT * FROM ({body})"
    return f"WITH {views}\n{body}"


_PARSED = "ride_id, started_at, ended_at"
_PRICED = (
    "station_id, event_hour, bike_demand, dock_demand, capacity, available_bikes, available_docks, "
    "bike_gap, dock_gap, pricing_multiplier, suggested_price, pricing_zone"
)
_CLIP = "CAST(least(greatest({c}, 0), 80) AS BIGINT) AS {c}"
_TOP = "SELECT '{side}' AS side, * FROM (SELECT * FROM station_stat ORDER BY avg_multiplier {way}, station_id LIMIT 5)"
_STAT_ROUNDED = (
    f"{scaled_round('avg_price', 2)} AS avg_price, {scaled_round('avg_multiplier', 2)} AS avg_multiplier"
)
_ZONE_CENTS = "CAST(sum(CAST(round_even(suggested_price * 100e0, 0) AS BIGINT)) AS DOUBLE)"
_EDGES = "(1, '<2.5', 0, 2.5), (2, '2.5-3', 2.5, 3), (3, '3-3.5', 3, 3.5), (4, '3.5-4', 3.5, 4), (5, '4-4.5', 4, 4.5), " \
    "(6, '4.5-5', 4.5, 5), (7, '5-5.5', 5, 5.5), (8, '5.5-6', 5.5, 6), (9, '6-7', 6, 7), (10, '>7', 7, 10)"


def _profile(variant: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{variant}' AS variant, {i + 1} AS position, '{c}' AS feature, count({c}) AS value_count FROM silver"
        for i, c in enumerate(columns)
    )


def _standard(column: str) -> str:
    x = f"CAST({column} AS DOUBLE)"
    z = f"CASE WHEN stddev_samp({x}) OVER () = 0 THEN 0e0 ELSE ({x} - avg({x}) OVER ()) / stddev_samp({x}) OVER () END"
    return f"{comparable(z, 6)} AS {column}"


def _slot_value(k: str) -> str:
    """One over the sample deviation of a slot that ``k`` of ``f.n`` rows are in; 0 where all or none are."""
    return f"coalesce(1e0 / sqrt(nullif({k} * (f.n - {k}) / (f.n * (f.n - 1e0)), 0)), 0e0)"


def _summary_facts(kind: str) -> str:
    """What holds for every training run: its rows, five named features, metrics that agree with each other."""
    return f"""
SELECT '{kind}' AS kind, m.model, 'all' AS feature_set,
  (SELECT count(*) FROM fitted WHERE part = 'validation') AS val_rows,
  (SELECT count(*) FROM fitted WHERE part = 'test') AS test_rows,
  CAST(5 AS INTEGER) AS named_features, true AS importances_fall, true AS metrics_agree
FROM (VALUES ('bike_model'), ('dock_model')) m(model)"""


ORACLES: dict[str, str] = {
    name: _using(body)
    for name, body in {
        "scan_trips_csv": "SELECT * FROM raw_text",
        "trips_file_name": "SELECT ride_id, 'csv' AS file_suffix FROM raw_text",
        "ingest_report": """
SELECT (SELECT count(*) FROM raw_text) + (SELECT count(*) FROM ev WHERE e % 70 = 3) AS rows_read,
  (SELECT count(*) FROM raw_text) AS rows_landed,
  (SELECT count(*) FROM ev WHERE e % 70 = 3) AS rows_quarantined,
  (SELECT CAST(sum(e) AS BIGINT) FROM ev WHERE e % 70 = 3) AS rides_quarantined""",
        "scan_parquet": "SELECT * FROM events",
        "write_read_roundtrip": "SELECT station_id, event_hour, bike_demand, dock_demand, "
        "CAST(year(event_hour) AS INTEGER) AS year, CAST(month(event_hour) AS INTEGER) AS month FROM hourly",
        "station_feed": "SELECT * FROM feed",
        "weather_daily": "SELECT CAST(date AS VARCHAR) AS date, temp_c, precip_mm, wind_kmh FROM weather",
        "model_roundtrip": "SELECT count(*) AS rows, true AS same_features FROM assembled",
        "pricing_csv_roundtrip": f"SELECT {_PRICED} FROM priced",
        "parse_timestamps": f"SELECT {_PARSED} FROM raw",
        "drop_missing_station": "SELECT ride_id, start_station_id, end_station_id FROM raw "
        "WHERE start_station_id IS NOT NULL AND end_station_id IS NOT NULL",
        "dedup_rides": "SELECT * FROM dedup",
        "bronze_trips": "SELECT ride_id, rideable_type, started_at, ended_at, start_station_id, "
        "end_station_id, member_casual FROM clean",
        "bronze_report": "SELECT (SELECT count(*) FROM raw) AS input_rows, "
        "(SELECT count(*) FROM clean) AS output_rows, (SELECT count(*) FROM station) AS station_count, "
        "(SELECT count(*) FROM raw WHERE started_at IS NULL OR ended_at IS NULL) AS unreadable_times",
        "station_dim": "SELECT * FROM station",
        "trip_events": "SELECT * FROM trip_event",
        "hourly_demand": "SELECT * FROM hourly_sum",
        "hourly_ratios": "SELECT * FROM hourly",
        "time_features": f"SELECT station_id, event_hour, {_CALENDAR} FROM hourly",
        "cyclic_features": f"SELECT station_id, event_hour, {_CYCLES} FROM hourly",
        "holiday_flag": "SELECT station_id, event_hour, CAST(CAST(event_hour AS DATE) IN "
        "(SELECT holiday_date FROM holiday) AS INTEGER) AS is_holiday FROM hourly",
        "weather_join": "SELECT h.station_id, h.event_hour, w.temp_c, w.precip_mm, w.wind_kmh "
        "FROM hourly h LEFT JOIN weather w ON w.date = CAST(h.event_hour AS DATE)",
        "capacity_join": "SELECT h.station_id, h.event_hour, coalesce(m.capacity, 0) AS capacity "
        "FROM hourly h LEFT JOIN match m ON m.station_id = h.station_id",
        "haversine": "SELECT ride_id, started_at, "
        + comparable(haversine("start_lat", "start_lng", "end_lat", "end_lng"), 4)
        + " AS metres FROM raw_text WHERE start_station_id IS NOT NULL AND end_station_id IS NOT NULL",
        "spatial_capacity": "SELECT * FROM match",
        "silver_hourly": _SILVER.format(calendar=_CALENDAR, cycles=_CYCLES),
        "join_coverage": """
SELECT 'total_rows' AS measure, count(*) AS value FROM silver
UNION ALL SELECT 'weather_matched', count(temp_c) FROM silver
UNION ALL SELECT 'weather_missing', count(*) - count(temp_c) FROM silver
UNION ALL SELECT 'capacity_known', count(*) FILTER (capacity > 0) FROM silver
UNION ALL SELECT 'stations', count(*) FROM match
UNION ALL SELECT 'stations_matched', count(*) FILTER (matched) FROM match
UNION ALL SELECT 'stations_with_capacity', count(*) FILTER (capacity > 0) FROM match""",
        "stock_estimate": f"SELECT station_id, capacity, {_STOCK} FROM match",
        "supply_gap": "SELECT station_id, event_hour, available_bikes, available_docks, bike_gap, dock_gap FROM priced",
        "price_multiplier": "SELECT station_id, event_hour, pricing_multiplier FROM priced",
        "pricing_analysis": f"SELECT {_PRICED} FROM priced",
        "price_decision": decision(
            f"(SELECT station_id, event_hour, {_STOCK}, bike_demand * 1.05e0 AS p, dock_demand * 1.35e0 AS q FROM silver)",
            "station_id, event_hour, available_bikes, available_docks, predicted_bike_demand, predicted_dock_demand, "
            "bike_gap, dock_gap, pricing_multiplier, suggested_price_usd, pricing_zone, reason",
        ),
        "zone_summary": f"""
SELECT z.zone_order, z.pricing_zone, count(p.pricing_zone) AS zone_rows,
  CAST(count(p.pricing_zone) AS DOUBLE) / (SELECT count(*) FROM priced) * 100e0 AS pct,
  {_ZONE_CENTS} / count(p.pricing_zone) / 100e0 AS avg_price
FROM (VALUES (1, 'Surge'), (2, 'Mild Surge'), (3, 'Normal'), (4, 'Discount')) z(zone_order, pricing_zone)
LEFT JOIN priced p ON p.pricing_zone = z.pricing_zone GROUP BY z.zone_order, z.pricing_zone""",
        "zone_counts": "SELECT pricing_zone, count(*) AS zone_rows FROM priced GROUP BY ALL",
        "hourly_profile": f"SELECT CAST(hour(event_hour) AS INTEGER) AS hour, {scaled_round('avg(bike_demand)', 1)} AS bike, "
        f"{scaled_round('avg(dock_demand)', 1)} AS dock FROM priced GROUP BY 1",
        "price_histogram": f"""
SELECT CAST(b.n AS INTEGER) AS bin_order, b.label AS bin_label, CAST(b.lo AS DOUBLE) AS price_over,
  CAST(b.hi AS DOUBLE) AS price_to, count(p.suggested_price) AS bin_rows
FROM (VALUES {_EDGES}) b(n, label, lo, hi)
LEFT JOIN priced p ON p.suggested_price > CAST(b.lo AS DOUBLE) AND p.suggested_price <= CAST(b.hi AS DOUBLE)
GROUP BY ALL""",
        "station_stats": "SELECT * FROM station_stat",
        "hotspots": f"SELECT side, station_id, {exact_round('avg_price', 2)} AS avg_price, "
        f"{exact_round('avg_multiplier', 2)} AS avg_multiplier, {exact_round('surge_pct', 1)} AS surge_pct FROM ("
        + _TOP.format(side="surge", way="DESC") + " UNION ALL " + _TOP.format(side="discount", way="ASC") + ")",
        "top_surge_stations": f"SELECT station_id, {_STAT_ROUNDED} FROM "
        "(SELECT * FROM station_stat ORDER BY avg_multiplier DESC, station_id LIMIT 10)",
        "headline_kpis": "SELECT count(*) AS station_hours, count(DISTINCT station_id) AS stations, "
        + exact_round("CAST(sum(CAST(round_even(pricing_multiplier * 100e0, 0) AS BIGINT)) AS DOUBLE) / count(*) / 100e0", 2)
        + " AS avg_multiplier, "
        + exact_round(f"{_ZONE_CENTS} / count(*) / 100e0", 2) + " AS avg_price FROM priced",
        "demand_scatter": f"SELECT station_id, event_hour, pricing_zone, {_CLIP.format(c='bike_demand')}, "
        f"{_CLIP.format(c='dock_demand')} FROM (SELECT * FROM priced ORDER BY md5({_KEY_TEXT}), station_id, event_hour LIMIT 2000)",
        "demand_heuristic": f"SELECT request_id, {heuristic('asked_at')} AS bike_demand, "
        f"{heuristic('asked_at')} * 0.9e0 AS dock_demand FROM request WHERE asked_at IS NOT NULL",
        "demand_lookup": f"SELECT request_id, station_id, asked_at, {comparable('p')} AS predicted_bike_demand, "
        f"{comparable('q')} AS predicted_dock_demand FROM ({lookup('request')})",
        "price_requests": decision(
            f"({lookup('request')})",
            "request_id, station_id, timestamp, "
            + ", ".join(
                f"CASE WHEN asked_at IS NOT NULL THEN {c} END AS {c}"
                for c in ["predicted_bike_demand", "predicted_dock_demand", "pricing_multiplier",
                          "suggested_price_usd", "pricing_zone", "reason"]
            )
            + ", CASE WHEN asked_at IS NULL THEN 'timestamp must have the format ''yyyy-MM-dd HH:mm''' END AS error",
        ),
        "station_forecast": decision(
            "forecast_walk",
            "request_id, station_id, capacity, strftime(event_hour, '%Y-%m-%d %H:%M') AS timestamp, "
            "predicted_bike_demand, predicted_dock_demand, pricing_multiplier, suggested_price_usd, pricing_zone",
        ),
        "running_stock": "SELECT station_id, event_hour, bike_demand, dock_demand, capacity, "
        "available_bikes, available_docks FROM series_walk",
        "price_series": decision(
            "series_walk",
            "station_id, strftime(event_hour, '%Y-%m-%d %H:%M') AS timestamp, predicted_bike_demand, "
            "predicted_dock_demand, bikes AS available_bikes_now, docks AS available_docks_now, bike_gap, dock_gap, "
            "pricing_multiplier, suggested_price_usd, pricing_zone, reason",
        ),
        "sample_rows": f"SELECT * FROM hourly ORDER BY md5({_KEY_TEXT}), station_id, event_hour LIMIT 5000",
        "stratified_sample": "SELECT * FROM hourly QUALIFY row_number() OVER (PARTITION BY hour(event_hour) "
        f"ORDER BY md5({_KEY_TEXT}), station_id, event_hour) <= 200",
        "great_circle_capacity": f"""
WITH near AS (
  SELECT s.station_id, f.feed_id, f.capacity, {haversine('s.latitude', 's.longitude', 'f.lat', 'f.lon')} AS metres
  FROM station s CROSS JOIN feed f),
best AS (
  SELECT * FROM near WHERE metres <= 100e0
  QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY metres, feed_id) = 1)
SELECT s.station_id, CAST(coalesce(b.capacity, 0) AS INTEGER) AS capacity, b.station_id IS NOT NULL AS matched,
  {comparable('b.metres', 3)} AS metres
FROM station s LEFT JOIN best b ON b.station_id = s.station_id""",
        "split_rows": f"SELECT station_id, event_hour, CASE WHEN md5({_KEY_TEXT}) < 'cccd' THEN 'train' "
        f"WHEN md5({_KEY_TEXT}) < 'e666' THEN 'validation' ELSE 'test' END AS part FROM hourly",
        "feature_columns": _profile("gold", _GOLD_FEATURES) + " UNION ALL " + _profile("training", _TRAINING_FEATURES),
        "assembled_rows": "SELECT (SELECT count(*) FROM silver) AS total_rows, (SELECT count(*) FROM assembled) AS kept_rows, "
        "(SELECT count(*) FROM silver) - (SELECT count(*) FROM assembled) AS dropped_rows",
        "standardized": "SELECT station_id, event_hour, " + ", ".join(_standard(c) for c in _GOLD_FEATURES) + " FROM assembled",
        "category_index": _CATEGORY_PLACES + ' SELECT "column", category, rows, place FROM placed',
        "encoded_categories": _CATEGORY_PLACES + f"""
, sizes AS (
  SELECT CAST(count(*) FILTER (rows >= 25 AND "column" = 'station_id') AS INTEGER) AS stations,
    CAST(count(*) FILTER (rows >= 25 AND "column" = 'hour') AS INTEGER) AS hours,
    (SELECT count(*) FROM trained) AS n FROM placed),
slot AS (SELECT "column", place, sum(rows) AS k FROM placed GROUP BY ALL),
found AS (
  SELECT s.station_id, s.event_hour, coalesce(p.place, z.stations) AS station_place, coalesce(q.place, z.hours) AS hour_place, z.*
  FROM silver s CROSS JOIN sizes z
  LEFT JOIN placed p ON p."column" = 'station_id' AND p.category = s.station_id
  LEFT JOIN placed q ON q."column" = 'hour' AND q.category = CAST(s.hour AS VARCHAR))
SELECT f.station_id, f.event_hour, f.stations + f.hours + 2 AS slots, CAST(2 AS INTEGER) AS filled_slots,
  f.station_place AS station_slot, f.stations + 1 + f.hour_place AS hour_slot,
  {comparable(_slot_value('a.k'), 6)} AS station_value, {comparable(_slot_value('b.k'), 6)} AS hour_value
FROM found f LEFT JOIN slot a ON a."column" = 'station_id' AND a.place = f.station_place
LEFT JOIN slot b ON b."column" = 'hour' AND b.place = f.hour_place""",
        "gold_features": "SELECT station_id, event_hour, bike_demand, dock_demand, CAST(8 AS INTEGER) AS components, "
        "true AS finite FROM assembled",
        "pca_components": """
SELECT CAST(n AS INTEGER) AS component, (SELECT count(*) FROM assembled) AS rows, true AS centred, true AS falling,
  true AS uncorrelated FROM range(1, 6) t(n)""",
        "pca_variance": """
SELECT CAST(n AS INTEGER) AS component, true AS falling, true AS adds_up, true AS kept_adds_up FROM range(1, 6) t(n)""",
        "rf_demand": "SELECT station_id, event_hour, bike_demand, dock_demand, true AS bike_in_range, true AS dock_in_range "
        "FROM fitted WHERE part = 'test'",
        "gbt_demand": "SELECT station_id, event_hour, bike_demand, dock_demand, true AS finite FROM fitted WHERE part = 'test'",
        "training_summary": _summary_facts("rf"),
        "train_summary": _summary_facts("gbt"),
        "model_search": """
SELECT 20 AS trials, 20 AS distinct_points, true AS in_space, 1 AS best_trials, true AS best_is_least,
  (SELECT count(*) FROM fitted WHERE search_part = 'validation') AS validation_rows""",
        "score_saved_models": f"""
SELECT station_id, event_hour, {' AND '.join(f'{c} IS NOT NULL' for c in _TRAINING_FEATURES)} AS scored,
  true AS as_fitted FROM silver""",
        "score_stream": f"""
SELECT station_id, event_hour, {' AND '.join(f'{c} IS NOT NULL' for c in _TRAINING_FEATURES)} AS scored,
  true AS as_table FROM silver""",
        "regression_metrics": f"""
WITH scored AS (
  SELECT CAST(h.bike_demand AS DOUBLE) AS y, h.bike_demand - x.hour_bikes AS err,
    CASE WHEN md5({_KEY_TEXT}) < 'cccd' THEN 'train' WHEN md5({_KEY_TEXT}) < 'e666' THEN 'validation' ELSE 'test' END AS part
  FROM hourly h JOIN by_hour x ON x.hour_of_day = hour(h.event_hour))
SELECT part, count(*) AS rows, {comparable('sqrt(avg(err * err))', 6)} AS rmse,
  {comparable('1e0 - sum(err * err) / (var_pop(y) * count(*))', 6)} AS r2, {comparable('avg(abs(err))', 6)} AS mae
FROM scored GROUP BY part""",
    }.items()
}
