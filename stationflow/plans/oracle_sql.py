"""DuckDB SQL twins of the registered queries (the correctness oracle).

The CTEs restate the events-derived feed rules and the report semantics in
plain SQL. Conventions that keep the two engines comparable:
* integer sums are cast to BIGINT (DuckDB sums to HUGEINT);
* division by zero is NULL (``NULLIF``; DuckDB would give inf);
* float feed columns are FLOAT (32 bit) as in the Spark schema;
* averages and deviations are rounded to 9 decimals on both sides, since
  floating sums depend on summation order.
"""

SNAPS = """
snaps AS (
  SELECT CAST(user_id AS VARCHAR) AS station_id,
         time_bucket(INTERVAL '15 minutes', ts) AS ts,
         CAST(max(CASE WHEN user_id % 50 = 0 THEN 0 ELSE 15 + user_id % 45 END) AS INTEGER)
           AS capacity,
         CAST(max(CASE WHEN event_type <> 'error'
                       THEN CAST(json_extract(props, '$.k') AS INTEGER) END) % 16 AS INTEGER)
           AS num_bikes_available
  FROM events
  WHERE ts IS NOT NULL
  GROUP BY 1, 2)"""

INFO = """
info AS (
  SELECT station_id || '_' || strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z' AS key,
         station_id, capacity, ts AS info_timestamp
  FROM snaps)"""

STATUS = """
status AS (
  SELECT station_id || '_' || strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z' AS key,
         station_id, num_bikes_available, ts AS status_timestamp
  FROM snaps)"""

WEATHER = """
weather AS (
  SELECT ts AS timestamp,
         CAST((n % 61) * 0.5 - 5 AS FLOAT) AS temperature,
         CAST((n % 17) * 0.5 AS FLOAT) AS wind_speed,
         CAST((n % 11) * 10 AS FLOAT) AS cloudiness
  FROM (SELECT DISTINCT ts, CAST(floor(epoch(ts) / 900) AS BIGINT) AS n FROM snaps))"""

PAIR = """
pair AS (
  SELECT i.key, i.station_id, i.capacity, s.num_bikes_available,
         i.info_timestamp AS event_timestamp
  FROM info i JOIN status s
    ON i.station_id = s.station_id AND i.info_timestamp = s.status_timestamp)"""

JOINED = """
joined AS (
  SELECT p.key, p.station_id, p.capacity, p.num_bikes_available,
         p.event_timestamp AS timestamp, w.temperature, w.wind_speed, w.cloudiness
  FROM pair p JOIN weather w ON p.event_timestamp = w.timestamp)"""

HOURLY = """
hourly AS (
  SELECT time_bucket(INTERVAL '1 hour', timestamp) AS window_start,
         station_id, capacity AS station_capacity, temperature, wind_speed, cloudiness,
         CAST(sum(coalesce(num_bikes_available, 0)) AS BIGINT) AS total_bikes_available_per_station,
         CAST(sum(capacity) AS BIGINT) AS total_capacity_per_station
  FROM joined
  WHERE timestamp IS NOT NULL
  GROUP BY 1, 2, 3, 4, 5, 6)"""

UTIL = """
util AS (
  SELECT *,
         CAST(total_capacity_per_station - total_bikes_available_per_station AS DOUBLE)
           / NULLIF(total_capacity_per_station, 0) AS station_utilization_rate
  FROM hourly)"""

TOTALS = """
totals AS (
  SELECT window_start,
         CAST(sum(total_capacity_per_station) AS BIGINT) AS city_total_capacity,
         CAST(sum(total_bikes_available_per_station) AS BIGINT) AS city_total_bikes_available,
         min(station_utilization_rate) AS min_utilization,
         max(station_utilization_rate) AS max_utilization,
         avg(station_utilization_rate) AS avg_utilization,
         stddev_samp(station_utilization_rate) AS std_dev_docking_station_utilisation
  FROM util GROUP BY window_start)"""

REPORT = """
report AS (
  SELECT u.station_id, u.temperature, u.wind_speed, u.cloudiness,
         u.station_utilization_rate,
         CAST(t.city_total_capacity - t.city_total_bikes_available AS DOUBLE)
           / NULLIF(t.city_total_capacity, 0) AS citywide_utilization_rate,
         t.min_utilization, t.max_utilization, t.avg_utilization,
         t.std_dev_docking_station_utilisation,
         u.window_start, u.window_start + INTERVAL 1 HOUR AS window_end
  FROM util u JOIN totals t ON u.window_start = t.window_start)"""

BLOCKS = {"snaps": SNAPS, "info": INFO, "status": STATUS, "weather": WEATHER,
          "pair": PAIR, "joined": JOINED, "hourly": HOURLY, "util": UTIL,
          "totals": TOTALS, "report": REPORT}
_ORDER = list(BLOCKS)


def with_blocks(upto: str, body: str, **own: str) -> str:
    """``WITH`` all feed/report CTEs up to and including ``upto``, then ``body``;
    blocks given by name take the place of the usual ones."""
    names = _ORDER[: _ORDER.index(upto) + 1]
    return "WITH " + ",".join((BLOCKS | own)[n] for n in names) + "\n" + body


# Feeds that do not fit each other (see ``sources.events.uneven_feeds``).
UNEVEN = {
    "info": """
info AS (
  SELECT station_id || '_' || strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z' AS key,
         CASE WHEN CAST(station_id AS BIGINT) % 11 <> 5 THEN station_id END AS station_id, capacity,
         CASE WHEN CAST(station_id AS BIGINT) % 17 <> 6 THEN ts END AS info_timestamp
  FROM snaps WHERE CAST(station_id AS BIGINT) % 7 <> 3)""",
    "status": """
status AS (
  SELECT CASE WHEN CAST(station_id AS BIGINT) % 11 <> 5 THEN station_id END AS station_id,
         num_bikes_available + more AS num_bikes_available,
         CASE WHEN CAST(station_id AS BIGINT) % 17 <> 6 THEN ts END AS status_timestamp
  FROM snaps JOIN (VALUES (0), (1)) copies (more)
    ON more = 0 OR CAST(station_id AS BIGINT) % 13 = 2
  WHERE CAST(station_id AS BIGINT) % 5 <> 1)""",
    "weather": """
weather AS (
  SELECT CASE WHEN n % 6 <> 4 OR more = 0 THEN ts END AS timestamp,
         CAST((n % 61) * 0.5 - 5 + CASE WHEN n % 6 = 2 THEN more ELSE 0 END AS FLOAT) AS temperature,
         CAST((n % 17) * 0.5 AS FLOAT) AS wind_speed,
         CAST((n % 11) * 10 AS FLOAT) AS cloudiness
  FROM (SELECT DISTINCT ts, CAST(floor(epoch(ts) / 900) AS BIGINT) AS n FROM snaps)
  JOIN (VALUES (0), (1)) copies (more) ON more = 0 OR n % 6 IN (2, 4)
  WHERE n % 6 <> 1)"""}

# Joined rows of which some have no time.
TIMELESS = {"joined": JOINED.replace("p.event_timestamp AS timestamp", """
         CASE WHEN CAST(p.station_id AS BIGINT) % 9 <> 4 THEN p.event_timestamp END AS timestamp""")}


def r9(expr: str, alias: str) -> str:
    return f"round({expr}, 9) AS {alias}"


def iso_text(ts: str) -> str:
    """DuckDB twin of ``iso_utc``: ISO text with ``Z``, zero fraction dropped."""
    return (f"strftime({ts}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN strftime({ts}, '%f') = '000000' "
            f"THEN '' ELSE '.' || strftime({ts}, '%f') END || 'Z'")


SLOTS = "(SELECT DISTINCT ts, CAST(floor(epoch(ts) / 900) AS BIGINT) AS n FROM snaps)"

FORECAST = """
fc AS (
  SELECT CAST(timestamp AS DATE) AS day,
         CAST(temperature AS DOUBLE) AS temperature,
         CAST(wind_speed AS DOUBLE) AS wind_speed,
         CAST(cloudiness AS INTEGER) AS cloudiness,
         timestamp AS forecast_time,
         CAST(row_number() OVER (PARTITION BY CAST(timestamp AS DATE) ORDER BY timestamp) - 1
              AS INTEGER) AS horizon
  FROM weather
  WHERE minute(timestamp) = 0 AND hour(timestamp) % 3 = 0)"""


def training_rows(train_fraction_tenths: int = 7, distinct: bool = False) -> str:
    """Report rows with a reproducible window split (hour number mod 10);
    ``distinct`` keeps one row per window / weather / label."""
    return f"""
rows AS (
  SELECT {'DISTINCT ' if distinct else ''}CAST(temperature AS DOUBLE) AS x1, CAST(wind_speed AS DOUBLE) AS x2,
         CAST(cloudiness AS DOUBLE) AS x3, avg_utilization AS y, window_start,
         CASE WHEN CAST(floor(epoch(window_start) / 3600) AS BIGINT) % 10
                   < {train_fraction_tenths}
              THEN 'train' ELSE 'test' END AS side
  FROM report
  WHERE temperature IS NOT NULL AND wind_speed IS NOT NULL AND cloudiness IS NOT NULL
    AND avg_utilization IS NOT NULL)"""


# Ordinary least squares from the normal equations: the 3x3 covariance matrix
# of the features is inverted through its adjugate.
OLS = """
m AS (
  SELECT covar_pop(x1, x1) AS s11, covar_pop(x1, x2) AS s12, covar_pop(x1, x3) AS s13,
         covar_pop(x2, x2) AS s22, covar_pop(x2, x3) AS s23, covar_pop(x3, x3) AS s33,
         covar_pop(x1, y) AS c1, covar_pop(x2, y) AS c2, covar_pop(x3, y) AS c3,
         avg(x1) AS m1, avg(x2) AS m2, avg(x3) AS m3, avg(y) AS my
  FROM rows WHERE side = 'train'),
adj AS (
  SELECT *, s22 * s33 - s23 * s23 AS a11, s13 * s23 - s12 * s33 AS a12,
         s12 * s23 - s13 * s22 AS a13, s11 * s33 - s13 * s13 AS a22,
         s12 * s13 - s11 * s23 AS a23, s11 * s22 - s12 * s12 AS a33
  FROM m),
beta AS (
  SELECT (a11 * c1 + a12 * c2 + a13 * c3) / det AS b1,
         (a12 * c1 + a22 * c2 + a23 * c3) / det AS b2,
         (a13 * c1 + a23 * c2 + a33 * c3) / det AS b3, m1, m2, m3, my
  FROM (SELECT *, s11 * a11 + s12 * a12 + s13 * a13 AS det FROM adj)),
coef AS (
  SELECT my - b1 * m1 - b2 * m2 - b3 * m3 AS b0, b1, b2, b3 FROM beta)"""


def r8(expr: str, alias: str) -> str:
    return f"round({expr}, 8) AS {alias}"
