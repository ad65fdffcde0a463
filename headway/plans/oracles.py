"""The registered queries as plain SQL over the given tables, for checking results."""

from __future__ import annotations

from headway import schemas as S
from headway.plans.warehouse import MIN_CELL

STOPS = "['signup', 'view', 'click', 'purchase', 'error']"
SEQ = f"CAST(list_position({STOPS}, event_type) AS INTEGER)"
EPOCH = "CAST(floor(epoch(ts)) AS BIGINT)"
TRIP = "'T' || lpad(CAST(user_id // 12 AS VARCHAR), 9, '0')"
ROUTE = "'R' || lpad(CAST(user_id // 48 AS VARCHAR), 9, '0')"

CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, needs: tuple[str, ...], sql: str) -> None:
    CTES[name] = (needs, sql)


def with_ctes(needs: tuple[str, ...], sql: str) -> str:
    """``sql`` behind the named common tables and whatever those need."""
    ordered: list[str] = []

    def add(name: str) -> None:
        if name not in ordered:
            for need in CTES[name][0]:
                add(need)
            ordered.append(name)

    for name in needs:
        add(name)
    if not ordered:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][1]})" for n in ordered) + "\n" + sql


cte("feed", (), f"""
  SELECT 'trip_updates' AS record_type, {EPOCH} AS feed_timestamp, {EPOCH} AS ingest_ts,
    {TRIP} AS trip_id, CASE WHEN event_id % 97 = 0 THEN NULL ELSE {ROUTE} END AS route_id,
    CAST(user_id % 2 AS INTEGER) AS direction_id, strftime(ts, '%Y%m%d') AS start_date,
    CAST(CASE WHEN event_id % 33 = 0 THEN 3 WHEN event_id % 7 = 0 THEN NULL ELSE 0 END AS INTEGER)
      AS schedule_relationship,
    'V' || CAST(user_id AS VARCHAR) AS vehicle_id, event_type AS stop_id,
    {SEQ} AS stop_sequence,
    {EPOCH} + 60 * CAST(json_extract(props, '$.k') AS INTEGER) AS arrival_time,
    CAST(trunc(value * 30 - 1860) AS INTEGER) AS arrival_delay,
    CAST(NULL AS BIGINT) AS departure_time, CAST(NULL AS INTEGER) AS departure_delay,
    strftime(ts, '%Y-%m-%d') AS dt, strftime(ts, '%H') AS "hour"
  FROM events""")
cte("positions", (), f"""
  SELECT 'vehicle_positions' AS record_type, {EPOCH} AS feed_timestamp, {EPOCH} AS ingest_ts,
    'V' || CAST(user_id AS VARCHAR) AS vehicle_id, {TRIP} AS trip_id, {ROUTE} AS route_id,
    49 + user_id / 1000.0 AS latitude, -123 - user_id / 1000.0 AS longitude,
    value AS speed, {SEQ} AS current_stop_sequence
  FROM events""")
cte("dim_routes", (), f"""
  SELECT DISTINCT {ROUTE} AS route_id,
    'line ' || CAST(user_id // 48 AS VARCHAR) AS route_short_name, 3 AS route_type
  FROM events""")
cte("listed_trips", (), f"""
  SELECT DISTINCT {TRIP} AS trip_id, {ROUTE} AS route_id, user_id // 12 AS n
  FROM events WHERE (user_id // 12) % 11 <> 10""")
cte("dim_trips", ("listed_trips",), """
  SELECT trip_id, route_id FROM listed_trips
  UNION ALL SELECT trip_id, 'RX-duplicate' FROM listed_trips WHERE n % 4 = 0""")
cte("dim_stops", (), f"""
  SELECT DISTINCT event_type AS stop_id, 49 + {SEQ} / 100.0 AS stop_lat,
    -123 - {SEQ} / 100.0 AS stop_lon FROM events""")
cte("visits", (), f"""
  SELECT DISTINCT {TRIP} AS trip_id, event_type AS stop_id, {SEQ} AS seq,
    user_id // 12 AS n FROM events""")
cte("dim_stop_times", ("visits",), """
  SELECT trip_id, stop_id, seq, CAST(20 + seq AS VARCHAR) || ':10:00' AS arrival_time,
    CAST(seq * 1.5 AS DOUBLE) AS dist
  FROM (SELECT * FROM visits
        UNION ALL SELECT trip_id, stop_id, seq - 10, n FROM visits WHERE n % 5 = 0)""")
cte("weather", (), f"""
  SELECT CAST(h AS DATE) AS service_date, CAST(extract(hour FROM h) AS INTEGER) AS hour_of_day,
    avg(extract(hour FROM h) - 2 + s) AS temp_c, avg(s) AS precipitation_mm,
    avg(10 + extract(hour FROM h)) AS wind_kph, avg(20000 - 100 * s) AS visibility_m
  FROM (SELECT DISTINCT date_trunc('hour', ts) AS h, {SEQ} AS s FROM events)
  WHERE extract(hour FROM h) <> 5 GROUP BY ALL""")
cte("valid", ("feed",), """
  SELECT * FROM feed WHERE trip_id IS NOT NULL AND stop_id IS NOT NULL
    AND start_date IS NOT NULL AND coalesce(schedule_relationship, 0) <> 3""")

LATEST = """ingest_ts DESC NULLS LAST, arrival_time DESC NULLS LAST,
    arrival_delay DESC NULLS LAST, vehicle_id DESC NULLS LAST, route_id DESC NULLS LAST,
    direction_id DESC NULLS LAST, stop_sequence DESC NULLS LAST"""


def latest(source: str) -> str:
    return f"""
  SELECT start_date, trip_id, stop_id, route_id, direction_id, vehicle_id, stop_sequence,
    arrival_time AS observed_arrival_epoch, arrival_delay AS observed_delay_sec,
    ingest_ts AS last_seen_ts
  FROM {source}
  QUALIFY row_number() OVER (PARTITION BY start_date, trip_id, stop_id ORDER BY {LATEST}) = 1"""


def snapshot(source: str, minutes: int) -> str:
    return f"""
  SELECT start_date, trip_id, stop_id, arrival_delay AS delay_t_minus_{minutes},
    ingest_ts AS snap_ts_t_minus_{minutes}
  FROM {source} WHERE arrival_time - ingest_ts >= {minutes * 60}
  QUALIFY row_number() OVER (PARTITION BY start_date, trip_id, stop_id
    ORDER BY arrival_time - ingest_ts - {minutes * 60}, ingest_ts DESC,
      arrival_delay DESC NULLS LAST) = 1"""


def add_silver(suffix: str, condition: str) -> None:
    """The whole silver build over the valid rows that meet ``condition``."""
    v = f"valid{suffix or '_all'}"
    cte(v, ("valid",), f"SELECT * FROM valid WHERE {condition}")
    cte(f"latest{suffix}", (v,), latest(v))
    for m in S.HORIZONS:
        cte(f"snap_{m}{suffix}", (v,), snapshot(v, m))
    snaps = tuple(f"snap_{m}{suffix}" for m in S.HORIZONS)
    cte(f"collapsed{suffix}", (f"latest{suffix}", *snaps), f"""
  SELECT * FROM latest{suffix} """ + " ".join(
        f"LEFT JOIN {s} USING (start_date, trip_id, stop_id)" for s in snaps))
    cte(f"scheduled{suffix}", (f"collapsed{suffix}", "dim_stop_times"), f"""
  SELECT c.*, t.arrival_time AS scheduled_arrival, t.dist AS shape_dist_traveled
  FROM collapsed{suffix} c LEFT JOIN dim_stop_times t
    ON c.trip_id = t.trip_id AND c.stop_id = t.stop_id
  QUALIFY row_number() OVER (PARTITION BY c.start_date, c.trip_id, c.stop_id
    ORDER BY coalesce(t.seq = c.stop_sequence, false) DESC, t.seq) = 1""")
    cte(f"recovered{suffix}", (f"scheduled{suffix}", "dim_trips"), f"""
  SELECT s.* EXCLUDE (route_id), coalesce(s.route_id, k.route_id) AS route_id
  FROM scheduled{suffix} s
  LEFT JOIN (SELECT trip_id, min(route_id) AS route_id FROM dim_trips GROUP BY trip_id) k
    ON s.trip_id = k.trip_id""")
    cte(f"silver{suffix}", (f"recovered{suffix}", "dim_stops", "dim_routes"), f"""
  SELECT CAST(strptime(start_date, '%Y%m%d') AS DATE) AS service_date, r.trip_id, r.stop_id,
    r.route_id, direction_id, vehicle_id, stop_sequence, start_date, observed_arrival_epoch,
    CASE WHEN observed_delay_sec BETWEEN -1800 AND 7200 THEN observed_delay_sec END
      AS observed_delay_sec,
    last_seen_ts, delay_t_minus_5, delay_t_minus_15, delay_t_minus_30,
    snap_ts_t_minus_5, snap_ts_t_minus_15, snap_ts_t_minus_30, scheduled_arrival,
    shape_dist_traveled, CAST(p.stop_lat AS DOUBLE) AS stop_lat,
    CAST(p.stop_lon AS DOUBLE) AS stop_lon, q.route_short_name, q.route_type,
    CAST(extract(hour FROM clock) AS INTEGER) AS hour_of_day,
    CAST(extract(dow FROM clock) + 1 AS INTEGER) AS day_of_week,
    CAST(extract(dow FROM clock) IN (0, 6) AS INTEGER) AS is_weekend,
    max(stop_sequence) OVER w - stop_sequence AS stops_remaining,
    CAST(stop_sequence = max(stop_sequence) OVER w AS INTEGER) AS is_terminus
  FROM (SELECT *, make_timestamp(observed_arrival_epoch * 1000000) AS clock
        FROM recovered{suffix}) r
  LEFT JOIN dim_stops p ON r.stop_id = p.stop_id
  LEFT JOIN dim_routes q ON r.route_id = q.route_id
  WINDOW w AS (PARTITION BY start_date, r.trip_id)""")


add_silver("", "true")
add_silver("_am", "\"hour\" < '12'")
add_silver("_pm", "\"hour\" >= '12'")

STATS = """quantile_disc(observed_delay_sec, 0.5) AS hist_median_delay,
    quantile_disc(observed_delay_sec, 0.9) AS hist_p90_delay,
    stddev_samp(observed_delay_sec) AS hist_std_delay, count(*) AS hist_n"""
cte("days", ("silver",), "SELECT DISTINCT service_date AS as_of FROM silver")
cte("priors", ("silver", "days"), f"""
  SELECT as_of, route_id, stop_id, is_weekend, hour_of_day, {STATS}
  FROM days JOIN silver ON service_date < as_of AND service_date >= as_of - {S.LOOKBACK_DAYS}
  WHERE observed_delay_sec IS NOT NULL
  GROUP BY as_of, route_id, stop_id, is_weekend, hour_of_day
  HAVING count(*) >= {MIN_CELL}""")
ALONG = "PARTITION BY service_date, trip_id ORDER BY stop_sequence NULLS FIRST, stop_id"
PRECEDING = """PARTITION BY service_date, route_id, stop_id
      ORDER BY observed_arrival_epoch NULLS FIRST, trip_id"""
cte("context", ("silver",), f"""
  SELECT *,
    lag(delay_t_minus_15) OVER ({ALONG}) AS prev_stop_delay,
    avg(delay_t_minus_15) OVER ({ALONG} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
      AS upstream_delay_same_trip,
    lag(delay_t_minus_15) OVER ({PRECEDING}) AS preceding_trip_delay,
    avg(delay_t_minus_15) OVER h AS mean_route_delay_15m,
    count(DISTINCT vehicle_id) OVER h AS vehicles_active_on_route
  FROM silver WINDOW h AS (PARTITION BY service_date, route_id, hour_of_day)""")
cte("gold", ("context", "priors", "weather"), """
  SELECT c.*, p.hist_median_delay, p.hist_p90_delay, p.hist_std_delay, p.hist_n,
    CAST(c.hour_of_day IN (7, 8, 15, 16, 17) AS INTEGER) AS is_peak, 0 AS is_holiday,
    CAST(c.hour_of_day * 60 + (observed_arrival_epoch // 60) % 60 AS INTEGER)
      AS minutes_since_service_start,
    0 AS active_alert_on_route, w.temp_c, w.precipitation_mm, w.wind_kph, w.visibility_m
  FROM context c
  LEFT JOIN priors p ON c.service_date = p.as_of AND c.route_id = p.route_id
    AND c.stop_id = p.stop_id AND c.is_weekend = p.is_weekend AND c.hour_of_day = p.hour_of_day
  LEFT JOIN weather w ON c.service_date = w.service_date AND c.hour_of_day = w.hour_of_day
  WHERE observed_delay_sec IS NOT NULL""")
cte("vectors", ("gold",), "  SELECT service_date, trip_id, stop_id,\n" + ",\n".join(
    f"    coalesce(CAST({n} AS DOUBLE), {d}) AS {n}" for n, d in S.FEATURES) + "\n  FROM gold")
cte("predictions", ("silver",), """
  SELECT route_id, stop_id, trip_id, service_date,
    round(0.8 * coalesce(delay_t_minus_15, 0), 1) AS predicted_delay_sec,
    CAST(delay_t_minus_15 AS DOUBLE) AS d15
  FROM silver WHERE is_terminus = 0""")
cte("matched", ("predictions", "silver"), """
  SELECT p.*, CAST(s.observed_delay_sec AS DOUBLE) AS y FROM predictions p
  JOIN silver s USING (service_date, trip_id, stop_id) WHERE s.observed_delay_sec IS NOT NULL""")
METRICS = """count(*) AS n, round(avg(abs(y - predicted_delay_sec)), 3) AS model_mae,
    round(avg(abs(y - coalesce(d15, 0))), 3) AS persistence_mae,
    round(avg(abs(y)), 3) AS schedule_mae,
    round(sqrt(avg(pow(y - predicted_delay_sec, 2))), 3) AS model_rmse,
    round(avg(abs(y - predicted_delay_sec)) / nullif(avg(abs(y - coalesce(d15, 0))), 0), 4)
      AS mae_ratio_vs_persistence"""
cte("daily_metrics", ("matched",),
    f"SELECT service_date, {METRICS} FROM matched GROUP BY service_date")
cte("scored", ("gold",), """
  SELECT *, CAST(observed_delay_sec AS DOUBLE) AS y,
    round(0.8 * coalesce(delay_t_minus_15, 0), 1) AS predicted FROM gold""")
cte("live_rows", ("feed",), """
  SELECT * FROM feed WHERE route_id <> '' AND stop_id <> ''
    AND arrival_delay BETWEEN -1800 AND 7200""")
cte("stop_state", ("live_rows",), """
  SELECT 'ROUTE#' || route_id || '#STOP#' || stop_id AS pk, 'CURRENT' AS sk, route_id, stop_id,
    CAST(arrival_delay AS DOUBLE) AS current_delay, coalesce(trip_id, '') AS trip_id,
    coalesce(stop_sequence, 0) AS stop_sequence, ingest_ts AS updated_at
  FROM live_rows
  QUALIFY row_number() OVER (PARTITION BY route_id, stop_id ORDER BY ingest_ts DESC,
    arrival_delay DESC, trip_id DESC, stop_sequence DESC) = 1""")
cte("asked", ("gold",), """
  SELECT service_date, trip_id, stop_id, route_id, snap_ts_t_minus_15 AS asked_at,
    make_timestamp(snap_ts_t_minus_15 * 1000000) AS clock
  FROM gold WHERE route_id IS NOT NULL AND snap_ts_t_minus_15 IS NOT NULL""")
cte("asked_stops", ("asked", "live_rows"), f"""
  SELECT a.route_id, a.stop_id, a.asked_at, arrival_delay, coalesce(stop_sequence, 0) AS stop_sequence
  FROM (SELECT DISTINCT route_id, stop_id, asked_at FROM asked) a
  JOIN live_rows l ON l.route_id = a.route_id AND l.stop_id = a.stop_id
    AND l.ingest_ts <= a.asked_at AND l.ingest_ts > a.asked_at - {S.STATE_TTL_SECONDS}
  QUALIFY row_number() OVER (PARTITION BY a.route_id, a.stop_id, a.asked_at
    ORDER BY ingest_ts DESC, arrival_delay DESC, trip_id DESC, stop_sequence DESC) = 1""")
cte("route_feed", ("live_rows", "positions"), """
  SELECT route_id, ingest_ts, arrival_delay, NULL AS vehicle_id FROM live_rows
  UNION ALL SELECT route_id, ingest_ts, NULL, vehicle_id FROM positions""")
cte("asked_routes", ("asked", "route_feed"), """
  SELECT a.route_id, a.asked_at, avg(arrival_delay) AS mean_delay, count(DISTINCT vehicle_id) AS vehicles
  FROM (SELECT DISTINCT route_id, asked_at FROM asked) a
  LEFT JOIN route_feed f ON f.route_id = a.route_id
    AND f.ingest_ts < a.asked_at AND f.ingest_ts >= a.asked_at - 900
  GROUP BY ALL""")
# What scoring knows; all other features are at their defaults there.
ONLINE = {
    "hour_of_day": "extract(hour FROM a.clock)", "day_of_week": "extract(dow FROM a.clock) + 1",
    "is_weekend": "CAST(extract(dow FROM a.clock) IN (0, 6) AS INTEGER)",
    "is_peak": "CAST(extract(hour FROM a.clock) IN (7, 8, 15, 16, 17) AS INTEGER)",
    "minutes_since_service_start": "extract(hour FROM a.clock) * 60 + extract(minute FROM a.clock)",
    "stop_sequence": "s.stop_sequence", "delay_t_minus_15": "s.arrival_delay",
    "mean_route_delay_15m": "r.mean_delay", "vehicles_active_on_route": "r.vehicles",
    **{n: f"p.{n}" for n in ("hist_median_delay", "hist_p90_delay", "hist_std_delay", "hist_n")},
}
cte("online", ("asked", "asked_stops", "asked_routes", "priors"),
    "  SELECT a.service_date, a.trip_id, a.stop_id,\n" + ",\n".join(
        f"    coalesce(CAST({ONLINE.get(n, 'NULL')} AS DOUBLE), {d}) AS {n}" for n, d in S.FEATURES) + """
  FROM asked a
  LEFT JOIN asked_stops s ON s.route_id = a.route_id AND s.stop_id = a.stop_id AND s.asked_at = a.asked_at
  LEFT JOIN asked_routes r ON r.route_id = a.route_id AND r.asked_at = a.asked_at
  LEFT JOIN priors p ON p.as_of = CAST(a.clock AS DATE) AND p.route_id = a.route_id
    AND p.stop_id = a.stop_id AND p.hour_of_day = extract(hour FROM a.clock)
    AND p.is_weekend = CAST(extract(dow FROM a.clock) IN (0, 6) AS INTEGER)""")
cte("paths", ("vectors", "online"), "  SELECT service_date, trip_id, stop_id, unnest([\n" + ",\n".join(
    f"    {{'feature': '{n}', 'offline': v.{n}, 'online': o.{n}}}" for n in S.FEATURE_NAMES) + """
    ], recursive := true) FROM vectors v JOIN online o USING (service_date, trip_id, stop_id)""")
cte("route_state", ("live_rows", "positions"), """
  SELECT 'ROUTE#' || route_id AS pk, 'ROUTESTATE' AS sk, route_id,
    round(avg(arrival_delay), 3) AS mean_route_delay_15m,
    coalesce(any_value(vehicles), 0) AS vehicles_active_on_route
  FROM live_rows LEFT JOIN (SELECT route_id, count(DISTINCT vehicle_id) AS vehicles
                            FROM positions GROUP BY route_id) v USING (route_id)
  GROUP BY route_id""")
cte("costs", (), """
  SELECT CAST(o_orderdate AS DATE) AS day, o_orderpriority AS service,
    CASE o_orderstatus WHEN 'F' THEN 'Usage' WHEN 'O' THEN 'Credit' ELSE 'Tax' END AS record_type,
    o_totalprice / 100000 AS amount
  FROM orders""")
cte("cost_daily", ("costs",), """
  SELECT day, service, sum(amount) AS amount FROM costs WHERE record_type = 'Usage'
  GROUP BY day, service HAVING sum(amount) >= 0.005""")
cte("cost_totals", ("cost_daily",), "SELECT day, sum(amount) AS total FROM cost_daily GROUP BY day")
cte("cost_rate", ("cost_totals",), """
  SELECT *, median_rate * days_in_month AS projected_month,
    total * days_in_month AS projected_from_latest
  FROM (SELECT day, total, lag(total) OVER (ORDER BY day) AS prior_total,
          quantile_cont(total, 0.5) OVER w AS median_rate, avg(total) OVER w AS mean_rate,
          CAST(extract(day FROM last_day(day)) AS INTEGER) AS days_in_month
        FROM cost_totals WINDOW w AS (ORDER BY day ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))""")
cte("runs", (), """
  SELECT DISTINCT CAST(ts AS DATE) AS day FROM events WHERE extract(dow FROM ts) <> 0""")
cte("event_days", (), """
  SELECT CAST(unnest(generate_series(min(CAST(ts AS DATE)), max(CAST(ts AS DATE)),
    INTERVAL 1 DAY)) AS DATE) AS day FROM events""")

ROW = "service_date, trip_id, stop_id"
NEST = "(start_date, trip_id, stop_id)"
TRIP_COLUMNS = ", ".join(f'"{n}"' for n in S.TRIP_UPDATES_ROW.names)
SILVER_OUT = ", ".join(
    n for n in S.STOP_EVENTS_SCHEMA.names
    if n not in ("observed_arrival_ts", "stop_lat", "stop_lon")
) + ", round(stop_lat, 6) AS stop_lat, round(stop_lon, 6) AS stop_lon"
GOLD_ROUNDED = {
    "hist_std_delay": 4, "upstream_delay_same_trip": 6, "mean_route_delay_15m": 6, "temp_c": 6,
    "precipitation_mm": 6, "wind_kph": 6, "visibility_m": 6, "stop_lat": 6, "stop_lon": 6,
}
GOLD_OUT = ", ".join(
    f"round({n}, {GOLD_ROUNDED[n]}) AS {n}" if n in GOLD_ROUNDED else n
    for n in S.TRAINING_FEATURES_SCHEMA.names if n != "observed_arrival_ts"
)
FLAT = f"""
  SELECT 'trip_updates' AS record_type, {EPOCH} AS feed_timestamp, {EPOCH} + 100 AS ingest_ts,
    {TRIP} AS trip_id, CASE WHEN event_id % 97 = 0 THEN NULL ELSE {ROUTE} END AS route_id,
    CAST(user_id % 2 AS INTEGER) AS direction_id, strftime(ts, '%Y%m%d') AS start_date,
    CAST(CASE WHEN event_id % 33 = 0 THEN 3 ELSE 0 END AS INTEGER) AS schedule_relationship,
    'V' || CAST(user_id AS VARCHAR) AS vehicle_id, """
BUCKET = """CASE WHEN observed_delay_sec < -300 THEN '1. early >5m'
    WHEN observed_delay_sec < -60 THEN '2. early 1-5m'
    WHEN observed_delay_sec < 60 THEN '3. on time'
    WHEN observed_delay_sec < 180 THEN '4. late 1-3m'
    WHEN observed_delay_sec < 300 THEN '5. late 3-5m'
    WHEN observed_delay_sec < 600 THEN '6. late 5-10m' ELSE '7. late >10m' END"""
cte("buckets", ("silver",), f"""
  SELECT {BUCKET} AS bucket, count(*) AS n FROM silver WHERE observed_delay_sec IS NOT NULL
  GROUP BY 1""")


def stump(turn: int) -> str:
    """One boosting round: the split with the largest gain over sums of signs, leaf medians."""
    before, after = f"fit{turn}", f"fit{turn + 1}"
    return f"""
    side{turn} AS (
      SELECT c.f, c.c, sum(sign(b.y - b.pred)) FILTER (WHERE x.x <= c.c) AS l,
        count(*) FILTER (WHERE x.x <= c.c) AS n, sum(sign(b.y - b.pred)) AS g, count(*) AS m
      FROM cuts c JOIN long x ON x.f = c.f JOIN {before} b ON b.id = x.id
      WHERE b.split = 'train' AND b.y IS NOT NULL GROUP BY c.f, c.c),
    best{turn} AS (
      SELECT f, c FROM side{turn} WHERE n >= 5 AND m - n >= 5
      ORDER BY l * l / (n + 1.0) + (g - l) * (g - l) / (m - n + 1.0) - g * g / (m + 1.0) DESC, f, c LIMIT 1),
    leaf{turn} AS (
      SELECT x.x <= b.c AS low, quantile_disc(r.y - r.pred, 0.5) AS value
      FROM best{turn} b JOIN long x ON x.f = b.f JOIN {before} r ON r.id = x.id
      WHERE r.split = 'train' AND r.y IS NOT NULL GROUP BY 1),
    {after} AS (
      SELECT r.id, r.split, r.y, r.pred + 0.5 * v.value AS pred
      FROM {before} r JOIN long x ON x.id = r.id JOIN best{turn} b ON b.f = x.f
      JOIN leaf{turn} v ON v.low = (x.x <= b.c))"""


STUMPS = f"""
  WITH labelled AS (
    SELECT v.*, g.observed_delay_sec AS label, row_number() OVER () AS id,
      CASE WHEN t - v.service_date >= 14 THEN 'train'
        WHEN t - v.service_date >= 7 THEN 'validation' ELSE 'test' END AS split
    FROM vectors v JOIN gold g USING ({ROW}), (SELECT max(service_date) AS t FROM gold)),
  long AS MATERIALIZED (
    SELECT id, split, label AS y, unnest(range({len(S.FEATURE_NAMES)})) AS f,
      unnest([{", ".join(S.FEATURE_NAMES)}]) AS x FROM labelled),
  cuts AS MATERIALIZED (
    SELECT DISTINCT f, unnest(quantile_disc(x, [{", ".join(str(k / 256) for k in range(1, 256))}])) AS c
    FROM long WHERE split = 'train' AND y IS NOT NULL GROUP BY f),
  fit0 AS (
    SELECT id, split, CAST(label AS DOUBLE) AS y, (SELECT quantile_disc(CAST(label AS DOUBLE), 0.5)
      FROM labelled WHERE split = 'train') AS pred
    FROM labelled), {stump(0)}, {stump(1)}
  SELECT {ROW}, l.split, round(pred, 3) AS predicted_delay_sec FROM labelled l JOIN fit2 USING (id)"""


def hours(offset: int) -> str:
    return f"""
  SELECT CAST((hour_of_day + {offset % 24}) % 24 AS INTEGER) AS hour_of_day, count(*) AS events,
    round(avg(observed_delay_sec), 1) AS avg_delay,
    round(CAST(quantile_disc(observed_delay_sec, 0.9) AS DOUBLE), 1) AS p90_delay
  FROM silver WHERE observed_delay_sec IS NOT NULL GROUP BY hour_of_day"""


BASE = """round(avg(abs(observed_delay_sec)), 1) AS mae_schedule,
    round(avg(abs(observed_delay_sec - coalesce(delay_t_minus_15, 0))), 1) AS mae_persistence"""
DQ_STATS = """count(*) AS rows, count(trip_id) AS trip_ids, count(observed_delay_sec) AS labelled,
    count(DISTINCT CASE WHEN trip_id IS NOT NULL AND stop_id IS NOT NULL
      THEN trip_id || '/' || stop_id END) AS distinct_keys,
    min(observed_delay_sec) AS min_delay, max(observed_delay_sec) AS max_delay"""
cte("dq", ("silver",), f"SELECT service_date, {DQ_STATS} FROM silver GROUP BY service_date")
DQ_MIN_ROWS = 40
cte("rules", ("dq",), f"""
  SELECT service_date, 'row_count_minimum' AS rule, rows >= {DQ_MIN_ROWS} AS passed,
    CAST(rows AS VARCHAR) AS observed, '>= {DQ_MIN_ROWS}' AS expected, CAST(rows AS DOUBLE) AS "value"
  FROM dq
  UNION ALL SELECT service_date, 'trip_id_completeness', trip_ids = rows, CAST(trip_ids AS VARCHAR),
    CAST(rows AS VARCHAR), CAST(trip_ids AS DOUBLE) FROM dq
  UNION ALL SELECT service_date, 'label_completeness', labelled / rows >= 0.85,
    CAST(round(labelled / rows, 4) AS VARCHAR), '>= 0.85', round(labelled / rows, 4) FROM dq
  UNION ALL SELECT service_date, 'key_uniqueness', distinct_keys / rows >= 0.999,
    CAST(round(distinct_keys / rows, 6) AS VARCHAR), '>= 0.999',
    round(distinct_keys / rows, 6) FROM dq
  UNION ALL SELECT service_date, 'delay_within_bounds',
    coalesce(min_delay >= -1800 AND max_delay <= 7200, true),
    '[' || min_delay || ', ' || max_delay || ']', '[-1800, 7200]',
    CAST(min_delay AS DOUBLE) FROM dq""")
NULL_RATES = " UNION ALL ".join(
    f"SELECT service_date, '{n}' AS feature, round(count_if({n} IS NULL) / count(*), 6) AS null_rate,"
    f" coalesce(min({n}) = max({n}), true) AS is_constant FROM gold GROUP BY service_date"
    for n in S.FEATURE_NAMES
)
WEATHER_OF_ROWS = f"""
      SELECT s.service_date, trip_id, stop_id, round(temp_c, 6) AS temp_c,
        round(precipitation_mm, 6) AS precipitation_mm, round(wind_kph, 6) AS wind_kph,
        round(visibility_m, 6) AS visibility_m
      FROM silver s LEFT JOIN weather w
        ON s.service_date = w.service_date AND s.hour_of_day = w.hour_of_day"""
PRIORS_OF_LAST_DAY = f"""
      SELECT route_id, stop_id, is_weekend, hour_of_day, {STATS.replace(
          'stddev_samp(observed_delay_sec)', 'round(stddev_samp(observed_delay_sec), 4)')}
      FROM silver, (SELECT max(service_date) AS d FROM silver)
      WHERE service_date < d AND service_date >= d - 28 AND observed_delay_sec IS NOT NULL
      GROUP BY route_id, stop_id, is_weekend, hour_of_day HAVING count(*) >= {MIN_CELL}"""
cte("upserted", ("silver_am", "silver_pm"), f"""
  SELECT {ROW}, """ + ", ".join(
    f"CASE WHEN t.trip_id IS NULL OR s.last_seen_ts > t.last_seen_ts THEN "
    + f"s.{n}"
    + f" ELSE t.{n} END AS {n}"
    for n in S.STOP_EVENTS_SCHEMA.names
    if n not in (*S.SILVER_KEY, "observed_arrival_ts")
) + f" FROM silver_am t FULL JOIN silver_pm s USING ({ROW})")
cte("spine", (), f"""
  SELECT unnest(generate_series(min({EPOCH}) // 900 * 900, max({EPOCH}) // 900 * 900, 900))
    AS window_start FROM events""")
STATE_NOW = "(SELECT max(ingest_ts) FROM feed)"
cte("requests", (), f"SELECT DISTINCT {ROUTE} AS route_id, event_type AS stop_id FROM events")

_EMPTY: tuple[str, ...] = ()
ORACLES: dict[str, tuple[tuple[str, ...], str]] = {
    # --- silver
    "silver_latest": (("latest",), "SELECT * FROM latest"),
    **{f"silver_snapshot_{m}": ((f"snap_{m}",), f"SELECT * FROM snap_{m}") for m in S.HORIZONS},
    "silver_schedule": (("scheduled",), """
      SELECT start_date, trip_id, stop_id, scheduled_arrival, shape_dist_traveled FROM scheduled"""),
    "silver_route_recovery": (("recovered", "collapsed"), f"""
      SELECT start_date, trip_id, stop_id, c.route_id AS feed_route_id, r.route_id
      FROM recovered r JOIN collapsed c USING {NEST}"""),
    "silver_enriched": (("silver",), f"SELECT {SILVER_OUT} FROM silver"),
    "silver_terminus": (("silver",), f"SELECT {ROW}, stops_remaining, is_terminus FROM silver"),
    "silver_clamped": (("silver", "latest"), f"""
      SELECT s.service_date, s.trip_id, s.stop_id, s.observed_delay_sec,
        l.observed_delay_sec AS reported_delay_sec
      FROM silver s JOIN latest l USING {NEST}"""),
    "silver_upsert": (("silver",), f"SELECT {SILVER_OUT} FROM silver"),
    "silver_merge_whole_row": (("upserted",), f"SELECT {SILVER_OUT} FROM upserted"),
    # --- gold
    "gold_priors": (("priors",), """
      SELECT as_of, route_id, stop_id, is_weekend, hour_of_day, hist_median_delay, hist_p90_delay,
        round(hist_std_delay, 4) AS hist_std_delay, hist_n FROM priors"""),
    "gold_priors_run_date": (("silver",), PRIORS_OF_LAST_DAY),
    "gold_priors_kept": (("silver",), PRIORS_OF_LAST_DAY),
    "backfill_days": (("gold", "dq"), f"""
      SELECT {ROW}, observed_delay_sec, prev_stop_delay, preceding_trip_delay, hist_median_delay, hist_n,
        round(upstream_delay_same_trip, 6) AS upstream_delay_same_trip,
        round(mean_route_delay_15m, 6) AS mean_route_delay_15m, round(temp_c, 6) AS temp_c
      FROM gold JOIN dq USING (service_date), (SELECT ceil(avg(rows)) AS least, max(service_date) AS d FROM dq)
      WHERE service_date >= d - 9 AND rows >= least AND distinct_keys / rows >= 0.999
        AND coalesce(min_delay >= -1800 AND max_delay <= 7200, true)"""),
    "gold_prev_stop": (("context",), f"SELECT {ROW}, prev_stop_delay FROM context"),
    "gold_upstream_mean": (("context",), f"""
      SELECT {ROW}, round(upstream_delay_same_trip, 6) AS upstream_delay_same_trip FROM context"""),
    "gold_preceding_trip": (("context",), f"SELECT {ROW}, preceding_trip_delay FROM context"),
    "gold_route_hour": (("context",), f"""
      SELECT {ROW}, round(mean_route_delay_15m, 6) AS mean_route_delay_15m,
        vehicles_active_on_route FROM context"""),
    "gold_route_strict": (("silver",), f"""
      SELECT {ROW},
        CASE WHEN snap_ts_t_minus_15 IS NOT NULL THEN round(avg(delay_t_minus_15) OVER w, 6) END
          AS mean_route_delay_15m,
        CASE WHEN snap_ts_t_minus_15 IS NOT NULL THEN count(DISTINCT vehicle_id) OVER w END
          AS vehicles_active_on_route
      FROM silver WINDOW w AS (PARTITION BY service_date, route_id ORDER BY snap_ts_t_minus_15
        RANGE BETWEEN 900 PRECEDING AND 1 PRECEDING)"""),
    "gold_weather_join": (("silver", "weather"), WEATHER_OF_ROWS),
    "gold_weather_stored": (("silver", "weather"), WEATHER_OF_ROWS),
    "gold_weather_absent": (("silver",), f"SELECT {ROW}, " + ", ".join(
        f"CAST({S.FEATURE_DEFAULTS[n]} AS DOUBLE) AS {n}" for n in S.WEATHER_FALLBACK) + " FROM silver"),
    "training_split": (("vectors", "gold"), f"SELECT {ROW}, g.observed_delay_sec, " + ", ".join(
        f"round(v.{n}, 4) AS {n}" for n in S.FEATURE_NAMES) + f"""
      FROM vectors v JOIN gold g USING ({ROW}), (SELECT max(service_date) AS t FROM gold)
      WHERE t - service_date >= 14"""),
    "gold_features": (("gold",), f"SELECT {GOLD_OUT} FROM gold"),
    "feature_vector": (("vectors",), f"SELECT {ROW}, " + ", ".join(
        f"round({n}, 4) AS {n}" for n in S.FEATURE_NAMES) + " FROM vectors"),
    "feature_csv": (("vectors",), f"SELECT {ROW}, concat_ws(',', " + ", ".join(
        f"printf('%.6f', {n})" for n in S.FEATURE_NAMES) + ") AS csv FROM vectors"),
    "fill_rate": (("gold",), f"SELECT {ROW}, round((" + " + ".join(
        f"CAST({n} IS NOT NULL AS INTEGER)" for n in S.FEATURE_NAMES)
        + ") / 26.0, 6) AS fill_rate FROM gold"),
    "feature_mismatches": (("gold",), """
      SELECT service_date, trip_id, stop_id, 'delay_t_minus_15' AS feature,
        CAST(coalesce(delay_t_minus_15, 0) AS DOUBLE) AS offline,
        CAST(coalesce(delay_t_minus_5, 0) AS DOUBLE) AS online
      FROM gold
      WHERE abs(coalesce(delay_t_minus_15, 0) - coalesce(delay_t_minus_5, 0)) > 1e-6"""),
    "replayed_mismatches": (("paths",), """
      SELECT service_date, trip_id, stop_id, feature, round(offline, 4) AS offline, round(online, 4) AS online
      FROM paths WHERE abs(offline - online) > 1e-6"""),
    "feature_parity": (("paths",), """
      SELECT feature, count(*) AS compared, count_if(abs(offline - online) > 1e-6) AS differing,
        round(max(abs(offline - online)), 4) AS largest FROM paths GROUP BY feature"""),
    "uncovered_features": (("silver",), "SELECT unnest([" + ", ".join(
        f"'{n}'" for n in S.FEATURE_NAMES if n not in S.STOP_EVENTS_SCHEMA.names)
        + "]) AS feature FROM (SELECT count(*) FROM silver)"),
    # --- quality
    "dq_stats": (("dq",), "SELECT * FROM dq"),
    "dq_rules": (("rules",), "SELECT * FROM rules"),
    "hourly_landing": (("feed",), """
      SELECT dt, "hour", count(*) AS rows, count(DISTINCT trip_id) AS trips,
        count(arrival_delay) AS labelled FROM feed GROUP BY dt, "hour" """),
    "trip_id_match": (("feed", "dim_trips"), """
      SELECT count(*) AS joined_rows FROM feed t JOIN dim_trips d ON t.trip_id = d.trip_id"""),
    "trip_id_unmatched": (("feed", "dim_trips"), """
      SELECT trip_id, count(*) AS rows FROM feed
      WHERE trip_id IS NOT NULL AND trip_id NOT IN (SELECT trip_id FROM dim_trips)
      GROUP BY trip_id"""),
    "ingest_counts": (("feed", "positions"), """
      SELECT record_type, count(*) AS rows FROM (SELECT record_type FROM feed
        UNION ALL SELECT record_type FROM positions) GROUP BY record_type"""),
    "dedupe_check": (("silver",), """
      SELECT service_date, count(*) AS events, count(observed_delay_sec) AS labelled,
        count(*) - count(DISTINCT trip_id || '|' || stop_id) AS dupes,
        quantile_disc(observed_delay_sec, 0.5) AS median_delay
      FROM silver GROUP BY service_date"""),
    "coverage": (("silver",), """
      SELECT service_date, count(*) AS events FROM silver GROUP BY service_date"""),
    "completeness": (("gold",), """
      SELECT count(*) AS rows, count(DISTINCT service_date) AS days,
        CAST(count_if(hist_median_delay IS NULL) AS BIGINT) AS missing_prior,
        CAST(count_if(delay_t_minus_15 IS NULL) AS BIGINT) AS missing_snapshot FROM gold"""),
    "null_rates": (("gold",), NULL_RATES),
    "recent_days": (("silver",), """
      SELECT *, events >= 40 AS enough_events, label_rate >= 0.85 AS enough_labels,
        dupes = 0 AS no_dupes, events >= 40 AND label_rate >= 0.85 AND dupes = 0 AS usable
      FROM (SELECT service_date, count(*) AS events, count(observed_delay_sec) AS labelled,
        round(count(observed_delay_sec) / count(*), 3) AS label_rate,
        count(*) - count(DISTINCT trip_id || '|' || stop_id) AS dupes
      FROM silver GROUP BY service_date ORDER BY service_date DESC LIMIT 7)"""),
    "gold_days": (("gold",), """
      SELECT service_date, count(*) AS rows_out FROM gold GROUP BY service_date
      ORDER BY service_date DESC LIMIT 7"""),
    "layer_diff": (("silver", "gold"), """
      SELECT * FROM (SELECT service_date, silver_rows, silver_labelled, gold_rows,
        CASE WHEN gold_rows IS NULL THEN 'missing' WHEN silver_rows IS NULL THEN 'orphan'
          WHEN silver_labelled <> gold_rows THEN 'partial' END AS status
      FROM (SELECT service_date, count(*) AS silver_rows,
              count(observed_delay_sec) AS silver_labelled FROM silver GROUP BY service_date)
      FULL JOIN (SELECT service_date + 1 AS service_date, count(*) AS gold_rows
                 FROM gold GROUP BY 1) USING (service_date)) WHERE status IS NOT NULL"""),
    "collection_progress": (("silver",), """
      SELECT days, first_day, last_day, total_events, labelled,
        round(labelled / total_events, 6) AS label_rate, greatest(0, 21 - days) AS remaining
      FROM (SELECT count(DISTINCT service_date) AS days, min(service_date) AS first_day,
        max(service_date) AS last_day, count(*) AS total_events,
        count(observed_delay_sec) AS labelled FROM silver)"""),
    # --- profiles and baselines
    "delay_distribution": (("buckets",), "SELECT * FROM buckets"),
    "distribution_share": (("buckets",), """
      SELECT bucket, regexp_replace(bucket, '^\\d\\.\\s*', '') AS label, n,
        round(n * 100.0 / sum(n) OVER (), 6) AS pct,
        round(sum(CASE WHEN bucket LIKE '%early%' THEN n ELSE 0 END) OVER () * 100.0
          / sum(n) OVER (), 6) AS early_pct,
        round(sum(CASE WHEN bucket LIKE '%late%' THEN n ELSE 0 END) OVER () * 100.0
          / sum(n) OVER (), 6) AS late_pct
      FROM buckets"""),
    "hour_profile": (("silver",), hours(0)),
    "local_hour_profile": (("silver",), hours(-7)),
    "worst_hour": (("silver",), f"""
      SELECT hour_of_day, p90_delay FROM ({hours(0)})
      ORDER BY p90_delay DESC, hour_of_day LIMIT 1"""),
    "baselines_silver": (("silver",), f"""
      SELECT count(*) AS n, {BASE} FROM silver WHERE observed_delay_sec IS NOT NULL"""),
    "baselines_gold": (("gold",), """
      SELECT count(*) AS n, round(avg(abs(observed_delay_sec)), 6) AS mae_schedule,
        round(avg(abs(observed_delay_sec - coalesce(delay_t_minus_15, 0))), 6) AS mae_persistence,
        round(avg(abs(observed_delay_sec - coalesce(hist_median_delay, 0))), 6) AS mae_historical
      FROM gold"""),
    "baselines_last_14_days": (("gold",), """
      SELECT count(*) AS n, round(avg(abs(observed_delay_sec)), 6) AS mae_schedule,
        round(avg(abs(observed_delay_sec - coalesce(delay_t_minus_15, 0))), 6) AS mae_persistence,
        round(avg(abs(observed_delay_sec - coalesce(hist_median_delay, 0))), 6) AS mae_historical
      FROM gold WHERE service_date >= (SELECT max(service_date) FROM gold) - 14"""),
    "historical_baseline": (("gold",), """
      SELECT count(*) AS n, count(hist_median_delay) AS with_prior,
        round(avg(abs(observed_delay_sec - coalesce(hist_median_delay, 0))), 1) AS mae_historical
      FROM gold WHERE observed_delay_sec IS NOT NULL"""),
    "baseline_gain": (("silver",), f"""
      SELECT n, mae_schedule, mae_persistence,
        round((mae_schedule - mae_persistence) / mae_schedule * 100, 6) AS persistence_gain_pct,
        round(mae_persistence * 0.92, 6) AS gate_sec
      FROM (SELECT count(*) AS n, {BASE} FROM silver WHERE observed_delay_sec IS NOT NULL)"""),
    # --- backtest and evaluation
    "backtest_metrics": (("matched",), f"SELECT {METRICS} FROM matched"),
    "backtest_daily": (("daily_metrics",), "SELECT * FROM daily_metrics"),
    "metric_summary": (("daily_metrics",), " UNION ALL ".join(
        f"SELECT '{label}' AS metric, count({c}) AS points, round(sum(CAST({c} AS DOUBLE)), 3) AS total,"
        f" max(CAST({c} AS DOUBLE)) AS highest, min(CAST({c} AS DOUBLE)) AS lowest FROM daily_metrics"
        for c, label in (("model_mae", "ModelMae"), ("persistence_mae", "PersistenceMae"),
                         ("schedule_mae", "ScheduleMae"),
                         ("mae_ratio_vs_persistence", "ModelMaeRatioVsPersistence"),
                         ("n", "PredictionsScored")))),
    "model_degraded": (("daily_metrics",), """
      SELECT service_date AS day,
        CAST(coalesce(mae_ratio_vs_persistence > 0.95, false) AS BIGINT)
          + CAST(coalesce(prior > 0.95, false) AS BIGINT) AS breaches,
        CASE WHEN mae_ratio_vs_persistence <= 0.95 OR prior <= 0.95 THEN 'ok'
          WHEN mae_ratio_vs_persistence > 0.95 AND prior > 0.95 THEN 'degraded'
          ELSE 'unknown' END AS status
      FROM (SELECT m.*, p.mae_ratio_vs_persistence AS prior FROM daily_metrics m
            LEFT JOIN daily_metrics p ON p.service_date = m.service_date - 1)"""),
    "evaluation_report": (("scored",), """
      SELECT n_test, round(mae, 4) AS mae, round(rmse, 4) AS rmse,
        round(p90, 4) AS p90_abs_error, round(persistence, 4) AS persistence_mae,
        round(schedule, 4) AS schedule_mae, round(historical, 4) AS historical_mae,
        round(mae / persistence, 4) AS mae_ratio_vs_persistence,
        round(mae / schedule, 4) AS mae_ratio_vs_schedule, mae / persistence <= 0.92 AS passes_gate
      FROM (SELECT count(*) AS n_test, avg(abs(y - predicted)) AS mae,
        sqrt(avg(pow(y - predicted, 2))) AS rmse, quantile_cont(abs(y - predicted), 0.9) AS p90,
        avg(abs(y - coalesce(delay_t_minus_15, 0))) AS persistence, avg(abs(y)) AS schedule,
        avg(abs(y - coalesce(hist_median_delay, 0))) AS historical FROM scored)"""),
    "time_split": (("gold",), f"""
      SELECT {ROW}, CASE WHEN t - service_date >= 14 THEN 'train'
        WHEN t - service_date >= 7 THEN 'validation' ELSE 'test' END AS split
      FROM gold, (SELECT max(service_date) AS t FROM gold)"""),
    "gbt_stumps": (("gold", "vectors"), STUMPS),
    # --- feed and stream rows
    "flatten_trip_updates": (_EMPTY, FLAT + f"""event_type AS stop_id, {SEQ} AS stop_sequence,
        {EPOCH} + 600 AS arrival_time, CAST(trunc(value * 30 - 1860) AS INTEGER) AS arrival_delay,
        CAST(NULL AS BIGINT) AS departure_time, CAST(NULL AS INTEGER) AS departure_delay
      FROM events UNION ALL {FLAT} event_type || '-next', {SEQ} + 1, NULL, NULL, NULL, NULL
      FROM events"""),
    "flatten_vehicle_positions": (_EMPTY, f"""
      SELECT 'vehicle_positions' AS record_type, {EPOCH} AS feed_timestamp,
        {EPOCH} + 100 AS ingest_ts, 'V' || CAST(user_id AS VARCHAR) AS vehicle_id,
        {TRIP} AS trip_id, CAST(NULL AS VARCHAR) AS route_id,
        round(49 + user_id / 1000.0, 6) AS latitude,
        round(-123 - user_id / 1000.0, 6) AS longitude,
        CAST(NULL AS DOUBLE) AS bearing, value AS speed, {SEQ} AS current_stop_sequence,
        CAST(NULL AS INTEGER) AS occupancy_status, {EPOCH} AS vehicle_timestamp
      FROM events"""),
    "pack_unpack": (("feed",), f"SELECT {TRIP_COLUMNS} FROM feed"),
    "partition_keys": (("feed",), """
      SELECT coalesce(nullif(route_id, ''), nullif(vehicle_id, ''), 'unknown') AS partition_key,
        count(*) AS rows FROM feed GROUP BY 1"""),
    "feature_distincts": (("gold",), " UNION ALL ".join(
        f"SELECT '{n}' AS feature, count(DISTINCT {n}) AS distinct_values, true AS within FROM gold"
        for n in S.FEATURE_NAMES)),
    "route_vehicles": (("silver",), """
      SELECT route_id, count(DISTINCT vehicle_id) AS vehicles, true AS within
      FROM silver WHERE route_id IS NOT NULL GROUP BY route_id"""),
    # --- live state
    "live_stop_state": (("stop_state",), "SELECT * FROM stop_state"),
    "live_route_state": (("route_state",), "SELECT * FROM route_state"),
    "live_state_alive": (("stop_state", "feed"), f"""
      SELECT pk, current_delay, updated_at FROM stop_state
      WHERE updated_at + 7200 > {STATE_NOW}"""),
    "live_upstream_state": (("stop_state",), """
      SELECT pk, lag(current_delay) OVER w AS prev_stop_delay,
        round(avg(current_delay) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 6)
          AS upstream_delay
      FROM stop_state WINDOW w AS (PARTITION BY trip_id ORDER BY stop_sequence, route_id, stop_id)"""),
    "prior_state": (("priors", "days"), """
      SELECT 'ROUTE#' || route_id || '#STOP#' || stop_id AS pk,
        'STATS#' || is_weekend || '#' || lpad(CAST(hour_of_day AS VARCHAR), 2, '0') AS sk,
        hist_median_delay, hist_p90_delay, round(hist_std_delay, 4) AS hist_std_delay, hist_n
      FROM priors WHERE as_of = (SELECT max(as_of) FROM days) AND route_id IS NOT NULL"""),
    "score_features": (("requests", "stop_state", "route_state", "priors", "days", "feed"), f"""
      SELECT r.route_id, r.stop_id, n.hour_of_day, n.day_of_week, n.is_weekend,
        s.stop_sequence, s.current_delay AS delay_t_minus_15, t.mean_route_delay_15m,
        t.vehicles_active_on_route, p.hist_median_delay, p.hist_n
      FROM requests r
      CROSS JOIN (SELECT CAST(extract(hour FROM clock) AS INTEGER) AS hour_of_day,
          CAST(extract(dow FROM clock) + 1 AS INTEGER) AS day_of_week,
          CAST(extract(dow FROM clock) IN (0, 6) AS INTEGER) AS is_weekend
        FROM (SELECT make_timestamp({STATE_NOW} * 1000000) AS clock)) n
      LEFT JOIN stop_state s ON r.route_id = s.route_id AND r.stop_id = s.stop_id
      LEFT JOIN route_state t ON r.route_id = t.route_id
      LEFT JOIN priors p ON p.as_of = (SELECT max(as_of) FROM days) AND r.route_id = p.route_id
        AND r.stop_id = p.stop_id AND p.is_weekend = n.is_weekend
        AND p.hour_of_day = n.hour_of_day"""),
    "stream_stop_state": (("stop_state",), "SELECT * FROM stop_state"),
    "stream_route_state": (("route_state",), "SELECT * FROM route_state"),
    "stream_state_expiry": (("stop_state", "live_rows"), """
      SELECT * FROM stop_state
      WHERE updated_at + 7200 >= (SELECT max(ingest_ts) FROM live_rows) - 300"""),
    "stream_route_windows": (("feed",), """
      SELECT * FROM (WITH rows AS (SELECT * FROM feed WHERE route_id IS NOT NULL),
      middle AS (SELECT min(ingest_ts) + CAST(floor((max(ingest_ts) - min(ingest_ts)) * 0.5) AS BIGINT) AS m FROM rows),
      before AS (SELECT max(ingest_ts) AS l FROM rows, middle WHERE ingest_ts <= m),
      seen AS (
        SELECT * FROM rows
        UNION ALL SELECT rows.* FROM rows, before WHERE ingest_ts > l - 240 AND ingest_ts <= l)
      SELECT ingest_ts // 300 * 300 - 300 * k AS window_start,
        ingest_ts // 300 * 300 - 300 * k + 900 AS window_end, route_id,
        round(avg(arrival_delay) FILTER (WHERE arrival_delay BETWEEN -1800 AND 7200), 3) AS mean_route_delay_15m,
        count(DISTINCT vehicle_id) AS vehicles_active_on_route
      FROM seen, range(3) AS r(k)
      WHERE ingest_ts // 300 * 300 - 300 * k + 900 <= (SELECT max(ingest_ts) FROM rows) - 300
      GROUP BY ALL)"""),
    "stream_landing": (("feed", "positions"), """
      SELECT record_type, CAST(to_timestamp(ingest_ts) AT TIME ZONE 'UTC' AS DATE) AS dt,
        count(*) AS rows, count(DISTINCT trip_id) AS trips
      FROM (SELECT record_type, ingest_ts, trip_id FROM feed
            UNION ALL SELECT record_type, ingest_ts, trip_id FROM positions) GROUP BY ALL"""),
    "stream_silver": (("silver",), f"SELECT {SILVER_OUT} FROM silver"),
    # --- stored results, read back
    "static_versions": (("dim_stop_times", "dim_stops", "dim_trips", "dim_routes"), """
      SELECT v AS version, name, rows, CASE WHEN v = 'v2' AND name = 'routes' THEN rows ELSE 0 END AS changed,
        CASE WHEN name = 'routes' THEN v ELSE 'v1' END AS held_in
      FROM (SELECT unnest(['v1', 'v2']) AS v), (
        SELECT 'stop_times' AS name, count(*) AS rows FROM dim_stop_times
        UNION ALL SELECT 'stops', count(*) FROM dim_stops
        UNION ALL SELECT 'trips', count(*) FROM dim_trips
        UNION ALL SELECT 'routes', count(*) FROM dim_routes)"""),
    "captured_day": (("predictions",), """
      SELECT service_date, route_id, count(*) * n AS rows, round(sum(predicted_delay_sec) * n, 1) AS total
      FROM predictions, (SELECT max(service_date) AS d FROM predictions),
        (SELECT unnest([0, 1]) AS k, unnest([2, 1]) AS n)
      WHERE service_date = d - CAST(k AS INTEGER) GROUP BY service_date, route_id, n"""),
    "bronze_day_scan": (("feed",), """
      SELECT trip_id, route_id, stop_id, ingest_ts, arrival_time, arrival_delay, dt, "hour"
      FROM feed"""),
    "silver_csv": (("silver",), """
      SELECT CAST(observed_delay_sec AS VARCHAR) AS observed_delay_sec, trip_id, stop_id,
        CAST(service_date AS VARCHAR) AS service_date, route_id FROM silver"""),
    "observed_rows": (("silver",), "SELECT count(*) AS rows FROM silver"),
    "dq_document": (("rules",), """
      SELECT rule, passed, observed, expected, "value", CAST(service_date AS VARCHAR) AS dt
      FROM rules WHERE service_date = (SELECT max(service_date) FROM rules)"""),
    "backtest_document": (("matched", "silver"), f"""
      SELECT m.*, d AS run_date, d AS dt FROM (SELECT {METRICS} FROM matched) m,
        (SELECT CAST(max(service_date) AS VARCHAR) AS d FROM silver)"""),
    "clamped_delays": (("feed",), """
      SELECT trip_id, stop_id, ingest_ts, CASE WHEN arrival_delay BETWEEN -1800 AND 7200
        THEN CAST(arrival_delay AS DOUBLE) END AS delay FROM feed"""),
    # --- operations
    "ingest_windows": (("spine", "feed"), """
      SELECT window_start, coalesce(rows, 0) AS rows, coalesce(rows, 0) < 3 AS stalled
      FROM spine LEFT JOIN (SELECT ingest_ts // 900 * 900 AS window_start, count(*) AS rows
                            FROM feed GROUP BY 1) USING (window_start)"""),
    "missing_runs": (("event_days", "runs"), """
      SELECT day FROM event_days WHERE day NOT IN (SELECT day FROM runs)"""),
    "run_status": (("event_days", "runs"), """
      SELECT e.day, CASE WHEN r.day IS NULL THEN NULL ELSE CAST(1 AS BIGINT) END AS runs,
        CASE WHEN r.day IS NULL THEN NULL ELSE CAST(extract(dow FROM e.day) = 1 AS BIGINT) END
          AS failed,
        CASE WHEN r.day IS NULL THEN NULL ELSE CAST(8 AS DOUBLE) END AS minutes,
        CASE WHEN r.day IS NULL THEN 'missing' WHEN extract(dow FROM e.day) = 1 THEN 'failed'
          ELSE 'ok' END AS verdict
      FROM event_days e LEFT JOIN runs r ON e.day = r.day"""),
    "cost_daily": (("cost_daily",), """
      SELECT day, service, round(amount, 9) AS amount FROM cost_daily"""),
    "cost_totals": (("cost_totals",), "SELECT day, round(total, 9) AS total FROM cost_totals"),
    "cost_delta": (("cost_daily",), """
      SELECT day, service, round(before, 9) AS before, round(now, 9) AS "now",
        round(now - before, 9) AS delta, abs(now - before) >= 0.25 AS moved
      FROM (SELECT coalesce(a.day, b.day + 1) AS day, coalesce(a.service, b.service) AS service,
              coalesce(a.amount, 0) AS now, coalesce(b.amount, 0) AS before
            FROM cost_daily a FULL JOIN cost_daily b
              ON a.day = b.day + 1 AND a.service = b.service)
      WHERE day IN (SELECT day FROM cost_daily) AND day - 1 IN (SELECT day FROM cost_daily)"""),
    "cost_movers": (("cost_daily",), """
      SELECT day, service, round(before, 9) AS before, round(now, 9) AS "now", round(delta, 9) AS delta, rank
      FROM (SELECT *, now - before AS delta, CAST(row_number() OVER (PARTITION BY day
              ORDER BY abs(now - before) DESC, service) AS INTEGER) AS rank
            FROM (SELECT coalesce(a.day, b.day + 1) AS day, coalesce(a.service, b.service) AS service,
                    coalesce(a.amount, 0) AS now, coalesce(b.amount, 0) AS before
                  FROM cost_daily a FULL JOIN cost_daily b
                    ON a.day = b.day + 1 AND a.service = b.service)
            WHERE day IN (SELECT day FROM cost_daily) AND day - 1 IN (SELECT day FROM cost_daily)
              AND abs(now - before) >= 0.25)
      WHERE rank <= 2"""),
    "cost_top_services": (("cost_daily",), """
      SELECT day, service, round(amount, 9) AS amount, rank
      FROM (SELECT *, CAST(row_number() OVER (PARTITION BY day ORDER BY amount DESC, service)
        AS INTEGER) AS rank FROM cost_daily)
      WHERE rank <= 3"""),
    "cost_run_rate": (("cost_rate",), """
      SELECT day, round(total, 9) AS total, round(prior_total, 9) AS prior_total,
        round(median_rate, 9) AS median_rate, round(mean_rate, 9) AS mean_rate, days_in_month,
        round(projected_month, 9) AS projected_month,
        round(projected_from_latest, 9) AS projected_from_latest FROM cost_rate"""),
    "cost_verdict": (("cost_rate",), """
      SELECT day, round(total, 9) AS total, round(median_rate, 9) AS median_rate,
        round(projected_month, 9) AS projected_month,
        CASE WHEN total > {d} THEN 'breached' WHEN prior_total > {d} THEN 'resolved' ELSE 'ok' END
          AS daily_status,
        CASE WHEN projected_month > {m} AND projected_from_latest > {m} THEN 'breached'
          WHEN projected_month > {m} THEN 'stale_window' ELSE 'ok' END AS month_status,
        total > {d} OR (projected_month > {m} AND projected_from_latest > {m}) AS breached,
        mean_rate > 2 * median_rate AS one_day_dominates
      FROM cost_rate WHERE prior_total IS NOT NULL""".format(d=5, m=130)),
    "cost_drivers": (("cost_daily",), """
      SELECT day, service, round(amount, 9) AS amount,
        round(amount / sum(amount) OVER (PARTITION BY day), 9) AS share FROM cost_daily"""),
    "cost_credits": (("costs",), """
      SELECT day, round(abs(sum(amount)), 9) AS credited FROM costs
      WHERE record_type = 'Credit' GROUP BY day"""),
}


# Dates come out as ISO text on both sides, whatever client reads them.
BY_SERVICE_DATE = (
    "silver_enriched silver_terminus silver_clamped silver_upsert silver_merge_whole_row gold_prev_stop "
    "gold_upstream_mean gold_preceding_trip gold_route_hour gold_route_strict "
    "gold_weather_join gold_features feature_vector feature_csv fill_rate feature_mismatches "
    "replayed_mismatches backfill_days gold_weather_stored gold_weather_absent training_split "
    "dq_stats dq_rules dedupe_check coverage null_rates recent_days gold_days layer_diff "
    "backtest_daily time_split stream_silver gbt_stumps captured_day"
).split()
BY_DAY = (
    "model_degraded missing_runs run_status cost_daily cost_totals cost_delta "
    "cost_movers cost_top_services cost_run_rate cost_verdict cost_drivers cost_credits"
).split()
DATES: dict[str, tuple[str, ...]] = {
    **{name: ("service_date",) for name in BY_SERVICE_DATE},
    **{name: ("day",) for name in BY_DAY},
    "gold_priors": ("as_of",),
    "collection_progress": ("first_day", "last_day"),
    "stream_landing": ("dt",),
}


def oracle_sql() -> dict[str, str]:
    out = {}
    for name, (needs, sql) in ORACLES.items():
        if name in DATES:
            as_text = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in DATES[name])
            sql = f"SELECT * REPLACE ({as_text}) FROM ({sql})"
        out[name] = with_ctes(needs, sql)
    return out
