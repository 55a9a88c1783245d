"""The same results in SQL over the given tables, written from the definitions."""

from __future__ import annotations

TZ = "America/New_York"
AS_OF = "TIMESTAMP '2024-01-20 12:00:00'"
_WALL = "%Y-%m-%d %H:%M:%S"
ACTIVITY = "departures_15m, departures_1h, arrivals_15m, arrivals_1h"


def local(ts: str) -> str:
    return f"timezone('{TZ}', timezone('UTC', {ts}))"


def utc(wall: str) -> str:
    return f"timezone('UTC', timezone('{TZ}', {wall}))"


def how(ts: str) -> str:
    return f"CAST((isodow({local(ts)}) - 1) * 24 + hour({local(ts)}) AS BIGINT)"


def millis(ts: str) -> str:
    """Whole milliseconds since the epoch, rounded down."""
    return f"(epoch_us({ts}) // 1000)"


def floor_to(ts: str, step: str) -> str:
    return f"time_bucket(INTERVAL '{step}', {ts})"


def grid(name: str, step: str) -> str:
    """CTEs `<name>_c` (counts per bucket) and `<name>` (dense)."""
    return f"""
    {name}_c AS MATERIALIZED (
      SELECT user_id AS k, {floor_to('ts', step)} AS b,
             count(*) FILTER (event_type = 'click') AS d, count(*) FILTER (event_type = 'view') AS a
      FROM events GROUP BY ALL),
    {name}_g AS (
      SELECT k, unnest(generate_series(min(b), max(b), INTERVAL '{step}')) AS b
      FROM {name}_c GROUP BY k),
    {name} AS MATERIALIZED (
      SELECT g.k, g.b, coalesce(c.d, 0) AS d, coalesce(c.a, 0) AS a
      FROM {name}_g g LEFT JOIN {name}_c c ON c.k = g.k AND c.b = g.b)"""


def windows(source: str) -> str:
    """Trailing counts of a relation (k, kind, ts)."""
    return f"""
      SELECT k, e,
        count(*) FILTER (kind = 'click' AND ts >= e - INTERVAL '15 minutes') AS departures_15m,
        count(*) FILTER (kind = 'click') AS departures_1h,
        count(*) FILTER (kind = 'view' AND ts >= e - INTERVAL '15 minutes') AS arrivals_15m,
        count(*) FILTER (kind = 'view') AS arrivals_1h
      FROM (SELECT k, kind, ts,
              {floor_to('ts', '15 minutes')} + (i + 1) * INTERVAL '15 minutes' AS e
            FROM {source}, range(4) r(i))
      GROUP BY k, e"""


QUARTERS = grid("quarters", "15 minutes")
HOURS = grid("hours", "1 hour")
ACTIVE = f"""{QUARTERS},
    beating AS (SELECT user_id AS k, event_type AS kind, ts FROM events
                UNION ALL SELECT k, 'heartbeat', b FROM quarters_g),
    activity AS MATERIALIZED ({windows('beating')})"""
PROFILE = f"""{HOURS},
    profile AS MATERIALIZED (
      SELECT k, h, b + INTERVAL '1 hour' AS e, avg(d) OVER w AS avg_departures_4w,
             avg(a) OVER w AS avg_arrivals_4w
      FROM (SELECT *, {how('b')} AS h FROM hours)
      WINDOW w AS (PARTITION BY k, h ORDER BY b ROWS BETWEEN 3 PRECEDING AND CURRENT ROW))"""
WEATHER = f"""
    weather AS MATERIALIZED (
      SELECT user_id % 5 AS region_id, {floor_to('ts', '1 hour')} AS e, max(value) AS temperature_c,
             min(value) AS precipitation_mm, max(value * 2) AS wind_speed_kmh
      FROM events GROUP BY ALL)"""
STATUS = """
    status AS (
      SELECT user_id AS station_id, ts AS e, CAST(floor(value) AS BIGINT) AS num_bikes_available,
        CAST(floor(floor(value) / 4) AS BIGINT) AS num_ebikes_available,
        CAST(400 - floor(value) AS BIGINT) AS num_docks_available,
        CASE WHEN CAST(floor(value) AS BIGINT) % 3 = 0 THEN NULL ELSE CAST(1 AS BIGINT) END
          AS is_renting
      FROM events WHERE event_type = 'signup')"""
# Needs the quarters CTE.
LABELS = """
    labels_of AS MATERIALIZED (
      SELECT k, b AS e, y FROM (
        SELECT k, b, CAST(sum(d) OVER w AS BIGINT) AS y, count(d) OVER w AS n FROM quarters
        WINDOW w AS (PARTITION BY k ORDER BY b ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING))
      WHERE n = 4)"""
TRIPS = f"""
    raw AS (
      SELECT concat(l_orderkey, '-', l_linenumber) AS ride_id, {utc('o_orderdate')} AS started_at,
        {utc('l_shipdate')} AS ended_at, concat('C', o_custkey) AS start_station_id,
        concat('S', l_suppkey) AS end_station_id
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey
      WHERE l_discount <> 0),
    trips AS (
      SELECT * EXCLUDE (n) FROM (
        SELECT *, row_number() OVER (PARTITION BY ride_id ORDER BY started_at, ended_at,
          start_station_id, end_station_id) AS n
        FROM raw WHERE ended_at >= started_at)
      WHERE n = 1)"""


def joined(weather_of: str = "l.k % 5") -> str:
    """CTEs up to `pit`: labels with every feature as known at their time.

    Labels and activity lie on the same grid of quarters without gaps, so the activity known at a
    label's time is the one of that time. CTEs that are large or read twice are materialised.
    """
    return f"""{ACTIVE}, {HOURS.strip()}, {PROFILE[len(HOURS) + 1 :].strip()}, {WEATHER}, {LABELS},
    keyed AS MATERIALIZED (SELECT l.k, l.e, l.y, {how('l.e')} AS h, {weather_of} AS r FROM labels_of l),
    j1 AS MATERIALIZED (
      SELECT l.*, f.e AS fe1, {', '.join(f'f.{c}' for c in ACTIVITY.split(', '))}
      FROM keyed l LEFT JOIN activity f ON l.k = f.k AND l.e = f.e),
    j2 AS MATERIALIZED (
      SELECT l.*, f.e AS fe2, f.avg_departures_4w, f.avg_arrivals_4w
      FROM j1 l ASOF LEFT JOIN profile f ON l.k = f.k AND l.h = f.h AND l.e >= f.e),
    j3 AS (
      SELECT l.*, f.e AS fe3, f.temperature_c, f.precipitation_mm, f.wind_speed_kmh
      FROM j2 l ASOF LEFT JOIN weather f ON l.r = f.region_id AND l.e >= f.e),
    pit AS MATERIALIZED (
      SELECT k AS station_id, e AS event_timestamp, y AS target_departures_next_1h,
        h AS hour_of_week, r AS region_id,
        {', '.join(f"CASE WHEN e - fe1 <= INTERVAL '30 minutes' THEN {c} END AS {c}"
                   for c in ACTIVITY.split(', '))},
        {', '.join(f"CASE WHEN e - fe2 <= INTERVAL '90 days' THEN {c} END AS {c}"
                   for c in ('avg_departures_4w', 'avg_arrivals_4w'))},
        {', '.join(f"CASE WHEN e - fe3 <= INTERVAL '3 hours' THEN {c} END AS {c}"
                   for c in ('temperature_c', 'precipitation_mm', 'wind_speed_kmh'))}
      FROM j3)"""


MODEL_COLUMNS = """
    coalesce(CAST(departures_15m AS DOUBLE), 0) AS departures_15m,
    coalesce(CAST(departures_1h AS DOUBLE), 0) AS departures_1h,
    coalesce(CAST(arrivals_15m AS DOUBLE), 0) AS arrivals_15m,
    coalesce(CAST(arrivals_1h AS DOUBLE), 0) AS arrivals_1h,
    coalesce(avg_departures_4w, 0) AS avg_departures_4w,
    coalesce(avg_arrivals_4w, 0) AS avg_arrivals_4w,
    temperature_c, precipitation_mm, wind_speed_kmh,
    coalesce(avg_arrivals_4w - avg_departures_4w, 0) AS typical_net_flow_4w,
    CAST(coalesce(arrivals_1h, 0) - coalesce(departures_1h, 0) AS DOUBLE) AS net_flow_1h,
    CAST(coalesce(departures_1h, 0) AS DOUBLE) / (coalesce(avg_departures_4w, 0) + 1.0::DOUBLE)
      AS demand_vs_profile,
    CAST(hour_of_week % 24 AS DOUBLE) AS hour_of_day,
    CAST(hour_of_week // 24 AS DOUBLE) AS day_of_week"""


def newest(relation: str, keys: str, ts: str = "e", where: str = "TRUE") -> str:
    return f"""SELECT * EXCLUDE (n) FROM (
        SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {ts} DESC) AS n
        FROM {relation} WHERE {where}) WHERE n = 1"""


KNOWN = f"e <= {AS_OF}"
STATUS_COLUMNS = ("num_bikes_available", "num_ebikes_available", "num_docks_available", "is_renting")


def blanked(view: str, ttl: str, columns: tuple[str, ...]) -> str:
    old = f"coalesce({AS_OF} - {view}.e > INTERVAL '{ttl}', FALSE)"
    values = ", ".join(f"CASE WHEN NOT {old} THEN {view}.{c} END AS {c}" for c in columns)
    names = {"a": "station_recent_activity", "p": "station_hourly_profile",
             "w": "weather_hourly", "s": "station_live_status"}
    return f"{values}, {view}.e AS {names[view]}__ts, {old} AS {names[view]}__expired"


LOOKUP = f"""{ACTIVE}, {HOURS.strip()}, {PROFILE[len(HOURS) + 1 :].strip()}, {WEATHER}, {STATUS},
    la AS ({newest('activity', 'k', where=KNOWN)}),
    lp AS ({newest('profile', 'k, h', where=KNOWN)}),
    lw AS ({newest('weather', 'region_id', where=KNOWN)}),
    ls AS ({newest('status', 'station_id', where=KNOWN)}),
    ent AS (SELECT c_custkey AS station_id, {how(AS_OF)} AS hour_of_week,
                   c_custkey % 5 AS region_id FROM customer),
    found AS (
      SELECT ent.*, {blanked('a', '30 minutes', tuple(ACTIVITY.split(', ')))},
        {blanked('p', '90 days', ('avg_departures_4w', 'avg_arrivals_4w'))},
        {blanked('w', '3 hours', ('temperature_c', 'precipitation_mm', 'wind_speed_kmh'))},
        {blanked('s', '2 days', STATUS_COLUMNS)}
      FROM ent LEFT JOIN la a ON a.k = ent.station_id
        LEFT JOIN lp p ON p.k = ent.station_id AND p.h = ent.hour_of_week
        LEFT JOIN lw w ON w.region_id = ent.region_id
        LEFT JOIN ls s ON s.station_id = ent.station_id),
    lookup AS (SELECT *, avg_arrivals_4w - avg_departures_4w AS typical_net_flow_4w FROM found)"""

VIEW_VALUES = {
    "station_recent_activity": "departures_1h",
    "station_hourly_profile": "avg_departures_4w",
    "weather_hourly": "temperature_c",
    "station_live_status": "num_bikes_available",
}


def freshness(views: tuple[str, ...]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{v}' AS view,
              (epoch_us({AS_OF}) - epoch_us(max({v}__ts) FILTER (NOT {v}__expired
                AND {VIEW_VALUES[v]} IS NOT NULL))) / 1000000 AS age_seconds,
              count(*) FILTER ({v}__expired) AS expired FROM lookup"""
        for v in views
    )


def age_text(s: str) -> str:
    def shown(size: int, unit: str) -> str:
        return f"CAST(round_even({s} / {size}, 0) AS BIGINT) || ' {unit} old'"

    return f"""CASE WHEN {s} IS NULL THEN 'no data' WHEN {s} < 120 THEN {shown(1, 's')}
      WHEN {s} < 7200 THEN {shown(60, 'min')} WHEN {s} < 172800 THEN {shown(3600, 'h')}
      ELSE {shown(86400, 'days')} END"""


REPORT = f"""{LOOKUP},
    places AS (SELECT c_custkey AS station_id, CASE WHEN c_acctbal >= 0 THEN c_name END AS name,
        CASE WHEN c_nationkey % 7 <> 0 THEN 40 + c_nationkey / 64 END AS lat,
        CASE WHEN c_nationkey % 7 <> 0 THEN -74 - c_nationkey / 128 END AS lon FROM customer),
    report AS (
      SELECT l.station_id, name, lat, lon,
        round(greatest(coalesce(avg_departures_4w, 0) * 60, 0), 2)
          AS predicted_departures_next_hour,
        num_bikes_available AS bikes_available, num_docks_available AS docks_available, is_renting,
        coalesce(round(greatest(coalesce(avg_departures_4w, 0) * 60, 0), 2) > num_bikes_available,
          FALSE) AS stockout_risk,
        departures_1h, arrivals_1h, avg_departures_4w, temperature_c
      FROM lookup l LEFT JOIN places p ON p.station_id = l.station_id),
    display AS (
      SELECT coalesce(name, CAST(station_id AS VARCHAR)) AS station, station_id, lat, lon,
        predicted_departures_next_hour AS predicted, bikes_available AS bikes_now,
        docks_available AS docks_now, coalesce(departures_1h, 0) AS departures_last_hour,
        coalesce(avg_departures_4w, 0) AS typical_for_hour,
        CASE WHEN stockout_risk THEN 'may run out' ELSE 'ok' END AS risk,
        stockout_risk AS at_risk
      FROM report)"""

EVENT_COLUMNS = "event_id, user_id AS station_id, event_type, ts AS event_ts"
COUNTS = "b AS bucket, d AS departures, a AS arrivals"
PERIOD = "strftime(o_orderdate, '%Y%m')"
DATED = f"SELECT o_orderkey, o_custkey, o_orderdate, {PERIOD} AS period FROM orders"
TEXT_KEYED = "SELECT event_id, printf('U%04d', user_id) AS station_id, event_type, ts AS event_ts FROM events"
IN_SCOPE = "(station_id LIKE 'U00%' OR station_id LIKE 'U012%')"
ASOF_SIGNUP = """
    SELECT p.event_id, p.user_id AS station_id, p.ts AS event_timestamp, {value} AS value,
           {at} AS feature_ts
    FROM (SELECT * FROM events WHERE event_type = 'purchase') p
    ASOF LEFT JOIN (SELECT user_id, ts, max(value) AS value FROM events
                    WHERE event_type = 'signup' GROUP BY ALL) s
      ON p.user_id = s.user_id AND p.ts >= s.ts"""
RECENT = "p.ts - s.ts <= INTERVAL '36 hours'"


def weather_where(condition: str, temperature: str) -> str:
    return f"""SELECT user_id % 5 AS region_id, {floor_to('ts', '1 hour')} AS event_timestamp,
        {temperature} AS temperature_c, min(value) AS precipitation_mm,
        max(value * 2) AS wind_speed_kmh
      FROM events WHERE {condition} GROUP BY ALL"""


ORACLES: dict[str, str] = {
    "hour_of_week": f"SELECT event_id, {how('ts')} AS hour_of_week FROM events",
    "epoch_millis": f"""SELECT event_id, {millis('ts')} AS event_ts_ms,
        make_timestamp({millis('ts')} * 1000) AS event_ts FROM events""",
    "json_extract": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
    "age_label": f"""SELECT event_id, s AS age_seconds, {age_text('s')} AS age FROM (
        SELECT event_id, CASE WHEN d >= 0 THEN d END AS s FROM (
          SELECT event_id, CAST(epoch({AS_OF}) AS BIGINT) - CAST(floor(epoch(ts)) AS BIGINT) AS d
          FROM events))""",
    "json_envelope": f"""SELECT CAST(user_id AS VARCHAR) AS key, CAST(to_json({{'event_id': event_id,
        'station_id': user_id, 'event_type': event_type, 'event_ts_ms': {millis('ts')}}}) AS VARCHAR)
        AS value FROM events""",
    "normalize_trips": f"WITH {TRIPS} SELECT * FROM trips",
    "trip_events": f"""WITH {TRIPS}
        SELECT ride_id || ':d' AS event_id, start_station_id AS station_id,
               'departure' AS event_type, started_at AS event_ts FROM trips
        UNION ALL SELECT ride_id || ':a', end_station_id, 'arrival', ended_at FROM trips""",
    "scope_filter_pushdown": """SELECT c_custkey, c_name FROM customer
        WHERE c_name LIKE 'Customer#00000000%' OR c_name LIKE 'Customer#0000001%'""",
    "scope_filter": f"SELECT * FROM ({TEXT_KEYED}) WHERE {IN_SCOPE}",
    "scope_complement": f"SELECT * FROM ({TEXT_KEYED}) WHERE NOT {IN_SCOPE}",
    "dedupe_events": f"SELECT {EVENT_COLUMNS} FROM events",
    "newest_periods": f"""SELECT * FROM ({DATED}) WHERE period IN (
        SELECT DISTINCT {PERIOD} FROM orders ORDER BY 1 DESC LIMIT 3)""",
    "skip_loaded_periods": f"""SELECT * FROM ({DATED}) WHERE period NOT IN (
        SELECT strftime(l_shipdate, '%Y%m') FROM lineitem
        WHERE l_returnflag = 'R' AND l_shipdate < TIMESTAMP '1998-01-01 00:00:00')""",
    "backfill_range": """SELECT CAST(unnest(generate_series(
          CAST(date_trunc('month', min(ts)) AS TIMESTAMP) - INTERVAL '1 day',
          TIMESTAMP '2024-01-20 00:00:00', INTERVAL '1 day')) AS DATE) AS day FROM events""",
    "observed_only": f"SELECT {EVENT_COLUMNS} FROM events WHERE ts <= {AS_OF}",
    "heartbeats": f"""WITH {QUARTERS} SELECT concat('hb:', k, ':', {millis('b')}) AS event_id,
        k AS station_id, 'heartbeat' AS event_type, b AS event_ts FROM quarters_g""",
    "status_heartbeats": f"""SELECT concat('hb:', user_id, ':', {millis('ts')}) AS event_id,
        user_id AS station_id, 'heartbeat' AS event_type,
        make_timestamp({millis('ts')} * 1000) AS event_ts
        FROM events WHERE event_type = 'signup'""",
    "hourly_counts": f"WITH {HOURS} SELECT k AS station_id, {COUNTS} FROM hours_c",
    "tumbling_counts": f"WITH {QUARTERS} SELECT k AS station_id, {COUNTS} FROM quarters_c",
    "dense_grid": f"WITH {QUARTERS} SELECT k AS station_id, {COUNTS} FROM quarters",
    "activity_with_zeros": f"""WITH {ACTIVE}
        SELECT k AS station_id, e AS event_timestamp, {ACTIVITY} FROM activity""",
    "seasonal_profile": f"""WITH {PROFILE} SELECT k AS station_id, h AS hour_of_week,
        e AS event_timestamp, avg_departures_4w, avg_arrivals_4w FROM profile""",
    "on_demand_net_flow": f"""WITH {PROFILE} SELECT k AS station_id, h AS hour_of_week,
        e AS event_timestamp, avg_arrivals_4w - avg_departures_4w AS typical_net_flow_4w
        FROM profile""",
    "forward_label": f"""WITH {QUARTERS}, {LABELS} SELECT k AS station_id, e AS event_timestamp,
        y AS target_departures_next_1h FROM labels_of""",
    "id_map_join": """SELECT l_orderkey, l_linenumber, l_quantity, s_name AS station_id
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""",
    "parallel_arrays_to_rows": f"""SELECT event_id AS region_id, h AS event_timestamp,
          value AS temperature_c, CAST(NULL AS DOUBLE) AS precipitation_mm, value AS wind_speed_kmh
        FROM (SELECT *, {floor_to('ts', '1 hour')} AS h FROM events)
        UNION ALL SELECT event_id, h + INTERVAL '2 hours', value + 1, value, value
        FROM (SELECT *, {floor_to('ts', '1 hour')} AS h FROM events)""",
    "flatten_stations": """SELECT c_name AS station_id, concat('u', c_custkey) AS gbfs_station_id,
        c_name AS name, CAST(c_nationkey AS DOUBLE) AS lat, c_nationkey / -2 AS lon
        FROM customer WHERE c_acctbal >= 0 AND c_name NOT LIKE 'Customer#00000000%'""",
    "flatten_status": """WITH pairs AS (
          SELECT user_id AS id, ts, CAST(floor(value) AS BIGINT) AS bikes, CAST(1 AS BIGINT) AS renting
          FROM events WHERE event_type <> 'error'
          UNION ALL SELECT user_id + 1000, ts, 0, 0 FROM events WHERE event_type <> 'error')
        SELECT c_name AS station_id, CAST(floor(epoch(ts)) AS BIGINT) * 1000 AS event_ts_ms,
          bikes AS num_bikes_available, CAST(0 AS BIGINT) AS num_ebikes_available,
          CAST(0 AS BIGINT) AS num_docks_available, CAST(0 AS BIGINT) AS num_bikes_disabled,
          CAST(0 AS BIGINT) AS num_docks_disabled, renting AS is_renting,
          CAST(0 AS BIGINT) AS is_returning
        FROM pairs JOIN customer ON c_custkey = id""",
    "merge_prefer_first": f"""WITH archive AS ({weather_where(f'ts < {AS_OF}', 'max(value)')}),
        recent AS ({weather_where(f"ts >= {AS_OF} - INTERVAL '7 days'", 'avg(value) * 0')})
        SELECT * FROM archive UNION ALL SELECT * FROM recent r WHERE NOT EXISTS (
          SELECT 1 FROM archive a
          WHERE a.region_id = r.region_id AND a.event_timestamp = r.event_timestamp)""",
    "only_changed": f"""SELECT event_id, station_id, event_type, event_ts, stamp FROM (
        SELECT *, lag(stamp) OVER (PARTITION BY station_id ORDER BY event_ts, event_id) AS before
        FROM (SELECT {EVENT_COLUMNS}, {floor_to('ts', '6 hours')} AS stamp FROM events))
        WHERE before IS NULL OR before <> stamp""",
    "asof_join": ASOF_SIGNUP.format(value="s.value", at="s.ts"),
    "asof_join_ttl": ASOF_SIGNUP.format(
        value=f"CASE WHEN {RECENT} THEN s.value END", at=f"CASE WHEN {RECENT} THEN s.ts END"
    ),
    "asof_join_hot_keys": f"""WITH {WEATHER}, found AS (
        SELECT l.event_id, l.user_id % 5 AS region_id, l.ts, w.* EXCLUDE (region_id)
        FROM events l ASOF LEFT JOIN weather w ON l.user_id % 5 = w.region_id AND l.ts >= w.e)
        SELECT event_id, region_id, ts AS event_timestamp,
          CASE WHEN ts - e <= INTERVAL '3 hours' THEN temperature_c END AS temperature_c,
          CASE WHEN ts - e <= INTERVAL '3 hours' THEN precipitation_mm END AS precipitation_mm,
          CASE WHEN ts - e <= INTERVAL '3 hours' THEN wind_speed_kmh END AS wind_speed_kmh,
          CASE WHEN ts - e <= INTERVAL '3 hours' THEN e END AS feature_ts
        FROM found""",
    "point_in_time_service": f"""WITH {joined()}
        SELECT *, avg_arrivals_4w - avg_departures_4w AS typical_net_flow_4w FROM pit""",
    "model_frame": f"WITH {joined()} SELECT station_id, event_timestamp, {MODEL_COLUMNS} FROM pit",
    "training_set": f"""WITH {joined('CAST(3 AS BIGINT)')}
        SELECT station_id, event_timestamp, target_departures_next_1h, {MODEL_COLUMNS} FROM pit""",
    "time_split": f"""WITH {QUARTERS}, {LABELS} SELECT k AS station_id, e AS event_timestamp,
        y AS target_departures_next_1h,
        epoch_us(e) > (SELECT quantile_cont(epoch_us(e), 0.8) FROM labels_of) AS is_validation
        FROM labels_of""",
    "error_metrics": f"""WITH {joined()}, held AS (
          SELECT target_departures_next_1h AS y, coalesce(avg_departures_4w, 0) AS p,
                 coalesce(departures_1h, 0) AS q FROM pit
          WHERE epoch_us(event_timestamp) > (
            SELECT quantile_cont(epoch_us(event_timestamp), 0.8) FROM pit))
        SELECT 'baseline_profile' AS predictor, round(avg(abs(y - p)), 6) AS mae,
               round(sqrt(avg((y - p) * (y - p))), 6) AS rmse FROM held
        UNION ALL SELECT 'baseline_last_hour', round(avg(abs(y - q)), 6),
               round(sqrt(avg((y - q) * (y - q))), 6) FROM held""",
    "latest_per_key": f"""SELECT {EVENT_COLUMNS} FROM ({newest('events', 'user_id', 'ts DESC, event_id')})""",
    "upsert_latest": f"""SELECT {EVENT_COLUMNS} FROM ({newest('events', 'user_id', 'ts DESC, event_id')})""",
    "materialize_latest": f"""WITH {STATUS} SELECT station_id, e AS event_timestamp,
        {', '.join(STATUS_COLUMNS)} FROM ({newest('status', 'station_id',
            where=f"e > {AS_OF} - INTERVAL '10 days' AND {KNOWN}")})""",
    "online_lookup": f"WITH {LOOKUP} SELECT * FROM lookup",
    "feature_freshness": f"WITH {LOOKUP} {freshness(tuple(VIEW_VALUES))}",
    "freshness_status": f"""WITH {LOOKUP}, ages AS ({freshness(tuple(VIEW_VALUES)[:3])}),
        limits(view, label, allowed) AS (VALUES
          ('station_recent_activity', 'Trip activity (stream)', 1800),
          ('station_live_status', 'Bike availability (stream)', 600),
          ('weather_hourly', 'Weather (stream)', 10800),
          ('station_hourly_profile', 'Weekly profile (batch)', 7776000))
        SELECT l.view, label, round(age_seconds, 3) AS age_seconds,
          CASE WHEN age_seconds IS NULL THEN 'no data yet' WHEN age_seconds > allowed THEN 'stale'
               ELSE 'fresh' END AS state, {age_text('age_seconds')} AS age
        FROM limits l LEFT JOIN ages a ON a.view = l.view""",
    "score_report": f"WITH {REPORT} SELECT * FROM report",
    "report_table": f"WITH {REPORT} SELECT * FROM display",
    "top_k": f"""WITH {REPORT} SELECT * FROM display
        ORDER BY predicted DESC, station_id LIMIT 15""",
    "report_kpis": f"""WITH {REPORT} SELECT count(*) AS stations,
        round(sum(predicted), 6) AS expected_departures, count(*) FILTER (at_risk) AS at_risk,
        round(avg(lat), 6) AS centre_lat, round(avg(lon), 6) AS centre_lon FROM display""",
    "map_points": f"""WITH {REPORT} SELECT station_id,
        CASE WHEN at_risk THEN '208,59,59,220' ELSE '42,120,214,200' END AS color,
        25 + 18 * predicted AS radius FROM display WHERE lat IS NOT NULL""",
    "replay": f"""WITH ev AS (SELECT * FROM events WHERE event_type IN ('click', 'view')),
        shift AS (SELECT greatest(0, CAST(ceil(epoch({local("TIMESTAMP '2024-03-12 00:00:00'")}
          - max(ts)) / 604800) AS BIGINT)) AS weeks FROM ev),
        moved AS (SELECT ev.*, weeks, ts + weeks * INTERVAL '7 days' AS wall FROM ev, shift),
        placed AS (SELECT *, {utc('wall')} AS placed_at FROM moved)
        SELECT concat(event_id, ':', CASE event_type WHEN 'click' THEN 'd' ELSE 'a' END, ':', weeks)
            AS event_id, CAST(event_id AS VARCHAR) AS ride_id,
          CASE event_type WHEN 'click' THEN 'departure' ELSE 'arrival' END AS event_type,
          user_id AS station_id, {millis('placed_at')} AS event_ts_ms
        FROM placed WHERE {local('placed_at')} = wall
          AND placed_at > TIMESTAMP '2024-03-05 00:00:00'
          AND placed_at <= TIMESTAMP '2024-03-12 00:00:00'""",
    "stream_latest_status": f"""WITH {STATUS} SELECT station_id, e AS event_timestamp,
        num_bikes_available FROM ({newest('status', 'station_id')})""",
}
_DIRECT = f"""SELECT k AS station_id, e AS event_timestamp, {ACTIVITY} FROM (
    {windows('(SELECT user_id AS k, event_type AS kind, ts FROM events)')})"""
_AS_ON_TABLES = ("trailing_activity_one_pass", "stream_trailing_activity")
ORACLES |= dict.fromkeys(("trailing_activity", *_AS_ON_TABLES), _DIRECT)
ORACLES["asof_join_ttl_interval"] = ORACLES["asof_join_ttl"]
ORACLES["asof_join_hot_keys_interval"] = ORACLES["asof_join_hot_keys"]
ORACLES["stream_only_changed"] = ORACLES["only_changed"]
ORACLES["table_by_name"] = f"SELECT {EVENT_COLUMNS} FROM events"
ORACLES["trips_of_two_layouts"] = f"""SELECT concat(l_orderkey, '-', l_linenumber) AS ride_id,
      strftime(o_orderdate, '{_WALL}') AS started_at,
      CASE WHEN l_discount = 0 THEN 'unknown' ELSE strftime(l_shipdate, '{_WALL}') END AS ended_at,
      concat('C', o_custkey) AS start_station_id, concat('S', l_suppkey) AS end_station_id
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
ORACLES["latest_corrections"] = f"""SELECT station_id, event_timestamp, reading FROM (
      SELECT user_id AS station_id, {floor_to('ts', '1 hour')} AS event_timestamp,
             event_id AS reading,
             row_number() OVER (PARTITION BY user_id ORDER BY {floor_to('ts', '1 hour')} DESC,
               event_id % 3 DESC, event_id DESC) AS place FROM events)
    WHERE place = 1"""
# A pass shifts by w weeks and lasts until the shifted end of the data, so it plays the last week.
ORACLES["replay_job"] = f"""WITH ev AS (SELECT * FROM events WHERE event_type IN ('click', 'view')),
    final AS (SELECT * FROM ev WHERE ts > (SELECT max(ts) FROM ev) - INTERVAL '7 days'),
    moved AS (SELECT final.*, weeks, ts + weeks * INTERVAL '7 days' AS wall
              FROM final, range(20) w(weeks)),
    placed AS (SELECT *, {utc('wall')} AS placed_at FROM moved)
    SELECT concat(event_id, ':', CASE event_type WHEN 'click' THEN 'd' ELSE 'a' END, ':', weeks)
        AS event_id, CAST(event_id AS VARCHAR) AS ride_id,
      CASE event_type WHEN 'click' THEN 'departure' ELSE 'arrival' END AS event_type,
      user_id AS station_id, {millis('placed_at')} AS event_ts_ms
    FROM placed WHERE {local('placed_at')} = wall
      AND placed_at > TIMESTAMP '2024-03-05 00:00:00'
      AND placed_at <= TIMESTAMP '2024-03-12 00:00:00'"""
ORACLES["stream_refreshed_names"] = """SELECT event_id, c_custkey AS station_id, c_name
    FROM events JOIN customer ON user_id = c_custkey
    WHERE c_custkey % 2 = 0 OR ts >= TIMESTAMP '2024-01-22 00:00:00'"""
ORACLES["seeded_cap"] = f"""SELECT {EVENT_COLUMNS} FROM events
    ORDER BY CAST('0x' || substr(md5('7:' || event_id), 1, 15) AS BIGINT) LIMIT 1000"""
