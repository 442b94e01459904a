"""Independent SQL statement of each registered query, for DuckDB.

The SQL restates the semantics from scratch (no Spark plan is translated):
the same fixed feed mapping of ``events``, the same split and evaluation
instant, the same tie-breaks. DuckDB is set to UTC by the checker; every
timestamp here is a naive UTC wall-clock value.
"""

from __future__ import annotations

HISTORY_UNTIL = "TIMESTAMP '2024-01-24 00:00:00'"
AS_OF = "TIMESTAMP '2024-01-28 12:00:00'"
WINDOW_FROM = "TIMESTAMP '2024-01-28 06:00:00'"      # AS_OF - 6 hours
SIZE_US = 6 * 3600 * 1_000_000
SLIDE_US = 3600 * 1_000_000
K = SIZE_US // SLIDE_US


def rb(x: str, d: int) -> str:
    """Half-even rounding of a DOUBLE on its shortest decimal form (as Spark's bround)."""
    dec = f"cast(cast({x} AS VARCHAR) AS DECIMAL(38,18))"
    sc = f"({dec} * {10 ** d})"
    t = f"trunc({sc})"
    fr = f"abs({sc} - {t})"
    r = (f"(CASE WHEN {fr} > 0.5 THEN {t} + sign({sc}) WHEN {fr} < 0.5 THEN {t} "
         f"WHEN {t} % 2 = 0 THEN {t} ELSE {t} + sign({sc}) END)")
    return f"(cast({r} AS DOUBLE) / {10 ** d})"


EV = """ev AS (
  SELECT cast(event_id AS VARCHAR) AS event_id,
         ts AS event_ts,
         'R' || lpad(cast(user_id % 12 AS VARCHAR), 2, '0') AS route_id,
         'T' || cast(user_id AS VARCHAR) AS trip_id,
         cast(json_extract_string(props, '$.k') AS INTEGER) AS stop_sequence,
         CASE WHEN event_type = 'view' THEN NULL
              ELSE cast(floor(value * 4) - 60 AS INTEGER) END AS delay_seconds,
         CASE WHEN event_type = 'view' THEN 'tfi_vehicle_positions'
              ELSE 'tfi_trip_updates' END AS source
  FROM events)"""

CLEAN = """clean AS (
  SELECT *, dayname(event_ts) AS day_of_week, cast(hour(event_ts) AS INTEGER) AS hour_of_day
  FROM ev WHERE route_id IS NOT NULL AND delay_seconds IS NOT NULL)"""

HIST = f"hist AS (SELECT * FROM clean WHERE event_ts < {HISTORY_UNTIL})"

WHOLE = "hist AS (SELECT * FROM clean)"

STATS = """stats AS (
  SELECT route_id, day_of_week, hour_of_day, avg(delay_seconds) AS avg_delay,
         max(delay_seconds) AS max_delay, count(*) AS observations
  FROM hist GROUP BY route_id, day_of_week, hour_of_day)"""

BVIEW = """bview AS (
  SELECT route_id, day_of_week || '_' || lpad(cast(hour_of_day AS VARCHAR), 2, '0') AS time_bucket,
         avg_delay AS avg_delay_seconds
  FROM stats WHERE day_of_week IS NOT NULL AND hour_of_day IS NOT NULL)"""

SPD = """spd AS (
  SELECT * FROM ev
  WHERE route_id IS NOT NULL AND route_id <> '' AND delay_seconds IS NOT NULL
    AND source = 'tfi_trip_updates')"""

LIVE = f"livespd AS (SELECT * FROM spd WHERE event_ts >= {HISTORY_UNTIL})"


def bucket(ts: str) -> str:
    return f"(dayname({ts}) || '_' || lpad(cast(hour({ts}) AS VARCHAR), 2, '0'))"


def sliding(src: str) -> str:
    return f"""
  SELECT make_timestamp(ws) AS window_start, make_timestamp(ws + {SIZE_US}) AS window_end, route_id,
         count(*) AS event_count, avg(delay_seconds) AS avg_delay_seconds,
         max(delay_seconds) AS max_delay_seconds,
         cast(sum(CASE WHEN delay_seconds > 60 THEN 1 ELSE 0 END) AS BIGINT) AS late_count
  FROM (SELECT route_id, delay_seconds, (epoch_us(event_ts) // {SLIDE_US} - i) * {SLIDE_US} AS ws
        FROM (SELECT *, unnest(range(0, {K})) AS i FROM {src}))
  GROUP BY ws, route_id"""


LW = f"lw AS ({sliding('livespd')})"

ALLW = f"lw AS ({sliding('spd')})"

SR = f"""sr AS (
  SELECT w.window_start, w.window_end, w.route_id, w.tb AS time_bucket, w.event_count,
         {rb("w.avg_delay_seconds", 2)} AS avg_delay_seconds, w.max_delay_seconds, w.late_count,
         {rb("b.avg_delay_seconds", 2)} AS batch_baseline_seconds,
         {rb("CASE WHEN b.avg_delay_seconds > 0 THEN w.avg_delay_seconds / b.avg_delay_seconds END", 2)}
           AS anomaly_ratio,
         coalesce(CASE WHEN b.avg_delay_seconds > 0
                       THEN w.avg_delay_seconds / b.avg_delay_seconds END > 2.0, false) AS is_anomaly
  FROM (SELECT *, {bucket('window_end')} AS tb FROM lw) w
  LEFT JOIN bview b ON w.route_id = b.route_id AND w.tb = b.time_bucket)"""

WS = f"""ws AS (
  SELECT {AS_OF} AS window_end, route_id, count(*) AS event_count,
         avg(delay_seconds) AS avg_delay_seconds, max(delay_seconds) AS max_delay_seconds,
         cast(sum(CASE WHEN delay_seconds > 60 THEN 1 ELSE 0 END) AS BIGINT) AS late_count
  FROM spd WHERE event_ts >= {WINDOW_FROM} AND event_ts <= {AS_OF}
  GROUP BY route_id)"""

TOPLIVE = f"""toplive AS (
  SELECT window_end, cast(row_number() OVER (ORDER BY avg_delay_seconds DESC, route_id) AS INTEGER) AS "rank",
         route_id, {rb("avg_delay_seconds", 1)} AS avg_delay_seconds, max_delay_seconds, event_count
  FROM ws ORDER BY avg_delay_seconds DESC, route_id LIMIT 5)"""

SNAP = f"""snap AS (
  SELECT window_end, cast("rank" AS INTEGER) AS "rank", route_id,
         {rb("avg_delay_seconds", 1)} AS avg_delay_seconds, max_delay_seconds, event_count
  FROM (SELECT *, row_number() OVER (PARTITION BY window_end
                                     ORDER BY avg_delay_seconds DESC, route_id) AS "rank" FROM lw)
  WHERE "rank" <= 5)"""

LATESTSNAP = f"""latestsnap AS (
  SELECT * FROM snap
  WHERE window_end = (SELECT max(window_end) FROM snap WHERE window_end <= {AS_OF}))"""

LATEST = f"""latest AS (
  SELECT route_id, window_start, window_end, event_count, avg_delay_seconds, max_delay_seconds,
         late_count, batch_baseline_seconds, anomaly_ratio, is_anomaly
  FROM (SELECT *, row_number() OVER (PARTITION BY route_id ORDER BY window_end DESC) AS rn
        FROM sr WHERE window_end <= {AS_OF})
  WHERE rn = 1)"""

CURANOM = """curanom AS (
  SELECT route_id, window_end, event_count, avg_delay_seconds, batch_baseline_seconds, anomaly_ratio
  FROM latest WHERE is_anomaly)"""


def merge_select() -> str:
    """Columns of a full outer merge m(hs, hb, live, hist)."""
    delta = ("CASE WHEN hs AND hb THEN coalesce(live_avg_delay_seconds, 0) "
             "- coalesce(historical_avg_delay_seconds, 0) END")
    return f"""{rb(delta, 1)} AS delta_vs_historical,
         CASE WHEN hs AND hb AND {delta} > 120 THEN 'SIGNIFICANTLY_WORSE_THAN_USUAL'
              WHEN hs AND hb AND {delta} > 60 THEN 'WORSE_THAN_USUAL'
              WHEN hs AND hb AND {delta} < -60 THEN 'BETTER_THAN_USUAL'
              WHEN hs AND hb THEN 'NORMAL'
              WHEN hs THEN 'LIVE_ONLY_NO_HISTORY'
              WHEN hb THEN 'HISTORICAL_ONLY_NO_LIVE_DATA' END AS verdict"""


MERGE = f"""merged AS (
  SELECT coalesce(l.route_id, h.route_id) AS route_id, {bucket(AS_OF)} AS time_bucket,
         l.window_end AS speed_window_end, l.avg_delay_seconds AS live_avg_delay_seconds,
         l.event_count AS live_event_count, l.is_anomaly,
         h.avg_delay_seconds AS historical_avg_delay_seconds,
         l.route_id IS NOT NULL AS hs, h.route_id IS NOT NULL AS hb
  FROM latest l
  FULL OUTER JOIN (SELECT * FROM bview WHERE time_bucket = {bucket(AS_OF)}) h
    ON l.route_id = h.route_id)"""

MERGE_OUT = f"""SELECT route_id, time_bucket, speed_window_end, live_avg_delay_seconds, live_event_count,
       is_anomaly, historical_avg_delay_seconds, {merge_select()}
FROM merged"""

HISTMERGE = f"""hm AS (
  SELECT coalesce(l.route_id, h.route_id) AS route_id, coalesce(l.time_bucket, h.time_bucket) AS time_bucket,
         l.window_end, l.avg_delay_seconds AS live_avg_delay_seconds, l.event_count AS live_event_count,
         h.avg_delay_seconds AS historical_avg_delay_seconds,
         l.route_id IS NOT NULL AS hs, h.route_id IS NOT NULL AS hb
  FROM sr l FULL OUTER JOIN bview h ON l.route_id = h.route_id AND l.time_bucket = h.time_bucket),
hmo AS (
  SELECT route_id, time_bucket, window_end, live_avg_delay_seconds, live_event_count,
         historical_avg_delay_seconds, {merge_select()}
  FROM hm)"""


def label(x: str) -> str:
    """Dashboard delay text (JS Math.round = floor(x + 0.5))."""
    v = f"cast({x} AS DOUBLE)"
    s = f"floor({v} + 0.5)"
    m = f"floor({s} / 60)"
    rem = f"({s} - {m} * 60)"
    as_int = lambda e: f"cast(cast({e} AS BIGINT) AS VARCHAR)"
    return f"""(CASE WHEN {v} IS NULL OR isnan({v}) THEN '–'
      WHEN {s} < 0 THEN {as_int(f'abs({s})')} || 's early'
      WHEN {s} < 60 THEN {as_int(s)} || 's late'
      WHEN {rem} > 0 THEN {as_int(m)} || 'm ' || {as_int(rem)} || 's late'
      ELSE {as_int(m)} || 'm late' END)"""


def severity(x: str) -> str:
    v = f"cast({x} AS DOUBLE)"
    return f"""(CASE WHEN {v} IS NULL OR isnan({v}) OR {v} = 0 OR {v} < 60 THEN 'ok'
      WHEN {v} < 300 THEN 'warn' ELSE 'crit' END)"""


def delta_text(d: str) -> str:
    return f"""(CASE WHEN {d} IS NULL THEN 'No history' WHEN {d} > 120 THEN 'Much worse'
      WHEN {d} > 60 THEN 'Worse' WHEN {d} < -60 THEN 'Better' ELSE 'Normal' END)"""


def w(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


ROUNDED = f"""rounded AS (
  SELECT window_end, route_id, {rb("avg_delay_seconds", 2)} AS avg_delay_seconds, max_delay_seconds FROM lw)"""

BASE = (EV, CLEAN, HIST, STATS, BVIEW)
SPEED = (EV, CLEAN, HIST, STATS, BVIEW, SPD, LIVE, LW, SR)

ORACLE: dict[str, str] = {
    "clean_events": w(EV, CLEAN) + """SELECT event_id, route_id, trip_id, stop_sequence, delay_seconds,
       event_ts, day_of_week, hour_of_day FROM clean""",
    "input_counts": w(EV) + """SELECT count(*) AS raw_records,
       cast(count_if(route_id IS NOT NULL AND delay_seconds IS NOT NULL) AS BIGINT) AS clean_records,
       cast(count(*) - count_if(route_id IS NOT NULL AND delay_seconds IS NOT NULL) AS BIGINT)
         AS dropped_records FROM ev""",
    "route_statistics": w(EV, CLEAN, WHOLE, STATS) + "SELECT * FROM stats",
    "top_delayed_routes": w(EV, CLEAN, WHOLE) + """SELECT route_id, avg(delay_seconds) AS average_delay,
       count(*) AS records FROM hist GROUP BY route_id ORDER BY average_delay DESC, route_id LIMIT 20""",
    "batch_view": w(EV, CLEAN, WHOLE, STATS, BVIEW) + "SELECT * FROM bview",
    "time_bucket": w(EV, CLEAN) + f"""SELECT event_id, route_id, event_ts, {bucket('event_ts')} AS time_bucket
       FROM clean""",
    "batch_delay_history": w(EV, CLEAN, WHOLE, STATS) + """SELECT route_id,
       cast(NULL AS VARCHAR) AS route_short_name,
       day_of_week || '_' || lpad(cast(hour_of_day AS VARCHAR), 2, '0') AS time_bucket,
       avg_delay AS avg_delay_seconds, cast(max_delay AS DOUBLE) AS max_delay_seconds,
       observations AS trip_count, day_of_week, hour_of_day FROM stats""",
    "window_stats": w(EV, SPD, WS) + "SELECT * FROM ws",
    "sliding_window_stats": w(EV, SPD) + sliding("spd"),
    "tumbling_window_avg": w(EV, SPD) + """SELECT make_timestamp(epoch_us(event_ts) // 60000000 * 60000000)
         AS window_start,
       make_timestamp(epoch_us(event_ts) // 60000000 * 60000000 + 60000000) AS window_end,
       route_id, avg(delay_seconds) AS avg_delay_seconds, count(*) AS event_count
       FROM spd GROUP BY ALL""",
    "top_delayed_live": w(EV, SPD, WS, TOPLIVE) + "SELECT * FROM toplive",
    "top_n_snapshot": w(EV, SPD, ALLW, SNAP) + "SELECT * FROM snap",
    "latest_snapshot": w(EV, SPD, ALLW, SNAP, LATESTSNAP) + "SELECT * FROM latestsnap",
    "latest_snapshot_json": w(EV, SPD, ALLW, SNAP, LATESTSNAP) + "SELECT * FROM latestsnap",
    "top_delayed_n": w(EV, SPD, ALLW, SNAP, LATESTSNAP) + 'SELECT * FROM latestsnap WHERE "rank" <= 3',
    "speed_with_baseline": w(*SPEED) + "SELECT * FROM sr",
    "anomaly_windows": w(*SPEED) + "SELECT * FROM sr WHERE is_anomaly",
    "anomalies": w(*SPEED, LATEST, CURANOM) + "SELECT * FROM curanom",
    "anomaly_alerts": w(*SPEED, LATEST, CURANOM) + f"""SELECT route_id, avg_delay_seconds, event_count,
       anomaly_ratio, floor(anomaly_ratio * 10 + 0.5) / 10 AS ratio_display,
       {label('avg_delay_seconds')} AS avg_delay_label
       FROM curanom ORDER BY anomaly_ratio DESC, route_id LIMIT 6""",
    "speed_view_live": w(*SPEED) + f"""SELECT *, cast(epoch(window_end) AS BIGINT) + 3600 AS ttl FROM sr
       WHERE cast(epoch(window_end) AS BIGINT) + 3600 > cast(epoch({AS_OF}) AS BIGINT)
         AND window_end <= {AS_OF}""",
    "latest_per_route": w(*SPEED, LATEST) + "SELECT * FROM latest",
    "serving_merge": w(*SPEED, LATEST, MERGE) + MERGE_OUT,
    "serving_merge_history": w(*SPEED, HISTMERGE) + "SELECT * FROM hmo",
    "verdict": w(*SPEED, HISTMERGE) + "SELECT verdict, count(*) AS row_count FROM hmo GROUP BY verdict",
    "route_detail": w(*SPEED, LATEST, MERGE) + MERGE_OUT + " WHERE route_id = 'R05'",
    "live_summary": w(EV, SPD, WS, TOPLIVE) + """SELECT
       (SELECT count(*) FROM ws) AS routes_in_window,
       (SELECT cast(count(*) AS INTEGER) FROM toplive) AS top_list_size,
       (SELECT route_id FROM toplive WHERE "rank" = 1) AS top_route_id,
       (SELECT avg_delay_seconds FROM toplive WHERE "rank" = 1) AS top_route_avg_delay_seconds""",
    "kpis": w(*SPEED, WS, TOPLIVE, LATEST, CURANOM) + f"""SELECT t.*, {label('t.top_avg_delay_seconds')}
         AS top_delay_label, (SELECT count(*) FROM curanom) AS active_anomalies
       FROM (SELECT (SELECT route_id FROM toplive WHERE "rank" = 1) AS top_route_id,
                    (SELECT avg_delay_seconds FROM toplive WHERE "rank" = 1) AS top_avg_delay_seconds,
                    (SELECT count(*) FROM toplive) AS routes_tracked) t""",
    "top_delayed_enriched": w(*SPEED, LATEST, MERGE, SNAP, LATESTSNAP) + f"""SELECT s.window_end, s."rank",
       s.route_id, s.avg_delay_seconds, s.max_delay_seconds, s.event_count, m.delta_vs_historical,
       m.verdict, {delta_text('m.delta_vs_historical')} AS delta_label
       FROM latestsnap s LEFT JOIN ({MERGE_OUT}) m ON s.route_id = m.route_id""",
    "delay_label": w(EV, SPD, ALLW, ROUNDED) + f"""SELECT window_end, route_id, avg_delay_seconds,
       {label('avg_delay_seconds')} AS delay_label, {label('max_delay_seconds')} AS max_delay_label
       FROM rounded""",
    "delay_severity": w(EV, SPD, ALLW, ROUNDED) + f"""SELECT window_end, route_id, avg_delay_seconds, max_delay_seconds,
       {severity('avg_delay_seconds')} AS avg_severity, {severity('max_delay_seconds')} AS max_severity
       FROM rounded""",
    "delta_label": w(*SPEED, HISTMERGE) + f"""SELECT route_id, time_bucket, window_end, delta_vs_historical,
       {delta_text('delta_vs_historical')} AS delta_label FROM hmo""",
    "relative_delay": w(EV, SPD, ALLW, SNAP) + """SELECT window_end, "rank", route_id, avg_delay_seconds,
       cast(CASE WHEN max(coalesce(avg_delay_seconds, 0)) OVER (PARTITION BY window_end) > 0
                 THEN floor(avg_delay_seconds
                            / max(coalesce(avg_delay_seconds, 0)) OVER (PARTITION BY window_end) * 120 + 0.5)
                 ELSE 4 END AS INTEGER) AS bar_px
       FROM snap""",
}


# -- ingestion (the derived raw shapes, restated from the event type) ----------

SRC = """src AS (
  SELECT event_id AS eid, ts, user_id, event_type, value,
         cast(json_extract_string(props, '$.k') AS INTEGER) AS k,
         cast(floor(value * 4) - 60 AS INTEGER) AS d,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS iso,
         'R' || lpad(cast(user_id % 12 AS VARCHAR), 2, '0') AS route_id,
         'T' || cast(user_id AS VARCHAR) AS trip_id
  FROM events)"""

RAWSCAN = """rawscan AS (
  SELECT CASE WHEN event_type = 'signup' THEN NULL WHEN event_type = 'view' THEN 'vp_' || cast(eid AS VARCHAR)
              ELSE cast(eid AS VARCHAR) END AS event_id,
         CASE WHEN event_type = 'signup' THEN NULL ELSE iso END AS ingestion_time,
         CASE WHEN event_type = 'signup' THEN NULL ELSE route_id END AS route_id,
         CASE WHEN event_type = 'signup' THEN NULL ELSE trip_id END AS trip_id,
         CASE WHEN event_type IN ('signup', 'view') THEN NULL ELSE k END AS stop_sequence,
         CASE WHEN event_type IN ('signup', 'view') THEN NULL ELSE 'S' || cast(k AS VARCHAR) END AS stop_id,
         CASE WHEN event_type = 'click' THEN d END AS delay_seconds,
         CASE WHEN event_type = 'signup' THEN NULL WHEN event_type = 'view' THEN 'tfi_vehicle_positions'
              ELSE 'tfi_trip_updates' END AS source
  FROM src)"""

SPEEDREC = """SELECT cast(eid AS VARCHAR) AS event_id, route_id,
       CASE WHEN event_type = 'error' THEN cast(trunc(value * 4 - 60) AS INTEGER) ELSE d END AS delay_seconds,
       ts AS event_ts
FROM src WHERE event_type IN ('click', 'purchase', 'error')"""

TRIPS = """trips AS (
  SELECT 'E' || cast(eid AS VARCHAR) || '_' || cast(k AS VARCHAR) AS event_id, iso AS ingestion_time,
         route_id, trip_id, k AS stop_sequence, 'S' || cast(k AS VARCHAR) AS stop_id,
         CASE WHEN event_type = 'error' THEN 0 ELSE d END AS delay_seconds,
         strftime(ts, '%Y%m%d') AS start_date, 0 AS schedule_relationship, 'tfi_trip_updates' AS source
  FROM src WHERE event_type IN ('click', 'purchase', 'error'))"""

VEHICLES = """vehicles AS (
  SELECT 'vp_E' || cast(eid AS VARCHAR) AS event_id, iso AS ingestion_time, route_id, trip_id,
         'V' || cast(user_id AS VARCHAR) AS vehicle_id,
         cast(53.0 + k / 1000 AS FLOAT) AS latitude, cast(-6.0 - k / 1000 AS FLOAT) AS longitude,
         cast(k * 3.6::DOUBLE AS FLOAT) AS bearing, cast(value AS FLOAT) AS speed_ms,
         cast(k % 7 AS INTEGER) AS occupancy_status, 'tfi_vehicle_positions' AS source
  FROM src WHERE event_type = 'view')"""

ORACLE.update({
    "raw_json_scan": w(SRC, RAWSCAN) + "SELECT * FROM rawscan",
    "archive_route_statistics": w(SRC, RAWSCAN) + f"""SELECT route_id, dayname(ts) AS day_of_week,
       cast(hour(ts) AS INTEGER) AS hour_of_day, avg(delay_seconds) AS avg_delay,
       max(delay_seconds) AS max_delay, count(*) AS observations
       FROM (SELECT *, cast(ingestion_time AS TIMESTAMP) AS ts FROM rawscan)
       WHERE route_id IS NOT NULL AND delay_seconds IS NOT NULL
       GROUP BY ALL""",
    "coerce_delay": w(SRC) + SPEEDREC,
    "decode_envelope": w(SRC) + SPEEDREC,
    "malformed_records": w(SRC) + """SELECT count(*) AS records,
       cast(count_if(event_type = 'signup') AS BIGINT) AS malformed,
       cast(count(*) - count_if(event_type = 'signup') AS BIGINT) AS decoded FROM src""",
    "flatten_trip_updates": w(SRC, TRIPS) + "SELECT * FROM trips",
    "flatten_vehicle_positions": w(SRC, VEHICLES) + "SELECT * FROM vehicles",
    "ingest_union": w(SRC, TRIPS, VEHICLES) + """SELECT *, coalesce(nullif(route_id, ''), 'unknown') AS partition_key
       FROM (SELECT event_id, ingestion_time, route_id, trip_id, stop_sequence, stop_id, delay_seconds,
                    start_date, schedule_relationship, source, NULL::VARCHAR AS vehicle_id,
                    NULL::FLOAT AS latitude, NULL::FLOAT AS longitude, NULL::FLOAT AS bearing,
                    NULL::FLOAT AS speed_ms, NULL::INTEGER AS occupancy_status FROM trips
             UNION ALL
             SELECT event_id, ingestion_time, route_id, trip_id, NULL, NULL, NULL, NULL, NULL, source,
                    vehicle_id, latitude, longitude, bearing, speed_ms, occupancy_status FROM vehicles)""",
})


# -- run-log reports --------------------------------------------------------------

REQ = """req AS (
  SELECT cast([1, 5, 10, 20][user_id % 4 + 1] AS INTEGER) AS concurrency,
         CASE WHEN event_type <> 'error' THEN value END AS latency_ms,
         event_type <> 'error' AS success
  FROM events)"""

LATENCY = f"""SELECT c.concurrency, c.requests, c.successful, c.requests - c.successful AS failed,
       {rb('s.mean', 2)} AS avg_latency_ms, {rb('(s.lo + s.hi) / 2', 2)} AS p50_ms,
       {rb('s.p95', 2)} AS p95_ms, {rb('s.p99', 2)} AS p99_ms
FROM (SELECT concurrency, count(*) AS requests,
             cast(count_if(success AND latency_ms IS NOT NULL) AS BIGINT) AS successful
      FROM req GROUP BY concurrency) c
LEFT JOIN (
  SELECT concurrency, any_value(mean) AS mean,
         max(CASE WHEN rn = floor((n + 1) / 2) THEN latency_ms END) AS lo,
         max(CASE WHEN rn = floor(n / 2) + 1 THEN latency_ms END) AS hi,
         max(CASE WHEN rn = least(floor(n * 95 / 100), n - 1) + 1 THEN latency_ms END) AS p95,
         max(CASE WHEN rn = least(floor(n * 99 / 100), n - 1) + 1 THEN latency_ms END) AS p99
  FROM (SELECT concurrency, latency_ms,
               row_number() OVER (PARTITION BY concurrency ORDER BY latency_ms) AS rn,
               count(*) OVER (PARTITION BY concurrency) AS n,
               avg(latency_ms) OVER (PARTITION BY concurrency) AS mean
        FROM req WHERE success AND latency_ms IS NOT NULL)
  GROUP BY concurrency) s ON c.concurrency = s.concurrency"""

THROUGHPUT = f"""SELECT target_rate, count(*) AS total_records, cast(count_if(success) AS BIGINT) AS success,
       {rb('count_if(success) / count(*) * 100', 2)} AS success_rate,
       {rb('CASE WHEN (epoch_us(max(ts)) - epoch_us(min(ts))) > 0 THEN count_if(success) / ((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6) END', 2)} AS actual_rps
FROM (SELECT cast([10, 50, 100, 200, 500][user_id % 5 + 1] AS INTEGER) AS target_rate,
             event_type <> 'error' AS success, ts FROM events)
GROUP BY target_rate"""

SPEEDUP = f"""SELECT job_date, partitions, state, {rb('time_seconds', 2)} AS time_seconds,
       {rb("CASE WHEN state = 'COMPLETED' AND base IS NOT NULL THEN base / time_seconds ELSE 0 END", 3)} AS speedup,
       {rb("CASE WHEN partitions > 0 THEN (CASE WHEN state = 'COMPLETED' AND base IS NOT NULL THEN base / time_seconds ELSE 0 END) / partitions ELSE 0 END", 3)} AS efficiency
FROM (SELECT *, first_value(CASE WHEN state = 'COMPLETED' THEN time_seconds END IGNORE NULLS)
                  OVER (PARTITION BY job_date ORDER BY partitions
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS base
      FROM (SELECT cast(ts AS DATE) AS job_date, cast(pow(2, user_id % 4) AS INTEGER) AS partitions,
                   CASE WHEN max(value) > 480 THEN 'FAILED' ELSE 'COMPLETED' END AS state,
                   sum(cast(round(value * 100) AS BIGINT)) / 100 AS time_seconds
            FROM events GROUP BY ALL))"""

ORACLE.update({
    "latency_report": w(REQ) + LATENCY,
    "throughput_report": THROUGHPUT,
    "speedup_report": SPEEDUP,
})


# -- streaming replays (batch twins; append mode emits closed windows only) -------

MICRO = f"""SELECT cast(0 AS BIGINT) AS batch_id, m.route_id, {AS_OF} AS window_end,
       cast(epoch({AS_OF}) AS BIGINT) + 3600 AS ttl, m.event_count,
       {rb('m.avg_delay_seconds', 2)} AS avg_delay_seconds, m.max_delay_seconds, m.late_count,
       {rb('b.avg_delay_seconds', 2)} AS batch_baseline_seconds,
       {rb('CASE WHEN b.avg_delay_seconds > 0 THEN m.avg_delay_seconds / b.avg_delay_seconds END', 2)}
         AS anomaly_ratio,
       coalesce(CASE WHEN b.avg_delay_seconds > 0 THEN m.avg_delay_seconds / b.avg_delay_seconds END > 2.0,
                false) AS is_anomaly
FROM (SELECT route_id, count(*) AS event_count, avg(delay_seconds) AS avg_delay_seconds,
             max(delay_seconds) AS max_delay_seconds,
             cast(sum(CASE WHEN delay_seconds > 60 THEN 1 ELSE 0 END) AS BIGINT) AS late_count
      FROM ({SPEEDREC}) GROUP BY route_id) m
LEFT JOIN (SELECT * FROM bview WHERE time_bucket = {bucket(AS_OF)}) b ON m.route_id = b.route_id"""

ORACLE.update({
    "stream_sliding_window": w(EV, SPD) + sliding("spd"),
    "stream_tumbling_window": ORACLE["tumbling_window_avg"],
    "stream_open_windows": w(EV, SPD) + f"""SELECT * FROM ({sliding('spd')})
       WHERE window_end > (SELECT max(event_ts) FROM spd) - INTERVAL 1 HOUR""",
    "stream_closed_windows": w(EV, SPD) + f"""SELECT * FROM ({sliding('spd')})
       WHERE window_end <= (SELECT max(event_ts) FROM spd) - INTERVAL 1 HOUR""",
    "stream_closed_tumbling": w(EV, SPD) + """SELECT * FROM (
         SELECT make_timestamp(epoch_us(event_ts) // 60000000 * 60000000) AS window_start,
                make_timestamp(epoch_us(event_ts) // 60000000 * 60000000 + 60000000) AS window_end,
                route_id, avg(delay_seconds) AS avg_delay_seconds, count(*) AS event_count
         FROM spd GROUP BY ALL)
       WHERE window_end <= (SELECT max(event_ts) FROM spd) - INTERVAL 10 MINUTE""",
    "stream_top_n": w(EV, SPD, ALLW, SNAP) + "SELECT * FROM snap",
    "stream_anomalies": w(*SPEED) + "SELECT * FROM sr WHERE is_anomaly",
    "microbatch_stats": w(SRC, EV, CLEAN, HIST, STATS, BVIEW) + MICRO,
    "batch_counters": w(SRC) + """SELECT cast(0 AS BIGINT) AS batch_id, count(*) AS processed,
       count(DISTINCT CASE WHEN event_type IN ('click', 'purchase', 'error') THEN route_id END)
         AS routes_updated FROM src""",
    "stream_late_data": w(EV, SPD, LIVE) + f"""SELECT * FROM ({sliding('livespd')})
       WHERE window_end <= (SELECT max(event_ts) FROM livespd) - INTERVAL 1 HOUR""",
    "stream_late_report": w(EV, SPD) + f"""SELECT route_id, date_trunc('hour', event_ts) AS pane_start, count(*) AS events,
       cast(sum(delay_seconds) AS BIGINT) AS sum_delay, max(delay_seconds) AS max_delay,
       cast(count_if(delay_seconds > 60) AS BIGINT) AS late_count
       FROM spd WHERE event_ts < {HISTORY_UNTIL} GROUP BY ALL""",
    "stream_late_corrected": w(EV, SPD) + sliding("spd"),
    "fan_out_archive": w(SRC, RAWSCAN) + """SELECT *, true AS has_sequence, true AS has_arrival FROM rawscan
       WHERE event_id IS NOT NULL""",
    "fan_out_quarantine": w(SRC) + """SELECT cast(0 AS BIGINT) AS batch_id, 'not JSON' AS reason, count(*) AS malformed
       FROM src WHERE event_type = 'signup' GROUP BY ALL""",
    "fan_out_speed_view": w(SRC, f"rec AS ({SPEEDREC})") + f"""SELECT window_start, window_end, route_id, event_count,
       {rb('avg_delay_seconds', 2)} AS avg_delay_seconds, max_delay_seconds, late_count FROM ({sliding('rec')})""",
    "archive_between": w(SRC, RAWSCAN) + """SELECT * FROM rawscan WHERE event_id IS NOT NULL
       AND cast(ingestion_time AS TIMESTAMP) >= TIMESTAMP '2024-01-10 06:00:00'
       AND cast(ingestion_time AS TIMESTAMP) < TIMESTAMP '2024-01-12 18:00:00'""",
    "published_route_statistics": w(EV, CLEAN, WHOLE, STATS) + "SELECT *, true AS has_generated_at FROM stats",
    "published_top_routes": ORACLE["top_delayed_routes"],
    "incremental_batch_view": f"""WITH s AS ({ORACLE["archive_route_statistics"]})
       SELECT route_id, day_of_week || '_' || lpad(cast(hour_of_day AS VARCHAR), 2, '0') AS time_bucket,
              avg_delay AS avg_delay_seconds FROM s""",
    "event_time_fallback": w(SRC) + f"""SELECT event_id, route_id, delay_seconds,
       CASE WHEN cast(event_id AS BIGINT) % 3 = 0 THEN {AS_OF} ELSE event_ts END AS event_ts FROM ({SPEEDREC})""",
    "served_rows": w(*SPEED, LATEST) + f"""SELECT m.route_id, {bucket(AS_OF)} AS time_bucket, {AS_OF} AS merged_at,
       m.window_start AS live_window_start, m.window_end AS live_window_end, m.event_count AS live_event_count,
       m.live_avg_delay_seconds, m.max_delay_seconds AS live_max_delay_seconds, m.late_count AS live_late_count,
       m.batch_baseline_seconds AS live_batch_baseline_seconds, m.anomaly_ratio AS live_anomaly_ratio,
       m.is_anomaly AS live_is_anomaly, CASE WHEN hs THEN 360.0::DOUBLE END AS live_window_size_minutes,
       m.historical_avg_delay_seconds, {merge_select()}
       FROM (SELECT coalesce(l.route_id, h.route_id) AS route_id, l.* EXCLUDE (route_id, avg_delay_seconds),
                    l.avg_delay_seconds AS live_avg_delay_seconds, h.avg_delay_seconds AS historical_avg_delay_seconds,
                    l.route_id IS NOT NULL AS hs, h.route_id IS NOT NULL AS hb
             FROM latest l FULL OUTER JOIN (SELECT * FROM bview WHERE time_bucket = {bucket(AS_OF)}) h
               ON l.route_id = h.route_id) m""",
    "summary": w(EV, SPD, WS, TOPLIVE) + f"""SELECT {AS_OF} AS as_of, cast(count(*) AS INTEGER) AS live_routes_tracked,
       max(CASE WHEN "rank" = 1 THEN 1 END) AS top_rank, max(CASE WHEN "rank" = 1 THEN route_id END) AS top_route_id,
       max(CASE WHEN "rank" = 1 THEN avg_delay_seconds END) AS top_avg_delay_seconds,
       max(CASE WHEN "rank" = 1 THEN max_delay_seconds END) AS top_max_delay_seconds,
       max(CASE WHEN "rank" = 1 THEN event_count END) AS top_event_count, 'operational' AS system_status FROM toplive""",
    "throughput_elapsed": f"""SELECT target_rate, count(*) AS total_records, cast(count_if(success) AS BIGINT) AS success,
       {rb('count_if(success) / count(*) * 100', 2)} AS success_rate,
       {rb("count_if(success) / ((epoch_us(max(date_trunc('hour', ts))) + 3600000000 - epoch_us(min(date_trunc('hour', ts)))) / 1e6)", 2)} AS actual_rps
FROM (SELECT cast([10, 50, 100, 200, 500][user_id % 5 + 1] AS INTEGER) AS target_rate,
             event_type <> 'error' AS success, ts FROM events)
GROUP BY target_rate""",
    "archive_raw": w(SRC, RAWSCAN) + """SELECT r.* FROM rawscan r
       WHERE r.event_id IS NOT NULL""",
})
