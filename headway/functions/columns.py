"""Column expressions shared by the batch, speed and serving operators.

Every rule of the domain lives here exactly once, as a built-in Spark
expression (JVM-side, whole-stage codegen), so batch and streaming jobs
cannot drift apart.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for identical results.
TRIP_UPDATES = "tfi_trip_updates"
VEHICLE_POSITIONS = "tfi_vehicle_positions"
LATE_AFTER_SECONDS = 60            # late iff delay > 60 (strict)
ANOMALY_RATIO = 2.0                # anomaly iff live / baseline > 2.0 (strict)
WORSE_DELTA = 60                   # delta > 60 -> WORSE_THAN_USUAL
MUCH_WORSE_DELTA = 120             # delta > 120 -> SIGNIFICANTLY_WORSE_THAN_USUAL
BETTER_DELTA = -60                 # delta < -60 -> BETTER_THAN_USUAL
WARN_SECONDS = 60                  # severity: < 60 ok, < 300 warn, else crit
CRIT_SECONDS = 300
TOP_N = 5
WINDOW_SIZE = "5 minutes"
WINDOW_SLIDE = "30 seconds"
TTL_SECONDS = 3600
VERDICTS = (
    "SIGNIFICANTLY_WORSE_THAN_USUAL",
    "WORSE_THAN_USUAL",
    "BETTER_THAN_USUAL",
    "NORMAL",
    "LIVE_ONLY_NO_HISTORY",
    "HISTORICAL_ONLY_NO_LIVE_DATA",
)
NO_VALUE = "–"                # en dash shown for a missing delay


def ts_literal(when: datetime) -> Column:
    """A UTC instant as a TIMESTAMP literal (independent of the Python zone)."""
    return F.lit(when.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_event_time(text: Column | str) -> Column:
    """ISO-8601 text (with or without a trailing ``Z``) -> TIMESTAMP; bad -> NULL.

    ``to_timestamp`` raises on bad text under ANSI mode, ``try_to_timestamp``
    keeps the row with a NULL time (the batch layer groups it under NULL).
    """
    return F.try_to_timestamp(_c(text))


def event_time_or(text: Column | str, fallback: Column) -> Column:
    """Speed-layer rule: a missing or unparsable time means 'now'."""
    return F.coalesce(parse_event_time(text), fallback)


def day_of_week(ts: Column | str) -> Column:
    """Full English weekday name."""
    return F.date_format(_c(ts), "EEEE")


def hour_of_day(ts: Column | str) -> Column:
    return F.hour(_c(ts))


def time_bucket(ts: Column | str) -> Column:
    """``<Weekday>_<HH>`` (2-digit hour) of a timestamp; NULL stays NULL."""
    ts = _c(ts)
    return F.concat(day_of_week(ts), F.lit("_"), F.lpad(F.hour(ts).cast("string"), 2, "0"))


def is_late(delay: Column | str) -> Column:
    return _c(delay) > F.lit(LATE_AFTER_SECONDS)


def late_flag(delay: Column | str) -> Column:
    """1 when late, else 0 (sum() of it is the late count)."""
    return F.when(is_late(delay), F.lit(1)).otherwise(F.lit(0))


def speed_filter(route: Column | str = "route_id", delay: Column | str = "delay_seconds",
                 source: Column | str = "source") -> Column:
    """Rows the speed layer accepts: trip updates with a non-empty route and a delay."""
    route = _c(route)
    return (
        route.isNotNull()
        & (route != F.lit(""))
        & _c(delay).isNotNull()
        & (_c(source) == F.lit(TRIP_UPDATES))
    )


def batch_filter(route: Column | str = "route_id", delay: Column | str = "delay_seconds") -> Column:
    """Rows the batch layer keeps: route and delay present (``''`` route kept)."""
    return _c(route).isNotNull() & _c(delay).isNotNull()


def anomaly_ratio(avg: Column | str, baseline: Column | str) -> Column:
    """live / baseline when the baseline is present and positive, else NULL."""
    b = _c(baseline)
    return F.when(b > F.lit(0), _c(avg) / b)


def is_anomaly(ratio: Column | str, threshold: float = ANOMALY_RATIO) -> Column:
    """Strict ``ratio > threshold`` on the unrounded ratio; no ratio -> false."""
    return F.coalesce(_c(ratio) > F.lit(threshold), F.lit(False))


def verdict(has_speed: Column | str, has_batch: Column | str, delta: Column | str) -> Column:
    """Merge verdict on the unrounded delta (live - historical)."""
    s, b, d = _c(has_speed), _c(has_batch), _c(delta)
    both = s & b
    return (
        F.when(both & (d > F.lit(MUCH_WORSE_DELTA)), F.lit(VERDICTS[0]))
        .when(both & (d > F.lit(WORSE_DELTA)), F.lit(VERDICTS[1]))
        .when(both & (d < F.lit(BETTER_DELTA)), F.lit(VERDICTS[2]))
        .when(both, F.lit(VERDICTS[3]))
        .when(s, F.lit(VERDICTS[4]))
        .when(b, F.lit(VERDICTS[5]))
    )


def half_even(x: Column | str, digits: int) -> Column:
    """Round half-to-even (Python ``round`` on the binary value)."""
    return F.bround(_c(x), digits)


def js_round(x: Column | str) -> Column:
    """JavaScript ``Math.round``: ties go towards +infinity."""
    return F.floor(_c(x) + F.lit(0.5))


def delay_label(secs: Column | str) -> Column:
    """Human label of a delay in seconds: '5s early', '45s late', '2m 5s late'."""
    x = _c(secs)
    s = js_round(x)
    m = F.floor(s / 60)
    rem = s - m * 60
    return (
        F.when(x.isNull() | F.isnan(x), F.lit(NO_VALUE))
        .when(s < 0, F.format_string("%ds early", F.abs(s)))
        .when(s < 60, F.format_string("%ds late", s))
        .when(rem > 0, F.format_string("%dm %ds late", m, rem))
        .otherwise(F.format_string("%dm late", m))
    )


def delay_severity(secs: Column | str) -> Column:
    """'ok' for missing, zero or under a minute; 'warn' under 5 minutes; else 'crit'."""
    x = _c(secs)
    return (
        F.when(x.isNull() | F.isnan(x) | (x == 0) | (x < WARN_SECONDS), F.lit("ok"))
        .when(x < CRIT_SECONDS, F.lit("warn"))
        .otherwise(F.lit("crit"))
    )


def delta_label(delta: Column | str) -> Column:
    """Dashboard text of the live-vs-history delta."""
    d = _c(delta)
    return (
        F.when(d.isNull(), F.lit("No history"))
        .when(d > MUCH_WORSE_DELTA, F.lit("Much worse"))
        .when(d > WORSE_DELTA, F.lit("Worse"))
        .when(d < BETTER_DELTA, F.lit("Better"))
        .otherwise(F.lit("Normal"))
    )


def nearest_rank(n: Column | str, percent: float) -> Column:
    """1-based rank of the nearest-index percentile: min(floor(n*p/100), n-1) + 1."""
    n = _c(n)
    return F.least(F.floor(n * F.lit(percent) / F.lit(100)), n - 1) + 1


def ttl_of(ts: Column | str) -> Column:
    """Expiry epoch seconds of a speed-view row written at ``ts``."""
    return F.unix_timestamp(_c(ts)) + F.lit(TTL_SECONDS)


def to_ntz(ts: Column | str) -> Column:
    """Instant -> UTC wall-clock TIMESTAMP_NTZ (session zone is UTC)."""
    return _c(ts).cast("timestamp_ntz")
