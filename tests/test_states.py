"""Route states from one scan equal the views computed one by one."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from headway.functions import columns as C
from headway.operators import batch as B
from headway.operators import serving as V
from headway.operators import speed as S
from headway.operators import states as ST

SINCE = datetime(2024, 1, 24)
SCHEMA = "event_id string, route_id string, delay_seconds int, source string, event_ts timestamp"


def frame(spark, rows):
    return spark.createDataFrame([(str(i), *r) for i, r in enumerate(rows)], SCHEMA)


def some_events(seed, n=600):
    """Routes of every kind: shared, '' and NULL, history only, live only; positions without a delay."""
    r = random.Random(seed)
    out = []
    for _ in range(n):
        route = r.choice(["a", "b", "c", "d", "", None, "past", "new"])
        start, span = {"past": (-400, 390), "new": (0, 60)}.get(route, (-400, 460))
        when = SINCE + timedelta(seconds=round((start + r.random() * span) * 3600, 0))
        when = r.choice([when, when.replace(minute=0, second=0), when.replace(minute=30, second=0)])
        out.append((route, r.choice([None, 0, 60, 61, 400, -90, r.randint(-60, 340)]),
                    r.choice([C.TRIP_UPDATES] * 4 + [C.VEHICLE_POSITIONS]), when))
    return out


def rows_of(df):
    return sorted((tuple(sorted(r.asDict().items())) for r in df.collect()), key=repr)


def one_by_one(events, as_of, size, slide):
    past = events.filter(F.col("event_ts") < S.ts_literal(SINCE))
    live = events.filter((F.col("event_ts") >= S.ts_literal(SINCE)) & (F.col("event_ts") < S.ts_literal(as_of)))
    base = B.batch_view(B.route_statistics(B.clean_events(past)))
    windows = S.sliding_window_stats(live, size, slide, pre_aggregate=False)
    newest = S.speed_with_baseline(V.latest_per_route(windows, as_of), base)
    return windows, newest, base


@pytest.mark.parametrize("seed,as_of,size,slide", [
    (1, datetime(2024, 1, 26, 6), "6 hours", "1 hour"),
    (2, datetime(2024, 1, 25, 17, 42, 13), "6 hours", "1 hour"),        # between two slides
    (3, datetime(2024, 1, 25, 12, 30), "90 minutes", "1 hour"),         # not a multiple of the slide
    (4, datetime(2024, 1, 24, 0, 10), "1 hour", "30 minutes"),          # hardly any live event
])
def test_states_equal_the_separate_views(spark, seed, as_of, size, slide):
    events = frame(spark, some_events(seed))
    windows, newest, base = one_by_one(events, as_of, size, slide)
    states = ST.route_states(events, SINCE, as_of, size, slide)
    assert rows_of(ST.newest_windows(states)) == rows_of(newest.drop("time_bucket"))
    assert rows_of(ST.merged_states(states)) == rows_of(V.serving_merge(newest, base, as_of))
    assert rows_of(ST.served_states(states, as_of, size)) == rows_of(
        V.served_rows(newest, base, as_of, size))
    assert rows_of(ST.enriched_top(states, 3)) == rows_of(V.top_delayed_enriched(
        S.top_n_snapshot(windows, 3), V.serving_merge(newest, base, as_of), as_of))
    closed = ST.route_states(events, SINCE, as_of, size, slide, closed=True)
    assert rows_of(ST.state_kpis(closed, 3)) == rows_of(V.kpis(
        S.window_stats(events, as_of, size), V.current_anomalies(newest, as_of), 3))


def test_both_ends_of_the_closed_window_count(spark):
    as_of = datetime(2024, 1, 25, 12)
    rows = [("a", 100, C.TRIP_UPDATES, as_of), ("a", 300, C.TRIP_UPDATES, as_of - timedelta(hours=6)),
            ("a", 9000, C.TRIP_UPDATES, as_of + timedelta(microseconds=1)), ("b", 10, C.TRIP_UPDATES, as_of)]
    states = {r.route_id: r for r in ST.route_states(frame(spark, rows), SINCE, as_of, "6 hours", "1 hour", True).collect()}
    assert states["a"].window_mean == 200 and states["a"].event_count == 1       # a sliding window leaves its end out
    assert states["b"].window_mean == 10 and not states["b"].has_speed and states["b"].is_anomaly is None


def test_no_events_and_short_windows(spark):
    states = ST.route_states(frame(spark, []), SINCE, datetime(2024, 1, 25), "6 hours", "1 hour", True)
    assert states.collect() == [] and ST.enriched_top(states).collect() == []
    assert ST.state_kpis(states).first().routes_tracked == 0
    with pytest.raises(ValueError):
        ST.route_states(frame(spark, []), SINCE, SINCE, "1 minute", "1 hour")
