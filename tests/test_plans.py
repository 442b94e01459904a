"""Guards on the physical plans: the scale properties the design relies on."""

import re

import pytest

from headway.plans.catalog import QUERIES
from tests.conftest import SF_SMALL

BATCH = sorted(n for n in QUERIES
               if not n.startswith("stream_") and n not in {"microbatch_stats", "batch_counters", "archive_raw"})


def executed(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    return {n: executed(spark, n) for n in BATCH}


def test_no_cross_join_and_no_row_at_a_time_python(plans):
    for name, plan in plans.items():
        for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython"):
            assert bad not in plan, (name, bad)


def test_time_bounds_reach_the_scan(plans):
    def pushed(plan):
        return " ".join(re.findall(r"PushedFilters: \[[^\n]*", plan))

    assert "LessThan(ts,2024-01-24T00:00)" in pushed(plans["speed_with_baseline"])
    assert "LessThan(ts,2024-01-28T12:00)" in pushed(plans["serving_merge"])
    assert "GreaterThanOrEqual(ts,2024-01-28T06:00)" in pushed(plans["window_stats"])
    assert "LessThanOrEqual(ts,2024-01-28T12:00)" in pushed(plans["window_stats"])
    assert "GreaterThanOrEqual(ts,2024-01-24T00:00)" in pushed(plans["speed_with_baseline"])


def test_columns_pruned_at_the_scan(plans):
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", plans["route_statistics"])
    assert schemas and all("props" not in s and "event_id" not in s for s in schemas)


@pytest.mark.parametrize("name,scans,exchanges", [
    ("route_statistics", 1, 1), ("window_stats", 1, 1), ("top_delayed_routes", 1, 1),
    ("sliding_window_stats", 1, 2), ("latest_snapshot", 1, 4), ("serving_merge", 1, 2),
    ("served_rows", 1, 2), ("route_detail", 1, 2), ("kpis", 1, 3), ("top_delayed_enriched", 1, 3), ("anomalies", 1, 2),
    ("ingest_union", 1, 0), ("coerce_delay", 1, 0),
])
def test_scan_and_shuffle_budget(plans, name, scans, exchanges):
    plan = plans[name]
    assert plan.count("events.parquet") == scans
    assert plan.count("Exchange ") <= exchanges


def test_top_n_uses_group_limit_before_shuffle(plans):
    assert "WindowGroupLimit" in plans["top_n_snapshot"]
    assert "TakeOrderedAndProject" in plans["top_delayed_routes"]
