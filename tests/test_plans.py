"""What the plans must not do at scale."""

import re

import pytest

from homegrid.plans import catalog, views
from tests.conftest import SMALL

# fits, whose rounds multiply blocks of rows with centers in Arrow batches
FITS = {"cluster_cycles", "cluster_devices", "cluster_elbow", "cluster_silhouette"}
STREAMS = {"stream_ingest", "stream_dedupe", "stream_day_summary"}
BATCH = sorted(set(catalog.QUERIES) - FITS - STREAMS)
PYTHON = re.compile(r"Python|MapInArrow|MapInPandas|InPandas|InArrow")


def executed(df) -> str:
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def plans(spark):
    return {}


def plan_of(spark, plans, name):
    if name not in plans:
        plans[name] = executed(catalog.QUERIES[name](spark, SMALL))
    return plans[name]


@pytest.mark.parametrize("name", BATCH)
def test_no_python_and_no_cross_join(spark, plans, name):
    plan = plan_of(spark, plans, name)
    assert not PYTHON.search(plan) and "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


WINDOWED = ["solar_energy_daily", "solar_energy_by_device", "resample_ffill", "resample_bfill", "price_rolling_time",
            "price_rolling_rows", "price_step", "cycle_marks", "cycle_pairs", "cycle_profiles"]


@pytest.mark.parametrize("name", WINDOWED)
def test_rows_never_meet_in_one_partition(spark, plans, name):
    """A window over everything may only see one row per day, so it sits on an aggregate by day."""
    lines = plan_of(spark, plans, name).splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            below = next(x for x in lines[i + 1 :] if "Aggregate" in x or "Project" not in x)
            assert "Aggregate" in below and re.search(r"_bucket|_day|_step", below), below


@pytest.mark.parametrize("name", ["resample_bfill", "cycle_marks", "cycle_pairs", "cycle_profiles", "cluster_profiles",
                                  "resample_ffill", "price_rolling_rows", "price_rolling_time", "solar_energy_daily"])
def test_files_are_read_once(spark, plans, name):
    assert plan_of(spark, plans, name).count("FileScan") == 1


def test_range_and_columns_reach_the_scan(spark, plans):
    plan = plan_of(spark, plans, "scan_range")
    assert "GreaterThanOrEqual(ts,2024-01-05" in plan and "LessThan(ts,2024-01-20" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,value:double>" in plan


def test_diary_is_one_grouping(spark, plans):
    plan = plan_of(spark, plans, "day_summary")
    assert plan.count(" Exchange ") == 1 and "Join" not in plan and "Sort" not in plan


def test_views_match_their_names(events):
    assert views.prices_raw(events).count() == events.select("ts").selectExpr("window(ts, '15 minutes')").distinct().count()


def test_entry_has_every_query_of_the_catalog():
    import __spark_entry__ as entry

    assert set(catalog.QUERIES) <= set(entry.queries())
