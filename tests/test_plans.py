"""What the plans of the queries must and must not contain."""

import re

import pytest

from slotwise import catalog
from slotwise.operators import grid
from slotwise.sources import tables

FOLDER = "/root/testdata/sf0.001"
LAZY = (
    "scan_clean", "resample_mean", "dense_grid", "gap_interpolate", "resample_daily", "ingest_gaps", "shutdown_periods",
    "merge_periods", "slots_in_periods", "rolling_features", "rolling_mad_z", "mad_anomaly_periods", "lag_matrix",
    "state_size_gate", "standardize", "exclude_shutdowns", "period_attributes", "features_between_shutdowns",
    "mad_clip", "describe_sensors", "anomaly_lead_time", "forecast_union", "forecast_tail", "ar1_expanding",
)


def nodes(plan):
    yield plan
    children = plan.children()
    for i in range(children.size()):
        yield from nodes(children.apply(i))


@pytest.fixture(scope="module")
def plans(spark):
    return {name: catalog.queries()[name](spark, FOLDER)._jdf.queryExecution() for name in LAZY}


@pytest.mark.parametrize("name", LAZY)
def test_no_unpartitioned_window_and_no_cross_join(plans, name):
    for node in nodes(plans[name].optimizedPlan()):
        if node.nodeName() == "Window":
            assert node.partitionSpec().size() > 0
    text = plans[name].executedPlan().toString()
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text and "ArrowEval" not in text


@pytest.mark.parametrize("name", ["gap_interpolate", "rolling_features", "shutdown_periods", "lag_matrix", "rolling_mad_z"])
def test_rows_are_windowed_by_chunk(plans, name):
    """Windows by series alone run over chunk summaries only."""
    for node in nodes(plans[name].optimizedPlan()):
        if node.nodeName() != "Window":
            continue
        by = node.partitionSpec().mkString(",")
        if "chunk" in by or "_home" in by:
            continue
        below = node
        while below.nodeName() in ("Window", "Project", "Filter"):
            below = below.children().apply(0)
        assert below.nodeName() == "Aggregate"


def test_scan_reads_only_what_is_used(spark):
    rows = grid.resample_mean(tables.telemetry(spark, FOLDER), ["click"], catalog.P)
    text = rows._jdf.queryExecution().executedPlan().toString()
    schema = re.search(r"ReadSchema: struct<(.*?)>", text).group(1)
    assert "props" not in schema and "event_id" not in schema


def test_shared_exchange_is_reused(spark):
    df = catalog.gap_interpolate(spark, FOLDER)
    df.collect()
    assert "ReusedExchange" in df._jdf.queryExecution().executedPlan().toString()
