"""Physical plans: what is pushed down, pruned and never used."""

import re

import pytest

import __spark_entry__ as contract
from fieldgauge.plans import batch

SF_DIR = "/root/testdata/sf0.001"


def plan(spark, name):
    df = contract.queries()[name](spark, SF_DIR)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(batch.QUERIES))
def test_no_cross_joins_no_python(spark, name):
    text = plan(spark, name)
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "MapInPandas", "MapInArrow"):
        assert node not in text


@pytest.mark.parametrize(
    "name, columns",
    [
        ("status_share", "user_id,event_type"),
        ("cadence_audit", "ts,user_id"),
        ("sequence_audit", "l_orderkey,l_linenumber"),
        ("top_k", "user_id"),
        ("alert_filter", "event_id,props"),
        ("count_lines", "text"),
        ("snapshot_lines", "event_id,user_id,props"),
        ("latest_orders", "o_orderkey,o_custkey,o_totalprice,o_orderdate"),
    ],
)
def test_only_needed_columns_are_read(spark, name, columns):
    schemas = re.findall(r"ReadSchema: struct<(.*?)>", plan(spark, name))
    assert schemas
    for schema in schemas:
        assert [c.split(":")[0] for c in schema.split(",")] == columns.split(",")


def test_lookup_filters_the_scan(spark):
    assert "EqualTo(user_id,7)" in plan(spark, "lookup")


def test_slice_reads_one_folder(spark):
    filters = re.search(r"PartitionFilters: \[(.*?)\]", plan(spark, "slice")).group(1)
    assert all(name in filters for name in ("event_type", "year", "month"))


@pytest.mark.parametrize("name, exchanges", [("latest_per_key", 1), ("top_k", 1), ("status_share", 2),
                                             ("cadence_audit", 2), ("pair_text", 0), ("classify_messages", 0),
                                             ("default_key", 0), ("route", 0), ("max_duration", 0)])
def test_number_of_shuffles(spark, name, exchanges):
    assert len(re.findall(r"Exchange (?:hash|range|round|Round)", plan(spark, name))) == exchanges


def test_top_k_sorts_only_k_rows(spark):
    assert "TakeOrderedAndProject" in plan(spark, "top_k")
