"""What the registered queries must not, and must, have in their plans."""

from __future__ import annotations

import re

import pytest

from tests.conftest import SMALL
from tidelake.queries import arrivals, matching, rental, reshape

WRITING = {"next_key", "incremental_files", "stream_drain", "stream_parse", "stream_manifest", "stream_gate", "wait_for_all"}
READING = {
    name: query
    for family in (rental, matching, reshape, arrivals)
    for name, query in family.QUERIES.items()
    if name not in WRITING
}


@pytest.fixture(autouse=True)
def large_tables(spark):
    """Plan as if no table were small enough to be broadcast."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def plan_of(spark, name):
    return READING[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(READING))
def test_no_pairing_of_everything_and_no_python(spark, name):
    plan = plan_of(spark, name)
    for operator in ("CartesianProduct", "NestedLoop", "Python", "Pandas", "Window", "RDDScan"):
        assert operator not in plan
    if name not in ("lookup_exact", "unmatched_keys"):  # the rule table of the caller
        assert "BroadcastHashJoin" not in plan


@pytest.mark.parametrize(
    ("name", "shuffles"),
    [
        ("rental_fact", 4),
        ("latest_per_key", 5),  # four for the joins, one small one per store
        ("match_on_id", 2),
        ("match_growth", 2),
        ("pivot_max", 1),
        ("arrival_gate", 1),
        ("arrival_missing", 1),
        ("parse_notifications", 0),
    ],
)
def test_number_of_shuffles(spark, name, shuffles):
    assert len(re.findall(r"Exchange hashpartitioning", plan_of(spark, name))) == shuffles


def test_filters_and_columns_reach_the_reader(spark):
    plan = plan_of(spark, "filter_partition")
    assert "GreaterThanOrEqual(o_orderdate,1998-02-06" in plan
    assert "EqualTo(c_nationkey,1)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double,l_shipdate:timestamp_ntz>" in plan
    assert "EqualTo(o_custkey,4)" in plan_of(spark, "filter_point")
    assert "In(event_type" in plan_of(spark, "arrival_gate")


def test_manifest_needs_no_sort(spark):
    assert not re.search(r"\bSort \[", plan_of(spark, "manifest_latest"))
