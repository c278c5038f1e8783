"""What the plans must look like: pushed filters, pruned columns, partial aggregation, no cross joins."""

import re

import pytest

from tests.conftest import SMALL
from tidemark.plans import QUERIES


def plan(spark, name):
    return QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()


def read_columns(text):
    return [set(re.findall(r"(\w+):", schema)) for schema in re.findall(r"ReadSchema: struct<([^>]*)", text)]


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(spark, "filter_point")
    assert "EqualTo(o_orderkey,1006)" in text
    assert read_columns(text) == [{"o_orderkey", "o_custkey", "o_totalprice"}]
    assert "GreaterThanOrEqual(o_custkey,100)" in plan(spark, "filter_range")
    assert "In(user_id, [1,2,3])" in plan(spark, "filter_in_param")
    assert read_columns(plan(spark, "agg_token_freq")) == [{"event_id", "ts", "user_id", "event_type"}]


def test_retention_prunes_partitions(spark):
    assert re.search(r"PartitionFilters: \[[^\]]*day", plan(spark, "retention_drop"))


@pytest.mark.parametrize("name", ["emit_on_update", "join_full_latest", "merge_columns", "keyed_versioned",
                                  "rep_leader_distribution", "rep_backpressure", "win_tumble"])
def test_aggregates_combine_before_the_shuffle(spark, name):
    text = plan(spark, name)
    assert "partial_" in text
    assert "Python" not in text and "Pandas" not in text


def test_full_latest_join_is_one_shuffle(spark):
    text = plan(spark, "join_full_latest")
    assert text.count("Exchange hashpartitioning") == 1 and "Join" not in text


def test_three_json_sides_join_every_event(spark):
    from tidemark.operators.latest import tag_sides
    from tidemark.plans import joins

    events = spark.read.parquet(f"{SMALL}/events.parquet")
    tagged = tag_sides(joins._json_sides(events), "p", "seq")
    assert tagged.select("seq").exceptAll(events.select("event_id")).count() == 0
    assert tagged.count() == events.count() and tagged.select("_side").distinct().count() == 3
    text = plan(spark, "join_full_latest_json")
    assert text.count("Exchange hashpartitioning") == 1 and "Join" not in text and "get_json_object" in text


def test_stateless_queries_do_not_shuffle(spark):
    for name in ("json_pairs_raw", "frame_header", "tier_of_age", "sink_json_rows", "json_typed_rows", "fn_extract"):
        assert "Exchange" not in plan(spark, name), name


@pytest.mark.parametrize("name", ["join_lookup", "join_two_tier", "route_target", "rename_chain", "expire_all",
                                  "trace_groups", "agg_p90", "emit_periodic_keyed"])
def test_no_cross_joins(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_expiry_windows_share_one_shuffle(spark):
    assert plan(spark, "expire_all").count("Exchange hashpartitioning") == 1
