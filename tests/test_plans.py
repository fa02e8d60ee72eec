"""Physical-plan checks: the plans we want at scale, not just the right rows."""

import re

import pytest

import __spark_entry__ as E

from .conftest import SF_SMALL

QUERIES = E.queries()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_attempts_limit_rows_before_the_shuffle(spark):
    p = plan(QUERIES["attempt_history"](spark, SF_SMALL))
    assert "WindowGroupLimit" in p and "Partial" in p
    assert p.count("Exchange") == 1  # one shuffle: window, cut and aggregate share it


def test_scan_prunes_columns(spark):
    p = plan(QUERIES["attempt_history"](spark, SF_SMALL))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", p).group(1)
    assert "props" not in schema and "value" not in schema


def test_branch_match_is_an_equi_join(spark):
    p = plan(QUERIES["match_branches"](spark, SF_SMALL))
    assert "NestedLoopJoin" not in p and "CartesianProduct" not in p
    assert "SortMergeJoin" in p or "BroadcastHashJoin" in p or "ShuffledHashJoin" in p


def test_routing_table_is_broadcast(spark):
    assert "BroadcastHashJoin" in plan(QUERIES["route_model"](spark, SF_SMALL))


def test_cost_rollup_aggregates_before_the_join(spark):
    p = plan(QUERIES["cost_rollup"](spark, SF_SMALL))
    first_join = min(i for i in (p.find("SortMergeJoin"), p.find("BroadcastHashJoin")) if i >= 0)
    # the usage aggregate (partial + final) sits below the join in the plan text
    assert p.find("HashAggregate", first_join) > first_join


STATIC = [n for n in sorted(QUERIES) if not n.startswith(("stream_", "run_log", "json_array", "exec_log", "kv_",
                                                            "config_docs", "state_round", "issue_", "prompt_",
                                                            "stack_listing", "read_documents", "append_"))]


@pytest.mark.parametrize("name", STATIC)
def test_no_cross_products(spark, name):
    p = plan(QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


@pytest.mark.parametrize("name", ["tail_error", "top_files_per_context"])
def test_first_k_limits_rows_before_the_shuffle(spark, name):
    p = plan(QUERIES[name](spark, SF_SMALL))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_thread_positions_use_range_partitioning(spark):
    p = plan(QUERIES["ordered_comments"](spark, SF_SMALL))
    assert "rangepartitioning" not in p  # cut once into a written table that both sides read
    assert p.count("Scan parquet") >= 2 and "row_number" not in p  # no per-thread row_number window


def test_fk_keys_are_counted_before_the_anti_join(spark):
    p = plan(QUERIES["fk_violations"](spark, SF_SMALL))
    first_anti = p.find("LeftAnti")
    assert first_anti > 0 and p.find("HashAggregate", first_anti) > first_anti


def test_latest_state_has_one_shuffle(spark):
    assert plan(QUERIES["latest_state"](spark, SF_SMALL)).count("Exchange") == 1
