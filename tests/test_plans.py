"""Plan guards: no registered query may plan a nested-loop / cartesian join or Python evaluation."""

import re

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
FORBIDDEN = r"BroadcastNestedLoopJoin|CartesianProduct|BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas"


@pytest.fixture(scope="module")
def no_auto_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # the plans large inputs get
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(E.LLM_QUERIES)))
def test_plan_has_no_forbidden_operators(spark, no_auto_broadcast, name):
    plan = E.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert re.findall(FORBIDDEN, plan) == []


def test_window_filters_reach_the_scan(spark):
    plan = E.queries()["usage_30d"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    pushed = [line for line in plan.splitlines() if "PushedFilters" in line and "event_type" in line]
    assert pushed and all("GreaterThanOrEqual(ts," in line for line in pushed)
    # column pruning: only the four columns the usage aggregate needs (no event_id, no props)
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in plan
    assert "props" not in plan
