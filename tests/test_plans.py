"""Physical plans: what must and must not be in them."""

import os
import re

import pytest

import __spark_entry__ as entry
from outledger.operators.batching import with_position

FOLDER = "/root/testdata/sf0.001"
QUERIES = entry.queries()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")

# These run writes or streams; their returned plan is only the read-back.
PLANNED = [n for n in sorted(QUERIES) if "stream" not in n and n not in ("push_run",)]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PLANNED)
def test_no_python_and_no_cross_join(spark, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def single_partition_children(plan):
    """The operators whose rows go through a single-partition exchange."""
    lines = plan.splitlines()
    found = []
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            below = re.sub(r"^[\s:+\-*()\d]*", "", lines[i + 1])
            found.append(below.split("(")[0].split(" ")[0])
    return found


@pytest.mark.parametrize("name", PLANNED)
def test_single_partition_only_holds_partial_aggregates(spark, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    allowed = {"HashAggregate", "SortAggregate", "ObjectHashAggregate", "LocalLimit", "GlobalLimit"}
    assert set(single_partition_children(plan)) <= allowed


@pytest.mark.parametrize(
    "name", ["source_priority", "first_line_per_doc", "first_per_composite", "pipe_prices"]
)
def test_rankings_limit_rows_before_the_shuffle(spark, name):
    if name == "pipe_prices":
        from outledger.plans import prices
        from outledger.queries.sample_rules import AS_OF, RULES
        from outledger.queries.views import erp

        plan = plan_of(prices.price_rows(erp(spark, FOLDER), RULES, AS_OF))
    else:
        plan = plan_of(QUERIES[name](spark, FOLDER))
    assert plan.count("Partial") >= 1 and "WindowGroupLimit" in plan


def test_semi_joins_and_existence(spark):
    assert "LeftSemi" in plan_of(QUERIES["exists_semi"](spark, FOLDER))
    either = plan_of(QUERIES["exists_either"](spark, FOLDER))
    assert either.count("LeftOuter") == 2
    assert "max_by" in plan_of(QUERIES["apply_top1"](spark, FOLDER))


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(QUERIES["point_lookup"](spark, FOLDER))
    assert "EqualTo(o_orderkey,1000)" in plan and "o_orderpriority" not in plan
    day = plan_of(QUERIES["today_slice"](spark, FOLDER))
    assert "GreaterThanOrEqual(ts" in day and "LessThan(t" in day


def test_position_needs_no_single_partition(spark):
    df = with_position(spark.range(1000), ["id"])
    assert "SinglePartition" not in plan_of(df)


def test_page_is_a_top_n(spark):
    assert "TakeOrderedAndProject" in plan_of(QUERIES["offset_page"](spark, FOLDER))
