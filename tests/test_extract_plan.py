"""A filter by record type does not copy the expression of the line."""

import pytest

from feedloom.layouts import FEEDS
from feedloom.plans.queries import _bound
from feedloom.plans.sample_lines import lines_sql
from feedloom.plans.transform import extract, transform


@pytest.mark.parametrize("with_status", [False, True])
def test_plan_of_computed_lines_stays_small(spark, with_status):
    feed = FEEDS["position_balance"]
    items = spark.range(1, 600).selectExpr(
        "id AS l_orderkey", "CAST(1 AS INT) AS l_linenumber", "id AS l_partkey", "id AS l_suppkey",
        "CAST(id AS DOUBLE) AS l_extendedprice", "'N' AS l_returnflag", "'O' AS l_linestatus")
    lines = spark.sql(_bound(lines_sql(feed), "lineitem"), lineitem=items)
    header = extract(lines, feed, "Customer Position Header", with_status=with_status)
    plan = header._jdf.queryExecution().optimizedPlan().toString()
    # The expression of the line stands in it once; copied into the filter it stood there some sixty times.
    assert plan.count("?????????????????????") <= 2
    types = {r._ROW_ID: r._ROW_TYPE for r in transform(lines, feed).collect()}
    assert {r._ROW_ID for r in header.select("_ROW_ID").collect()} == \
        {k for k, name in types.items() if name == "Customer Position Header"} != set()
