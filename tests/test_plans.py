"""What the plans look like, on the test tables."""

import re

from fleetmart.workload.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"

def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def columns_read(plan, table):
    return {
        c.split(":")[0]
        for scan in re.findall(rf"{table}\.parquet\].*?ReadSchema: struct<(.*?)>(?:\n|$)", plan)
        for c in scan.split(",")
    }


def test_marts_read_only_what_they_need(spark):
    plan = physical(QUERIES["driver_efficiency"](spark, FOLDER))
    assert columns_read(plan, "lineitem") == {"l_orderkey", "l_suppkey", "l_quantity"}
    assert columns_read(plan, "orders") == {"o_orderkey", "o_totalprice"}


def test_filters_reach_the_files(spark):
    plan = physical(QUERIES["customer_analytics_recent"](spark, FOLDER))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(o_orderdate", plan)


def test_the_fact_is_reduced_before_it_meets_the_dimension(spark):
    plan = physical(QUERIES["driver_efficiency"](spark, FOLDER))
    lines = plan.splitlines()
    join = next(n for n, line in enumerate(lines) if "Join [driver_id" in line)
    partial = next(n for n, line in enumerate(lines) if "partial_sum" in line)

    def depth(n):
        return re.search("[A-Z]", lines[n]).start()

    assert partial > join and depth(partial) > depth(join)


def test_small_dimensions_do_not_move_the_fact(spark):
    from fleetmart.plans import marts
    from fleetmart.workload.views import Views

    v = Views(spark, FOLDER)
    flat = spark.createDataFrame(v.full_rides.collect(), v.full_rides.schema)
    assert "Exchange hashpartitioning(current_status" not in physical(marts.orders_sla(flat, v.statuses, v.tariffs))
