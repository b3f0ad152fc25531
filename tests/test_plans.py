"""Plan assertions: scans, pruning, join strategies."""

import contextlib
import io
import os

import pytest
from pyspark.sql import functions as F

from blendwise.functions import count_, sum_
from blendwise.operators import granularity_rollup, linear_attribution
from blendwise.plans import registry, roles
from blendwise.plans.queries import RANGED
from blendwise.sources import read_tables

registry.queries()  # fills RANGED
SF = os.environ.get("BLENDWISE_TEST_SF", "/root/testdata/sf0.001")


def physical(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue().split("\n\n")[0]


def test_cascade_reads_source_once_even_with_date_filter(spark):
    t = read_tables(spark, SF)
    rolled = granularity_rollup(t["lineitem"], "l_shipdate", ["l_suppkey"],
                                {"n": count_(), "q": sum_("l_quantity")})
    capped = rolled.filter(F.col("date") <= F.lit("1998-12-31").cast("date"))
    plan = physical(capped)
    assert plan.count("Scan parquet") == 1
    assert plan.count("Exchange") == 2


def test_union_strategy_prunes_other_grains(spark):
    t = read_tables(spark, SF)
    rolled = granularity_rollup(t["orders"], "o_orderdate", [], {"n": count_()}, strategy="union")
    plan = physical(rolled.filter(F.col("date_granularity") == "month"))
    assert plan.count("Scan parquet") == 1


def test_lookback_predicate_turns_left_join_inner(spark):
    t = read_tables(spark, SF)
    att = linear_attribution(roles.touches(t), roles.attribution_orders(t), roles.ATTRIBUTION_CHANNELS)
    plan = physical(att)
    assert "LeftOuter" not in plan and "FullOuter" not in plan
    assert "Inner" in plan


def test_small_dimension_is_broadcast(spark):
    plan = physical(registry.queries()["classify_keywords"](spark, SF))
    assert "BroadcastHashJoin" in plan


def test_no_cartesian_or_nested_loop_joins_in_blends(spark):
    qs = registry.queries()
    for name in ("full_outer_blend_chain", "campaign_web_store", "app_blend", "attributed_spend_blend"):
        plan = physical(qs[name](spark, SF))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def full_explain(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_filters_and_columns_reach_the_scan(spark):
    qs = registry.queries()
    text = full_explain(qs["stack_channels"](spark, SF))
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in text
    assert "l_tax" not in text.split("ReadSchema:")[1].split("\n")[0]   # unused columns pruned
    text = full_explain(qs["date_range_as_of"](spark, SF))
    assert "ReadSchema: struct<o_orderdate:timestamp_ntz>" in text
    assert "GreaterThanOrEqual(o_orderdate" in text


def test_date_range_reaches_the_scan(spark):
    t = read_tables(spark, SF)
    rolled = granularity_rollup(t["orders"], "o_orderdate", [], {"n": count_()}, date_range=("1997-03-10", "1997-04-20"))
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = rolled._jdf.queryExecution().explainString(mode)
    assert "GreaterThanOrEqual(o_orderdate,1997-01-01" in plan and "LessThan(o_orderdate,1998-01-01" in plan
    whole = granularity_rollup(t["orders"], "o_orderdate", [], {"n": count_()})
    rows = {(r.date.isoformat(), r.date_granularity): r.n for r in whole.collect()}
    got = {(r.date.isoformat(), r.date_granularity): r.n for r in rolled.collect()}
    first = {"day": "1997-03-10", "week": "1997-03-10", "month": "1997-03-01", "quarter": "1997-01-01", "year": "1997-01-01"}
    assert got == {k: n for k, n in rows.items() if first[k[1]] <= k[0] <= "1997-04-20"}


def scans(df) -> list[str]:
    """(table, pushed filters) of every file scan of the optimised plan."""
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(mode)
    out = []
    for block in text.split("\n\n"):
        if "Scan parquet" in block and "Location:" in block:
            table = block.split("Location:")[1].split("]")[0].rstrip("/").split("/")[-1].split(".")[0]
            pushed = block.split("PushedFilters:")[1].split("\n")[0] if "PushedFilters:" in block else ""
            columns = block.split("ReadSchema:")[1].split("\n")[0]
            out.append((table, pushed, columns))
    return out


@pytest.mark.parametrize("name", RANGED)
def test_a_range_bounds_every_fact_scan(spark, name):
    found = scans(registry.queries()[f"{name}_range"](spark, SF))
    for table, pushed, columns in found:
        if table == "lineitem":  # lines of the range's orders come through a semi-join on the order
            assert "OrEqual(l_shipdate" in pushed or "l_orderkey" in columns, (name, pushed)
        if table == "orders":  # a customer's first order may lie before the range
            assert "OrEqual(o_orderdate" in pushed or "o_custkey" in columns and "o_totalprice" not in columns, (name, pushed, columns)
        if table == "events":
            assert "OrEqual(ts" in pushed, (name, pushed)


def test_rejected_costs_are_observed_with_the_result(spark):
    from pyspark.sql import Observation

    from blendwise.plans import report_queries3 as R3, reports
    t = read_tables(spark, SF)
    dims = ["campaign_id", "campaign_name"]
    network = R3._network(t)
    broken = network.withColumn("cost", F.when(F.col("clicks") == 7, F.lit("n/a")).otherwise(F.col("cost")))
    seen = Observation("rejects")
    ads = R3.ad_period(t, ["A"], dims, grains=["day"])
    report = reports.attributed_spend_blend(
        {"touches": roles.touches(t), "orders": roles.attribution_orders(t), "store_order": R3._store_order(t),
         "meta_ads": ads, "google": ads, "google_ads": ads, "network": broken}, exact_scale=2, rejects=seen)
    assert report.count() > 0
    alive = broken.where("_fivetran_deleted = false")
    assert seen.get == {"costs": alive.where("cost is not null").count(), "unreadable_costs": alive.where("cost in ('', 'n/a')").count(),
                        "blank_costs": alive.where("cost in ('', 'n/a')").count()}
