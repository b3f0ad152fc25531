"""Invariants of the operators and reports on the driver tables."""

import os

import pytest
from pyspark.sql import functions as F

from blendwise.plans import registry, roles
from blendwise.sources import read_tables

SF = os.environ.get("BLENDWISE_TEST_SF", "/root/testdata/sf0.001")
Q = registry.queries()


@pytest.fixture(scope="module")
def t(spark):
    return read_tables(spark, SF)


def test_attribution_preserves_order_totals(spark, t):
    from blendwise.operators import attribute_measures, linear_attribution
    att = linear_attribution(roles.touches(t), roles.attribution_orders(t), roles.ATTRIBUTION_CHANNELS)
    sales = t["orders"].select(F.col("o_orderkey").cast("string").alias("order_id"),
                               F.col("o_orderdate").alias("date"),
                               roles.money("o_totalprice").alias("total"))
    out = attribute_measures(sales, att, {"revenue": F.col("total"), "orders": F.lit(1)},
                             exact_scale=2)
    got = out.agg(F.sum("revenue"), F.sum("orders")).first()
    want = sales.agg(F.sum("total"), F.count(F.lit(1))).first()
    assert got[0] == pytest.approx(want[0], abs=1e-3 * want[1])
    assert got[1] == pytest.approx(want[1], abs=1e-3)


def test_every_grain_sums_to_the_same_total(spark):
    df = Q["granularity_rollup_lineitem"](spark, SF)
    totals = df.groupBy("date_granularity").agg(F.sum("lines").alias("n"), F.sum("spend").alias("s"))
    rows = totals.collect()
    assert len(rows) == 5
    assert len({(r.n, r.s) for r in rows}) == 1


def test_skan_offset_keeps_total_installs(spark, t):
    out = Q["skan_offset"](spark, SF)
    li = t["lineitem"]
    non_self = li.filter(~F.col("l_returnflag").isin("R", "A")).count()
    assert out.agg(F.sum("installs")).first()[0] == non_self


def test_blend_has_no_null_measures(spark):
    df = Q["campaign_web_store"](spark, SF)
    measures = df.columns[4:]
    nulls = df.agg(*[F.sum(F.col(m).isNull().cast("int")).alias(m) for m in measures]).first()
    assert all(v == 0 for v in nulls)


def test_full_outer_blend_keeps_input_totals(spark, t):
    out = Q["full_outer_blend_two"](spark, SF).agg(F.sum("f_orders"), F.sum("spend")).first()
    o = t["orders"]
    assert out[0] == o.filter(F.col("o_orderstatus") == "F").count()
    assert out[1] == o.filter(F.col("o_orderstatus") != "F").agg(
        F.sum(roles.money("o_totalprice"))).first()[0]


def test_fee_pool_is_fully_allocated_per_month_within_grain(spark, t):
    from blendwise.operators import allocate_fee, granularity_rollup, video_masks
    from blendwise.functions import sum_
    base = granularity_rollup(
        t["lineitem"].select("l_shipdate", F.lit("Google Ads").alias("channel"),
                             F.lit("US").alias("market"), F.lit("Youtube").alias("campaign_type"),
                             F.concat(F.lit("video "), F.col("l_suppkey").cast("string")).alias("google_campaign"),
                             roles.money("l_extendedprice").alias("spend")),
        "l_shipdate", ["channel", "market", "campaign_type", "google_campaign"],
        {"spend": sum_("spend")}, grains=["month"])
    video, image = video_masks("channel", "market", "campaign_type", "google_campaign")
    out = allocate_fee(base, video, image, share_within_grain=True)
    per_month = out.groupBy("date").agg(
        (F.sum("spend_with_fees") - F.sum("spend") * 1.02565).alias("fees")).collect()
    assert per_month and all(r.fees == pytest.approx(10000.0) for r in per_month)


def test_stack_row_count_is_sum_of_branches(spark, t):
    assert Q["stack_relations"](spark, SF).count() == t["customer"].count()


def test_publish_partitions_by_grain(spark, tmp_path):
    from blendwise.sources import publish
    df = Q["granularity_rollup"](spark, SF)
    path = str(tmp_path / "out")
    publish(df, path=path)
    back = spark.read.parquet(path)
    assert sorted(r[0] for r in back.select("date_granularity").distinct().collect()) == \
        sorted(["day", "week", "month", "quarter", "year"])
    assert back.count() == df.count()
    assert os.path.isdir(os.path.join(path, "date_granularity=month"))


def test_cluster_session_requires_shared_checkpoint_folder():
    from blendwise.session import ensure_checkpoint_dir

    class _Ctx:
        master = "spark://cluster:7077"

        def getCheckpointDir(self):
            return None

    class _Conf:
        def get(self, key, default=None):
            return default

    class _Session:
        sparkContext = _Ctx()
        conf = _Conf()

    with pytest.raises(ValueError, match="shared"):
        ensure_checkpoint_dir(_Session())


def test_shuffle_partitions_sized_for_volume():
    from blendwise.session import shuffle_partitions_for
    tb = 1024 ** 4
    assert shuffle_partitions_for(100 * tb) == 819200
    assert shuffle_partitions_for(10 * 1024 ** 2) == 200
