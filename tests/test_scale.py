"""Publishing, mergeable distinct counts, split joins, gap filling, bucketed sources and shared relations."""

import contextlib
import datetime as dt
import glob
import io
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from blendwise.functions import count_, sum_
from blendwise.functions.aggs import exact_sum_, max_, min_
from blendwise.functions.dates import GRAINS
from blendwise.operators import (
    days_of_periods, dense_ids, distinct_rollup, full_outer, gap_fill, granularity_rollup, reduce_to, split_full_outer,
)
from blendwise.session import SCALE_CONF, Shared, ensure_checkpoint_dir
from blendwise.sources import PublishError, publish, publishing, read_tables
from blendwise.sources.bucketed import ContractError, bucketed_table, write_bucketed

SF = os.environ.get("BLENDWISE_TEST_SF", "/root/testdata/sf0.001")


def physical(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue().split("\n\n")[0]


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@contextlib.contextmanager
def settings(spark, **conf):
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


# ------------------------------------------------------------------ publish --

def wide(spark, n=4000):
    return spark.range(n).select(F.when(F.col("id") % 10 < 7, "day").when(F.col("id") % 10 < 9, "week").otherwise(None).alias("date_granularity"),
                                 F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 50).cast("int")).alias("date"),
                                 F.sha2(F.col("id").cast("string"), 256).alias("text"), "id")


def data_files(path):
    return sorted(glob.glob(f"{path}/**/part-*", recursive=True))


def test_files_are_planned_by_size(spark, tmp_path):
    df, path = wide(spark), str(tmp_path / "out")
    done = publish(df, path=path, file_bytes=32 * 1024)
    back = spark.read.schema(df.schema).parquet(path)
    assert rows(back.select(*df.columns)) == rows(df) and done.rows == 4000 and done.rows_by == {"day": 2800, "week": 800, None: 400}
    sizes = {}
    for f in data_files(path):
        grain = os.path.basename(os.path.dirname(f))
        sizes.setdefault(grain, []).append(os.path.getsize(f))
    assert {len(v) for v in sizes.values()} != {1}
    for grain, n in done.files.items():
        own = sizes[f"date_granularity={grain or '__HIVE_DEFAULT_PARTITION__'}"]
        assert len(own) == n <= -(-sum(own) // (32 * 1024)) + 1


def test_publish_replaces_all_or_touched_grains(spark, tmp_path):
    df, path = wide(spark, 500), str(tmp_path / "out")
    publish(df, path=path)
    publish(df.where("date_granularity = 'week'").limit(3), path=path, replace="touched")
    back = spark.read.schema(df.schema).parquet(path)
    assert dict(map(tuple, back.groupBy("date_granularity").count().collect())) == {"day": 350, "week": 3, None: 50}
    publish(df.where("date_granularity = 'day'"), path=path)
    assert spark.read.schema(df.schema).parquet(path).count() == 350
    publish(df.limit(0), path=path, replace="touched")
    assert spark.read.schema(df.schema).parquet(path).count() == 350
    publish(df.limit(0), path=path)
    assert spark.read.schema(df.schema).parquet(path).count() == 0


def test_publish_to_a_catalog_table(spark, tmp_path):
    df = wide(spark, 300)
    with settings(spark, **{"spark.sql.sources.default": "parquet"}):
        spark.sql("DROP TABLE IF EXISTS published_report")
        df.limit(0).write.partitionBy("date_granularity").option("path", str(tmp_path / "t")).saveAsTable("published_report")
        publish(df, "published_report", replace="touched")
        publish(df.where("date_granularity = 'week'").limit(2), "published_report", replace="touched")
        assert spark.table("published_report").where("date_granularity = 'week'").count() == 2
        assert spark.table("published_report").count() == 300 - 60 + 2
        spark.sql("DROP TABLE published_report")
    with pytest.raises(ValueError):
        publish(df, "t", path="p")
    with pytest.raises(ValueError):
        publish(df, "t", replace="some")


def test_a_damaged_stage_leaves_the_target(spark, tmp_path, monkeypatch):
    df, path = wide(spark, 200), str(tmp_path / "out")
    publish(df, path=path)
    before = data_files(path)
    stage = publishing._stage

    def one_more(*args):
        staged, n, checksum = stage(*args)
        return staged, n + 1, checksum

    monkeypatch.setattr(publishing, "_stage", one_more)
    with pytest.raises(PublishError):
        publish(df, path=path)
    assert data_files(path) == before
    staged = ensure_checkpoint_dir(spark).removeprefix("file:")
    assert not [x for x in os.listdir(staged) if x.startswith("publish-")]


def test_a_hot_date_is_cut_and_files_stay_in_order(spark, tmp_path):
    df, path = wide(spark, 6000).withColumn("date", F.when(F.col("id") % 2 == 0, F.lit("2024-01-20").cast("date")).otherwise(F.col("date"))), str(tmp_path / "o")
    done = publish(df, path=path, order_by=["date"], file_bytes=48 * 1024)
    back = spark.read.schema(df.schema).parquet(path).where("date_granularity = 'day'")
    files = back.groupBy(F.col("_metadata.file_name").alias("f")).agg(F.min("date"), F.max("date"), F.count("*")).orderBy("f").collect()
    assert len(files) >= 3 and len(files) <= done.files["day"] + 1
    assert all(a[2] <= b[1] for a, b in zip(files, files[1:]))
    hot = [f for f in files if f[1] <= dt.date(2024, 1, 20) <= f[2]]
    assert len(hot) >= 2


# ----------------------------------------------------------------- lattice --

AGGS = {"n": count_(), "q": sum_("v", fill=0), "x": exact_sum_("w"), "lo": min_("v"), "hi": max_("v"), "some": count_("v")}


@pytest.mark.parametrize("grains", [("day", "week", "month", "quarter", "year"), ("year",), ("quarter", "week"), ("month", "year"), ("year", "day")])
@pytest.mark.parametrize("week_start", ["monday", "sunday"])
def test_lattice_equals_union(spark, grains, week_start):
    rng = random.Random(5)
    data = [(dt.date(2023, 1, 1) + dt.timedelta(rng.randrange(800)) if rng.random() > .05 else None, rng.choice(["a", "b", None]),
             rng.choice([None, 1, 2, 50]), rng.random()) for _ in range(600)]
    df = spark.createDataFrame(data, "d date, k string, v long, w double")
    forms = [granularity_rollup(df, "d", ["k"], AGGS, grains, week_start, strategy=s) for s in ("lattice", "union")]
    assert forms[0].columns == forms[1].columns and rows(forms[0]) == rows(forms[1])


def test_lattice_reads_its_source_once_under_a_filter(spark):
    t = read_tables(spark, SF)
    rolled = granularity_rollup(t["lineitem"], "l_shipdate", ["l_suppkey"], {"n": count_(), "q": sum_("l_quantity")}, strategy="lattice")
    plan = final_plan(rolled.filter(F.col("date") >= F.lit("1995-06-01").cast("date")))
    executed = plan.split("== Initial Plan ==")[0]
    assert executed.count("FileScan parquet") == 1
    assert "Expand" not in executed and "ReusedExchange" in executed


# ---------------------------------------------------------------- distinct --

def test_dense_ids_are_dense_and_in_order(spark):
    rng = random.Random(2)
    data = [(i, dt.date(2024, 1, 1) + dt.timedelta(0 if i % 3 else rng.randrange(40)) if i % 50 else None) for i in range(500)]
    df = spark.createDataFrame(data + data[:20] + [(None, dt.date(2024, 1, 1))], "id long, d date")
    got = dense_ids(df, "id", "d", per_part=16).collect()
    assert sorted(r.dense_id for r in got) == list(range(1, 501)) and len({r.id for r in got}) == 500
    days = dict(data)
    order = [days[r.id] or dt.date(1, 1, 1) for r in sorted(got, key=lambda r: r.dense_id)]
    assert order == sorted(order)


def test_distinct_rollup_equals_count_distinct(spark):
    rng = random.Random(8)
    data = [(dt.date(2024, 1, 1) + dt.timedelta(rng.randrange(120)), rng.choice(["a", "b", None]), rng.choice([None, *range(60)]), rng.random() < .4, 3)
            for _ in range(900)] + [(None, "a", 3, True, 1)]
    df = spark.createDataFrame(data, "d date, k string, id long, first boolean, v long")
    numbers = dense_ids(df, "id", "d", "number", per_part=8)
    known = df.join(numbers, "id", "left")
    got = distinct_rollup(known, "d", ["k"], "number", {"ids": None, "firsts": F.col("first")}, {"n": count_(), "v": sum_("v", fill=0)})
    want = None
    for g in ("day", "week", "month", "quarter", "year"):
        part = df.groupBy(F.trunc("d", g).alias("date") if g != "day" else F.col("d").alias("date"), F.lit(g).alias("date_granularity"), "k").agg(
            F.count_distinct("id").alias("ids"), F.count_distinct(F.when(F.col("first"), F.col("id"))).alias("firsts"), F.count("*").alias("n"), F.sum("v").alias("v"))
        want = part if want is None else want.unionByName(part)
    assert got.columns == want.columns and rows(got) == rows(want)
    plan = final_plan(got).split("== Initial Plan ==")[0]
    assert "Expand" not in plan
    with pytest.raises(ValueError):
        from blendwise.functions.aggs import count_distinct
        distinct_rollup(known, "d", [], "number", {"ids": None}, {"x": count_distinct("id")})


# ------------------------------------------------------------------- joins --

def test_split_full_outer_equals_the_plain_join(spark):
    left = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (None, "a", 3), (2, None, 4), (9, "z", 5), (1, "a", 6)] + [(7, "h", i) for i in range(200)],
                                 "k int, c string, v int")
    right = spark.createDataFrame([(1, "a", 10), (7, "h", 70), (7, "other", 71), (None, "a", 11), (3, "q", 12), (2, None, 13)], "k int, c string, w int")
    for keys in (["k"], ["k", "c"]):
        l, r = (left, right.drop("c")) if keys == ["k"] else (left, right)
        assert rows(split_full_outer(l, r, keys, parts=8, min_rows=0)) == rows(full_outer(l, r, keys))
        assert rows(split_full_outer(l, r, keys)) == rows(full_outer(l, r, keys))
    empty = left.limit(0)
    assert rows(split_full_outer(empty, right, ["k", "c"], parts=4, min_rows=0)) == rows(full_outer(empty, right, ["k", "c"]))


def test_a_hot_reduced_key_does_not_fill_one_task(spark):
    left = spark.range(40_000).select(F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id") % 997).alias("k"), F.col("id").alias("v"))
    right = spark.range(1200).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8",
           "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    with settings(spark, **off):
        per_task = lambda df: [r[1] for r in df.groupBy(F.spark_partition_id()).count().collect() if r[1] > 300]
        plain = per_task(full_outer(left, right, ["k"]))
        split = per_task(split_full_outer(left, right, ["k"], parts=256, min_rows=0).where("v is not null"))
    assert max(plain) > 2 * sum(plain) / 8
    assert sum(split) == 40_000 and max(split) <= 2 * sum(split) / 8


def test_a_side_of_some_megabytes_is_not_broadcast(spark):
    left = spark.range(1_000_000).select((F.col("id") % 700_001).alias("k"), "id")
    right = spark.range(700_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))  # 11 MB, several times that as a hash table
    sized = {k: SCALE_CONF[k] for k in SCALE_CONF if k.endswith("roadcastJoinThreshold")}
    with settings(spark, **sized):
        assert "BroadcastHashJoin" not in physical(left.join(right, "k"))
    assert int(SCALE_CONF["spark.sql.files.maxPartitionBytes"]) <= 32 << 20


def test_reduce_to_is_a_semi_join_with_a_bloom_filter(spark):
    t = read_tables(spark, SF)
    few = t["orders"].where("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").alias("l_orderkey"))
    low = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
           "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0"}
    with settings(spark, **low):
        reduced = reduce_to(t["lineitem"], few, ["l_orderkey"])
        text = reduced._jdf.queryExecution().toString()
        assert "LeftSemi" in text and "might_contain" in text
    wanted = {r[0] for r in few.collect()}
    assert reduced.count() == t["lineitem"].where(F.col("l_orderkey").isin(*wanted)).count()


def test_days_of_periods(spark):
    periods = spark.createDataFrame([(dt.date(2024, 2, 1), "month"), (dt.date(2024, 2, 26), "week"), (dt.date(2024, 2, 5), "day"), (dt.date(2024, 1, 1), "never"),
                                     (None, "day")], "date date, date_granularity string")
    days = sorted(r.day for r in days_of_periods(periods).collect())
    assert days == [dt.date(2024, 2, 1) + dt.timedelta(i) for i in range(32)]


def test_gap_fill(spark):
    d = dt.date
    df = spark.createDataFrame([("a", "month", d(2024, 1, 1), 1), ("a", "month", d(2024, 4, 1), 2), ("a", "day", d(2024, 1, 5), 3), (None, "week", d(2024, 1, 1), 4),
                                (None, "week", d(2024, 1, 15), 5), ("b", "year", None, 6), ("b", "odd", d(2024, 1, 1), 7)],
                               "k string, date_granularity string, date date, v int")
    got = rows(gap_fill(df, ["k"]))
    extra = [("a", "month", d(2024, 2, 1), None), ("a", "month", d(2024, 3, 1), None), (None, "week", d(2024, 1, 8), None)]
    assert got == sorted([*map(tuple, df.collect()), *extra], key=str)
    assert "Cartesian" not in physical(gap_fill(df, ["k"])) and "NestedLoop" not in physical(gap_fill(df, ["k"]))


# ------------------------------------------------------ bucketed and shared --

def test_bucketed_sources_join_without_a_shuffle(spark, tmp_path):
    li = read_tables(spark, SF)["lineitem"].select(F.col("l_suppkey").alias("k"), F.col("l_shipdate").cast("date").alias("d"), "l_quantity")
    for name in ("one", "two"):
        spark.sql(f"DROP TABLE IF EXISTS bucketed_{name}")
        write_bucketed(li, f"bucketed_{name}", ["k", "d"], 4, path=str(tmp_path / name))
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    with settings(spark, **off):
        one, two = (bucketed_table(spark, f"bucketed_{n}", ["k", "d"], 4).groupBy("k", "d").agg(F.sum("l_quantity").alias(n)) for n in ("one", "two"))
        joined = full_outer(one, two, ["k", "d"])
        assert "Exchange" not in physical(joined)
        assert joined.where("one <> two or one is null or two is null").count() == 0
    with pytest.raises(ContractError):
        bucketed_table(spark, "bucketed_one", ["d", "k"])
    with pytest.raises(ContractError):
        bucketed_table(spark, "bucketed_one", ["k", "d"], 8)
    for name in ("one", "two"):
        spark.sql(f"DROP TABLE bucketed_{name}")


def test_shared_relations_go_with_their_owner(spark):
    with Shared(spark) as shared:
        one = shared.written(spark.range(10))
        two = shared.written(one.select((F.col("id") * 2).alias("x")))
        assert one.count() == 10 and two.agg(F.sum("x")).first()[0] == 90
        folder = shared.folder.removeprefix("file:")
        assert len(os.listdir(folder)) == 2
    assert not os.path.exists(folder)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_touch_keys_are_those_of_the_output_before_the_roll_up(spark):
    from blendwise.plans import registry
    plan = _plan(registry.queries()["touch_orders_fee_allocation"](spark, "/root/testdata/sf0.001"))
    assert "channel_adj" not in "".join(x for x in plan.splitlines() if "hashpartitioning(" in x)


def test_cascade_merges_the_fan_out_where_the_key_lies(spark):
    rows = spark.createDataFrame([("a", "2024-02-28", 1), ("a", "2024-02-29", 2), ("b", "2024-03-01", 3), (None, "2024-03-01", 4)], "k string, d string, v int")
    roll = lambda **o: granularity_rollup(rows, "d", ["k"], {"v": sum_("v")}, **o)
    assert sorted(map(str, roll().collect())) == sorted(map(str, roll(strategy="union").collect()))
    plan = _plan(roll())
    assert "hashpartitioning(k#" in plan  # day rows by key alone
    assert "hashpartitioning(date#" not in plan  # no shuffle of the five rows of each


def test_distinct_rollup_holds_no_block_per_day(spark):
    """One id a block of 32,768 numbers and day: rows as many as facts, not a bitmap each."""
    far = spark.createDataFrame([(i * 40_000, f"2024-01-{1 + i % 28:02d}", i % 3) for i in range(84)], "number long, d string, k int")
    got = distinct_rollup(far, "d", ["k"], "number", {"ids": None, "odd": F.col("number") % 80_000 != 0}, {"n": count_()})
    assert "bitmap" not in _plan(got)
    year = {r["k"]: (r["ids"], r["odd"], r["n"]) for r in got.where("date_granularity = 'year'").collect()}
    assert year == {k: (28, 14, 28) for k in range(3)}


def test_adset_blend_sums_each_channel_where_it_lies(spark):
    from blendwise.plans.queries import tables
    from blendwise.plans import registry
    plan = _plan(registry.queries()["adset_store_blend"](spark, "/root/testdata/sf0.001"))
    assert not [x for x in plan.splitlines() if "hashpartitioning(" in x and "campaign_id#" in x and "date_granularity#" in x]


def test_partitions_follow_the_input(spark, tmp_path):
    from blendwise.session import configure_for, partitions_for_input
    spark.range(200_000).selectExpr("rand(1) AS a").write.parquet(f"{tmp_path}/t.parquet")
    few, many = (partitions_for_input(spark, str(tmp_path), n) for n in (1 << 30, 1 << 16))
    assert few == 1 and many >= 200_000 * 8 // (1 << 16) // 2
    configure_for(spark, str(tmp_path))
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum") == spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")


def shuffle_files(spark) -> set:
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {f for f in files.split("\n") if f.endswith(".data")}


def left_after(spark, before) -> set:
    for _ in range(50):
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.2)
    return left


def test_shared_tables_leave_no_shuffle_files(spark):
    before = shuffle_files(spark)
    with Shared(spark) as shared:
        table = shared.written(spark.range(100_000).groupBy((F.col("id") % 1000).alias("x")).count().repartition(5, "x"))
        assert not left_after(spark, before)
        assert table.count() == 1000
        held = shared.written(table.select("x"))
        shared.drop(table)
        assert held.count() == 1000 and len(os.listdir(shared.folder.removeprefix("file:"))) == 1


def test_grains_are_written_one_after_the_other(spark):
    from blendwise.plans.queries import grain_by_grain
    before, seen = shuffle_files(spark), []

    def report(grains):
        seen.append((grains, left_after(spark, before)))
        days = spark.range(400).select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("day"), (F.col("id") % 3).alias("k"))
        return granularity_rollup(days, "day", ["k"], {"n": count_()}, grains=grains).repartition(4, "k")

    rows = {tuple(r) for r in grain_by_grain(spark, report).collect()}
    assert [g for g, _ in seen] == [[g] for g in GRAINS] and not any(left for _, left in seen)
    days = spark.range(400).select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("day"), (F.col("id") % 3).alias("k"))
    assert rows == {tuple(r) for r in granularity_rollup(days, "day", ["k"], {"n": count_()}).collect()}


def test_one_grain_is_rolled_up_in_one_shuffle(spark):
    rows = spark.range(100).select(F.lit("2024-01-01").cast("date").alias("day"), (F.col("id") % 3).alias("k"))
    plan = granularity_rollup(rows, "day", ["k"], {"n": count_()}, grains=["week"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_written_share_totals_do_not_shuffle_the_rows(spark):
    from blendwise.operators import share_of_total
    rows = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").alias("v")).repartition(3)
    with Shared(spark) as shared:
        out = share_of_total(rows, "v", ["k"], shared=shared)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert sorted(map(tuple, out.collect())) == sorted(map(tuple, share_of_total(rows, "v", ["k"]).collect()))
