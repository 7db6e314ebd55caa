"""What the physical plans must look like for the work to scale."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from sediment.operators import report
from sediment.operators.keys import KeyFilter, key_filter, seen_keys
from sediment.operators.upsert import MergePlan, MergeSpec, merge_upsert
from sediment.plans import tables
from sediment.queries.landed import landing_orders
from sediment.session import configured
from sediment.sinks.staging import staged
from sediment.sinks.tables import PartitionMerge, create_table, upsert
from sediment.sources import conform
from tests.conftest import SF_DIR, plan, rows

LAZY = (
    "gold_daily_sales",
    "gold_customer_metrics",
    "gold_category_performance",
    "country_category_revenue",
    "merge_orders",
    "prices_dedup",
    "reject_split",
    "landing_coverage",
)


@pytest.mark.parametrize("name", LAZY)
def test_no_python_no_cross_join_no_single_task(spark, name):
    text = plan(entry.queries()[name](spark, SF_DIR))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "Exchange SinglePartition"):
        assert operator not in text


def test_scan_reads_only_what_is_needed(spark):
    text = plan(entry.queries()["country_category_revenue"](spark, SF_DIR))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double,l_extendedprice:double>" in text
    assert "ReadSchema: struct<p_partkey:bigint,p_type:string>" in text
    assert "IsNotNull(l_orderkey)" in text


@pytest.fixture
def without_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))


def test_products_are_pre_aggregated_before_the_shuffle(spark, without_broadcast):
    text = plan(entry.queries()["gold_category_performance"](spark, SF_DIR), "simple")
    below = text[text.index("SortMergeJoin"):]
    # Read from the join down: the items' exchange carries sums per product, not items.
    items = next(part for part in below.split("Exchange hashpartitioning")[1:] if "l_partkey" in part)
    assert "HashAggregate(keys=[product_id" in items and "partial_sum" in items


def test_a_small_source_leaves_the_target_in_place(spark):
    target = conform.order_items(spark, SF_DIR)
    source = conform.orders(spark, SF_DIR)
    text = plan(seen_keys(target, source, ["order_id"]), "simple")
    assert "SortMergeJoin" not in text
    # The target's first shuffle is above the semi join, so it moves matching keys only.
    assert text.index("Exchange hashpartitioning") < text.index("BroadcastHashJoin")


def test_a_large_source_meets_distinct_target_keys(spark, without_broadcast):
    target = conform.order_items(spark, SF_DIR)
    source = conform.orders(spark, SF_DIR)
    text = plan(seen_keys(target, source, ["order_id"]), "simple")
    above, below = text.split("SortMergeJoin")
    assert "HashAggregate" not in above
    assert below.count("HashAggregate") == 4  # partial and final on either side


@pytest.fixture
def small_partitions(spark, without_broadcast):
    """Adaptive thresholds scaled down to the test tables."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    old = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in old.items():
        spark.conf.set(name, value)


def a_third_on(column, value):
    return F.when(F.col(column) % 3 == 0, value).otherwise(F.col(column)).alias(column)


def test_hot_order_is_split_over_tasks(spark, small_partitions):
    """A third of all items on one order: adaptive execution must split its partition."""
    items = conform.order_items(spark, SF_DIR).repartition(8)
    result = report.country_category_revenue(
        items.withColumn("order_id", a_third_on("order_id", 7)),
        conform.orders(spark, SF_DIR),
        conform.customers(spark, SF_DIR),
        conform.products(spark, SF_DIR),
    )
    result.collect()
    assert "SortMergeJoin(skew=true)" in plan(result, "simple")


def test_hot_product_is_split_over_tasks(spark, small_partitions):
    items = conform.order_items(spark, SF_DIR).repartition(8)
    result = report.country_category_revenue(
        items.withColumn("product_id", a_third_on("product_id", 7)),
        conform.orders(spark, SF_DIR),
        conform.customers(spark, SF_DIR),
        conform.products(spark, SF_DIR),
    )
    result.collect()
    assert "SortMergeJoin(skew=true)" in plan(result, "simple")


def test_hot_target_key_is_split_over_tasks(spark, small_partitions):
    target = conform.order_items(spark, SF_DIR).repartition(8).select(
        a_third_on("order_id", 7).alias("k"), F.col("order_item_id").alias("v")
    )
    source = conform.orders(spark, SF_DIR).select(F.col("order_id").alias("k"), F.col("status").alias("v"))
    merged = merge_upsert(target, source, MergeSpec("k", ("v",)), MergePlan.HOT_TARGET)
    merged.collect()
    assert "SortMergeJoin(skew=true)" in plan(merged, "simple")


def test_upsert_looks_a_table_up_in_one_scan(spark, without_broadcast, namespace):
    """One scan of key and folder, cut to the batch's range in the file; one exchange of its rows."""
    table = create_table(spark, namespace, tables.ORDERS)
    orders = landing_orders(spark, SF_DIR).withColumn("order_day", F.to_date("order_date"))
    orders = orders.withColumn("order_id", F.col("order_id").cast("string"))
    upsert(spark, table, orders, tables.ORDERS)
    batch = orders.filter(F.col("order_id").between("200", "299")).withColumn("status", F.lit("x"))
    merge = PartitionMerge(spark, table, batch, tables.ORDERS)
    text = plan(merge.lookup(spark.table(table), whole_rows=False))
    scans = [part for part in text.split("\n\n") if "Scan parquet" in part and "__default" not in part]
    of_table = [part for part in scans if "order_day" in part and "Batched" in part and "PushedFilters" in part and namespace in part]
    assert len(of_table) == 1
    assert "GreaterThanOrEqual(order_id,2" in of_table[0] and "LessThanOrEqual(order_id,299)" in of_table[0]
    assert "ReadSchema: struct<order_id:string>" in of_table[0]
    assert "SortMergeJoin" in text and text.count("BroadcastExchange\n") == 1  # the words of the filter
    assert merge.matched.count() == batch.count() > 0


def test_copartitioned_lines_meet_their_orders_without_an_exchange(spark, without_broadcast):
    lines = plan(entry.queries()["country_category_copartitioned"](spark, SF_DIR), "simple").split("\n")
    (start,) = [n for n, line in enumerate(lines) if "SortMergeJoin [order_id" in line]
    depth = lines[start].index("SortMergeJoin")
    below = [line for line in lines[start + 1 :] if line.strip()]
    own = below[: next((n for n, line in enumerate(below) if len(line) - len(line.lstrip(" :+-")) <= depth), len(below))]
    assert sum("Bucketed: true" in line for line in own) == 2
    assert not any("Exchange" in line for line in own)


def test_profile_reads_footers_only(spark):
    paths = {name: f"{SF_DIR}/{name}.parquet" for name in ("orders", "documents")}
    with configured(spark, report.FROM_FOOTERS):
        text = plan(report._counted_files(spark, paths, {}))
    assert text.count("PushedAggregation: [COUNT(*)]") == 2
    assert "ReadSchema: struct<count(*):bigint>" in text
    assert rows(report.profile_files(spark, paths)) == [
        (name, spark.read.parquet(path).count(), len(spark.read.parquet(path).columns)) for name, path in sorted(paths.items())
    ]
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""


def test_staged_frames_leave_no_shuffle_files(spark, tmp_path):
    import glob

    shuffled = spark.range(200_000).repartition(5, "id")
    count = lambda: len(glob.glob(f"{spark.conf.get('spark.local.dir', '/tmp')}/blockmgr-*/*/shuffle_*"))
    before = count()
    frame = staged(shuffled)
    assert count() == before
    assert frame.count() == 200_000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"


def test_key_filter_keeps_all_and_drops_most(spark):
    every = spark.range(200_000).select(F.col("id").cast("string").alias("k"))
    batch = every.filter("cast(k as int) % 40 = 0")
    for source in (batch, batch.limit(1), spark.createDataFrame([("7",), (None,)], "k string")):
        asked = key_filter(source, "k")
        passed = asked.applied(every)
        assert source.dropna().join(passed, "k", "left_anti").isEmpty()
        assert passed.count() < 1.5 * source.count() + 0.03 * every.count()
    assert key_filter(batch.filter("false"), "k") is None
    bare = KeyFilter("k", "0", "~", None, 0)
    assert bare.applied(every).count() == every.count()


def test_merge_result_is_the_same_without_broadcast(spark, without_broadcast):
    target = spark.range(0, 300).select(F.col("id").alias("k"), F.lit(0).alias("v"))
    source = spark.range(200, 400).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    for how in MergePlan:
        merged = merge_upsert(target, source, MergeSpec("k", ("v",)), how)
        assert rows(merged.groupBy("v").count()) == [(0, 200), (1, 200)]
