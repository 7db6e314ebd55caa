import datetime

from pyspark.sql import functions as F

from sediment.functions.money import sum_lines, sum_money
from sediment.operators import gold, report
from tests.conftest import rows

AT = datetime.datetime
ORDERS = "order_id string, customer_id string, order_date timestamp, total_amount double, status string"
DAY = datetime.date(2026, 6, 10)


def orders(spark, *data):
    return spark.createDataFrame(list(data), ORDERS)


def test_daily_sales_counts(spark):
    df = orders(
        spark,
        ("1", "a", AT(2026, 6, 10, 1), 10.1, "Cancelled"),
        ("2", "a", AT(2026, 6, 10, 23), 20.2, "Shipped"),
        ("3", "b", AT(2026, 6, 10), None, None),
        ("4", "b", AT(2026, 6, 11), 5.0, None),
    )
    run_ts = AT(2026, 6, 12)
    assert rows(gold.daily_sales(df, run_ts)) == [
        (DAY, 30.3, 3, 15.15, 1, run_ts),
        (datetime.date(2026, 6, 11), 5.0, 1, 5.0, 0, run_ts),
    ]


def test_day_without_amounts(spark):
    df = orders(spark, ("1", "a", AT(2026, 6, 10), None, None))
    assert rows(gold.daily_sales(df)) == [(DAY, None, 1, None, 0)]


def test_customer_metrics_keep_known_customers_with_orders(spark):
    df = orders(
        spark,
        ("1", "a", AT(2026, 6, 10), 1.0, "x"),
        ("2", "a", AT(2026, 6, 12), 2.5, "x"),
        ("3", "unknown", AT(2026, 6, 10), 9.0, "x"),
        ("4", None, AT(2026, 6, 10), 9.0, "x"),
    )
    customers = spark.createDataFrame(
        [("a", "A", "a@x", "US"), ("idle", "I", "i@x", "UK"), (None, "N", "n@x", "UK")],
        "customer_id string, name string, email string, country string",
    )
    assert rows(gold.customer_metrics(df, customers)) == [
        ("a", "A", "a@x", "US", 2, 3.5, AT(2026, 6, 10), AT(2026, 6, 12))
    ]


ITEMS = "order_id string, product_id string, quantity int, unit_price double"


def test_category_performance(spark):
    items = spark.createDataFrame(
        [("o", "p", 2, 1.25), ("o", "q", 1, 0.1), ("o", "p", None, 3.0), ("o", "gone", 5, 5.0)], ITEMS
    )
    products = spark.createDataFrame(
        [("p", "tools"), ("q", "toys"), ("q", "toys")], "product_id string, category string"
    )
    # A product listed twice counts twice, as in a plain join.
    assert rows(gold.category_performance(items, products)) == [("tools", 2, 2.5), ("toys", 2, 0.2)]


def test_report_drops_cancelled_and_unknown_status(spark):
    df = orders(
        spark,
        ("1", "a", AT(2026, 6, 10), 1.0, "Shipped"),
        ("2", "a", AT(2026, 6, 10), 1.0, "Cancelled"),
        ("3", "a", AT(2026, 6, 10), 1.0, None),
    )
    items = spark.createDataFrame([(o, "p", 1, 2.0) for o in "123"], ITEMS)
    customers = spark.createDataFrame([("a", "US")], "customer_id string, country string")
    products = spark.createDataFrame([("p", "tools")], "product_id string, category string")
    result = report.country_category_revenue(items, df, customers, products)
    assert rows(result) == [("US", "tools", 1, 2.0)]
    assert rows(report.top_n(result, 5)) == [("US", "tools", 1, 2.0)]


def test_money_is_exact_and_does_not_overflow(spark):
    # 10^6 rows of 10^13: as BIGINT cents the sum would be 10^21.
    big = spark.range(1_000_000).select(F.lit(1e13).alias("m"))
    assert big.agg(sum_money(F.col("m"))).first()[0] == 1e19
    mixed = spark.range(100_001).select(
        F.when(F.col("id") % 2 == 0, F.lit(0.1)).otherwise(F.lit(-0.1)).alias("m")
    )
    assert mixed.agg(sum_money(F.col("m"))).first()[0] == 0.1
    assert spark.createDataFrame([(None,)], "m double").agg(sum_money(F.col("m"))).first()[0] is None


def test_amounts_that_are_not_whole_cents_are_not_rounded(spark):
    def total(*amounts):
        df = spark.createDataFrame([(a,) for a in amounts], "m double")
        return df.agg(sum_money(F.col("m"))).first()[0]

    assert total(0.125, 0.125, 1.1) == 1.35
    assert total(0.001) == 0.001
    assert total(1e300, 1.0) == 1e300
    assert str(total(float("nan"), 1.0)) == "nan"
    assert total(float("inf"), 1.0) == float("inf")

    lines = spark.createDataFrame([(1000, 0.005), (3, 0.1), (2, None), (None, 5.0), (2, 3e7)], "q int, p double")
    assert lines.agg(sum_lines(F.col("q"), F.col("p"))).first()[0] == 6e7 + 5.3


def test_lines_above_any_former_limit_are_exact_in_any_partitioning(spark):
    lines = spark.range(100_000).selectExpr("cast(id % 97 + 1 as int) q", "30000000.0 + id / 100 p")
    expected = sum((i % 97 + 1) * (3_000_000_000 + i) for i in range(100_000)) / 100
    totals = {lines.repartition(n).agg(sum_lines(F.col("q"), F.col("p"))).first()[0] for n in (1, 3, 5, 7)}
    assert totals == {expected}


def test_huge_lines_do_not_overflow(spark):
    many = spark.range(3_000_000).selectExpr("2147483647 q", "21474836.47D p")
    assert many.agg(sum_lines(F.col("q"), F.col("p"))).first()[0] == 3_000_000 * (2**31 - 1) ** 2 / 100
    price = 2**53 - 1
    assert price / 100 * 100 == price
    few = spark.createDataFrame([(2**31 - 1, price / 100), (-(2**31), price / 100), (-7, -0.01)], "q int, p double")
    assert few.agg(sum_lines(F.col("q"), F.col("p"))).first()[0] == (-price + 7) / 100
    assert few.agg(sum_money(F.col("p"))).first()[0] == (2 * price - 1) / 100
