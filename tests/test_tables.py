"""Catalog tables, jobs and the stream, on small landed fixtures."""

import datetime
import json
import random
from collections import Counter

import pytest
from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import functions as F

from sediment import schemas
from sediment.operators import gold, report
from sediment.operators.fold import fold_days
from sediment.operators.upsert import MergeConflict, MergeSpec
from sediment.plans import tables
from sediment.plans.jobs import backfill, bronze_to_silver, silver_to_gold, store_prices, stored_days
from sediment.sinks.tables import PartitionMerge, create_or_append, create_table, merge_statement, upsert
from sediment.streaming import incremental
from sediment.streaming.incremental import merge_new_days
from tests.conftest import rows

DAYS = [datetime.date(2026, 6, day) for day in (10, 11, 12)]
AT = datetime.datetime


def write(path, *records):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(json.dumps(r) for r in records))


def folder(day):
    return f"year={day:%Y}/month={day:%m}/day={day:%d}"


def stamp(day, time="00:00:00"):
    return f"{day:%Y-%m-%d} {time}"


def order(number, day, amount, status, ordered=None):
    return {
        "order_id": f"ORD_{number}",
        "customer_id": "CUST_1" if number % 2 else "CUST_2",
        "order_date": stamp(ordered or day, "10:00:00"),
        "total_amount": amount,
        "status": status,
        "updated_at": stamp(day),
    }


def item(number, day, quantity):
    return {
        "order_item_id": f"ORD_{number}_1",
        "order_id": f"ORD_{number}",
        "product_id": f"PROD_{number % 2}",
        "quantity": quantity,
        "unit_price": 2.5,
        "updated_at": stamp(day),
    }


def customer(number, day, country):
    return {
        "customer_id": f"CUST_{number}",
        "name": f"Customer {number}",
        "email": f"c{number}@example.com",
        "country": country,
        "signup_date": stamp(day),
        "updated_at": stamp(day),
    }


def product(number, price):
    return {
        "product_id": f"PROD_{number}",
        "name": "thing",
        "category": "Toys" if number else "Tools",
        "price": price,
        "inventory_count": 3,
        "updated_at": "junk",
    }


@pytest.fixture
def landing(tmp_path):
    root = tmp_path / "landing"
    write(root / schemas.CUSTOMERS_FEED.path, customer(1, DAYS[0], "US"), customer(2, DAYS[0], "UK"))
    write(root / schemas.PRODUCTS_FEED.path, product(0, 1.0), product(1, 2.0))
    orders, items = root / "orders", root / "order_items"
    write(orders / folder(DAYS[0]) / "orders.json", order(1, DAYS[0], 10.0, "Pending"), order(2, DAYS[0], 20.0, "Pending"))
    write(items / folder(DAYS[0]) / "order_items.json", item(1, DAYS[0], 1), item(2, DAYS[0], 2))
    # Day two delivers order 1 again, under another order date, and a new order.
    write(
        orders / folder(DAYS[1]) / "orders.json",
        order(1, DAYS[1], 11.0, "Cancelled", ordered=DAYS[1]),
        order(3, DAYS[1], 30.0, "Pending"),
    )
    write(items / folder(DAYS[1]) / "order_items.json", item(1, DAYS[1], 5), item(3, DAYS[1], 3))
    # Day three has no files.
    return root


def stamped(day):
    return AT.combine(day, datetime.time(6))


def test_backfill(spark, landing, namespace):
    backfill(spark, str(landing), namespace, reversed(DAYS), stamped)
    orders = spark.table(f"{namespace}.orders")
    assert rows(orders.select("order_id", "order_date", "total_amount", "status", "order_day")) == [
        ("ORD_1", AT(2026, 6, 10, 10), 11.0, "Cancelled", DAYS[0]),
        ("ORD_2", AT(2026, 6, 10, 10), 20.0, "Pending", DAYS[0]),
        ("ORD_3", AT(2026, 6, 11, 10), 30.0, "Pending", DAYS[1]),
    ]
    assert rows(spark.table(f"{namespace}.order_items").select("order_item_id", "quantity", "landed_day")) == [
        ("ORD_1_1", 5, DAYS[0]),
        ("ORD_2_1", 2, DAYS[0]),
        ("ORD_3_1", 3, DAYS[1]),
    ]
    last = stamped(DAYS[2])
    assert rows(spark.table(f"{namespace}.gold_daily_sales")) == [
        (DAYS[0], 31.0, 2, 15.5, 1, last),
        (DAYS[1], 30.0, 1, 30.0, 0, last),
    ]
    assert rows(spark.table(f"{namespace}.gold_category_performance")) == [
        ("Tools", 2, 5.0, last),
        ("Toys", 8, 20.0, last),
    ]
    metrics = spark.table(f"{namespace}.gold_customer_metrics")
    assert rows(metrics.select("customer_id", "total_orders", "total_spent")) == [("CUST_1", 2, 41.0), ("CUST_2", 1, 20.0)]
    # Properties: gold of the merged table, and every order counted once.
    daily = gold.daily_sales(orders, last)
    assert rows(daily) == rows(spark.table(f"{namespace}.gold_daily_sales"))
    assert daily.agg(F.sum("orders_count")).first()[0] == orders.count()


def test_changed_days_give_the_same_daily_sales(spark, landing, namespace):
    assert bronze_to_silver(spark, str(landing), namespace, DAYS[0]) == {DAYS[0]}
    silver_to_gold(spark, namespace, stamped(DAYS[0]))
    changed = bronze_to_silver(spark, str(landing), namespace, DAYS[1])
    assert changed == set(DAYS[:2])  # order 1 is matched in its old folder
    silver_to_gold(spark, namespace, stamped(DAYS[1]), order_days=changed)
    sales = spark.table(f"{namespace}.gold_daily_sales")
    full = gold.daily_sales(spark.table(f"{namespace}.orders"))
    assert rows(sales.drop("updated_at")) == rows(full)
    assert bronze_to_silver(spark, str(landing), namespace, DAYS[2]) == set()
    silver_to_gold(spark, namespace, stamped(DAYS[2]), order_days=set())
    found = spark.table(f"{namespace}.gold_daily_sales")
    assert rows(found.drop("updated_at")) == rows(full)
    assert rows(found.select("updated_at").distinct()) == [(stamped(DAYS[1]),)]


def test_running_a_day_again_changes_nothing(spark, landing, namespace):
    for _ in range(2):
        bronze_to_silver(spark, str(landing), namespace, DAYS[0])
        silver_to_gold(spark, namespace, stamped(DAYS[0]))
    assert spark.table(f"{namespace}.orders").count() == 2
    assert spark.table(f"{namespace}.gold_daily_sales").count() == 1


def test_snapshot_change_keeps_the_signup_date(spark, landing, namespace):
    bronze_to_silver(spark, str(landing), namespace, DAYS[0])
    write(landing / schemas.CUSTOMERS_FEED.path, customer(1, DAYS[2], "FR"), customer(3, DAYS[2], "DE"))
    bronze_to_silver(spark, str(landing), namespace, DAYS[2])
    found = spark.table(f"{namespace}.customers").select("customer_id", "country", F.to_date("signup_date"))
    assert rows(found) == [("CUST_1", "FR", DAYS[0]), ("CUST_2", "UK", DAYS[0]), ("CUST_3", "DE", DAYS[2])]
    assert rows(spark.table(f"{namespace}.products").select("updated_at").distinct()) == [(None,)]


def test_missing_feed_stops_before_any_table_changes(spark, tmp_path, namespace):
    write(tmp_path / schemas.CUSTOMERS_FEED.path, customer(1, DAYS[0], "US"))
    write(tmp_path / schemas.PRODUCTS_FEED.path, product(0, 1.0))
    write(tmp_path / "orders" / folder(DAYS[0]) / "orders.json", order(1, DAYS[0], 10.0, "Pending"))
    with pytest.raises(AnalysisException):
        bronze_to_silver(spark, str(tmp_path), namespace, DAYS[0])
    assert rows(report.list_tables(spark, namespace)) == []


def test_upsert_rewrites_touched_days_only(spark, landing, namespace):
    bronze_to_silver(spark, str(landing), namespace, DAYS[0])
    bronze_to_silver(spark, str(landing), namespace, DAYS[1])
    table = f"{namespace}.orders"
    of_day = lambda day: set(spark.table(table).filter(F.col("order_day") == day).inputFiles())
    before = {day: of_day(day) for day in DAYS[:2]}
    source = spark.table(table).filter("order_id = 'ORD_3'").withColumn("status", F.lit("Shipped"))
    upsert(spark, table, source, tables.ORDERS)
    assert of_day(DAYS[0]) == before[DAYS[0]]
    assert not of_day(DAYS[1]) & before[DAYS[1]]
    assert rows(spark.table(table).select("order_id", "status")) == [
        ("ORD_1", "Cancelled"), ("ORD_2", "Pending"), ("ORD_3", "Shipped"),
    ]


def test_rows_without_key_or_day(spark, namespace):
    table = create_table(spark, namespace, tables.ORDERS)
    schema = spark.table(table).schema
    first = [("a", "c", None, 1.0, "x", None, None), (None, None, None, None, None, None, None)]
    upsert(spark, table, spark.createDataFrame(first, schema), tables.ORDERS)
    upsert(spark, table, spark.createDataFrame([("a", "d", AT(2026, 6, 10), 2.0, "y", None, DAYS[0]), first[1]], schema), tables.ORDERS)
    # The matched row stays in the folder without a day; the row without a key is added again.
    assert rows(spark.table(table)) == [first[1], first[1], ("a", "c", None, 2.0, "y", None, None)]


def test_conflict_leaves_the_table_alone(spark, namespace):
    table = create_table(spark, namespace, tables.ORDERS)
    schema = spark.table(table).schema
    row = ("a", "c", AT(2026, 6, 10), 1.0, "x", None, DAYS[0])
    upsert(spark, table, spark.createDataFrame([row], schema), tables.ORDERS)
    with pytest.raises(MergeConflict):
        upsert(spark, table, spark.createDataFrame([row, row], schema), tables.ORDERS)
    assert rows(spark.table(table)) == [row]


def test_stream_equals_backfill_and_sees_each_file_once(spark, landing, namespace, tmp_path):
    def run():
        merge_new_days(
            spark, str(landing), schemas.ORDERS_FEED, namespace, tables.ORDERS, str(tmp_path / "progress")
        ).awaitTermination()
        return rows(spark.table(f"{namespace}.orders").select("order_id", "total_amount", "order_day"))

    both = [("ORD_1", 11.0, DAYS[0]), ("ORD_2", 20.0, DAYS[0]), ("ORD_3", 30.0, DAYS[1])]
    assert run() == both
    assert run() == both
    late = order(4, DAYS[2], 40.0, "Pending", ordered=DAYS[0])
    write(landing / "orders" / folder(DAYS[2]) / "orders.json", order(2, DAYS[2], 21.0, "Shipped"), late)
    grown = [both[0], ("ORD_2", 21.0, DAYS[0]), both[2], ("ORD_4", 40.0, DAYS[0])]
    assert run() == grown
    next_day = DAYS[2] + datetime.timedelta(days=1)
    write(landing / "orders" / folder(next_day) / "orders.json", order(4, next_day, 41.0, "Shipped"))
    assert run() == [*grown[:3], ("ORD_4", 41.0, DAYS[0])]


def test_a_batch_stopped_after_its_upsert_can_be_repeated(spark, landing, namespace, tmp_path, monkeypatch):
    twice = [order(8, DAYS[1], amount, "Pending") for amount in (80.0, 81.0)]
    write(landing / "orders" / folder(DAYS[1]) / "more.json", *twice)
    write(landing / "orders" / folder(DAYS[2]) / "more.json", order(8, DAYS[2], 82.0, "Shipped"))
    calls = []

    def stopped(*arguments):
        upsert(*arguments)
        calls.append(arguments)
        if len(calls) == 1:
            raise RuntimeError("stopped")

    monkeypatch.setattr(incremental, "upsert", stopped)

    def run():
        merge_new_days(
            spark, str(landing), schemas.ORDERS_FEED, namespace, tables.ORDERS, str(tmp_path / "progress")
        ).awaitTermination()

    with pytest.raises(StreamingQueryException):
        run()
    run()
    found = spark.table(f"{namespace}.orders")
    assert rows(found.filter("order_id = 'ORD_8'").select("total_amount")) == [(82.0,), (82.0,)]
    assert found.count() == 5
    assert len(calls) == 2  # three days take one upsert


def test_create_then_append_by_name(spark, namespace):
    table = f"{namespace}.t"
    create_or_append(spark.createDataFrame([(1, "x")], "a int, b string"), table)
    create_or_append(spark.createDataFrame([("y", 2)], "b string, a int"), table)
    assert rows(spark.table(table)) == [(1, "x"), (2, "y")]


def test_all_tables_and_inspection(spark, namespace, capsys):
    for spec in (*tables.SILVER, *tables.GOLD):
        create_table(spark, namespace, spec)
        create_table(spark, namespace, spec)
        found = spark.table(f"{namespace}.{spec.name}")
        assert found.columns[: len(spec.schema)] == spec.schema.names
        assert set(spec.merge.update) < set(spec.schema.names)
    spark.range(3).createOrReplaceTempView("a_temporary_view")
    listed = [name for _, name in rows(report.list_tables(spark, namespace))]
    assert listed == sorted(spec.name for spec in (*tables.SILVER, *tables.GOLD))
    assert namespace in [r[0] for r in report.list_namespaces(spark).collect()]
    report.show_tables(spark, namespace)
    assert "gold_daily_sales" in capsys.readouterr().out


def test_merge_statement_is_valid_sql(spark, namespace):
    """Parquet tables have no MERGE; the statement must be rejected for that reason only."""
    for spec in (*tables.SILVER, *tables.GOLD):
        table = create_table(spark, namespace, spec)
        spark.table(table).createOrReplaceTempView("incoming")
        with pytest.raises(Exception, match="UNSUPPORTED_FEATURE.TABLE_OPERATION"):
            spark.sql(merge_statement(table, "incoming", spec.merge))


def sequential(spark, namespace, days):
    """The table after one upsert per day, or the word that the days conflict."""
    table = create_table(spark, namespace, tables.ORDERS)
    try:
        for _, source in sorted(days.items()):
            upsert(spark, table, source, tables.ORDERS)
    except MergeConflict:
        return "conflict"
    return rows(spark.table(table))


ROW = ["order_id", "customer_id", "order_date", "total_amount", "status", "updated_at", "order_day"]


@pytest.mark.parametrize("seed", range(6))
def test_folded_days_equal_one_upsert_per_day(spark, tmp_path, seed):
    """Random days over few keys; with repeats inside a day (odd seeds) also the conflicts agree."""
    made = random.Random(seed)
    schema = "order_id string, customer_id string, order_date timestamp, total_amount double, status string, updated_at timestamp, order_day date"
    values, names = {}, [f"fold_{seed}_{i}_{tmp_path.name.replace('-', '_')}" for i in range(2)]
    for day in DAYS:
        keys = made.sample("abcdef", 3) + ["a"] * (seed % 2 and made.random() < 0.5) + [None]
        values[day] = [(k, f"{day:%d}", AT(2026, 6, day.day, 10), made.random(), f"s{made.random()}", None, day) for k in keys]
    stored = [(k, "0", AT(2026, 6, 1), 0.5, "old", None, datetime.date(2026, 6, 1)) for k in "xya"[: 2 + (seed == 2)]]
    for name in names:
        spark.sql(f"CREATE NAMESPACE {name} LOCATION '{tmp_path / name}'")
        upsert(spark, create_table(spark, name, tables.ORDERS), spark.createDataFrame(stored, schema), tables.ORDERS)
    one = sequential(spark, names[0], {day: spark.createDataFrame(own, schema) for day, own in values.items()})
    every = spark.createDataFrame([(*row, day) for day, own in values.items() for row in own], f"{schema}, day date")
    try:
        upsert(spark, f"{names[1]}.orders", fold_days(every, "day", tables.ORDERS.merge), tables.ORDERS)
        other = rows(spark.table(f"{names[1]}.orders"))
    except MergeConflict:
        other = "conflict"
    assert one == other


def test_a_key_repeated_after_its_first_day_is_a_conflict(spark):
    schema = "k string, v int, day date"
    merge = MergeSpec("k", ("v",))
    twice_first = [("a", 1, DAYS[0]), ("a", 2, DAYS[0]), ("a", 3, DAYS[2])]
    assert rows(fold_days(spark.createDataFrame(twice_first, schema), "day", merge)) == [("a", 3), ("a", 3)]
    alone = [("a", 1, DAYS[1]), ("a", 2, DAYS[1]), (None, 5, DAYS[0]), (None, 5, DAYS[0])]
    assert rows(fold_days(spark.createDataFrame(alone, schema), "day", merge)) == [(None, 5), (None, 5), ("a", 1), ("a", 2)]
    with pytest.raises(MergeConflict, match="2026-06-12"):
        fold_days(spark.createDataFrame([*alone, ("a", 3, DAYS[2]), ("a", 4, DAYS[2])], schema), "day", merge)
    assert rows(fold_days(spark.createDataFrame([], schema), "day", merge)) == []


def test_images_are_the_difference_that_an_upsert_makes(spark, namespace):
    table = create_table(spark, namespace, tables.ORDERS)
    schema = spark.table(table).schema
    row = lambda key, amount, status="x", day=DAYS[0]: (key, "c", AT(2026, 6, 10), amount, status, None, day)
    upsert(spark, table, spark.createDataFrame([row("a", 1.0), row("b", None), row("c", 3.0, day=DAYS[1])], schema), tables.ORDERS)
    before = spark.table(table).collect()
    source = [row("a", 1.0, "y"), row("b", None), row("d", 4.0, day=None), row(None, 5.0)]
    merge = PartitionMerge(spark, table, spark.createDataFrame(source, schema), tables.ORDERS, whole_rows=True)
    images = merge.images().collect()
    assert merge.apply() == {DAYS[0], None}
    expected = Counter(map(tuple, before))
    for image in images:
        expected[tuple(image)[:-1]] += image["sign"]
    assert Counter(map(tuple, spark.table(table).collect())) == +expected
    assert len(images) == 4  # a: away and back; d and the row without a key: in; b stays


def test_snapshot_rewrites_changed_buckets_only(spark, namespace):
    """One in a hundred rows changes: files of buckets without such a row stay."""
    table = create_table(spark, namespace, tables.CUSTOMERS)
    schema = schemas.SILVER_CUSTOMERS
    people = [(f"C{i}", f"n{i}", f"e{i}", "US", AT(2026, 1, 1), AT(2026, 6, 10)) for i in range(1000)]
    upsert(spark, table, spark.createDataFrame(people, schema), tables.CUSTOMERS)

    def files():
        held = spark.table(table).select("customer_bucket", F.col("_metadata.file_path").alias("file")).distinct()
        return {row[0]: row[1] for row in held.collect()}

    before = files()
    assert len(before) == tables.BUCKETS
    changed = [(k, n, e, "FR" if i % 100 == 7 else c, AT(2026, 2, 2), u) for i, (k, n, e, c, _, u) in enumerate(people)]
    new = ("C1000", "n", None, None, AT(2026, 2, 2), None)
    touched = upsert(spark, table, spark.createDataFrame([*changed, new], schema), tables.CUSTOMERS)
    held = spark.table(table).filter("country = 'FR' or customer_id = 'C1000'").select("customer_bucket").distinct()
    assert touched == {row[0] for row in held.collect()} and len(touched) <= 11
    old_files = {b: f for b, f in before.items() if b not in touched}
    assert old_files.items() <= files().items() and len(old_files) >= tables.BUCKETS - 11
    expected = [(*row[:3], "FR" if i % 100 == 7 else "US", row[4], row[5]) for i, row in enumerate(people)]  # first sign-up stays
    assert rows(spark.table(table).select(schema.names)) == sorted([*expected, new])
    assert upsert(spark, table, spark.createDataFrame([*changed, new], schema), tables.CUSTOMERS) == set()


def test_snapshot_of_repeated_keys(spark, namespace):
    """As in any upsert: inserted while the table lacks them, a conflict or a plain update later."""
    table = create_table(spark, namespace, tables.PRODUCTS)
    schema = schemas.SILVER_PRODUCTS
    row = lambda key, name, price=1.0: (key, name, "c", price, 1, None)
    upsert(spark, table, spark.createDataFrame([row("p", "one"), row("p", "two"), row(None, "x"), row("q", None)], schema), tables.PRODUCTS)
    with pytest.raises(MergeConflict):
        upsert(spark, table, spark.createDataFrame([row("p", "one"), row("p", "three")], schema), tables.PRODUCTS)
    upsert(spark, table, spark.createDataFrame([row("p", "one"), row("q", None)], schema), tables.PRODUCTS)
    found = spark.table(table).select("product_id", "name")
    assert rows(found) == [(None, "x"), ("p", "one"), ("p", "one"), ("q", None)]


def test_prices_are_looked_for_in_the_days_of_the_batch(spark, namespace):
    schema = "coin_id string, price_usd double, timestamp timestamp"
    table, at = f"{namespace}.prices", lambda day: AT(2026, 6, day, 3)
    first = [("a", 1.0, at(1)), ("a", 2.0, at(2)), ("b", None, None), ("a", 9.0, at(2))]
    store_prices(spark.createDataFrame(first, schema), table, by_day=True)
    late = spark.createDataFrame([("a", 7.0, at(1)), ("b", 7.0, at(1)), ("a", 3.0, at(3)), ("b", 5.0, None)], schema)
    days = stored_days(spark, table, late.withColumn("price_day", F.to_date("timestamp")))
    assert all("price_day=2026-06-02" not in path for path in days.inputFiles()) and days.count() == 2
    store_prices(late, table, by_day=True)
    stored = [("a", 1.0, at(1)), ("a", 2.0, at(2)), ("a", 3.0, at(3)), ("b", None, None), ("b", 7.0, at(1))]
    assert rows(spark.table(table).select("coin_id", "price_usd", "timestamp")) == sorted(stored, key=lambda r: (r[0], r[1] is not None, str(r[1])))


def test_upsert_of_nothing(spark, namespace):
    table = create_table(spark, namespace, tables.ORDERS)
    schema = spark.table(table).schema
    assert upsert(spark, table, spark.createDataFrame([], schema), tables.ORDERS) == set()
    assert rows(spark.table(table)) == []


def test_command_line(spark, landing, namespace, capsys):
    from sediment.main import arguments, run

    for argv in (
        ["silver", "--landing", str(landing), "--namespace", namespace, "--date", "2026-06-10"],
        ["gold", "--namespace", namespace],
        ["backfill", "--landing", str(landing), "--namespace", namespace, "--first", "2026-06-11", "--last", "2026-06-12"],
        ["explore", "--namespace", namespace],
    ):
        run(spark, arguments(argv))
    assert "total_revenue" in capsys.readouterr().out
    assert spark.table(f"{namespace}.orders").count() == 3
    with pytest.raises(SystemExit):
        arguments(["silver", "--landing", "x", "--namespace", "y", "--date", "10.06.2026"])


def test_fold_moves_only_keys_that_come_again(spark, monkeypatch):
    """One key of a hundred comes on both days: the rows that are aggregated are its own."""
    from sediment.operators import fold

    schema, merge = "id string, kept string, status string, day date", MergeSpec("id", ("status",))
    days = DAYS[:2]
    first = [(f"k{i}", f"a{i}", "new", days[0]) for i in range(100)]
    later = [("k7", "other", "done", days[1]), (None, "x", "y", days[1])]
    written = []
    original = fold.staged

    def counted(df, *arguments, **named):
        result = original(df, *arguments, **named)
        written.append((result.columns, result.count()))
        return result

    monkeypatch.setattr(fold, "staged", counted)
    result = fold.fold_days(spark.createDataFrame(first + later, schema), "day", merge)
    assert sum(number for columns, number in written if "kept" in columns) == 2  # both rows of k7
    expected = [(key, kept, "done" if key == "k7" else "new") for key, kept, _, _ in first] + [(None, "x", "y")]
    assert rows(result) == sorted(expected, key=lambda t: tuple((v is not None, str(v)) for v in t))


@pytest.mark.parametrize("most", [0, 100])
def test_a_batch_too_large_for_the_filter(spark, namespace, monkeypatch, most):
    """Hashes tell which stored rows it meets; whole rows are shuffled for these alone."""
    from sediment.operators import keys
    from sediment.sinks import tables as sink

    monkeypatch.setattr(keys, "MOST_WORDS", 0)
    monkeypatch.setattr(sink, "MOST_MET", most)
    table = create_table(spark, namespace, tables.ORDERS)
    schema = spark.table(table).schema
    row = lambda key, amount: (key, "c", AT(2026, 6, 10), amount, "x", None, DAYS[0])
    upsert(spark, table, spark.createDataFrame([row(f"k{i}", 1.0) for i in range(50)], schema), tables.ORDERS)
    batch = spark.createDataFrame([row(f"k{i}", 2.0) for i in range(48, 80)], schema)
    merge = PartitionMerge(spark, table, batch, tables.ORDERS, whole_rows=True)
    assert rows(merge.matched.select("order_id")) == [("k48",), ("k49",)]
    far = spark.createDataFrame([row(f"k{i}a", 2.0) for i in range(32)], schema)
    assert PartitionMerge(spark, table, far, tables.ORDERS).matched.isEmpty()
    merge.apply()
    assert spark.table(table).count() == 80 and spark.table(table).filter("total_amount = 2").count() == 32


def test_a_large_batch_of_few_folders_is_appended_without_an_exchange(spark, namespace, monkeypatch):
    from sediment.sinks import tables as sink

    hints = []
    original = type(spark.range(1)).hint
    monkeypatch.setattr(type(spark.range(1)), "hint", lambda df, name, *by: hints.append(name) or original(df, name, *by))
    table = create_table(spark, namespace, tables.ORDERS)
    row = lambda key, day: (key, "c", AT(2026, 6, 10), 1.0, "x", None, day)
    schema = spark.table(table).schema
    batch = lambda start: spark.createDataFrame([row(f"k{start + i}", DAYS[i % 2]) for i in range(20)], schema)
    upsert(spark, table, batch(0), tables.ORDERS)
    assert hints == ["rebalance"]  # few rows: gathered into few files
    monkeypatch.setattr(sink, "MANY_ROWS", 10)
    upsert(spark, table, batch(100), tables.ORDERS)
    assert hints == ["rebalance"]
    assert spark.table(table).groupBy("order_day").count().select("count").collect() == [(20,), (20,)]
