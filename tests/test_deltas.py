"""Gold by signed changes: equal to a full computation, whatever fails and whatever the amounts."""


import pytest

from sediment.operators import gold
from sediment.plans import deltas, tables
from sediment.plans.deltas import run_by_deltas
from tests.conftest import rows
from tests.test_tables import AT, DAYS, folder, item, landing, order, stamped, write  # noqa: F401

GOLD = [spec.name for spec in tables.GOLD]


def full(spark, namespace, run_ts=None):
    """The gold tables computed from silver."""
    orders, items, customers, products = (
        spark.table(f"{namespace}.{name}") for name in ("orders", "order_items", "customers", "products")
    )
    return {
        "gold_daily_sales": rows(gold.daily_sales(orders, run_ts)),
        "gold_customer_metrics": rows(gold.customer_metrics(orders, customers, run_ts)),
        "gold_category_performance": rows(gold.category_performance(items, products, run_ts)),
    }


def stored(spark, namespace):
    return {name: rows(spark.table(f"{namespace}.{name}")) for name in GOLD}


def run(spark, landing, namespace, *days):
    run_by_deltas(spark, str(landing), namespace, days, stamped(days[-1]))


def test_runs_equal_a_full_computation(spark, landing, namespace):  # noqa: F811
    for day in DAYS:
        run(spark, landing, namespace, day)
        assert stored(spark, namespace) == full(spark, namespace, stamped(day))
    changes = spark.read.parquet(f"{deltas.namespace_location(spark, namespace)}/__images/2026-06-11/orders")
    assert rows(changes.select("order_id", "status", "sign")) == [
        ("ORD_1", "Cancelled", 1), ("ORD_1", "Pending", -1), ("ORD_3", "Pending", 1),
    ]


def test_several_days_in_one_run(spark, landing, namespace):  # noqa: F811
    run(spark, landing, namespace, *DAYS)
    assert stored(spark, namespace) == full(spark, namespace, stamped(DAYS[-1]))
    assert spark.table(f"{namespace}.orders").count() == 3


def test_amounts_that_are_not_whole_cents_or_absent(spark, landing, namespace):  # noqa: F811
    odd = [order(4, DAYS[0], 0.125, "Pending"), order(5, DAYS[0], None, "Pending"), order(6, DAYS[0], 1e17, "x")]
    write(landing / "orders" / folder(DAYS[0]) / "odd.json", *odd)
    write(landing / "order_items" / folder(DAYS[0]) / "odd.json", {**item(4, DAYS[0], 3), "unit_price": 0.375}, item(5, DAYS[0], None))
    run(spark, landing, namespace, DAYS[0])
    assert stored(spark, namespace) == full(spark, namespace, stamped(DAYS[0]))
    changed = [order(4, DAYS[1], 7.0, "Pending"), order(5, DAYS[1], 2.5, "Cancelled"), order(6, DAYS[1], None, "x")]
    write(landing / "orders" / folder(DAYS[1]) / "odd.json", *changed)
    write(landing / "order_items" / folder(DAYS[1]) / "odd.json", {**item(4, DAYS[1], None), "unit_price": 0.5}, item(5, DAYS[1], 2))
    run(spark, landing, namespace, DAYS[1])
    assert stored(spark, namespace) == full(spark, namespace, stamped(DAYS[1]))


def test_orders_without_customer_or_day(spark, landing, namespace):  # noqa: F811
    bare = {**order(7, DAYS[0], 3.0, "Pending"), "customer_id": None, "order_date": "junk"}
    write(landing / "orders" / folder(DAYS[0]) / "bare.json", bare, {**bare, "order_id": None})
    write(landing / "order_items" / folder(DAYS[0]) / "bare.json", {**item(7, DAYS[0], 1), "product_id": None})
    for day in DAYS[:2]:
        run(spark, landing, namespace, day)
        found, wanted = stored(spark, namespace), full(spark, namespace, stamped(day))
        # A gold row without a key is inserted again by every run, as by any upsert.
        assert found["gold_daily_sales"][0][:-1] == wanted["gold_daily_sales"][0][:-1] == (None, 6.0, 1, 3.0, 0)
        for tables_rows in (found, wanted):
            tables_rows["gold_daily_sales"] = [row for row in tables_rows["gold_daily_sales"] if row[0]]
        assert found == wanted


@pytest.mark.parametrize("broken", ["noted_images", "add_to_parts", "gold_from_parts", "replace_table", "upsert"])
def test_a_run_that_stopped_can_be_repeated(spark, landing, namespace, monkeypatch, broken):  # noqa: F811
    run(spark, landing, namespace, DAYS[0])
    original, calls = getattr(deltas, broken), []

    def stopped(*arguments, **named):
        calls.append(1)
        if len(calls) == (2 if broken in ("replace_table", "upsert") else 1):
            raise RuntimeError("stopped")
        return original(*arguments, **named)

    monkeypatch.setattr(deltas, broken, stopped)
    with pytest.raises(RuntimeError):
        run(spark, landing, namespace, DAYS[1])
    monkeypatch.setattr(deltas, broken, original)
    run(spark, landing, namespace, DAYS[1])
    assert stored(spark, namespace) == full(spark, namespace, stamped(DAYS[1]))
    run(spark, landing, namespace, DAYS[1])
    assert stored(spark, namespace) == full(spark, namespace, stamped(DAYS[1]))


def test_a_run_stopped_between_its_tables(spark, landing, namespace, monkeypatch):  # noqa: F811
    """Silver orders are merged, items are not: the noted images must still count once."""
    run(spark, landing, namespace, DAYS[0])
    apply, calls = deltas.PartitionMerge.apply, []

    def stopped(merge):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("stopped")
        return apply(merge)

    monkeypatch.setattr(deltas.PartitionMerge, "apply", stopped)
    with pytest.raises(RuntimeError):
        run(spark, landing, namespace, DAYS[1])
    monkeypatch.setattr(deltas.PartitionMerge, "apply", apply)
    run(spark, landing, namespace, DAYS[1])
    assert stored(spark, namespace) == full(spark, namespace, stamped(DAYS[1]))


def test_tables_that_were_filled_without_parts(spark, landing, namespace):  # noqa: F811
    from sediment.plans.jobs import bronze_to_silver

    bronze_to_silver(spark, str(landing), namespace, DAYS[0])
    run(spark, landing, namespace, DAYS[1])
    assert stored(spark, namespace) == full(spark, namespace, stamped(DAYS[1]))


def test_removed_extremes_are_computed_anew(spark):
    """The upsert keeps customer and date; other images may take the first order of a customer away."""
    from sediment.operators import parts

    schema = "order_id string, customer_id string, order_date timestamp, total_amount double, status string"
    at = lambda day: AT(2026, 6, day)
    orders = [("a", "c", at(1), 1.0, "x"), ("b", "c", at(2), 2.0, "x"), ("d", "e", at(1), 3.0, "x"), ("f", "e", at(1), 4.0, "x")]
    known = parts.customer_parts(spark.createDataFrame(orders, schema))
    gone = spark.createDataFrame([(*orders[0], -1), (*orders[2], -1)], f"{schema}, sign int")
    assert rows(parts.date_removed(gone, known, "sign")) == [("c",), ("e",)]
    left = spark.createDataFrame([orders[1], orders[3]], schema)
    groups = parts.date_removed(gone, known, "sign")
    anew = deltas._of_groups(left, groups, "customer_id", parts.customer_parts)
    result = parts.merged(known, parts.customer_parts(gone, "sign"), "customer_id", anew)
    assert rows(result) == rows(parts.customer_parts(left))
    none_left = deltas._of_groups(left.limit(0), groups, "customer_id", parts.customer_parts)
    assert rows(parts.merged(known, parts.customer_parts(gone, "sign"), "customer_id", none_left)) == []


def test_parts_are_updated_without_a_scan_of_the_silver_tables(spark, landing, namespace, monkeypatch):  # noqa: F811
    run(spark, landing, namespace, DAYS[0])
    plans, original = {}, deltas.replace_table

    def noted(df, table, mark=""):
        plans[table.rsplit(".", 1)[1]] = df.inputFiles()
        original(df, table, mark)

    monkeypatch.setattr(deltas, "replace_table", noted)
    run(spark, landing, namespace, DAYS[1])
    assert set(plans) == {spec.name for spec in (tables.DAILY_PARTS, tables.CUSTOMER_PARTS, tables.PRODUCT_PARTS)}
    for name, files in plans.items():
        assert files and all(f"/{name}/" in path or "/__images/" in path for path in files)


def test_noted_images_hold_what_the_parts_need(spark, namespace, tmp_path):
    """The long item id is not written again; the parts come out of the columns that are."""
    from types import SimpleNamespace

    from sediment.operators import parts
    from sediment.sinks.tables import create_table

    table = create_table(spark, namespace, tables.ORDER_ITEMS)
    item_row = ("1_1", "1", "p", 2, 1.5, AT(2026, 6, 10), DAYS[0], 1)
    images = spark.createDataFrame([item_row], spark.table(table).schema.add("sign", "integer"))
    merge = SimpleNamespace(spark=spark, table=table, images=lambda: images)
    noted = deltas.noted_images(spark, str(tmp_path / "images"), {tables.ORDER_ITEMS.name: merge})["order_items"]
    assert noted.columns == ["product_id", "quantity", "unit_price", "sign"]
    assert rows(parts.product_parts(noted, "sign")) == rows(parts.product_parts(images, "sign"))
