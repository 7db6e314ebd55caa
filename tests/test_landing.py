import datetime
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sediment import schemas
from sediment.functions.parsing import parse_timestamp
from sediment.operators.coverage import coverage, gaps, missing
from sediment.sinks.landing import append_payloads, land_days, land_snapshot, quarantine, with_ingest_metadata
from sediment.sinks.staging import staged
from sediment.sources.landing import (
    LANDED,
    is_json_object,
    parse_payloads,
    parse_run_date,
    read_day,
    read_days,
    read_feed,
    read_feed_days,
    read_payloads,
    read_snapshot,
    read_snapshots,
    split_payloads,
)
from sediment.sources.manifest import manifest, manifest_changes
from sediment.sources.rescue import read_rescued, with_rescued
from tests.conftest import plan, rows

DAY = datetime.date(2026, 6, 10)
ORDERS = schemas.ORDERS_FEED


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def orders(spark, *lines):
    typed = "order_id string, customer_id string, order_date timestamp, total_amount double, status string, updated_at timestamp"
    at = datetime.datetime
    return spark.createDataFrame(
        [(i, "c", at(2026, 6, day, 1, 2, 3), 1.5, "Pending", at(2026, 6, day)) for i, day in lines], typed
    )


@pytest.mark.parametrize(
    "text, good",
    [
        ("2026-06-10 01:02:03", True),
        ("2026-06-10", False),
        ("junk", False),
        (None, False),
        ("2026-06-10 24:00:00", False),
        ("2026-6-1 1:2:3", False),
    ],
)
def test_parse_timestamp(spark, text, good):
    df = spark.createDataFrame([(text,)], "t string").select(parse_timestamp(F.col("t")))
    assert df.first()[0] == (datetime.datetime(2026, 6, 10, 1, 2, 3) if good else None)


def test_run_date():
    assert parse_run_date("2026-06-10") == DAY
    with pytest.raises(ValueError):
        parse_run_date("10.06.2026")


def test_wrong_types_and_junk_become_null(spark, tmp_path):
    write(tmp_path / "f.json", '{"q":3,"u":"x"}\nnot json\n{"q":2.7,"u":1}\n{"q":3.0}\n')
    schema = StructType().add("q", "integer").add("u", "double")
    assert rows(read_snapshot(spark, str(tmp_path), schema)) == [
        (None, None),
        (None, None),
        (None, 1.0),
        (3, None),
    ]


def test_day_round_trip_and_pruning(spark, tmp_path):
    landed = orders(spark, ("a", 9), ("b", 10), ("c", 10))
    root = f"{tmp_path}/{ORDERS.path}"
    land_days(landed, root, F.col("order_date"), ORDERS.timestamps)
    assert os.path.isdir(f"{root}/year=2026/month=06/day=09")

    day = read_feed(spark, str(tmp_path), ORDERS, DAY)
    assert day.columns == ORDERS.schema.names
    assert rows(day) == rows(landed.filter("order_id <> 'a'"))

    every = read_days(spark, root, ORDERS.schema)
    assert rows(every.select("order_id", "day")) == [("a", 9), ("b", 10), ("c", 10)]
    assert "PartitionFilters: [isnotnull(day" in plan(every.filter("day = 9"))


def test_day_without_files_is_empty_but_a_missing_feed_is_an_error(spark, tmp_path):
    root = f"{tmp_path}/{ORDERS.path}"
    land_days(orders(spark, ("a", 9)), root, F.col("order_date"), ORDERS.timestamps)
    empty = read_day(spark, root, ORDERS.schema, DAY)
    assert empty.columns == ORDERS.schema.names and empty.isEmpty()
    with pytest.raises(AnalysisException):
        read_day(spark, f"{tmp_path}/nothing", ORDERS.schema, DAY)


def test_landing_a_day_again_replaces_that_day_only(spark, tmp_path):
    root = f"{tmp_path}/{ORDERS.path}"
    land_days(orders(spark, ("a", 9), ("b", 10)), root, F.col("order_date"), ORDERS.timestamps)
    land_days(orders(spark, ("z", 10)), root, F.col("order_date"), ORDERS.timestamps)
    assert rows(read_days(spark, root, ORDERS.schema).select("order_id")) == [("a",), ("z",)]


def test_snapshot_is_replaced(spark, tmp_path):
    path = f"{tmp_path}/{schemas.PRODUCTS_FEED.path}"
    for product in ("old", "new"):
        land_snapshot(spark.createDataFrame([(product,)], "product_id string"), path)
    assert rows(read_feed(spark, str(tmp_path), schemas.PRODUCTS_FEED, DAY).select("product_id")) == [("new",)]


def test_read_mode_follows_the_file_shape(spark, tmp_path):
    write(tmp_path / "lines" / "s.json", '{"a":{"usd":1}}\n{"a":{"usd":2}}\n{"a":{"usd":3}}\n')
    write(tmp_path / "pretty" / "s.json", '{\n  "a": {\n    "usd": 1\n  }\n}')
    assert read_snapshots(spark, str(tmp_path / "lines")).count() == 3
    assert rows(read_snapshots(spark, str(tmp_path / "pretty"), one_object_per_file=True).select("a.usd")) == [(1,)]


OBJECTS = ['{"a":1}', "{}", '{"a":NaN}', '{"a":1,"a":2}', '{"a":"]}"}', ' {"a":{"b":[1]}}\n', '{\n "a": 1\n}']
OTHERS = ["[1,2]", '[{"a":1}]', '"text"', "12", "null", "junk", "", None, "{'a':1}", '{"a":1} x', '{"a":1} {"b":2}', '{"a":1},{"b":2}', '{"a":1}] x', "}", '{"a":', '{"a":tru}', '{"a":1}][{"b":2}', '{"a":1}]junk}', '{"a":1}]}', '{"a":1}] [}', '{"a":1},"y":{"b":2}', '{"a":1}}']


def test_only_json_objects_are_accepted(spark):
    df = spark.createDataFrame([(t,) for t in OBJECTS + OTHERS], "payload string")
    accepted, rejected = split_payloads(df)
    assert rows(accepted) == sorted((t,) for t in OBJECTS)
    assert len(rows(rejected)) == len(OTHERS)
    assert {r[0] for r in df.select(is_json_object(F.col("payload"))).collect()} == {True, False}


def test_payload_files(spark, tmp_path):
    write(tmp_path / "day=01" / "good.json", '{\n "a": 7\n}')
    write(tmp_path / "day=02" / "bad.json", "[1]")
    accepted, rejected = split_payloads(read_payloads(spark, str(tmp_path)))
    assert rows(parse_payloads(accepted, "a INT").select("a")) == [(7,)]
    assert [r.path.rsplit("/", 1)[1] for r in rejected.collect()] == ["bad.json"]


def test_metadata_and_append(spark, tmp_path):
    at = F.lit("2026-06-09 06:30:00").cast("timestamp_ntz")
    for city in ("london", "paris"):
        payload = spark.createDataFrame([(20.5,)], "temperature double")
        append_payloads(with_ingest_metadata(payload, F.lit(city), at, DAY), str(tmp_path / "weather"), at)
    landed = spark.read.json(f"{tmp_path}/weather/year=2026/month=06/day=09")
    assert rows(landed.select("metadata.city", "metadata.ingested_at", "metadata.execution_date", "snapshot_ts")) == [
        ("london", "2026-06-09 06:30:00", "2026-06-10", "20260609T063000Z"),
        ("paris", "2026-06-09 06:30:00", "2026-06-10", "20260609T063000Z"),
    ]


def test_manifest_changes(spark, tmp_path):
    root = tmp_path / "x"
    for name in ("year=2026/month=06/day=09", "year=2026/month=06/day=10", "year=2026/month=06/day=11"):
        write(root / name / "one.json", "1\n2\n2\n")
    before = staged(manifest(spark, str(root)))
    assert {(r.folder, r.rows, r.bytes) for r in before.collect()} == {
        (f"year=2026/month=06/day={day}", 3, 6) for day in ("09", "10", "11")
    }
    assert len({r.digest for r in before.collect()}) == 1
    again = tmp_path / "y"
    write(again / "year=2026/month=06/day=09" / "a.json", "2\n1")  # the same lines in two files
    write(again / "year=2026/month=06/day=09" / "b.json", "2")
    write(again / "year=2026/month=06/day=10" / "one.json", "1\n1\n2\n")  # another multiset of equal size
    write(again / "year=2026/month=06/day=12" / "one.json", "")
    write(again / "plain.json", "é")
    assert rows(manifest_changes(before, manifest(spark, str(again)))) == [
        ("", "added", None, 1),
        ("year=2026/month=06/day=10", "changed", 3, 3),
        ("year=2026/month=06/day=11", "removed", 3, None),
    ]


def test_quarantine_takes_one_job(spark, tmp_path):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(OBJECTS + OTHERS)], "n int, payload string").repartition(3)
    tracker, group = spark.sparkContext.statusTracker(), f"quarantine {tmp_path}"
    spark.sparkContext.setJobGroup(group, "one write")
    try:
        counts = quarantine(df, str(tmp_path / "q"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(tracker.getJobIdsForGroup(group)) <= 2  # the repartition's own stage may be a job of adaptive execution
    assert counts == {"accepted": len(OBJECTS), "rejected": len(OTHERS)}
    landed = spark.read.parquet(str(tmp_path / "q"))
    assert {r["payload"] for r in landed.filter("verdict = 'accepted'").collect()} == set(OBJECTS)
    assert landed.filter("verdict = 'rejected'").count() == len(OTHERS)
    assert quarantine(df.limit(0), str(tmp_path / "none")) == {"accepted": 0, "rejected": 0}


RESCUE = StructType().add("q", "integer").add("u", "double").add("t", "timestamp").add("o", StructType().add("x", "long")).add("a b", "string")


@pytest.mark.parametrize(
    "line, typed, rescued",
    [
        ('{"q":3,"u":1.5,"a b":"x"}', (3, 1.5, None, None, "x"), None),
        ('{"q":"three","u":1}', (None, 1.0, None, None, None), {"q": "three"}),
        ('{"q":2.7,"u":null,"new":{"k":[1,2]}}', (None, None, None, None, None), {"q": "2.7", "new": '{"k":[1,2]}'}),
        ('{"t":"not a time","o":{"x":4}}', (None, None, None, (4,), None), {"t": "not a time"}),
        ('{"o":[1]}', (None, None, None, None, None), {"o": "[1]"}),
        ('{"Q":3}', (None, None, None, None, None), {"Q": "3"}),
        ("{}", (None,) * 5, None),
        ('{"q":3', (None,) * 5, {"_line": '{"q":3'}),
        ('{"q":3} x', (None,) * 5, {"_line": '{"q":3} x'}),
        ('[{"q":3}]', (None,) * 5, {"_line": '[{"q":3}]'}),
        ("12", (None,) * 5, {"_line": "12"}),
        ("é", (None,) * 5, {"_line": "é"}),
    ],
)
def test_rescued_fields(spark, line, typed, rescued):
    df = spark.createDataFrame([(7, line), (8, " \t"), (9, None)], "n int, value string")
    (row,) = with_rescued(df, RESCUE).collect()
    assert row[0] == 7 and tuple(row)[1:-1] == typed and row[-1] == rescued


def test_rescued_rows_equal_the_permissive_reader(spark, tmp_path):
    write(tmp_path / "day=1" / "f.json", '{"q":3,"u":"x"}\nnot json\n\n{"q":2.7,"u":1}\n{"q":3.0}\n')
    schema = StructType().add("q", "integer").add("u", "double")
    found = read_rescued(spark, str(tmp_path), schema)
    assert found.columns == ["day", "q", "u", "rescued"]
    assert rows(found.select("q", "u")) == rows(read_snapshot(spark, str(tmp_path), schema).select("q", "u"))


def test_gaps(spark):
    days = lambda *numbers: [datetime.date(2026, 6, number) for number in numbers]
    landed = [("london", d) for d in days(1, 2, 2, 5, 9, 30)] + [("oslo", d) for d in days(3)] + [(None, days(4)[0]), ("paris", None)]
    expected = spark.createDataFrame([("london",), ("paris",), ("london",)], "city string")
    landed = spark.createDataFrame(landed, "city string, at date")
    first, last = days(1, 10)
    assert rows(gaps(expected, landed, "city", "at", first, last)) == [
        ("london", *days(3, 4), 2),
        ("london", *days(6, 8), 3),
        ("london", *days(10, 10), 1),
        ("paris", *days(1, 10), 10),
    ]
    assert rows(gaps(expected.limit(0), landed, "city", "at", first, last)) == []


def test_days_are_read_together_with_the_day_they_landed_under(spark, tmp_path):
    root = f"{tmp_path}/{ORDERS.path}"
    land_days(orders(spark, ("a", 9), ("b", 10), ("c", 12)), root, F.col("order_date"), ORDERS.timestamps)
    dates = [datetime.date(2026, 6, day) for day in (9, 10, 11)]
    found = read_feed_days(spark, str(tmp_path), ORDERS, dates)
    assert rows(found.select("order_id", LANDED)) == [("a", dates[0]), ("b", dates[1])]
    assert all("day=12" not in path for path in found.inputFiles())
    assert read_feed_days(spark, str(tmp_path), ORDERS, dates[2:]).isEmpty()
    with pytest.raises(AnalysisException):
        read_feed_days(spark, f"{tmp_path}/nothing", ORDERS, dates)


def test_coverage(spark):
    expected = spark.createDataFrame([("london",), ("paris",), ("tokyo",)], "city string")
    landed = spark.createDataFrame([("london",), ("london",), ("oslo",)], "city string")
    assert rows(missing(expected, landed, "city")) == [("paris",), ("tokyo",)]
    assert rows(coverage(expected, landed, "city")) == [(3, 1, 2)]


def test_landed_lines_are_compressed_and_few_days_are_not_shuffled(spark, tmp_path):
    from sediment.sinks.landing import _with_day_folders

    landed = orders(spark, ("a", 9), ("b", 10), ("c", 12))
    for gather in (True, False):
        root = str(tmp_path / f"gather={gather}")
        land_days(landed, root, F.col("order_date"), ORDERS.timestamps, gather=gather)
        files = [file for file in (tmp_path / f"gather={gather}").rglob("part-*")]
        assert files and all(file.name.endswith(".json.gz") for file in files)
        assert sorted({r.day for r in read_days(spark, root, ORDERS.schema).select("day").collect()}) == [9, 10, 12]
        exchange = "Exchange" in plan(_with_day_folders(landed, F.col("order_date"), gather))
        assert exchange is gather
    # The day alone decides where a row goes: its folder texts are made after the exchange.
    text = plan(_with_day_folders(landed, F.col("order_date")), "simple")
    assert "date_format" not in text[text.index("Exchange") :]
