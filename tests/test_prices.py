import datetime

import pytest
from pyspark.sql import functions as F

from sediment.operators import prices
from sediment.plans.jobs import load_prices
from sediment.sources.landing import read_snapshots
from sediment.streaming.incremental import append_new_snapshots
from tests.conftest import plan, rows

EPOCH = 1781049600  # 2026-06-10 00:00:00 UTC
AT = datetime.datetime(2026, 6, 10)


def coin(usd, epoch=EPOCH):
    return f'{{"usd":{usd},"usd_market_cap":10,"usd_24h_vol":5.5,"usd_24h_change":-1.25,"last_updated_at":{epoch}}}'


@pytest.fixture
def landing(tmp_path):
    for day, text in (
        ("09", f'{{"bitcoin":{coin(67000)},"ethereum":{coin(3500.5)}}}\n'),
        ("10", f'{{"bitcoin":{coin(67000)},"solana":{coin(150)}}}\n'),
    ):
        folder = tmp_path / "crypto_data" / "year=2026" / "month=06" / f"day={day}"
        folder.mkdir(parents=True)
        (folder / "snapshot.json").write_text(text)
    return str(tmp_path / "crypto_data")


def test_flatten_inferred(spark, landing):
    flat = prices.flatten(read_snapshots(spark, landing))
    assert flat.columns == [
        "coin_id", "price_usd", "market_cap_usd", "volume_24h_usd", "change_24h_percent", "timestamp",
    ]
    assert flat.count() == 6  # every snapshot gives every coin
    assert rows(flat.filter("price_usd is not null").select("coin_id", "price_usd", "timestamp")) == [
        ("bitcoin", 67000.0, AT),
        ("bitcoin", 67000.0, AT),
        ("ethereum", 3500.5, AT),
        ("solana", 150.0, AT),
    ]
    assert prices.flatten(read_snapshots(spark, landing), drop_empty=True).count() == 4


def test_known_coins_equal_inferred(spark, landing):
    known = prices.snapshot_schema(["bitcoin", "ethereum", "solana"])
    assert rows(prices.flatten(read_snapshots(spark, landing, known))) == rows(
        prices.flatten(read_snapshots(spark, landing))
    )


def test_dedup_keeps_one_row_per_coin_and_time(spark, landing):
    assert prices.dedup(prices.flatten(read_snapshots(spark, landing))).count() == 5


def test_dedup_order_decides_the_survivor(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("a", 1, 3.0), ("a", None, 1.0), ("a", None, 2.0)], "k string, t int, v double")
    assert rows(prices.dedup(df, ["k", "t"])) == [("a", None, 1.0), ("a", 1, 3.0)]
    assert rows(prices.dedup(df, ["k", "t"], [F.desc("v")])) == [("a", None, 2.0), ("a", 1, 5.0)]


def test_a_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 1).alias("k"), (F.col("id") % 1).alias("t"), "id")
    text = plan(prices.dedup(df, ["k", "t"], ["id"]), "simple")
    before_shuffle = text[text.index("Exchange"):]
    assert "WindowGroupLimit" in before_shuffle


def test_missing_field_and_no_coin(spark):
    df = spark.createDataFrame([((1.0,), 2026)], "bitcoin struct<usd: double>, year int")
    assert rows(prices.flatten(df)) == [("bitcoin", 1.0, None, None, None, None)]
    with pytest.raises(ValueError):
        prices.flatten(spark.createDataFrame([(2026,)], "year int"))


def test_flatten_of_wide_is_the_original(spark):
    original = spark.createDataFrame(
        [("a", 1.0, 2.0, 3.0, 4.0, EPOCH), ("b", 5.0, 6.0, 7.0, 8.0, EPOCH + 1)],
        "coin string, usd double, usd_market_cap double, usd_24h_vol double, usd_24h_change double, last_updated_at bigint",
    )
    fields = original.columns[1:]
    wide = original.groupBy(F.monotonically_increasing_id().alias("n")).pivot("coin").agg(F.first(F.struct(*fields)))
    flat = prices.flatten(wide.drop("n"), drop_empty=True)
    expected = original.select("coin", *fields[:-1], F.timestamp_seconds("last_updated_at"))
    assert rows(flat) == rows(expected)


def test_a_value_wins_over_null(spark):
    df = spark.createDataFrame([("a", AT, None), ("a", AT, 5.0)], "coin_id string, timestamp timestamp, price double")
    assert rows(prices.dedup(df)) == [("a", AT, 5.0)]


def test_a_struct_without_prices_is_no_coin(spark):
    df = spark.createDataFrame([((1.0,), ("x",))], "bitcoin struct<usd: double>, metadata struct<city: string>")
    assert [row[0] for row in prices.flatten(df).collect()] == ["bitcoin"]
    texts = spark.createDataFrame([('{"bitcoin":{"usd":1},"metadata":{"city":"x"},"n":3}',), ("junk",), (None,)], "value string")
    assert [tuple(row)[:2] for row in prices.flatten_text(texts).collect()] == [("bitcoin", 1.0)]
    assert prices.coins_of(texts) == ["bitcoin"]


def test_unlisted_coins_are_kept(spark, landing, namespace, tmp_path):
    load_prices(spark, landing, f"{namespace}.batch", entities=["bitcoin"])
    append_new_snapshots(spark, landing, f"{namespace}.stream", ["bitcoin"], str(tmp_path / "p")).awaitTermination()
    for name in ("batch", "stream"):
        assert [row[0] for row in rows(spark.table(f"{namespace}.{name}").select("coin_id"))] == ["bitcoin", "ethereum", "solana"]


def test_null_timestamp_is_not_appended_twice(spark):
    schema = "coin_id string, timestamp timestamp, price double"
    stored = spark.createDataFrame([("a", None, 1.0), ("a", AT, 1.0)], schema)
    batch = spark.createDataFrame([("a", None, 2.0), ("a", AT, 2.0), ("b", None, 2.0)], schema)
    assert rows(prices.not_yet_stored(batch, stored)) == [("b", None, 2.0)]


def test_price_job_can_be_repeated(spark, landing, namespace):
    table = f"{namespace}.crypto_prices"
    for _ in range(2):
        load_prices(spark, landing, table)
    assert spark.table(table).count() == 5
    load_prices(spark, landing, table, entities=["bitcoin", "ethereum", "solana"], skip_stored=False)
    assert spark.table(table).count() == 10


def test_price_stream_reads_each_file_once(spark, landing, namespace, tmp_path):
    table = f"{namespace}.crypto_prices"

    def run():
        append_new_snapshots(
            spark, landing, table, ["bitcoin", "ethereum", "solana"], str(tmp_path / "progress")
        ).awaitTermination()
        return rows(spark.table(table).select("coin_id", "price_usd", "timestamp"))

    first = run()
    assert len(first) == 5
    assert run() == first
    folder = tmp_path / "crypto_data" / "year=2026" / "month=06" / "day=11"
    folder.mkdir()
    (folder / "snapshot.json").write_text(f'{{"bitcoin":{coin(70000, EPOCH + 60)},"solana":{coin(150)}}}\n')
    assert run() == rows(
        spark.createDataFrame(
            [*first, ("bitcoin", 70000.0, AT + datetime.timedelta(minutes=1))],
            "coin_id string, price_usd double, timestamp timestamp",
        )
    )
