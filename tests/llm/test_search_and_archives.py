import io
import zlib

import numpy as np
import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from sediment.llm import topk, warc

SCHEMA = "vec_id long, embedding array<float>, score string, block string"


def exact(rows, k):
    vectors = {}
    for vec_id, v in rows:
        if vec_id is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            vectors[vec_id] = [int(np.floor(1024 * float(np.float32(x)))) for x in v]
    found = []
    for q in (i for i in vectors if i % 5 == 0):
        scores = [(-sum(a * b for a, b in zip(vectors[q], v)), i) for i, v in vectors.items() if i != q and len(v) == len(vectors[q])]
        found += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(found)


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=6).round(2).tolist()) for i in range(150)]
    rows += [(200 + i, rows[3][1]) for i in range(30)]  # ties
    rows += [(300, None), (305, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (310, [float("nan")] * 6), (315, [float("inf")] * 6)]
    rows += [(None, rows[0][1]), (320, [0.0] * 6), (325, [1.0, 2.0]), (326, [3.0, 4.0]), (330, [])]
    df = spark.createDataFrame([(*row, "x", "y") for row in rows + [rows[3]]], SCHEMA)
    found = topk.top_k(df, F.col("vec_id") % 5 == 0, k=7, block_rows=40, query_rows=10)
    assert sorted(tuple(row) for row in found.collect()) == exact(rows, 7)
    assert topk.top_k(df.filter("false"), F.col("vec_id") % 5 == 0).collect() == []


def test_search_stops_early_on_one_long_list():
    vectors = np.zeros((1000, 2))
    vectors[:, 0] = np.arange(1000)
    lists = topk.SortedLists(np.arange(1000), vectors)
    met = []
    lists.vectors = type("Seen", (), {"__getitem__": lambda _, i: met.append(np.size(i)) or vectors[i], "shape": vectors.shape})()
    ids, _ = lists.best(-1, np.array([1.0, 0.0]), 5)
    assert sorted(ids.tolist()) == [995, 996, 997, 998, 999] and sum(met) < 200


PAGES = [
    (1, "http://a/ x\r\ny", "<p>" + "a" * 200),
    (5, "http://b", "<p>" + "a" * 200),
    (3, None, "<p>" + "a" * 200),
    (4, "http://d", "short"),
    (6, "http://e", "short"),
    (7, "http://f", None),
    (8, "http://g", ""),
    (9, "http://h", "é\r\n\r\nWARC/1.1\r\n" * 50_000),
    (None, "http://i", "<p>" + "a" * 200),
    (1, "http://a", "<p>" + "a" * 200),
]


def pages(spark, rows=PAGES):
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    return df.withColumns({"digest": F.lit("x"), "refers_to": F.lit("y"), "payload": F.lit("z")})


def test_round_trip(spark, tmp_path):
    manifest = warc.write_archives(pages(spark), f"file://{tmp_path}/w")
    records = warc.read_archives(manifest, f"file://{tmp_path}/w", with_payload=True).collect()
    responses = {r["page_id"]: bytes(r["payload"]) for r in records if r["record_type"] == "response"}
    assert responses == {i: (html or "").encode() for i, _, html in PAGES if i in (1, 4, 6, 7, 8, 9)}
    found = sorted((r["page_id"] or 0, r["record_type"], r["refers_to"] or 0) for r in warc.archived(pages(spark)).collect())
    assert found == [
        (0, "revisit", 1), (1, "response", 0), (1, "response", 0), (3, "revisit", 1), (4, "response", 0),
        (5, "revisit", 1), (6, "response", 0), (7, "response", 0), (8, "response", 0), (9, "response", 0),
    ]
    assert {r["payload_bytes"] for r in warc.archived(pages(spark)).filter("record_type = 'revisit'").collect()} == {203}
    assert warc.archived(pages(spark, PAGES[:0] or PAGES).filter("false")).collect() == []


def member(payload=b"hello", digest=None):
    digest = digest or __import__("hashlib").sha256(payload).hexdigest()
    return warc.record_bytes(1, "u", payload, digest, None, "1970-01-01T00:00:00Z")


def test_members_are_read_one_by_one():
    data = member(b"x" * 100_000) + member() + member(b"")
    assert [r.payload_bytes for r in warc.read_records(io.BytesIO(data))] == [100_000, 5, 0]
    assert zlib.decompressobj(31).decompress(data).startswith(b"WARC/1.1\r\n")


@pytest.mark.parametrize(
    "data",
    [member()[:-5], member() + member()[:20], member(digest="0" * 64), b"junk", member()[:30] + b"\0" + member()[31:]],
)
def test_damage_is_found(data):
    with pytest.raises(warc.DamagedArchive):
        list(warc.read_records(io.BytesIO(data)))


def test_an_archive_with_too_few_records_is_refused(spark, tmp_path):
    folder = f"file://{tmp_path}/w"
    manifest = warc.write_archives(pages(spark), folder).withColumn("n_records", F.col("n_records") + 1)
    with pytest.raises(PythonException):
        warc.read_archives(manifest, folder).collect()
