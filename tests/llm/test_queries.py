"""The registered queries: against SQL where there is some, and the pipeline stage by stage."""

import glob
import os

import duckdb
import pytest

import corpus_pipeline
from sediment.llm import minhash, queries
from tests.conftest import SF_DIR
from tests.llm import brute


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        connection.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, oracle, name):
    df = queries.QUERIES[name](spark, SF_DIR)
    cursor = oracle.execute(queries.ORACLES[name])
    names = [column[0] for column in cursor.description]
    expected = sorted(str(tuple(row[names.index(c)] for c in df.columns)) for row in cursor.fetchall())
    assert sorted(str(tuple(row)) for row in df.collect()) == expected and expected


def test_every_dealt_operator_has_a_query():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES) == list(range(1, 14))


def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF_DIR).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        if name == "best_fit_packing":
            break
        assert set(docs.columns) == set(corpus_pipeline.COLUMNS)
        after = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert all(r["n_chars"] == len(r["text"]) for r in docs.collect())
        if name == "quality_rules":
            failed = {k for k, t in before.items() if (s := brute.statistics(t))[0] < 50 or 100 * s[4] > 50 * s[0]}
            assert not failed & after.keys() and len(after) > 0.9 * (len(before) - len(failed)) - 20
        elif name == "line_dedup":
            assert after == {k: kept for k, (_, _, kept) in brute.line_dedup(before).items()}
        elif name == "near_dedup":
            assert set(after) == {k for k, (_, c) in brute.near_duplicates(before).items() if k == c}
        else:
            assert set(after) == set(before) and any(after[k] != before[k] for k in after)
            assert not any(brute.base_spans(text) for text in after.values())
        before = after
    assert {r["doc_id"] for r in docs.select("doc_id").collect()} == set(before)
    assert corpus_pipeline.run(spark, SF_DIR).count() == docs.count()


def test_near_dedup_of_the_pipeline_links_from_four_fifths_on(spark):
    """Four words changed far apart: 176 of 216 shingles, 0.815."""
    own = [f"w{i}" for i in range(200)]
    changed = [f"x{i}" if i in (20, 70, 120, 170) else word for i, word in enumerate(own)]
    texts = {1: " ".join(own), 2: " ".join(changed), 3: " ".join(own[:160])}
    rows = [(k, text, "en", "s", len(text)) for k, text in texts.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, SF_DIR).collect()}
    expected = {k for k, (_, component) in brute.near_duplicates(texts, 80).items() if k == component}
    assert kept == expected == {1, 3}


def test_no_bucket_means_no_component(spark):
    df = spark.createDataFrame([(1, "a b c d e f"), (2, "u v w x y z")], "doc_id long, text string")
    assert sorted(tuple(r) for r in minhash.near_duplicates(df).collect()) == [(1, 2, 1, True), (2, 2, 2, True)]
