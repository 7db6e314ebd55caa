"""Words made to collide, other tokenizer files, and pipeline stages on awkward rows."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from sediment.llm import bpe, common, minhash, packing, pii, quality, queries, recompression
from tests.conftest import SF_DIR
from tests.llm import brute


def thue_morse(bits, a, b):
    """2 ** bits symbols; the word and the one with a and b exchanged agree under any sum of
    powers modulo 2 ** 64."""
    text = a
    for _ in range(bits):
        text += text.translate(str.maketrans(a + b, b + a))
    return text


ONE, OTHER = thue_morse(11, "a", "b"), thue_morse(11, "b", "a")


def test_hashes_of_words_made_to_collide():
    words = common.split_words([f"{ONE} {OTHER} x".encode(), f"{OTHER} x".encode()])
    assert words.codes.tolist() == [0, 1, 2, 1, 2] and len(set(words.hashes.tolist())) == 3
    assert words.distinct == [ONE.encode(), OTHER.encode(), b"x"]
    hashes = np.array([hash_ for hash_ in words.hashes[:2]])
    order = {"a": 0, "b": 1}
    long = np.concatenate([hashes[[order[c] for c in ONE]], hashes[[order[c] for c in OTHER]]])
    e1, e2 = recompression.stretch_hashes(long, np.array([0, 2048]), np.array([2048, 4096]))
    assert e1[0] != e1[1] and e2[0] != e2[1]


def documents(spark, rows, extra=()):
    """Rows (doc_id, text) as documents, with extra columns."""
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text").cast("long")}
    )
    return df.withColumns({name: F.lit(7) for name in extra}).repartition(2)


@pytest.fixture(scope="module")
def colliding(spark):
    own, other = (" ".join([word] + [f"w{i}" for i in range(60)] + [word] * 60) for word in (ONE, OTHER))
    return {1: f"{ONE} tail", 2: f"{OTHER} tail", 3: own, 4: other, 5: " ".join([ONE] * 60), 6: " ".join([OTHER] * 60)}


def test_operators_keep_words_made_to_collide_apart(spark, colliding):
    docs = documents(spark, list(colliding.items()))
    counts = {r["doc_id"]: r for r in quality.rule_statistics(docs).collect()}
    for doc_id, text in colliding.items():
        own = tuple(counts[doc_id][c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
        assert own == brute.statistics(text)
    linked = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(docs).collect()}
    assert linked == brute.near_duplicates(colliding)
    kept = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_text"]) for r in recompression.substring_dedup(docs).collect()}
    assert kept == brute.substring_dedup(colliding)
    for file in (queries.WORD_BPE, queries.BYTE_BPE):
        library = Tokenizer.from_file(file)
        library.no_truncation()
        library.no_padding()
        for row in bpe.encoded(docs, file).collect():
            ids = library.encode(colliding[row["doc_id"]], add_special_tokens=False).ids
            assert np.frombuffer(row["ids"], "<u4").tolist() == ids
            assert row["decoded"] == library.decode(ids, skip_special_tokens=False)
    library = Tokenizer.from_file(queries.BYTE_BPE)
    pieces = packing.best_fit_packing(docs, queries.BYTE_BPE).orderBy("doc_id", "piece").collect()
    for doc_id, text in colliding.items():
        ids = [i for r in pieces if r["doc_id"] == doc_id for i in np.frombuffer(r["ids"], "<u4").tolist()]
        assert ids[:-1] == library.encode(text, add_special_tokens=False).ids


def test_a_file_of_another_kind_is_left_to_the_library(spark):
    import json

    word, byte = (json.load(open(file)) for file in (queries.WORD_BPE, queries.BYTE_BPE))
    assert bpe.fits(word) and not bpe.fits(byte)
    assert not bpe.fits({**word, "normalizer": None}) and not bpe.fits({**word, "decoder": byte["decoder"]})
    texts = {1: "It's  naïve <|endoftext|>\n\tx", 2: None, 3: "", 4: "日本 🙂 é"}
    library = Tokenizer.from_file(queries.BYTE_BPE)
    for row in bpe.encoded(documents(spark, list(texts.items())), queries.BYTE_BPE).collect():
        ids = library.encode(texts[row["doc_id"]] or "", add_special_tokens=False).ids
        assert np.frombuffer(row["ids"], "<u4").tolist() == ids
        assert row["decoded"] == library.decode(ids, skip_special_tokens=False)


def prose(seed, n=120):
    made = np.random.default_rng(seed)
    return " ".join("".join(made.choice(list("abcdeio"), made.integers(2, 7))) for _ in range(n))


GOOD, SECOND, SHORT = prose(1), prose(2), "two words"
NEAR = GOOD.replace(GOOD.split()[60], "changed", 1)
LINE = "a line of text that several documents share"
CLASHING = ("kept_id", "carried", "kept_text", "row", "node", "group", "scores", "__x", "n_words", "spans", "ids")
ROWS = [
    (1, GOOD), (1, SHORT), (1, GOOD), (None, GOOD), (None, SHORT), (None, None), (2, NEAR), (3, None), (4, ""), (4, ""),
    (5, SECOND), (5, GOOD), (6, f"{LINE}\n{SECOND} {prose(3)}"), (7, f"{prose(4)}\n{LINE}"), (-1, f"{LINE}\n{prose(5)}"),
]


def held(df):
    assert df.columns == list(corpus_pipeline.COLUMNS)
    rows = df.collect()
    assert all(r["text"] is None or r["n_chars"] == len(r["text"]) for r in rows)
    return Counter((r["doc_id"], r["text"]) for r in rows)


@pytest.fixture(scope="module")
def awkward(spark):
    return documents(spark, ROWS, CLASHING)


def test_quality_stage_judges_rows(spark, awkward):
    """Also under a shared or null id a short text goes and a good one stays."""
    failed = lambda text: (s := brute.statistics(text))[0] < 50 or 100 * s[4] > 50 * s[0]
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").limit(0)
    found = Counter((r["doc_id"], r["text"]) for r in quality.kept_rows(awkward.select(*corpus_pipeline.COLUMNS), labels).collect())
    assert found == Counter(row for row in ROWS if not failed(row[1]))
    assert not held(corpus_pipeline.quality_rules(spark, awkward, SF_DIR)) - found


def test_rows_are_judged_again_as_before(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    kept = {r["doc_id"] for r in quality.judged(docs, labels).filter("kept").collect()}
    assert {r["doc_id"] for r in quality.kept_rows(docs, labels).collect()} == kept
    assert quality.kept_rows(docs, labels).columns == docs.columns


def test_quality_stage_shuffles_no_text(spark):
    from tests.conftest import plan

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert "Exchange" not in plan(corpus_pipeline.quality_rules(spark, docs, SF_DIR), "simple")


def test_line_stage(spark, awkward):
    found = held(corpus_pipeline.line_dedup_stage(spark, awkward, SF_DIR))
    assert sum(found.values()) == len(ROWS)
    assert [t for (k, t) in found if k == -1] == [f"{LINE}\n{prose(5)}"]
    assert [t for (k, t) in found if k == 7] == [prose(4)] and [t for (k, t) in found if k == 3] == [""]
    assert found[(None, GOOD)] == 1 and found[(1, GOOD)] == 2 and found[(5, GOOD)] == 0


def test_near_stage_keeps_one_row_of_each_group(spark, awkward):
    found = held(corpus_pipeline.near_dedup(spark, awkward, SF_DIR))
    alone = [row for row in ROWS if row[0] is None or not brute.words(row[1])]
    # (1, GOOD) twice, (2, NEAR), (5, GOOD) are one group; (1, SHORT) and (5, SECOND) stand alone.
    assert found == Counter([*alone, (1, GOOD), (1, SHORT), (5, SECOND), *[row for row in ROWS if row[0] in (6, 7, -1)]])


def test_near_stage_with_rows_that_differ_elsewhere_only(spark):
    docs = documents(spark, [(1, GOOD)]).unionAll(documents(spark, [(1, GOOD)]).withColumn("source", F.lit("a")))
    rows = corpus_pipeline.near_dedup(spark, docs, SF_DIR).collect()
    assert [(r["doc_id"], r["source"]) for r in rows] == [(1, "a")]


def test_personal_data_and_packing_stages(spark, awkward):
    with_number = awkward.withColumn("text", F.concat("text", F.lit(" call +1 (017) 555-7713")))
    found = held(corpus_pipeline.personal_data(spark, with_number, SF_DIR))
    assert sum(found.values()) == len(ROWS) and not any("555-7713" in (t or "") for _, t in found)
    pieces = corpus_pipeline.best_fit_packing(spark, awkward, SF_DIR).collect()
    assert sum(r["piece"] == 0 for r in pieces) == len(ROWS)
    assert len({(r["sequence_id"], r["offset"]) for r in pieces}) == len(pieces)


def test_empty_tables(spark, awkward):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, awkward.limit(0), SF_DIR).collect() == [], name


def test_sampled_rows_do_not_depend_on_partitions(spark):
    rows = [(i, *[i % 97 + 60] * 6, False) for i in range(3000)]
    schema = "doc_id long, " + ", ".join(f"{c} long" for c in quality.COUNTS) + ", base_failed boolean"
    df = spark.createDataFrame(rows, schema)
    one, other = (quality.sampled(df.repartition(n), 500) for n in (1, 7))
    assert (one == other).all() and len(one) == 500
    same = spark.createDataFrame([(5, *row[1:]) for row in rows], schema)  # one id holds all rows
    assert len(quality.sampled(same, 500)) <= 500


def test_digest_of_texts_is_the_one_that_spark_computes(spark):
    docs = documents(spark, [(1, "é\x00x"), (2, "")])
    found = {r["doc_id"]: r["row"] for r in minhash.sketches(docs.select("doc_id", "text"), 80).collect()}
    assert found == {1: hashlib.md5("é\x00x".encode()).hexdigest(), 2: hashlib.md5(b"").hexdigest()}
    assert docs.select(F.md5(F.col("text").cast("binary"))).collect()


def test_digits_that_contradict_a_found_number_are_no_repeat(spark):
    """Numbers that end like a found one by chance, beside numbers that are other ways to write it."""
    text = "+1 (017) 555-7713 order 2026-00445557713, ref 88 5557713; 017 555 7713, 555 7713, 0017 5557713, 001 017 555 7713"
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    field = pii.trained(docs.union(spark.createDataFrame([(-1, text)], docs.schema)))
    nodes = pii.candidates(text)
    assert [text[n.start : n.end] for n in nodes][1:3] == ["2026-00445557713", "88 5557713"]
    assert field.labels(nodes) == [3, pii.OTHER, pii.OTHER, 3, 3, 3, 3]
    assert field.against <= -3
    many = "+1 (017) 555-7713" + "; 88 5557713; 017 555 7713" * 40
    assert field.labels(pii.candidates(many)) == [3, *[pii.OTHER, 3] * 40]


@pytest.mark.parametrize(
    "loose, base, same",
    [
        ("0175557713", "10175557713", True), ("5557713", "10175557713", True), ("0301234567", "49301234567", True),
        ("0049301234567", "49301234567", True), ("49301234567", "301234567", True), ("885557713", "10175557713", False),
        ("202649301234567", "49301234567", False), ("20260301234567", "301234567", False), ("", "", True),
    ],
)
def test_ways_to_write_a_number(loose, base, same):
    assert pii.repeats(loose, base) is same


def test_form_letters_are_ruled_out_by_signatures(spark, monkeypatch):
    """Letters of one form, hardly any pair linked: few pairs may reach the full comparison."""
    made = np.random.default_rng(4)
    form, choices = [f"w{i}" for i in range(200)], [f"c{i}" for i in range(4)]
    letters = {}
    for number in range(400):
        own = list(form)
        for slot in range(16):
            own[6 + 12 * slot] = f"{choices[made.integers(4)]}s{slot}"
        letters[number] = " ".join(own)
    counted, verified = [], minhash.verified

    def counting(pairs, sets, percent):
        counted.append(pairs.count())
        return verified(pairs, sets, percent)

    monkeypatch.setattr(minhash, "verified", counting)
    docs = spark.createDataFrame(list(letters.items()), "doc_id long, text string")
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(docs).collect()}
    assert found == brute.near_duplicates(letters)
    assert sum(counted) < 20 * len(letters)


def test_scores_beyond_64_bits_raise(spark):
    from sediment.llm import topk

    far = spark.createDataFrame([(0, [1e300]), (1, [2.0])], "vec_id long, embedding array<double>")
    with pytest.raises(OverflowError):
        topk.top_k(far, F.col("vec_id") == 0)
