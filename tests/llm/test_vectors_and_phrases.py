"""Collocations, near-duplicate vectors and vector codes against plain versions."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sediment.llm import collocations, itq, lloyd

VECTORS = "vec_id long, embedding array<double>, label int"
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


# ---- collocations ----


def plain_collocations(rows, min_count, top, max_words=4):
    counts, n, result = {}, Counter(), []
    for lang, text in rows:
        lang = "und" if lang is None else lang
        own = counts.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            own.update(tuple(words[i : i + k]) for k in range(1, max_words + 1) for i in range(len(words) - k + 1))
    for lang, own in counts.items():
        frequent = {p: a for p, a in own.items() if len(p) > 1 and a >= min_count}
        absorbed = {
            q[i : i + k]
            for q, f in frequent.items()
            for k in range(2, len(q))
            for i in range(len(q) - k + 1)
            if 100 * f >= 80 * own[q[i : i + k]]
        }
        found = []
        for p, a in frequent.items():
            if p not in absorbed:
                cuts = [(own[p[:k]], own[p[k:]]) for k in range(1, len(p))]
                score, _, (l, r) = min((2000000 * a // sum(cut), k, cut) for k, cut in enumerate(cuts))
                found.append((-score, -a, " ".join(p).encode(), l, r))
        result += [
            (lang, i + 1, p.decode(), -a, l, r, n[lang], -score) for i, (score, a, p, l, r) in enumerate(sorted(found)[:top])
        ]
    return sorted(result)


def mined(spark, rows, **options):
    docs = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], "doc_id long, lang string, text string")
    return sorted(map(tuple, collocations.collocations(docs, **options).collect()))


def random_texts(seed, number, words=6, length=60):
    made = np.random.default_rng(seed)
    marks = [" ", " ", " ", "\t", ". ", "!", "\n", "  "]
    return [
        "".join(f"W{made.integers(words)}é" + marks[made.integers(len(marks))] for _ in range(length)) for _ in range(number)
    ]


@pytest.mark.parametrize("seed", range(3))
def test_collocations_equal_a_plain_count(spark, seed):
    rows = [(("en", "de", None, "und")[i % 4], text) for i, text in enumerate(random_texts(seed, 24))]
    assert mined(spark, rows, min_count=3, top=25) == plain_collocations(rows, 3, 25)


def test_collocations_of_awkward_texts(spark):
    rows = [("en", None), (None, None), ("en", ""), ("en", " .,;\t\n"), ("fr", "a b" * 2)] * 2
    rows += [("en", "Zwölf bar, zwölf bar. Zwölf BAR")] * 3 + [("en", "zwölf\x0bbar x")]
    assert mined(spark, rows, min_count=2, top=10) == plain_collocations(rows, 2, 10)
    assert mined(spark, [], min_count=1) == [] == mined(spark, [("en", "one")], min_count=2)


def test_a_long_text_is_cut_between_pieces_only(spark, monkeypatch):
    text = random_texts(7, 1, length=400)[0].encode()
    for limit in (1, 17, 200, 10**6):
        stretches = list(collocations.pieces_of(text, limit))
        assert b"".join(stretches) == text
        assert all(part[-1:] in collocations.BREAKS for part in map(bytes, stretches[:-1]))


def test_extra_columns_and_parts_do_not_matter(spark):
    texts = random_texts(11, 12)
    docs = spark.createDataFrame([(t, "en", 1, "x", 2) for t in texts], "body string, tongue string, f int, id string, part int")
    found = collocations.collocations(docs.repartition(5), "body", "tongue", min_count=3)
    assert sorted(map(tuple, found.collect())) == plain_collocations([("en", t) for t in texts], 3, 2000)


def test_pairs_travel_packed_and_not_as_rows(spark, monkeypatch):
    made, staged, frames = np.random.default_rng(5), collocations.staged, []
    texts = [" ".join(f"w{int(w)}" for w in made.integers(400, size=300) // made.integers(1, 9, size=300)) for _ in range(120)]
    monkeypatch.setattr(collocations, "staged", lambda *args, **options: frames.append(staged(*args, **options)) or frames[-1])
    docs = spark.createDataFrame([("en", text) for text in texts], "lang string, text string").repartition(4)
    found = sorted(map(tuple, collocations.collocations(docs, min_count=5, top=50).collect()))
    assert found == plain_collocations([("en", text) for text in texts], 5, 50)
    pairs = len({pair for text in texts for pair in zip(text.split(), text.split()[1:])})
    assert sum(frame.count() for frame in frames) < pairs / 2


@pytest.mark.parametrize("least, words", [(1, 2 << 20), (1, 7), (300, 2 << 20)])
def test_the_number_of_buckets_does_not_matter(spark, monkeypatch, least, words):
    monkeypatch.setattr(collocations, "LEAST_BUCKETS", least)
    monkeypatch.setattr(collocations, "BUCKET_WORDS", words)
    rows = [(("en", None)[i % 2], text) for i, text in enumerate(random_texts(13, 12))]
    assert mined(spark, rows, min_count=3, top=25) == plain_collocations(rows, 3, 25)


@pytest.mark.parametrize("buckets", [1, 7, 500])
def test_joined_relations_equal_a_plain_join(buckets):
    made = np.random.default_rng(buckets)
    symbols = made.integers(-1, 12, 500).astype("<i4")
    ids = made.permutation(np.arange(12) << 40)
    ids[made.integers(12, size=3)] = -1
    known = [int(ids[code]) if code >= 0 else -1 for code in symbols]
    plain = [pair for pair in zip(known, known[1:]) if min(pair) >= 0]
    kept, own = collocations.known_only(symbols, ids)
    assert own.tolist() == sorted(own.tolist())
    codes, first, second, held, sizes = collocations.joined(kept, own, buckets)
    assert [(first[code], second[code]) for code in codes if code >= 0] == plain
    assert dict(zip(zip(first.tolist(), second.tolist()), held.tolist())) == Counter(plain)
    assert sizes.sum() == len(held) and len(sizes) == buckets
    assert (collocations.unpressed_symbols(collocations.pressed_symbols(codes)) == codes).all()
    for end in np.cumsum(sizes)[sizes > 0]:
        part = slice(end - sizes[np.searchsorted(np.cumsum(sizes), end)], end)
        back = collocations.unpressed_entries(collocations.pressed_entries(first[part], second[part], held[part]))
        assert [x.tolist() for x in back] == [first[part].tolist(), second[part].tolist(), held[part].tolist()]


def test_nothing_known_leaves_an_empty_relation():
    for symbols, ids in (([0, 1, 0], [-1, -1]), ([0, 1, 0, -1, 0], [5, -1])):
        kept, own = collocations.known_only(np.array(symbols, "<i4"), np.array(ids))
        assert len(kept) == len(own) == 0


def test_scores_are_exact_beyond_64_bits(spark):
    groups = spark.range(1).select(
        F.col("id"),
        F.lit("en").alias("lang"),
        F.lit("a b").alias("text"),
        F.lit(4 * 10**18).alias("f"),
        F.array(F.lit(4 * 10**18 + 3)).alias("heads"),
        F.array(F.lit(4 * 10**18 + 1)).alias("tails"),
    )
    assert collocations._scored(groups, 2).first()["score"] == 2000000 * 4 * 10**18 // (8 * 10**18 + 4)


# ---- near-duplicate vectors ----


def plain_links(vectors, cosine):
    able = [i for i, (key, v) in enumerate(vectors) if key is not None and v and np.isfinite(np.array(v, float)).all() and any(v)]
    unit = {i: np.array(vectors[i][1], float) / np.linalg.norm(np.array(vectors[i][1], float)) for i in able}
    links = {i: [j for j in able if j != i and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= cosine] for i in able}
    result = []
    for i, (key, _) in enumerate(vectors):
        seen, waiting = {i}, [i]
        while waiting:
            new = set(links.get(waiting.pop(), ())) - seen
            seen |= new
            waiting += new
        least = key if i not in links else min(vectors[j][0] for j in seen)
        result.append((key, len(links.get(i, ())), least, key is None or key == least))
    return sorted(result, key=str)


def near(spark, vectors, **options):
    df = spark.createDataFrame([(key, v, 1) for key, v in vectors], VECTORS)
    return sorted(map(tuple, itq.near_vectors(df, **options).collect()), key=str)


def clustered(seed, groups, members, dims, cosines):
    made, vectors = np.random.default_rng(seed), []
    for _ in range(groups):
        centre = made.standard_normal(dims)
        centre /= np.linalg.norm(centre)
        for _ in range(members):
            across = made.standard_normal(dims)
            across -= across @ centre * centre
            across /= np.linalg.norm(across)
            c = made.uniform(*cosines)
            vectors.append((c * centre + np.sqrt(1 - c * c) * across) * made.uniform(0.1, 50))
    order = made.permutation(len(vectors))
    return [(int(i), vectors[i].tolist()) for i in order]


@pytest.mark.parametrize("cosines", [(0.99, 1.0), (0.93, 0.99), (0.9, 0.96)])
def test_links_equal_a_full_comparison(spark, cosines):
    vectors = clustered(3, 40, 12, 64, cosines)
    found, wanted = near(spark, vectors), plain_links(vectors, 0.9)
    links = sum(row[1] for row in wanted)
    assert links > 400
    assert all(own[1] <= other[1] for own, other in zip(found, wanted))  # none below the similarity
    assert sum(row[1] for row in found) >= 0.995 * links


def test_recall_at_the_similarity_itself():
    made = np.random.default_rng(5)
    units = itq.unit_rows(made.standard_normal((3000, 64)) + made.standard_normal(64))
    codes = itq.learned(units[:2000], 100_000, 0.9, 0.001, 160)
    one, other = itq.at_angle(units[2000:], 0.9)
    met = (codes.keys(one) == codes.keys(other)).any(axis=1)
    assert len(met) >= 4000 and met.mean() >= 0.99


def test_bits_are_balanced_and_the_rotation_orthogonal():
    units = itq.unit_rows(np.random.default_rng(6).standard_normal((2000, 32)) + 0.5)
    rotations = itq.Rotations(units)
    codes = rotations.codes(8, 8)
    assert np.abs(((np.ldexp(units, 15) @ codes.weights) >= codes.middle).mean(axis=0) - 0.5).max() < 0.1
    turned = itq.rotation(rotations.projected, 1)
    assert np.allclose(turned @ turned.T, np.eye(32))


def test_one_large_group_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(itq, "BLOCK", 40)
    vectors = clustered(8, 1, 150, 16, (0.995, 1.0)) + [(1000 + i, v) for i, v in clustered(9, 30, 2, 16, (0.99, 1.0))]
    assert near(spark, vectors) == plain_links(vectors, 0.9)


def test_awkward_vectors(spark):
    v = [0.5, -0.25, 1.0]
    vectors = [
        (1, v), (2, v), (2, [-x for x in v]), (2, v), (3, [x * 1e300 for x in v]), (4, [x * 1e-300 for x in v]),
        (5, None), (6, []), (7, [0.0, -0.0, 0.0]), (8, [1.0, float("nan"), 0.0]), (9, [1.0, None, 0.0]), (10, [float("inf"), 0.0, 0.0]),
        (None, v), (None, None), (11, v + [0.0]), (12, v + [0.0]), (0, [-1.0, 0.5, -2.0]),
    ]
    comparable = [(k, None if w and None in w else w) for k, w in vectors]
    unscaled = [(k, v if k in (3, 4) else w) for k, w in comparable]
    assert near(spark, vectors) == plain_links(unscaled, 0.9)
    assert near(spark, []) == []
    assert near(spark, [(5, [3.0])]) == [(5, 0, 5, True)]


def test_extra_columns_with_clashing_names(spark):
    df = spark.createDataFrame(
        [(1, [1.0, 0.0], 9, 9, 9, 9), (2, [1.0, 0.1], 9, 9, 9, 9)],
        "id long, e array<float>, vec_id int, node int, class int, n_links int",
    )
    rows = itq.near_vectors(df, id_column="id", vector_column="e").collect()
    assert sorted(map(tuple, rows)) == [(1, 1, 1, True), (2, 1, 1, False)]


# ---- vector codes ----


def plain_codes(vectors, parts, entries, rounds, scale=1024):
    kept = [(k, v, l) for k, v, l in vectors if v and None not in v and np.isfinite(v).all() and len(v) % parts == 0]
    kept.sort(key=lambda row: (row[0] is None, row[0] or 0, [int(np.floor(scale * x)) for x in row[1]]))
    kept = [row for row in kept if len(row[1]) == len(kept[0][1])]
    x = np.array([[int(np.floor(scale * x)) for x in row[1]] for row in kept], np.int64).reshape(len(kept), parts, -1)
    books, codes, error = [], [], 0
    for p in range(parts):
        book = x[:entries, p].copy()
        for number in range(rounds + 1):
            distances = ((x[:, p][:, None] - book[None]) ** 2).sum(2)
            code = distances.argmin(1)
            if number < rounds:
                for e in set(code.tolist()):
                    book[e] = x[code == e, p].sum(0) // (code == e).sum()
        books.append(book)
        codes.append(code)
        error = error + distances.min(1)
    rows = [(row[0], [int(c[i]) for c in codes], int(error[i]), row[2]) for i, row in enumerate(kept)]
    return sorted(rows, key=str), books


def coded(spark, vectors, **options):
    df = spark.createDataFrame(vectors, VECTORS).repartition(3)
    result = lloyd.coded(df, **options)
    rows = [(r.vec_id, r.codes, r.error, None if r.label is None else int(r.label)) for r in result.rows.collect()]
    return sorted(rows, key=str), result


@pytest.mark.parametrize("spread", [0.002, 0.01, 1.0])
def test_codes_equal_full_scans(spark, spread):
    """A small spread makes many equal distances and unused entries."""
    made = np.random.default_rng(int(spread * 1000))
    vectors = [(int(i), (made.standard_normal(8) * spread).tolist(), int(i) % 3) for i in made.permutation(300)]
    rows, result = coded(spark, vectors, parts=4, entries=40, rounds=4)
    wanted, books = plain_codes(vectors, 4, 40, 4)
    assert rows == wanted
    assert all((own == other).all() for own, other in zip(result.codebooks, books))


def test_only_moved_entries_are_compared(monkeypatch):
    compared, nearest = [], lloyd.nearest

    def counted(x, book, number):
        compared.append(len(x) * len(book))
        return nearest(x, book, number)

    monkeypatch.setattr(lloyd, "nearest", counted)
    made = np.random.default_rng(1)
    x, book = made.integers(-9, 9, (200, 3)), made.integers(-9, 9, (16, 3))
    code, distance = lloyd.reassigned(x, book, np.ones(16, bool), np.full(200, -1), np.zeros(200, np.int64), np.float64)
    moved = np.zeros(16, bool)
    moved[5] = True
    book[5] += 2
    compared.clear()
    again, least = lloyd.reassigned(x, book, moved, code, distance, np.float64)
    assert sum(compared) == 16 * (code == 5).sum() + (code != 5).sum()
    full, exact = nearest(x, book, np.int64)
    assert (again == full).all() and (least == exact).all()


def test_codes_of_awkward_vectors(spark):
    v = [0.1, -0.2, 0.3, -0.4]
    vectors = [
        (3, v, 1), (3, v, 1), (3, [x / 2 for x in v], None), (None, [1.0, 2.0, 3.0, 4.0], None), (1, None, 1), (2, [], 1),
        (4, [float("nan"), 0.0, 0.0, 0.0], 1), (5, [None, 0.0, 0.0, 0.0], 2), (6, [float("inf"), 0.0, 0.0, 0.0], 2),
        (7, [1.0], 3), (8, v + v, 3), (9, [-0.0001, 0.0001, 0.0, 0.0], None),
    ]
    rows, result = coded(spark, vectors, parts=2, entries=3, rounds=2)
    wanted, books = plain_codes(vectors, 2, 3, 2)
    assert rows == wanted
    assert all((own == other).all() for own, other in zip(result.codebooks, books))
    errors = {(r.vec_id, r.error): r.label_error for r in lloyd.with_label_errors(result.rows).collect()}
    groups = Counter()
    for _, _, error, label in wanted:
        groups[label] += error
    assert errors == {(key, error): groups[label] for key, _, error, label in wanted}
    empty, result = coded(spark, [], parts=2)
    assert empty == [] and result.codebooks == []


def test_large_components(spark):
    made = np.random.default_rng(2)
    vectors = [(i, (made.standard_normal(4) * 1e5).tolist(), 0) for i in range(50)]
    rows, _ = coded(spark, vectors, parts=2, entries=8, rounds=3)
    assert rows == plain_codes(vectors, 2, 8, 3)[0]
    with pytest.raises(OverflowError):
        lloyd.coded(spark.createDataFrame([(1, [1e300, 0.0], 1)], VECTORS), parts=2)
