"""Registered queries of the operators, with production parameters over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sediment.llm import binary_output, bpe, collocations, itq, lloyd, minhash, packing, pii, quality, recompression
from sediment.llm import topk, warc
from sediment.llm import line_dedup as lines

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(table(spark, sf_dir, "documents"), with_text=False)
    base = F.filter("spans", lambda s: s["base"])

    def number(kind: str):
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[number(kind) for kind in pii.KINDS],
        F.sha2(pii.written(base), 256).alias("base_sha256"),
        pii.written(F.col("spans")).alias("spans"),
    )


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.archived(table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts = quality.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return verdicts.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "scores"
    )


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe.encoded(table(spark, sf_dir, "documents"), WORD_BPE)
    return encoded.select(
        "doc_id",
        F.expr("cast(length(ids) div 4 as long)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.line_dedup(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = packing.best_fit_packing(table(spark, sf_dir, "documents"), BYTE_BPE, with_ids=False)
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op9_binary_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binary_output.packed_rows(table(spark, sf_dir, "documents"), BYTE_BPE)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = recompression.substring_dedup(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return itq.near_vectors(table(spark, sf_dir, "embeddings"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = lloyd.coded(table(spark, sf_dir, "embeddings"))
    digits = F.transform("codes", lambda code: F.lower(F.lpad(F.hex(code), 2, "0")))
    return lloyd.with_label_errors(result.rows).select(
        "vec_id",
        F.array_join(digits, "").alias("code"),
        "error",
        "label_error",
        F.lit(result.digest()).alias("codebooks_sha256"),
    )


OP2_SQL = r"""
WITH payloads AS (
    SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
),
digests AS (
    SELECT page_id, octet_length(payload) AS payload_bytes, sha256(payload) AS payload_digest FROM payloads
),
firsts AS (
    SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_page FROM digests
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_page THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_page THEN first_page END AS refers_to
FROM firsts
"""

OP3_SQL = r"""
WITH vectors AS (
    SELECT vec_id, [floor(1024 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
),
scores AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
    FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""

OP5_SQL = r"""
WITH RECURSIVE split AS (
    SELECT doc_id,
           [w FOR w IN string_split_regex(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[\x20\x09-\x0D]+') IF w <> ''] AS words
    FROM documents
),
shingles AS MATERIALIZED (
    SELECT DISTINCT doc_id, md5(array_to_string(words[i.i:i.i + 4], ' ')) AS shingle
    FROM split, LATERAL (SELECT unnest(range(1, greatest(len(words) - 3, least(len(words), 1) + 1))) AS i) i
),
sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
),
shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id
),
links AS MATERIALIZED (
    SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * shared.n >= 85 * (x.n + y.n - shared.n)
),
both_ways AS MATERIALIZED (
    SELECT a, b FROM links UNION ALL SELECT b, a FROM links
),
reached(doc_id, other) AS (
    SELECT doc_id, doc_id FROM documents
    UNION
    SELECT reached.doc_id, both_ways.b FROM reached JOIN both_ways ON both_ways.a = reached.other
)
SELECT doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(other) AS component_id, doc_id = min(other) AS kept
FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""

OP7_SQL = r"""
WITH lines AS (
    SELECT doc_id, position, line, translate(trim(line, E' \t\n\x0b\x0c\r'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM (
        SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS position
        FROM documents
    )
),
shared AS (
    SELECT key, min(doc_id) AS first_doc FROM lines WHERE length(key) >= 10
    GROUP BY key HAVING count(DISTINCT doc_id) >= 2
),
marked AS (
    SELECT lines.*, coalesce(doc_id <> first_doc, false) AS dropped FROM lines LEFT JOIN shared USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY position) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

OP10_SQL = r"""
WITH split AS (
    SELECT doc_id, [w FOR w IN string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') IF w <> ''] AS words FROM documents
),
numbered AS (
    SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS pos FROM split
),
windows AS (
    SELECT doc_id, pos, words[pos] AS word,
           CASE WHEN pos + 49 <= len(words) THEN md5(array_to_string(words[pos:pos + 49], ' ')) END AS key
    FROM numbered
),
firsts AS (
    SELECT key, min(doc_id) AS first_doc FROM windows WHERE key IS NOT NULL GROUP BY key
),
marked AS (
    SELECT doc_id, pos, word,
           max(CASE WHEN first_doc < doc_id THEN 1 ELSE 0 END)
               OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone
    FROM windows LEFT JOIN firsts USING (key)
)
SELECT split.doc_id, len(words) AS n_words, count(*) FILTER (gone = 1) AS n_removed,
       sha256(coalesce(string_agg(word, ' ' ORDER BY pos) FILTER (gone = 0), '')) AS kept_sha256
FROM split LEFT JOIN marked ON split.doc_id = marked.doc_id GROUP BY split.doc_id, len(words)
"""

OP11_SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(string_split_regex(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
),
split AS (
    SELECT lang, row_number() OVER () AS piece_id,
           [w FOR w IN string_split_regex(piece, '[\x20\x09]+') IF w <> ''] AS words
    FROM pieces
),
occurrences AS MATERIALIZED (
    SELECT lang, piece_id, unnest(words) AS w1, unnest(range(len(words))) AS position FROM split
),
runs AS MATERIALIZED (
    SELECT lang, w1, lead(w1, 1) OVER own AS w2, lead(w1, 2) OVER own AS w3, lead(w1, 3) OVER own AS w4
    FROM occurrences WINDOW own AS (PARTITION BY piece_id ORDER BY position)
),
totals AS (
    SELECT lang, count(*) AS n FROM occurrences GROUP BY lang
),
counted AS MATERIALIZED (
    SELECT lang, [w1] AS words, count(*) AS f FROM runs GROUP BY ALL
    UNION ALL SELECT lang, [w1, w2], count(*) FROM runs WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 30
    UNION ALL SELECT lang, [w1, w2, w3], count(*) FROM runs WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 30
    UNION ALL SELECT lang, [w1, w2, w3, w4], count(*) FROM runs WHERE w4 IS NOT NULL GROUP BY ALL HAVING count(*) >= 30
),
candidates AS MATERIALIZED (
    SELECT lang, words, f FROM counted WHERE len(words) >= 2
),
held AS (
    SELECT lang, f, words[i.i:i.i + k.k - 1] AS inner_words
    FROM candidates, range(1, 4) i(i), range(2, 4) k(k)
    WHERE k.k < len(words) AND i.i + k.k - 1 <= len(words)
),
absorbed AS (
    SELECT c.lang, c.words FROM candidates c JOIN held h ON h.lang = c.lang AND h.inner_words = c.words
    GROUP BY c.lang, c.words, c.f HAVING 100 * max(h.f) >= 80 * c.f
),
cuts AS (
    SELECT c.lang, c.words, c.f AS a, k.k, left_side.f AS l, right_side.f AS r,
           (2000000::HUGEINT * c.f) // (left_side.f + right_side.f) AS score
    FROM candidates c ANTI JOIN absorbed USING (lang, words), range(1, 4) k(k), counted left_side, counted right_side
    WHERE k.k < len(c.words)
      AND left_side.lang = c.lang AND left_side.words = c.words[1:k.k]
      AND right_side.lang = c.lang AND right_side.words = c.words[k.k + 1:]
),
lowest AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1
),
ranked AS (
    SELECT lang, array_to_string(words, ' ') AS phrase, a, l, r, score FROM lowest
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score::BIGINT AS score
FROM ranked JOIN totals USING (lang) QUALIFY rank <= 2000
"""

OP12_SQL = r"""
WITH RECURSIVE vectors AS (
    SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
      AND len([x FOR x IN embedding IF x <> 0]) > 0
),
links AS MATERIALIZED (
    SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(a.v, b.v) >= 0.9
),
reached(vec_id, other) AS (
    SELECT vec_id, vec_id FROM embeddings
    UNION
    SELECT reached.vec_id, links.b FROM reached JOIN links ON links.a = reached.other
),
named AS (
    SELECT vec_id, min(other) AS component_id FROM reached GROUP BY vec_id
),
numbers AS (
    SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a
)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM named LEFT JOIN numbers USING (vec_id)
"""


def op13_sql(rounds: int = 4) -> str:
    """The rounds one after another, each assignment a full scan of the codebook."""
    assigned = """
assigned{0} AS MATERIALIZED (
    SELECT p.vec_id, p.label, p.part, p.x, arg_min(e.entry, {{'d': {1}, 'e': e.entry}}) AS entry, min({1}) AS distance
    FROM parts p JOIN entries{0} e ON e.part = p.part GROUP BY p.vec_id, p.label, p.part, p.x
)"""
    moved = """
entries{1} AS MATERIALIZED (
    SELECT old.part, old.entry, coalesce(new.c, old.c) AS c
    FROM entries{0} old LEFT JOIN (
        SELECT part, entry, list(floor(total / members) ORDER BY position) AS c
        FROM (
            SELECT part, entry, position, sum(value) AS total, count(*) AS members
            FROM (SELECT part, entry, unnest(x) AS value, unnest(range(len(x))) AS position FROM assigned{0})
            GROUP BY part, entry, position
        )
        GROUP BY part, entry
    ) new ON new.part = old.part AND new.entry = old.entry
)"""
    distance = "(list_inner_product(p.x, p.x) - 2 * list_inner_product(p.x, e.c) + list_inner_product(e.c, e.c))"
    steps = [assigned.format(0, distance)]
    for number in range(rounds):
        steps += [moved.format(number, number + 1), assigned.format(number + 1, distance)]
    return f"""
WITH vectors AS (
    SELECT vec_id, label, [floor(1024 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
),
parts AS MATERIALIZED (
    SELECT vec_id, label, part, v[part * (len(v) // 4) + 1:(part + 1) * (len(v) // 4)] AS x FROM vectors, range(4) parts(part)
),
entries0 AS MATERIALIZED (
    SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, x AS c
    FROM parts QUALIFY entry < 256
),{','.join(steps)},
books AS (
    SELECT sha256(string_agg(value::BIGINT::VARCHAR, ',' ORDER BY part, entry, position)) AS codebooks_sha256
    FROM (SELECT part, entry, unnest(c) AS value, unnest(range(len(c))) AS position FROM entries{rounds})
),
codes AS (
    SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', entry), '' ORDER BY part) AS code,
           sum(distance)::BIGINT AS error
    FROM assigned{rounds} GROUP BY vec_id
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM codes, books
"""


QUERIES = {
    "op1_personal_data": op1_personal_data,
    "op2_warc": op2_warc,
    "op3_exact_top_k": op3_exact_top_k,
    "op4_quality_rules": op4_quality_rules,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_bpe": op6_bpe,
    "op7_line_dedup": op7_line_dedup,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_binary_output": op9_binary_output,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_collocations": op11_collocations,
    "op12_near_vectors": op12_near_vectors,
    "op13_vector_codes": op13_vector_codes,
}

ORACLES = {
    "op2_warc": OP2_SQL,
    "op3_exact_top_k": OP3_SQL,
    "op5_near_duplicates": OP5_SQL,
    "op7_line_dedup": OP7_SQL,
    "op10_substring_dedup": OP10_SQL,
    "op11_collocations": OP11_SQL,
    "op12_near_vectors": OP12_SQL,
    "op13_vector_codes": op13_sql(),
}
