"""Quality rules: word statistics of every text, two fixed rules, and isolation forests.

A forest (trees over random splits of small samples) measures how few random splits isolate a
document. There is one forest over all rule statistics together and one for each statistic,
whose trees split that statistic alone, since one bad rate among good ones is otherwise hidden
by the splits of the others. Trees are grown from a bounded sample (`sample_rows`, chosen by
hash of the id, so the choice does not depend on partitioning); every document is scored.

Each forest's threshold is calibrated on all labelled documents: among the scores that reject
at most `max_good_rejected` of those labelled good, and bad documents at least `min_ratio` times
as often as good ones, the one that separates good from bad best, and of equal ones the most
lenient. A forest without such a score rejects nothing. The score histograms have `SCORE_BINS` bins per
forest, so what reaches the driver is bounded.

Defined results: a null or empty text has no words and fails the word-count rule; without any
labelled row of either kind, or when no threshold separates, the forests reject nothing;
repeated rows are judged alike, and rows that share an id each by their own text; a null id is
judged like any other and has no label; labels of unknown documents and null labels are ignored;
an empty table gives an empty result. A text is held whole by one task.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sediment.llm.common import Words, arrow_map, map_texts, mix, narrowed, quoted, repeated, split_words
from sediment.sinks.staging import staged

SYMBOLS = b"#*$%&|<>"
# White space and UTF-8 continuation bytes: what is left after deleting them is one byte per
# code point of the words.
NOT_COUNTED = bytes([*b" \t\n\x0b\x0c\r", *range(0x80, 0xC0)])
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
SCORE_BINS = 1024


def repeated_words(words: Words) -> np.ndarray:
    """Per text, the words inside three-word windows that occur at least twice in that text."""
    text, hashes = words.texts, words.hashes
    windows = np.flatnonzero(text[2:] == text[:-2])
    key = mix(hashes[windows] * np.uint64(3) + mix(hashes[windows + 1] + mix(hashes[windows + 2])))
    again = windows[repeated(mix(key + text[windows].astype(np.uint64)))]
    covered = np.zeros(len(hashes), bool)
    for i in range(3):
        covered[again + i] = True
    return np.bincount(text[covered], minlength=len(words.counts)).astype(np.int64)


def text_counts(texts: list[bytes]) -> dict[str, np.ndarray]:
    """The COUNTS of each text."""
    words = split_words(texts)
    lines = [[line for line in text.split(b"\n") if line.strip()] for text in texts]
    columns = [
        words.counts.astype(np.int64),
        np.array([len(text.translate(None, NOT_COUNTED)) for text in texts], np.int64),
        np.array([len(text) - len(text.translate(None, SYMBOLS)) for text in texts], np.int64),
        np.array([len(own) for own in lines], np.int64),
        np.array([len(own) - len(set(own)) for own in lines], np.int64),
        repeated_words(words),
    ]
    return dict(zip(COUNTS, columns, strict=True))


def rule_statistics(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id and the COUNTS of every row; n_lines counts lines with a word."""

    def measure(batch, texts):
        counts = text_counts(texts)
        yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(counts[name]) for name in COUNTS]], ["doc_id", *COUNTS])

    schema = "doc_id long, " + ", ".join(f"{name} long" for name in COUNTS)
    return map_texts(narrowed(docs, doc_id=id_column, text=text_column), "text", measure, schema)


def features(counts: dict[str, np.ndarray]) -> np.ndarray:
    """Rates that do not grow with the text, on a scale that keeps small ones apart from none."""
    words, lines = np.maximum(counts["n_words"], 1), np.maximum(counts["n_lines"], 1)

    def rate(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
        return np.log(part / whole + 0.01)

    return np.column_stack(
        [
            np.log1p(counts["n_words"]),
            counts["word_chars"] / words,
            rate(counts["n_symbols"], words),
            rate(counts["n_dup_lines"], lines),
            rate(counts["n_repeat_words"], words),
        ]
    ).astype(np.float64)


def average_path(n: np.ndarray) -> np.ndarray:
    """Mean depth of an unsuccessful search in a binary tree of n points."""
    n = np.asarray(n, np.float64)
    harmonic = np.log(np.maximum(n - 1, 1)) + 0.5772156649015329
    return np.where(n > 2, 2 * harmonic - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


@dataclass
class IsolationForest:
    """Trees as arrays: an inner node has a feature and a cut, a leaf the length of its path."""

    feature: np.ndarray  # trees x nodes; -1: leaf
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    path: np.ndarray
    sample: int

    @classmethod
    def grown(
        cls, points: np.ndarray, only: int | None = None, trees: int = 100, sample: int = 256, seed: int = 7
    ) -> IsolationForest:
        """Trees over all columns of the points, or over the column `only`."""
        allowed = np.arange(points.shape[1]) == only if only is not None else np.ones(points.shape[1], bool)
        rng = np.random.default_rng(seed)
        sample = min(sample, len(points))
        depth_limit = max(1, math.ceil(math.log2(max(sample, 2))))
        size = 2 ** (depth_limit + 1)
        shape = (trees, size)
        forest = cls(
            np.full(shape, -1), np.zeros(shape), np.zeros(shape, int), np.zeros(shape, int), np.zeros(shape), sample
        )
        for t in range(trees):
            own = points[rng.choice(len(points), sample, replace=False)]
            stack, used = [(0, own, 0)], 1
            while stack:
                node, rows, depth = stack.pop()
                low, high = rows.min(axis=0), rows.max(axis=0)
                varied = np.flatnonzero((high > low) & allowed)
                if depth == depth_limit or len(varied) == 0:
                    forest.path[t, node] = depth + average_path(len(rows))
                    continue
                f = rng.choice(varied)
                cut = rng.uniform(low[f], high[f])
                below = rows[:, f] <= cut
                forest.feature[t, node], forest.cut[t, node] = f, cut
                forest.left[t, node], forest.right[t, node] = used, used + 1
                stack += [(used, rows[below], depth + 1), (used + 1, rows[~below], depth + 1)]
                used += 2
        return forest

    def scores(self, points: np.ndarray) -> np.ndarray:
        """2 ** (-mean path / expected path): close to 1 where few splits isolate a point."""
        total = np.zeros(len(points))
        rows = np.arange(len(points))
        for t in range(len(self.feature)):
            node = np.zeros(len(points), int)
            while True:
                f = self.feature[t, node]
                inner = f >= 0
                if not inner.any():
                    break
                below = points[rows, np.maximum(f, 0)] <= self.cut[t, node]
                node = np.where(inner, np.where(below, self.left[t, node], self.right[t, node]), node)
            total += self.path[t, node]
        expected = max(float(average_path(self.sample)), 1e-9)
        return 2.0 ** (-total / len(self.feature) / expected)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def forest_scores(statistics: DataFrame, forests: list[IsolationForest]) -> DataFrame:
    """The statistics with a column `scores`, one score per forest."""

    def run(batches):
        for batch in batches:
            counts = {name: batch.column(name).to_numpy(zero_copy_only=False) for name in COUNTS}
            points = features(counts)
            scores = np.column_stack([forest.scores(points) for forest in forests])
            scores = pa.array(list(scores), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], [*batch.schema.names, "scores"])

    if not forests:
        return statistics.withColumn("scores", F.expr("cast(array() as array<double>)"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in statistics.schema) + ", scores array<double>"
    return arrow_map(statistics, run, schema)


def calibrated_thresholds(
    scored: DataFrame, labels: DataFrame, forests: int, max_good_rejected: float, min_ratio: float
) -> list[float]:
    """For each forest the score from which documents are rejected; above 1 if none should be."""
    known = labels.filter("quality is not null").select(F.col("doc_id").alias("labelled"), "quality")
    bins = (
        scored.filter("not base_failed")
        .join(known, F.col("doc_id") == F.col("labelled"))
        .select("quality", F.posexplode("scores").alias("forest", "score"))
        .groupBy("forest", F.floor(F.col("score") * SCORE_BINS).cast("int").alias("bin"))
        .agg(F.count_if(F.col("quality") == 1).alias("good"), F.count_if(F.col("quality") == 0).alias("bad"))
        .collect()  # one row per forest and bin
    )
    good, bad = np.zeros((forests, SCORE_BINS + 1)), np.zeros((forests, SCORE_BINS + 1))
    for row in bins:
        good[row["forest"], row["bin"]], bad[row["forest"], row["bin"]] = row["good"], row["bad"]
    thresholds = []
    for own_good, own_bad in zip(good, bad, strict=True):
        thresholds.append(2.0)
        if not own_good.sum() or not own_bad.sum():
            continue
        good_rejected = np.cumsum(own_good[::-1])[::-1] / own_good.sum()
        bad_rejected = np.cumsum(own_bad[::-1])[::-1] / own_bad.sum()
        allowed = (good_rejected <= max_good_rejected) & (bad_rejected >= min_ratio * good_rejected)
        gain = np.where(allowed, bad_rejected - good_rejected, -1.0)
        best = int(np.flatnonzero(gain == gain.max())[-1])
        if gain[best] > 0:
            thresholds[-1] = best / SCORE_BINS
    return thresholds


def judged(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    sample_rows: int = 8192,
    max_good_rejected: float = 0.002,
    min_ratio: float = 200.0,
) -> DataFrame:
    """Statistics, base_failed, scores and kept of every document.

    `labels` has doc_id and quality (1 good, 0 bad). The forests are grown from documents that
    pass the base rules: what is rare among those is what they should find.
    """
    return fitted(docs, labels, id_column, text_column, sample_rows, max_good_rejected, min_ratio).scored


@dataclass
class Fitted:
    """The verdict on every document, and what it takes to judge a row again."""

    scored: DataFrame
    forests: list[IsolationForest]
    thresholds: list[float]


def sampled(statistics: DataFrame, rows: int) -> np.ndarray:
    """COUNTS of at most `rows` documents that pass the base rules, those with the least hashes.

    Only rows whose hash lies below a bound for about twice as many take part, and executors
    put these in order, so what is sorted and what the driver gets do not grow with the table.
    """
    passed = statistics.filter("not base_failed")
    total = passed.count()
    if not total:
        return np.zeros((0, len(COUNTS)))
    share = min(1.0, 2 * (rows + 64) / total)
    hashed = F.xxhash64("doc_id")
    near = passed.filter(hashed <= F.lit(min(2**63 - 1, -(2**63) + int(share * 2**64))))
    chosen = staged(near.orderBy(hashed, *COUNTS).limit(rows).select("doc_id", *COUNTS))
    found = sorted(tuple(row)[1:] for row in chosen.collect())
    return np.array(found, np.float64).reshape(-1, len(COUNTS))


def fitted(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    sample_rows: int = 8192,
    max_good_rejected: float = 0.002,
    min_ratio: float = 200.0,
) -> Fitted:
    statistics = staged(rule_statistics(docs, id_column, text_column).withColumn("base_failed", base_failed()))
    sample = sampled(statistics, sample_rows)
    forests = []
    if len(sample):
        points = features(dict(zip(COUNTS, sample.T, strict=True)))
        forests = [IsolationForest.grown(points, trees=60)]
        forests += [IsolationForest.grown(points, only, trees=20) for only in range(points.shape[1])]
    scored = staged(forest_scores(statistics, forests))
    thresholds = calibrated_thresholds(scored, labels, len(forests), max_good_rejected, min_ratio)
    anomalous = F.lit(False)
    for i, threshold in enumerate(thresholds):
        anomalous = anomalous | (F.col("scores")[i] >= threshold)
    return Fitted(scored.withColumn("kept", ~F.col("base_failed") & ~anomalous), forests, thresholds)


def kept_rows(docs: DataFrame, labels: DataFrame, text_column: str = "text", **options) -> DataFrame:
    """The rows of `docs` that are kept, each judged by its own text, with all their columns.

    Statistics and scores are computed again where the row lies, so no text is shuffled.
    """
    known = fitted(docs, labels, text_column=text_column, **options)
    forests, thresholds = known.forests, np.array(known.thresholds)

    def keep(batch, texts):
        counts = text_counts(texts)
        kept = (counts["n_words"] >= 50) & (100 * counts["n_repeat_words"] <= 50 * counts["n_words"])
        if forests:
            points = features(counts)
            scores = np.column_stack([forest.scores(points) for forest in forests])
            kept &= ~(scores >= thresholds).any(axis=1)
        yield batch.filter(pa.array(kept))

    schema = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in docs.schema)
    return map_texts(docs, text_column, keep, schema)
