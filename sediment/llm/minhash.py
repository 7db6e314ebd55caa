"""Near-duplicate documents by fast similarity sketching, banding and exact verification.

A document is the set of its five-word shingles (A-Z lower-cased). Its sketch has `bins`
coordinates, filled in rounds: in each of the first `bins` rounds every shingle is hashed into a
bin with a value, in round `bins` + j every shingle goes to bin j, and a bin keeps its least
value, where earlier rounds are less than later ones. A document stops once all its bins are
filled, which the second kind of round guarantees, after about one pass over large sets. Equal
coordinates estimate the Jaccard similarity with the concentration of independent ones.

Bands of several coordinates give bucket keys. Their number and rows follow from the similarity
asked for, so that two sets that just have it share no bucket with a probability of at most
`MISS` (25 bands of 5 rows at 0.85, 28 of 4 at 0.80). Documents with equal sets are one class, and only the
smallest id of a class goes on, as a node named by half of the set's hash, since rows with other
texts may share that id. Inside a bucket not all pairs are formed: the member with the
fewest shingles of its own, the most central one, is compared with the others on full sets,
and verified links join components. Where a bucket's members are still in different
components, what may link them is found by their rarest shingles (`_sharing_rare`), which
loses no pair; signatures of 1024 bits rule out most of them before full sets are joined, and the
rest is verified as well. So a large group of near copies needs about one
comparison a member, and no link between components is lost.

Shingles are 64-bit hashes; sets are compared by their hashes and classes by 128 bits.

Defined results: a text without words has no shingles and is linked with nothing; one with
fewer than five words has one shingle, the whole sequence; rows that share an id are judged
each by its own text; a null id is linked with nothing, has no component and is kept; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sediment.llm.common import arrow_map, grams, map_texts, mix, narrowed, quoted, split_words, starts_of
from sediment.llm.components import components
from sediment.sinks.staging import staged

SHINGLE = 5
BINS = 128
MISS = 4.3e-7
EMPTY = np.uint64(2**64 - 1)
WORDS = 16  # 64-bit words of a set's signature
SKETCHES = "doc_id long, row string, n_shingles long, s1 long, s2 long, bands array<long>"


def shingle_sets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, sorted within each text, and their number per text."""
    words = split_words([text.lower() for text in texts])  # bytes: only A-Z change
    text, hashes = words.texts, words.hashes
    keys, owners = [], []
    if len(hashes) >= SHINGLE:
        whole = np.flatnonzero(text[SHINGLE - 1 :] == text[: len(text) - SHINGLE + 1])
        keys.append(grams(hashes, SHINGLE)[whole])
        owners.append(text[whole])
    first = starts_of(words.counts)
    for size in range(1, SHINGLE):
        short = np.flatnonzero(words.counts == size)
        if len(short):
            keys.append(mix(grams(hashes, size)[first[short]] + np.uint64(size)))
            owners.append(short)
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    key, owner = np.concatenate(keys), np.concatenate(owners)
    order = np.argsort(key)
    order = order[np.argsort(owner[order].astype(np.int32), kind="stable")]
    key, owner = key[order], owner[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
    return key[new], np.bincount(owner[new], minlength=len(texts))


def banding(percent: int) -> tuple[int, int]:
    """Rows a band and bands: the most rows whose bands fit BINS and miss a similarity of
    `percent` with a probability of at most MISS; one row where even that takes more bins."""
    if not 1 <= percent <= 100:
        raise ValueError(f"percent must be from 1 to 100, not {percent}")
    best = None
    for rows in range(1, BINS + 1):
        equal = min((percent / 100) ** rows, 1 - 1e-9)
        bands = math.ceil(math.log(MISS) / math.log1p(-equal))
        if best is None or rows * bands <= BINS:
            best = rows, bands
    return best


def similarity_sketches(keys: np.ndarray, counts: np.ndarray, size: int = BINS) -> np.ndarray:
    """texts x size; rows of texts without shingles stay EMPTY."""
    sketch = np.full((len(counts), size), EMPTY)
    flat, owner = sketch.reshape(-1), np.repeat(np.arange(len(counts)), counts)
    round_bits = (2 * size - 1).bit_length()
    for number in range(2 * size):
        if not len(keys):
            break
        values = mix(keys + np.uint64((number + 1) * 0x9E3779B97F4A7C15 % 2**64))
        bins = (values % np.uint64(size)).astype(np.int64) if number < size else number - size
        least = (values >> np.uint64(round_bits)) | np.uint64(number << (64 - round_bits))
        np.minimum.at(flat, owner * size + bins, least)
        unfilled = np.zeros(len(counts), bool)
        present = np.unique(owner)
        unfilled[present] = (sketch[present] == EMPTY).any(axis=1)
        going = unfilled[owner]
        keys, owner = keys[going], owner[going]
    return sketch


def bucket_keys(sketch: np.ndarray, rows: int, bands: int) -> np.ndarray:
    """texts x bands; the band's number is part of the key."""
    coordinates = sketch[:, : rows * bands].reshape(len(sketch), bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(sketch), bands)).copy()
    for row in range(rows):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + coordinates[:, :, row])
    return key


def _set_hashes(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each set, whatever its order."""
    ends, halves = np.cumsum(counts), []
    for salt in (0x1B873593CC9E2D51, 0x85EBCA6BC2B2AE35):
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(keys + np.uint64(salt)))))
        halves.append((total[ends] - total[ends - counts]).view(np.int64))
    return halves[0], halves[1]


def sketches(docs: DataFrame, percent: int) -> DataFrame:
    """SKETCHES for a frame with doc_id and text; `row` is the MD5 of the text."""
    rows, bands_held = banding(percent)
    size = max(BINS, rows * bands_held)

    def run(batch, texts):
        keys, counts = shingle_sets(texts)
        s1, s2 = _set_hashes(keys, counts)
        bands = bucket_keys(similarity_sketches(keys, counts, size), rows, bands_held).view(np.int64)
        bands = pa.array([own if n else None for own, n in zip(list(bands), counts.tolist())], pa.list_(pa.int64()))
        digests = pa.array([hashlib.md5(text).hexdigest() for text in texts])
        columns = [batch.column(0), digests, pa.array(counts, pa.int64()), pa.array(s1), pa.array(s2), bands]
        yield pa.RecordBatch.from_arrays(columns, [part.split()[0] for part in SKETCHES.split(", ")])

    return map_texts(docs, "text", run, SKETCHES)


def full_sets(docs: DataFrame) -> DataFrame:
    """node (half of the set's hash), shingles (binary, sorted 64-bit hashes) and signature: one of
    its bits is set for each shingle."""

    def run(batch, texts):
        keys, counts = shingle_sets(texts)
        held, ends = keys.astype("<u8").tobytes(), 8 * np.cumsum(counts)
        sets = [held[end - 8 * n : end] for end, n in zip(ends.tolist(), counts.tolist())]
        bits = np.zeros((len(texts), 64 * WORDS), bool)
        bits[np.repeat(np.arange(len(texts)), counts), (keys % np.uint64(64 * WORDS)).astype(np.int64)] = True
        words = np.packbits(bits, axis=1).view(np.int64)
        columns = [_set_hashes(keys, counts)[0], pa.array(sets, pa.binary()), pa.array(list(words), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0]), *columns[1:]], ["node", "shingles", "signature"])

    return map_texts(docs, "text", run, "node long, shingles binary, signature array<long>")


def still_possible(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose signatures allow the similarity: a bit that only one signature has stands
    for at least one shingle that only its set has. Spares most pairs the join of full sets."""
    thin = sets.select("node", F.expr("length(shingles) div 8").alias("n"), "signature").dropDuplicates(["node"])
    left = thin.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("signature").alias("bits_a"))
    right = thin.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("signature").alias("bits_b"))

    def alone(one: str, other: str):
        parts = [F.bit_count(F.get(one, F.lit(i)).bitwiseAND(F.bitwise_not(F.get(other, F.lit(i))))) for i in range(WORDS)]
        return reduce(lambda x, y: x + y, parts)

    common = F.least(F.col("n_a") - alone("bits_a", "bits_b"), F.col("n_b") - alone("bits_b", "bits_a"))
    joined = pairs.join(left, "a").join(right, "b").withColumn("most", common)
    return joined.filter(100 * F.col("most") >= percent * (F.col("n_a") + F.col("n_b") - F.col("most"))).select("a", "b")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets have 100 * intersection >= percent * union."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b"))

    def run(batches):
        for batch in batches:
            linked = []
            for a, b in zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist(), strict=True):
                one, other = np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8")
                at = np.minimum(np.searchsorted(other, one), len(other) - 1)
                common = int((other[at] == one).sum())
                linked.append(100 * common >= percent * (len(one) + len(other) - common))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(
                pa.array(linked, pa.bool_())
            )

    joined = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "set_a", "set_b")
    return staged(arrow_map(joined, run, "a long, b long").distinct())


def _exploded(sets: DataFrame) -> DataFrame:
    """node, shingle: one row per element."""

    def explode(batches):
        for batch in batches:
            held = batch.column("shingles").to_pylist()
            counts = np.array([len(own) // 8 for own in held], np.int64)
            owner = batch.column("node").take(pa.array(np.repeat(np.arange(len(held)), counts)))
            yield pa.RecordBatch.from_arrays([owner, pa.array(np.frombuffer(b"".join(held), "<i8"))], ["node", "shingle"])

    return arrow_map(sets.select("node", "shingles"), explode, "node long, shingle long")


def shared_sizes(sets: DataFrame) -> DataFrame:
    """rep, n, c: the size of each set, and how many of its shingles another set has too."""
    alone = (
        _exploded(sets)
        .groupBy("shingle")
        .agg(F.min("node").alias("only"), F.count(F.lit(1)).alias("held"))
        .filter("held = 1")
        .groupBy("only")
        .agg(F.count(F.lit(1)).alias("alone"))
    )
    sizes = sets.groupBy("node").agg(F.max(F.expr("length(shingles) div 8")).alias("n"))
    joined = sizes.join(alone, F.col("node") == F.col("only"), "left")
    return staged(joined.select(F.col("node").alias("rep"), "n", (F.col("n") - F.coalesce("alone", F.lit(0))).alias("c")))


def _possible(percent: int):
    """Whether sizes and shared sizes allow two members the similarity."""
    common = F.least("c", "leader_c")
    return 100 * common >= percent * (F.col("n") + F.col("leader_n") - common)


def linked_components(members: DataFrame, docs: DataFrame, percent: int) -> DataFrame | None:
    """node, component over the links among bucket members (band, rep, holder); None without
    buckets. `rep` is a node, `holder` the id of a document with its set."""
    shared = staged(members.groupBy("band").agg(F.count(F.lit(1)).alias("held")).filter("held > 1").select("band"))
    candidates = staged(members.join(shared, "band"))
    if candidates.isEmpty():
        return None
    wanted = staged(candidates.select(F.col("holder").alias("wanted")).distinct())
    candidates = candidates.drop("holder")
    # Other texts of a wanted id come along: they have nodes of their own.
    sets = staged(full_sets(docs.join(wanted, F.col("doc_id") == F.col("wanted")).select("doc_id", "text")))
    # A set that has too few of its shingles in common with all others has no link.
    sizes = shared_sizes(sets).filter(100 * F.col("c") >= percent * F.col("n"))
    able = staged(candidates.join(sizes, "rep"))
    # The leader is the member with the least of its own, the most central one.
    own_share = (F.col("n") - F.col("c")) / F.col("n")
    buckets = staged(
        able.groupBy("band")
        .agg(F.min(F.struct(own_share.alias("share"), "rep", "n", "c")).alias("first"), F.count(F.lit(1)).alias("held"))
        .filter("held > 1")
        .select(
            "band",
            F.col("first.rep").alias("leader"),
            F.col("first.n").alias("leader_n"),
            F.col("first.c").alias("leader_c"),
        )
    )
    waiting = staged(able.join(buckets, "band"))
    pairs = staged(
        waiting.filter((F.col("rep") != F.col("leader")) & _possible(percent))
        .select(F.least("rep", "leader").alias("a"), F.greatest("rep", "leader").alias("b"))
        .distinct()
    )
    links = verified(pairs, sets, percent)
    found = components(links)
    labelled = staged(
        waiting.join(found, F.col("rep") == F.col("node"), "left").select(
            "band", "rep", F.coalesce("component", "rep").alias("component")
        )
    )
    split = staged(
        labelled.groupBy("band")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .filter("low < high")
        .select("band")
    )
    unsettled = staged(labelled.join(split, "band").select("rep", "component").distinct())
    if unsettled.isEmpty():
        return found
    rest = _sharing_rare(unsettled, sets, percent).join(pairs, ["a", "b"], "left_anti")
    rest = staged(still_possible(rest, sets, percent))
    return components(links.union(verified(rest, sets, percent)))


def _sharing_rare(unsettled: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) from different components (rep, component) that can still be linked.

    Order the shingles of each set from rare to frequent. Sets of sizes n and m with the
    similarity have at least `common` = percent * (n + m) / (100 + percent) shingles in common,
    so the first n - common + 1 of one and m - common + 1 of the other share one. Far from
    their centre, near copies begin with shingles of their own changes, which few share. Of
    the sets that share a shingle, only those outside the most frequent component search.
    """
    shingles = staged(_exploded(sets.join(unsettled, F.col("node") == F.col("rep"), "left_semi")).distinct())
    frequency = staged(shingles.groupBy("shingle").agg(F.count(F.lit(1)).alias("held")))
    ordered = (
        shingles.join(frequency, "shingle")
        .groupBy("node")
        .agg(F.sort_array(F.collect_list(F.struct("held", "shingle"))).alias("all"))
        .withColumn("n", F.size("all"))
        .withColumn("longest", (F.col("n") - F.ceil(F.col("n") * percent / 100) + 1).cast("int"))
    )
    prefixes = staged(
        ordered.select("node", "n", F.posexplode(F.slice("all", F.lit(1), F.col("longest"))).alias("pos", "entry"))
        .select(F.col("node").alias("rep"), "n", "pos", F.col("entry.shingle").alias("shingle"))
        .join(unsettled, "rep")
    )
    parts = prefixes.groupBy("shingle", "component").agg(F.count(F.lit(1)).alias("held"))
    largest = staged(
        parts.groupBy("shingle")
        .agg(F.max_by("component", "held").alias("largest"), F.count(F.lit(1)).alias("parts"))
        .filter("parts > 1")
        .drop("parts")
    )
    met = staged(prefixes.join(largest, "shingle"))
    searching = met.filter("component <> largest").select(
        "shingle",
        F.col("rep").alias("other"),
        F.col("component").alias("other_component"),
        F.col("n").alias("m"),
        F.col("pos").alias("other_pos"),
    )
    common = F.ceil((F.col("n") + F.col("m")) * percent / (100 + percent))
    return (
        met.join(searching, "shingle")
        .filter(
            (F.col("component") != F.col("other_component"))
            & (F.col("pos") <= F.col("n") - common)
            & (F.col("other_pos") <= F.col("m") - common)
        )
        .select(F.least("rep", "other").alias("a"), F.greatest("rep", "other").alias("b"))
        .distinct()
    )


def _grouped(source: DataFrame, percent: int) -> tuple[DataFrame, DataFrame | None, DataFrame]:
    """Sketches, node -> component (None without buckets), and the classes of equal sets."""
    sketched = staged(sketches(source, percent))
    able = sketched.filter("n_shingles > 0 and doc_id is not null")
    classes = staged(able.groupBy("s1", "s2").agg(F.min("doc_id").alias("rep")))
    members = (
        able.join(classes, ["s1", "s2"])
        .filter(F.col("doc_id") == F.col("rep"))
        .select(F.explode("bands").alias("band"), F.col("s1").alias("rep"), F.col("doc_id").alias("holder"))
        .distinct()
    )
    return sketched, linked_components(members, source.select("doc_id", "text"), percent), classes


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", percent: int = 85
) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable by links), kept."""
    source = narrowed(docs, doc_id=id_column, text=text_column)
    sketched, found, classes = _grouped(source, percent)
    rows = sketched.join(classes, ["s1", "s2"], "left").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("rep")).alias("rep"), F.col("s1").alias("own")
    )
    if found is None:
        rows = rows.withColumn("component", F.lit(None).cast("long"))
    else:
        ids = found.join(classes, F.col("node") == F.col("s1")).groupBy("component").agg(F.min("rep").alias("smallest"))
        named = found.join(staged(ids), "component").select("node", F.col("smallest").alias("component"))
        rows = rows.join(named, F.col("own") == F.col("node"), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep", "doc_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def one_of_each_group(docs: DataFrame, percent: int = 80) -> DataFrame:
    """The rows of `docs` (doc_id, text and others) that stay when one of each group of near
    duplicates does, with all their columns.

    Of a group the row with the smallest id stays, then with the smallest digest of its text, then
    the first in order of its other columns, so also of rows that repeat id and text one stays.
    Rows without an id or without a word are in no group and stay.
    """
    digest = F.md5(F.coalesce("text", F.lit("")).cast("binary"))
    alone = F.col("doc_id").isNull() | ~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    dealt = docs.filter(~alone).withColumn("__digest", digest)
    source = dealt.select("doc_id", "text")
    sketched, found, _ = _grouped(source, percent)
    node = F.col("s1")
    if found is None:
        groups = sketched.select("doc_id", "row", node.alias("group"))
    else:
        groups = sketched.join(found, node == F.col("node"), "left").select(
            "doc_id", "row", F.coalesce("component", node).alias("group")
        )
    first = groups.groupBy("group").agg(F.min(F.struct("doc_id", "row")).alias("first"))
    staying = first.select(F.col("first.doc_id").alias("__id"), F.col("first.row").alias("__row")).distinct()
    met = dealt.join(staying, (F.col("doc_id") == F.col("__id")) & (F.col("__digest") == F.col("__row")), "left_semi")
    others = [F.col(quoted(name)) for name in docs.columns if name not in ("doc_id", "text")]
    rank = Window.partitionBy("doc_id", "__digest").orderBy(*(others or [F.lit(0)]))
    one = met.withColumn("__rank", F.row_number().over(rank)).filter("__rank = 1").select(docs.columns)
    return one.unionAll(docs.filter(alone))
