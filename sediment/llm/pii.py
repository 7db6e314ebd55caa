"""Personal data: base patterns, and a skip-chain conditional random field that adds to them.

The base patterns find e-mail addresses, IP addresses, card numbers and phone numbers. The
field labels every candidate of a document: the base spans, whose labels are given, and looser
matches (groups of 7 to 19 digits with any separators, addresses spelled with "(at)" and
"(dot)"). A run of such groups is cut at base spans, and where groups inside it end with the
digits of a found number, these are candidates instead of the whole run. Its potentials are
log-linear and trained on the corpus, with the base labels as the teacher: how often a shape of
candidate bears a label, which labels follow each other, and how far candidates with the same
key agree (the last seven digits, or the normalised address).

How two candidates of one key are tied depends on how similar they are. A loose number repeats a
base span if its digits before those that both share are none, or zeros (a trunk prefix), or
two or three more than the whole base span has (a country code). Other digits contradict it: the
two end alike by chance, and the potential speaks against the label, as strongly as base spans
of one key rarely contradict each other.

A loose candidate that repeats a base span is counted under the label of that span. What a
shape says against a label is bounded below what one repeat says for it, so whether a repeat is
found does not depend on how many documents there are. Neighbours in the text share the chain
potential. Every loose candidate is tied to each base span of its key, however far apart and
however many; those that repeat one also to one hub of the key, which the base spans inform as
well and which makes the repeats agree. Message passing runs until the messages settle (a field
that does not within MOST_ROUNDS raises an error); a loose candidate that repeats something
found becomes a span of its kind. Only candidates that share a key with a base span can: a
number that merely repeats itself adds nothing.

Training counts over all documents; what reaches the driver is a table of shapes and labels.
Texts are read twice and nothing is shuffled but those counts.

Defined results: a null or empty text has no spans; base spans are returned whatever the field
says, also where kinds overlap; added spans overlap no base span; of kinds that share a key
equally often the first in the order of KINDS counts; repeated rows give equal rows; an id may be
null; an empty table gives an empty result. A text is held whole by one task.
"""

from __future__ import annotations

import os
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sediment.llm.common import arrow_map, map_texts, narrowed, quoted

KINDS = ("email", "ip", "card", "phone")
OTHER = len(KINDS)  # label of a candidate that is none of them
LABELS = len(KINDS) + 1
MOST_ROUNDS, CLOSE = 500, 1e-4  # message passing ends when no message moves by more than CLOSE
CHAIN = 0.5  # largest chain potential: a neighbour moves the odds of two labels by twice that
MARGIN = 0.5
LEAST_DIGITS, MOST_DIGITS, KEY_DIGITS = 7, 19, 7
COUNTRY_DIGITS = 3  # of the longest country code

DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# A match that fails from the first digit of a group fails from its others: start only there.
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DIGIT = re.compile(r"[0-9]")
GROUP = re.compile(r"[0-9]+")
NUMBER_RUN = re.compile(r"[0-9][\x20().0-9/-]*")
SPELLED_AT = re.compile(r"\x20?[(\[{]at[)\]}]\x20?")
SPELLED_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\x20?(?:[(\[{]dot[)\]}]|\.)\x20?[A-Za-z0-9-]+)+")
SPELLED_DOT = re.compile(r"\x20?(?:[(\[{]dot[)\]}]|\.)\x20?")


class Candidate(NamedTuple):
    start: int
    kind: int  # OTHER for a loose match
    end: int
    shape: str
    key: str
    digits: str  # empty for an address


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        value = int(c) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _local_start(text: str, at: int, floor: int) -> int:
    """Where the run of address characters before position `at` begins."""
    start = at
    while start > floor and text[start - 1] in LOCAL:
        start -= 1
    return start


def _addresses(text: str, marks, domain: re.Pattern) -> list[tuple[int, int]]:
    """Leftmost non-overlapping address spans around the marks (start, end)."""
    found, floor = [], 0
    for mark_start, mark_end in marks:
        if mark_start < floor:
            continue
        start = _local_start(text, mark_start, floor)
        match = domain.match(text, mark_end) if start < mark_start else None
        if match:
            found.append((start, match.end()))
            floor = match.end()
    return found


def _ip_part(part: str) -> bool:
    significant = part.lstrip("0")
    return len(significant) <= 3 and int(significant or "0") <= 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, sorted."""
    spans = []
    if "@" in text:
        marks = ((m.start(), m.end()) for m in re.finditer("@", text))
        spans += [(start, 0, end) for start, end in _addresses(text, marks, DOMAIN)]
    if DIGIT.search(text):
        spans += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(map(_ip_part, m[0].split(".")))]
        for m in CARD.finditer(text):
            digits = digits_of(m[0]) if 14 <= m.end() - m.start() <= 37 else ""
            if 14 <= len(digits) <= 19 and luhn(digits):
                spans.append((m.start(), 2, m.end()))
        if "+" in text:
            spans += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(digits_of(m[0])) <= 15]
    return sorted(spans)


def shape_and_key(text: str) -> tuple[str, str, str]:
    """What the field knows of a candidate: a coarse shape, the key that repeats share, its digits."""
    digits = digits_of(text)
    if "@" in text or SPELLED_AT.search(text):
        address = SPELLED_DOT.sub(".", SPELLED_AT.sub("@", text)).lower()
        return "address", "@" + address, ""
    groups = len(re.findall(r"[0-9]+", text))
    return f"digits {min(len(digits), MOST_DIGITS)} groups {min(groups, 5)}", digits[-KEY_DIGITS:], digits


def repeats(loose: str, base: str) -> bool:
    """Whether a loose number of the same key can be another way to write the base span."""
    shared = len(os.path.commonprefix([loose[::-1], base[::-1]]))
    before, base_before = loose[: len(loose) - shared], base[: len(base) - shared]
    return not before.strip("0") or (not base_before and len(before) <= COUNTRY_DIGITS)


def _numbers(text: str, start: int, end: int, found: dict[str, list[str]]) -> list[tuple[int, int]]:
    """Loose numbers in a stretch of groups; `found` has the reversed digits of base spans by
    key, sorted, so the one that shares most with a number stands beside its place."""
    groups = [m.span() for m in GROUP.finditer(text, start, end)]
    if not groups:
        return []
    sizes = [b - a for a, b in groups]
    digits = "".join(text[a:b] for a, b in groups)
    whole = [(groups[0][0], groups[-1][1])] if LEAST_DIGITS <= len(digits) <= MOST_DIGITS else []
    spans, low, at = [], 0, 0  # digits from `low` on are free
    for i, size in enumerate(sizes):
        at += size
        key = digits[max(low, at - KEY_DIGITS) : at]
        if len(key) < KEY_DIGITS or key not in found:
            continue
        if whole and i == len(sizes) - 1 and not spans:
            return whole
        # The fewest groups that hold all digits, from the last one back, that a found number shares.
        own = digits[max(low, at - MOST_DIGITS) : at][::-1]
        place = bisect_left(found[key], own)
        shared = max(len(os.path.commonprefix([own, other])) for other in found[key][max(0, place - 1) : place + 1])
        j, held = i, size
        while held < shared:
            j -= 1
            held += sizes[j]
        if held <= MOST_DIGITS:
            spans.append((groups[j][0], groups[i][1]))
            low = at
    return spans or whole


def candidates(text: str) -> list[Candidate]:
    """Base spans and looser matches that overlap none of them, by position."""
    found = base_spans(text)
    ends = np.maximum.accumulate([end for _, _, end in found]).tolist() if found else []
    starts = [start for start, _, _ in found]

    def free(start: int, end: int) -> bool:
        before = bisect_right(starts, end - 1)
        return not before or ends[before - 1] <= start

    loose = []
    if "at" in text and SPELLED_AT.search(text):
        marks = ((m.start(), m.end()) for m in SPELLED_AT.finditer(text))
        loose += _addresses(text, marks, SPELLED_DOMAIN)
    if DIGIT.search(text):
        known: dict[str, set[str]] = {}
        for start, kind, end in found:
            if kind:
                digits = digits_of(text[start:end])
                known.setdefault(digits[-KEY_DIGITS:], set()).add(digits[-MOST_DIGITS:][::-1])
        by_key = {key: sorted(held) for key, held in known.items()}
        for m in NUMBER_RUN.finditer(text):
            start = m.start()
            if m.end() - start < LEAST_DIGITS:
                continue
            # Between the base spans that reach into the run.
            for k in range(bisect_right(ends, start), bisect_left(starts, m.end())):
                loose += _numbers(text, start, max(start, starts[k]), by_key)
                start = max(start, min(ends[k], m.end()))
            loose += _numbers(text, start, m.end(), by_key)
    loose = [(start, OTHER, end) for start, end in loose if free(start, end)]
    return [Candidate(*span, *shape_and_key(text[span[0] : span[2]])) for span in sorted(found + loose)]


def key_groups(nodes: list[Candidate]) -> tuple[dict[str, Counter], dict[str, list[int]]]:
    """By key: kind and digits of its base spans, and the positions of its loose candidates."""
    found: dict[str, Counter] = {}
    loose: dict[str, list[int]] = {}
    for i, node in enumerate(nodes):
        if node.kind == OTHER:
            loose.setdefault(node.key, []).append(i)
        else:
            found.setdefault(node.key, Counter())[node.kind, node.digits] += 1
    return found, loose


def kinds_of(spans: Counter) -> Counter:
    """How many base spans of each kind."""
    kinds: Counter = Counter()
    for (kind, _), held in spans.items():
        kinds[kind] += held
    return kinds


def tied(node: Candidate, spans: Counter) -> tuple[Counter, Counter]:
    """Of the base spans of a loose candidate's key, the kinds that it repeats and contradicts."""
    alike = Counter({span: held for span, held in spans.items() if repeats(node.digits, span[1])})
    return kinds_of(alike), kinds_of(spans - alike)


def taught(nodes: list[Candidate]) -> list[int]:
    """The labels that training counts: of a loose candidate the most frequent kind of the base
    spans that it repeats, or OTHER without one."""
    found = key_groups(nodes)[0]

    def label(node: Candidate) -> int:
        if node.kind != OTHER or node.key not in found:
            return node.kind
        alike, _ = tied(node, found[node.key])
        return max(sorted(alike), key=alike.__getitem__) if alike else OTHER

    return [label(node) for node in nodes]


@dataclass
class Field:
    """Trained potentials."""

    shapes: dict[str, np.ndarray]
    unseen: np.ndarray
    chain: np.ndarray
    skip: np.ndarray
    against: float = -3.0  # what a base span says for its own kind to a candidate that contradicts it

    def labels(self, nodes: list[Candidate]) -> list[int]:
        """The label of every candidate by loopy belief propagation; base labels are given."""
        found, loose = key_groups(nodes)
        kinds = np.array([node.kind for node in nodes])
        touched = [i for key in found for i in loose.get(key, [])]
        if not touched:
            return kinds.tolist()
        # A hub for each key, behind the candidates. What base spans say is given, so it is added.
        unary = np.zeros((len(nodes) + len(loose), LABELS))
        unary[: len(nodes)] = [self.shapes.get(node.shape, self.unseen) for node in nodes]
        given = np.flatnonzero(kinds != OTHER)
        unary[given] = -50.0
        unary[given, kinds[given]] = 0.0
        pairs = [(i, i + 1) for i in range(len(nodes) - 1)]
        spokes = []
        for hub, (key, own) in enumerate(loose.items(), len(nodes)):
            spans = found.get(key, Counter())
            for kind, held in kinds_of(spans).items():
                unary[hub] += held * self.skip[kind]
            for i in own:
                alike, contrary = tied(nodes[i], spans)
                for kind, held in alike.items():
                    unary[i] += held * self.skip[kind]
                if alike or not spans:
                    spokes.append((i, hub))
                else:
                    for kind in contrary:
                        unary[i, kind] += self.against
        potentials = np.concatenate([np.tile(self.chain, (len(pairs), 1, 1)), np.tile(self.skip, (len(spokes), 1, 1))])
        a, b = np.array(pairs + spokes, np.int64).reshape(-1, 2).T
        # One message each way along every edge: sources, targets, potential from source to target.
        source, target = np.concatenate([a, b]), np.concatenate([b, a])
        potential = np.concatenate([potentials, potentials.transpose(0, 2, 1)])
        back = np.concatenate([np.arange(len(a)) + len(a), np.arange(len(a))])
        messages = np.zeros((len(source), LABELS))
        for _ in range(MOST_ROUNDS):
            belief = unary.copy()
            np.add.at(belief, target, messages)
            before = belief[source] - messages[back]
            sent = np.logaddexp.reduce(before[:, :, None] + potential, axis=1)
            sent -= np.logaddexp.reduce(sent, axis=1, keepdims=True)
            if np.abs(sent - messages).max(initial=0.0) < CLOSE:
                break
            messages = 0.5 * messages + 0.5 * sent  # damped: the graph has loops
        else:
            raise ArithmeticError(f"messages did not settle in {MOST_ROUNDS} rounds")
        belief = unary.copy()
        np.add.at(belief, target, messages)
        best = belief[: len(nodes)].argmax(axis=1)
        kinds[touched] = best[touched]
        return kinds.tolist()


def contradictions(spans: Counter) -> int:
    """How many base spans contradict the most frequent one of their key and kind."""
    (kind, digits), _ = max(spans.items(), key=lambda own: (own[1], own[0]))
    return sum(n for (k, d), n in spans.items() if k == kind and not repeats(d, digits) and not repeats(digits, d))


def trained(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> Field:
    """Count shapes, neighbours and agreement of repeats over all documents."""

    def run(batches):
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                nodes = candidates(text) if text else []
                labels = taught(nodes)
                counts.update(("shape", node.shape, label) for node, label in zip(nodes, labels))
                counts.update(("chain", str(x), y) for x, y in zip(labels, labels[1:]))
                for spans in key_groups(nodes)[0].values():  # of base spans with one key
                    kinds = kinds_of(spans)
                    counts["skip", "", 1] += max(kinds.values()) - 1
                    counts["skip", "", 0] += kinds.total() - max(kinds.values())
                    counts["spelling", "", 1] += max(spans.values()) - 1
                    counts["spelling", "", 0] += contradictions(spans)
        rows = [(*what, n) for what, n in counts.items()]
        columns = list(zip(*rows)) if rows else [[], [], [], []]
        types = [pa.string(), pa.string(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["part", "value", "label", "n"]
        )

    source = narrowed(docs, doc_id=id_column, text=text_column)
    partial = arrow_map(source, run, "part string, value string, label long, n long")
    rows = partial.groupBy("part", "value", "label").agg(F.sum("n").alias("n")).collect()  # shapes x labels
    shapes: dict[str, np.ndarray] = {}
    chain, agreement, spelling = np.ones((LABELS, LABELS)), np.ones(2), np.ones(2)
    for part, value, label, n in rows:
        if part == "shape":
            shapes.setdefault(value, np.ones(LABELS))[label] += n
        elif part == "chain":
            chain[int(value), label] += n
        else:
            (agreement if part == "skip" else spelling)[label] += n
    follows = np.log(chain / chain.sum(axis=1, keepdims=True)) - np.log(chain.sum(axis=0) / chain.sum())
    weight = float(np.clip(np.log(agreement[1] / agreement[0]), 3.0, 8.0))
    # Both neighbours and the shape together stay below one repeat.
    against = weight - 4 * CHAIN - MARGIN
    return Field(
        {shape: np.maximum(np.log(own / own.sum()), np.log(own.max() / own.sum()) - against) for shape, own in shapes.items()},
        np.log(np.full(LABELS, 1 / LABELS)),
        np.clip(follows, -CHAIN, CHAIN),
        weight * np.eye(LABELS),
        float(np.clip(np.log(spelling[0] / spelling[1]), -8.0, -3.0)),
    )


def redacted(text: str, spans: list[tuple[int, int, int]]) -> str:
    """Each span, or group of overlapping spans, replaced by the name of its first kind."""
    parts, done = [], 0
    for start, kind, end in spans:
        if start >= done:
            parts += [text[done:start], f"<{KINDS[kind].upper()}>"]
        done = max(done, end)
    return "".join([*parts, text[done:]])


def personal_data(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    carry: tuple[str, ...] = (),
    with_text: bool = True,
) -> DataFrame:
    """doc_id, spans (array of start, end, kind, base) and, if asked for, the redacted text; and
    the columns named by `carry`. Offsets are code points, ends exclusive."""
    field = trained(docs, id_column, text_column)
    source = docs.select(
        F.col(quoted(id_column)).alias("doc_id"),
        F.col(quoted(text_column)).alias("text"),
        F.struct([F.col(quoted(c)) for c in carry] or [F.lit(0).alias("none")]).alias("carried"),
    )
    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("base", pa.bool_())])

    def run(batch, texts):
        spans, clean = [], []
        for raw in texts:
            text = raw.decode("utf-8", "replace")
            nodes = candidates(text)
            labels = field.labels(nodes) if nodes else []
            found = [(n.start, label, n.end, n.kind != OTHER) for n, label in zip(nodes, labels) if label != OTHER]
            found.sort()
            spans.append([{"start": s, "end": e, "kind": KINDS[k], "base": base} for s, k, e, base in found])
            if with_text:
                clean.append(redacted(text, [(s, k, e) for s, k, e, _ in found]) if found else text)
        columns = [batch.column("doc_id"), pa.array(spans, pa.list_(span))]
        names = ["doc_id", "spans"]
        if with_text:
            columns, names = [*columns, pa.array(clean, pa.string())], [*names, "clean_text"]
        yield pa.RecordBatch.from_arrays([*columns, batch.column("carried")], [*names, "carried"])

    schema = "doc_id long, spans array<struct<start:int,end:int,kind:string,base:boolean>>"
    schema += (", clean_text string" if with_text else "") + f", carried {source.schema['carried'].dataType.simpleString()}"
    result = map_texts(source, "text", run, schema)
    own = ["doc_id", "spans", *(["clean_text"] if with_text else [])]
    return result.select(*own, *[F.col(f"carried.{quoted(c)}") for c in carry])


def written(spans: Column) -> Column:
    """kind:start:end of spans, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
