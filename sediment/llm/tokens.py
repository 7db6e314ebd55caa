"""Token ids of texts by byte-level BPE, for the operators that pack sequences.

The tokenizer file is one of the tokenizers library. If its ids are in the order of its merges
and no token has a second way to be made, the ids are those that tiktoken finds with the ids as
ranks, several times faster; any other file is left to the tokenizers library itself.
"""

from __future__ import annotations

import hashlib
import json
from pathlib import Path

import numpy as np
import tiktoken
from pyspark import Broadcast
from pyspark.sql import SparkSession
from tokenizers import Tokenizer

from sediment.llm.bpe import MergeTable, byte_alphabet
from sediment.llm.common import WHITESPACE, coded_ranges, ranges, starts_of, sums

# Fixed value: the pattern by which byte-level BPE cuts texts.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# A word takes one space before it, so texts cut before such spaces encode piece by piece. Bytes
# that may begin other white space than ASCII's do not count as beginning a word.
_BEGINS_WORD = np.ones(256, bool)
_BEGINS_WORD[[*WHITESPACE, *range(0x1C, 0x20), 0xC2, 0xE1, 0xE2, 0xE3]] = False


class ByteLevelTokenizer:
    """Ids of whole texts; remembers the ids of pieces, up to a fixed number of them."""

    def __init__(self, source: str) -> None:
        spec = json.loads(source)
        vocabulary, merges = spec["model"]["vocab"], spec["model"]["merges"]
        self.library = Tokenizer.from_str(source)
        self.library.no_padding()
        self.library.no_truncation()
        to_byte = {c: b for b, c in byte_alphabet().items()}
        table = MergeTable(vocabulary, merges)
        ranked = np.argsort(table.rank, kind="stable")
        plain = spec["normalizer"] is None and spec["pre_tokenizer"].get("use_regex") and len(to_byte) == 256
        self.fast = None
        if plain and table.sound.all() and (np.diff(ranked[table.rank[ranked] >= 0]) > 0).all():
            ranks = {bytes(to_byte[c] for c in token): i for token, i in vocabulary.items()}
            special = {t["content"]: t["id"] for t in spec["added_tokens"]}
            self.fast = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
            self.widths = np.zeros(max([*ranks.values(), *special.values()]) + 1, np.int64)
            for token, i in [*ranks.items(), *((t.encode(), i) for t, i in special.items())]:
                self.widths[i] = len(token)

    def ids(self, text: bytes) -> np.ndarray:
        text = text.decode("utf-8", "replace")
        if self.fast is None:
            return np.array(self.library.encode(text, add_special_tokens=False).ids, np.int64)
        return self.fast.encode_to_numpy(text, allowed_special="all").astype(np.int64)

    def encode_batch(self, texts: list[bytes], end_id: int) -> list[np.ndarray]:
        """Ids of each text followed by `end_id`.

        The distinct pieces of the batch are encoded together, and the ids cut by their widths.
        What stands before a text's first cut may begin in any way and is encoded by itself.
        """
        end = np.array([end_id], "<u4")
        joined = b"".join(texts)
        if self.fast is None or len(joined) < 2:
            return [np.append(self.ids(text), end).astype("<u4") for text in texts]
        buffer = np.frombuffer(joined, np.uint8)
        lengths = np.array([len(text) for text in texts])
        text_ends = np.cumsum(lengths)
        cut = (buffer[:-1] == 32) & _BEGINS_WORD[buffer[1:]]
        edges = np.concatenate([text_ends - lengths, text_ends - 1])
        cut[edges[edges < len(cut)]] = False  # a space that begins or ends a text
        starts = np.flatnonzero(cut)
        owner = np.searchsorted(text_ends, starts, side="right")
        ends = np.minimum(np.append(starts[1:], len(buffer))[: len(starts)], text_ends[owner])
        counts = np.bincount(owner, minlength=len(texts))
        piece_of, pieces = coded_ranges(buffer, starts, ends)
        piece_bytes = np.array([len(piece) for piece in pieces], np.int64)
        found = self.ids(b"".join(pieces))
        piece_ends = np.searchsorted(np.cumsum(self.widths[found]), np.cumsum(piece_bytes)) + 1
        piece_starts = np.concatenate(([0], piece_ends))[:-1]
        widths = (piece_ends - piece_starts)[piece_of]
        ids = found[ranges(piece_starts[piece_of], widths)].astype("<u4")
        own_ends = np.cumsum(sums(widths, counts))
        heads = np.append(starts, 0)[starts_of(counts)]
        heads = np.where(counts > 0, heads, text_ends)
        result, own_start = [], 0
        for start, head, own_end in zip((text_ends - lengths).tolist(), heads.tolist(), own_ends.tolist(), strict=True):
            result.append(np.concatenate([self.ids(joined[start:head]).astype("<u4"), ids[own_start:own_end], end]))
            own_start = own_end
        return result


_TOKENIZERS: dict[str, ByteLevelTokenizer] = {}


def shared_source(spark: SparkSession, tokenizer_file: str) -> Broadcast:
    """The file's text, broadcast: its size does not depend on the data."""
    return spark.sparkContext.broadcast(Path(tokenizer_file).read_text(encoding="utf-8"))


def tokenizer(source: str) -> ByteLevelTokenizer:
    """One tokenizer per worker process and file."""
    key = hashlib.sha256(source.encode()).hexdigest()
    if key not in _TOKENIZERS:
        _TOKENIZERS[key] = ByteLevelTokenizer(source)
    return _TOKENIZERS[key]


def piece_bounds(length: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of a document's pieces: all are full but the first, which may be shorter."""
    first = (length - 1) % capacity + 1
    return [(0, first), *((start, capacity) for start in range(first, length, capacity))]
