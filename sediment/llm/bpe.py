"""BPE encoding by speculation: propose tokens greedily, verify adjacent pairs, repair the rest.

A token list is what BPE makes of a word exactly if every two neighbours are what BPE makes of
the two together. So each distinct word is first cut by greedy longest match, then all seams
of all words are checked at once with NumPy, and only words with a failing seam go through
exact merging. Whether a seam holds is read from the two merge trees: undoing merges from the
latest to the earliest shows every pair of symbols that ever met at the seam, and the seam
fails if such a pair has a merge that ranks before the one that took either symbol away.

Texts are cut at ASCII white space: in the vocabulary read here (BPE with word ends, white space
dropped) no token reaches across it. Only the distinct chunks of a few megabytes of text are cut
into words, and only words not seen before are encoded; everything per word of the text is
NumPy. Words are remembered per worker up to `REMEMBERED`, so memory does not grow with the
corpus.

Defined results: a null or empty text has no tokens and decodes to the empty string; special
tokens written in a text become their ids, as in the library; repeated rows give equal rows;
an id may be null; an empty table gives an empty result. A tokenizer file of another kind
(`fits`) is left to the tokenizers library, without speculation. A text is held whole by one task.
"""

from __future__ import annotations

import hashlib
import json
import re
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from sediment.llm.common import LARGE_CHUNK_BYTES, map_texts, narrowed, ranges, split_words, starts_of, sums

REMEMBERED = 1_000_000

# What a tokenizer file must say for words to be cut and joined as here.
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_NORMALIZERS = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
    {"type": "Lowercase"},
]
_SPLIT = {"type": "Split", "pattern": {"Regex": _WORDS}, "behavior": "Removed", "invert": True}
_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
FITTING = {
    "normalizer": {"type": "Sequence", "normalizers": _NORMALIZERS},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [_SPLIT, _BYTES]},
    "post_processor": None,
    "decoder": None,
}
FITTING_MODEL = {
    "type": "BPE",
    "dropout": None,
    "unk_token": None,
    "continuing_subword_prefix": None,
    "byte_fallback": False,
    "ignore_merges": False,
}
FITTING_SPECIAL = {"single_word": False, "lstrip": False, "rstrip": False, "normalized": False}
NEVER = np.iinfo(np.int64).max


def byte_alphabet() -> dict[int, str]:
    """Byte-level BPE writes printable Latin-1 bytes as themselves and the others from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {**{b: chr(b) for b in printable}, **{b: chr(256 + i) for i, b in enumerate(others)}}


class MergeTable:
    """Merges as arrays: rank and halves of every token, and pairs sorted for look-up."""

    def __init__(self, vocabulary: dict[str, int], merges: list) -> None:
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        size = max(vocabulary.values()) + 1
        self.size = size
        self.rank = np.full(size, -1, np.int64)
        self.left = np.arange(size)
        self.right = np.arange(size)
        makers = np.zeros(size, np.int64)
        keys = np.zeros(len(pairs), np.int64)
        self.merged: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(pairs):
            left, right = vocabulary[a], vocabulary[b]
            token = vocabulary[a + b if not a.endswith("</w>") else a[:-4] + b]
            keys[rank] = left * size + right
            self.merged.setdefault((left, right), (rank, token))
            makers[token] += 1
            if makers[token] == 1:
                self.rank[token], self.left[token], self.right[token] = rank, left, right
        order = np.argsort(keys, kind="stable")
        self.keys, self.key_ranks = keys[order], order
        self.sound = self._sound(makers)

    def ranks_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair, NEVER where there is none."""
        if not len(self.keys):
            return np.full(len(a), NEVER)
        wanted = a * self.size + b
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.key_ranks[at], NEVER)

    def seams_hold(self, a: np.ndarray, b: np.ndarray, until: np.ndarray | None = None) -> np.ndarray:
        """Whether BPE keeps the tokens a and b apart (before the merge `until`, if given)."""
        x, y = a.copy(), b.copy()
        taken_x = np.full(len(a), NEVER) if until is None else until.copy()
        taken_y = taken_x.copy()
        # A token of the pair that is taken away by `until` is taken by that very merge.
        taken_y[taken_y < NEVER] -= 1
        holds = np.ones(len(a), bool)
        live = np.arange(len(a))
        while len(live):
            xs, ys = x[live], y[live]
            met = self.ranks_of(xs, ys)
            # Equal merges go from left to right: the seam comes after x's, before y's.
            broken = (met < taken_x[live]) & (met <= taken_y[live])
            holds[live[broken]] = False
            rank_x, rank_y = self.rank[xs], self.rank[ys]
            undo_x = rank_x > rank_y
            undo_y = ~undo_x & (rank_y >= 0)
            at = live[undo_x]
            taken_x[at], x[at] = self.rank[x[at]], self.right[x[at]]
            at = live[undo_y]
            taken_y[at], y[at] = self.rank[y[at]], self.left[y[at]]
            live = live[~broken & (undo_x | undo_y)]
        return holds

    def _sound(self, makers: np.ndarray) -> np.ndarray:
        """Tokens that BPE makes of their own text by the one merge recorded for them."""
        made = np.flatnonzero(self.rank >= 0)
        later = (self.rank[self.left[made]] < self.rank[made]) & (self.rank[self.right[made]] < self.rank[made])
        own = later & (makers[made] == 1)
        own[own] = self.seams_hold(self.left[made[own]], self.right[made[own]], self.rank[made[own]])
        sound = np.ones(self.size, bool)
        sound[made] = own
        for token in made[np.argsort(self.rank[made])]:  # halves come before the whole
            sound[token] &= sound[self.left[token]] and sound[self.right[token]]
        return sound

    def merge(self, tokens: list[int]) -> list[int]:
        """Exact BPE: the lowest-ranked pair first, of equal ones the leftmost."""
        tokens, none = list(tokens), (NEVER, -1)
        merged = self.merged
        met = [merged.get(pair, none) for pair in zip(tokens, tokens[1:])]
        while met:
            best = min(met)
            if best is none:
                break
            i = met.index(best)
            tokens[i : i + 2] = [best[1]]
            del met[i]
            if i:
                met[i - 1] = merged.get((tokens[i - 1], tokens[i]), none)
            if i < len(met):
                met[i] = merged.get((tokens[i], tokens[i + 1]), none)
        return tokens


class Encoder:
    """Encodes chunks without white space; made from the text of a tokenizer file."""

    def __init__(self, source: str) -> None:
        spec = json.loads(source)
        model = spec["model"]
        library = Tokenizer.from_str(source)
        self.normalizer, self.pre_tokenizer = library.normalizer, library.pre_tokenizer
        self.suffix = model.get("end_of_word_suffix") or ""
        self.vocabulary: dict[str, int] = model["vocab"]
        self.table = MergeTable(self.vocabulary, model["merges"])
        self.proposable = {t: i for t, i in self.vocabulary.items() if self.table.sound[i]}
        # Longest proposable token by its first characters: where greedy matching starts.
        self.reach: dict[str, int] = {}
        for token in self.proposable:
            plain = token.removesuffix(self.suffix) or token
            self.reach[plain[:3]] = max(self.reach.get(plain[:3], 0), len(plain))
        self.strings = {i: t for t, i in self.vocabulary.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings.update({i: t for t, i in self.special.items()})
        self.special_pattern = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.alphabet = str.maketrans(byte_alphabet())
        # The file's own pattern, for lower-case ASCII; a line end closes each chunk.
        self.ascii_words = re.compile(r"\n|'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9\n]+")
        spaced = [f" {self.strings.get(i, '')}".encode() for i in range(max(self.strings) + 1)]
        self.string_widths = np.array([len(t) for t in spaced])
        self.string_starts = starts_of(self.string_widths)
        self.string_bytes = np.frombuffer(b"".join(spaced), np.uint8)
        self.repaired = 0
        self.forget()

    def forget(self) -> None:
        """Words seen so far: their number, and where their ids stand in `held`."""
        self.words: dict[str, int] = {}
        self.held = np.zeros(0, np.int64)
        self.widths = np.zeros(0, np.int64)
        for i in sorted(self.special.values()):
            self.keep([f"<{i}> "], [[i]])  # the blank: no word of the byte alphabet is like it

    def keep(self, words: list[str], ids: list[list[int]]) -> None:
        self.words.update(zip(words, range(len(self.words), len(self.words) + len(words))))
        self.held = np.concatenate([self.held, np.array([i for own in ids for i in own], np.int64)])
        self.widths = np.concatenate([self.widths, np.array([len(own) for own in ids], np.int64)])

    def words_of(self, text: str) -> list[str]:
        """The words of any text, in the byte alphabet."""
        return [word for word, _ in self.pre_tokenizer.pre_tokenize_str(self.normalizer.normalize_str(text))]

    def words_of_ascii(self, chunks: list[str]) -> list[list[str]]:
        """The words of each chunk, cut in one pass."""
        result: list[list[str]] = [[]]
        for word in self.ascii_words.findall("\n".join(chunks).lower()):
            if word == "\n":
                result.append([])
            else:
                result[-1].append(word if word.isprintable() else word.translate(self.alphabet))
        return result

    def words_of_others(self, chunks: list[str]) -> list[list[str]]:
        """The same for chunks with other characters but no white space of any kind."""
        joined = self.normalizer.normalize_str(" ".join(chunks))
        ends = np.cumsum([len(chunk) + 1 for chunk in joined.split(" ")])
        found = self.pre_tokenizer.pre_tokenize_str(joined)
        owners = np.searchsorted(ends, [start for _, (start, _) in found], side="right")
        result: list[list[str]] = [[] for _ in chunks]
        for (word, _), owner in zip(found, owners.tolist(), strict=True):
            result[owner].append(word)
        return result

    def proposed(self, word: str) -> list[int]:
        """Greedy longest match."""
        tokens, start, end, get = [], 0, len(word), self.proposable.get
        while start < end:
            head = word[start : start + 3]
            # A token can also be shorter than the characters looked at.
            reach = max(self.reach.get(head, 0), min(len(head), 2))
            stop = min(end, start + reach)
            token = get(word[start:] + self.suffix) if stop == end else None
            if token is None:
                stop = min(stop, end - 1)
                while (token := get(word[start:stop])) is None:
                    stop -= 1
            else:
                stop = end
            tokens.append(token)
            start = stop
        return tokens

    def symbols(self, word: str) -> list[int]:
        return [self.vocabulary[c] for c in word[:-1]] + [self.vocabulary[word[-1] + self.suffix]]

    def learn_words(self, new: list[str]) -> None:
        """Encode words: propose all, check all seams at once, repair where one fails."""
        proposals = [self.proposed(word) for word in new]
        lengths = np.array([len(p) for p in proposals])
        tokens = np.array([t for p in proposals for t in p], np.int64)
        owner = np.repeat(np.arange(len(new)), lengths)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        pairs, place = np.unique(tokens[inner] * self.table.size + tokens[inner + 1], return_inverse=True)
        holds = self.table.seams_hold(pairs // self.table.size, pairs % self.table.size)[place]
        failing = np.unique(owner[inner[~holds]])
        for i in failing.tolist():
            proposals[i] = self.table.merge(self.symbols(new[i]))
        self.repaired += len(failing)
        self.keep(new, proposals)

    def cut(self, chunks: list[bytes]) -> list[list[str]]:
        """The words of each chunk; a special token is the word `<id>` and a blank."""
        texts = [chunk.decode("utf-8", "replace") for chunk in chunks]
        ascii_text = [text.isascii() for text in texts]
        apart = {
            i
            for i, text in enumerate(texts)
            if ("<|" in text and self.special_pattern.search(text)) or (not ascii_text[i] and len(text.split()) != 1)
        }
        plain = [i for i in range(len(texts)) if ascii_text[i] and i not in apart]
        others = [i for i in range(len(texts)) if not ascii_text[i] and i not in apart]
        result: list[list[str]] = [[] for _ in texts]
        for indices, cutter in ((plain, self.words_of_ascii), (others, self.words_of_others)):
            if indices:
                for i, words in zip(indices, cutter([texts[i] for i in indices]), strict=True):
                    result[i] = words
        for i in apart:
            for part in self.special_pattern.split(texts[i]):
                result[i] += [f"<{self.special[part]}> "] if part in self.special else self.words_of(part)
        return result

    def encode_batch(self, texts: list[bytes]) -> list[tuple[bytes, bytes]]:
        """Ids (little-endian unsigned 32-bit) and decoded text of every text.

        The file names no decoder, so decoding joins the tokens' strings by one space.
        """
        if len(self.words) > REMEMBERED:
            self.forget()
        found = split_words(texts)
        chunk_of = found.codes
        cut = self.cut(found.distinct)
        flat = [word for words in cut for word in words]
        unknown = sorted(set(flat) - self.words.keys())
        if unknown:
            self.learn_words(unknown)
        words = np.fromiter(map(self.words.__getitem__, flat), np.int64, len(flat))
        # Ids of the distinct chunks, then of all chunks, then of the texts.
        ids = self.held[ranges(starts_of(self.widths)[words], self.widths[words])]
        chunk_widths = sums(self.widths[words], np.array([len(words) for words in cut], np.int64))
        ids = ids[ranges(starts_of(chunk_widths)[chunk_of], chunk_widths[chunk_of])]
        id_ends = np.cumsum(sums(chunk_widths[chunk_of], found.counts))
        strings = self.string_bytes[ranges(self.string_starts[ids], self.string_widths[ids])].tobytes()
        string_ends = np.concatenate(([0], np.cumsum(self.string_widths[ids])))[id_ends]
        id_bytes = ids.astype("<u4").tobytes()
        result, id_start, string_start = [], 0, 0
        for id_end, string_end in zip((4 * id_ends).tolist(), string_ends.tolist(), strict=True):
            result.append((id_bytes[id_start:id_end], strings[string_start + 1 : string_end]))
            id_start, string_start = id_end, string_end
        return result


def fits(spec: dict) -> bool:
    """Whether the file cuts and joins words as `Encoder` does, and has all bytes as tokens."""
    suffix = spec["model"].get("end_of_word_suffix") or ""
    return (
        all(spec.get(name) == value for name, value in FITTING.items())
        and all(spec["model"].get(name) == value for name, value in FITTING_MODEL.items())
        and all(token[name] == value for token in spec["added_tokens"] for name, value in FITTING_SPECIAL.items())
        and len(spec["added_tokens"]) > 0
        and bool(suffix)
        and all(c in spec["model"]["vocab"] and c + suffix in spec["model"]["vocab"] for c in byte_alphabet().values())
    )


class LibraryEncoder:
    """Any other tokenizer file is left to the tokenizers library."""

    def __init__(self, source: str) -> None:
        self.library = Tokenizer.from_str(source)
        self.library.no_padding()
        self.library.no_truncation()

    def encode_batch(self, texts: list[bytes]) -> list[tuple[bytes, bytes]]:
        found = self.library.encode_batch([text.decode("utf-8", "replace") for text in texts], add_special_tokens=False)
        decoded = self.library.decode_batch([own.ids for own in found], skip_special_tokens=False)
        return [(np.array(own.ids, "<u4").tobytes(), text.encode()) for own, text in zip(found, decoded, strict=True)]


_ENCODERS: dict[str, Encoder | LibraryEncoder] = {}


def encoder(source: str) -> Encoder | LibraryEncoder:
    """One encoder per worker process and tokenizer file."""
    key = hashlib.sha256(source.encode()).hexdigest()
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(source) if fits(json.loads(source)) else LibraryEncoder(source)
    return _ENCODERS[key]


def encoded(docs: DataFrame, tokenizer_file: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, ids (binary, little-endian unsigned 32-bit), decoded text.

    The tokenizer file is read on the driver and broadcast: its size does not depend on the data.
    """
    source = docs.sparkSession.sparkContext.broadcast(Path(tokenizer_file).read_text(encoding="utf-8"))

    def run(batch, texts):
        found = encoder(source.value).encode_batch(texts)
        ids = pa.array([f[0] for f in found], pa.binary())
        decoded = pa.array([f[1] for f in found], pa.binary()).cast(pa.string())
        yield pa.RecordBatch.from_arrays([batch.column(0), ids, decoded], ["doc_id", "ids", "decoded"])

    schema = "doc_id long, ids binary, decoded string"
    source_rows = narrowed(docs, doc_id=id_column, text=text_column)
    return map_texts(source_rows, "text", run, schema, LARGE_CHUNK_BYTES)
