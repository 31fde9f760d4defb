"""Encoding and decoding with a word-end BPE vocabulary by speculate and verify.

A batch's unseen words are first split greedily into their longest vocabulary
entries. All adjacent pairs of these proposals are then checked at once, in
numpy: the merges that made the two entries are undone from the boundary
outwards, and the pair stands unless a merge across the boundary would have come
first. A word whose pairs all stand is encoded as proposed; only failing words
undergo exact merging.

Defined results: a null or empty text has no ids and decodes to the empty text;
names of special tokens in a text become those tokens; repeated rows each get a
row; an empty input gives no row; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from strikepath.llm.common import pick, slices, texts_of

ENCODED = "doc_id bigint, ids array<int>"
DIGEST = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
WORD_END = "</w>"
NEVER = 1 << 40


def byte_alphabet() -> dict[int, str]:
    """Characters that stand for bytes in byte-level vocabularies: printable Latin-1 for itself, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


class WordBpe:
    """Encoder and decoder of one vocabulary file; encoded words are kept between calls."""

    def __init__(self, vocabulary: str, kept: int = 400_000):
        with open(vocabulary, encoding="utf-8") as f:
            data = json.load(f)
        self.vocab: dict[str, int] = data["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.token = {i: t for t, i in (self.vocab | self.special).items()}
        # Every entry as it is decoded, by id.
        self.entry = np.array([self.token.get(i, "").encode() for i in range(max(self.token) + 1)], object)
        self.special_pattern = re.compile("|".join(re.escape(t) for t in self.special) or "(?!)")
        split = next(p for p in data["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = regex.compile(split["pattern"]["Regex"])
        self.bytes = byte_alphabet()
        self.library = Tokenizer.from_file(vocabulary)
        self.longest = max(len(t.removesuffix(WORD_END)) for t in self.vocab)
        # Entries that end a word, by what stands before the end mark, and the others.
        self.final = {t.removesuffix(WORD_END): i for t, i in self.vocab.items() if t.endswith(WORD_END)}
        self.inner = {t: i for t, i in self.vocab.items() if not t.endswith(WORD_END)}
        self.kept = kept
        self.known: dict[str, bytes] = {}
        self.cache: dict[str, bytes] = {}
        # Merges: rank of a pair of ids, and which pair an id is made of.
        size = max(self.vocab.values()) + 1
        self.size = size
        self.made = np.full(size, -1, np.int64)
        self.left, self.right = np.zeros(size, np.int64), np.zeros(size, np.int64)
        self.pair_ranks: dict[tuple[int, int], int] = {}
        self.made_by: dict[int, int] = {}
        for rank, pair in enumerate(data["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            x, y, z = self.vocab[a], self.vocab[b], self.vocab[a + b]
            self.pair_ranks.setdefault((x, y), rank)
            self.made_by[rank] = z
            if self.made[z] < 0:
                self.made[z], self.left[z], self.right[z] = rank, x, y
        keys = np.array([x * size + y for x, y in self.pair_ranks], np.int64)
        order = np.argsort(keys)
        self.keys, self.key_ranks = keys[order], np.array(list(self.pair_ranks.values()), np.int64)[order]

    def propose(self, word: str) -> list[int]:
        """The longest entry at each place; empty if some place has none."""
        out, at, n = [], 0, len(word)
        final, inner, longest = self.final, self.inner, self.longest
        while n - at > longest or word[at:] not in final:
            for end in range(min(n - 1, at + longest), at, -1):
                i = inner.get(word[at:end])
                if i is not None:
                    out.append(i)
                    at = end
                    break
            else:
                return []
        out.append(final[word[at:]])
        return out

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For each pair of entries, whether merging the joined symbols gives the two again."""
        a, b = a.copy(), b.copy()
        ok = np.ones(len(a), bool)
        limit = np.full(len(a), NEVER, np.int64)
        live = np.arange(len(a))
        while len(live):
            x, y = a[live], b[live]
            key = x * self.size + y
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            rank = np.where(self.keys[at] == key, self.key_ranks[at], NEVER)
            wrong = rank < limit[live]
            ok[live[wrong]] = False
            # Undo the later of the two merges; of equal ones the right is later, as merging goes from the left.
            p, q = self.made[x], self.made[y]
            go = ~wrong & (np.maximum(p, q) >= 0)
            first = go & (p > q)
            second = go & (p <= q)
            a[live[first]] = self.right[x[first]]
            limit[live[first]] = p[first]
            b[live[second]] = self.left[y[second]]
            # The pair across the boundary would come before an equal merge to its right.
            limit[live[second]] = q[second] + 1
            live = live[go]
        return ok

    def merge(self, word: str) -> list[int]:
        """Exact merging: the lowest rank first, of equal ones the leftmost."""
        ids = [self.vocab[c] for c in word[:-1]] + [self.vocab[word[-1] + WORD_END]]
        rank_of = self.pair_ranks.get
        ranks = [rank_of(p, NEVER) for p in zip(ids, ids[1:], strict=False)]
        while ranks:
            rank = min(ranks)
            if rank == NEVER:
                break
            k = ranks.index(rank)
            ids[k : k + 2] = [self.made_by[rank]]
            del ranks[k]
            if k < len(ranks):
                ranks[k] = rank_of((ids[k], ids[k + 1]), NEVER)
            if k:
                ranks[k - 1] = rank_of((ids[k - 1], ids[k]), NEVER)
        return ids

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Ids of byte-alphabet words: proposals where all pairs stand, else exact merging."""
        proposed = [self.propose(w) for w in words]
        counts = np.array([max(0, len(p) - 1) for p in proposed], np.int64)
        a = np.array([i for p in proposed for i in p[:-1]], np.int64)
        b = np.array([i for p in proposed for i in p[1:]], np.int64)
        pairs, back = np.unique(a * self.size + b, return_inverse=True)
        fails = ~self.compatible(pairs // self.size, pairs % self.size)[back] if len(a) else np.zeros(0, bool)
        failed = np.bincount(np.repeat(np.arange(len(words)), counts), fails, len(words)) > 0 if len(a) else np.zeros(len(words), bool)
        return [self.merge(w) if bad or not p else p for w, p, bad in zip(words, proposed, failed.tolist(), strict=True)]

    def _pieces(self, chunk: str) -> list[str]:
        if not chunk.isascii() and any(unicodedata.category(c) == "Cn" for c in chunk):
            # Characters too new for Python's tables: the library's own tables split these.
            text = self.library.normalizer.normalize_str(chunk)
            return [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(text)]
        # Lower case goes character by character: sigma has one form only.
        text = unicodedata.normalize("NFC", chunk) if not chunk.isascii() else chunk
        text = text.replace("Σ", "σ").lower()
        alphabet = self.bytes
        return ["".join([alphabet[b] for b in w.encode()]) for w in self.pattern.findall(text)]

    def _learn(self, chunks: set[str]) -> None:
        pieces = {c: self._pieces(c) for c in chunks}
        if len(self.known) > self.kept:
            self.known.clear()
        ids = self.known
        words = list({w for p in pieces.values() for w in p}.difference(ids))
        for w, own in zip(words, self.encode_words(words), strict=True):
            ids[w] = np.array(own, "<u4").tobytes()
        for c, p in pieces.items():
            self.cache[c] = b"".join([ids[w] for w in p])

    def _plain(self, texts: list[str]) -> list[bytes]:
        """Ids of texts without special tokens. A space always ends a word, so texts go chunk by chunk."""
        if len(self.cache) > self.kept:
            self.cache.clear()
        split = [t.split(" ") for t in texts]
        unseen = set().union(*split).difference(self.cache)
        self._learn(unseen)
        get = self.cache.__getitem__
        out = [b"".join(map(get, chunks)) for chunks in split]
        for c in unseen:
            if len(c) > 100:
                del self.cache[c]
        return out

    def encode_ids(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        special = [bool(self.special_pattern.search(t)) for t in texts]
        plain = iter(self._plain([t for t, s in zip(texts, special, strict=True) if not s]))
        return [self._mixed(t) if s else next(plain) for t, s in zip(texts, special, strict=True)]

    def encode(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """Each text's ids, and the text decoded from them in UTF-8."""
        return [(ids, self.decode_ids(ids)) for ids in self.encode_ids(texts)]

    def _mixed(self, text: str) -> bytes:
        parts, at = [], 0
        for m in self.special_pattern.finditer(text):
            parts += self._plain([text[at : m.start()]])
            parts.append(np.array([self.special[m[0]]], "<u4").tobytes())
            at = m.end()
        return b"".join([*parts, *self._plain([text[at:]])])

    def decode_ids(self, ids: bytes) -> bytes:
        """Entries joined by spaces, as the vocabulary file names no decoder."""
        return b" ".join(self.entry[np.frombuffer(ids, "<u4")].tolist())

    def decode(self, ids: list[int]) -> str:
        """The text of ids, unknown ones left out."""
        return self.decode_ids(np.array([i for i in ids if i in self.token], "<u4").tobytes()).decode()


_encoders: dict[str, WordBpe] = {}


def encoder(vocabulary: str) -> WordBpe:
    """One encoder for each Python worker."""
    if vocabulary not in _encoders:
        _encoders[vocabulary] = WordBpe(vocabulary)
    return _encoders[vocabulary]


def _batches(vocabulary: str, make: Callable[[WordBpe, bytes], tuple], types: list[pa.DataType], names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, rows=2000, chars=8_000_000):
            bpe = encoder(vocabulary)
            rows = [make(bpe, ids) for ids in bpe.encode_ids(texts_of(batch))]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=["doc_id", *names])

    return run


def encode(documents: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, ids) of whole texts."""
    make = lambda _, ids: (np.frombuffer(ids, "<u4").astype(np.int32),)
    run = _batches(vocabulary, make, [pa.list_(pa.int32())], ["ids"])
    return pick(documents, {"doc_id": "bigint", "text": "string"}).mapInArrow(run, ENCODED)


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, text) of (doc_id, ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, rows=2000):
            texts = [encoder(vocabulary).decode(x or []) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return pick(encoded, {"doc_id": "bigint", "ids": "array<int>"}).mapInArrow(run, "doc_id bigint, text string")


def round_trip(documents: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): ids and the text decoded from them, as digests."""
    make = lambda bpe, ids: (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(bpe.decode_ids(ids)).hexdigest())
    run = _batches(vocabulary, make, [pa.int64(), pa.string(), pa.string()], ["n_tokens", "ids_sha256", "decoded_sha256"])
    return pick(documents, {"doc_id": "bigint", "text": "string"}).mapInArrow(run, DIGEST)
