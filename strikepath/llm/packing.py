"""Packing of tokenised documents into windows by non-negative least squares.

1. Each document is encoded once and cut every ``window`` ids; what is left over
   is its remainder. Only the histogram of piece lengths (at most ``window``
   counts) goes to the driver.
2. Shallow combinations of up to three lengths that fill a window exactly are
   enumerated; non-negative least squares fits how often each should be used to
   the histogram; the counts are rounded down.
3. What the rounding leaves is packed greedily, lots of equal pieces at a time:
   the longest piece, then the longest that still fit, and a piece is cut where
   nothing fits the gap. So only the last window can have padding.
4. Pieces are ranked within their length, in two levels so that one common
   length is spread over many tasks, and look their place up in the plan.

Defined results: a null or empty text is the end id alone; equal rows are packed
each for itself; an empty input gives no row; further columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strikepath.llm.common import pick, slices, stored, texts_of

WINDOW = 1024
END_ID = 0
BUCKETS = 4096
PIECES = "doc_id bigint, start bigint, length int, crc bigint, doc_tokens bigint, ids binary"
#: The split pattern of the public byte-level vocabulary (a fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PLACED = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


class Encoder:
    """Ids of byte-level BPE texts as little-endian unsigned 32-bit bytes.

    A text is split before every space, where the vocabulary's own pattern
    always splits too, and each such word is encoded once and kept. Texts in
    which a space stands between white space, where that does not hold, are
    encoded whole.
    """

    MIXED = re.compile(r"\s (?=\s|\Z)")

    def __init__(self, vocabulary: str, kept: int = 400_000):
        import json

        import tiktoken

        with open(vocabulary, encoding="utf-8") as f:
            data = json.load(f)
        byte_of = _byte_alphabet()
        ranks = {bytes(byte_of[c] for c in token): i for token, i in data["model"]["vocab"].items() if token not in _added(data)}
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.special_pattern = re.compile("|".join(map(re.escape, self.special)) or "(?!)")
        self.plain = tiktoken.Encoding("pack", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, i in ranks.items():
            self.lengths[i] = len(token)
        self.kept = kept
        self.cache: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return np.array(self.plain.encode_ordinary(text), "<u4").tobytes()

    def _learn(self, words: set[str]) -> None:
        """Encode unseen words, each after a space: in one go, as none of them joins with what stands before."""
        joined = [w for w in words if w and not w[-1].isspace()]
        for w in words.difference(joined):
            self.cache[w] = self._whole(" " + w)
        if joined:
            ids = np.array(self.plain.encode_ordinary(" " + " ".join(joined)), "<u4")
            ends = np.cumsum(self.lengths[ids])
            cuts = np.searchsorted(ends, np.cumsum([1 + len(w.encode()) for w in joined])) + 1
            data, at = ids.tobytes(), 0
            for w, end in zip(joined, cuts.tolist(), strict=True):
                self.cache[w] = data[4 * at : 4 * end]
                at = end

    def _ordinary(self, texts: list[str]) -> list[bytes]:
        if len(self.cache) > self.kept:
            self.cache.clear()
        split = [None if self.MIXED.search(t) else t.split(" ") for t in texts]
        unseen: set[str] = set()
        for words in split:
            if words:
                unseen.update(words[1:])
        unseen.difference_update(self.cache)
        self._learn(unseen)
        get = self.cache.__getitem__
        out = [
            self._whole(t) if words is None else self._whole(words[0]) + b"".join(map(get, words[1:]))
            for t, words in zip(texts, split, strict=True)
        ]
        for w in unseen:
            if len(w) > 100:
                del self.cache[w]
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids; names of special tokens in a text are those tokens."""
        special = {i for i, t in enumerate(texts) if self.special_pattern.search(t)}
        plain = iter(self._ordinary([t for i, t in enumerate(texts) if i not in special]))
        return [self._mixed(t) if i in special else next(plain) for i, t in enumerate(texts)]

    def _mixed(self, text: str) -> bytes:
        out, at = [], 0
        for m in self.special_pattern.finditer(text):
            out += [self._whole(text[at : m.start()]), np.array([self.special[m[0]]], "<u4").tobytes()]
            at = m.end()
        return b"".join([*out, self._whole(text[at:])])


def _added(data: dict) -> set[str]:
    return {t["content"] for t in data["added_tokens"]}


def _byte_alphabet() -> dict[str, int]:
    """Printable characters that stand for bytes in byte-level vocabularies: printable Latin-1 for itself, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


_encoders: dict[str, Encoder] = {}


def encoder(vocabulary: str) -> Encoder:
    """One encoder for each Python worker."""
    if vocabulary not in _encoders:
        _encoders[vocabulary] = Encoder(vocabulary)
    return _encoders[vocabulary]


def _cut(vocabulary: str, window: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int32()), ("crc", pa.int64()), ("doc_tokens", pa.int64()), ("ids", pa.binary())])
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode
        for batch in slices(batches, rows=4000, chars=4_000_000):
            rows = []
            for doc, ids in zip(batch.column("doc_id").to_pylist(), encode(texts_of(batch)), strict=True):
                ids += end
                for at in range(0, len(ids), 4 * window):
                    part = ids[at : at + 4 * window]
                    n = len(part) // 4
                    rows.append((doc, at // 4, n, zlib.crc32(part), len(ids) // 4, part if n < window else None))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return run


def pieces(documents: DataFrame, vocabulary: str, window: int = WINDOW) -> DataFrame:
    """Documents' ids, each with the end id, cut every ``window`` ids; ``ids`` is kept for remainders, which may be cut again."""
    documents = pick(documents, {"doc_id": "bigint", "text": "string"})
    return documents.mapInArrow(_cut(vocabulary, window), PIECES)


def combinations(lengths: np.ndarray, window: int) -> np.ndarray:
    """All ways to fill the window exactly with one, two or three of the given lengths (ascending; 0 pads)."""
    have = np.zeros(window + 1, bool)
    have[lengths] = True
    rows = [np.array([[window, 0, 0]])] if have[window] else []
    short = lengths[lengths < window]
    pair = short[have[window - short] & (2 * short <= window)]
    rows.append(np.stack([pair, window - pair, np.zeros_like(pair)], 1))
    for a in short[3 * short <= window]:
        b = short[(short >= a) & (2 * short <= window - a)]
        b = b[have[window - a - b]]
        rows.append(np.stack([np.full_like(b, a), b, window - a - b], 1))
    return np.concatenate(rows) if rows else np.zeros((0, 3), np.int64)


def least_squares(combos: np.ndarray, histogram: np.ndarray, steps: int = 400) -> np.ndarray:
    """Repeats x >= 0 that bring the use of each length close to its count: accelerated projected gradient."""
    if not len(combos):
        return np.zeros(0)
    size = len(histogram)
    use = lambda x: np.bincount(combos.ravel(), np.repeat(x, combos.shape[1]), size)
    back = lambda r: r[combos].sum(1)

    def no_pad(r: np.ndarray) -> np.ndarray:
        r[0] = 0
        return r

    scale = max(1.0, float(histogram.max()))
    h = histogram / scale
    v = np.ones(len(combos))
    for _ in range(30):
        v = back(no_pad(use(v)))
        norm = np.linalg.norm(v) or 1.0
        v /= norm
    x = y = np.zeros(len(combos))
    t = 1.0
    for _ in range(steps):
        new = np.maximum(0, y - back(no_pad(use(y) - h)) / (norm * 1.02))
        s = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y, x, t = new + (t - 1) / s * (new - x), new, s
    return x * scale


@dataclass
class Plan:
    """Places: pieces of ``length`` with ranks from ``rank`` on, ``count`` of them, give their ids [cut, cut + size) to windows from ``sequence`` on, at ``offset``."""

    rows: list[tuple[int, int, int, int, int, int, int]] = field(default_factory=list)
    offsets: list[int] = field(default_factory=list)
    sequences: int = 0

    def put(self, parts: list[tuple[int, int, int, int]], count: int, strides: list[int]) -> None:
        """parts: (length, first rank, cut, size); the i-th repeat takes rank + i * stride of each."""
        at = 0
        for (length, rank, cut, size), stride in zip(parts, strides, strict=True):
            self.rows.append((length, rank, count, stride, cut, size, self.sequences))
            self.offsets.append(at)
            at += size
        self.sequences += count


def plan(histogram: dict[int, int], window: int = WINDOW) -> Plan:
    """Place every piece: fitted combinations first, the rest greedily."""
    h = np.zeros(window + 1, np.int64)
    for length, n in histogram.items():
        h[length] = n
    out, left, used = Plan(), h.copy(), np.zeros(window + 1, np.int64)
    combos = combinations(np.flatnonzero(h), window)
    repeats = np.floor(least_squares(combos, h.astype(float)) + 1e-6).astype(np.int64)
    for k in np.argsort(-repeats, kind="stable"):
        if not repeats[k]:
            break
        parts = [int(x) for x in combos[k] if x]
        n = min(int(repeats[k]), *(int(left[x]) // parts.count(x) for x in parts))
        if n > 0:
            strides = [parts.count(x) for x in parts]
            out.put([(x, int(used[x]) + parts[:i].count(x), 0, x) for i, x in enumerate(parts)], n, strides)
            for x in parts:
                left[x] -= n
                used[x] += n
    _greedy(out, left, used, window)
    return out


def _greedy(out: Plan, left: np.ndarray, used: np.ndarray, window: int) -> None:
    """Lots of equal pieces: the longest first, then the longest that fit; where none fits, the longest is cut to the gap."""
    # A lot: (size, length, first rank, stride, cut, count).
    lots = [[int(x), int(x), int(used[x]), 1, 0, int(left[x])] for x in np.flatnonzero(left)]
    by_size: dict[int, list[list[int]]] = {}

    def add(lot: list[int]) -> None:
        by_size.setdefault(lot[0], []).append(lot)

    def largest(most: int, taken: dict[int, int]) -> list[int] | None:
        for size in range(min(most, window), 0, -1):
            for lot in by_size.get(size, ()):
                if lot[5] > taken.get(id(lot), 0):
                    return lot
        return None

    for lot in lots:
        add(lot)
    while any(by_size.values()):
        gap, chosen, taken = window, [], {}
        while gap:
            lot = largest(gap, taken)
            size = lot[0] if lot else gap
            if lot is None:
                lot = largest(window, taken)
                if lot is None:
                    break
            chosen.append((lot, size))
            taken[id(lot)] = taken.get(id(lot), 0) + 1
            gap -= size
        lot_of = {id(lot): lot for lot, _ in chosen}
        n = min(lot_of[k][5] // m for k, m in taken.items())
        seen: dict[int, int] = {}
        parts, strides, rests = [], [], []
        for lot, size in chosen:
            nth, m = seen.get(id(lot), 0), taken[id(lot)]
            seen[id(lot)] = nth + 1
            rank, stride = lot[2] + nth * lot[3], lot[3] * m
            parts.append((lot[1], rank, lot[4], size))
            strides.append(stride)
            if size < lot[0]:
                rests.append([lot[0] - size, lot[1], rank, stride, lot[4] + size, n])
        out.put(parts, n, strides)
        for k, m in taken.items():
            lot = lot_of[k]
            lot[2] += n * m * lot[3]
            lot[5] -= n * m
            if not lot[5]:
                by_size[lot[0]].remove(lot)
        for rest in rests:
            add(rest)


def _ranked(parts: DataFrame) -> DataFrame:
    """Number the pieces of each length from 0: within a hashed bucket of the length, plus the sizes of the buckets before it."""
    bucketed = parts.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start", "crc"), F.lit(BUCKETS)))
    sizes = bucketed.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "start", "crc")
    return bucketed.withColumn("at", F.row_number().over(within)).join(sizes, ["length", "bucket"]).select(
        "doc_id", "start", "length", "crc", "doc_tokens", "ids", (F.col("before") + F.col("at") - 1).alias("rank")
    )


def _place(made: Plan) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    rows = np.array(made.rows, np.int64).reshape(-1, 7)
    offsets = np.array(made.offsets, np.int64)
    order = np.argsort(rows[:, 0], kind="stable")
    rows, offsets = rows[order], offsets[order]
    lo = {int(x): np.searchsorted(rows[:, 0], x, "left") for x in np.unique(rows[:, 0])}
    hi = {x: np.searchsorted(rows[:, 0], x, "right") for x in lo}
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in names]
            cols = [batch.column(c).to_pylist() for c in ("doc_id", "start", "length", "crc", "doc_tokens", "rank")]
            ids = batch.column("ids")
            for i, (doc, start, length, crc, total, rank) in enumerate(zip(*cols, strict=True)):
                r = rows[lo[length] : hi[length]]
                step = rank - r[:, 1]
                fits = np.flatnonzero((step >= 0) & (step % r[:, 3] == 0) & (step // r[:, 3] < r[:, 2]))
                for k in fits.tolist():
                    _, first, _, stride, cut, size, sequence = r[k].tolist()
                    if size != length:
                        crc = zlib.crc32(ids[i].as_py()[4 * cut : 4 * (cut + size)])
                    for c, v in zip(out, (doc, start + cut, size, crc, total, sequence + (rank - first) // stride, int(offsets[lo[length] + k])), strict=True):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=names)

    return run


def pack(documents: DataFrame, vocabulary: str, window: int = WINDOW) -> DataFrame:
    """One row for each piece: where in its document it stands, and its sequence and offset there."""
    parts = stored(pieces(documents, vocabulary, window), "pack-pieces")
    histogram = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    return _ranked(parts).mapInArrow(_place(plan(histogram, window)), PLACED)
