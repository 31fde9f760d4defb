"""Removal of repeated strings by suffix arrays.

A byte goes if a string of ``WINDOW`` bytes that covers it also starts in a
document with a smaller doc_id; all is judged on the input.

1. Documents are stored in batches of about ``BATCH`` bytes. In each window the
   ``ANCHOR`` bytes with the lowest hash are its anchor. Windows in a row with
   one anchor make a string, so equal windows lie in strings with equal anchors,
   in whatever documents they are.
2. Each batch names its different strings, by hashes of anchor and string, with
   the smallest document that has them. Brought together by anchor, that gives
   each string's first holder, and tells which anchors only one document has:
   those are done. An anchor with one string only is in order as it is.
3. Strings that differ though their anchors agree are fetched from their first
   holders and form a block. A suffix array of each block (``suffixes.py``) puts
   equal windows side by side, and the smallest document among them is the
   window's first holder. An anchor with more than ``LARGEST`` strings would make
   too large a block: its strings are cut into single windows, which are brought
   together by their own bytes.
4. A string whose first holder is smaller than the document goes whole. The first
   holder itself loses the windows that a smaller document has in another string.

A batch asks once however many of its documents hold a string, and gets one
answer. Equal strings are those whose 64-bit and 32-bit hashes both agree.

Defined results: a null text is empty; rows that share a doc_id are versions of
one document, never compared with each other, each with its own result; rows
without a doc_id come last of all and count as one such document (the largest
bigint counts as null); what is left may end inside a character, so it is given
as bytes; empty input gives no row; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strikepath.llm.common import pick, small_transfers, stored
from strikepath.llm.suffixes import suffix_order

WINDOW = 50
ANCHOR = 20
#: Of a window's other bytes, so many at least lie side by side on one side of its anchor.
SIDE = (WINDOW - ANCHOR) // 2
#: Bytes of a batch, and of a part of a longer text.
BATCH = 1 << 19
#: Bytes of text per bucket of anchors.
BUCKET = 8 << 20
#: Different strings of one anchor that are ordered in one block, some 2 MB of them.
LARGEST = 32_768
#: Bytes of blocks that are ordered together.
TOGETHER = 1 << 20
LAST = (1 << 63) - 1
#: Odd, so that its powers have inverses modulo 2**64.
BASE = 0x9E3779B97F4A7C15
POSITION = np.uint64((1 << 24) - 1)
#: What a batch is asked: to cut the string from later documents, to send it to a block, to send its windows.
CUT, BLOCK, WINDOWS = 1, 2, 4


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(BASE)
    return values ^ (values >> np.uint64(29))


@lru_cache(maxsize=2)
def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Keyed:
    """Pieces of texts with hashes that tell which are equal (``key``) and which may share something (``anchor``)."""

    text: np.ndarray
    start: np.ndarray
    more: np.ndarray
    anchor: np.ndarray
    key: np.ndarray

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """The pieces in order of anchor and key, and where each different one begins in that order."""
        order = np.lexsort((self.key, self.anchor))
        anchor, key = self.anchor[order], self.key[order]
        new = np.ones(len(order), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (key[1:] != key[:-1])
        return order, np.flatnonzero(new)


class Strings(Keyed):
    """The strings of some texts: which text, where in it, how many windows beyond the first, hashes of anchor and string, and where its anchor is."""

    def __init__(self, texts: list[bytes]):
        parts = []
        for k, data in enumerate(texts):
            # Parts of a long text overlap so that each window lies in one of them.
            for at in range(0, max(0, len(data) - WINDOW + 1), BATCH):
                parts.append((k, at, data[at : at + BATCH + WINDOW - 1]))
        found = [np.empty((6, 0), np.uint64)]
        while parts:
            size, n = 0, 0
            while n < len(parts) and (not n or size + len(parts[n][2]) <= 2 * BATCH):
                size, n = size + len(parts[n][2]), n + 1
            found.append(_strings(parts[:n]))
            parts = parts[n:]
        columns = np.concatenate(found, axis=1)
        self.text, self.start, self.more = (columns[k].astype(np.int64) for k in range(3))
        self.anchor, self.key, self.offset = columns[3].astype(np.uint32), columns[4], columns[5].astype(np.int64)


def _strings(parts: list[tuple[int, int, bytes]]) -> np.ndarray:
    sizes = np.array([len(p[2]) for p in parts])
    data = np.frombuffer(b"".join(p[2] for p in parts), np.uint8)
    n, room = len(data), 1 << max(16, len(data).bit_length())
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, room)[:n], out=sums[1:])
    inverse = powers(pow(BASE, -1, 1 << 64), room)
    anchors = mixed((sums[ANCHOR:] - sums[:-ANCHOR]) * inverse[: n - ANCHOR + 1])
    # The lowest anchor of every window with its position in the low bits, the leftmost of equal ones.
    low = (anchors & ~POSITION) | np.arange(len(anchors), dtype=np.uint64)
    width, length = WINDOW - ANCHOR + 1, 1
    while length < width:
        step = min(length, width - length)
        low = np.minimum(low[:-step], low[step:])
        length += step
    at = (low & POSITION).astype(np.int64)
    ends = np.cumsum(sizes)
    part = np.repeat(np.arange(len(parts)), sizes)
    whole = part[: len(at)] == part[WINDOW - 1 :]
    # A change of part always lies between two windows that are whole.
    begins = whole.copy()
    begins[1:] &= (at[1:] != at[:-1]) | ~whole[:-1]
    start = np.flatnonzero(begins)
    last = np.minimum(np.append(start[1:] - 1, n), ends[part[start]] - WINDOW)
    more = last - start
    key = mixed((sums[last + WINDOW] - sums[start]) * inverse[start] + more.astype(np.uint64))
    numbers = np.array([p[0] for p in parts], np.uint64), (np.array([p[1] for p in parts]) - (ends - sizes)).astype(np.int64)
    name = mixed(anchors[at[start]] ^ np.uint64(BASE)) >> np.uint64(32)
    return np.stack([numbers[0][part[start]], (start + numbers[1][part[start]]).astype(np.uint64), more.astype(np.uint64), name, key, (at[start] - start).astype(np.uint64)])


def _in_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ids: list[int | None] = []
    texts: list[bytes] = []
    size = 0

    def closed() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([ids], pa.list_(pa.int64())), pa.array([texts], pa.list_(pa.binary()))], names=["ids", "texts"])

    for batch in batches:
        for doc_id, data in zip(batch.column("doc_id"), batch.column("data"), strict=True):
            ids.append(doc_id.as_py())
            texts.append(data.as_py() or b"")
            size += len(texts[-1])
            if size >= BATCH or len(ids) == 10_000:
                yield closed()
                ids, texts, size = [], [], 0
    if ids:
        yield closed()


def _places(ids: list[int | None]) -> np.ndarray:
    return np.array([LAST if i is None else i for i in ids], np.int64)


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]


def by_bucket(strings: Keyed, order: np.ndarray, first: np.ndarray, buckets: int) -> list[tuple[int, np.ndarray]]:
    """Numbers of the different strings by bucket of their anchors."""
    bucket = strings.anchor[order[first]] % np.uint32(buckets)
    by = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[by].astype(np.int64), prepend=-1))
    return [(int(bucket[x[0]]), x) for x in np.split(by, cuts[1:])] if len(by) else []


def planes(values: np.ndarray) -> bytes:
    """Whole numbers from their least on, equal bytes of all of them together: near numbers then shrink well."""
    least = values.min()
    return least.tobytes() + (values - least).view(np.uint8).reshape(-1, 8).T.tobytes()


def from_planes(data: bytes) -> np.ndarray:
    least = np.frombuffer(data, np.int64, 1)
    return np.frombuffer(data, np.uint8, offset=8).reshape(8, -1).T.copy().view(np.int64).ravel() + least


_ASKED = "batch bigint, bucket int, anchors binary, keys binary, holders binary, several binary"
ANSWER = "batch bigint, bucket int, numbers binary, holders binary, tasks binary"


def _asking(buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _each(batches):
            strings = Strings(row["texts"])
            if not len(strings.key):
                continue
            order, first = strings.distinct()
            places = _places(row["ids"])[strings.text[order]]
            holders = np.minimum.reduceat(places, first)
            several = (np.maximum.reduceat(places, first) > holders).astype(np.uint8)
            out = [
                (row["batch"], b, strings.anchor[order[first[x]]].tobytes(), strings.key[order[first[x]]].tobytes(), planes(holders[x]), several[x].tobytes())
                for b, x in by_bucket(strings, order, first, buckets)
            ]
            kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=["batch", "bucket", "anchors", "keys", "holders", "several"])

    return run


def verdicts(asked: pa.Table, largest: int) -> pa.Table:
    """Of one bucket: what each batch is to do with which of the strings it named."""
    def column(name: str, kind: type) -> np.ndarray:
        return np.frombuffer(b"".join(asked.column(name).to_pylist()), kind)

    anchor, key, several = column("anchors", np.uint32), column("keys", np.uint64), column("several", np.uint8)
    holder = np.concatenate([from_planes(x) for x in asked.column("holders").to_pylist()])
    sizes = np.array([len(x) // 4 for x in asked.column("anchors").to_pylist()])
    order = np.lexsort((key, anchor))
    a, k = anchor[order], key[order]
    new_anchor = np.append(True, a[1:] != a[:-1])
    new = new_anchor | np.append(True, k[1:] != k[:-1])
    first = np.flatnonzero(new)
    string = np.cumsum(new) - 1
    least = np.minimum.reduceat(holder[order], first)
    most = np.maximum.reduceat(holder[order], first)
    many = np.maximum.reduceat(several[order], first) | (most > least)
    heads = np.flatnonzero(new_anchor[first])
    n = np.diff(heads, append=len(first))
    shared = np.maximum.reduceat(many, heads).astype(bool) | (np.minimum.reduceat(least, heads) < np.maximum.reduceat(least, heads))
    task = np.where(shared & (n > 1), np.where(n > largest, WINDOWS, BLOCK), 0)
    task, own = np.repeat(task, n)[string], least[string]
    cut = (holder[order] > own) | (several[order] > 0)
    tasks = np.where(cut, CUT, 0) | np.where(holder[order] == own, task, 0)
    answer = np.zeros(len(order), np.uint8)
    owner = np.zeros(len(order), np.int64)
    answer[order], owner[order] = tasks, own
    out: dict[str, list] = {"batch": [], "bucket": [], "numbers": [], "holders": [], "tasks": []}
    at = 0
    for batch, bucket, size in zip(asked.column("batch").to_pylist(), asked.column("bucket").to_pylist(), sizes, strict=True):
        told = np.flatnonzero(answer[at : at + size])
        if len(told):
            for c, x in zip(out, (batch, bucket, told.astype(np.uint32).tobytes(), planes(owner[at + told]), answer[at + told].tobytes()), strict=True):
                out[c].append(x)
        at += size
    kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
    return pa.table({c: pa.array(x, t) for (c, x), t in zip(out.items(), kinds, strict=True)})


_FOUND = "batch bigint, doc int, ranges array<struct<first:bigint,end:bigint>>, anchor bigint, holder bigint, task int, starts array<bigint>, offset int, data binary"
_RANGES = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
_FOUND_KINDS = (pa.int64(), pa.int32(), _RANGES, pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.int32(), pa.binary())


def _merged(first: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    """Ascending ranges that neither touch nor overlap, from ranges by ascending start."""
    if not len(first):
        return []
    reach = np.maximum.accumulate(end)
    new = np.flatnonzero(np.append(True, first[1:] > reach[:-1]))
    return list(zip(first[new].tolist(), reach[np.append(new[1:] - 1, len(first) - 1)].tolist(), strict=True))


def _answering(buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _each(batches):
            strings = Strings(row["texts"])
            order, first = strings.distinct()
            named = dict(by_bucket(strings, order, first, buckets))
            task, owner = np.zeros(len(first), np.uint8), np.zeros(len(first), np.int64)
            for x in row["answers"]:
                numbers = named[x["bucket"]][np.frombuffer(x["numbers"], np.uint32)]
                task[numbers], owner[numbers] = np.frombuffer(x["tasks"], np.uint8), from_planes(x["holders"])
            counts = np.diff(first, append=len(order))
            task, owner = np.repeat(task, counts), np.repeat(owner, counts)
            places = _places(row["ids"])[strings.text[order]]
            out = []
            gone = order[(task & CUT > 0) & (places > owner)]
            gone = gone[np.lexsort((strings.start[gone], strings.text[gone]))]
            bounds = np.flatnonzero(np.diff(strings.text[gone], prepend=-1, append=-1))
            for a, b in zip(bounds, bounds[1:]):
                x = gone[a:b]
                ranges = _merged(strings.start[x], strings.start[x] + strings.more[x] + WINDOW)
                out.append((row["batch"], int(strings.text[x[0]]), [{"first": f, "end": e} for f, e in ranges], None, None, CUT, None, None, None))
            sent = np.flatnonzero((task & (BLOCK | WINDOWS) > 0) & (places == owner))
            bounds = np.flatnonzero(np.diff(np.searchsorted(first, sent, side="right") * len(places) + strings.text[order[sent]], prepend=-1, append=-1))
            for a, b in zip(bounds, bounds[1:]):
                x = order[sent[a:b]]
                at, doc = int(strings.start[x[0]]), int(strings.text[x[0]])
                data = row["texts"][doc][at : at + int(strings.more[x[0]]) + WINDOW]
                out.append((row["batch"], doc, None, int(strings.anchor[x[0]]), int(owner[sent[a]]), int(task[sent[a]]) & (BLOCK | WINDOWS), strings.start[x].tolist(), int(strings.offset[x[0]]), data))
            if out:
                columns = [pa.array(c, t) for c, t in zip(zip(*out), _FOUND_KINDS)]
                yield pa.RecordBatch.from_arrays(columns, names=["batch", "doc", "ranges", "anchor", "holder", "task", "starts", "offset", "data"])

    return run


def _comparable(rows: list[dict]) -> list[dict]:
    """Strings of one block that may share a window: equal windows agree in their anchor and SIDE bytes on one side of it."""
    held: dict[tuple[bool, bytes], tuple[int, int]] = {}
    sides = []
    for r in rows:
        p, data, holder = r["offset"], r["data"], r["holder"]
        own = [(True, data[p : p + ANCHOR + SIDE])] if p + ANCHOR + SIDE <= len(data) else []
        if p >= SIDE:
            own.append((False, data[p - SIDE : p + ANCHOR]))
        for side in own:
            low, high = held.get(side, (holder, holder))
            held[side] = min(low, holder), max(high, holder)
        sides.append(own)
    return [r for r, own in zip(rows, sides, strict=True) if any(held[x][0] < held[x][1] for x in own)]


def least_holders(blocks: list[list[bytes]], holders: list[list[int]]) -> list[np.ndarray]:
    """For every string, in the order given, the smallest holder of each of its windows among the strings of its block."""
    flat = [s for b in blocks for s in b]
    owner = np.array([h for b in holders for h in b], np.int64)
    sizes = np.array([len(s) for s in flat])
    starts = np.cumsum(sizes) - sizes
    begins = np.cumsum([0, *(len(b) for b in blocks[:-1])])
    text = np.frombuffer(b"".join(flat), np.uint8)
    order = suffix_order(text, starts, starts[begins])
    string = np.repeat(np.arange(len(flat)), sizes)
    left = (starts + sizes)[string] - np.arange(len(text))
    order = order[left[order] >= WINDOW]
    # Windows side by side are compared by eight bytes at a time.
    words = np.lib.stride_tricks.sliding_window_view(text, 8).copy().view(np.uint64).ravel()
    block = np.repeat(np.arange(len(blocks)), [len(b) for b in blocks])[string]
    new = np.append(True, block[order[1:]] != block[order[:-1]])
    for k in (*range(0, WINDOW - 8, 8), WINDOW - 8):
        new[1:] |= words[order[1:] + k] != words[order[:-1] + k]
    heads = np.flatnonzero(new)
    least = np.zeros(len(text), np.int64)
    least[order] = np.repeat(np.minimum.reduceat(owner[string[order]], heads), np.diff(heads, append=len(order)))
    return [least[s : s + n - WINDOW + 1] for s, n in zip(starts, sizes, strict=True)]


def _lost(row: dict, least: np.ndarray) -> tuple[int, int, list[dict[str, int]]] | None:
    """The ranges that a string's first holder loses in all the places where it has the string."""
    at = np.flatnonzero(least < row["holder"])
    if not len(at):
        return None
    own = _merged(at, at + WINDOW)
    return row["batch"], row["doc"], [{"first": s + f, "end": s + e} for s in row["starts"] for f, e in own]


def _ordering(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def ready(groups: list[list[dict]]) -> pa.RecordBatch | None:
        least = least_holders([[r["data"] for r in g] for g in groups], [[r["holder"] for r in g] for g in groups])
        out = [x for row, own in zip((r for g in groups for r in g), least, strict=True) if (x := _lost(row, own))]
        kinds = (pa.int64(), pa.int32(), _RANGES)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=["batch", "doc", "ranges"]) if out else None

    rows = (r for batch in batches for r in batch.to_pylist())
    groups, size = [], 0
    for _, group in groupby(rows, key=lambda r: r["anchor"]):
        if not (own := _comparable(list(group))):
            continue
        groups.append(own)
        size += sum(len(r["data"]) for r in own)
        if size >= TOGETHER:
            if (found := ready(groups)) is not None:
                yield found
            groups, size = [], 0
    if groups and (found := ready(groups)) is not None:
        yield found


def spans_of(ranges: list[dict[str, int]]) -> list[tuple[int, int]]:
    pairs = np.array([(r["first"], r["end"]) for r in ranges], np.int64).reshape(-1, 2)
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    return _merged(pairs[:, 0], pairs[:, 1])


_KEPT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("spans", _RANGES), ("kept", pa.binary())])


def _applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row in _each(batches):
        ranges: dict[int, list[dict[str, int]]] = {}
        for x in row["found"] or []:
            ranges.setdefault(x["doc"], []).extend(x["ranges"])
        spans, kept = [], []
        for k, data in enumerate(row["texts"]):
            own = spans_of(ranges.get(k, []))
            spans.append([{"first": a, "end": b} for a, b in own])
            kept.append(b"".join(data[a:b] for a, b in zip([0, *(e for _, e in own)], [*(f for f, _ in own), len(data)], strict=True)) if own else data)
        columns = [pa.array(row["ids"], pa.int64()), pa.array([len(x) for x in row["texts"]], pa.int64()), pa.array(spans, _RANGES), pa.array(kept, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, schema=_KEPT)


def removed(documents: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, spans, kept): the byte ranges that go from every document, and what is left of it."""
    texts = pick(documents, {"doc_id": "bigint", "text": "string"}).select("doc_id", F.col("text").cast("binary").alias("data"))
    dealt = texts.mapInArrow(_in_batches, "ids array<bigint>, texts array<binary>").withColumn("batch", F.monotonically_increasing_id())
    batches = stored(dealt, "repeats-batches")
    total = batches.select(F.sum(F.expr("aggregate(texts, 0L, (n, x) -> n + length(x))")).alias("n")).first()["n"] or 0
    buckets = max(1, -(-total // BUCKET))

    largest = LARGEST
    with small_transfers(documents.sparkSession):
        asked = batches.mapInArrow(_asking(buckets), _ASKED)
        answers = stored(asked.groupBy("bucket").applyInArrow(lambda t: verdicts(t, largest), ANSWER), "repeats-answers")
        by_batch = answers.groupBy("batch").agg(F.collect_list(F.struct("bucket", "numbers", "holders", "tasks")).alias("answers"))
        found = stored(batches.join(by_batch, "batch").select("batch", "ids", "texts", "answers").mapInArrow(_answering(buckets), _FOUND), "repeats-found")

    whole = found.where(F.col("task") == CUT).select("batch", "doc", "ranges")
    sent = found.where(F.col("task") == BLOCK).select("batch", "doc", "anchor", "holder", "starts", "offset", "data")
    blocks = sent.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_ordering, "batch bigint, doc int, ranges array<struct<first:bigint,end:bigint>>")

    single = found.where(F.col("task") == WINDOWS).select("batch", "doc", "holder", "starts", "data", F.explode(F.expr(f"sequence(0, length(data) - {WINDOW})")).alias("k"))
    single = single.select("batch", "doc", "holder", "starts", "k", F.expr(f"substring(data, k + 1, {WINDOW})").alias("window"))
    firsts = stored(single.groupBy("window").agg(F.min("holder").alias("least"), F.max("holder").alias("most")).where("least < most").drop("most"), "repeats-windows")
    span = F.transform("starts", lambda s: F.struct((s + F.col("k")).alias("first"), (s + F.col("k") + WINDOW).alias("end")))
    windows = single.join(firsts, "window").where("holder > least").select("batch", "doc", span.alias("ranges"))

    cut = whole.unionByName(blocks).unionByName(windows).groupBy("batch").agg(F.collect_list(F.struct("doc", "ranges")).alias("found"))
    return batches.join(cut, "batch", "left").select("ids", "texts", "found").mapInArrow(
        _applied, "doc_id bigint, n_bytes bigint, spans array<struct<first:bigint,end:bigint>>, kept binary"
    )
