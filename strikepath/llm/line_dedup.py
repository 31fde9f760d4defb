"""Line and passage deduplication by pairwise alignment.

1. Lines are compared without outer white space. A line of at least
   ``min_words`` words is a key: long enough that sharing it is no accident.
2. Keys held by more than one document find overlapping documents. Every later
   holder meets the key's first holder, so a key in n documents makes n - 1
   pairs, however common it is.
3. Each pair is aligned with patience diff: keys and other lines that are unique
   on both sides anchor the alignment, the longest rising run of anchors is
   kept, and blocks grow from it; this is repeated on what is left.
4. Aligned common blocks that hold a key are deleted from the later document.
   A key's first holder never loses it to a whole line, so every line stays once.
5. Passages that start or end inside lines are found on words, white space and
   line breaks apart: each window of ``PASSAGE`` words that an earlier document
   has too is deleted. Windows in a row with the same lowest run of ``GRAM``
   words make a stretch. Stretches whose run is held by one document are left
   out; equal stretches are matched whole; of the first of each, windows are
   matched one by one if its run stands in different stretches. No pair of
   documents is compared, and only words, runs and stretches whose hashes all agree match, and lines whose 64-bit hashes do.
   A line that loses all its words counts as deleted; of any other the words
   before and after stay. Shorter repeats inside longer lines stay.

Order is by doc_id. Defined results: a null text has one empty line; rows that
share a doc_id count as versions of one document, are never compared with each
other, and each gets its own result; rows without a doc_id come last of all and
count as one such document; empty input gives no row; further columns are
ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from strikepath.llm.common import DOCUMENT_COLUMNS, pick, slices, small_transfers, stored, texts_of
from strikepath.llm.repeats import ANSWER, BASE, BATCH, BUCKET, CUT, POSITION, Keyed, by_bucket, from_planes, mixed, planes, powers, verdicts

MIN_WORDS = 5
PASSAGE = 50
GRAM = 10
#: Words whose runs are hashed at once.
STEP = 250_000
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_WORD = re.compile(r"[^\x09-\x0D\x20]+")
LAST = (1 << 63) - 1


def split_lines(text: str) -> list[str]:
    return text.split("\n")


def count_words(line: str) -> int:
    return line.count(" ") + 1 if line and "  " not in line and "\t" not in line else len(line.split())


def _drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, rows=2000):
        lines, words = [], []
        for text in texts_of(batch):
            own = [x.strip() for x in split_lines(text)]
            lines.append([xxh3_64_intdigest(x.encode("utf-8", "surrogatepass")) - (1 << 63) for x in own])
            words.append([count_words(x) for x in own])
        yield pa.RecordBatch.from_arrays(
            [batch.column("at"), batch.column("digest"), batch.column("size"), pa.array(lines, pa.list_(pa.int64())), pa.array(words, pa.list_(pa.int32()))],
            names=["at", "digest", "size", "lines", "words"],
        )


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs (ascending in the second) that also ascends in the first."""
    tops: list[int] = []
    ends: list[int] = []
    before: list[int] = []
    for k, (i, _) in enumerate(pairs):
        at = bisect_left(tops, i)
        before.append(ends[at - 1] if at else -1)
        if at == len(tops):
            tops.append(i)
            ends.append(k)
        else:
            tops[at], ends[at] = i, k
    out, k = [], ends[-1] if ends else -1
    while k >= 0:
        out.append(pairs[k])
        k = before[k]
    return out[::-1]


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Aligned positions (i, j) with a[i] == b[j], ascending in both."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i0, i1, j0, j1 = todo.pop()
        while i0 < i1 and j0 < j1 and a[i0] == b[j0]:
            out.append((i0, j0))
            i0, j0 = i0 + 1, j0 + 1
        while i0 < i1 and j0 < j1 and a[i1 - 1] == b[j1 - 1]:
            i1, j1 = i1 - 1, j1 - 1
            out.append((i1, j1))
        if i0 == i1 or j0 == j1:
            continue
        n, m = Counter(a[i0:i1]), Counter(b[j0:j1])
        place = {x: i for i, x in enumerate(a[i0:i1], i0) if n[x] == 1 and m.get(x) == 1}
        anchors = _rising([(place[x], j) for j, x in enumerate(b[j0:j1], j0) if x in place])
        if anchors:
            for (i, j), (p, q) in zip([(i0 - 1, j0 - 1), *anchors], [*anchors, (i1, j1)], strict=True):
                todo.append((i + 1, p, j + 1, q))
            out += anchors
    return sorted(out)


def common_blocks(a: list, b: list, words: list[int], min_words: int = MIN_WORDS) -> list[int]:
    """Positions of b to delete, where b is the later of the two: aligned blocks with a key line, until none is left."""
    left = list(range(len(b)))
    gone: set[int] = set()
    held = set(a)
    while True:
        block: list[int] = []
        cut: set[int] = set()
        last = (-2, -2)

        def close(block: list[int], cut: set[int]) -> None:
            if any(words[j] >= min_words for j in block):
                cut.update(block)

        for i, at in patience(a, [b[j] for j in left]):
            j = left[at]
            if (i, j) != (last[0] + 1, last[1] + 1):
                close(block, cut)
                block = []
            block.append(j)
            last = (i, j)
        close(block, cut)
        if not cut:
            # What has no unique anchor left is deleted line by line.
            gone.update(j for j in left if words[j] >= min_words and b[j] in held)
            return sorted(gone)
        gone |= cut
        left = [j for j in left if j not in cut]


def _align(min_words: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, rows=2000):
            a, b, words = (batch.column(c).to_pylist() for c in ("lines_a", "lines_b", "words_b"))
            cut = [common_blocks(x, y, w, min_words) for x, y, w in zip(a, b, words, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("b"), batch.column("digest"), batch.column("a"), pa.array(cut, pa.list_(pa.int32()))], names=["at", "digest", "first", "cut"]
            )

    return run


def _runs(ids: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` numbers in a row, from hashes of runs half as long."""
    out, held = None, 0
    part, length = ids, 1
    while True:
        if size & length:
            if out is None:
                out, held = part, length
            else:
                n = len(ids) - held - length + 1
                out = out[:n] * np.uint64(pow(BASE, length, 1 << 64)) + part[held : held + n]
                held += length
        if held == size:
            return out
        part = part[:-length] * np.uint64(pow(BASE, length, 1 << 64)) + part[length:]
        length *= 2


def _words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each word of some bytes begins, and its hash."""
    space = np.concatenate([[True], _SPACE[data], [True]])
    edges = np.flatnonzero(space[1:] != space[:-1])
    starts, ends = edges[::2], edges[1::2]
    # Its share of the running sum of bytes times powers, brought back to the first power.
    size = 1 << max(16, len(data).bit_length())
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, size)[: len(data)], out=sums[1:])
    return starts, mixed((sums[ends] - sums[starts]) * powers(pow(BASE, -1, 1 << 64), size)[starts])


class Stretches(Keyed):
    """The stretches of some texts: windows start .. start + more of one text share their lowest run of words."""

    def __init__(self, texts: list[bytes]):
        found, group, size = [np.empty((5, 0), np.uint64)], [], 0
        for k, data in enumerate(texts):
            group.append((k, 0, data))
            size += len(data)
            if size >= BATCH:
                found += self._found(group)
                group, size = [], 0
        found += self._found(group)
        columns = np.concatenate(found, axis=1)
        self.text, self.start, self.more = (columns[k].astype(np.int64) for k in range(3))
        self.anchor, self.key = columns[3].astype(np.uint32), columns[4]

    @staticmethod
    def _found(group: list[tuple[int, int, bytes]]) -> list[np.ndarray]:
        """Texts worked on together; the words of a text that is longer than a batch are taken in steps."""
        data = np.frombuffer(b"\n".join(g[2] for g in group), np.uint8)
        if len(data) < PASSAGE:
            return []
        offsets = np.cumsum([0, *(len(g[2]) + 1 for g in group)])
        begins, ids = [], []
        for at in range(0, len(data), 4 * BATCH):
            # A step ends where a word does.
            begins.append(at if not at or _SPACE[data[at - 1]] else at + int(np.argmax(np.append(_SPACE[data[at:]], True))))
        parts = [_words(data[a:b]) for a, b in zip(begins, [*begins[1:], len(data)], strict=True)]
        starts = np.concatenate([p[0] + a for p, a in zip(parts, begins, strict=True)])
        ids = np.concatenate([p[1] for p in parts])
        text = np.searchsorted(offsets, starts, side="right") - 1
        if len(ids) < PASSAGE:
            return []
        first = np.searchsorted(text, np.arange(len(group)))
        out = []
        for at in range(0, len(ids) - PASSAGE + 1, STEP):
            own, doc = ids[at : at + STEP + PASSAGE - 1], text[at : at + STEP + PASSAGE - 1]
            grams, windows = mixed(_runs(own, GRAM)), _runs(own, PASSAGE)
            # The lowest run of every window with its position in the low bits, the leftmost of equal ones.
            low, length, width = (grams & ~POSITION) | np.arange(len(grams), dtype=np.uint64), 1, PASSAGE - GRAM + 1
            while length < width:
                step = min(length, width - length)
                low = np.minimum(low[:-step], low[step:])
                length += step
            low = (low & POSITION).astype(np.int64)
            whole = doc[: len(low)] == doc[PASSAGE - 1 :]
            new = whole.copy()
            new[1:] &= (low[1:] != low[:-1]) | ~whole[:-1]
            start = np.flatnonzero(new)
            ends = np.flatnonzero(whole & ~np.append(whole[1:] & ~new[1:], False))
            more = ends - start
            # The two end windows overlap or touch, so they and their distance tell the whole.
            key = mixed(mixed(windows[start]) * np.uint64(BASE) + windows[ends] + more.astype(np.uint64))
            name = mixed(grams[low[start]] ^ np.uint64(BASE)) >> np.uint64(32)
            docs = doc[start]
            number = np.array([g[0] for g in group], np.uint64)[docs]
            out.append(np.stack([number, (start + at - first[docs]).astype(np.uint64), more.astype(np.uint64), name, key]))
        return out


_LISTED = "batch bigint, bucket int, anchors binary, keys binary, holders binary, several binary, ats binary, digests binary, docs binary, starts binary, mores binary, counts binary, buckets binary"
_LISTED_KINDS = (pa.int64(), pa.int32(), *[pa.binary()] * 11)
_LISTED_NAMES = [c.split(" ")[0] for c in _LISTED.split(", ")]


def _named(buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Batches of texts: what they ask of every bucket, and in a row of its own (bucket -1) where their stretches lie."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n = TaskContext.get().partitionId(), 0
        for batch in _grouped(batches):
            found = Stretches([x or b"" for x in batch.column("data").to_pylist()])
            if not len(found.key):
                continue
            name, n = (part << 33) + n, n + 1
            order, first = found.distinct()
            ats = batch.column("at").to_numpy()
            places = ats[found.text[order]]
            holders = np.minimum.reduceat(places, first)
            several = (np.maximum.reduceat(places, first) > holders).astype(np.uint8)
            rows = [
                (name, b, found.anchor[order[first[x]]].tobytes(), found.key[order[first[x]]].tobytes(), planes(holders[x]), several[x].tobytes(), *[None] * 7)
                for b, x in by_bucket(found, order, first, buckets)
            ]
            counts = np.diff(first, append=len(order))
            lists = (ats, batch.column("digest").to_numpy(), found.text[order], found.start[order], found.more[order], counts, found.anchor[order[first]].astype(np.int64) % buckets)
            rows.append((name, -1, *[None] * 4, *[planes(x.astype(np.int64)) for x in lists]))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _LISTED_KINDS)], names=_LISTED_NAMES)

    return run


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in batches of about ``BATCH`` bytes."""
    for batch in batches:
        step = max(1, min(10_000, int(batch.num_rows * BATCH / max(1, batch.nbytes))))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


_MET = "at bigint, digest bigint, first bigint, run bigint, start bigint, more bigint"


def _told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches with an earlier holder (``first``), and those of first holders whose run stands in others as well (``run``)."""
    for batch in batches:
        for row in batch.to_pylist():
            ats, digests, docs, starts, mores, counts, buckets = (from_planes(row[c]) for c in ("ats", "digests", "docs", "starts", "mores", "counts", "buckets"))
            task, owner = np.zeros(len(counts), np.uint8), np.zeros(len(counts), np.int64)
            by = np.argsort(buckets, kind="stable")
            edges = np.searchsorted(buckets[by], np.arange(buckets.max() + 2))
            for x in row["answers"]:
                numbers = by[edges[x["bucket"]] + np.frombuffer(x["numbers"], np.uint32).astype(np.int64)]
                task[numbers], owner[numbers] = np.frombuffer(x["tasks"], np.uint8), from_planes(x["holders"])
            string = np.repeat(np.arange(len(counts)), counts)
            places = ats[docs]
            cut = (task[string] & CUT > 0) & (places > owner[string])
            doubt = (task[string] & ~np.uint8(CUT) > 0) & (places == owner[string])
            x = np.flatnonzero(cut | doubt)
            if len(x):
                columns = [pa.array(c) for c in (places[x], digests[docs[x]])]
                columns += [pa.array(owner[string[x]], mask=~cut[x]), pa.array(string[x], mask=cut[x]), pa.array(starts[x]), pa.array(mores[x])]
                yield pa.RecordBatch.from_arrays(columns, names=[c.split(" ")[0] for c in _MET.split(", ")])


def _single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows of the stretches in question, one by one."""
    for batch in slices(batches):
        found, sizes = [np.empty((2, 0), np.int64)], []
        for data, asked in zip(batch.column("data").to_pylist(), batch.column("asked").to_pylist(), strict=True):
            ids = np.concatenate([_words(np.frombuffer(p, np.uint8))[1] for p in _pieces(data)])
            # Stretches of one text share no window.
            at = np.concatenate([np.arange(x["start"], x["start"] + x["more"] + 1) for x in asked])
            if len(at) * PASSAGE < len(ids):
                windows = np.concatenate([_runs(ids[x["start"] : x["start"] + x["more"] + PASSAGE], PASSAGE) for x in asked])
            else:
                windows = _runs(ids, PASSAGE)[at]
            found.append(np.stack([mixed(windows).view(np.int64), at]))
            sizes.append(len(at))
        lists = _lists(np.concatenate(found, axis=1), sizes, ["window", "start"])
        yield pa.RecordBatch.from_arrays([batch.column("at"), batch.column("digest"), lists], names=["at", "digest", "found"])


def _pieces(data: bytes) -> Iterator[bytes]:
    """A text in pieces of bounded size that end where a word does."""
    at = 0
    while at < len(data) or not at:
        end = at + 4 * BATCH
        while end < len(data) and not _SPACE[data[end]]:
            end += 1
        yield data[at:end]
        at = max(end, 1)


def _lists(columns: np.ndarray, sizes: list[int], names: list[str]) -> pa.Array:
    """One list of structs per size, from the columns side by side."""
    at = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
    return pa.ListArray.from_arrays(at, pa.StructArray.from_arrays([pa.array(c) for c in columns], names=names))


def _joined(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same positions in ranges that neither touch nor overlap."""
    out: list[tuple[int, int]] = []
    for first, end in sorted(ranges):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((first, end))
    return out


def without(text: str, cut: list[int], words: list[tuple[int, int]]) -> tuple[list[int], str]:
    """All lines that go, and the text without them and without the given ranges of its words."""
    gone, kept, at, n = set(cut), [], 0, 0
    words = _joined(words)
    for k, line in enumerate(split_lines(text)):
        count = len(line.encode("utf-8", "surrogatepass").split()) if words else 0
        here = range(at, at + count)
        at += count
        while n < len(words) and words[n][1] <= here.start:
            n += 1
        lost: set[int] = set()
        for m in range(n, len(words)):
            first, end = words[m]
            if first >= here.stop:
                break
            lost.update(range(max(first, here.start) - here.start, min(end, here.stop) - here.start))
        if k in gone:
            continue
        if lost and len(lost) == count:
            gone.add(k)
            continue
        if lost:
            own = [m.span() for m in _WORD.finditer(line)]
            stay = [j for j in range(count) if j not in lost]
            # Each word that stays keeps the white space before it; the first keeps the line's.
            line = line[: own[0][0]] + "".join(line[own[j - 1][1] if i and j else own[j][0] : own[j][1]] for i, j in enumerate(stay)) + (line[own[-1][1] :] if stay[-1] == count - 1 else "")
        kept.append(line)
    return sorted(gone), "\n".join(kept)


_KEPT = {c: k for c, k in DOCUMENT_COLUMNS.items() if c != "text"} | {"n_lines": "int", "cut": "array<int>", "partners": "array<bigint>", "kept_text": "string"}


def _applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, rows=5000):
        text = batch.column("text")
        changed = [len(p) > 0 for p in batch.column("partners")]
        rows = [k for k, c in enumerate(changed) if c]
        cuts, texts = [[]] * batch.num_rows, []
        if rows:
            some = batch.take(pa.array(rows))
            for k, old, cut, words in zip(rows, some.column("text"), some.column("cut").to_pylist(), some.column("words").to_pylist(), strict=True):
                cuts[k], kept = without(old.as_py() or "", cut, [(w["first"], w["end"]) for w in words])
                texts.append(kept)
            text = pc.replace_with_mask(text, pa.array(changed), pa.array(texts, pa.string()))
        columns = {c: batch.column(c) for c in _KEPT if c not in ("cut", "kept_text")} | {"cut": pa.array(cuts, pa.list_(pa.int32())), "kept_text": text}
        yield pa.RecordBatch.from_arrays([columns[c] for c in _KEPT], names=list(_KEPT))


def _keyed(documents: DataFrame) -> DataFrame:
    return documents.withColumn("at", F.coalesce("doc_id", F.lit(LAST))).withColumn("digest", F.xxhash64(F.coalesce("text", F.lit(""))))


def lines_of(documents: DataFrame) -> DataFrame:
    """(at, digest, size, lines, words): each row's bytes, the hashes of its lines and their numbers of words; stored."""
    keyed = _keyed(pick(documents, {"doc_id": "bigint", "text": "string"})).select("at", "digest", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("size"), "text")
    return stored(keyed.mapInArrow(_drawn, "at bigint, digest bigint, size bigint, lines array<bigint>, words array<int>"), "linededup-lines")


def cuts(drawn: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(at, digest, cut, partners): for each row that loses lines their numbers from 0, and the documents they align with.

    ``at`` is the doc_id, or the largest bigint where that is null, and
    ``digest`` tells rows of one doc_id apart.
    """
    keys = drawn.select("at", F.explode(F.arrays_zip("lines", "words")).alias("x")).where(F.col("x.words") >= min_words).select("at", F.col("x.lines").alias("line"))
    # Stored, so that the join has exchanges of its own, whose large partitions are split.
    firsts = stored(keys.groupBy("line").agg(F.min("at").alias("a"), F.max("at").alias("last")).where("a < last").select("line", "a"), "linededup-firsts")
    pairs = keys.join(firsts, "line").where("at > a").select("a", F.col("at").alias("b")).distinct()
    rows = drawn.select(F.col("at").alias("b"), "digest", F.col("lines").alias("lines_b"), F.col("words").alias("words_b")).distinct()
    first = drawn.select(F.col("at").alias("a"), F.col("lines").alias("lines_a")).distinct()
    met = stored(pairs, "linededup-pairs").join(rows, "b").join(first, "a").select("a", "b", "digest", "lines_a", "lines_b", "words_b")
    aligned = met.mapInArrow(_align(min_words), "at bigint, digest bigint, first bigint, cut array<int>").where(F.size("cut") > 0)
    return aligned.groupBy("at", "digest").agg(
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("cut")))).alias("cut"), F.sort_array(F.collect_set("first")).alias("partners")
    )


def shared_passages(documents: DataFrame, size: int) -> DataFrame:
    """(at, digest, words, partners): for each row that loses passages their word positions, and the first documents that have them; ``size`` is the bytes of all."""
    keyed = _keyed(pick(documents, {"doc_id": "bigint", "text": "string"})).select("at", "digest", F.col("text").cast("binary").alias("data"))
    buckets = max(1, -(-size // BUCKET))
    with small_transfers(documents.sparkSession):
        listed = stored(keyed.mapInArrow(_named(buckets), _LISTED), "linededup-stretches")
        asked = listed.where("bucket >= 0").select("batch", "bucket", "anchors", "keys", "holders", "several")
        answers = stored(asked.groupBy("bucket").applyInArrow(lambda t: verdicts(t, 1), ANSWER), "linededup-answers")
        by_batch = answers.groupBy("batch").agg(F.collect_list(F.struct("bucket", "numbers", "holders", "tasks")).alias("answers"))
        index = listed.where("bucket = -1").select("batch", "ats", "digests", "docs", "starts", "mores", "counts", "buckets")
        met = stored(index.join(by_batch, "batch").drop("batch").mapInArrow(_told, _MET), "linededup-met")
    repeats = met.where("first IS NOT NULL").select("at", "digest", "first", "start", "more")
    # Windows of the first of each, where its run stands in different stretches.
    asked = met.where("run IS NOT NULL").groupBy("at", "digest").agg(F.collect_set(F.struct("start", "more")).alias("asked"))
    single = keyed.join(asked, ["at", "digest"]).mapInArrow(_single, "at bigint, digest bigint, found array<struct<window:bigint,start:bigint>>")
    windows = stored(single, "linededup-windows").select("at", "digest", F.explode("found").alias("x")).select("at", "digest", "x.*")
    # Stored, so that the join has exchanges of its own, whose large partitions are split.
    firsts = stored(windows.groupBy("window").agg(F.min("at").alias("first"), F.max("at").alias("z")).where("first < z").drop("z"), "linededup-firsts")
    others = windows.join(firsts, "window").where("at > first").select("at", "digest", "first", "start", F.lit(0).cast("bigint").alias("more"))
    span = F.struct(F.col("start").cast("int").alias("first"), (F.col("start") + F.col("more") + PASSAGE).cast("int").alias("end"))
    return repeats.unionByName(others).groupBy("at", "digest").agg(F.collect_set(span).alias("words"), F.collect_set("first").alias("partners"))


def dedup(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The columns of documents but the text, with n_lines, cut, partners, and the text without repeated blocks as kept_text."""
    kinds = {"cut": "array<int>", "words": "array<struct<first:int,end:int>>", "partners": "array<bigint>"}
    none = {c: F.array().cast(kind) for c, kind in kinds.items()}
    with small_transfers(documents.sparkSession):
        drawn = lines_of(documents)
        size = drawn.agg(F.sum("size").alias("n")).first()["n"] or 0
        by_line = cuts(drawn, min_words).select("at", "digest", "cut", none["words"].alias("words"), "partners")
        by_word = shared_passages(documents, size).select("at", "digest", none["cut"].alias("cut"), "words", "partners")
        both = by_line.unionByName(by_word).groupBy("at", "digest").agg(*[F.flatten(F.collect_list(c)).alias(c) for c in kinds])
        found = stored(both.withColumn("partners", F.sort_array(F.array_distinct("partners"))), "linededup-cuts")
    joined = _keyed(pick(documents, DOCUMENT_COLUMNS)).join(found, ["at", "digest"], "left")
    text = F.coalesce("text", F.lit(""))
    n_lines = F.length(text) - F.length(F.replace(text, F.lit("\n"))) + 1
    asked = joined.select(*DOCUMENT_COLUMNS, n_lines.alias("n_lines"), *[F.coalesce(c, none[c]).alias(c) for c in kinds])
    return asked.mapInArrow(_applied, ", ".join(f"{c} {kind}" for c, kind in _KEPT.items()))


def without_repeats(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Documents with repeated blocks and passages deleted; one that loses all it had goes, one that loses nothing stays as it was."""
    out = dedup(documents, min_words)
    changed = F.size("partners") > 0
    return out.where(~changed | F.col("kept_text").rlike(r"\S")).select(
        "doc_id", F.col("kept_text").alias("text"), "lang", "source", F.when(changed, F.length("kept_text").cast("bigint")).otherwise(F.col("n_chars")).alias("n_chars")
    )
