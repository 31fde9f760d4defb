"""Document fingerprints by spot signatures.

Common words are anchors. Each anchor starts a chain of the next ``CHAIN``
content words, and a document's fingerprint is the set of its chains, as 64-bit
hashes; the start of a text counts as an anchor as well. Likeness is the Jaccard
similarity of two such sets, which is at most the ratio of their sizes: sets are
partitioned by size, and partitions that cannot reach a threshold are not
compared.

Defined results: a null or empty text has the empty set; two empty sets have
likeness 1, an empty and another 0; a text with fewer than ``CHAIN`` content
words after an anchor has no chain there, but a short text keeps the chain that
starts it; repeated rows each get a row; rows without a doc_id come first in the
order of documents; an empty input gives no row; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strikepath.llm.common import pick, slices, texts_of

CHAIN = 3
# Very common words of English, German, French and Spanish.
COMMON = frozenset(
    "a an and are as at be but by for from had has have he her his i in is it its not of on or she that the their there they this to was were which "
    "will with would you "
    "als am an auch auf aus bei das dem den der des die ein eine einem einen einer es für hat im in ist mit nach nicht sich sie sind und von war wie "
    "zu zum zur "
    "au aux avec ce cette dans de des du elle en est et il la le les mais ne nous on ou par pas pour qu que qui se son sur un une vous "
    "al con de del el en es esta la las lo los más no o para pero por que se sin su sus un una y".split()
)
_EDGES = "".join(chr(c) for c in range(33, 128) if not chr(c).isalnum()) + "«»“”‘’„…–—¿¡"
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _M2
    return h ^ (h >> np.uint64(29))


class Spotter:
    """Spot signatures of texts; words are kept between calls as (hash, whether common)."""

    def __init__(self, kept: int = 500_000):
        self.kept, self.words = kept, {}

    def sets(self, texts: list[str]) -> list[np.ndarray]:
        """Sorted distinct signatures of each text."""
        if len(self.words) > self.kept:
            self.words.clear()
        split = [t.split() for t in texts]
        new = set().union(*split).difference(self.words)
        for w in new:
            core = w.strip(_EDGES).lower()
            # The lowest bit tells common words from content words; 0 is no word at all.
            self.words[w] = (xxhash.xxh3_64_intdigest(core.encode("utf-8", "surrogatepass")) | 1) - (core not in COMMON) if core else 0
        get = self.words.__getitem__
        out = [self._spots(np.fromiter(map(get, s), np.uint64, len(s))) for s in split]
        for w in new:
            if len(w) > 100:
                del self.words[w]
        return out

    @staticmethod
    def _spots(h: np.ndarray) -> np.ndarray:
        h = np.concatenate([np.ones(1, np.uint64), h[h != 0]])
        common = (h & np.uint64(1)) == 1
        content = h[~common]
        if not len(content):
            return content
        anchors = np.flatnonzero(common)
        first = anchors - np.arange(len(anchors))
        full = first + CHAIN <= len(content)
        full[0] = True
        first = first[full]
        content = np.concatenate([content, np.zeros(CHAIN, np.uint64)])
        with np.errstate(over="ignore"):
            sig = _mix(h[anchors[full]] * _M1)
            for d in range(CHAIN):
                sig = _mix((sig + content[first + d]) * _M1)
        return np.unique(sig)


_spotter = Spotter()


def size_partition(n: int, least: float) -> int:
    """Partition of a set of n signatures, for a threshold: sets in partitions two apart cannot reach it."""
    return int(np.log(n) / -np.log(least)) if n and 0 < least < 1 else 0


def likeness(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard similarity of two sorted sets; 0 as soon as it must lie below ``least``."""
    n, m = len(a), len(b)
    if not n and not m:
        return 1.0
    if not n or not m or min(n, m) < least * max(n, m) or abs(size_partition(n, least) - size_partition(m, least)) > 1:
        return 0.0
    if a[0] > b[-1] or b[0] > a[-1]:
        return 0.0
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (n + m - shared)


def digest(signatures: np.ndarray) -> str:
    """A fingerprint as text: how many signatures, and a hash of all of them."""
    return f"{len(signatures)}:{hashlib.blake2b(signatures.tobytes(), digest_size=16).hexdigest()}"


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by as much of the start of the following one."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, rows=2000):
        sets = [s.view(np.int64) for s in _spotter.sets(texts_of(batch))]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sets, pa.list_(pa.int64()))], names=["doc_id", "signatures"])


def fingerprints(documents: DataFrame) -> DataFrame:
    """(doc_id, signatures): the set of spot signatures of each whole text."""
    return pick(documents, {"doc_id": "bigint", "text": "string"}).mapInArrow(_prints, "doc_id bigint, signatures array<bigint>")


def _block(column: str, cuts: list[int]) -> F.Column:
    """How many of the ascending cuts are at most the column's value, looked up in two steps."""
    if not cuts:
        return F.lit(0)
    step = max(1, round(len(cuts) ** 0.5))
    parts = [cuts[i : i + step] for i in range(0, len(cuts), step)]
    listed = lambda xs: f"array({', '.join(f'{x}L' for x in xs)})"
    upto = lambda xs: f"size(filter({xs}, c -> c <= {column}))"
    coarse = upto(listed(p[0] for p in parts))
    fine = f"get(array({', '.join(listed(p) for p in parts)}), {coarse} - 1)"
    return F.expr(f"if({column} < {cuts[0]}L, 0, ({coarse} - 1) * {step} + {upto(fine)})")


FOLLOWED = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, n_signatures bigint"
)


def _followed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come ordered within their block; a block ends with a guest, the row that follows its last one."""
    names = [x.split(" ")[0] for x in FOLLOWED.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64()]
    carry = None
    for batch in slices(batches, rows=1000, chars=4_000_000):
        texts = texts_of(batch)
        sets = _spotter.sets(texts)
        rows = list(zip(batch.column("block").to_pylist(), batch.column("guest").to_pylist(), batch.column("doc_id").to_pylist(), texts, sets, strict=True))
        if carry is not None:
            rows.insert(0, carry)
        pairs = [(x, y) for x, y in zip(rows, rows[1:], strict=False) if x[0] == y[0] and not x[1]]
        carry = rows[-1]
        if not pairs:
            continue
        changed = [edited(x[3], y[3]) for x, y in pairs]
        others = _spotter.sets(changed)
        out = [
            (x[2], len(x[3]), hashlib.sha256(c.encode("utf-8", "surrogatepass")).hexdigest(), digest(x[4]), digest(o), likeness(x[4], o), likeness(x[4], y[4]), len(x[4]))
            for (x, y), c, o in zip(pairs, changed, others, strict=True)
        ]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)


def followed(documents: DataFrame, rows_per_block: int = 20_000) -> DataFrame:
    """Each document's fingerprint against that of its edited text and of the next document by doc_id (after the last: the first).

    Documents are dealt into blocks of doc_ids at approximate quantiles, which
    are ids that occur. A block's first rows are also sent to the block before,
    the first of all to the last one, so a block is worked on alone.
    """
    spark = documents.sparkSession
    least = -(1 << 63)
    rows = pick(documents, {"doc_id": "bigint", "text": "string"}).withColumn("at", F.coalesce("doc_id", F.lit(least)))
    n = rows.count()
    blocks = max(1, min(10_000, max(int(spark.conf.get("spark.sql.shuffle.partitions")), n // rows_per_block)))
    shares = [k / blocks for k in range(1, blocks)] or [0.5]
    found = rows.agg(F.percentile_approx("at", shares, max(10_000, 10 * blocks)).alias("q"), F.min("at").alias("first")).first()
    first = least if found["first"] is None else found["first"]
    cuts = sorted({q for q in found["q"] or [] if q > first})
    own = rows.withColumn("block", _block("at", cuts))
    last = len(cuts)
    begins = F.col("at").isin(cuts) if cuts else F.lit(False)
    before = F.when(F.col("at") == F.lit(first), F.lit(last)).when(begins, F.col("block") - 1)
    dealt = own.select("doc_id", "text", "at", F.xxhash64(F.coalesce("text", F.lit(""))).alias("digest"), F.explode(F.array_compact(F.array(
        F.struct(F.col("block").alias("block"), F.lit(False).alias("guest")), F.when(before.isNotNull(), F.struct(before.alias("block"), F.lit(True).alias("guest")))
    ))).alias("place"))
    dealt = dealt.select("doc_id", "text", "at", "digest", F.col("place.block").alias("block"), F.col("place.guest").alias("guest"))
    ordered = dealt.repartition(blocks, "block").sortWithinPartitions("block", "guest", "at", "digest")
    return ordered.select("doc_id", "text", "block", "guest").mapInArrow(_followed, FOLLOWED)
