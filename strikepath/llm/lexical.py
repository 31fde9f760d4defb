"""Ranked lexical search by the Best Position Algorithm.

1. One pass over the texts counts every document's terms. A fixed-size bit table
   of the items' terms drops most others at once; a join on the terms themselves
   decides, so the table's size costs time only, never a row.
2. N, L, document frequencies and weights are aggregates over all documents.
3. Documents are dealt to shards of about ``SHARD`` documents by a hash, so no
   term's list lies in one task, and items to blocks of about ``BLOCK`` items.
   Each shard holds an impact list per term, highest impact first.
4. Per shard and item the lists are read in parallel from the top. Each document
   met is looked up in all lists directly, which scores it in full and marks its
   place in each list as seen. A list's best position is the end of its seen
   places without a gap; the impacts there add up to the highest score an unseen
   document can have. Reading stops when that is strictly below the kth score,
   so equal scores are never lost.
5. The shards' top rows are merged into each item's top rows.

Scores are 64-bit integers, equal ones in order of ascending doc_id.

Defined results: null or empty texts have no terms; a document without terms
counts in neither N nor any list; rows that share a doc_id are documents of
their own, a null doc_id comes after all others (the largest bigint counts as null); repeated rows of an item count
once, rows of one item_id with different texts are ranked apart; an item whose
terms no document holds has no row; an empty table on either side gives no row;
further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strikepath.llm.common import pick, slices, stored

TOP = 20
SHARD = 4096
BLOCK = 256
#: Bits of the table of the items' terms.
BITS = 20
#: Entries of each list read before the first look at the threshold; doubled each time.
FIRST_READ = 16

_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(data: bytes | None) -> list[bytes]:
    """A text's terms; UTF-8 bytes beyond ASCII all belong to terms."""
    return data.translate(_FOLD).split() if data else []


def _counted(wanted: np.ndarray | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Term counts of every row, only of those whose bit is set where a table is given."""
    mask = (1 << BITS) - 1
    flags = None if wanted is None else wanted.tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crc = zlib.crc32
        for batch in slices(batches):
            sizes, terms, counts, lengths = [], [], [], []
            for data in batch.column("data").to_pylist():
                found = terms_of(data)
                own = Counter(found)
                kept = own if flags is None else [t for t in own if flags[crc(t) & mask]]
                terms.extend(kept)
                counts.extend(own[t] for t in kept)
                sizes.append(len(kept))
                lengths.append(len(found))
            at = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            pairs = pa.StructArray.from_arrays([pa.array(terms, pa.binary()), pa.array(counts, pa.int64())], names=["term", "tf"])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("digest"), pa.array(lengths, pa.int64()), pa.ListArray.from_arrays(at, pairs)],
                names=["id", "digest", "n", "terms"],
            )

    return run


def counted(rows: DataFrame, key: str, wanted: np.ndarray | None = None) -> DataFrame:
    """(id, digest, n, terms): a row's number of terms and how often it holds each."""
    text = pick(rows, {key: "bigint", "text": "string"}).select(F.col(key).alias("id"), F.xxhash64("text").alias("digest"), F.col("text").cast("binary").alias("data"))
    return text.mapInArrow(_counted(wanted), "id bigint, digest bigint, n bigint, terms array<struct<term:binary,tf:bigint>>")


def bit_table(terms: DataFrame) -> np.ndarray:
    """One flag per bit; at most 2**BITS numbers come to the driver, however many terms there are."""
    bits = terms.select(F.crc32("term").bitwiseAND((1 << BITS) - 1).cast("int").alias("bit")).distinct().toArrow()
    flags = np.zeros(1 << BITS, np.uint8)
    flags[bits.column("bit").to_numpy()] = 1
    return flags


class Shard:
    """Impact lists of one shard's documents."""

    def __init__(self, terms: np.ndarray, docs: np.ndarray, impacts: np.ndarray, n_docs: int):
        order = np.lexsort((docs, -impacts, terms))
        self.docs, self.impacts, self.n_docs = docs[order], impacts[order], n_docs
        names, starts = np.unique(terms[order], return_index=True)
        ends = np.append(starts[1:], len(order))
        self.lists = {int(t): (int(a), int(b)) for t, a, b in zip(names, starts, ends, strict=True)}

    def best(self, terms: list[int], weights: list[int], k: int) -> list[tuple[int, int]]:
        """(document, score) of the k best with a score above 0, highest first, equal scores by document."""
        held = [(*self.lists[t], w) for t, w in zip(terms, weights, strict=True) if t in self.lists and w > 0]
        if not held:
            return []
        # Every list in a row of its own, one place further than its end with impact 0.
        longest = max(b - a for a, b, _ in held) + 1
        impact = np.zeros((len(held), longest), np.int64)
        seen = np.zeros((len(held), longest), bool)
        # Direct access: where a document stands in each list; the place past the end if it does not.
        place = np.empty((len(held), self.n_docs), np.int32)
        for row, (a, b, w) in enumerate(held):
            impact[row, : b - a] = self.impacts[a:b] * w
            place[row] = b - a
            place[row, self.docs[a:b]] = np.arange(b - a, dtype=np.int32)
        rows = np.arange(len(held))
        ends = np.array([b - a for a, b, _ in held])
        position = np.zeros(len(held), np.int64)
        met = np.zeros(self.n_docs, bool)
        top_docs, top_scores = np.empty(0, np.int64), np.empty(0, np.int64)
        depth, step = 0, FIRST_READ
        while depth < longest - 1:
            read = [self.docs[a + depth : min(b, a + depth + step)] for a, b, _ in held if a + depth < b]
            found = np.unique(np.concatenate(read))
            found = found[~met[found]]
            met[found] = True
            at = place[:, found]
            score = np.take_along_axis(impact, at, axis=1).sum(axis=0)
            seen[rows[:, None], at] = True
            seen[rows, ends] = False
            docs, scores = np.append(top_docs, found), np.append(top_scores, score)
            order = np.lexsort((docs, -scores))[:k]
            top_docs, top_scores = docs[order], scores[order]
            depth, step = depth + step, step * 2
            # Best positions move on over what reading or direct access has seen.
            for row in rows:
                position[row] += int(np.argmin(seen[row, position[row] :]))
            last = impact[rows, np.maximum(position - 1, 0)]
            threshold = int(np.where(position == ends, 0, last).sum())
            if len(top_docs) == k and threshold < top_scores[-1]:
                break
        return [(int(d), int(s)) for d, s in zip(top_docs, top_scores, strict=True) if s > 0]


def _search(k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(postings: pa.Table, asked: pa.Table) -> pa.Table:
        out: dict[str, list] = {"item_id": [], "item_digest": [], "row_id": [], "place": [], "score": []}
        if postings.num_rows and asked.num_rows:
            rows, first = np.unique(postings.column("row_id").to_numpy(), return_index=True)
            places = postings.column("place").to_numpy()[first]
            # Documents are numbered in the order in which equal scores are listed.
            order = np.lexsort((rows, places))
            number = np.empty(len(rows), np.int64)
            number[order] = np.arange(len(rows))
            docs = number[np.searchsorted(rows, postings.column("row_id").to_numpy())]
            shard = Shard(postings.column("term_id").to_numpy(), docs, postings.column("impact").to_numpy(), len(rows))
            for item in asked.to_pylist():
                found = shard.best([x["term_id"] for x in item["terms"]], [x["weight"] for x in item["terms"]], k)
                for doc, score in found:
                    at = order[doc]
                    for name, x in zip(out, (item["item_id"], item["item_digest"], int(rows[at]), int(places[at]), score), strict=True):
                        out[name].append(x)
        return pa.table({c: pa.array(v, pa.int64()) for c, v in out.items()})

    return run


def search(documents: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """(item_id, item_digest, rank, doc_id, score): each item's k highest-scoring documents."""
    asked = stored(counted(items, "item_id").distinct(), "lexical-items").select(F.col("id").alias("item_id"), F.col("digest").alias("item_digest"), F.explode("terms").alias("t"))
    n_blocks = max(1, -(-asked.select("item_id", "item_digest").distinct().count() // BLOCK))
    asked = asked.select("item_id", "item_digest", F.pmod(F.xxhash64("item_id", "item_digest"), F.lit(n_blocks)).cast("int").alias("block"), "t.term", F.col("t.tf").alias("repeats"))
    vocabulary = stored(asked.groupBy("term").agg(F.collect_set("block").alias("blocks")).withColumn("term_id", F.monotonically_increasing_id()), "lexical-terms")

    counts = counted(documents, "doc_id", bit_table(vocabulary)).where("n > 0").withColumn("row_id", F.monotonically_increasing_id())
    docs = stored(counts.select("row_id", F.col("id").alias("doc_id"), "n", "terms"), "lexical-counts")
    total = docs.agg(F.count("*").alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("all")).first()
    n_docs, n_terms = total["n"], max(1, total["all"])
    n_shards = max(1, -(-n_docs // SHARD))

    holders = docs.select(F.explode("terms.term").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    weight = F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * n_docs + 2.0) / (F.lit(2.0) * F.col("df") + F.lit(1.0)))).cast("bigint")
    weighed = stored(vocabulary.join(holders, "term").select("term", "term_id", "blocks", weight.alias("w")), "lexical-weights")

    lists = (
        asked.join(weighed, "term")
        .groupBy("item_id", "item_digest", "block")
        .agg(F.collect_list(F.struct("term_id", (F.col("w") * F.col("repeats")).alias("weight"))).alias("terms"))
        .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))))
    )
    m = F.expr(f"75 + ((25 * n * {n_docs}L) div {n_terms}L)")
    postings = (
        docs.select("row_id", F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("place"), m.alias("m"), F.explode("terms").alias("t"))
        .join(weighed.select("term", "term_id", "blocks"), F.col("t.term") == F.col("term"))
        .select(
            F.pmod(F.xxhash64("row_id"), F.lit(n_shards)).cast("int").alias("shard"), F.explode("blocks").alias("block"),
            "row_id", "place", "term_id", F.expr("(1000000000L * t.tf) div (1000L * t.tf + 12L * m)").alias("impact"),
        )
    )
    found = postings.groupBy("shard", "block").cogroup(lists.groupBy("shard", "block")).applyInArrow(
        _search(k), "item_id bigint, item_digest bigint, row_id bigint, place bigint, score bigint"
    )
    best = Window.partitionBy("item_id", "item_digest").orderBy(F.desc("score"), "place", "row_id")
    top = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return top.select("item_id", "item_digest", "rank", F.when(F.col("place") < (1 << 63) - 1, F.col("place")).alias("doc_id"), "score")
