"""Near-duplicate groups by bottom-k sketches of one hash function.

1. A text's set is its distinct word shingles, each a 64-bit hash. Texts with
   equal sets form a class, and only classes are compared. The ``k`` smallest
   hashes of a set are its sketch.
2. Inverted lists of retained values: of each sketch only the rarest values in
   the corpus are listed, as many as a pair over the threshold cannot all miss.
   Each list links its members to its most central one, whose values are the
   most common, so it makes as many pairs as it is long.
3. The merged sketch of a linked pair estimates its similarity; pairs far below
   the threshold go, the others are confirmed on their full sets. Confirmed
   links give components.
4. Lists whose members still lie in several components are unfinished. Their
   members are listed again, now by the rarest part of their full sets, which is
   exact, and those that meet are compared across components, block by block.

Two members of one component need not be compared: no component is lost.

Defined results: a null, empty or blank text has no shingles and is linked with
nothing, not even its like; rows with equal sets always share a component,
repeated rows included; a null doc_id never names a component unless all of it
is null; an empty input gives no row; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strikepath.llm.common import DOCUMENT_COLUMNS, pick, slices, stored, texts_of

WIDTH = 5
THRESHOLD = 75
K = 48
#: Of K retained values two sets at the threshold share 36 on average, with a
#: deviation of 3; fewer than this share of them counts as impossible (5 deviations).
LEAST_SHARED = 0.42
#: Sets in a block of the comparison across components.
BLOCK = 256

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _M2
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Shingler:
    """Sorted distinct 64-bit shingle hashes of texts; word hashes are kept between calls."""

    def __init__(self, width: int = WIDTH, kept: int = 500_000):
        self.width, self.kept, self.words = width, kept, {}

    def sets(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.words) > self.kept:
            self.words.clear()
        split = [t.encode("utf-8", "surrogatepass").lower().split() for t in texts]
        new = set().union(*split)
        new.difference_update(self.words)
        self.words.update((w, xxhash.xxh3_64_intdigest(w)) for w in new)
        counts = [len(s) for s in split]
        get = self.words.__getitem__
        h = np.fromiter((get(w) for s in split for w in s), np.uint64, sum(counts))
        w = self.width
        with np.errstate(over="ignore"):
            grams = np.zeros(max(0, len(h) - w + 1), np.uint64)
            for i in range(w):
                grams = _mix(grams * _M1 + h[i : i + len(grams)])
            out, at = [], 0
            for n in counts:
                if n >= w:
                    out.append(np.unique(grams[at : at + n - w + 1]))
                elif n:
                    short = np.zeros(1, np.uint64)
                    for x in h[at : at + n]:
                        short = _mix(short * _M1 + x)
                    # A short text is one shingle; its length keeps it apart from any longer one.
                    out.append(_mix(short + np.uint64(n)))
                else:
                    out.append(np.zeros(0, np.uint64))
                at += n
        for x in new:
            if len(x) > 100:
                del self.words[x]
        return out


_shinglers: dict[int, Shingler] = {}


def shingler(width: int) -> Shingler:
    """One for each Python worker and width."""
    return _shinglers.setdefault(width, Shingler(width))


def _set_id(values: np.ndarray) -> bytes | None:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest() if len(values) else None


def _arrays(sets: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, sets)])
    flat = np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))


def _sketch(width: int, k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, rows=2000, chars=2_000_000):
            sets = shingler(width).sets(texts_of(batch))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([_set_id(s) for s in sets], pa.binary()), pa.array([len(s) for s in sets], pa.int64()), _arrays([s[:k] for s in sets])],
                names=["doc_id", "set_id", "n", "sketch"],
            )

    return run


def _full(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, rows=1000, chars=4_000_000):
            sets = shingler(width).sets(texts_of(batch))
            yield pa.RecordBatch.from_arrays([pa.array([_set_id(s) for s in sets], pa.binary()), _arrays(sets)], names=["set_id", "items"])

    return run


def sketches(documents: DataFrame, width: int = WIDTH, k: int = K) -> DataFrame:
    """(doc_id, set_id, n, sketch): the set's name and size and its k smallest hashes; set_id is null for an empty set."""
    schema = "doc_id bigint, set_id binary, n bigint, sketch array<bigint>"
    return pick(documents, {"doc_id": "bigint", "text": "string"}).mapInArrow(_sketch(width, k), schema)


def _rarest(postings: DataFrame, least_shared: float) -> DataFrame:
    """Of each member's values (set_id, n, size, v) the rarest that two linked sets cannot all miss; only values of two members or more.

    ``central`` is high for members most of whose values many others have, as
    the origin of a group of edited copies.
    """
    often = postings.groupBy("v").agg(F.count(F.lit(1)).alias("often")).where("often > 1")
    # Values of one member alone come first in its order and need no list; they only shorten what is left to list.
    listed = postings.join(often, "v")
    own = Window.partitionBy("set_id")
    unique = F.col("size") - F.count(F.lit(1)).over(own)
    reach = F.col("size") - F.greatest(F.lit(1), F.ceil(F.col("size") * F.lit(least_shared))) + 1
    central = F.sum(F.log("often")).over(own) / F.col("size")
    at = F.row_number().over(own.orderBy("often", "v")) + unique
    return listed.select("v", "set_id", "n", central.alias("central"), at.alias("at"), reach.alias("reach")).where("at <= reach").drop("at", "reach")


def _estimated(pairs: DataFrame, classes: DataFrame, threshold: int, k: int) -> DataFrame:
    """Pairs whose merged sketch does not rule the threshold out."""
    side = classes.select("set_id", "sketch")
    both = pairs.join(side.toDF("a", "sketch_a"), "a").join(side.toDF("b", "sketch_b"), "b")
    union = F.slice(F.array_sort(F.array_union("sketch_a", "sketch_b")), 1, k)
    shared = F.size(F.array_intersect(F.array_intersect("sketch_a", "sketch_b"), union))
    size = F.size(union)
    deviation = F.sqrt(F.lit(threshold / 100 * (1 - threshold / 100)) / size)
    return both.where(shared >= size * (F.lit(threshold / 100) - 5 * deviation)).select("a", "b")


def _confirm(threshold: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, rows=2000, chars=32_000_000):
            x, y = batch.column("items_a"), batch.column("items_b")
            keep = []
            for i in range(batch.num_rows):
                p, q = x[i].values.to_numpy(), y[i].values.to_numpy()
                shared = len(p) + len(q) - len(np.union1d(p, q))
                keep.append(100 * shared >= threshold * (len(p) + len(q) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _linked(pairs: DataFrame, documents: DataFrame, classes: DataFrame, width: int, threshold: int) -> DataFrame:
    """Pairs confirmed on full sets, which are made again only for the sets that occur in a pair."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("set_id")).distinct()
    items = _full_sets(wanted, documents, classes, width)
    half = pairs.join(items.toDF("b", "items_b"), "b")
    return half.join(items.toDF("a", "items_a"), "a").mapInArrow(_confirm(threshold), "a binary, b binary")


def _full_sets(wanted: DataFrame, documents: DataFrame, classes: DataFrame, width: int) -> DataFrame:
    """(set_id, items) for the wanted sets, from the text of one document of each."""
    rows = classes.join(wanted, "set_id", "left_semi").select(F.col("first_id").alias("doc_id")).distinct()
    texts = documents.join(rows, documents["doc_id"].eqNullSafe(rows["doc_id"]), "left_semi")
    made = texts.select("text").mapInArrow(_full(width), "set_id binary, items array<bigint>")
    return stored(made.join(wanted, "set_id", "left_semi").dropDuplicates(["set_id"]), "neardup-sets")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges(a, b)``: the smallest node it can reach, by alternating large and small stars."""
    edges = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "neardup-edges")
    mark = lambda e: e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % F.lit(1 << 30))).first()
    before = mark(edges)
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        edges = stored(small.where("u <> v").distinct(), "neardup-edges")
        after = mark(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)


def _with_root(members: DataFrame, roots: DataFrame) -> DataFrame:
    return members.join(roots.select(F.col("node").alias("set_id"), "root"), "set_id", "left").withColumn("root", F.coalesce("root", "set_id"))


def groups(documents: DataFrame, width: int = WIDTH, threshold: int = THRESHOLD, k: int = K) -> DataFrame:
    """(doc_id, set_id, n_shingles, component_id), one row for each row of ``documents(doc_id, text)``.

    ``component_id`` is the smallest doc_id in reach over links of at least
    ``threshold`` hundredths of Jaccard similarity.
    """
    documents = pick(documents, {"doc_id": "bigint", "text": "string"})
    drawn = stored(sketches(documents, width, k), "neardup-sketches")
    classes = stored(
        drawn.where("set_id is not null")
        .groupBy("set_id")
        .agg(F.min("doc_id").alias("first_id"), F.first("n").alias("n"), F.first("sketch").alias("sketch")),
        "neardup-classes",
    )
    values = classes.select("set_id", "n", F.size("sketch").alias("size"), F.explode("sketch").alias("v"))
    lists = stored(_rarest(values, LEAST_SHARED), "neardup-lists")
    firsts = lists.groupBy("v").agg(F.max(F.struct("central", "set_id")).alias("top")).select("v", F.col("top.set_id").alias("a"))
    stars = lists.join(firsts, "v").where("a <> set_id").select("a", F.col("set_id").alias("b"))
    stars = stored(stars.distinct(), "neardup-stars")
    links = stored(_linked(_estimated(stars, classes, threshold, k), documents, classes, width, threshold), "neardup-links")
    roots = components(links)

    placed = _with_root(lists, roots)
    open_lists = placed.groupBy("v").agg(F.count(F.lit(1)).alias("members"), F.min("root").alias("lo"), F.max("root").alias("hi"))
    open_lists = open_lists.where("lo <> hi and members > 2").select("v")
    rest = stored(placed.join(open_lists, "v", "left_semi").select("set_id", "root").distinct(), "neardup-open")
    more = _across(rest, documents, classes, width, threshold)
    roots = components(links.union(stored(more, "neardup-links")))

    named = _with_root(classes.select("set_id", "first_id"), roots)
    labels = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = stored(named.join(labels, "root").select("set_id", "component_id"), "neardup-named")
    return drawn.join(named, "set_id", "left").select(
        "doc_id", "set_id", F.col("n").alias("n_shingles"), F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    )


def _across(rest: DataFrame, documents: DataFrame, classes: DataFrame, width: int, threshold: int) -> DataFrame:
    """Confirmed pairs (a, b) of different components among ``rest(set_id, root)``.

    Sets are listed by the rarest part of their full items: no pair over the
    threshold can share none of it. Sets that meet in lists of several
    components make a region. A region is dealt into blocks of about
    ``BLOCK`` sets, those of one large component into blocks of their own, and
    each pair of blocks that can hold a link is compared by itself.
    """
    sets = _full_sets(rest.select("set_id"), documents, classes, width)
    values = sets.select("set_id", F.size("items").cast("bigint").alias("n"), F.size("items").alias("size"), F.explode("items").alias("v"))
    lists = stored(_rarest(values, threshold / 100).select("v", "set_id").join(rest, "set_id"), "neardup-open-lists")
    heads = lists.groupBy("v").agg(F.min("set_id").alias("a"), F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi")
    regions = components(lists.join(heads, "v").select("a", F.col("set_id").alias("b"))).select(F.col("node").alias("set_id"), F.col("root").alias("region"))
    placed = stored(rest.join(regions, "set_id"), "neardup-regions")
    sizes = placed.groupBy("region", "root").agg(F.count(F.lit(1)).alias("of_root"))
    own = F.when(F.col("of_root") >= BLOCK, F.col("root"))
    sizes = sizes.withColumn("part", own)
    parts = sizes.groupBy("region", "part").agg(F.ceil(F.sum("of_root") / BLOCK).cast("int").alias("blocks"))
    placed = placed.join(sizes.drop("of_root"), ["region", "root"]).alias("p").join(
        parts.alias("q"), (F.col("p.region") == F.col("q.region")) & F.col("p.part").eqNullSafe(F.col("q.part"))
    )
    placed = placed.select("p.region", "set_id", "root", "p.part", F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int").alias("at"))
    placed = stored(placed.withColumn("block", F.xxhash64("region", F.coalesce("part", F.unhex(F.lit(""))), "at")), "neardup-blocks")
    blocks = placed.select("region", "part", "block").distinct()
    x, y = blocks.toDF("region", "part_x", "x"), blocks.toDF("region", "part_y", "y")
    met = x.join(y, "region").where((F.col("x") <= F.col("y")) & ~F.coalesce(F.col("part_x") == F.col("part_y"), F.lit(False))).select("x", "y")
    sides = met.select("x", "y", F.explode(F.array_distinct(F.array("x", "y"))).alias("block"))
    full = placed.select("set_id", "root", "block").join(sets, "set_id")
    return sides.join(full, "block").select("x", "y", "block", "set_id", "root", "items").groupBy("x", "y").applyInArrow(_compare(threshold), "a binary, b binary")


def _compare(threshold: int) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        block, ids = table.column("block").to_numpy(), table.column("set_id").to_pylist()
        roots = table.column("root").to_pylist()
        items = [x.values.to_numpy() for chunk in table.column("items").chunks for x in chunk]
        first = block == table.column("x")[0].as_py()
        left = np.flatnonzero(first)
        right = left if first.all() else np.flatnonzero(~first)
        values = np.concatenate([items[j] for j in right])
        owner = np.repeat(np.arange(len(right)), [len(items[j]) for j in right])
        order = np.argsort(values, kind="stable")
        values, owner = values[order], owner[order]
        sizes = np.array([len(items[j]) for j in right])
        a, b = [], []
        for i in left.tolist():
            lo, hi = np.searchsorted(values, items[i], "left"), np.searchsorted(values, items[i], "right")
            n = hi - lo
            at = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
            shared = np.bincount(owner[at], minlength=len(right))
            linked = 100 * shared >= threshold * (len(items[i]) + sizes - shared)
            for j in right[linked].tolist():
                if roots[i] != roots[j]:
                    a.append(ids[i])
                    b.append(ids[j])
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    return run


def keep_first(documents: DataFrame, width: int = WIDTH, threshold: int = THRESHOLD) -> DataFrame:
    """``documents`` without near-duplicates: of each group the document with the smallest doc_id stays.

    Rows that share a doc_id stand or fall together, and equal ones count once.
    Rows without a doc_id stay.
    """
    documents = pick(documents, DOCUMENT_COLUMNS)
    found = groups(documents, width, threshold)
    gone = found.where("doc_id <> component_id").select("doc_id")
    texts = documents.withColumn("digest", F.xxhash64("text"))
    named = texts.where("doc_id is not null").join(gone.distinct(), "doc_id", "left_anti").dropDuplicates(["doc_id", "digest"])
    return named.union(texts.where("doc_id is null")).select(*DOCUMENT_COLUMNS)
