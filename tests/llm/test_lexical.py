import math
import random
from collections import Counter

import numpy as np

from conftest_llm import clashing, documents, ODD
from strikepath.llm import lexical


def brute(rows, items, k=20):
    def terms(text):
        return Counter("".join(c.lower() if "A" <= c <= "Z" else c if c >= "\x80" or c.isascii() and c.isalnum() else " " for c in text or "").split(" "))

    counts = [(i, Counter({t: n for t, n in terms(x).items() if t})) for i, x in rows]
    lengths = [sum(c.values()) for _, c in counts]
    docs, total = sum(n > 0 for n in lengths), sum(lengths)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in set(items):
        scores = []
        for (i, c), n in zip(counts, lengths, strict=True):
            score = 0
            for t, repeats in terms(text).items():
                if t and t in c:
                    w = math.floor(1000 * math.log((2 * docs + 2) / (2 * df[t] + 1)))
                    score += repeats * w * ((10**9 * c[t]) // (1000 * c[t] + 12 * (75 + 25 * n * docs // total)))
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, rank, x[3], -x[0]) for rank, x in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def found(df, items, **kw):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in lexical.search(df, items, **kw).collect()), key=str)


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id bigint, text string")


def test_equals_brute_force_over_shards_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(lexical, "SHARD", 37)
    monkeypatch.setattr(lexical, "BLOCK", 3)
    monkeypatch.setattr(lexical, "FIRST_READ", 2)
    rng = random.Random(11)
    vocabulary = [f"{x}{i}" for i in range(60) for x in ("a", "É", "Z", "日本")]
    weights = [1 / (k + 1) for k in range(len(vocabulary))]
    rows = [(i, rng.choice([" ", ", ", "-", "\n"]).join(rng.choices(vocabulary, weights, k=rng.choice([0, 1, 5, 40, 200])))) for i in range(300)]
    rows += [(400 + i, rows[7][1]) for i in range(30)]
    items = [(k, " ".join(rng.choices(vocabulary, weights, k=rng.choice([1, 3, 30])))) for k in range(10)] + [(20, None), (21, "nowhere"), (22, "")]
    assert found(documents(spark, rows), items_of(spark, items)) == brute(rows, items)


def test_stops_early_and_only_strictly_below():
    """One rare list decides: reading stops long before the common list ends, yet equal scores all count."""
    n = 4000
    terms = np.concatenate([np.zeros(n, np.int64), np.ones(40, np.int64)])
    docs = np.concatenate([np.arange(n), np.arange(3960, 4000)])
    shard = lexical.Shard(terms, docs, np.full(n + 40, 10, np.int64), n)
    assert shard.best([0, 1], [1, 100], 20) == [(d, 1010) for d in range(3960, 3980)]
    assert shard.best([0], [1], 20) == [(d, 10) for d in range(20)]
    assert shard.best([5], [1], 20) == [] and shard.best([0], [0], 20) == []


def test_table_with_every_bit_shared(spark, monkeypatch):
    """Terms that share a bit are told apart by the join."""
    monkeypatch.setattr(lexical, "BITS", 1)
    rows = [(i, f"red{i % 3} blue{i % 5} green") for i in range(30)]
    items = [(1, "red1 blue2"), (2, "green")]
    assert found(documents(spark, rows), items_of(spark, items)) == brute(rows, items)


def test_odd_rows(spark):
    items = [(1, "one two"), (1, "one two"), (2, None), (3, "LO a"), (None, "seven")]
    assert found(clashing(spark, ODD), items_of(spark, items)) == brute(ODD, items)
    assert found(documents(spark, []), items_of(spark, items)) == []
    assert found(documents(spark, ODD), items_of(spark, [])) == []
