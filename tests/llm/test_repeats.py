import random

import numpy as np
import pytest

from conftest_llm import clashing, documents, ODD
from strikepath.llm import repeats
from strikepath.llm.common import read
from strikepath.llm.suffixes import suffix_order


def brute(rows, width=repeats.WINDOW):
    place = lambda i: repeats.LAST if i is None else i
    data = [(i, (t or "").encode()) for i, t in rows]
    least = {}
    for i, b in data:
        for k in range(len(b) - width + 1):
            w = b[k : k + width]
            least[w] = min(place(i), least.get(w, place(i)))
    out = []
    for i, b in data:
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - width + 1):
            if least[b[k : k + width]] < place(i):
                gone[k : k + width] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int), [0]])))
        spans = list(zip(edges[::2].tolist(), edges[1::2].tolist()))
        out.append((i, len(b), spans, bytes(np.frombuffer(b, np.uint8)[~gone])))
    return sorted(out, key=str)


def removed(df):
    return sorted(((r["doc_id"], r["n_bytes"], [tuple(s) for s in r["spans"]], bytes(r["kept"])) for r in repeats.removed(df).collect()), key=str)


@pytest.mark.parametrize("alphabet", ["ab", "abc", "aé日."])
def test_order_of_suffixes(alphabet):
    rng = random.Random(alphabet)
    for _ in range(300):
        blocks = [["".join(rng.choices(alphabet, k=rng.randrange(1, 20))).encode() for _ in range(rng.randrange(1, 6))] for _ in range(rng.randrange(1, 6))]
        flat = [s for b in blocks for s in b]
        starts = np.cumsum([0, *map(len, flat[:-1])])
        begins = starts[np.cumsum([0, *map(len, blocks[:-1])])]
        suffix = {a + k: s[k:] for a, s in zip(starts, flat) for k in range(len(s))}
        order = suffix_order(np.frombuffer(b"".join(flat), np.uint8), starts, begins)
        for a, z in zip(begins, [*begins[1:], len(suffix)]):
            assert sorted(order[a:z]) == list(range(a, z))
            found = [suffix[i] for i in order[a:z]]
            assert found == sorted(found)
    assert len(suffix_order(np.empty(0, np.uint8), np.empty(0, int), np.empty(0, int))) == 0


def corpus(rng, n):
    """Unique text, copies, edited copies, passages of 40 to 300 bytes inside others, and one passage that most documents hold."""
    words = ["".join(rng.choices("abcdefgé", k=rng.randrange(1, 9))) for _ in range(300)]
    text = lambda k: " ".join(rng.choices(words, k=k))
    common, passages, rows = text(30), [text(rng.randrange(6, 40)) for _ in range(12)], []
    for i in range(n):
        own = text(rng.choice([0, 3, 30, 120]))
        kind = rng.randrange(6)
        if kind == 1 and rows:
            own = rng.choice(rows)[1]
        elif kind == 2 and rows:
            own = list(rng.choice(rows)[1])
            for _ in range(3 if own else 0):
                own[rng.randrange(len(own))] = rng.choice("xyz")
            own = "".join(own)
        elif kind > 2:
            at = rng.randrange(len(own) + 1)
            own = own[:at] + (common if kind == 3 else rng.choice(passages)) + own[at:]
        rows.append((i * 2, own))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("largest", [1, 4, 32_768])
def test_equals_brute_force(spark, monkeypatch, largest):
    """Small batches, buckets and blocks; with ``largest`` 1 every block is cut into windows."""
    monkeypatch.setattr(repeats, "LARGEST", largest)
    monkeypatch.setattr(repeats, "BUCKET", 5_000)
    rows = corpus(random.Random(largest), 150)
    assert removed(documents(spark, rows).repartition(6)) == brute(rows)


def test_texts_longer_than_a_batch():
    """Strings of a text in parts cover each of its windows once."""
    rng = random.Random(2)
    texts = [bytes(rng.choices(b"abcd ", k=n)) for n in (0, 49, 50, 51, repeats.BATCH * 2 + 77, 300)]
    strings = repeats.Strings(texts)
    for k, data in enumerate(texts):
        own = np.flatnonzero(strings.text == k)
        covered = sorted(w for x in own for w in range(strings.start[x], strings.start[x] + strings.more[x] + 1))
        assert covered == list(range(max(0, len(data) - repeats.WINDOW + 1)))


def test_given_documents(spark, sf_dir):
    df = read(spark, sf_dir, "documents")
    assert removed(df) == brute([tuple(r) for r in df.select("doc_id", "text").collect()])


def test_odd_rows(spark):
    rows = [*ODD, (11, "lo ng " * 40_000), (12, "a" * 70), (13, "a" * 5000), (13, "a" * 60), (None, "b" * 80), (None, "b" * 90), (2, "b" * 51), (5, "é" * 30)]
    assert removed(clashing(spark, rows)) == brute(rows)
    assert removed(documents(spark, [])) == []
