import random

from conftest_llm import clashing, documents, ODD
from strikepath.llm import near_dup


def brute(rows, threshold=75):
    def shingles(text):
        w = (text or "").encode().lower().split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()

    sets = [(i, shingles(t)) for i, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x in range(len(rows)):
        for y in range(x):
            a, b = sets[x][1], sets[y][1]
            if a and b and 100 * len(a & b) >= threshold * len(a | b):
                parent[max(find(x), find(y))] = min(find(x), find(y))
    ids = {}
    for x, (i, _) in enumerate(rows):
        if i is not None:
            ids[find(x)] = min(i, ids.get(find(x), i))
    return sorted(((i, len(s), ids.get(find(x))) for x, (i, s) in enumerate(sets)), key=str)


def groups(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in near_dup.groups(df).collect()), key=str)


def test_components_equal_brute_force(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    shared = [rng.choice(vocabulary) for _ in range(60)]
    rows, base = [], None
    for i in range(160):
        if i % 8 == 0:
            base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 12, 80, 200]))]
            if i % 16 == 0:
                base += shared
        words = list(base)
        for _ in range(rng.choice([0, 0, 1, 2, 3, 5]) if len(words) > 20 else rng.choice([0, 0, 1])):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        rows.append((i * 3 + 1, " ".join(words)))
    rng.shuffle(rows)
    assert groups(documents(spark, rows)) == brute(rows)


def test_group_of_edited_copies_across_blocks(spark, monkeypatch):
    """Copies so edited that most are linked by chance only; small blocks make them meet across blocks."""
    monkeypatch.setattr(near_dup, "BLOCK", 4)
    rng = random.Random(5)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(60):
        words = list(base)
        for k in rng.sample(range(120), rng.choice([2, 3, 4])):
            words[k] = f"e{rng.randrange(40)}"
        rows.append((i, " ".join(words)))
    assert groups(documents(spark, rows)) == brute(rows)


def test_odd_rows(spark):
    got = groups(clashing(spark, ODD))
    assert got == brute(ODD)
    assert near_dup.groups(documents(spark, [])).count() == 0
    kept = near_dup.keep_first(documents(spark, ODD)).collect()
    assert sorted(str(r["doc_id"]) for r in kept) == ["1", "2", "3", "4", "9", "None"]
