import random

from conftest_llm import clashing, documents, ODD
from strikepath.llm import line_dedup


def keys_to_delete(rows):
    """Lines of five words or more that a document with a smaller id has."""
    first = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            first[line.strip()] = min(i, first.get(line.strip(), i))
    return {i: {k for k, line in enumerate((t or "").split("\n")) if len(line.split()) >= 5 and first[line.strip()] < i} for i, t in rows}


def test_every_repeated_key_line_goes_and_no_other(spark):
    rng = random.Random(1)
    lines = [" ".join(f"x{rng.randrange(50)}" for _ in range(rng.choice([1, 2, 5, 9]))) for _ in range(60)]
    rows = [(i, "\n".join(rng.choice(lines) if rng.random() < 0.5 else f"own {i} {k} line of it" for k in range(rng.randrange(12)))) for i in range(80)]
    got = {r["doc_id"]: r for r in line_dedup.dedup(documents(spark, rows)).collect()}
    for i, wanted in keys_to_delete(rows).items():
        text = dict(rows)[i].split("\n")
        cut = set(got[i]["cut"])
        assert wanted <= cut
        assert all(len(text[k].split()) < 5 for k in cut - wanted)
        assert got[i]["kept_text"] == "\n".join(x for k, x in enumerate(text) if k not in cut)


def test_short_lines_go_only_within_an_aligned_block():
    a = ["one two three four five", "short", "six seven eight nine ten", "end"]
    b = ["short", "mine", *a[:3], "short"]
    words = [line_dedup.count_words(x) for x in b]
    assert line_dedup.common_blocks(a, b, words) == [2, 3, 4]
    assert line_dedup.patience(list("abcdx"), list("abxcd")) in ([(0, 0), (1, 1), (2, 3), (3, 4)], [(0, 0), (1, 1), (4, 2)])


def test_moved_and_repeated_blocks_go_too():
    p, q = ["p one two three four", "p five six seven eight"], ["q one two three four", "q five six seven eight"]
    b = [*q, "own", *p, *p]
    assert line_dedup.common_blocks([*p, "other", *q], b, [5, 5, 1, 5, 5, 5, 5]) == [0, 1, 3, 4, 5, 6]


def test_odd_rows(spark):
    out = line_dedup.dedup(clashing(spark, ODD)).collect()
    assert len(out) == len(ODD) and all(r["cut"] == [] for r in out)
    assert line_dedup.dedup(documents(spark, [])).count() == 0
    twice = [(1, "a b c d e f"), (2, "a b c d e f"), (3, "a b c d e f\nown"), (None, "a b c d e f\nnew")]
    kept = line_dedup.without_repeats(documents(spark, twice)).collect()
    assert sorted((str(r["doc_id"]), r["text"], r["n_chars"]) for r in kept) == [("1", "a b c d e f", 11), ("3", "own", 3), ("None", "new", 3)]


def test_passages_inside_longer_lines_go(spark):
    """50 words that start and end mid-line, with no sentence end in them, go from the later document, also over a line break."""
    words = [f"p{k}" for k in range(50)]
    flat, broken = " ".join(words), " ".join(words[:20]) + "\n" + " ".join(words[20:])
    rows = [
        (1, f"before one {flat} after one"), (2, f"  before two {flat}  behind two\nnext line"), (3, f"three {broken} end"), (4, f"four {' '.join(words[:49])} end"),
        (5, f"five {' '.join(words[:30])}\n{' '.join(words[30:])}\nlast"), (None, f"six {flat} fin"),
    ]
    got = {r["doc_id"]: r for r in line_dedup.dedup(documents(spark, rows)).collect()}
    assert {i: r["kept_text"] for i, r in got.items()} == {
        1: rows[0][1], 2: "  before two  behind two\nnext line", 3: "three\nend", 4: rows[3][1], 5: "five\nlast", None: "six fin",
    }
    assert {i: (r["cut"], r["partners"]) for i, r in got.items()} == {1: ([], []), 2: ([], [1]), 3: ([], [1]), 4: ([], []), 5: ([1], [1]), None: ([], [1])}
    kept = {r["doc_id"]: r for r in line_dedup.without_repeats(documents(spark, rows)).collect()}
    assert len(kept) == 6 and kept[3]["text"] == "three\nend" and kept[3]["n_chars"] == 9 and kept[1]["n_chars"] == len(rows[0][1])


def test_repeated_passages_equal_brute_force(spark):
    rng, size = random.Random(2), line_dedup.PASSAGE
    known = [[f"k{i} w{rng.randrange(9)}" for _ in range(rng.choice([24, 25, 26, 40]))] for i in range(6)]
    texts = []
    for i in range(60):
        parts = [rng.choice(known) if rng.random() < 0.5 else [f"own{i}x{rng.randrange(10**6)}" for _ in range(rng.randrange(9))] for _ in range(6)]
        texts.append("".join(w + rng.choice([" ", " ", " ", "\n"]) for p in parts for w in p))
    earlier = {}
    for i, t in enumerate(texts):
        w = t.split()
        for k in range(len(w) - size + 1):
            earlier.setdefault(tuple(w[k : k + size]), i)
    got = {r["doc_id"]: r for r in line_dedup.dedup(documents(spark, list(enumerate(texts))), min_words=10**6).collect()}
    n = 0
    for i, t in enumerate(texts):
        w = t.split()
        lost = {j for k in range(len(w) - size + 1) if earlier[tuple(w[k : k + size])] < i for j in range(k, k + size)}
        n += len(lost)
        assert got[i]["kept_text"].split() == [x for j, x in enumerate(w) if j not in lost]
    assert n > 1000
