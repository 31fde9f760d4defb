import hashlib

import numpy as np

from conftest_llm import clashing, documents, ODD
from strikepath.llm import spotsigs
from strikepath.llm.queries import op9_spotsigs


def sets(texts):
    return spotsigs.Spotter().sets(texts)


def brute(text):
    """Chains as tuples: the anchor and the next three content words."""
    words = [w.strip(spotsigs._EDGES).lower() for w in text.split()]
    words = ["", *[w for w in words if w]]
    content = [w for w in words[1:] if w not in spotsigs.COMMON]
    out, seen = set(), 0
    for k, w in enumerate(words):
        if k and w not in spotsigs.COMMON:
            seen += 1
        elif content and (k == 0 or seen + spotsigs.CHAIN <= len(content)):
            out.add((w, *content[seen : seen + spotsigs.CHAIN]))
    return out


def test_signatures_and_likeness_equal_brute_force():
    a = "The quick brown fox jumps over the lazy dog and a cat, with the old grey mouse in der Tat."
    b = a.replace("lazy", "sleepy")
    texts = [a, b, "", "the of", "word", "the one"]
    made = sets(texts)
    for text, got in zip(texts, made, strict=True):
        assert len(got) == len(brute(text))
    x, y = brute(a), brute(b)
    assert spotsigs.likeness(made[0], made[1]) == len(x & y) / len(x | y)
    assert spotsigs.likeness(made[2], made[3]) == 1.0 and spotsigs.likeness(made[0], made[2]) == 0.0


def test_pruning_never_hides_a_pair_over_the_threshold():
    rng = np.random.default_rng(0)
    for _ in range(300):
        a = np.unique(rng.integers(0, 60, rng.integers(1, 50)).astype(np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.9], rng.integers(0, 60, rng.integers(0, 8)).astype(np.uint64)]))
        exact = spotsigs.likeness(a, b)
        for least in (0.3, 0.5, 0.75, 0.9):
            assert spotsigs.likeness(a, b, least) == exact or exact < least


def follow(rows):
    """Expected (doc_id, n_chars, sha of the edited text) in the order of documents."""
    out = []
    for k, (i, t) in enumerate(rows):
        t, n = t or "", len(t or "") // 4
        edited = t[: len(t) - n] + (rows[(k + 1) % len(rows)][1] or "")[:n]
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest()))
    return out


def test_each_document_meets_the_next_one_in_any_number_of_blocks(spark):
    rows = [(i * i, f"the text number {i} of the many é " * (i % 5)) for i in range(57)] + [(9000, None), (9001, "")]
    for per_block in (3, 20_000):
        out = spotsigs.followed(clashing(spark, rows).repartition(5), per_block).collect()
        assert sorted((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in out) == sorted(follow(rows))
    one = spotsigs.followed(documents(spark, [(5, "the only one text of all")])).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0
    assert spotsigs.followed(documents(spark, [])).count() == 0
    assert spotsigs.followed(documents(spark, ODD)).count() == len(ODD)


def test_query_has_every_document_and_equal_texts_have_equal_fingerprints(spark, sf_dir):
    docs = sorted(((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()))
    out = {r["doc_id"]: r for r in op9_spotsigs(spark, sf_dir).collect()}
    assert [(i, out[i]["n_chars"], out[i]["edited_sha256"]) for i, _ in docs] == follow(docs)
    prints = {}
    for i, t in docs:
        assert prints.setdefault(t, out[i]["fingerprint"]) == out[i]["fingerprint"]
    near = [out[i]["near_edited"] - out[i]["near_next"] for i, t in docs if len(t) > 400]
    assert sum(x > 0.2 for x in near) > 0.9 * len(near)
