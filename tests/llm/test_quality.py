import re
from collections import Counter

import pandas as pd

from conftest_llm import CLASH, clashing, documents, ODD
from strikepath.llm import quality
from strikepath.llm.queries import op6_quality

LABELS = "doc_id bigint, quality int, toxic int"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def brute(text):
    text = text or ""
    w = re.findall("[^\x20\x09-\x0d]+", text)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    seen, covered = Counter(windows), set()
    for i, x in enumerate(windows):
        if seen[x] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


def test_counts_equal_brute_force(spark):
    texts = ["a b c a b c a b c d", "x y z é\n\nx y z é\n \n#*$ %&|<> \x0b\x0c q", "w " * 200, " ".join(f"w{i % 60}" for i in range(130))]
    rows = [*enumerate(texts), *ODD]
    out = quality.judge(documents(spark, rows), spark.createDataFrame([], LABELS)).collect()
    assert Counter(tuple(r[c] for c in COUNTS) for r in out) == Counter(brute(t) for _, t in rows)
    assert all(r["score"] == 0 and r["kept"] == (not r["base_failed"]) for r in out)


def test_held_out_labels_are_told_apart(spark):
    """Trained on half of the labels, the threshold separates the other half."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    half = labels.where("pmod(xxhash64(doc_id), 2) = 0")
    out = quality.judge(docs, half).join(labels.join(half, "doc_id", "left_anti"), "doc_id").where("not base_failed").select("quality", "score", "kept").toPandas()
    assert out[out.quality == 1].kept.mean() > 0.99
    assert out[out.quality == 0].kept.mean() < 0.05


def test_query_counts_equal_brute_force(spark, sf_dir):
    out = op6_quality(spark, sf_dir).toPandas().set_index("doc_id")
    for i, text in pd.read_parquet(f"{sf_dir}/documents.parquet")[["doc_id", "text"]].itertuples(index=False):
        assert tuple(out.loc[i, list(COUNTS)]) == brute(text)


def test_odd_rows(spark):
    labels = spark.createDataFrame([(4, 1, 0), (4, 1, 0), (None, 1, None), (77, 1, 0), (9, None, None)], LABELS)
    out = quality.judge(clashing(spark, ODD), labels).collect()
    assert len(out) == len(ODD)
    assert quality.judge(documents(spark, []), labels).count() == 0
    assert quality.keep_good(spark.createDataFrame([], CLASH), labels).columns == ["doc_id", "text", "lang", "source", "n_chars"]
