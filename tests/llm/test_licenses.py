import re

from conftest_llm import clashing, documents, ODD
from strikepath.llm import licenses
from strikepath.llm.queries import QUERIES

PHRASES = {"mit": "the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}
TEXTS = [
    "Under The MIT License. the mit license, THE-MIT-LICENSE",
    "cc by nc cc by cc by nc",
    "Apache License, Version 2.0 or Apache license version 3",
    "KIT K the mit licenſe theé mit license",
    licenses.TEMPLATES[3].text,
    "words before " + licenses.TEMPLATES[8].text + " words after",
    "the license of mit: permission granted",
]


def brute(text):
    upper = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(upper))
    starts, labels = [], set()
    for label, phrase in PHRASES.items():
        p = phrase.split()
        found = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        starts += found
        labels |= {label} if found else set()
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), sorted(labels)


def test_base_equals_brute_force_and_templates_add_labels(spark):
    rows = [*enumerate(TEXTS), *[(100 + i, t) for i, (_, t) in enumerate(ODD)]]
    out = {r["doc_id"]: r for r in licenses.scan(clashing(spark, rows)).collect()}
    for i, text in rows:
        r = out[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute(text)
        assert set(r["base_labels"]) <= set(r["labels"]) and 0 <= r["score"] <= 1
    assert out[4]["labels"] == ["mit"] and out[4]["score"] == 1.0
    assert out[5]["labels"] == ["gpl-3"] and out[6]["labels"] == []


def test_empty_table(spark):
    assert licenses.scan(documents(spark, [])).count() == 0


def test_query_counts_its_own_phrases(spark, tmp_path, monkeypatch):
    """Its base phrase is "under the mit license"; the licence's name alone still labels."""
    monkeypatch.setitem(PHRASES, "mit", "under the mit license")
    more = ["x under the MIT license, Under-The_MIT/License", "under the mit", "under the mit, under the mit license, version 2", "CC BY NC under the MIT License", "see the MIT license"]
    rows = [*enumerate(TEXTS + more), *[(100 + i, t) for i, (_, t) in enumerate(ODD)]]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    out = {r["doc_id"]: r for r in QUERIES["op2_licenses"](spark, str(tmp_path)).collect()}
    for i, text in rows:
        *counts, labels = brute(text)
        r = out[i]
        assert [r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]] == [*counts, ",".join(labels)], text
        assert set(labels) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
    assert (out[0]["n_base"], out[0]["first_word"], out[7]["n_base"], out[7]["last_word"]) == (1, 0, 2, 5)
    assert (out[8]["labels"], out[11]["n_base"], out[11]["labels"], out[11]["score"]) == ("", 0, "mit", 1.0)
