"""Queries against their SQL, the pipeline against its stages, and the driver contract."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from conftest_llm import clashing, documents, ODD
import corpus_pipeline
from strikepath.llm.common import read
from strikepath.llm.queries import ORACLE_SQL, QUERIES
from test_near_dup import brute as components
from test_packing import check
from test_secret_scan import brute as secrets_of

TABLES = ("documents", "conversations", "pages", "labels", "benchmark")


def test_all_operators_and_the_pipeline_are_registered():
    assert [q.split("_")[0] for q in QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert {"pipeline", *QUERIES} <= set(entry.queries())
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_repeats", "near_duplicates", "secrets", "packed"]


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_query_equals_sql(spark, sf_dir, name):
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    theirs = db.execute(ORACLE_SQL[name]).df()
    mine = QUERIES[name](spark, sf_dir).toPandas()
    assert sorted(mine.columns) == sorted(theirs.columns)
    columns = sorted(mine.columns)
    rows = lambda df: sorted(map(tuple, df[columns].astype(str).values.tolist()))
    assert rows(mine) == rows(theirs)


def what_stays_of_repeats(rows, kept):
    """Words go if their whole line of five words or more, or a passage of fifty around them, is in an earlier document.

    Every other word stays, but for those of short lines, which may go with a block. How many words went.
    """
    line_of, passage_of = {}, {}
    for i, text in sorted(rows):
        words = text.split()
        for line in text.split("\n"):
            line_of.setdefault(line.strip(), i)
        for k in range(len(words) - 49):
            passage_of.setdefault(hash(tuple(words[k : k + 50])), i)
    gone = 0
    for i, text in rows:
        words = text.split()
        lost = [False] * len(words)
        for k in range(len(words) - 49):
            if passage_of[hash(tuple(words[k : k + 50]))] < i:
                lost[k : k + 50] = [True] * 50
        left, at, place = kept.get(i, "").split(), 0, 0
        for line in text.split("\n"):
            own, here = line.split(), lost[place : place + len(line.split())]
            place += len(own)
            if len(own) >= 5 and line_of[line.strip()] < i:
                here = [True] * len(own)
            stays = [w for w, x in zip(own, here, strict=True) if not x]
            if len(own) < 5 and left[at : at + len(stays)] != stays:
                stays = []
            assert left[at : at + len(stays)] == stays, (i, line)
            at += len(stays)
            gone += len(own) - len(stays)
        assert at == len(left), i
    return gone


def test_pipeline_stage_by_stage(spark, sf_dir, tmp_path):
    """Each stage is judged on its own input; the last one's rows cover what is left."""
    docs, seen = read(spark, sf_dir, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, docs, sf_dir).write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        seen[name] = (before.toPandas(), docs.toPandas())
        if name != "packed":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    before, after = seen["quality_rules"]
    labels = pd.read_parquet(f"{sf_dir}/labels.parquet")
    good = set(labels[labels.quality == 1].doc_id) & set(before[before.text.str.split().str.len() >= 50].doc_id)
    assert good <= set(after.doc_id) and len(after) < len(before)
    before, after = seen["line_repeats"]
    kept = dict(zip(after.doc_id, after.text, strict=True))
    assert what_stays_of_repeats(list(zip(before.doc_id, before.text, strict=True)), kept) > 0
    # A key line need not stay whole where a longer passage takes a part of it, but each of its words stays somewhere.
    key_words = {w for t in before.text for x in t.split("\n") if len(x.split()) >= 5 for w in x.split()}
    assert key_words <= {w for t in after.text for w in t.split()}
    lines = [x.strip() for t in after.text for x in {y.strip() for y in t.split("\n")} if len(x.split()) >= 5]
    assert len(lines) == len(set(lines))
    before, after = seen["near_duplicates"]
    assert set(after.doc_id) == {c for _, _, c in components(list(zip(before.doc_id, before.text, strict=True)))}
    before, after = seen["secrets"]
    assert len(before) == len(after) and not any(secrets_of(t) for t in after.text)
    before, after = seen["packed"]
    check(after.to_dict("records"), list(zip(before.doc_id, before.text, strict=True)))


def test_pipeline_stages_take_odd_rows(spark, tmp_path):
    """Nulls, empty, repeated and very long texts, clashing columns and empty tables, stage by stage and as a whole."""
    sf_dir = str(tmp_path / "odd")
    clashing(spark, ODD).write.parquet(f"{sf_dir}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (9, 0, None), (None, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{sf_dir}/labels.parquet")
    expected = {"quality_rules": 0, "line_repeats": len(ODD), "near_duplicates": 6, "secrets": len(ODD)}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, clashing(spark, ODD), sf_dir)
        if name != "packed":
            assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
            assert out.count() == expected[name], name
        else:
            check([r.asDict() for r in out.collect()], [(i, t or "") for i, t in ODD])
        assert stage(spark, documents(spark, []), sf_dir).count() == 0, name
    assert corpus_pipeline.run(spark, sf_dir).count() == 0
    good = " ".join(f"word{k}" for k in range(80))
    documents(spark, [(1, good), (2, None), (3, good + " more"), (None, good)]).write.parquet(f"{tmp_path}/some/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/some/labels.parquet")
    kept = {r["doc_id"] for r in corpus_pipeline.run(spark, f"{tmp_path}/some").collect()}
    # With so little to learn from the scores may reject any text, but nothing else comes out.
    assert kept <= {1, 3, None}
