"""Stages against what they must keep and drop, over the smallest documents and over odd rows."""

import re

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from terrane.llm import stages
from terrane.sources import stage
from tests.llm.test_near import exact

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """The documents, and what each stage makes of them."""
    out = [spark.read.parquet(f"{SF}/documents.parquet")]
    for _, apply in corpus_pipeline.STAGES:
        out.append(stage(apply(spark, out[-1], SF)))
    return [{r.doc_id: r for r in df.collect()} for df in out]


def test_stages_only_drop_and_cut(steps):
    for before, after in zip(steps[:-2], steps[1:-1], strict=True):
        assert set(after) <= set(before)
        assert all(r.n_chars == len(r.text) for r in after.values())
    assert set(steps[5]) == set(steps[4])
    assert len(steps[4]) > 0.5 * len(steps[0])
    assert all(steps[1][i] == steps[0][i] for i in steps[1])
    assert all(steps[4][i] == steps[3][i] == steps[2][i] for i in steps[4])


def test_toxic_documents_go(steps):
    labels = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{SF}/labels.parquet'").fetchall())
    toxic = [i for i, t in labels.items() if t and i in steps[0]]
    clean = [i for i, t in labels.items() if t == 0 and i in steps[0]]
    assert sum(i in steps[1] for i in clean) >= 0.97 * len(clean)
    assert sum(i in steps[1] for i in toxic) <= 0.5 * len(toxic)


def test_near_copies_leave_one(steps):
    ids = sorted(steps[2])
    labels = exact([steps[2][i].text for i in ids])
    assert sorted(steps[3]) == [ids[i] for i in sorted(set(labels))]


def test_benchmark_passages_go(steps):
    split = lambda t: " ".join(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t)))
    items = [(i, split(t)) for i, t in duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()]
    windows = {tuple(w[k : k + 10]) for _, t in items for w in [t.split()] for k in range(max(1, len(w) - 9))}
    for i, row in steps[3].items():
        words = split(row.text).split()
        dirty = any(tuple(words[k : k + 10]) in windows for k in range(len(words)))
        assert (i in steps[4]) != dirty


def test_samples_decode(steps):
    assert all(r.round_trip and len(r.samples) == 2 for r in steps[5].values())


def test_run(spark, steps):
    assert {r.doc_id for r in corpus_pipeline.run(spark, SF).select("doc_id").collect()} == set(steps[5])


def test_odd_rows(spark, odd, none):
    for docs in (odd, none):
        for name, apply in corpus_pipeline.STAGES:
            got = apply(spark, docs, SF)
            rows = got.collect()
            assert len(rows) <= docs.count()
            if name != corpus_pipeline.STAGES[-1][0]:
                assert got.columns == docs.columns, name
                assert got.dtypes == docs.dtypes, name


def test_emptied_documents_go(spark):
    docs = spark.createDataFrame([(1, "a\nb\nc", 5), (2, "a\nb\nc", 5), (3, "x\na\nb\nc", 7), (4, "", 0)], "doc_id long, text string, n_chars long")
    got = {r.doc_id: (r.text, r.n_chars) for r in stages.drop_repeated_lines(spark, docs, SF).collect()}
    assert got == {1: ("a\nb\nc", 5), 3: ("x", 1), 4: ("", 0)}
    assert stages.drop_repeated_lines(spark, docs.drop("n_chars"), SF).select(F.count("*")).first()[0] == 3
