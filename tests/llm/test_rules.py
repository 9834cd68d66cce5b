"""Rule statistics against a plain reading, and the forest against a walk down its trees."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrane.llm import queries as Q
from terrane.llm import rules

SF = "/root/testdata/sf0.01"


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(8)}
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)]


def test_counts():
    rng = random.Random(2)
    texts = ["", None, " \n\x0b", "a#b <x> é \x1c z", "x\nx \nx\n\nx\n \n ", "a " * 9, "a " * 8, "\r\nx\r\nx\r\n"]
    for _ in range(200):
        texts.append("".join(rng.choice(["a", "b", "#", "é"]) + rng.choice([" ", " ", "\n", "\x0c"]) for _ in range(rng.randrange(60))))
    for text in texts:
        assert rules.statistics((text or "").encode())[0] == plain(text), text


def test_windows_of_long_texts():
    words = [b"w%d" % (i % 700) for i in range(1300)]
    assert rules.repeated_words(words) == 1200
    assert rules.repeated_words(words[:707]) == 0
    assert rules.repeated_words(words[:708]) == 16


def test_paths_by_walking():
    rows = np.random.default_rng(1).normal(size=(300, 3))
    forest = rules.Forest.grow(rows, trees=7, sample=32)
    for row, score in zip(rows[:40], forest.score(rows[:40]), strict=True):
        paths = []
        for t in range(7):
            node = 0
            while forest.left[t, node] != node:
                node = forest.left[t, node] + (row[forest.feature[t, node]] > forest.value[t, node])
            paths.append(forest.path[t, node])
        assert score == pytest.approx(2 ** (-np.mean(paths) / forest.usual))
    assert forest.score(np.array([[30.0, -30, 30]]))[0] > np.quantile(forest.score(rows), 0.99)
    assert rules.Forest.grow(rows[:1]) is None
    assert np.isfinite(rules.Forest.grow(np.ones((5, 3))).score(np.ones((2, 3)))).all()


def test_threshold():
    assert rules.threshold([(10, 99, 0), (50, 1, 5), (90, 0, 5)], 100, 0.99) == pytest.approx(0.31, abs=0.2)
    assert rules.threshold([(10, 10, 0)], 100, 0.99) == 2.0
    assert rules.threshold([], 100, 0.99) == 2.0
    assert 0.1 < rules.threshold([(10, 98, 0), (80, 2, 0), (90, 0, 5)], 100, 0.99) <= 0.9


def test_every_row_of_the_test_documents(spark):
    got = Q.op13_quality_rules(spark, SF).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(got) == len(texts)
    for r in got:
        counts = [r[c] for c in rules.COUNTS]
        if len(texts[r.doc_id]) < 5000:
            assert counts == plain(texts[r.doc_id])
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.kept and r.base_failed)
    judged = [r for r in got if r.doc_id in labels and not r.base_failed]
    assert np.mean([r.kept for r in judged if labels[r.doc_id] == 1]) >= 0.98
    assert np.mean([r.kept for r in judged if labels[r.doc_id] == 0]) < 0.2


def test_odd_rows(spark, odd, none):
    marks = spark.createDataFrame([(1, 1), (5, 0), (7, None), (None, 1), (3, 5), (1, 0)], "doc_id long, quality int")
    for docs, labels in ((odd, marks), (odd, marks.limit(0)), (none, marks)):
        got = rules.judge(docs, "doc_id", "text", labels, "quality").collect()
        assert len(got) == docs.count()
        assert all(r.base_failed and not r.kept and r.n_words == 0 for r in got if r.word_chars == 0)
        assert all(0 <= r.anomaly <= 1 for r in got)
    # Without labels nothing but the base rules decides.
    assert all(r.kept != r.base_failed for r in rules.judge(odd, "doc_id", "text", marks.limit(0), "quality").collect())


def test_copies_and_hot_keys_do_not_fill_the_sample(spark):
    rng = random.Random(5)
    words = lambda: " ".join("w" * rng.randrange(2, 9) for _ in range(60))
    rows = [(None if i % 3 else 1, "# # # ! " * 30) for i in range(600)] + [(i, words()) for i in range(10, 310)] + [(i, "WWWW!! " * 3 + words()) for i in range(310, 320)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 310)) for i in range(10, 320)], "doc_id long, quality int")
    got = rules.judge(docs, "doc_id", "text", labels, "quality").where(F.col("doc_id") >= 10).collect()
    assert np.mean([r.kept for r in got if r.doc_id < 310]) > 0.97
    assert sum(r.kept for r in got if r.doc_id >= 310) <= 1
