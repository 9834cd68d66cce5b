"""Language, toxicity and quality: held-out accuracy, the methods' parts, edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrane.llm import language, quality, toxicity
from terrane.llm import queries as Q
from terrane.llm.common import fold

SF = "/root/testdata/sf0.01"


def test_language_masks_name_every_language_that_has_the_gram():
    filters = language.Filters(("a", "b"), np.zeros(1 << 12, np.uint64), 2, 0)
    g = language.grams("hello there")
    for h in range(2):
        filters.slots[filters.places(g[:4], h)] |= np.uint64(1)
        filters.slots[filters.places(g, h)] |= np.uint64(2)
    assert (filters.masks(g[:4]) == 3).all()
    assert (filters.masks(g) & np.uint64(2) == 2).all()
    fill = filters.false_positives()
    assert 0 < fill[0] < fill[1] < 0.01


def test_no_letter_no_gram():
    for text in ("", "12 34", "² ³ ½", "__ -- ##", " \n"):
        assert not len(language.grams(text))
    assert len(language.grams("² a"))


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = Q.op10_language(spark, SF).join(docs.select("doc_id", "lang"), "doc_id")
    right, n = got.where("held_out").agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert right / n > 0.98
    assert got.count() == docs.count()


def test_language_odd_rows(spark, odd, none):
    filters = language.fit(odd, "text", "lang", "doc_id", fold(F.col("doc_id"), 3) != 7, min_docs=1)
    got = language.predict(odd, "text", filters, odd.columns[:6]).collect()
    assert len(got) == odd.count()
    assert {r.lang_pred for r in got if not any(c.isalpha() for c in r.text or "")} == {"und"}
    assert all(0 <= r.score <= 1 for r in got)
    assert next(r for r in got if r.doc_id == 7).lang_pred == "de"
    empty = language.fit(none, "text", "lang", "doc_id", F.lit(True))
    assert {r.lang_pred for r in language.predict(odd, "text", empty, ["doc_id"]).collect()} == {"und"}
    assert language.predict(none, "text", filters, ["doc_id"]).count() == 0


def test_toxicity_risk_is_non_negative_and_ranks():
    rng = np.random.default_rng(1)
    usual = lambda: rng.choice(np.arange(100, 2000), 40, replace=False)
    toxic = [np.append(usual(), [7, 8]) for _ in range(60)]
    other = [usual() for _ in range(540)] + [np.append(usual(), [7, 8]) for _ in range(60)]
    clf = toxicity.learn(toxic, other, prior=0.1)
    f = lambda x: clf.intercept + clf.weights[x].sum()
    assert np.mean([f(x) > 0 for x in toxic]) > 0.95
    assert np.mean([f(x) < 0 for x in other[:540]]) > 0.98
    assert toxicity.learn([], other, 0.1).scorer()("x") == 0.0


def test_toxicity_held_out(spark):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = Q.op2_toxicity(spark, "/root/testdata/sf0.1").join(labels, "doc_id").where("held_out").groupBy("toxic", "predicted").count().collect()
    n = {(r.toxic, r.predicted): r["count"] for r in got}
    assert n[1, 1] / (n[1, 1] + n.get((1, 0), 0)) > 0.88
    assert n.get((0, 1), 0) / (n[0, 0] + n.get((0, 1), 0)) < 0.02


def test_toxicity_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (5, 0), (7, None), (None, 1), (1, 0), (3, 5)], "doc_id long, toxic int")
    for docs, known in ((odd, labels), (odd, labels.limit(0)), (none, labels)):
        model = toxicity.fit(docs, "text", "doc_id", known, "toxic", F.lit(True))
        got = toxicity.score(docs, "text", model, ["doc_id", "node"]).collect()
        assert len(got) == docs.count()
        assert all(0 <= r.score <= 1 for r in got)


def test_quality_gradient_matches_differences():
    net = quality.Network.fresh(width=3, filters=4, hop=16)
    data = net.padded("some text, and a little more of it than one hop has places for")
    found = net.gradient(data, 1.0)
    loss = lambda: np.logaddexp(0, -net.logit(net.pooled(net.peaks(data)[0])))
    net.head = net.head.astype(np.float64)
    for p, g, at in ((net.head, found[2], 5), (net.bias, found[1], 2), (net.table, found[0], np.unravel_index(np.abs(found[0]).argmax(), found[0].shape))):
        old, step = p[at].copy(), 1e-3
        p[at] = old + step
        up = loss()
        p[at] = old - step
        down = loss()
        p[at] = old
        assert (up - down) / (2 * step) == pytest.approx(g[at], rel=0.05, abs=1e-4)


def test_quality_sees_the_whole_text():
    net = quality.Network.fresh()
    net.trained = True
    usual = "plain words follow each other here " * 4000
    # The passage that beats every peak of one filter: its greatest weight at each place, in ASCII.
    sign = "".join(chr(32 + net.table[k, 32:127, 0].argmax()) for k in range(len(net.table)))
    scores = {net.score(usual[:at] + sign * 10 + usual[at:]) for at in (0, len(usual) // 2, len(usual))}
    assert net.score(usual) not in scores
    assert net.score("") == net.score(None)


def test_quality_held_out(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = Q.op3_quality(spark, SF).join(labels, "doc_id").where("held_out")
    right, n = got.agg(F.sum((F.col("quality") == F.col("predicted")).cast("int")), F.count("*")).first()
    assert right / n > 0.93


def test_quality_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (5, 0), (7, None), (None, 1), (3, 5)], "doc_id long, quality int")
    for docs, known in ((odd, labels), (odd, labels.limit(0)), (none, labels)):
        net = quality.fit(docs, "text", "doc_id", known, "quality", F.lit(True))
        got = quality.score(docs, "text", net, ["doc_id", "label"]).collect()
        assert len(got) == docs.count()
        assert all(0 <= r.score <= 1 for r in got)


def test_language_of_many_labels(spark):
    """70 languages, each with letters of its own: the rarest ones too are found, also from one or two documents."""
    name = lambda k: f"l{k:02}"
    word = lambda k, i: "".join(chr(0x4E00 + 40 * k + (i * 7 + j) % 40) for j in range(6))
    rows = [(100 * k + i, " ".join(word(k, i + j) for j in range(30)), name(k)) for k in range(70) for i in range(1 if k == 69 else 2 if k == 68 else 5 + k % 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    filters = language.fit(docs, "text", "lang", "doc_id", F.lit(True))
    assert filters.languages == tuple(name(k) for k in range(70))
    got = language.predict(docs, "text", filters, ["doc_id", "lang"]).collect()
    assert len(got) == len(rows)
    assert all(r.lang == r.lang_pred and r.score > 0.9 for r in got)
