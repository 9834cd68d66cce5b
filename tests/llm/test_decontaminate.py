"""The index against a plain search of every window in every document."""

import random

from terrane.llm import decontaminate as dc


def search(docs, items, size=10):
    out = []
    for _, text in docs:
        words = (text or "").lower().split()
        hit, names = set(), set()
        for name, phrase in items:
            w = (phrase or "").lower().split()
            for at in range(max(1, len(w) - size + 1)) if w else ():
                win = w[at : at + size]
                for i in range(len(words) - len(win) + 1):
                    if words[i : i + len(win)] == win:
                        hit.update(range(i, i + len(win)))
                        names.add(str(name))
        out.append((len(words), len(hit), sorted(names)))
    return out


def test_brute_force(spark):
    rng = random.Random(4)
    word = lambda: rng.choice("a b c d e f g h".split())
    items = [(i, " ".join(word() for _ in range(rng.choice([1, 3, 10, 12, 15])))) for i in range(12)] + [(50, None), (51, "..."), (52, "a a a a a a a a a a a")]
    docs = []
    for i in range(60):
        text = [word() for _ in range(rng.randint(0, 40))]
        if rng.random() < 0.6:
            text += rng.choice(items[:12])[1].split() + ["a"] * rng.choice([0, 14])
        docs.append((i, " ".join(text)))
    left = spark.createDataFrame(docs, "doc_id long, text string")
    right = spark.createDataFrame(items, "item_id long, text string")
    items[-2] = (51, "")
    got = {r.doc.key: (r.n_words, r.n_hit, r.item_ids) for r in dc.contamination(left, "doc_id", "text", right, "item_id", "text").collect()}
    expected = search(docs, items)
    assert [got[i] for i, _ in docs] == expected
    assert any(n for _, n, _ in expected)


def test_words(spark):
    df = spark.createDataFrame([("It's É-Ünit 42_x\tA\n", 1), (None, 2)], "t string, i int")
    assert [r[0] for r in df.orderBy("i").select(dc.words(df.t)).collect()] == [["it", "s", "É", "Ünit", "42", "x", "a"], []]


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "zebra one two quagga"), (2, "quagga " + "x " * 30 + "zebra"), (3, "one two three")], "doc_id long, text string")
    items = spark.createDataFrame([(9, "zebra quagga")], "item_id long, text string")
    phrases = dc.windows(items, "item_id", "text")
    index = dc.PositionalIndex(docs, "doc_id", "text", phrases)
    assert index.matches(phrases).count() == 0
    assert [r.doc.key for r in index.near_matches(5).collect()] == [1]
    assert {r.doc.key for r in index.near_matches(40).collect()} == {1, 2}


def test_without_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(dc, "checked_broadcast", lambda df, rows: df)
    docs = spark.createDataFrame([(1, "p q r s"), (2, "s r q p")], "doc_id long, text string")
    items = spark.createDataFrame([(9, "q r s")], "item_id long, text string")
    got = dc.contamination(docs, "doc_id", "text", items, "item_id", "text").collect()
    assert {r.doc.key: r.n_hit for r in got} == {1: 3, 2: 0}


def test_odd_rows(spark, odd, none):
    items = spark.createDataFrame([(1, "A row without any key, which has"), (None, "third line here"), (3, None)], "item_id long, text string")
    got = dc.contamination(odd, "doc_id", "text", items, "item_id", "text").collect()
    assert len(got) == odd.count()
    assert sorted((r.doc.key is None, r.n_hit) for r in got if r.n_hit) == [(False, 3), (False, 3), (True, 7)]
    assert dc.contamination(none, "doc_id", "text", items, "item_id", "text").count() == 0
    assert all(r.n_hit == 0 for r in dc.contamination(odd, "doc_id", "text", items.limit(0), "item_id", "text").collect())
