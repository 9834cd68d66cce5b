"""Near-duplicate classes against all pairs, and the parts of the method."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from terrane.llm import near
from terrane.llm.components import components, rooted


def exact(texts, least=0.8):
    """Least index of each text's component by comparing all pairs."""
    memo = near.word_hashes()
    found = [near.shingles(t, memo) for t in texts]
    label = list(range(len(texts)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if texts[i] == texts[j] or near.likeness(found[i], found[j]) >= least:
                a, b = root(i), root(j)
                label[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(texts))]


def corpus(seed, families=8, size=6, words=120):
    rng = random.Random(seed)
    texts = []
    for _ in range(families):
        text = [f"w{rng.randint(0, 500)}" for _ in range(words)]
        for _ in range(size):
            texts.append(" ".join(text))
            if rng.random() < 0.8:
                text = list(text)
                text[rng.randrange(words)] = f"w{rng.randint(0, 500)}"
    rng.shuffle(texts)
    return texts


def classes(spark, texts, **how):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: r.class_id for r in near.classes(docs, "doc_id", "text", **how).collect()}


def test_all_pairs(spark):
    texts = corpus(3)
    assert [classes(spark, texts)[i] for i in range(len(texts))] == exact(texts)


def test_leaders_lose_no_link(spark, monkeypatch):
    """One leader a round, and bands of one register, so that most buckets mix classes."""
    monkeypatch.setattr(near, "LEADERS", 2)
    texts = corpus(5, families=3, size=4, words=60)
    got = classes(spark, texts, bands=3, rows=1)
    assert [got[i] for i in range(len(texts))] == exact(texts)


def test_likeness_by_its_definition():
    rng = np.random.default_rng(2)
    for _ in range(30):
        a, b = (np.unique(rng.integers(0, 12, rng.integers(1, 10))).astype(np.uint64) for _ in range(2))
        x, y = rng.integers(1, 5, len(a)), rng.integers(1, 5, len(b))
        wx, wy = dict(zip(a.tolist(), x.tolist(), strict=True)), dict(zip(b.tolist(), y.tolist(), strict=True))
        expected = sum(1 / sum(max(wx.get(j, 0) / wx[i], wy.get(j, 0) / wy[i]) for j in {*wx, *wy}) for i in wx if i in wy)
        assert near.likeness((a, x), (b, y)) == pytest.approx(expected)


def test_signatures_agree_as_often_as_texts_are_alike():
    rng = np.random.default_rng(3)
    for n in (3, 40, 600):
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        b = np.unique(np.append(a[: n * 4 // 5], rng.integers(0, 2**63, n // 5).astype(np.uint64)))
        x, y = rng.integers(1, 4, len(a)), rng.integers(1, 4, len(b))
        agree = np.equal(*near.signatures([(a, x), (b, y)], 4000)).mean()
        assert agree == pytest.approx(near.likeness((a, x), (b, y)), abs=0.035)


def test_sketches_keep_what_is_alike(spark):
    rng = np.random.default_rng(4)
    rows = []
    for alike in (0.8, 0.4):
        for _ in range(60):
            one = np.unique(rng.integers(0, 2**63, 400).astype(np.uint64))
            keep = int(len(one) * 2 * alike / (1 + alike))
            two = np.unique(np.append(one[:keep], rng.integers(0, 2**63, len(one) - keep).astype(np.uint64)))
            won = near.signatures([(s, np.ones(len(s), int)) for s in (one, two)], 128)
            rows.append((alike, *near.sketches(won).tolist()))
    df = spark.createDataFrame(rows, "alike double, a array<bigint>, b array<bigint>")
    kept = {r.alike: r["count"] for r in df.where(near._may_be_alike("a", "b", 4, 0.8)).groupBy("alike").count().collect()}
    assert kept[0.8] == 60
    assert kept.get(0.4, 0) < 15


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(35)] + [(100 + i, 101 + i) for i in range(50)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    around = defaultdict(set)
    for u, v in edges:
        around[u].add(v)
        around[v].add(u)
    for start in around:
        seen, todo = {start}, [start]
        while todo:
            for x in around[todo.pop()] - seen:
                seen.add(x)
                todo.append(x)
        assert got.get(start, start) == min(seen)


def test_rooted(spark):
    parents = [(i - 1, i) for i in range(1, 40)] + [(50, 60), (50, 61), (60, 70)]
    got = {r.node: r.label for r in rooted(spark.createDataFrame(parents, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(1, 40)}, 60: 50, 61: 50, 70: 50}


def test_odd_rows(spark, odd, none):
    given = odd.drop("class_id")
    got = near.classes(given, "doc_id", "text")
    assert got.columns == [*given.columns, "class_id"]
    rows = got.collect()
    assert len(rows) == odd.count()
    assert all(r.class_id == r.doc_id for r in rows)
    kept = near.keep_one(given, "doc_id", "text")
    assert kept.columns == given.columns
    assert kept.count() == odd.count() - 1  # the repeated row
    assert near.classes(none.drop("class_id"), "doc_id", "text").count() == 0


def test_one_stays_of_near_texts_with_one_key_or_none(spark):
    words = [f"word{i}" for i in range(400)]
    texts = [" ".join([*words, f"end{i}"]) for i in range(4)]
    for key in (7, None):
        docs = spark.createDataFrame([(key, t) for t in texts] + [(9, "another text of its own"), (None, None)], "doc_id long, text string")
        got = near.keep_one(docs, "doc_id", "text").collect()
        assert len(got) == 3
        assert sum(r.text in texts for r in got) == 1
    docs = spark.createDataFrame([(None, texts[0]), (5, texts[1]), (4, texts[2])], "doc_id long, text string")
    assert [r.doc_id for r in near.keep_one(docs, "doc_id", "text").collect()] == [4]


def family(n, edits, words=300, seed=8):
    """Texts that differ from one base in ``edits`` places each, so every two of them are about equally alike."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(words)]
    out = []
    for k in range(n):
        text = list(base)
        for j in rng.sample(range(words), edits):
            text[j] = f"e{k}x{j}"
        out.append(" ".join(text))
    return out


def test_own_shares_bound_the_likeness():
    rng = np.random.default_rng(6)
    for _ in range(300):
        a, b = (np.unique(rng.integers(0, 25, rng.integers(2, 20))).astype(np.uint64) for _ in range(2))
        x, y = rng.integers(1, 6, len(a)), rng.integers(1, 6, len(b))
        p, q = x[~np.isin(a, b)].sum() / x.sum(), y[~np.isin(b, a)].sum() / y.sum()
        assert near.likeness((a, x), (b, y)) <= (1 - p) * (1 - q) / (1 - p * q + 1e-12) + 1e-9


def test_pairs_at_the_threshold_meet_at_a_rare_shingle(spark):
    """Every pair alike by 0.8 has a shingle among the prefixes of both, before which the bound holds."""
    texts = family(40, 2, words=250) + family(40, 6, words=250, seed=3) + ["one two three"] * 2 + ["x y " * 60, "x y " * 55]
    rows = spark.createDataFrame([(bytes([n]), t) for n, t in enumerate(texts)], "node binary, text string")
    met = {}
    for bucket, node, before in near._prefixes(rows.select("node"), rows, 0.8).collect():
        assert before <= 0.2 + 1e-6
        met.setdefault(node[0], {})[bucket] = before
    sets = [near.shingles(t, near.word_hashes()) for t in texts]
    linked = 0
    for a in range(len(texts)):
        for b in range(a):
            if near.likeness(sets[a], sets[b]) >= 0.8:
                linked += 1
                common = met.get(a, {}).keys() & met.get(b, {}).keys()
                assert any((1 - p) * (1 - q) >= 0.8 * (1 - p * q) - 1e-9 for p, q in ((met[a][s], met[b][s]) for s in common))
    assert linked > 20


def test_a_family_below_the_threshold_costs_no_pairs(spark, monkeypatch):
    """Twice the family gives about twice the verified pairs, and the classes of all pairs."""
    seen = []
    verify = near._verify
    monkeypatch.setattr(near, "_verify", lambda pairs, *rest: seen.append(pairs.count()) or verify(pairs, *rest))
    totals = []
    for n in (60, 120):
        seen.clear()
        texts = family(n, 10)  # likeness about 0.7
        got = classes(spark, texts)
        assert [got[i] for i in range(n)] == list(range(n))
        totals.append(sum(seen))
    assert totals[1] <= 2.5 * totals[0] <= 5 * 60
    mixed = family(25, 2) + family(25, 10, seed=9)
    assert [classes(spark, mixed)[i] for i in range(50)] == exact(mixed)


def test_members_of_a_crowded_bucket_meet_once(spark, monkeypatch):
    """A dense family on both sides of the threshold: no pair is named at each shingle that both prefixes have."""
    named = []
    meet = near._meet
    monkeypatch.setattr(near, "CROWD", 2)
    monkeypatch.setattr(near, "_meet", lambda *given: (named.extend(tuple(map(bytes, r)) for r in meet(*given).collect()), meet(*given))[1])
    texts = [" ".join(t.split()[:100]) for t in family(30, 7) + family(30, 9, seed=4)]
    got = classes(spark, texts)
    assert [got[i] for i in range(60)] == exact(texts)
    assert len(set(got.values())) > 1
    assert len(named) == len(set(named)) > 20


def test_recall_of_pairs_at_the_threshold():
    """Texts alike by 0.8 share a bucket nearly always."""
    rng = np.random.default_rng(9)
    hit = 0
    for _ in range(200):
        one = np.unique(rng.integers(0, 2**63, 400).astype(np.uint64))
        keep = int(len(one) * 1.6 / 1.8) + 1
        two = np.unique(np.append(one[:keep], rng.integers(0, 2**63, len(one) - keep).astype(np.uint64)))
        won = near.signatures([(s, np.ones(len(s), int)) for s in (one, two)], 128)
        hit += (near.buckets(won)[0] == near.buckets(won)[1]).any()
    assert hit >= 0.98 * 200


def test_the_largest_component_gathers_its_members_first(spark, monkeypatch):
    """While more members are outside than have their turn, they meet few members of the largest component of their bucket."""
    rounds = []
    meet = near._meet
    monkeypatch.setattr(near, "TURNS", 2)
    monkeypatch.setattr(near, "_meet", lambda mixed, leaders, *rest: rounds.append(leaders.join(mixed.select("bucket", "main").distinct(), "bucket").collect()) or meet(mixed, leaders, *rest))
    texts = family(14, 4) + family(14, 9, seed=4)
    got = classes(spark, texts, bands=12, rows=1)
    assert [got[i] for i in range(len(texts))] == exact(texts)
    assert rounds[0] and all(r.a == r.main for r in rounds[0])
    assert all(n <= near.TIES[0] for n in Counter(r.bucket for r in rounds[0]).values())


def test_members_of_a_bucket_meet_in_one_task(spark, monkeypatch):
    """Families on both sides of the threshold: classes of all pairs, and few staged tables; no texts are joined to pairs."""
    staged = []
    stage = near.stage
    monkeypatch.setattr(near, "stage", lambda df: staged.append(df.columns) or stage(df))
    monkeypatch.setattr(near, "_verify", None)
    texts = family(25, 2) + family(25, 9, seed=9) + corpus(3, families=3)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")  # buckets go on from batch to batch
    try:
        got = classes(spark, texts)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert [got[i] for i in range(len(texts))] == exact(texts)
    assert len(staged) == 4


def test_spread_and_other_buckets_give_the_classes_of_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(near, "CROWD", 8)
    texts = family(14, 3) + family(3, 2, seed=9)
    got = classes(spark, texts)
    assert [got[i] for i in range(len(texts))] == exact(texts)


def test_links_of_a_bucket():
    """The components of all pairs from few comparisons; pairs that have met are left out."""
    rng = np.random.default_rng(5)
    memo = near.word_hashes()
    sets = [near.shingles(t, memo) for t in family(20, 2) + family(20, 9, seed=4)]
    sets = [sets[i] for i in rng.permutation(len(sets))]
    sketch = near.sketches(near.signatures(sets, 32 * near.WIDE)).view(np.uint64)
    asked = []

    def alike(i, j):
        asked.append((i, j))
        return near.likeness(sets[i], sets[j])

    def parts(links):
        label = list(range(len(sets)))
        for a, b in links:
            label = [label[a] if x == label[b] else x for x in label]
        return [label.index(x) for x in label]

    every = [(i, j) for j in range(len(sets)) for i in range(j) if near.likeness(sets[i], sets[j]) >= 0.8]
    none_met = near._met(len(sets), np.arange(2), np.array([5, 6]))
    assert parts(near._joined(sketch, none_met, alike, 0.8)) == parts(every)
    assert len(every) >= 190 and len(asked) == len(set(asked))
    met = near._met(len(sets), np.array([*range(len(sets)), 0, 1]), np.array([7] * len(sets) + [3, 3]))
    assert met.all() and near._joined(sketch, met, alike, 0.8) == []
