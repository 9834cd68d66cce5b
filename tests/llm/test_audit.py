"""The filter audit against a plain walk through every order, and its SQL."""

import re
from collections import Counter
from itertools import permutations

import numpy as np

from terrane.llm import audit


def plain(docs, labels):
    """(part, order, step) -> the seven counts, by running every order over every row."""
    docs = [(k, t or "", p or "") for k, t, p in docs]
    least = {}
    for k, t, _ in docs:
        if k is not None:
            least[t] = min(k, least.get(t, k))
    fails = []
    for k, t, _ in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails.append({
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), "D": bool(re.search(r"[#$%&*|]", t)), "E": k is not None and k > least[t],
        })
    flag = lambda k, at: any(x[0] == k and x[at] == 1 for x in labels) if k is not None else False
    out, shapley = {}, Counter()
    for part in {p for _, _, p in docs}:
        rows = [(k, f) for (k, _, p), f in zip(docs, fails, strict=True) if p == part]
        for order in map("".join, permutations("ABCDE")):
            left = rows
            for step, name in enumerate(order, 1):
                gone = [r for r in left if r[1][name]]
                left = [r for r in left if not r[1][name]]
                out[part, order, step] = [
                    len(left), len(gone), sum(f[name] for _, f in rows) - len(gone),
                    sum(f[name] and sum(f.values()) == 1 for _, f in rows), sum(flag(k, 1) for k, _ in gone), sum(flag(k, 2) for k, _ in gone),
                ]
                shapley[part, name] += len(gone)
    return {(p, o, s): tuple([*v, shapley[p, o[s - 1]]]) for (p, o, s), v in out.items()}


def got(df):
    rows = df.collect()
    assert len(rows) == len({r[:3] for r in rows})
    return {tuple(r[:3]): tuple(r[3:]) for r in rows}


def test_every_order_over_rows(spark):
    long, loud = " ".join(f"w{i}" for i in range(220)), " ".join(f"W{i % 90}" for i in range(230))
    docs = [
        (1, long, "a"), (2, long, "b"), (2, long, "a"), (2, long, "a"), (3, long, None), (1, long, ""), (None, long, "a"), (None, long, "a"),
        (4, loud, "a"), (5, loud + " #", "a"), (6, None, "a"), (7, "", "b"), (8, "short\x0bA\x1cB C", "b"), (9, "x x x x | x", "b"), (None, None, None),
        (10, loud, "b"), (9, "x x x x | x", "b"),
    ]
    labels = [(1, 1, 0), (2, 1, 1), (2, 0, None), (5, 0, 1), (6, None, 1), (9, 1, 1), (10, 1, 0), (None, 1, 1)]
    given = spark.createDataFrame([(*d, "clash", "clash") for d in docs], "doc_id long, text string, source string, part string, good string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert got(audit.audit(given, "doc_id", "text", "source", marks)) == plain(docs, labels)
    assert audit.audit(given.limit(0), "doc_id", "text", "source", marks).count() == 0


def test_odd_rows(spark, odd):
    marks = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    rows = [tuple(r) for r in odd.select("doc_id", "text", "source").collect()]
    assert got(audit.audit(odd, "doc_id", "text", "source", marks)) == plain(rows, [(1, 1, 0)])


def test_a_hot_text_is_one_row_a_part(spark):
    docs = spark.createDataFrame([(i, "the same text", "a") for i in range(900)] + [(None, "the same text", "a") for _ in range(900)], "doc_id long, text string, source string")
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    found = audit.patterns(docs, "doc_id", "text", "source", marks).where("n > 0").collect()
    assert {(r.pattern, r.n) for r in found} == {(1, 901), (17, 899)}


def test_contractions_of_any_number_of_filters():
    rng = np.random.default_rng(1)
    counts = rng.integers(0, 50, (2, 2, 2, 2))
    rows = audit.contract(counts)
    for (order, k), row in zip([(o, k) for o in audit.orders(3) for k in range(3)], rows.tolist(), strict=True):
        cells = [(index, counts[(slice(None), *index)]) for index in np.ndindex(2, 2, 2)]
        passed = [(i, n) for i, n in cells if not any(i[f] for f in order[:k])]
        removed = sum(n for i, n in passed if i[order[k]])
        assert row[0] == sum(n[0] for i, n in passed if not i[order[k]])
        assert (row[1], row[4]) == tuple(removed)
        assert row[2] == sum(n[0] for i, n in cells if i[order[k]]) - row[1]
        assert row[3] == sum(n[0] for i, n in cells if i[order[k]] and sum(i) == 1)
