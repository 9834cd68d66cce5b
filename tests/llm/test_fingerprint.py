"""Fingerprints against exact shingles and a plain reading of the contract."""

import hashlib

from pyspark.sql import functions as F

from terrane.llm import fingerprint as fp
from terrane.llm import queries as Q

SF = "/root/testdata/sf0.001"


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b)


def test_query(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: r for r in Q.op6_fingerprint(spark, SF).collect()}
    ids = sorted(texts, reverse=True)
    assert set(got) == set(ids)
    off = []
    for here, after in zip(ids, [*ids[1:], ids[0]], strict=True):
        text, following, row = texts[here], texts[after], got[here]
        third = len(text) // 3
        edited = text[: len(text) - third] + following[:third]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert len(row.fingerprint) == len(row.edited_fingerprint) == 2 * fp.BINS
        off += [row.near_edited - jaccard(text, edited), row.near_next - jaccard(text, following)]
    assert max(map(abs, off)) < 0.2
    assert abs(sum(off) / len(off)) < 0.02
    prints = {}
    for i in ids:
        assert prints.setdefault(texts[i], got[i].fingerprint) == got[i].fingerprint


def test_densified_bins_repeat_values_of_full_ones(spark):
    df = spark.createDataFrame([("one two three four five six",)], "t string").select(fp.fingerprint(F.col("t")).alias("f"))
    f = df.first().f
    assert 1 <= len({f[i : i + 2] for i in range(0, len(f), 2)}) <= 2


def test_order_over_many_buckets(spark):
    docs = spark.createDataFrame([(i * 7 % 101, f"text {i}") for i in range(101)], "k long, t string")
    for buckets in (1, 2, 9, 300):
        got = fp.with_next(docs, "k", F.col("t"), {"k": "after"}, buckets).collect()
        assert {r.k: r.after for r in got} == {k: (k - 1) % 101 for k in range(101)}
        assert len(got) == 101


def test_odd_rows(spark, odd, none):
    got = fp.fingerprints_with_edits(odd, "doc_id", "text", buckets=3).collect()
    assert len(got) == odd.count()
    by_size = {r.fingerprint for r in got if r.n_chars == 0}
    assert len(by_size) == 1
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert fp.fingerprints_with_edits(none, "doc_id", "text").count() == 0
    single = spark.createDataFrame([(4, "just one document with some words")], "doc_id long, text string")
    assert fp.fingerprints_with_edits(single, "doc_id", "text").first().near_next == 1.0
    keyless = spark.createDataFrame([(None, "a b c"), (None, "d e f")], "doc_id long, text string")
    assert fp.fingerprints_with_edits(keyless, "doc_id", "text").count() == 2
