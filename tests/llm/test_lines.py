from pyspark.sql import functions as F

from terrane.llm import lines


def cut(docs, **how):
    return {r.doc_id: (r.n_lines, r.n_removed, r.kept) for r in lines.remove_repeats(docs, "doc_id", "text", **how).select("doc_id", "_cut.*").collect()}


def docs_of(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_windows_overlap_and_merge(spark):
    got = cut(docs_of(spark, "a\nb\nc\nd\ne", "x\na\nb\nc\nd\ny", "a\nb\nz", "q\n b \nc\t\n\nd\nr"))
    assert got[0] == (5, 0, "a\nb\nc\nd\ne")
    assert got[1] == (6, 4, "x\ny")
    assert got[2] == (3, 0, "a\nb\nz")
    assert got[3] == (5, 3, "q\n\nr")


def test_repeats_inside_a_document(spark):
    got = cut(docs_of(spark, "\n".join(["a", "b", "c"] * 3)))
    assert got[0] == (9, 6, "a\nb\nc")  # a later window also covers lines of an earlier one only if it is a repeat itself
    assert cut(docs_of(spark, "s\ns\ns\ns\ns"))[0] == (5, 4, "s")


def test_whole_copies_and_hot_windows(spark):
    docs = docs_of(spark, *["one\ntwo\nthree\nfour"] * 300, "alone\nin\nthis")
    for hot in (1, 2, 2000):
        got = cut(docs, hot=hot)
        assert got[0] == (4, 0, "one\ntwo\nthree\nfour")
        assert all(got[i] == (4, 4, "") for i in range(1, 300))
        assert got[300] == (3, 0, "alone\nin\nthis")


def test_odd_rows(spark, odd, none):
    got = lines.remove_repeats(odd, "doc_id", "text")
    assert got.columns == [*odd.columns, "_cut"]
    rows = got.collect()
    assert len(rows) == odd.count()
    assert all(r._cut.kept == r.text and r._cut.n_removed == 0 for r in rows)
    assert lines.remove_repeats(none, "doc_id", "text").count() == 0


def test_long_text(spark):
    text = "\n".join(f"line {i}" for i in range(30_000))
    got = cut(docs_of(spark, text, f"own\n{text}\nend"))
    assert got[1] == (30_002, 30_000, "own\nend")
    assert spark.range(1).select(F.size(lines.windows(F.lit(text)))).first()[0] == 29_998


def test_short_documents_and_long_lines(spark):
    long = " ".join(f"w{i}" for i in range(50))
    docs = docs_of(
        spark, "a\nb", f"x\n{long}\ny\nz", "alone", "a \n\nb\r", "alone\n", f"p\n {long} \nq", long, f"{long} more", "a\nc", "b", f"{long} more\nd", f"{long[:-4]}\ne\nf", f"{long[:-4]}\ng\nh",
    )
    got = cut(docs)
    assert [got[i][1] for i in range(13)] == [0, 0, 0, 2, 1, 1, 1, 0, 0, 0, 1, 0, 0]
    assert got[3] == (2, 2, "") and got[5] == (3, 1, "p\nq") and got[6] == (1, 1, "") and got[10] == (2, 1, "d")
    assert cut(docs, hot=1) == got
    assert all(n == 0 for _, n, _ in cut(docs, three_only=True).values())
    assert cut(docs_of(spark, f"{long}\n{long}\nend"))[0] == (3, 1, f"{long}\nend")
