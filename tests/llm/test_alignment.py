"""Token alignment against whole texts, tokenised and linked plainly."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer
from tokenizers.decoders import ByteLevel

from terrane.llm import alignment
from terrane.llm import queries as Q

V = Q.VOCABULARIES


@pytest.fixture(scope="module")
def tokens():
    """A function from a text to the (id, bytes) of both tokenizers over the whole of it."""
    a, b = Tokenizer.from_file(V.a), SentencePieceProcessor(model_file=V.b)
    a.encode_special_tokens = True
    signs = {}
    plain = [x for x in range(256) if 33 <= x < 127 or 161 <= x < 256 and x != 173]
    for x in plain:
        signs[chr(x)] = x
    for k, x in enumerate(x for x in range(256) if x not in plain):
        signs[chr(256 + k)] = x
    assert ByteLevel().decode(["".join(next(c for c, x in signs.items() if x == y) for y in "é ".encode())]) == "é "

    def of(text):
        first = [(i, bytes(signs[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
        second = [(i, bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)]
        return first, second

    return of


def spans(found):
    out, at = [], 0
    for i, raw in found:
        out.append((i, at, at + len(raw)))
        at += len(raw)
    return out


def plain(texts, tokens):
    """The seven measures of each text, over all of them."""
    links, groups, sizes = [], [], []
    for text in texts:
        a, b = tokens(text) if text else ([], [])
        if any(b"".join(raw for _, raw in x) != (" " + text).encode() for x in (a, b) if text):
            a, b = [], []
        a, b = spans(a), spans(b)
        links.append([(i, j) for i, s, e in a for j, t, f in b if s < f and t < e])
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        cut = [([i for i, s, e in a if x < e <= y], [j for j, s, e in b if x < e <= y]) for x, y in zip([0, *cuts], cuts, strict=False)]
        groups.append(";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in cut))
        sizes.append((len(a), len(b), len(cuts)))
    count = Counter(x for found in links for x in found)
    most = {}
    for (_, j), n in count.items():
        most[j] = max(n, most.get(j, 0))
    return [
        (*n, len(found), sum(count[x] == most[x[1]] for x in found), sum(count[x] for x in found), hashlib.sha256(g.encode()).hexdigest() if g else "")
        for n, found, g in zip(sizes, links, groups, strict=True)
    ]


def check(spark, texts, tokens, **how):
    docs = spark.createDataFrame([(i, t, "clash", 1) for i, t in enumerate(texts)], "doc_id long, text string, digest string, n_a int")
    got = {r[0]: tuple(r)[1:] for r in alignment.align(docs, "doc_id", "text", V, **how).collect()}
    assert len(got) == len(texts)
    expected = plain(texts, tokens)
    for i, want in enumerate(expected):
        assert got[i] == want, texts[i]


AWKWARD = [
    "Hello world", "Hello  world", " lead", "trail ", "trail  ", "\n", " ", "   ", "a\nb\n\nc", "a \n b", "tab\tand\x0bmore", "café 你好 \U0001f389\U0001f389",
    "<|endoftext|> and <s> </s> <unk>", "<0x41>", "▁lower", "a▁b", "don't we'll I'M", "x y 　z", " em", "1234567 89", "!!!???...", "a\x00b",
    "", None, "Hello world", "Hello world", "ﬁne ½ é", "​ zero ​", "\x1c a \x1d b", "a \u0085 b", "᠎ x",
]


def test_awkward_texts(spark, tokens):
    for how in ({}, {"signs": 20}, {"hot": 2}):
        check(spark, AWKWARD, tokens, **how)


def test_random_texts(spark, tokens):
    rng = random.Random(4)
    signs = ["a", "the", "ing", " ", " ", "  ", "\n", ".", "'s", "é", "中", "▁", "\t", "7", " ", "<s>", "Z"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(1, 30))) for _ in range(250)]
    check(spark, texts + texts[:60], tokens, signs=300)


def test_test_documents(spark, tokens):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").select("doc_id", "text").collect()
    short = [r.text for r in docs if len(r.text) < 4000]
    check(spark, short, tokens)


def test_cells_forget(tokens):
    cells = alignment.Cells(V.a, V.b, most=3)
    for text in ("one two three", "four five six seven", "one two"):
        parts = alignment.split(text)
        cells.learn(set(parts))
        assert "".join(parts) == " " + text
        assert all(c in cells.number for c in parts)


def test_odd_rows(spark, odd, none):
    got = alignment.align(odd, "doc_id", "text", V).collect()
    assert len(got) == odd.count()
    assert all((r.n_a == 0) == (r.groups_sha256 == "") for r in got)
    assert sum(r.n_a == 0 for r in got) == 3
    assert alignment.align(none, "doc_id", "text", V).count() == 0


def test_cells_at_once_are_cells_by_themselves():
    cells = [" one", " two\n", "  three", " é日", " <|endoftext|>", " four", "\tx", " a▁b", " five"]
    together, alone = alignment.Cells(V.a, V.b), alignment.Cells(V.a, V.b)
    together._learn(cells)
    for c in cells:
        alone._learn([c])
    for c in cells:
        i, j = together.number[c], alone.number[c]
        assert together.groups[i] == alone.groups[j]
        assert together.sizes[:, i].tolist() == alone.sizes[:, j].tolist()
        assert together._links(np.array([i]))[0].tolist() == alone._links(np.array([j]))[0].tolist()
