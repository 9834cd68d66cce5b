"""Sampled segmentations: round trips, distinctness, and the distribution of sampling without replacement."""

import math
import tracemalloc
from collections import Counter

import numpy as np
import pytest

from terrane.llm import pieces
from terrane.llm.stages import VOCABULARY

TEXTS = ["The  quick\tfox\njumps ### Éçé 12 日本 €", "", " ", "x", "a▁b 🎉🎉  ", "\x00 nul", "hello world " * 3000, "日本語" * 400]


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load(VOCABULARY)


def test_round_trip_and_library(vocabulary):
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=VOCABULARY)
    back = pieces.decoder(vocabulary)
    for text, samples in zip(TEXTS, pieces.sampler(vocabulary, 3)(TEXTS, list(range(len(TEXTS)))), strict=True):
        assert all(back(ids.tolist()) == text for ids, _, _ in samples)
        assert len({tuple(ids.tolist()) for ids, _, _ in samples}) == len(samples) <= 3
        assert all(log_p - 1e-9 <= 0 and inclusion <= 0 for _, log_p, inclusion in samples)
        if pieces.MARK not in text:
            assert all(model.decode(ids.tolist()) == text for ids, _, _ in samples)


def _paths(vocabulary, text):
    """All segmentations of a short text without byte pieces, and their probabilities."""
    marked = pieces.MARK + text.replace(" ", pieces.MARK)
    ids = {p: i for i, p in enumerate(vocabulary.pieces) if p}

    def walk(at):
        if at == len(marked):
            yield ()
        for end in range(at + 1, len(marked) + 1):
            if marked[at:end] in ids:
                for rest in walk(end):
                    yield (ids[marked[at:end]], *rest)

    weight = {p: math.exp(sum(vocabulary.weights[i] for i in p)) for p in walk(0)}
    return {p: w / sum(weight.values()) for p, w in weight.items()}


def test_distribution_without_replacement(vocabulary):
    text, n = "the cat", 8000
    exact = _paths(vocabulary, text)
    seeds = np.random.default_rng(0).integers(0, 2**62, n).tolist()
    got = pieces.sampler(vocabulary, 2)([text] * n, seeds)
    first, second = (Counter(tuple(row[k][0].tolist()) for row in got) for k in (0, 1))
    for path, p in exact.items():
        assert first[path] / n == pytest.approx(p, abs=4 * math.sqrt(p / n) + 1e-3)
        q = sum(exact[a] * p / (1 - exact[a]) for a in exact if a != path)
        assert second[path] / n == pytest.approx(q, abs=4 * math.sqrt(q / n) + 1e-3)
    for row in got[:200]:
        for ids, log_p, _ in row:
            assert math.exp(log_p) == pytest.approx(exact[tuple(ids.tolist())])
    # The inclusion scores make an unbiased estimate of any sum over all segmentations, here of their probability.
    assert np.mean([sum(math.exp(lp - q) for _, lp, q in row) for row in got]) == pytest.approx(1, abs=0.01)


def test_all_segmentations_if_there_are_few(vocabulary):
    samples = pieces.sampler(vocabulary, 50)(["x"], [1])[0]
    assert {tuple(s[0].tolist()) for s in samples} == set(_paths(vocabulary, "x"))
    assert [s[2] for s in samples] == [0.0] * len(samples)


def test_neighbours_do_not_matter(vocabulary):
    sample = pieces.sampler(vocabulary, 2)
    alone = sample([TEXTS[0]], [9])[0]
    among = sample(["some other text", TEXTS[0], "and more"], [1, 9, 2])[1]
    assert [s[0].tolist() for s in alone] == [s[0].tolist() for s in among]


def test_rows(spark, odd, none, vocabulary):
    given = odd.drop("samples")
    rows = pieces.encode(given, "doc_id", "text", vocabulary, ["doc_id", "text", "node"])
    got = rows.collect()
    assert len(got) == odd.count()
    assert all((r.samples is None) == (r.text is None) for r in got)
    assert all(r.round_trip for r in got if r.text is not None)
    back = pieces.decode(rows.selectExpr("doc_id", "text AS given", "samples[0].ids AS ids"), "ids", vocabulary, ["given"]).collect()
    assert all(r.given == r.text for r in back)
    assert pieces.encode(none.drop("samples"), "doc_id", "text", vocabulary, ["doc_id"]).count() == 0


def test_words_are_built_once_and_kept(vocabulary, monkeypatch):
    """Later batches build lattices of new words only; a bound drops words, and changes no sample."""
    built = []
    lattices = pieces.Lattices
    monkeypatch.setattr(pieces, "Lattices", lambda words, lookup: built.extend(words) or lattices(words, lookup))
    batches = [["the old cat 日本"], ["the  old dog €x", "", "the old cat 日本"], ["a dog €x  ", "日本 the"], ["the old cat"]]
    sample = pieces.sampler(vocabulary, 2)
    whole = [sample(texts, [5] * len(texts)) for texts in batches]
    assert len(built) == len(set(built)) == 9
    monkeypatch.setattr(pieces._Words.__init__, "__defaults__", (25,))
    small = pieces.sampler(vocabulary, 2)
    for texts, wanted in zip(batches, whole, strict=True):
        got = small(texts, [5] * len(texts))
        assert [[s[0].tolist() for s in row] for row in got] == [[s[0].tolist() for s in row] for row in wanted]
    assert len(built) > 2 * 9


def test_lookup_knows_pieces_and_their_beginnings(vocabulary):
    lookup = pieces._Lookup(vocabulary)
    ids = {p: i for i, p in reversed(list(enumerate(vocabulary.pieces))) if p}
    starts = {p[:n] for p in ids for n in range(1, len(p))}
    probes = [*ids, *starts, "zzqx", "\x07", "▁日本語の"]
    hashes = []
    for probe in probes:
        h = 0
        for c in probe:
            h = (h * int(pieces._BASE) + ord(c) + 1) % 2**64
        hashes.append(h)
    expected = [ids.get(p, -2 if p in starts else -1) for p in probes]
    assert lookup.find(np.array(hashes, np.uint64)).tolist() == expected


def test_kept_words_are_not_copied_with_every_batch(vocabulary):
    """New words go into room behind the kept ones; texts are searched together up to a million characters."""
    words = pieces._Words(pieces._Lookup(vocabulary))
    words.of([" ".join(f"alpha{i} €{i}" for i in range(500))])
    words.of(["the first new words"])
    before = {name: getattr(words.net, name) for name in ("first", "token", "span", "arc_log", "upto")}
    words.of(["then some others 日本"])
    assert all(np.shares_memory(kept, getattr(words.net, name)) for name, kept in before.items())
    assert all(len(getattr(words.net, name)) > len(kept) for name, kept in before.items())
    assert pieces.encode.__defaults__[-1] <= 1_000_000


def test_memory_of_a_task_does_not_grow_with_its_rows(spark, vocabulary, monkeypatch):
    """A task holds a batch of texts, its paths and few kept words, though most words are new."""
    taken = {}
    monkeypatch.setattr(pieces, "map_texts", lambda docs, text, keep, added, start, rows=256: taken.update(start=start, rows=rows))
    pieces.encode(spark.createDataFrame([(1, "x")], "doc_id long, text string"), "doc_id", "text", vocabulary, ["doc_id"])
    encoded, rng = taken["start"](), np.random.default_rng(3)
    letters = rng.integers(97, 123, (900, 400, 8)).astype(np.uint8)
    letters[:, :, 0] = 0x20
    found = [{"text": x.tobytes().decode(), "seed": i} for i, x in enumerate(letters)]
    tracemalloc.start()
    for at in range(0, len(found), taken["rows"]):
        samples, same = encoded(found[at : at + taken["rows"]])
        assert all(same) and set(samples.value_lengths().to_pylist()) == {2}
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 120_000_000
