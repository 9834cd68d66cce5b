import random
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from terrane.operators import link_entities

from .helpers import rows


def norm(text):
    return re.sub("[^a-z0-9]", "", text.lower())


def brute(keys, titles, min_len=1):
    """{key: title id} by trying every pair."""
    found = {}
    for key, text in keys.items():
        hits = [
            (norm(title), -number)
            for number, title in titles
            if title is not None and len(norm(title)) >= max(min_len, 1) and norm(title) in norm(text)
        ]
        if hits:
            found[key] = -max(hits)[1]
    return found


def linked(spark, keys, titles, as_text=False, **options):
    lookup = spark.createDataFrame(titles, "id int, title string")
    if as_text:
        facts = spark.createDataFrame(list(keys.items()), "k string, body string")
        options["text"] = "body"
    else:
        facts = spark.createDataFrame([(k,) for k in keys] + [(None,)], "k string")
    return dict(rows(link_entities(facts, "k", lookup, "id", "title", **options), "k", "id"))


def test_edge_rows(spark):
    keys = {k: k for k in ("BlueBolt_x_1", "Zed_y_2")}
    titles = [(1, "Bolt"), (2, "Blue Bolt"), (3, "進撃の巨人"), (4, None), (5, "bolt")]
    assert linked(spark, keys, titles) == {"BlueBolt_x_1": 1}


def test_min_len(spark):
    assert linked(spark, {"abx": "abx"}, [(1, "ab")], min_len=3) == {}
    assert linked(spark, {"abx": "abx"}, [(1, "ab")], min_len=2) == {"abx": 1}


def test_empty_lookup(spark):
    assert linked(spark, {"abx": "abx"}, []) == {}
    assert linked(spark, {"a": "some text"}, [], as_text=True) == {}


@pytest.mark.parametrize("as_text", [False, True])
@pytest.mark.parametrize("broadcast_rows", [1000, 0])
def test_all_ways_equal_brute_force(spark, as_text, broadcast_rows):
    rng = random.Random(7)

    def word(n):
        return "".join(rng.choice("abcX _é") for _ in range(n))

    titles = [(i, word(rng.randint(0, 9))) for i in range(60)]
    texts = [word(rng.randint(0, 30)) for _ in range(150)]
    keys = {f"k{i}": t for i, t in enumerate(texts)} if as_text else {t: t for t in texts}
    expected = brute(keys, titles)
    assert 20 < len(expected) < len(keys)
    got = linked(spark, keys, titles, as_text=as_text, gram=4, broadcast_rows=broadcast_rows)
    assert got == expected


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.text("aabZ1 -", max_size=25), min_size=1, max_size=12, unique=True),
    st.lists(st.text("aabZ1 -", max_size=12), min_size=1, max_size=12),
)
def test_random_keys_and_titles(spark, texts, names):
    keys, titles = {t: t for t in texts}, list(enumerate(names))
    assert linked(spark, keys, titles, gram=5) == brute(keys, titles)


def test_shared_prefix_gives_no_pairs_beyond_matches(spark):
    """All titles start alike and a third of the keys contain the same title: work stays linear."""
    titles = [(i, f"commonprefixcommonprefix{i:05d}") for i in range(3000)]
    keys = [f"x_commonprefixcommonprefix{i % 3000 if i % 3 else 7:05d}_{i}" for i in range(3000)]
    got = linked(spark, {k: k for k in keys}, titles, broadcast_rows=0)
    assert len(got) == 3000
    assert all(f"{title:05d}" in key for key, title in got.items())


def test_long_text_is_searched_to_its_end(spark):
    keys = {"d1": "lorem ipsum " * 20000 + "The Very Last Words", "d2": "lorem ipsum " * 100}
    assert linked(spark, keys, [(1, "the very last words")], as_text=True) == {"d1": 1}


def test_plan_has_no_pairwise_join(spark):
    facts = spark.createDataFrame([("abc",)], "k string")
    lookup = spark.createDataFrame([(1, "a" * 20), (2, "b")], "id int, title string")
    for limit in (1000, 0):
        plan = link_entities(facts, "k", lookup, "id", "title", broadcast_rows=limit)
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in text and "Cartesian" not in text
        assert ("_salt" in text) == (limit == 0)


def test_long_texts_in_blocks(spark):
    """Titles of one letter and such that reach over the ends of blocks."""
    rng = random.Random(9)
    texts = {f"k{i}": "".join(rng.choice("abcde ") for _ in range(rng.choice([3, 90, 700]))) for i in range(25)}
    cuts = [t[rng.randrange(len(t)):][: rng.randint(1, 20)] for t in texts.values() for _ in range(2)]
    titles = [*enumerate(cuts), (900, "e"), (901, "z")]
    for block in (1, 16, 4096):
        assert linked(spark, texts, titles, as_text=True, gram=8, block=block) == brute(texts, titles)
