"""Main text: templates, markup rules, the cut itself."""

import html as escapes
import itertools
import re
import time

import duckdb
import pytest

from terrane.llm import html
from terrane.llm import queries as Q

NEWS = """<html><head><title>Storm</title><style>p{}</style></head><body><div id=header><a href=/>Home</a> <a href=/x>About us</a></div>
<div class="content"><h1>Storm hits coast</h1><p>A strong storm hit the coast on Monday, and left
 thousands of people without power &amp; heat.</p><ul><li>Three roads are closed until further notice, the police said.</li>
<li>Trains run late.</li></ul><p>More rain is expected.</p></div><div class="comments"><p>Great article, I really enjoyed
 reading it, thanks for sharing this with us!</p></div><div class=sidebar><p>Ten tips for your garden that will change your life.</p></div>
<div class="cookie-notice">We use cookies to improve your experience. <button>OK</button></div><form><label>Email</label></form>
<p class=copyright>© 2020 News Inc. All rights reserved.</p><script>var x = "<p>no text</p>"</script></body></html>"""


def test_article_without_its_surroundings():
    assert html.main_text(NEWS).split("\n") == [
        "Storm hits coast", "A strong storm hit the coast on Monday, and left thousands of people without power & heat.",
        "Three roads are closed until further notice, the police said.", "Trains run late.", "More rain is expected.",
    ]


@pytest.mark.parametrize(("page", "text"), [
    (None, ""), ("", ""), ("   ", ""), ("<nav><a href=x>Home</a></nav>", ""),
    ("<p>unclosed <b>bold &lt;x&gt; text, with an end", "unclosed bold <x> text, with an end"),
    ("3 < 4 is text without any tags at all, here.", "3 < 4 is text without any tags at all, here."),
    ("<div>One short block of words, and more of them.<br>Same\n\n block.</div><p>Next&nbsp;block of words comes here.", "One short block of words, and more of them. Same block.\nNext block of words comes here."),
    ("<article><p>All words of an article count, even few.</p><!-- never <p>closed</p>", "All words of an article count, even few."),
    ('<article title="a > b"><p>Quoted signs are no ends of a tag, of course.</p></article>', "Quoted signs are no ends of a tag, of course."),
])
def test_markup(page, text):
    assert html.main_text(page) == text


def test_long_page_is_linear_enough():
    page = "<article>" + "<p>Some words in a paragraph, again and again.</p>" * 20_000 + "</article>"
    assert html.main_text(page).count("\n") == 19_999


def test_flow_finds_the_cheapest_cut():
    """Against every labelling of small graphs."""
    import random

    rng = random.Random(5)
    for _ in range(60):
        n = rng.randint(1, 6)
        edges = [{} for _ in range(n + 2)]
        weights = {}
        for a, b in itertools.combinations(range(n + 2), 2):
            if rng.random() < 0.7 and (a, b) != (0, 1):
                w = round(rng.random(), 3)
                if a == 0:
                    edges[0][b] = w
                    weights[0, b] = w
                elif a == 1:
                    edges[b][1] = w
                    weights[b, 1] = w
                else:
                    edges[a][b] = edges[b][a] = w
                    weights[a, b] = weights[b, a] = w
        cost = lambda side: sum(w for (a, b), w in weights.items() if a in side and b not in side)
        best = min(cost({0, *chosen}) for k in range(n + 1) for chosen in itertools.combinations(range(2, n + 2), k))
        assert cost(html.max_flow(edges, 0, 1)) == pytest.approx(best)


def test_test_pages(spark):
    """The pages' articles as a pattern finds them, which this template allows."""
    sf = "/root/testdata/sf0.01"
    pages = dict(duckdb.sql(f"SELECT page_id, html FROM '{sf}/pages.parquet'").fetchall())
    got = Q.op1_main_text(spark, sf).collect()
    assert len(got) == len(pages)
    for row in got:
        inside = re.search(r"<article>(.*?)</article>", pages[row.page_id], re.S)[1]
        inside = re.sub(r"</?(p|h1|b|br)>", lambda m: "\n" if m[1] in ("p", "h1") else " ", inside)
        blocks = [x for x in (" ".join(escapes.unescape(y).split()) for y in re.split(r"\n", inside)) if x]
        assert row.text.split("\n") == blocks
        assert row.n_chars == len(row.text)


def test_odd_rows(spark):
    pages = spark.createDataFrame([(1, "u", NEWS), (1, "u", NEWS), (2, None, None), (None, "u", "")], "page_id long, url string, html string")
    got = html.extract(pages, "html", ["page_id", "url"]).collect()
    assert sorted(len(r.text) > 0 for r in got) == [False, False, True, True]
    assert html.extract(pages.limit(0), "html", ["page_id"]).count() == 0


BODY = "<p>A first paragraph of the article, with enough words in it.</p>", "<p>A second paragraph of the article, with enough words too.</p>"
BOTH = "A first paragraph of the article, with enough words in it.\nA second paragraph of the article, with enough words too."


@pytest.mark.parametrize("between", [
    "<svg/>", '<svg width="1" />', "<svg viewBox='0 0 1 1'/><svg><text>not this</text></svg>", "<math/>", "<object>", "<noscript>", "<template>", "<iframe src=x>", "<svg>", "<svg><path d=x />",
    "<noscript>not this</noscript>", "<template><p>not this</p></template>", "<iframe>not this</iframe>", "<script/>not this</script>", "<textarea>not this</textarea>",
])
def test_elements_without_text_hide_only_themselves(between):
    assert html.main_text(f"<article>{BODY[0]}{between}{BODY[1]}</article>") == BOTH


def test_formulas_objects_and_open_heads():
    assert html.main_text("<article><p>The formula <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds for all of them.</p></article>") == "The formula x=1 holds for all of them."
    assert html.main_text(f"<article>{BODY[0]}<object data=x>{BODY[1]}</object></article>") == BOTH
    assert html.main_text(f"<html><head><title>Name</title><body><article>{''.join(BODY)}</article>") == BOTH
    for tag in ("script", "style", "textarea"):
        assert html.main_text(f"<article>{BODY[0]}<{tag}>{BODY[1]}</article>") == BOTH.split("\n")[0]
    assert html.main_text("<article>" + f"<iframe>{BODY[0]}" * 20_000).count("\n") == 19_999


LONG = "This is a long sentence of the article that says quite a lot about many things, and it goes on."


@pytest.mark.parametrize("page, text", [
    (f"<p>{LONG} <button>Share this page</button>And more.</p><p><label>Email</label> <input>{LONG}</p>", f"{LONG} And more.\n{LONG}"),
    (f"<body><form><div><p>{LONG}</p><p>{LONG}</p></div><label>Name</label><button>Go</button></form></body>", f"{LONG}\n{LONG}"),
    (f"<form><label>Search the site</label><input><button>Find</button></form><p>{LONG}</p>", LONG),
    (f"<p>{LONG}<select><option>One<option>Two</select> Yes.</p>", f"{LONG} Yes."),
    (f"<header class='entry-header'><h1>Head</h1></header><div class='entry-content'><p>{LONG}</p></div>", f"Head\n{LONG}"),
    (f"<div class='article-header'><h1>Head</h1></div><p>{LONG}</p><header class='site-header'><h1>Blog</h1></header>", f"Head\n{LONG}"),
    (f"<div>{'日本語の文章がここにあります。' * 6}</div>", "日本語の文章がここにあります。" * 6),
    (f"<div><label>Name<p>{LONG}</p></div>", LONG),
])
def test_parts_inside_and_around_articles(page, text):
    assert html.main_text(page) == text


def test_deep_pages_take_linear_time():
    def seconds(n):
        start = time.process_time()
        assert html.main_text("<div>some words here " * n + f"<p>{LONG}").endswith(LONG)
        return time.process_time() - start

    seconds(100)
    assert seconds(50_000) < 25 * max(seconds(5_000), 0.05)
