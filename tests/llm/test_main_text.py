"""Main text under the weights that the query learns."""

from __future__ import annotations

import os
import random

import pytest

SF = "/root/testdata/sf0.01"
PAGE = "<html><head><title>t</title></head><body><header><a href=/>Site</a></header><nav><ul><li><a href=/>Home</a></li><li><a>About us</a></li></ul></nav>{}<footer><p>Copyright nobody at all</p></footer></body></html>"
WORDS = "river house old stone bridge town people walked morning light market bread price council vote school garden winter".split()


@pytest.fixture(scope="module")
def weight(spark):
    if not os.path.isdir(SF):
        pytest.skip("needs the tables")
    from gnomon.llm.op2_html import fit

    return fit(spark.read.parquet(f"{SF}/pages.parquet"))


LEAD = "<p>This is the first paragraph of many words.</p>"
#: What stands in an article after a first paragraph, and the blocks that stay.
KEPT = {
    "<ul><li>two eggs</li><li>white flour</li></ul>": ["two eggs", "white flour"],
    "<ul><li>two eggs</li></ul><p>Enjoy it.</p>": ["two eggs", "Enjoy it."],
    "<p>See <a>the report</a> by <a>the ministry</a> now.</p>": ["See the report by the ministry now."],
    "<div>First one</div><div>Second block</div><div>Third</div>": ["First one", "Second block", "Third"],
    "<table><tr><th>a</th><td>b1</td></tr><tr><td>c2</td></tr></table>": ["a", "b1", "c2"],
    "<div class=ad>Buy it now</div><h2>Section</h2><p>Short.</p>": ["Section", "Short."],
    "<p><a>only a link</a></p><p>One</p>": ["only a link", "One"],
    "<p>var<script>var x = 1</script> here</p><script>y</script>end": ["var here", "end"],
    "<section id=discussion><h2>Discussion</h2><p>The results say so.</p></section>": ["Discussion", "The results say so."],
    "<div class='premium story'><p>Paid text.</p></div>": ["Paid text."],
    "<blockquote><p>quoted</p></blockquote><pre>a\n b</pre>": ["quoted", "a b"],
    "<dl><dt>term</dt><dd>what it is</dd></dl>": ["term", "what it is"],
    "<article><p>an inner piece</p></article>after": ["an inner piece", "after"],
    "<p hidden=until-found>found by search</p>": ["found by search"],
}
#: What goes, wherever it stands in the article.
GONE = [
    "<ol class=commentlist><li>Nice post!</li></ol>", "<div class=discussion><p>bad talk here</p></div>", "<div class=teaser-box>read this too</div>", "<div class='premium-upsell'>pay for it</div>", "<p style='color:red; display: none'>gone</p>",
    "<p style='visibility:hidden'>gone</p>", "<p hidden>gone too</p>", "<div aria-hidden=true><p>and this</p></div>", "<article class=x hidden><p>hidden one</p></article>", "<form><p>your name</p></form>", "<aside><p>by the way</p></aside>",
    "<div id=comments><article><p>a reader's long comment about all of this</p></article></div>", "<div class='share-buttons'>share</div>",
]


def test_articles_keep_what_is_theirs(weight):
    from gnomon.llm.op2_html import extract

    first = "This is the first paragraph of many words."
    for inner, blocks in KEPT.items():
        for before, after in (("", ""), ("<div class=wrap><div>", "</div></div>"), ("<main>", "</main>")):
            page = PAGE.format(f"{before}<article><h1>A title</h1>{LEAD}{inner}</article>{after}")
            assert extract(page, weight) == "\n".join(["A title", first, *blocks]), inner
    for inner in GONE:
        for body, want in ((f"{LEAD}{inner}", [first]), (f"{inner}{LEAD}<p>End.</p>", [first, "End."]), (f"<p>Short.</p>{inner}<p>End.</p>", ["Short.", "End."])):
            assert extract(PAGE.format(f"<article>{body}</article>"), weight) == "\n".join(want), inner


def test_made_pages_give_their_blocks(weight):
    """Pages made of known blocks, asides and wrappers."""
    from gnomon.llm.op2_html import extract

    rng = random.Random(6)
    text = lambda n: " ".join(rng.choice(WORDS) for _ in range(rng.randint(1, n)))
    for _ in range(300):
        out, want = [], []
        for _ in range(rng.randint(1, 12)):
            kind, t = rng.choice(["p", "p", "p", "h2", "li", "div", "td", "aside", "inline", "link"]), text(20)
            if kind == "aside":
                out.append(rng.choice(GONE))
                continue
            want.append(t)
            if kind == "inline":
                a, _, b = t.partition(" ")
                out.append(f"<p><b>{a}</b> <span class=x>{b}</span></p>")
            elif kind == "link":
                out.append(f"<p><a href='#'>{t}</a></p>")
            else:
                out.append({"li": f"<ul><li>{t}</li></ul>", "td": f"<table><tr><td>{t}</td></tr></table>"}.get(kind, f"<{kind}>{t}</{kind}>"))
        page = PAGE.format(f"<div><article>{''.join(out)}</article></div><div class=sidebar><ul><li>{text(9)}</li></ul></div>")
        assert extract(page, weight) == "\n".join(want), page


def test_regions_without_an_article_and_across_several(weight):
    from gnomon.llm.op2_html import best_region, extract, pieces, values, whole_article

    body = "<div class=text>" + LEAD * 3 + "</div>"
    assert extract(PAGE.format(body), weight).split("\n") == ["This is the first paragraph of many words."] * 3
    many = "".join(f"<article><h2>Post {i}</h2><p>some words of this post here</p></article>" for i in range(4))
    assert extract(PAGE.format(many), weight).count("Post") == 4
    # The query's own region, against all regions, and the element that it becomes.
    found = pieces(PAGE.format(f"<article>{LEAD}<ul><li>x</li></ul></article><p>two words</p>"))
    scores = list(values(found, weight))
    best = max(sum(scores[a:b]) for a in range(len(scores)) for b in range(a, len(scores) + 1))
    first, end = best_region(scores)
    assert abs(sum(scores[first:end]) - best) < 1e-9
    first, end = whole_article(found, first, end)
    inside = [i for i, (_, _, top) in enumerate(found) if top.article > 0]
    assert (first, end) == (inside[0], inside[-1] + 1)
    assert extract("", weight) == "" and extract("<article></article>", weight) == "" and extract("<p>unclosed <article>words here", weight) == "words here"
    deep = "<div>" * 20_000 + "<article><p>deep words</p></article>"
    assert extract(deep, weight) == "deep words"


def test_weights_of_what_was_seen_little_stay_near_their_start():
    from collections import Counter

    from gnomon.llm import op2_html as op

    made = op.weights(Counter({"t:p": 900, "w:p": 9000}), Counter({"t:ul": 1, "t:li": 3, "t:nav": 500, "w:aside": 5000, "t:aside": 800}))
    assert abs(made["t:li"] - op.TAG_COST) < 0.1 and abs(made["t:ul"] - op.TAG_COST) < 0.1
    assert all(op.TAG_MOST <= v <= -0.1 for k, v in made.items() if k.startswith("t:")) and made["t:nav"] == op.TAG_MOST
