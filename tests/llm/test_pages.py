"""Main text of pages: named containers, broken tags, and a labelled set of pages of many layouts."""

from __future__ import annotations

import numpy as np
import pytest

from tickwell.llm import pages

TREE = pages.fit(np.array(pages.LABELLED, float))
LONG = "The river had risen in the night and the lower fields were under water before anyone in the village had noticed it."
MORE = "By noon the water stood at the church door, and the men who had gone out with boats came back with what they could carry."
NAV = '<nav><ul><li><a href="/">Home</a></li><li><a href="/a">News</a></li></ul></nav>'


def text(source):
    return pages.main_text(source, TREE)


@pytest.mark.parametrize(
    "wrapper",
    [
        '<div class="content with-sidebar"><article>{}</article></div>',
        '<div class="no-sidebar"><article>{}</article></div>',
        '<article class="post has-comments">{}</article>',
        '<div id="search-engines-explained"><article>{}</article></div>',
        '<div id="search-engines-explained">{}</div>',
        '<div class="sidebar-layout"><main>{}</main></div>',
        '<form action="/"><main>{}</main></form>',
        '<body class="widget"><main>{}</main></body>',
        '<div class="layout"><div class="page-share-area-inner">{}</div></div>',
    ],
)
def test_containers_whose_names_say_little(wrapper):
    assert text(NAV + wrapper.format(f"<p>{LONG}</p><p>{MORE}</p>")) == f"{LONG}\n{MORE}"


@pytest.mark.parametrize(
    "extra",
    [
        '<div class="comments"><article><p>{}</p></article></div>',
        '<section class="comment-list"><p>{}</p></section>',
        '<div class="related posts"><article class="card"><h3>Read on</h3></article><article class="card"><h3>And on</h3></article></div>',
        '<div id="newsletter-signup"><p>{}</p></div>',
        "<aside><article><p>{}</p></article></aside>",
        "<div hidden><p>{}</p></div>",
        '<div style="display: none"><p>{}</p></div>',
        "<section><h3>Comments</h3><p>{}</p></section>",
        "<section><h3>3 Kommentare:</h3><p>{}</p></section>",
    ],
)
@pytest.mark.parametrize("page", ["<article><p>{}</p><p>{}</p>{}</article>", "<article><p>{}</p><p>{}</p></article>{}"])
def test_what_is_not_the_article(page, extra):
    other = "I was there and I can say that it was nothing like what this paper tells its readers every single week."
    assert text(NAV + page.format(LONG, MORE, extra.format(other))) == f"{LONG}\n{MORE}"


@pytest.mark.parametrize(
    ("source", "want"),
    [
        ("<p>Only a few words.</p>", "Only a few words."),
        ("<p>Only a few words.</p><p>And some more.</p><p>The end.</p>", "Only a few words.\nAnd some more.\nThe end."),
        (f"{NAV}<h1>Flood</h1><p>{LONG}</p>", f"Flood\n{LONG}"),
        (f"{NAV}<article><h1>Flood</h1><p>Short.</p></article>", "Flood\nShort."),
        (f"<article><h2>Comments</h2><p>{LONG}</p></article>", f"Comments\n{LONG}"),
        (f'<article><p class="a>{LONG}</p><p class="b">{MORE}</p></article>', f"{LONG}\n{MORE}"),
        (f"<article><p title='a > b'>{LONG}</p></article>", LONG),
        (f'<article><p id="a"class="b">{LONG}</p></article>', LONG),
        (f'<article><img alt="it"s"><p>{LONG}</p></article>', LONG),
        ("", ""),
        ("<p", "<p"),
        ('<p class="', '<p class="'),
    ],
)
def test_small_and_broken_pages(source, want):
    assert text(source) == want


def test_neighbours_decide_and_the_tree_changes_the_result():
    """The same three words are text among paragraphs and none among links; a leaf alone takes both."""
    inside = f"<p>{LONG}</p><p>At the mill</p><p>{MORE}</p>"
    among = '<p><a href="/">Home</a></p><p>At the mill</p><p><a href="/a">News</a></p>'
    assert "At the mill" in text(inside) and "At the mill" not in text(among)
    assert "At the mill" in pages.main_text(among, 1.0)
    used, stack = set(), [TREE]
    while stack:
        node = stack.pop()
        if isinstance(node, pages.Branch):
            used.add(pages.FEATURES[node.feature])
            stack += [node.low, node.high]
    assert {"words", "links", "links_before", "after", "links_after", "zone", "hint", "around"} <= used


#: Pages of other layouts than the labelled blocks were written for: what is article text in `[[`..`]]`.
PAGES = [
    f"{NAV}<div class='post'><h1>[[Flood in the valley]]</h1><p>[[{LONG}]]</p><p>[[{MORE}]]</p></div><footer>All rights</footer>",
    f"<table><tr><td><a href=a>One</a><a href=b>Two</a></td><td><p>[[{LONG}]]</p><p>[[{MORE}]]</p></td></tr></table>",
    f"<div id=wrap><div class='menu'><a href=/>Home</a></div><div class='entry'><p>[[{LONG}]]</p><ul><li>[[one boat of five]]</li><li>[[two carts and a horse]]</li></ul><p>[[{MORE}]]</p></div><div class='tags'><a href=t>flood</a></div></div>",
    f"<header><h1>The Paper</h1></header>{NAV}<main><header><h1>[[Flood]]</h1><p>[[By A. Writer]]</p></header><p>[[{LONG}]]</p><figure><img src=x><figcaption>[[The church door]]</figcaption></figure><p>[[{MORE}]]</p></main>",
    f"<body><div class='cookie-banner'>We use cookies and ask you to accept them all now please</div><div class='article-body'><p>[[{MORE}]]</p><blockquote>[[{LONG}]]</blockquote></div><div class='social-share'><a href=s>Share</a></div></body>",
    f"<section class='has-sidebar'><article><h2>[[At dusk]]</h2><p>[[{LONG}]]</p><div class='advert'>Buy two boats and get a third one for nothing at all today</div><p>[[{MORE}]]</p></article></section><aside><h3>More</h3><p>Other stories of the week that we have chosen for you to read</p></aside>",
    f"<center><font size=5>[[Flood]]</font><p>[[{LONG}]]<br><br>[[{MORE}]]</p></center><hr><a href=i>Index</a> | <a href=n>Next</a>",
    f"<form id='aspnet'><div><main><p>[[{LONG}]]</p></main></div><label>Name</label><button>Send</button></form>",
    f"<article><p>[[{LONG}]]</p><p>[[{MORE}]]</p><section id='comments'><h2>2 comments</h2><article><p>That is not how I remember it at all, the water was lower</p></article></section></article>",
    f"<div class='breadcrumbs'><a href=/>Home</a> » <a href=n>News</a></div><h1>[[Flood]]</h1><p>[[{LONG}]]</p><div class='related-links'><ul><li><a href=1>Rain again</a></li><li><a href=2>The mill</a></li></ul></div><p>[[{MORE}]]</p><div class='footer-legal'>Copyright of the paper, all rights are kept by it</div>",
]


def test_labelled_pages_at_least_95_percent_both_ways():
    hit = found = wanted = 0
    for source in PAGES:
        want = {w for part in source.split("[[")[1:] for w in [part.split("]]")[0]]}
        got = set(text(source.replace("[[", "").replace("]]", "")).split("\n"))
        size = lambda blocks: sum(len(b.split()) for b in blocks)
        want = {" ".join(w.replace("<br>", " ").split()) for w in want}
        joined = {g: [w for w in want if w in g] for g in got}
        hit += sum(size(ws) for ws in joined.values())
        found, wanted = found + size(got), wanted + size(want)
    assert hit / found >= 0.95 and hit / wanted >= 0.95


def test_other_columns_stay(spark):
    frame = spark.createDataFrame([(1, f"<p>{LONG}</p>", "kept", "old"), (2, None, "x", None)], "page_id int, html string, zone string, text string")
    got = {r.page_id: (r.text, r.zone, r.html) for r in pages.with_main_text(frame).collect()}
    assert got == {1: (LONG, "kept", f"<p>{LONG}</p>"), 2: ("", "x", None)}
