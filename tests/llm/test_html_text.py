import numpy as np

from newsloom.llm import html_text as H

TREE = H.grow_tree(*H.labelled_table())
PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{x}</style><script>var t="</p>";</script></head><body class="has-sidebar">
<header class="site"><a href="/">Site</a> a tagline of the site</header><nav><ul><li><a href="/a">A</a></li></ul></nav>
<div id="cookie-banner">We use cookies on this site to make it better and so on and so forth. <button>OK</button></div>
<main><article class="post comments-open"><header><h1>Title &amp; more</h1></header><p>First <b>bold</b>text,&nbsp;&#8212;
 two  lines.<p>Second<br>one.<!-- <p>hidden</p> --><div class="ad-slot">Buy this great thing today</div><ul><li>one<li>two</ul>
<footer>Tags: a, b</footer></article><section class="comments"><p>Nice article, I liked it very much, thank you for writing.</p></section></main>
<aside><p>About the author: a long text here with many words in it</p></aside><form><label>Mail</label><input></form><footer>&copy; 2020"""


def test_one_page_of_everything():
    assert H.main_text_of(PAGE, TREE) == "Title & more\n\nFirst boldtext, — two lines.\n\nSecond one.\n\none\n\ntwo"


def test_tree_knows_its_table():
    x, y = H.labelled_table()
    assert (H.classify(TREE, x) == y).all()


def test_tree_by_definition():
    x = np.array([[0.0, 5.0], [1, 5], [0, 9], [1, 9]])
    y = np.array([0.0, 1, 1, 1])
    assert (H.classify(H.grow_tree(x, y), x) == y).all()
    assert H.grow_tree(x[:0], y[:0]) == (1,)


def test_odd_pages():
    for page in (None, "", " ", "<", "<p", "</p></div>", "<!--", "<script>", "<a", "<<>>", "&", "&#xFFFFFFFF;", '<a href="x', "<p>" * 5000, "<div>" * 3000 + "x"):
        assert isinstance(H.main_text_of(page, TREE), str)
    assert H.main_text_of("just text", TREE) == "just text"
    assert H.main_text_of("<article><p title='a>b'>" + "long " * 100_000 + "</p></article>", TREE) == ("long " * 100_000).strip()


def test_drawings_and_formulas_take_only_their_own_text():
    text = "Words of an article that stand before and after a small drawing of some kind."
    for inner in ('<svg class="i"/>', "<svg><text>no</text></svg>", "<svg><svg/><svg>no</svg><g>no</g></svg>", "<math><mi>x</mi></math>", "<MATH />", "<svg>"):
        page = f"<article><p>{text}</p><p>{inner}{text}</p><p>{text}</p></article>"
        assert H.main_text_of(page, TREE) == "\n\n".join([text] * 3), inner


def test_rows(spark):
    rows = [(1, "u", PAGE, "x", 1), (1, "u", PAGE, "x", 1), (2, None, None, "x", 1), (None, "v", "<article><p>é😀</p></article>", "x", 1)]
    got = H.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in got) == [(0, 2), (1, len(H.main_text_of(PAGE, TREE)))] + [(1, len(H.main_text_of(PAGE, TREE))), (2, 0)]
    assert H.extract_pages(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []
