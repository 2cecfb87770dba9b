"""The small labelled table behind the block classifier: page layouts whose blocks are marked.

A block that starts with + belongs to the article, one that starts with - does
not. The words themselves are filler; only counts, links and places matter.
"""

from __future__ import annotations


def _words(n: int, stop: str = ".") -> str:
    return " ".join(("filler words stand here for prose of an invented page and say nothing at all " * (n // 14 + 1)).split()[:n]) + stop


def _links(mark: str, *sizes: int, tag: str = "li") -> str:
    return "".join(f'<{tag}><a href="/x">{mark} {_words(n, "")}</a></{tag}>' for n in sizes)


def _paragraphs(mark: str, *sizes: int) -> str:
    return "".join(f"<p>{mark} {_words(n)}</p>" for n in sizes)


MENU = f"<nav><ul>{_links('-', 1, 1, 2, 1, 1, 3)}</ul></nav>"
FOOT = f"<footer>- {_words(18)}</footer>"
COOKIES = f'<div id="cookie-consent"><p>- {_words(35)}</p><button>- Accept</button></div>'
COMMENTS = (
    f'<section id="comments"><h3>- Two comments</h3><div class="comment"><p>- {_words(40)}</p></div>'
    f'<article class="comment"><p>- {_words(70)}</p></article><form><label>- Name</label><textarea>x</textarea></form></section>'
)

PAGES = [
    # marked-up article between menu, advert and footer
    f'{MENU}<div class="ad">- {_words(6)}</div><article><h1>+ {_words(7, "")}</h1>{_paragraphs("+", 40, 25, 60, 4, 1)}</article>{FOOT}',
    f'{MENU}<div class="ad">- {_words(30)}</div><article><h1>+ {_words(1, "")}</h1><p>+ {_words(3)}</p></article>{FOOT}',
    f'<header><h1>- Site</h1><p>- {_words(12)}</p></header>{MENU}<main><h1>+ {_words(5, "")}</h1>{_paragraphs("+", 30, 2, 80)}'
    f'<ul><li>+ {_words(4)}</li><li>+ {_words(9)}</li></ul><blockquote>+ {_words(20)}</blockquote>{_paragraphs("+", 15)}</main>'
    f'<aside><h2>- More</h2><p>- {_words(45)}</p>{_links("-", 6, 8, 5)}</aside>{FOOT}',
    f'{COOKIES}{MENU}<article><header><h1>+ {_words(8, "")}</h1></header>{_paragraphs("+", 55, 6)}<h2>+ {_words(3, "")}</h2>{_paragraphs("+", 35)}'
    f'<div class="advert"><p>- {_words(25)}</p></div>{_paragraphs("+", 48)}<footer>- {_words(5)}</footer></article>{COMMENTS}{FOOT}',
    f'<article class="post"><h1>+ {_words(6, "")}</h1><p>+ <a href="/x">{_words(9, "")}</a></p>{_paragraphs("+", 70)}'
    f'<table><tr><td>+ {_words(2, "")}</td><td>+ {_words(3, "")}</td></tr></table></article>{COMMENTS}',
    f'<main><article><h1>+ {_words(4, "")}</h1>{_paragraphs("+", 5, 5)}<form><label>- Mail</label><p>- {_words(20)}</p></form>'
    f'<div class="share">{_links("-", 1, 1, tag="span")}</div></article></main>{COOKIES}{FOOT}',
    f'<article><h1>+ {_words(3, "")}</h1><p>+ <a href="/x">{_words(2, "")}</a></p><ul><li>+ <a href="/x">{_words(6, "")}</a></li></ul></article>{FOOT}',
    f'{MENU}<article><h1>+ {_words(1, "")}</h1><p>+ {_words(2)}</p></article>',
    f'<article><p>+ {_words(1)}</p></article>',
    f'<article><h1>+ {_words(2, "")}</h1>{_paragraphs("+", 30, 1)}</article>',
    f'<main><p>+ <a href="/x">{_words(1, "")}</a></p></main>',
    f'<main><h2>+ {_words(3, "")}</h2>{_paragraphs("+", 20)}<p>+ <a href="/x">{_words(3, "")}</a></p></main>',
    f'<div class="content">{_paragraphs("+", 3, 25, 2)}</div>',
    # what stands outside of a marked article is something else, however long
    f'<p>- {_words(40)}</p><article><h1>+ {_words(3, "")}</h1>{_paragraphs("+", 25, 3)}</article><div>- {_words(60)}</div>',
    f'<div>- {_words(15)}</div><div>- {_words(33)}</div><main>{_paragraphs("+", 14, 12)}</main><p>- {_words(25)}</p><p>- {_words(3)}</p>',
    f'<h2>- {_words(4, "")}</h2><p>- {_words(52)}</p><div id="article">{_paragraphs("+", 4, 30, 2)}</div><p>- {_words(28)}</p><p>- {_words(45)}</p>',
    # divisions with telling names only
    f'<div id="top-nav">{_links("-", 1, 2, 1, tag="div")}</div><div class="post-content"><h2>+ {_words(6, "")}</h2>{_paragraphs("+", 45, 3, 38)}</div>'
    f'<div class="sidebar"><p>- {_words(50)}</p></div><div class="footer">- {_words(10)}</div>',
    f'<div class="menu">{_links("-", 1, 1, tag="span")}</div><div id="content"><h1>+ {_words(5, "")}</h1>{_paragraphs("+", 22, 64, 8)}</div>'
    f'<div class="related">{_links("-", 7, 9, 6)}</div><div class="newsletter"><p>- {_words(16)}</p></div>',
    # no names at all: length, links and neighbours decide
    f'<table><tr><td>{_links("-", 1, 1, 2, tag="p")}</td><td><h1>+ {_words(6, "")}</h1>{_paragraphs("+", 50, 34, 5, 41)}</td></tr></table><div>- {_words(6)}</div>',
    f'<div>{_links("-", 2, 1, 1, tag="div")}</div><h1>+ {_words(9, "")}</h1>{_paragraphs("+", 28, 60, 3, 44, 19)}<div>{_links("-", 5, 7, 6, tag="div")}</div><div>- {_words(5)}</div>',
    f'<div>- {_words(2, "")}</div><div>{_links("-", 1, 3, tag="span")}</div>{_paragraphs("+", 90, 75)}<h3>+ {_words(4, "")}</h3>{_paragraphs("+", 66)}<div>- {_words(4, "")}</div>',
    f'<div><a href="/">- Home</a></div><h2>+ {_words(7, "")}</h2>{_paragraphs("+", 16, 22)}<div>- {_words(3)}</div><div>{_links("-", 4, 4, 4, tag="p")}</div>',
    f'<p>+ {_words(12)}</p><p>+ {_words(30)}</p>',
    f'<h1>+ {_words(4, "")}</h1><p>+ {_words(18)}</p>',
    f'<p>+ {_words(2)}</p>',
    f'<div>+ {_words(5, "")}</div>',
    f'<h1>+ {_words(3, "")}</h1>',
]
