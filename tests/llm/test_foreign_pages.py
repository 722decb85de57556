"""Main text of pages written by hand, in styles that the generator of training pages doesn't know."""

from __future__ import annotations

from collections import Counter

from leafcut.llm import html_extract

A = "The bridge was closed on Monday after engineers found a crack in one of its older piers, and traffic was sent by way of the ferry."
B = "Nobody could say when it would open again, though the mayor hoped for a date before the summer holidays begin."
C = "A short note follows."
BODY = f"<p>{A}</p><p>{B}</p><p>{C}</p>"
TEXT = [A, B, C]
MENU = "<ul><li><a href='/'>Home</a></li><li><a href='/n'>News</a></li><li><a href='/c'>Contact us</a></li></ul>"
TALK = "<p>I was there and saw it happen, it was quite a sight for everyone.</p><p>So was I, and my whole family too.</p>"

#: (page, blocks of its main text)
PAGES = [
    (f'<body class="has-ads has-sidebar"><article>{BODY}</article></body>', TEXT),
    (f'<body class="single modal-open nav-fixed"><nav>{MENU}</nav><article>{BODY}</article></body>', TEXT),
    (f'<article class="post comment-open">{BODY}</article>', TEXT),
    (f'<article id="post-12" class="post-12 post type-post status-publish format-standard hentry category-news tag-bridge">{BODY}</article>', TEXT),
    (f'<form method="post" action="./p.aspx" id="aspnetForm"><input type="hidden" name="__VIEWSTATE"><div id="content">{BODY}</div></form>', TEXT),
    (f'<form id="aspnetForm"><div class="menu">{MENU}</div><div id="content"><h1>Bridge closed</h1>{BODY}</div><div id="footer">About this site</div></form>', ["Bridge closed", *TEXT]),
    ("<div id=content><nav><a href=/>Home</a> <a href=/n>News</a></nav><p>Let x be real. Then we see.</p></div>", ["Let x be real. Then we see."]),
    (f"<article>{BODY}<form><p>Subscribe now</p></form></article>", TEXT),
    (f'<article>{BODY}</article><div id="bottom">All rights reserved 2020</div>', TEXT),
    (f"<table><tr><td><a href=a>One</a></td><td><a href=b>Two</a></td></tr></table><div id=text>{BODY}</div>", TEXT),
    (f"<center><table width=100%><tr><td width=20%><a href=1>Index</a><br><a href=2>Links</a><br><a href=3>Guestbook</a></td><td><h2>My page</h2>{BODY}</td></tr></table></center>", ["My page", *TEXT]),
    (f'<div id="wrapper" class="sidebar-right"><div id="header"><h1>The Daily</h1></div><div id="main"><h2>Bridge closed</h2>{BODY}</div><div id="sidebar"><h3>More</h3>{MENU}</div></div>', ["Bridge closed", *TEXT]),
    (f'<main><section><h1>Bridge closed</h1>{BODY}</section><section id="comments"><h2>2 comments</h2>{TALK}</section></main>', ["Bridge closed", *TEXT]),
    (f'<div class="l-page"><div class="l-main"><div class="c-article__body">{BODY}</div><div class="c-related"><a href=/x>Ferry runs late again</a></div></div></div>', TEXT),
    (f'<div class="entry"><h1 class="entry-title">Bridge closed</h1><div class="entry-meta">By Kim, 4 May</div><div class="entry-content">{BODY}</div></div>', ["Bridge closed", "By Kim, 4 May", *TEXT]),
    (f'<div id="mw-content-text"><div id="toc"><ul><li><a href="#a">1 History</a></li><li><a href="#b">2 Use</a></li></ul></div><h2>History</h2>{BODY}</div><div id="mw-navigation">{MENU}</div>', ["History", *TEXT]),
    (f"<header role=banner><a href=/>Gazette</a></header><div role=navigation>{MENU}</div><div role=main>{BODY}</div><div role=contentinfo>&copy; Gazette</div>", TEXT),
    (f"<div class='cookie-banner'><p>We use cookies to make this site work. By going on you agree.</p><button>OK</button></div><div class=story>{BODY}</div>", TEXT),
    (f"<p>{A}<p>{B}<p>{C}", TEXT),
    (f"<div>{A}<br><br>{B}<br><br>{C}</div>", TEXT),
    (f"<article><h1>Bridge closed</h1><p>{A}</p><aside class='newsletter'><p>Get the news by mail every day.</p></aside><p>{B}</p><div class='ad'>Cheap ferries here.</div><p>{C}</p></article>", ["Bridge closed", *TEXT]),
    (f"<div class=post><h2>Steps</h2><ol><li>{A}</li><li>{B}</li></ol><pre>open --now</pre></div><div class=share><a href=t>Tweet</a> <a href=f>Share</a></div>", ["Steps", A, B, "open --now"]),
    (f'<div class="content no-comments"><h1>Bridge closed</h1>{BODY}</div><div class="promo"><p>Try our new paper for free today.</p></div>', ["Bridge closed", *TEXT]),
    (f'<body id="top" class="ad-free"><div class="header-fixed page"><div class="masthead"><a href=/>Gazette</a></div><div class="prose">{BODY}</div><footer><p>Printed in town.</p></footer></div></body>', TEXT),
]


def counts(page, want):
    got = html_extract.main_text(page, html_extract.trained())
    a, b = Counter(got.split("\n") if got else []), Counter(want)
    return sum((a & b).values()), sum(a.values()), sum(b.values())


def test_blocks_of_foreign_pages():
    hits, said, meant = (sum(x) for x in zip(*(counts(p, w) for p, w in PAGES), strict=True))
    assert 2 * hits / (said + meant) >= 0.95, [(p, html_extract.main_text(p, html_extract.trained())) for p, w in PAGES if len({*counts(p, w)}) > 1]


def test_wrappers_do_not_lose_articles():
    for page, want in PAGES[:10]:
        assert html_extract.main_text(page, html_extract.trained()).split("\n") == want


def test_whole_article_in_any_wrapper():
    plain = f"<nav>{MENU}</nav><article><h1>Bridge closed</h1>{BODY}</article><footer>&copy; Gazette</footer>"
    for names in ("ads", "sidebar", "comment-open", "has-menu", "modal-open popup", "footer-fixed header-fixed", "nav menu cookie"):
        for tag in ("body", "div", "section", "form"):
            assert html_extract.main_text(f'<{tag} class="{names}">{plain}</{tag}>', html_extract.trained()).split("\n") == ["Bridge closed", *TEXT]


def test_nesting_as_deep_as_the_page_is_long():
    page = "<div class='sidebar ad'>" * 20_000 + f"<article>{BODY}</article>"
    assert html_extract.main_text(page, html_extract.trained()).split("\n") == TEXT


def test_markup_around_nothing_and_forms_alone():
    field = html_extract.trained()
    for page in ("<form><p>Log in</p><input name=u></form>", "<nav><a href=/>Home</a></nav>", "<body class=post></body>", "<article></article>", "</div></article>"):
        assert html_extract.main_text(page, field) == ""
