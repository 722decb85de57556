"""Main text of web pages: a linear-chain conditional random field over the leaf blocks of the document tree.

A page is cut into leaf blocks (runs of text between block-level tags). Features of a block are its ancestor tags, the
words of their class, id and role attributes, and what its text looks like; labels are content and boilerplate. The field
is trained on labelled pages made by a generator with many layouts (and further pages if given), and Viterbi decodes the
most likely labelling. Scripts, styles, frames, heads, templates, form controls, comments of the markup and forms that hold less
than half of a page's text never become blocks. What an ancestor says counts by its distance and by the share of the page's
text that it holds: an element around most of the page, or a class that speaks of the page's state, says nothing of a block.

Defined results: null or empty html has no text; character references are decoded; white space inside a block becomes one
blank; unclosed and stray tags are tolerated; long pages are read whole, in time in proportion to their length; no rows give
no rows; blocks come in page order, joined by a line feed; rows that repeat give
repeated rows; other columns are ignored.
"""

from __future__ import annotations

import functools
import html as entities
import math
import random
import re
from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of HTML: elements whose content is not text, elements without content, block-level elements.
RAW = frozenset("script style iframe".split())
RAW_TEXT = frozenset("textarea title".split())
HIDDEN = frozenset("head template select datalist option textarea button".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    """address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html li
    main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul br head title template noscript select textarea button iframe""".split()
)
#: Elements that a new one of the same set closes, and those that any block closes.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_P_ENDERS = BLOCK - {"br", "head", "title", "template", "noscript", "select", "option", "optgroup", "textarea", "button", "iframe", "html", "body", "tr", "td", "th", "tbody", "thead", "tfoot"}
#: What is not an element, and how an element's tag begins and goes on; each is tried at a place only once.
_OTHER = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)", re.S)
_MARK = re.compile(r"<[!?]")
_OPEN = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_REST = re.compile(r"""(?:[^>"']|"[^"]*"|'[^']*')*+>""")
_ATTR = re.compile(r"""\b(class|id|role|aria-label|itemprop)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_SPACE = re.compile(r"\s+")
_NAME = re.compile(r"[a-z]+")


class Place(NamedTuple):
    """What a block's ancestors say, of a size that does not grow with their number: tags that count, the nearest tag of a block, the hints of the nearest and the next nearest element with any, hints of all but wrappers with the share of text that their element holds, and that share for the nearest element around several blocks."""

    tags: frozenset = frozenset()
    at: str = "none"
    near: frozenset = frozenset()
    beyond: frozenset = frozenset()
    under: frozenset = frozenset()
    share: int = 0


class Node(NamedTuple):
    """An element: the place of its parent in the list of elements, its tag, and what its attributes hint at."""

    parent: int
    tag: str
    hints: frozenset


def hinted(tag: str, said: str) -> frozenset:
    """What an element's class, id, role and the like hint at. Of a compound word such as comment-body the part that isn't the main text counts; has-sidebar or comments-open speak of a state; an article or main element that calls itself a post is one whatever else it is called."""
    found = []
    for a in _ATTR.finditer(said):
        for token in (a[2] or a[3] or a[4] or "").split():
            words = _NAME.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", "-", token).lower())
            if not words or len(words) > 1 and (words[0] in STATE_FIRST or words[-1] in STATE_LAST):
                continue
            own = {_HINT[w] for w in words if w in _HINT}
            found.append(own - {"main"} if len(own) > 1 else own)
    if tag in ("article", "main") and {"main"} in found:
        return frozenset({"main"})
    return frozenset().union(*found)


def placed(nodes: list[Node], found: list[tuple[str, int, int]]) -> list[tuple[str, Place, int]]:
    """Blocks with their places, without those of small forms. One pass up adds up the text of elements, one pass down hands on what they say."""
    own = [0] * len(nodes)
    for text, k, linked in found:
        own[k] += max(0, len(text) - linked)
    amount, holds, several = own[:], [False] * len(nodes), [0] * len(nodes)
    for k in range(len(nodes) - 1, 0, -1):
        up, tag, hints = nodes[k]
        amount[up] += amount[k]
        several[up] += tag in BLOCK
        holds[up] |= holds[k] or tag in ("h1", "article", "main") or hints == {"main"}
    total = max(1, amount[0])
    places, gone = [Place()], [False]
    for k in range(1, len(nodes)):
        up, tag, hints = nodes[k]
        was, share = places[up], amount[k] / total
        wraps = share >= WRAPS and "comment" not in hints and tag not in ("nav", "aside", "footer") and (holds[k] or share >= 0.8 and amount[k] >= LONG)
        gone.append(gone[up] or tag == "form" and share < 0.5)
        part = 0 if share < 0.1 else 1 if share < 0.5 else 2
        at = tag if tag in BLOCK else was.at
        around = (0 if share < 0.02 else 1 if share < 0.2 else 2 if share < 0.6 else 3) if several[k] > 1 else was.share
        if tag in ("html", "body") or wraps:
            good = hints & {"main"} if tag not in ("html", "body") else frozenset()
            places.append(Place(was.tags | ({tag} & {"article", "main"}), at, good or was.near, was.near if good else was.beyond, was.under, around))
            continue
        tags = was.tags | {tag} if tag in _TAGS and tag not in was.tags else was.tags
        under = was.under | {f"{h}:{part}" for h in hints if h != "main"}
        places.append(Place(tags, at, hints or was.near, was.near if hints else was.beyond, under if len(under) > len(was.under) else was.under, around))
    return [(text, places[k], linked) for text, k, linked in found if not gone[k]]


def blocks(page: str | None) -> list[tuple[str, Place, int]]:
    """(text, place, characters inside links) of each leaf block with text. The time is in proportion to the page: a tag that is never closed is text, and once a quote is never closed, tags end at the first >."""
    page = page or ""
    out: list[tuple[str, int, int]] = []
    nodes = [Node(0, "", frozenset())]
    stack: list[tuple[str, int]] = []
    opened: Counter = Counter()
    text: list[str] = []
    linked, hidden, at, quotes, last = 0, 0, 0, True, page.rfind(">")

    def add(raw: str) -> None:
        nonlocal linked
        if raw and not hidden:
            text.append(entities.unescape(raw))
            if opened["a"]:
                linked += len(text[-1].strip())

    def flush() -> None:
        nonlocal linked
        got = _SPACE.sub(" ", "".join(text)).strip()
        if got:
            out.append((got, stack[-1][1] if stack else 0, linked))
        text.clear()
        linked = 0

    def pop(k: int) -> None:
        nonlocal hidden
        if any(t in BLOCK for t, _ in stack[k:]):
            flush()
        for t, _ in stack[k:]:
            opened[t] -= 1
            hidden -= t in HIDDEN
        del stack[k:]

    while at < len(page):
        lt = page.find("<", at)
        if lt < 0:
            add(page[at:])
            break
        add(page[at:lt])
        if m := _OTHER.match(page, lt):
            at = m.end()
            continue
        if lt > last:
            end = _MARK.search(page, lt)
            end = end.start() if end else len(page)
            add(page[lt:end])
            at = end
            continue
        m = _OPEN.match(page, lt)
        if not m:
            add("<")
            at = lt + 1
            continue
        rest = _REST.match(page, m.end()) if quotes else None
        quotes = rest is not None
        at = rest.end() if rest else page.find(">", m.end()) + 1
        tag, said = m[2].lower(), page[m.end() : at - 1]
        if m[1]:
            if opened[tag]:
                pop(max(k for k in range(len(stack)) if stack[k][0] == tag) if stack[-1][0] != tag else len(stack) - 1)
            elif tag in BLOCK:
                flush()
            continue
        if tag in RAW or tag in RAW_TEXT:
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            if tag in RAW_TEXT:
                flush()
            continue
        if tag in BLOCK:
            flush()
        if tag in CLOSES and any(opened[t] for t in CLOSES[tag]):
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in CLOSES[tag]:
                    pop(k)
                    break
                if stack[k][0] in ("ul", "ol", "dl", "table", "select"):
                    break
        if tag in _P_ENDERS and opened["p"]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == "p":
                    pop(k)
                    break
                if stack[k][0] in BLOCK:
                    break
        if tag in VOID or said.endswith("/") and tag not in BLOCK:
            continue
        nodes.append(Node(stack[-1][1] if stack else 0, tag, hinted(tag, said)))
        stack.append((tag, len(nodes) - 1))
        opened[tag] += 1
        hidden += tag in HIDDEN
    flush()
    return placed(nodes, out)


#: An element with this share of a page's text that holds its heading or main part, or with LONG characters and four fifths of the text, is a wrapper.
WRAPS, LONG = 0.6, 500
#: First and last words of classes that speak of a page's or an element's state and not of what a part is.
STATE_FIRST = frozenset("has no not with without is can allow show hide enable disable".split())
STATE_LAST = frozenset("open closed enabled disabled active status layout on off".split())
# What attribute words say about a part of a page, by the first letters of a word.
HINTS = {
    "nav": "nav menu breadcrumb crumb toc pagination pager tabs skip sitemap",
    "head": "header masthead topbar banner logo brand",
    "foot": "footer foot copyright colophon legal",
    "side": "sidebar aside widget related recommend popular trending rail more promoted complementary",
    "ad": "ad ads advert advertisement sponsor sponsored promo promotion adsense dfp taboola outbrain affiliate",
    "note": "cookie consent notice gdpr alert popup modal overlay newsletter subscribe signup paywall announcement toast",
    "social": "social share sharing follow tweet like",
    "comment": "comment comments reply replies discussion disqus respond feedback review",
    "form": "form search login input subscribe contact",
    "main": "article content main post entry story body text prose page",
    "meta": "meta byline author date time published tags tag category",
}
_HINT = {w: k for k, ws in HINTS.items() for w in ws.split()}
_TAGS = frozenset("article main nav header footer aside form section figure table ul ol li p h1 h2 h3 h4 blockquote pre div td dl figcaption a".split())


def features(found: list[tuple[str, Place, int]]) -> list[list[str]]:
    out = []
    for i, (text, place, linked) in enumerate(found):
        words = text.split()
        f = {"bias", f"at:{place.at}", f"share:{place.share}"}
        f.update(f"in:{t}" for t in place.tags)
        f.update(f"near:{h}" for h in place.near)
        f.update(f"beyond:{h}" for h in place.beyond)
        f.update(f"under:{h}" for h in place.under)
        f.update(f"hint:{h[:-2]}" for h in place.under)
        if not place.under and not {"nav", "header", "footer", "aside", "form"} & place.tags:
            f.add("plain")
            f.add("main" if "main" in place.near or {"article", "main"} & place.tags else "bare")
        f.add(f"words:{min(7, int(math.log2(len(words) + 1)))}")
        share = linked / max(1, len(text))
        f.add(f"linked:{0 if share == 0 else 1 if share < 0.3 else 2 if share < 0.8 else 3}")
        f.add(f"ends:{'stop' if text[-1] in '.!?…:;' else 'none'}")
        if re.match(r"[©]|copyright\b|\(c\)", text, re.I) or len(text) < 200 and re.search(r"©|\brights reserved\b", text, re.I):
            f.add("copyright")
        f.add("first" if i == 0 else "last" if i == len(found) - 1 else "inner")
        out.append(sorted(f))
    return out


class Field:
    """A linear-chain conditional random field with two labels (1: content)."""

    def __init__(self, names: dict[str, int], state: np.ndarray, step: np.ndarray):
        self.names, self.state, self.step = names, state, step

    def _scores(self, rows: list[list[str]]) -> np.ndarray:
        return np.array([self.state[[k for x in f if (k := self.names.get(x)) is not None]].sum(0) for f in rows])

    def decode(self, rows: list[list[str]]) -> list[int]:
        """The most likely labels, by Viterbi; ties go to boilerplate."""
        (a, b), (c, d) = self.step.tolist()
        p = q = 0.0
        back = []
        for i, (u, v) in enumerate(self._scores(rows).tolist()):
            if i:
                back.append((q + c > p + a, q + d > p + b))
                p, q = max(p + a, q + c) + u, max(p + b, q + d) + v
            else:
                p, q = u, v
        out = [int(q > p)]
        for x in reversed(back):
            out.append(int(x[out[-1]]))
        return out[::-1]


def fit(pages: list[tuple[list[list[str]], list[int]]], rounds: int = 40, decay: float = 0.3) -> Field:
    """Weights of greatest penalised likelihood, by gradient steps with a scale for each weight."""
    names = {x: i for i, x in enumerate(sorted({x for rows, _ in pages for f in rows for x in f}))}
    pages = [(rows, y) for rows, y in pages if rows]
    # All pages side by side, padded to the longest; blocks that only pad are masked.
    size, longest = len(pages), max(len(rows) for rows, _ in pages)
    real = np.array([[t < len(rows) for t in range(longest)] for rows, _ in pages])
    gold = np.zeros((size, longest, 2))
    for k, (_, y) in enumerate(pages):
        gold[k, np.arange(len(y)), y] = 1
    ends = real.sum(1) - 1
    every = [[names[x] for x in f] for rows, _ in pages for f in rows]
    sizes = np.array([len(f) for f in every])
    flat, starts = np.concatenate(every), np.concatenate([[0], sizes.cumsum()[:-1]])
    met = np.einsum("kti,ktj->ij", gold[:, :-1], gold[:, 1:])
    state, step = np.zeros((len(names), 2)), np.zeros((2, 2))
    s2, t2 = np.full_like(state, 1e-8), np.full_like(step, 1e-8)
    for _ in range(rounds):
        u = np.zeros((size, longest, 2))
        u[real] = np.add.reduceat(state[flat], starts)
        fwd, bwd = u.copy(), np.zeros_like(u)
        for t in range(1, longest):
            fwd[:, t] += np.logaddexp.reduce(fwd[:, t - 1, :, None] + step, axis=1)
        for t in range(longest - 2, -1, -1):
            z = step + (u[:, t + 1] + bwd[:, t + 1])[:, None, :]
            bwd[:, t] = np.where(real[:, t + 1, None], np.logaddexp.reduce(z, axis=2), 0)
        total = np.logaddexp.reduce(fwd[np.arange(size), ends], axis=1)[:, None, None]
        off = (gold - np.exp(fwd + bwd - total))[real]
        gs = np.stack([np.bincount(flat, np.repeat(off[:, j], sizes), len(names)) for j in (0, 1)], 1) - decay * state
        pairs = np.exp(fwd[:, :-1, :, None] + step + (u + bwd)[:, 1:, None, :] - total[..., None])
        gt = met - pairs[real[:, 1:]].sum(0) - decay * step
        s2 += gs**2
        t2 += gt**2
        state, step = state + gs / np.sqrt(s2), step + gt / np.sqrt(t2)
    return Field(names, state, step)


def labelled_page(rng: random.Random) -> tuple[str, list[str]]:
    """A made page with its content blocks: invented prose in one of many layouts, semantic or plain, with boilerplate around it."""
    syllables = "ba co di fu ge ha ki lo mu ne or pa qui re sta tu ve wo za el".split()
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    some = lambda lo, hi: " ".join(word() for _ in range(rng.randint(lo, hi)))
    say = lambda lo, hi: some(lo, hi).capitalize() + rng.choice([".", ".", ".", "!", "", "."])
    content: list[str] = []

    def keep(tag: str, text: str) -> str:
        content.append(text)
        inner = text
        return f"<{tag}>{inner}</{tag}>" if rng.random() < 0.85 or tag != "p" else f"<p>{inner}"

    def links(k: int, tag: str = "li") -> str:
        inner = "".join(f'<li><a href="/{word()}">{some(1, 3)}</a></li>' if tag == "li" else f'<a href="/{word()}">{some(1, 2)}</a> ' for _ in range(k))
        return f"<ul>{inner}</ul>" if tag == "li" else inner

    kinds = lambda key: rng.choice(HINTS[key].split()[:6])
    tag = lambda name: name if rng.random() < 0.6 else "div"

    def part(name: str, key: str, inner: str) -> str:
        t = tag(name)
        mark = f' {rng.choice(["class", "id", "class"])}="{kinds(key)}{rng.choice(["", "-" + word(), " " + word()])}"' if t == "div" or rng.random() < 0.3 else ""
        return f"<{t}{mark}>{inner}</{t}>"

    def wrapped(inner: str) -> str:
        """In elements around everything, whose names may be those of parts of a page or of its state."""
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            name = rng.choice(["page", "wrapper", "site", "container", "outer", word()])
            state = rng.choice(["", "", " has-sidebar", " with-ads", f" {kinds('side')}-{rng.choice(['left', 'right'])}", f" {kinds('head')}-fixed", f" {kinds('nav')}-top", " no-comments"])
            t = rng.choice(["div", "div", "section", "form"])
            inner = f'<{t} {rng.choice(["class", "id"])}="{name}{state}">' + ('<input type="hidden" name="state">' if t == "form" else "") + f"{inner}</{t}>"
        return inner

    state = lambda: rng.choice(["", "", "", " comment-open", " has-sidebar", " ads-enabled", f" {kinds('meta')}-{word()}", f" {word()}"])
    grid = lambda k: "<table><tr>" + "".join(f'<td><a href="/{word()}">{some(1, 2)}</a></td>' for _ in range(k)) + "</tr></table>"
    note = lambda: part("div", "note", f"<p>{say(5, 20)}</p>" * rng.randint(1, 2) + ("<button>OK</button>" if rng.random() < 0.5 else ""))
    ad = lambda: part(rng.choice(["div", "aside"]), "ad", rng.choice([say(3, 30), f"<p>{say(5, 30)}</p>", f'<a href="/x">{say(3, 9)}</a>']))
    top = [part("header", "head", rng.choice([f"<h1>{some(1, 3)}</h1>", f"<p>{some(2, 5)}</p>", some(1, 4)]) + (part("nav", "nav", links(rng.randint(2, 6))) if rng.random() < 0.5 else "")), part("nav", "nav", links(rng.randint(2, 9), rng.choice(["li", "a"]))), grid(rng.randint(2, 6)), f"<div id='{word()}'>{links(rng.randint(2, 6))}</div>", ad(), note(), part("form", "form", f"<label>{some(1, 3)}</label><input name=q>")]
    rng.shuffle(top)
    body = [keep(rng.choice(["h1", "h1", "h2"]), some(2, 10).capitalize())] if rng.random() < 0.85 else []
    if body and rng.random() < 0.2:
        content.append(some(2, 6))
        t = rng.choice(["div", "p"])
        body.append(f'<{t} class="{rng.choice(["entry-", "post-", ""])}{kinds("meta")}">{content[-1]}</{t}>')
    if rng.random() < 0.15:
        body.insert(rng.randint(0, len(body)), f"<nav>{links(rng.randint(2, 6))}</nav>")
    for _ in range(rng.randint(1, 9)):
        r = rng.random()
        if r < 0.04:
            body.append(f"<form><p>{say(2, 12)}</p><input name=mail><button>{word()}</button></form>")
        elif r < 0.62:
            body.append(keep("p", say(4, 90) + " " + say(3, 60) if rng.random() < 0.7 else say(1, 12)))
        elif r < 0.7:
            body.append(keep("h2", some(2, 6)))
        elif r < 0.78:
            body.append("<ul>" + "".join(keep("li", say(2, 20)) for _ in range(rng.randint(2, 5))) + "</ul>")
        elif r < 0.84:
            body.append("<blockquote>" + keep("p", say(5, 40)) + "</blockquote>")
        elif r < 0.88:
            body.append("<table><tr>" + "".join(keep("td", some(1, 4)) for _ in range(3)) + "</tr></table>")
        elif r < 0.93:
            body.append(ad())
        elif r < 0.97:
            first, second = say(5, 30), say(5, 30)
            content.extend((first, second))
            body.append(f"<p>{first}<br>{second}</p>")
        else:
            body.append(part("div", "social", links(3, "a")))
    wrap = rng.random()
    main = "".join(body)
    if rng.random() < 0.08:
        lines = [say(8, 60) for _ in range(rng.randint(1, 5))]
        around, main, content = rng.choice([("{}", main, content), ("<div>{}</div>", main, content), ("<body>{}</body>", "<br><br>".join(lines), lines), ("<div>{}</div>", "<br>".join(lines), lines)])
        return around.format(main), content
    if wrap < 0.3:
        main = f"<article>{main}</article>"
    elif wrap < 0.45:
        main = f"<article class='{kinds('main')}{state()}'>{main}</article>"
    elif wrap < 0.6:
        main = f"<main><div class='{kinds('main')}'>{main}</div></main>"
    elif wrap < 0.85:
        main = f"<div {rng.choice(['class', 'id'])}='{kinds('main')}{rng.choice(['', '-body', '-content'])}{state()}'>{main}</div>"
    else:
        main = f"<div>{main}</div>"
    talk = lambda: part("section", "comment", (f"<h2>{rng.randint(1, 90)} {some(1, 1)}</h2>" if rng.random() < 0.5 else "") + "".join(f'<div class="{rng.choice(["comment", "reply", "comment-body"])}"><p>{say(3, 50)}</p></div>' for _ in range(rng.randint(1, 4))))
    end = [part("aside", "side", f"<h3>{some(1, 3)}</h3>" + links(rng.randint(2, 6)) + (f"<p>{say(5, 25)}</p>" if rng.random() < 0.5 else "")), talk(), ad(), note(), part("div", "social", links(3, "a")), part("form", "form", f"<p>{say(3, 9)}</p><input><button>{word()}</button>")]
    rng.shuffle(end)
    foot = part("footer", "foot", rng.choice(["&copy; ", "Copyright ", ""]) + some(1, 4) + " &middot; " + say(3, 14) + (links(3) if rng.random() < 0.4 else ""))
    if rng.random() < 0.25:
        foot = f"<div id='{rng.choice(['bottom', 'base', word()])}'>{rng.choice(['&copy; ', '', ''])}{some(1, 3).capitalize()} {rng.choice(['All rights reserved', 'all rights reserved.', ''])} {rng.randint(1995, 2025)}</div>"
    pick = lambda xs: "".join(xs[: rng.randint(0, len(xs))])
    inner = wrapped(f"{pick(top)}{main}{pick(end)}{foot if rng.random() < 0.9 else ''}")
    return f"<html><head><title>{word()}</title></head><body>{inner}</body></html>", content


@functools.cache
def trained(pages: int = 320, seed: int = 5) -> Field:
    """The field, trained on generated pages whose content is known block by block."""
    rng = random.Random(seed)
    data = []
    for _ in range(pages):
        page, content = labelled_page(rng)
        found = blocks(page)
        left = list(content)
        y = []
        for text, _, _ in found:
            hit = bool(left) and text == " ".join(left[0].split())
            y.append(int(hit))
            if hit:
                left.pop(0)
        data.append((features(found), y))
    return fit(data)


def main_text(page: str | None, field: Field) -> str:
    found = blocks(page)
    if not found:
        return ""
    return "\n".join(b[0] for b, keep in zip(found, field.decode(features(found)), strict=True) if keep)


def extract(pages: DataFrame, field: Field | None = None) -> DataFrame:
    """page_id, url, text, n_chars for each page."""
    field = field or trained()

    def run(batches):
        for b in batches:
            got = [main_text(x.as_py(), field) for x in b.column(2)]
            yield pa.record_batch([b.column(0), b.column(1), pa.array(got, pa.string())], ["page_id", "url", "text"])

    cols = [F.col("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")]
    out = pages.select(*cols)
    schema = out.select("page_id", "url", F.col("html").alias("text")).schema
    return out.mapInArrow(run, schema).withColumn("n_chars", F.length("text").cast("long"))
