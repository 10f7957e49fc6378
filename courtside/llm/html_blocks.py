"""Main-text extraction: a recurrent labeller over the blocks of a page.

A page is cut into its leaf blocks in order.  Each block gets a vector: its
tag path and class words (hashed), its words (hashed) and a few numbers
(length, link share, punctuation, position).  A bidirectional LSTM in numpy
reads the whole sequence in both directions, so each block is classified
(main text or not) with the context of the document.

The network is trained on the driver, from a fixed seed, on generated pages
whose blocks are known (random layouts with menus, notices, adverts, forms,
sidebars, comments) and on a bounded sample of the table (``sample``
pages, smallest hash of the id first) labelled by tag and class names.  A
page of more than ``window`` blocks is trained on in windows that cover it
to its end; their blocks keep their features from the whole page.
Labelling and extraction then cover every page, whole.

Text rules: character references are decoded, white space in a block becomes
one space (``<br>`` is white space), ends are trimmed, empty blocks vanish,
main blocks are joined in page order by one newline.  Scripts, styles, the
head, comments and other markup are never blocks.  A formula (``<math>``) is
text, its annotations too.  Custom elements (``<svg-icon>``) are ordinary
tags, ``<svg/>`` ends at once, and an ``<svg>``, ``<object>``, ``<canvas>`` or
``<template>`` that nothing closes hides nothing.

Defined results: a null or empty page, or one without main text, gives the
empty string.  Pages are handled one by one (repeated rows repeat); a page's
result does not depend on the pages beside it; an empty table gives an empty
result (trained on generated pages only); other columns are ignored.
"""

from __future__ import annotations

import html
import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtside.llm.common import batches_of, ship_package

#: Content that is no text of the page; the first ones run to the end of the page when nothing closes them, the others are then ordinary tags.
_RAW = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*+>", re.I) for t in
        "script style noscript iframe textarea title svg template object canvas".split()}
_TO_END = frozenset("script style noscript iframe textarea title".split())
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^>]*+)>", re.S | re.I)
_HINT = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header html label legend li main menu nav ol option p pre search section select "
    "summary table tbody td tfoot th thead tr ul".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: An opening tag closes these when they are open inside the given container.
_CLOSES = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
           "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
           "option": ({"option"}, {"select"})}
_IN_P = frozenset("button label option td th li dd dt".split())


class Path:
    """An open element and, by its parents, the way to it from the root; paths share what they have in common."""

    __slots__ = ("parent", "tag", "hints", "depth", "in_head", "in_body", "vector", "final", "marks")

    def __init__(self, parent: "Path | None", tag: str, hints: tuple[str, ...]):
        self.parent, self.tag, self.hints, self.vector, self.final, self.marks = parent, tag, hints, None, None, None
        self.depth = parent.depth + 1 if parent else 1
        self.in_head = tag == "head" or bool(parent and parent.in_head)
        self.in_body = tag == "body" or bool(parent and parent.in_body)

    def up(self) -> Iterator["Path"]:
        """The element and its parents, the root last."""
        node = self
        while node:
            yield node
            node = node.parent

    def __iter__(self) -> Iterator[tuple[str, tuple[str, ...]]]:
        return reversed([(x.tag, x.hints) for x in self.up()])

    def __len__(self) -> int:
        return self.depth

    def __getitem__(self, i):
        return tuple(self)[i]


class Block:
    __slots__ = ("text", "path", "linked")

    def __init__(self, text, path, linked):
        self.text, self.path, self.linked = text, path, linked


def blocks(page: str) -> list[Block]:
    """The leaf blocks: text, path of (tag, class words) from the root, and the share of linked characters."""
    top: Path | None = None
    n_open: Counter[str] = Counter()  # open elements by tag, so that nobody looks for one that isn't there
    out: list[Block] = []
    parts: list[str] = []
    linked, anchor, at = 0, False, 0
    unclosed: set[str] = set()  # raw elements without an end from here on
    last = page.rfind(">") + 1  # no tag ends after this

    def close_block():
        nonlocal linked, anchor
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text and not (top and top.in_head):
                out.append(Block(text, top or (), min(1.0, linked / len(text))))
            parts.clear()
        linked, anchor = 0, False

    def pop_to(node):
        """Close the elements down to ``node`` and itself."""
        nonlocal top
        while True:
            n_open[top.tag] -= 1
            gone, top = top, top.parent
            if gone is node:
                return

    while m := _TOKEN.search(page, at, last):
        if m.start() > at:
            raw = page[at:m.start()]
            parts.append(raw)
            linked += len(raw) * anchor
        at = m.end()
        tag = m[2] or m[5]
        if not tag:
            if m[0].startswith("<!--") and not (len(m[0]) > 6 and m[0].endswith("-->")):
                at = len(page)  # an open comment hides the rest
                break
            continue
        tag, closing, attrs = tag.lower(), m[1] or m[4], m[3] or m[6] or ""
        if tag in _RAW:
            named = not attrs or attrs[0] == "/" or attrs[0].isspace()  # <svg_x> is another element
            if named and not closing and tag not in unclosed and not (tag == "svg" and attrs.endswith("/")):
                end = _RAW[tag].search(page, at, last)
                if end:
                    at = end.end()
                elif tag in _TO_END:
                    at = len(page)
                    break
                else:
                    unclosed.add(tag)
        elif tag == "a":
            anchor = not closing
        elif tag == "br":
            parts.append(" ")
        elif tag == "hr":
            close_block()
        elif tag in _BLOCK:
            close_block()
            if closing:
                if n_open[tag]:
                    pop_to(next(x for x in top.up() if x.tag == tag))
            else:
                if tag == "body":
                    if top and top.in_body:
                        continue
                    top = None  # whatever the head left open
                    n_open.clear()
                elif top and top.tag == "p" and tag not in _IN_P:
                    pop_to(top)
                shut, within = _CLOSES.get(tag, ((), ()))
                if any(n_open[t] for t in shut):
                    met = next(x for x in top.up() if x.tag in shut or x.tag in within)
                    if met.tag in shut:
                        pop_to(met)
                hints = tuple(w for x in _HINT.findall(attrs) for w in re.split(r"[^a-z]+", "".join(x).lower()) if w) if "=" in attrs else ()
                top = Path(top, tag, hints)
                n_open[tag] += 1
    if at < len(page):
        rest = page[at:]
        start = rest.find("<!--")
        parts.append(rest if start < 0 else rest[:start])
        linked += len(parts[-1]) * anchor if start >= 0 else 0
    close_block()
    return out


# ---------------------------------------------------------------- features

N_TAG, N_CLASS, N_WORD, N_NUM = 48, 64, 32, 10
N_IN = N_TAG + N_CLASS + N_WORD + N_NUM
_KNOWN_TAGS = {t: i for i, t in enumerate(
    "article aside blockquote button dd dt div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header label legend "
    "li main menu nav ol option p pre section select summary table td th ul details dialog search address center".split())}


@lru_cache(1 << 16)
def _slot(word: str, n: int) -> int:
    return zlib.crc32(word.encode()) % n


class Features:
    """Block vectors; a path's vector is made from its nearest ancestor's that has one, words are remembered in bounded number."""

    def __init__(self):
        self.words: dict[str, int] = {}

    def path(self, path: Path) -> np.ndarray:
        """Tags and class words of the path; the element's own tag counts double."""
        if not path:
            return np.zeros(N_TAG + N_CLASS, np.float32)
        if path.final is None:
            way = []
            for x in path.up():
                if x.vector is not None:
                    break
                way.append(x)
            v = x.vector.copy() if x.vector is not None else np.zeros(N_TAG + N_CLASS, np.float32)
            for x in reversed(way):
                if x is path and len(way) > 1:
                    x.parent.vector = v.copy()  # the next block in there starts from it
                v[_KNOWN_TAGS.get(x.tag, N_TAG - 1)] = 1
                for h in x.hints:
                    v[N_TAG + _slot(h, N_CLASS)] = 1
            path.vector = path.final = v
            if path.tag in _KNOWN_TAGS:
                path.final = v.copy()
                path.final[_KNOWN_TAGS[path.tag]] = 2
        return path.final

    def page(self, found: list[Block]) -> np.ndarray:
        x, n = np.zeros((len(found), N_IN), np.float32), len(found)
        if len(self.words) > 300_000:
            self.words.clear()
        for i, b in enumerate(found):
            x[i, :N_TAG + N_CLASS] = self.path(b.path)
            ws, slots = b.text.lower().split(), self.words
            for w in ws:
                if w not in slots:
                    slots[w] = _slot(w, N_WORD)
            bag = np.bincount([slots[w] for w in ws], minlength=N_WORD)
            size = len(b.text)
            x[i, N_TAG + N_CLASS:-N_NUM] = bag / len(ws)
            stops = b.text.count(".") + b.text.count(",") + b.text.count("!") + b.text.count("?")
            x[i, -N_NUM:] = (np.log1p(size) / 8, np.log1p(len(ws)) / 6, b.linked, min(1.0, 10 * stops / size), size / len(ws) / 20,
                             b.text[-1] in ".!?\"'”»", i / n, (n - i) / n, size < 25, len(b.path) / 10)
        return x


# ------------------------------------------------------------------ network

def _sigmoid(a):
    return 1 / (1 + np.exp(-a))


class BiLstm:
    """Two LSTMs, one per direction, and a logistic output; pages of a batch are padded and masked."""

    def __init__(self, n_in: int, hidden: int = 24, seed: int = 11):
        r = np.random.default_rng(seed)

        def draw(*shape):
            return (r.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

        self.h = hidden
        self.p = {"out": draw(2 * hidden), "skip": draw(n_in) * 0, "bias": np.zeros(1, np.float32)}
        for d in "fb":
            self.p |= {f"wx{d}": draw(n_in, 4 * hidden), f"wh{d}": draw(hidden, 4 * hidden), f"b{d}": np.zeros(4 * hidden, np.float32)}
            self.p[f"b{d}"][hidden:2 * hidden] = 1  # remember at first

    def _run(self, x, mask, d, keep):
        h, (n, t, _) = self.h, x.shape
        z = x @ self.p[f"wx{d}"] + self.p[f"b{d}"]
        hs, c, state, tape = np.zeros((n, t, h), np.float32), np.zeros((n, h), np.float32), np.zeros((n, h), np.float32), []
        for s in range(t) if d == "f" else range(t - 1, -1, -1):
            a = z[:, s] + state @ self.p[f"wh{d}"]
            i, f, o, g = _sigmoid(a[:, :h]), _sigmoid(a[:, h:2 * h]), _sigmoid(a[:, 2 * h:3 * h]), np.tanh(a[:, 3 * h:])
            m = mask[:, s, None]
            c2 = np.where(m, f * c + i * g, c)
            th = np.tanh(c2)
            s2 = np.where(m, o * th, state)
            if keep:
                tape.append((s, i, f, o, g, c, th, state, m))
            c, state = c2, s2
            hs[:, s] = state
        return hs, tape

    def forward(self, x, mask, keep=False):
        hf, tf = self._run(x, mask, "f", keep)
        hb, tb = self._run(x, mask, "b", keep)
        logit = np.concatenate([hf, hb], 2) @ self.p["out"] + x @ self.p["skip"] + self.p["bias"]
        return logit, (hf, hb, tf, tb)

    def gradients(self, x, mask, y):
        logit, (hf, hb, tf, tb) = self.forward(x, mask, True)
        e = (_sigmoid(logit) - y) * mask / mask.sum()
        g = {"out": np.concatenate([(e[..., None] * hf).sum((0, 1)), (e[..., None] * hb).sum((0, 1))]),
             "skip": (e[..., None] * x).sum((0, 1)), "bias": e.sum()[None]}
        h = self.h
        for d, tape, out in (("f", tf, self.p["out"][:h]), ("b", tb, self.p["out"][h:])):
            wh, dz = self.p[f"wh{d}"], np.zeros((*x.shape[:2], 4 * h), np.float32)
            dh, dc, gwh = np.zeros((len(x), h), np.float32), np.zeros((len(x), h), np.float32), np.zeros_like(wh)
            for s, i, f, o, gg, c, th, before, m in reversed(tape):
                dh = dh + e[:, s, None] * out
                a, b = np.where(m, dh, 0), np.where(m, dc, 0)
                b = b + a * o * (1 - th * th)
                da = np.concatenate([b * gg * i * (1 - i), b * c * f * (1 - f), a * th * o * (1 - o), b * i * (1 - gg * gg)], 1)
                dz[:, s] = da
                gwh += before.T @ da
                dh, dc = np.where(m, da @ wh.T, dh), np.where(m, b * f, dc)
            flat = dz.reshape(-1, 4 * h)
            g |= {f"wx{d}": x.reshape(-1, x.shape[2]).T @ flat, f"wh{d}": gwh, f"b{d}": flat.sum(0)}
        return g

    def fit(self, pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = 14, rate: float = 0.01, seed: int = 5) -> None:
        r, m, v, step = np.random.default_rng(seed), {}, {}, 0
        pages = sorted((p for p in pages if len(p[0])), key=lambda p: len(p[0]))
        groups = [pages[i:i + 32] for i in range(0, len(pages), 32)]
        for epoch in range(epochs):
            for at in r.permutation(len(groups)):
                x, mask = padded([p[0] for p in groups[at]])
                y = np.zeros(mask.shape, np.float32)
                for k, (_, labels) in enumerate(groups[at]):
                    y[k, :len(labels)] = labels
                step += 1
                for k, g in self.gradients(x, mask, y).items():
                    g = np.clip(g, -1, 1)
                    m[k] = 0.9 * m.get(k, 0) + 0.1 * g
                    v[k] = 0.99 * v.get(k, 0) + 0.01 * g * g
                    lr = rate * (0.3 if epoch > 0.7 * epochs else 1)
                    self.p[k] = (self.p[k] - lr * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)

    def classify(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Main text or not, per block; pages of like length share a batch."""
        out: list = [np.zeros(0, bool)] * len(pages)
        todo = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
        while todo:
            width = len(pages[todo[-1]])
            n = max(1, min(128, (1 << 15) // width))
            part, todo = todo[-n:], todo[:-n]
            logit, _ = self.forward(*padded([pages[i] for i in part]))
            for k, i in enumerate(part):
                out[i] = logit[k, :len(pages[i])] > 0
        return out


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    x = np.zeros((len(pages), max(map(len, pages)), N_IN), np.float32)
    mask = np.zeros(x.shape[:2], bool)
    for k, p in enumerate(pages):
        x[k, :len(p)], mask[k, :len(p)] = p, True
    return x, mask


# ----------------------------------------------------------------- training

_NOT_MAIN_TAGS = frozenset("aside button dialog fieldset footer form label legend menu nav option search select".split())
_NOT_MAIN = {
    "menu": "menu nav navbar navigation topnav breadcrumb breadcrumbs links toolbar tabs pagination pager tags", "header": "header masthead logo brand topbar banner",
    "footer": "footer copyright colophon legal bottom", "side": "sidebar side widget related recommended popular trending rail",
    "notice": "notice cookie cookies consent gdpr alert banner popup modal overlay paywall subscribe", "ad": "ad ads advert advertisement adbox sponsor sponsored promo promotion",
    "form": "form login signup newsletter search register contact", "share": "share social follow buttons byline meta",
    "comments": "comment comments commentlist discussion replies reply responses respond"}
_NOT_MAIN_WORDS = frozenset(" ".join(_NOT_MAIN.values()).split())


def label_by_names(found: list[Block]) -> np.ndarray:
    """Labels from tag and class names: what stands in no menu, footer, ... is main text; headers count inside an article only."""
    y = []
    for b in found:
        way = []
        for x in b.path.up() if b.path else ():
            if x.marks:
                break
            way.append(x)
        for x in reversed(way):  # (in something that is no main text, in a header, in an article)
            bad, header, article = x.parent.marks if x.parent else (False, False, False)
            x.marks = (bad or x.tag in _NOT_MAIN_TAGS or bool(_NOT_MAIN_WORDS & set(x.hints)), header or x.tag == "header", article or x.tag == "article")
        bad, header, article = b.path.marks if b.path else (False, False, False)
        y.append(not bad and (not header or article))
    return np.array(y, np.float32)


def generated_pages(n: int, seed: int = 3) -> list[tuple[list[Block], np.ndarray]]:
    """Pages of random layout with a label per block."""
    r = random.Random(seed)
    parts = ["".join(r.choices("aeioustrnldmchgpbfvkwöéñç", k=r.randint(1, 5))) for _ in range(600)]

    def word():
        return "".join(r.choices(parts, k=r.choice((1, 1, 2))))

    def text(lo, hi):
        ws = [word() + r.choice(("", "", "", "", ",")) for _ in range(r.randint(lo, hi))]
        cuts = " ".join(w + "." if r.random() < 0.1 else w for w in ws)
        return cuts[:1].upper() + cuts[1:] + r.choice((".", ".", ".", "!", "?", ""))

    def short():
        return " ".join(word().capitalize() for _ in range(r.randint(1, 4)))

    def box(kind, inner, tags=("div", "div", "section")):
        tag, names = r.choice(tags), _NOT_MAIN[kind].split()
        how = r.random()
        name = r.choice(names) if how < 0.5 else f"{r.choice(names)}-{word()}" if how < 0.75 else f"{word()} {r.choice(names)}"
        return f'<{tag} {r.choice(("class", "class", "id"))}="{name}">{inner}</{tag}>'

    def plain(tag, inner):
        return f"<{tag}>{inner}</{tag}>"

    def linked(n):
        form = r.choice(("<li>{}</li>", "<li>{}</li>", "<p>{}</p>", "<div>{}</div>", "{} "))
        items = "".join(form.format(f'<a href="/{word()}">{short()}</a>') for _ in range(n))
        return f"<ul>{items}</ul>" if "li" in form else items

    def menu():
        return plain("nav", linked(r.randint(2, 8))) if r.random() < 0.5 else box("menu", linked(r.randint(2, 8)), ("div", "ul", "nav"))

    def side():
        inner = f"<h3>{short()}</h3>" + r.choice((linked(r.randint(2, 6)), f"<p>{text(5, 30)}</p>"))
        return plain("aside", inner) if r.random() < 0.5 else box("side", inner, ("div", "aside"))

    def advert():
        inner = r.choice(("{}", "<p>{}</p>", "<a href='/x'>{}</a>", "<div><span>{}</span></div>")).format(text(3, 40))
        return box("ad", inner, ("div", "div", "aside", "section"))

    def notice():
        return box("notice", r.choice(("<p>{}</p><button>{}</button>", "{}<button>{}</button>", "<p>{} {}</p>")).format(text(5, 30), short()))

    def form():
        inner = f'<label>{short()}</label><input name="q"><button>{short()}</button>' + r.choice(("", f"<p>{text(4, 15)}</p>"))
        return plain("form", inner) if r.random() < 0.7 else box("form", inner)

    def comments():
        one = "".join(r.choice((f"<p>{text(4, 60)}</p>", f"<li><b>{short()}</b> <p>{text(4, 60)}</p></li>", f"<div>{text(3, 40)}</div>")) for _ in range(r.randint(1, 5)))
        return box("comments", r.choice(("", f"<h3>{short()}</h3>")) + one, ("div", "section", "ol", "ul", "aside"))

    def header():
        inner = r.choice((f"<h1>{short()}</h1>", f"<p>{text(2, 10)}</p>", f"<a href='/'>{short()}</a>", f"<div>{short()}</div>"))
        return plain("header", inner + (menu() if r.random() < 0.3 else "")) if r.random() < 0.6 else box("header", inner)

    def footer():
        inner = r.choice(("{}", "<p>{}</p>", "<div>{}</div><p>" + short() + "</p>")).format("&copy; " + text(2, 25))
        return plain("footer", inner) if r.random() < 0.7 else box("footer", inner)

    def article():
        body = r.choice(("<h1>{}</h1>", "<h2>{}</h2>", "<header><h1>{}</h1></header>", "")).format(text(2, 12))
        for _ in range(r.choice((1, 2, 3, 5, 8, 14, 25))):
            body += r.choices((f"<p>{text(1, 8)}</p>", f"<p>{text(8, 90)}</p>", f"<p><b>{text(3, 40)}<br><p>{text(5, 50)}</p>",
                               f"<h2>{text(1, 8)}</h2>", "<ul>" + "".join(f"<li>{text(1, 15)}</li>" for _ in range(3)) + "</ul>",
                               f"<blockquote>{text(5, 40)}</blockquote>", f"<p>{text(3, 20)} <a href='/x'>{short()}</a> {text(3, 20)}</p>",
                               f"<table><tr><td>{text(1, 4)}</td><td>{text(1, 4)}</td></tr></table>", f"<pre>{text(3, 30)}</pre>",
                               f"<figure><figcaption>{text(3, 12)}</figcaption></figure>", f"<div>{text(8, 60)}</div>"),
                              (5, 14, 3, 2, 1, 1, 2, 0.5, 0.5, 0.5, 1))[0]
            if r.random() < 0.04:
                body += "\0" + r.choice((advert, side, form, notice, lambda: box("share", linked(3))))() + "\1"
        name = r.choice(("article", "content", "post", "entry", "main", "story", "text", "post-body", "entry-content", "article-body", word()))
        return r.choice((f"<article>{body}</article>", f"<article>{body}</article>", f"<main>{body}</main>", f"<main><article>{body}</article></main>",
                         f'<div class="{name}">{body}</div>', f'<div id="{name}">{body}</div>', f'<section class="{name}">{body}</section>',
                         f'<article class="{name}"><div class="{name}">{body}</div></article>', f"<div>{body}</div>", body))

    out = []
    for _ in range(n):
        some = lambda f, p: f() if r.random() < p else ""
        top = some(notice, 0.25) + some(header, 0.5) + some(menu, 0.8) + some(advert, 0.5) + some(form, 0.15) + some(side, 0.15)
        end = some(lambda: box("share", linked(3)), 0.2) + some(comments, 0.4) + some(side, 0.3) + some(advert, 0.3) + some(form, 0.2) + some(menu, 0.15) + some(footer, 0.85) + some(notice, 0.15)
        # \0 and \1 mark what is not main text; they stay in the text until labels are read off.
        wrap = r.choice(("{}", "{}", "{}", '<div class="page">{}</div>', '<div id="wrapper"><div class="container">{}</div></div>'))
        page = "<html><head><title>x</title></head><body>" + wrap.format(f"\0{top}\1{article()}\0{end}\1") + "</body></html>"
        marks, found, y, level = page, [], [], 0
        for b in blocks(re.sub(r"([\0\1])", r"<p>\1</p>", marks)):
            if b.text in "\0\1":
                level += 1 if b.text == "\0" else -1
            else:
                found.append(b)
                y.append(level == 0)
        out.append((found, np.array(y, np.float32)))
    return out


def windows(x: np.ndarray, y: np.ndarray, size: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """A page in as few sequences of like length as ``size`` blocks allow; every block is in one."""
    n = max(1, -(-len(x) // size))
    return list(zip(np.array_split(x, n), np.array_split(y, n)))


def train(pages: list[str], generated: int = 700, window: int = 400) -> dict[str, np.ndarray]:
    """Weights from generated pages and from ``pages`` labelled by names, whole; longer ones in windows of ``window`` blocks."""
    f, data = Features(), [(b, y) for b, y in generated_pages(generated)]
    for page in pages:
        found = blocks(page)
        data.append((found, label_by_names(found)))
    net = BiLstm(N_IN)
    net.fit([w for b, y in data for w in windows(f.page(b), y, window)])
    return net.p


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", sample: int = 256, window: int = 400) -> DataFrame:
    """Per row: id, url, text, n_chars, n_blocks, n_main.  ``sample`` bounds the table's pages used in training, ``window`` the blocks of a training sequence."""
    ship_package(pages.sparkSession)
    page = F.coalesce(F.col(html_col), F.lit("")).alias("_html")
    ids = pages.select(F.col(id_col).cast("long").alias("_id"), page).where("_id IS NOT NULL AND _html != ''")
    # The sample is chosen by id alone; only its pages come to the driver.
    chosen = [r[0] for r in ids.select("_id").orderBy(F.xxhash64("_id"), "_id").limit(sample).collect()]
    seen = [r[1] for r in sorted(map(tuple, ids.where(F.col("_id").isin(chosen)).limit(sample).collect()))] if chosen else []
    weights = train([r[0] for r in seen], window=window)
    names = [id_col, url_col, "text", "n_chars", "n_blocks", "n_main"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f, net = Features(), BiLstm(N_IN)
        net.p = weights

        def flush(held):
            main = net.classify([x for *_, x in held])
            out = []
            for (key, url, texts, _), keep in zip(held, main):
                text = "\n".join(t for t, k in zip(texts, keep) if k)
                out.append((key, url, text, len(text), len(texts), int(keep.sum())))
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

        held, size = [], 0
        for key, url, page in batches_of(rows, "_id", "_url", "_html"):
            found = blocks(page)
            held.append((key, url, [b.text for b in found], f.page(found)))
            size += len(found)
            if size > 20_000:
                yield flush(held)
                held, size = [], 0
        if held:
            yield flush(held)

    schema = f"{id_col} bigint, {url_col} string, text string, n_chars bigint, n_blocks bigint, n_main bigint"
    return pages.select(F.col(id_col).cast("long").alias("_id"), F.col(url_col).alias("_url"), page).mapInArrow(run, schema)
