"""Main text of web pages: a recurrent labeller reads a page's blocks in order and keeps those of the article."""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.frames import bounded_sample
from tessella.llm.text import SPACE, slices, words_of

PATH_DIM, WORD_DIM, SHAPE_DIM, HIDDEN = 96, 32, 8, 24
INPUT = PATH_DIM + WORD_DIM + SHAPE_DIM
SLICE_BYTES = 4 << 20
PAGES_AT_ONCE = 128
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|svg|head|iframe)(?=[\s/>])[^>]*>"
    r"|<(/?)([a-z][a-z0-9:-]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|</?[a-z][^>]*>|<[!?][^>]*>", re.S | re.I)
RAW = {"script", "style", "iframe"}  # without a closing tag they run to the page's end
CLOSING = {t: re.compile(rf"</{t}\s*>", re.I) for t in "script style iframe noscript template title".split()}
# what a head holds besides elements with a content of their own; anything else ends it
HEAD_PART = re.compile(
    r"\s+|<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(script|style|noscript|template|title)(?=[\s/>])[^>]*>"
    r"|<(?:head|/?(?:base|basefont|bgsound|link|meta))(?=[\s/>])(?:[^>\"']++|\"[^\"]*+\"|'[^']*')*+>"
    r"|</(?!(?:head|body|html|br)[\s/>])[a-z][^>]*>", re.S | re.I)
HEAD_END = re.compile(r"</head\s*>", re.I)
TITLE_END = re.compile(r"<(?:/?head|/?body|svg)(?=[\s/>])", re.I)
# in an svg: nested ones, parts that may hold HTML, and HTML's elements, before which an svg without closing tag ends
SVG_PART = re.compile(
    r"<!--.*?(?:-->|\Z)|<(foreignobject|desc|title|style|script)(?=[\s/>])[^>]*(?<!/)>.*?</\1\s*>"
    r"|<(/?svg)(?=[\s/>])[^>]*>|</?(?:article|aside|blockquote|body|br|center|dd|div|dl|dt|embed|em|footer|form|h[1-6]|head|header"
    r"|hr|html|img|li|main|menu|nav|ol|p|pre|section|small|span|strong|sub|sup|table|tbody|td|th|tr|ul)(?=[\s/>])", re.S | re.I)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
NAME = re.compile(r"[a-z]+")
# fixed values: HTML's elements without content, those inside a line, and those that end their like
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike "
             "strong sub sup time tt u var wbr img".split())
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = set("ul ol dl table article section div main body aside nav footer header form select blockquote".split())


@dataclass
class Block:
    """A leaf of a page: its text, the way of elements to it, and how much of it stands in links."""

    text: str
    path: tuple[str, ...]
    linked: float


class Skips:
    """Where the parts of a page that are no text end."""

    def __init__(self, page: str):
        self.page = page
        self.open: set[str] = set()  # elements that no later tag closes

    def closed(self, tag: str, at: int) -> int | None:
        m = None if tag in self.open else CLOSING[tag].search(self.page, at)
        if m is None:
            self.open.add(tag)
            return len(self.page) if tag in RAW else None
        return m.end()

    def end(self, tag: str, opening: str, at: int) -> int:
        """The end of the element whose opening tag ends at ``at``: that place, if only its tag is no text."""
        if tag == "head":
            return self.head(at)
        if tag == "svg":
            return at if closes_itself(opening) else self.svg(at)
        return self.closed(tag, at) or at

    def head(self, at: int) -> int:
        """At </head>, or before the first text or element that can't stand in a head."""
        while m := HEAD_PART.match(self.page, at):
            at = m.end()
            if not m[1]:
                continue
            end = self.closed(m[1].lower(), at)
            if m[1].lower() == "title" and (end is None or TITLE_END.search(self.page, at, end)):
                end = self.page.find("<", at)
                end = len(self.page) if end < 0 else end
            at = end or at
        m = HEAD_END.match(self.page, at)
        return m.end() if m else at

    def svg(self, at: int) -> int:
        depth, start = 1, at
        if "svg" in self.open:
            return at
        while m := SVG_PART.search(self.page, at):
            at = m.end()
            if m[2]:
                depth += -1 if m[2][0] == "/" else 0 if closes_itself(m[0]) else 1
                if not depth:
                    return at
            elif not m[1] and not m[0].startswith("<!--"):
                return m.start()
        self.open.add("svg")
        return start


def closes_itself(tag: str) -> bool:
    return tag.endswith("/>") and not re.search(r"=[^\s\"'>]*/>$", tag)


def blocks(page: str) -> list[Block]:
    """The page's non-empty blocks in order: runs of text between the borders of block elements.

    Character references are decoded, white space becomes one space. Comments, scripts, styles and the head are no
    text. Unclosed and misnested elements are closed as their borders demand; a text without markup is one block.
    Only a script, style or iframe without its closing tag runs to the page's end; a head ends where its content does,
    an svg before the next element of HTML, and of other such elements only the tag is skipped.
    """
    found: list[Block] = []
    stack: list[tuple[str, str]] = []
    parts: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                found.append(Block(text, tuple(s for _, s in stack), min(1.0, linked / len(text))))
            parts.clear()
        linked = 0

    at, skips = 0, Skips(page)
    while m := TOKEN.search(page, at):
        if m.start() > at:
            piece = page[at:m.start()]
            parts.append(piece)
            if any(t == "a" for t, _ in stack):
                linked += len(piece.strip())
        at = m.end()
        tag = (m[3] or "").lower()
        if not tag:
            if m[1]:
                at = skips.end(m[1].lower(), m[0], at)
                if m[1].lower() not in ("script", "style"):
                    parts.append(" ")
            continue
        if tag in ("br", "wbr"):
            parts.append(" " if tag == "br" else "")
            continue
        if tag not in INLINE:
            flush()
        if m[2]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
                if tag in INLINE and stack[k][0] not in INLINE:
                    break
        elif tag not in VOID and not m[4].rstrip().endswith("/"):
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in CLOSES.get(tag, ()):
                    del stack[k:]
                    break
                if stack[k][0] in SCOPE:
                    break
            if tag not in INLINE:
                while stack and stack[-1][0] in INLINE and stack[-1][0] != "a":
                    stack.pop()
            names = " ".join(next(filter(None, a.groups()[1:]), "") for a in ATTRIBUTE.finditer(m[4])) if m[4] else ""
            stack.append((tag, f"{tag} {names.lower()}".strip()))
    if at < len(page):
        parts.append(page[at:])
    flush()
    return found


def path_vector(path: tuple[str, ...], dim: int = PATH_DIM) -> np.ndarray:
    """A hashed bag of the tags, and of the words of class, id and role names, on the way to a block."""
    out = np.zeros(dim, np.float32)
    for depth, step in enumerate(path):
        tag, _, names = step.partition(" ")
        for name in [f"<{tag}>", *(f".{n}" for n in NAME.findall(names))]:
            h = hash_name(name)
            out[h % dim] += 1.0 if h >> 20 & 1 else -1.0
        if depth == len(path) - 1:
            h = hash_name(f"last:{tag}")
            out[h % dim] += 1.0 if h >> 20 & 1 else -1.0
    return np.clip(out, -3, 3)


def hash_name(name: str) -> int:
    h = 1469598103
    for b in name.encode():
        h = (h ^ b) * 16777619 & 0xFFFFFFFFFF
    return h ^ h >> 17


def page_inputs(pages: list[list[Block]], seen: dict[tuple[str, ...], np.ndarray]) -> np.ndarray:
    """One row for each block of all pages: path, hashed words and shape."""
    flat = [b for p in pages for b in p]
    out = np.zeros((len(flat), INPUT), np.float32)
    if not flat:
        return out
    for k, b in enumerate(flat):
        v = seen.get(b.path)
        if v is None:
            if len(seen) > 20_000:
                seen.clear()
            v = seen[b.path] = path_vector(b.path)
        out[k, :PATH_DIM] = v
    words = words_of(pa.array([b.text for b in flat], pa.large_string()), SPACE, lower=True)
    h, owner = words.hashes(), words.owners()
    sign = np.where(h >> np.uint64(40) & np.uint64(1), 1.0, -1.0)
    bag = np.bincount(owner * WORD_DIM + (h % np.uint64(WORD_DIM)).astype(np.int64), weights=sign,
                      minlength=len(flat) * WORD_DIM).reshape(-1, WORD_DIM)
    n = np.maximum(words.counts, 1)
    out[:, PATH_DIM:PATH_DIM + WORD_DIM] = bag / np.sqrt(n)[:, None] * 0.5
    size = np.fromiter((len(b.text) for b in flat), np.float64, len(flat))
    marks = np.fromiter((b.text[-1] in ".!?:;\"'" for b in flat), np.float64, len(flat))
    count = np.array([len(p) for p in pages])
    place = np.concatenate([np.arange(c) for c in count]) / np.repeat(np.maximum(count, 1), count)
    shape = [np.log1p(n), np.log1p(size) / 2, np.fromiter((b.linked for b in flat), np.float64, len(flat)), marks,
             place, 1 - place, np.log1p(np.repeat(count, count)) / 2, size / n / 8]
    out[:, PATH_DIM + WORD_DIM:] = np.stack(shape, 1)
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Two LSTMs, one in each direction, and a logistic output on both states of a block."""

    def __init__(self, seed: int = 7, weights: dict[str, np.ndarray] | None = None):
        rng = np.random.default_rng(seed)
        draw = lambda *s: rng.normal(0, 1 / np.sqrt(s[0]), s).astype(np.float32)
        self.w = weights or {}
        if not self.w:
            for d in "fb":
                self.w |= {f"x{d}": draw(INPUT, 4 * HIDDEN), f"h{d}": draw(HIDDEN, 4 * HIDDEN),
                           f"c{d}": np.repeat(np.array([0, 1, 0, 0], np.float32), HIDDEN)}
            self.w |= {"out": draw(2 * HIDDEN, 1)[:, 0], "bias": np.zeros(1, np.float32)}

    def scan(self, x: np.ndarray, mask: np.ndarray, d: str) -> tuple[np.ndarray, list[tuple[np.ndarray, ...]]]:
        """States (time, page, HIDDEN) of one direction over padded input (time, page, INPUT)."""
        steps, pages, _ = x.shape
        ahead = x @ self.w[f"x{d}"] + self.w[f"c{d}"]
        h = c = np.zeros((pages, HIDDEN), np.float32)
        out, kept = np.zeros((steps, pages, HIDDEN), np.float32), [()] * steps
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            z = ahead[t] + h @ self.w[f"h{d}"]
            i, f, o = (sigmoid(z[:, k * HIDDEN:(k + 1) * HIDDEN]) for k in range(3))
            g = np.tanh(z[:, 3 * HIDDEN:])
            new = f * c + i * g
            tanh = np.tanh(new)
            m = mask[t][:, None]
            kept[t] = (h, c, i, f, o, g, tanh)
            c = np.where(m, new, c)
            h = np.where(m, o * tanh, h)
            out[t] = h
        return out, kept

    def forward(self, x: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, tuple]:
        front, kept_f = self.scan(x, mask, "f")
        back, kept_b = self.scan(x, mask, "b")
        both = np.concatenate([front, back], 2)
        return sigmoid(both @ self.w["out"] + self.w["bias"]), (both, kept_f, kept_b)

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log loss over blocks, by backpropagation through time."""
        p, (both, kept_f, kept_b) = self.forward(x, mask)
        slope = np.where(mask, p - y, 0) / max(1, mask.sum())
        grads = {"out": np.einsum("tp,tph->h", slope, both), "bias": slope.sum(keepdims=True).reshape(1)}
        above = slope[:, :, None] * self.w["out"]
        for d, kept, part in (("f", kept_f, above[:, :, :HIDDEN]), ("b", kept_b, above[:, :, HIDDEN:])):
            steps, pages, _ = x.shape
            dz_all = np.zeros((steps, pages, 4 * HIDDEN), np.float32)
            dh = dc = np.zeros((pages, HIDDEN), np.float32)
            gh = np.zeros_like(self.w[f"h{d}"])
            for t in range(steps - 1, -1, -1) if d == "f" else range(steps):
                h, c, i, f, o, g, tanh = kept[t]
                m = mask[t][:, None]
                dh = dh + part[t]
                live = np.where(m, dh, 0)
                cell = np.where(m, dc, 0) + live * o * (1 - tanh * tanh)
                dz = np.concatenate([cell * g * i * (1 - i), cell * c * f * (1 - f), live * tanh * o * (1 - o),
                                     cell * i * (1 - g * g)], 1)
                dz_all[t] = dz
                gh += h.T @ dz
                dc = np.where(m, cell * f, dc)
                dh = np.where(m, dz @ self.w[f"h{d}"].T, dh)
            grads |= {f"h{d}": gh, f"x{d}": np.einsum("tpi,tpz->iz", x, dz_all), f"c{d}": dz_all.sum((0, 1))}
        return grads

    def probabilities(self, pages: list[list[Block]], seen: dict) -> list[np.ndarray]:
        """Of each page's blocks; pages of like length share a padded batch."""
        flat, count = page_inputs(pages, seen), [len(p) for p in pages]
        start = np.cumsum([0, *count])
        out: list[np.ndarray] = [np.zeros(0)] * len(pages)
        order = sorted(range(len(pages)), key=count.__getitem__)
        for k in range(0, len(order), PAGES_AT_ONCE):
            some = [i for i in order[k:k + PAGES_AT_ONCE] if count[i]]
            if some:
                x, mask = padded([flat[start[i]:start[i + 1]] for i in some])
                p, _ = self.forward(x, mask)
                for col, i in enumerate(some):
                    out[i] = p[:count[i], col]
        return out


def padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(map(len, rows))
    x, mask = np.zeros((steps, len(rows), INPUT), np.float32), np.zeros((steps, len(rows)), bool)
    for k, r in enumerate(rows):
        x[:len(r), k], mask[:len(r), k] = r, True
    return x, mask


# fixed values: names that page authors give to parts of a page
NAMES = {
    "menu": ["nav", "menu", "navbar", "main-menu", "breadcrumb", "topnav", "navigation", "links", "tabs", "toc"],
    "header": ["header", "masthead", "site-header", "topbar", "branding", "logo"],
    "footer": ["footer", "site-footer", "copyright", "colophon", "legal", "bottom"],
    "sidebar": ["sidebar", "aside", "widget", "related", "rail", "popular", "trending", "secondary", "recommended"],
    "notice": ["cookie", "notice", "banner", "consent", "alert", "popup", "modal", "gdpr", "overlay", "paywall"],
    "advert": ["ad", "ads", "advert", "sponsor", "promo", "sponsored", "advertisement", "adsbox", "promotion"],
    "form": ["form", "login", "subscribe", "newsletter", "search", "signup", "contact-form"],
    "comments": ["comments", "comment", "reply", "discussion", "disqus", "responses", "comment-list", "reader-comments"],
    "share": ["share", "social", "tags", "byline-links", "share-buttons", "pagination", "pager", "meta-links"],
    "article": ["article", "content", "post", "entry", "story", "main", "post-content", "entry-content", "article-body",
                "text", "body", "page"],
}
TAGS = {"menu": ["nav", "div", "ul"], "header": ["header", "div"], "footer": ["footer", "div"],
        "sidebar": ["aside", "div", "section"], "notice": ["div", "section", "dialog"], "advert": ["div", "aside", "ins"],
        "form": ["form", "div"], "comments": ["section", "div", "ol"], "share": ["div", "ul"],
        "article": ["article", "main", "div", "section"]}


def made_page(rng: random.Random, words: list[str]) -> tuple[str, list[int]]:
    """A page of random layout, and for each of its blocks whether it is of the article."""
    labels: list[int] = []

    def line(lo: int, hi: int) -> str:
        text = " ".join(rng.choice(words) for _ in range(rng.randint(lo, hi)))
        return html.escape(text[:1].upper() + text[1:] + rng.choice([".", ".", ".", "", "?"]))

    def block(tag: str, text: str, label: int) -> str:
        labels.append(label)
        return f"<{tag}>{text}" + (f"</{tag}>" if rng.random() < 0.9 else "" if tag in ("p", "li") else f"</{tag}>")

    def part(kind: str) -> str:
        tag = rng.choice(TAGS[kind])
        name = rng.choice(NAMES[kind])
        plain = tag not in ("div", "section", "ul", "ol") and rng.random() < 0.5
        attribute = "" if plain else f' {rng.choice(["class", "class", "id"])}="{name}{rng.choice(["", "-1", " box", " clearfix"])}"'
        inner = []
        if kind in ("menu", "share") or kind == "footer" and rng.random() < 0.3:
            body = "".join(block("li", f'<a href="/x">{line(1, 3)}</a>', 0) for _ in range(rng.randint(2, 8)))
            inner.append(body if tag == "ul" else f"<ul>{body}</ul>")
        elif kind == "sidebar":
            inner.append(block("h3", line(1, 4), 0))
            inner += [block("li", f'<a href="/x">{line(3, 9)}</a>', 0) for _ in range(rng.randint(1, 6))]
        elif kind == "comments":
            inner += [block(rng.choice(["p", "div", "li"]), line(2, 40), 0) for _ in range(rng.randint(1, 6))]
        elif kind == "form":
            inner += [block("label", line(1, 4), 0) + "<input>" for _ in range(rng.randint(1, 3))]
            inner.append(block("button", line(1, 2), 0))
        elif rng.random() < 0.5 and tag not in ("ul", "ol"):
            labels.append(0)
            inner.append(line(2, 25))
        else:
            inner += [block(rng.choice(["p", "div"]), line(2, 25), 0) for _ in range(rng.randint(1, 2))]
        return f"<{tag}{attribute}>{''.join(inner)}</{tag}>"

    def article() -> str:
        tag = rng.choice(TAGS["article"])
        plain = tag in ("article", "main") and rng.random() < 0.7
        attribute = "" if plain else f' class="{rng.choice(NAMES["article"])}"'
        inner = []
        if rng.random() < 0.8:
            title = block("h1", line(2, 12), 1)
            inner.append(f"<header>{title}</header>" if tag == "article" and rng.random() < 0.2 else title)
        for _ in range(rng.randint(1, 24)):
            kind = rng.random()
            if kind < 0.72:
                inner.append(block("p", line(1, 8) if rng.random() < 0.25 else line(6, 90), 1))
            elif kind < 0.8:
                inner.append(block(rng.choice(["h2", "h3"]), line(1, 7), 1))
            elif kind < 0.86:
                inner.append("<ul>" + "".join(block("li", line(1, 20), 1) for _ in range(rng.randint(1, 4))) + "</ul>")
            elif kind < 0.92:
                inner.append(block(rng.choice(["blockquote", "pre", "div", "td", "figcaption"]), line(2, 40), 1))
            elif kind < 0.97:
                inner.append(part(rng.choice(["advert", "share", "form", "notice", "sidebar"])))
            else:
                labels.append(1)
                inner.append(f"<p><b>{line(1, 30)}<br>")
        if rng.random() < 0.1:
            inner.append(part("comments"))
        return f"<{tag}{attribute}>{''.join(inner)}</{tag}>"

    parts = [part(k) for k in rng.sample(["menu", "header", "notice", "advert", "form", "sidebar"], rng.randint(0, 4))]
    parts.append(article())
    parts += [part(k) for k in rng.sample(["comments", "sidebar", "advert", "footer", "form", "share", "menu", "notice"],
                                          rng.randint(0, 4))]
    if rng.random() < 0.6:
        parts.append(part("footer"))
    wrap = rng.random() < 0.4
    body = f'<div class="{rng.choice(["wrapper", "container", "page", "site"])}">{"".join(parts)}</div>' if wrap else "".join(parts)
    return f"<!DOCTYPE html><html><head><title>{line(2, 6)}</title></head><body>{body}</body></html>", labels


def marked(page: list[Block]) -> list[int] | None:
    """Labels by a page's own markup: what stands in its one article element, outside of parts named otherwise."""
    if not any(s.split(" ")[0] == "article" for b in page for s in b.path):
        return None
    other = {n for k, names in NAMES.items() if k != "article" for n in names} | {"nav", "aside", "footer", "form"}
    out = []
    for b in page:
        inside = False
        for step in b.path:
            tag, _, names = step.partition(" ")
            inside |= tag == "article"
            if tag in other or other & set(names.split()):
                inside = False
                break
        out.append(int(inside))
    return out


def fit_labeller(samples: list[str], made: int = 900, epochs: int = 3, seed: int = 7) -> Labeller:
    """Train on made pages of random layouts in the sample's words, and on sampled pages that mark their article."""
    rng = random.Random(seed)
    parsed = [blocks(p) for p in samples]
    words = sorted({w for p in parsed for b in p for w in b.text.split()[:200]})[:20_000] or \
        "the of and to in is for on with as at by it from this that are".split()
    data: list[tuple[list[Block], list[int]]] = []
    for _ in range(made):
        page, labels = made_page(rng, words)
        got = blocks(page)
        if len(got) == len(labels):
            data.append((got, labels))
    data += [(p, y) for p in parsed if p and len(p) <= 200 and (y := marked(p)) is not None]
    model, seen = Labeller(seed), {}
    inputs = [page_inputs([p], seen) for p, _ in data]
    first = {k: np.zeros_like(v) for k, v in model.w.items()}
    second = {k: np.zeros_like(v) for k, v in model.w.items()}
    step = 0
    for epoch in range(epochs):
        order = sorted(range(len(data)), key=lambda k: (len(data[k][1]) // 8, rng.random()))
        groups = [order[k:k + 16] for k in range(0, len(order), 16)]
        rng.shuffle(groups)
        for group in groups:
            x, mask = padded([inputs[k] for k in group])
            y = np.zeros(mask.shape, np.float32)
            for col, k in enumerate(group):
                y[:len(data[k][1]), col] = data[k][1]
            grads = model.gradients(x, mask, y)
            size = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
            step += 1
            for k, g in grads.items():
                g = g * min(1.0, 1.0 / max(size, 1e-9))
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                rate = 0.02 * (1 - epoch / epochs * 0.7)
                model.w[k] = (model.w[k] - rate * (first[k] / (1 - 0.9**step)) /
                              (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return model


def extract_text(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html", sample: int = 200,
                 threshold: float = 0.5) -> DataFrame:
    """(key, url, text, n_blocks, n_kept) for each page: the kept blocks in page order, joined by one space.

    The labeller is trained on the driver on ``sample`` pages at most, the first by a hash of their html; every page is
    then labelled whole, in tasks. A null or empty page has no blocks and an empty text; repeated rows give the same
    text each. Other columns are not read.
    """
    some = pages.where(F.col(page).isNotNull() & (F.length(page) < 200_000)).select(page)
    some = bounded_sample(some, sample, F.col(page)).collect()
    model = fit_labeller([r[0] for r in some])
    shared = pages.sparkSession.sparkContext.broadcast(model.w)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, seen = Labeller(weights=shared.value), {}
        for rows in slices(batches, page, SLICE_BYTES):
            parsed = [blocks(p or "") for p in rows.column(2).to_pylist()]
            texts, kept = [], []
            for found, p in zip(parsed, own.probabilities(parsed, seen), strict=True):
                chosen = [b.text for b, keep in zip(found, p >= threshold, strict=True) if keep]
                texts.append(" ".join(chosen))
                kept.append(len(chosen))
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(1), pa.array(texts, pa.string()),
                 pa.array(list(map(len, parsed)), pa.int64()), pa.array(kept, pa.int64())],
                [key, url, "text", "n_blocks", "n_kept"])

    kinds = dict(pages.dtypes)
    return pages.select(key, url, page).mapInArrow(
        run, f"`{key}` {kinds[key]}, `{url}` {kinds[url]}, text string, n_blocks long, n_kept long")
