"""Main text of web pages: a bidirectional LSTM labels every block of a page.

A page is cut into blocks: runs of text between block-level tags.  Each block is a vector of
its hashed tag path (names, classes, ids), its hashed words and a few figures; the network
reads the page's blocks from both ends, so a label depends on all of the page.  It is trained
here, on a bounded sample of the pages, labelled by tags that say what they hold, and on pages
built from their texts in many layouts.
"""

from __future__ import annotations

import html as entities
import random
import re
import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import arrow_udf, pieces

#: Pages that training may read, none longer than so many bytes: the bound of its sample.
SAMPLE_PAGES, SAMPLE_BYTES = 150, 60_000
BUILT_PAGES, EPOCHS, BATCH = 1500, 4, 32
PATH, WORD, FIGURES, HIDDEN = 512, 64, 10, 24
INPUT = PATH + WORD + FIGURES

_NAME = r"[a-zA-Z][^\s/>]*+"
_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>|"
    rf"<(/?)({_NAME})((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)({_NAME})([^>]*+)>",
    re.S,
)
_NOSCRIPT_END = re.compile(r"</noscript\b", re.I)
_ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Elements whose contents are no markup: skipped up to their end tag.
SKIPPED = frozenset("script style textarea iframe title".split())
#: Elements whose contents are no text of the page; they end with their parent at the latest.
UNSEEN = frozenset("template select button svg object canvas noscript".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp "
    "small span strike strong sub sup time tt u var wbr br "
    "math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom msub msup msubsup "
    "munder mover munderover mmultiscripts mprescripts none mtable mtr mtd semantics annotation annotation-xml "
    "maction menclose mfenced".split()
)
#: An opening tag ends open elements of these names.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
_SCOPE = frozenset("ul ol dl table body html article section div td th".split()) | UNSEEN


class Block(NamedTuple):
    path: tuple[tuple[str, str], ...]  # name and class, id, role, outermost first
    text: str
    linked: int  # characters inside links


def blocks(page: str) -> list[Block]:
    """The blocks of a page that have text, in its order.

    Comments, declarations and the contents of ``SKIPPED`` and ``UNSEEN`` elements are left out; character
    references are decoded, white space (``<br>`` too) becomes one space.  A head has no text but
    that of such elements, so other text before its end tag, or without one, is the page's.  A
    ``noscript`` that no end tag follows is no element.
    """
    found: list[Block] = []
    stack: list[tuple[str, str]] = []
    parts: list[str] = []
    linked = links = hidden = 0
    where: tuple | None = None
    last: int | None = None  # where the last end tag of a noscript stands

    def close() -> None:
        nonlocal parts, linked, where
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                found.append(Block(where or (), text, linked))
        parts, linked, where = [], 0, None

    def drop(n: int) -> None:
        nonlocal links, hidden
        links -= sum(name == "a" for name, _ in stack[n:])
        hidden -= sum(name in UNSEEN for name, _ in stack[n:])
        del stack[n:]

    at = 0
    while at < len(page):
        token = _TOKEN.search(page, at)
        stop = token.start() if token else len(page)
        if stop > at and not hidden:
            text = page[at:stop]
            if where is None and not text.isspace():
                where = tuple(stack) if len(stack) <= 16 else (*stack[:6], *stack[-10:])
            parts.append(text)
            linked += len(text) if links else 0
        if token is None:
            break
        at = token.end()
        name = token[2] or token[5]
        if name is None:
            continue
        name = name.lower()
        closing, attributes = bool(token[1] or token[4]), token[3] or token[6] or ""
        if name in SKIPPED:
            if not closing and not attributes.endswith("/"):
                end = re.compile(rf"</{name}\b[^>]*>", re.I).search(page, at)
                at = end.end() if end else len(page)
            parts.append(" ")
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name == "head":
            if not hidden:
                close()
            continue
        if name == "noscript" and not closing:
            if last is None:
                last = max((m.start() for m in _NOSCRIPT_END.finditer(page)), default=-1)
            if last < at:
                parts.append(" ")
                continue
        inner = name in INLINE or name in UNSEEN
        if name in UNSEEN:
            parts.append(" ")
        if not inner and not hidden:
            close()
        if closing:
            for n in range(len(stack) - 1, -1, -1):
                if stack[n][0] == name:
                    was = hidden
                    drop(n)
                    if was and not hidden and not inner:
                        close()
                    break
            continue
        if name in VOID or attributes.endswith("/"):
            continue
        if not inner:
            for n in range(len(stack) - 1, -1, -1):
                if stack[n][0] == "p" or stack[n][0] in ENDS.get(name, ()):
                    drop(n)
                elif stack[n][0] in _SCOPE:
                    break
        marks = ""
        if attributes:
            marks = " ".join(f"{m[1].lower()}={m[2] or m[3] or m[4] or ''}" for m in _ATTRIBUTE.finditer(attributes))
            if re.search(r"\bhidden\b|display:\s*none", attributes, re.I):
                marks += " class=hidden"
        stack.append((name, marks))
        links += name == "a"
        hidden += name in UNSEEN
    close()
    return found


def _hash(text: str, size: int) -> int:
    return zlib.crc32(text.encode()) % size


_elements: dict[tuple[str, str], list[int]] = {}


def _element(element: tuple[str, str]) -> list[int]:
    """Hashed names of an element: its tag, and the words of its class, id and role."""
    known = _elements.get(element)
    if known is None:
        name, marks = element
        tokens = [name]
        for m in marks.split():
            value = m.partition("=")[2] or m
            tokens += ["." + part.lower() for part in _PART.findall(value)]
        known = [_hash(t, PATH) for t in dict.fromkeys(tokens)]
        if len(_elements) > 50_000:
            _elements.clear()
        _elements[element] = known
    return known


_words: dict[str, int] = {}
_CAPITAL = re.compile(r"[A-ZÀ-ÖØ-Þ]")


def _word(word: str) -> int:
    known = _words.get(word)
    if known is None:
        if len(_words) > 200_000:
            _words.clear()
        known = _words[word] = _hash(word, WORD)
    return known


def vectors(page: list[Block]) -> np.ndarray:
    """One row of INPUT numbers for each block."""
    x = np.zeros((len(page), INPUT), np.float32)
    for i, b in enumerate(page):
        for element in b.path:
            x[i, _element(element)] = 1
        if b.path:
            name = b.path[-1][0]
            x[i, _hash("<" + name, PATH)] = 1
        words = b.text.lower().split()
        counts = np.bincount([_word(w) for w in words], minlength=WORD)
        x[i, PATH : PATH + WORD] = counts / np.sqrt(len(words))
        n = len(b.text)
        x[i, PATH + WORD :] = (
            np.log1p(n) / 6,
            np.log1p(len(words)) / 4,
            min(1.0, b.linked / n),
            sum(map(b.text.count, ".,;:!?")) / n * 10,
            b.text[-1] in ".!?:\"'”»…",
            len(_CAPITAL.findall(b.text)) / n,
            len(b.path) / 10,
            i / len(page),
            i == 0,
            i == len(page) - 1,
        )
    return x


class Model(NamedTuple):
    enter: np.ndarray  # 2 x INPUT x 4 HIDDEN
    again: np.ndarray  # 2 x HIDDEN x 4 HIDDEN
    bias: np.ndarray  # 2 x 4 HIDDEN
    out: np.ndarray  # 2 HIDDEN + 1


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Pages x blocks numbers of rows of the joined blocks (-1: none), and lengths."""
    sizes = np.array([len(p) for p in pages])
    start = np.cumsum(sizes) - sizes
    place = np.arange(sizes.max(initial=0))[None, :]
    return np.where(place < sizes[:, None], start[:, None] + place, -1), sizes


def _run(model: Model, side: int, x: np.ndarray, rows: np.ndarray, keep: list | None = None) -> np.ndarray:
    """Outputs of one direction for all blocks; ``rows`` is in the order of reading."""
    entered = x @ model.enter[side] + model.bias[side]
    h = np.zeros((len(rows), HIDDEN), np.float32)
    c = np.zeros_like(h)
    out = np.zeros((len(x), HIDDEN), np.float32)
    for t in range(rows.shape[1]):
        at = rows[:, t]
        on = at >= 0
        gates = entered[at[on]] + h[on] @ model.again[side]
        i, f, o = (_sigmoid(gates[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
        g = np.tanh(gates[:, 3 * HIDDEN :])
        before = c[on]
        now = f * before + i * g
        if keep is not None:
            keep.append((at[on], on, i, f, o, g, before, now, h[on].copy()))
        c[on] = now
        h[on] = o * np.tanh(now)
        out[at[on]] = h[on]
    return out


def _reversed(rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    place = sizes[:, None] - 1 - np.arange(rows.shape[1])[None, :]
    turned = np.take_along_axis(rows, np.maximum(place, 0), 1) if rows.size else rows
    return np.where(place >= 0, turned, -1)


def chances(model: Model, pages: list[np.ndarray]) -> list[np.ndarray]:
    """Per page the probability of each block to be main text.  Pages are read together with
    others of about their length."""
    result: list[np.ndarray] = [np.zeros(0)] * len(pages)
    order = sorted(range(len(pages)), key=lambda p: len(pages[p]))
    at = 0
    while at < len(order):
        # Some thousand blocks at once, or one page.
        group, total = [], 0
        while at < len(order) and (not group or total + len(pages[order[at]]) <= 6000):
            group.append(order[at])
            total += len(pages[order[at]])
            at += 1
        some = [pages[p] for p in group if len(pages[p])]
        if not some:
            continue
        x = np.concatenate(some)
        rows, sizes = _padded(some)
        both = np.hstack([_run(model, 0, x, rows), _run(model, 1, x, _reversed(rows, sizes))])
        p = _sigmoid(both @ model.out[:-1] + model.out[-1])
        ends = np.cumsum(sizes)
        k = 0
        for page in group:
            if len(pages[page]):
                result[page] = p[ends[k] - sizes[k] : ends[k]]
                k += 1
    return result


def _gradient(model: Model, pages: list[np.ndarray], truth: np.ndarray) -> tuple[list[np.ndarray], float]:
    x = np.concatenate(pages)
    rows, sizes = _padded(pages)
    kept: tuple[list, list] = ([], [])
    sides = [_run(model, 0, x, rows, kept[0]), _run(model, 1, x, _reversed(rows, sizes), kept[1])]
    both = np.hstack(sides)
    p = _sigmoid(both @ model.out[:-1] + model.out[-1])
    known = truth >= 0
    error = np.where(known, p - truth, 0) / max(known.sum(), 1)
    loss = -np.log(np.maximum(np.where(truth == 1, p, 1 - p)[known], 1e-9)).mean()
    d_out = np.append(both.T @ error, error.sum())
    d_enter, d_again = np.zeros_like(model.enter), np.zeros_like(model.again)
    d_bias = np.zeros_like(model.bias)
    for side in (0, 1):
        d_h_all = error[:, None] * model.out[side * HIDDEN : (side + 1) * HIDDEN][None, :]
        d_entered = np.zeros((len(x), 4 * HIDDEN), np.float32)
        d_h = np.zeros((len(pages), HIDDEN), np.float32)
        d_c = np.zeros_like(d_h)
        for at, on, i, f, o, g, before, now, h in reversed(kept[side]):
            dh = d_h[on] + d_h_all[at]
            tc = np.tanh(now)
            dc = d_c[on] + dh * o * (1 - tc * tc)
            d = np.hstack(
                [dc * g * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)]
            )
            d_entered[at] = d
            d_again[side] += h.T @ d
            d_h[on] = d @ model.again[side].T
            d_c[on] = dc * f
        d_enter[side] = x.T @ d_entered
        d_bias[side] = d_entered.sum(0)
    return [d_enter, d_again, d_bias, d_out], float(loss)


def fit(pages: list[np.ndarray], labels: list[np.ndarray], epochs: int = EPOCHS, seed: int = 1) -> Model:
    """Adam steps on batches of pages; labels are 1, 0 or -1 (unknown)."""
    rng = np.random.default_rng(seed)
    model = Model(
        rng.normal(0, 0.1, (2, INPUT, 4 * HIDDEN)).astype(np.float32),
        rng.normal(0, 0.15, (2, HIDDEN, 4 * HIDDEN)).astype(np.float32),
        np.zeros((2, 4 * HIDDEN), np.float32),
        rng.normal(0, 0.2, 2 * HIDDEN + 1).astype(np.float32),
    )
    m = [np.zeros_like(p) for p in model]
    v = [np.zeros_like(p) for p in model]
    step, steps = 0, epochs * -(-len(pages) // BATCH)
    for _ in range(epochs):
        order = rng.permutation(len(pages))
        for first in range(0, len(order), BATCH):
            batch = [k for k in order[first : first + BATCH] if len(pages[k])]
            if not batch:
                continue
            step += 1
            grads, _ = _gradient(model, [pages[k] for k in batch], np.concatenate([labels[k] for k in batch]))
            for p, g, a, b in zip(model, grads, m, v, strict=True):
                g = g.astype(np.float32) + 1e-5 * p
                a += 0.1 * (g - a)
                b += 0.01 * (g * g - b)
                p -= 0.01 * (1.05 - step / steps) * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)
    return model


#: Path words that say what a part of a page holds, for the labels of the sample.
_OTHER = frozenset(
    "nav footer aside form ad ads advert advertisement sponsored promo sidebar widget menu cookie notice "
    "banner comment comments share social related breadcrumb breadcrumbs newsletter subscribe".split()
)
_MAIN = frozenset("article main".split())


def tagged(block: Block) -> int:
    """1 inside an article or main element, 0 inside what is named as something else, else -1."""
    label = -1
    for name, marks in block.path:
        words = {name} | {p.lower() for m in marks.split() for p in _PART.findall(m.partition("=")[2])}
        if words & _OTHER:
            return 0
        if name in _MAIN:
            label = 1
        elif name == "header" and label < 1:
            return 0
    return label


_C, _B = "", ""  # marks of main and other text in built pages


class _Builder:
    """Pages in many layouts from given texts, each block marked with what it is."""

    def __init__(self, texts: list[str], seed: int) -> None:
        self.r = random.Random(seed)
        self.texts = texts
        self.words = [w for t in texts for w in t.split()] or ["lorem"]

    def some(self, low: int, high: int) -> str:
        return " ".join(self.r.choices(self.words, k=self.r.randint(low, high)))

    def attrs(self, names: str) -> str:
        """A class, an id or both; sometimes with more words around."""
        name = self.r.choice(names.split("|"))
        if self.r.random() < 0.3:
            name = self.r.choice(["{}-wrap", "{} box", "{}-1", "site-{}", "{}-inner", "main-{}", "block {}", "{}_list"]).format(name)
        return self.r.choice([f' class="{name}"', f' id="{name}"', f' class="{name}" id="x{self.r.randint(1, 99)}"'])

    def plain(self) -> str:
        k = self.r.randint(0, 3)
        return ["", f' class="c{self.r.randint(1, 99)}"', ' class="row"', ' class="container"'][k]

    def other(self, text: str) -> str:
        return _B + text

    def sentence(self) -> str:
        return self.r.choice(self.texts)[:300] if self.texts and self.r.random() < 0.6 else self.some(3, 25) + "."

    def links(self) -> str:
        items = [self.other(self.some(1, 3)) for _ in range(self.r.randint(2, 8))]
        style = self.r.randint(0, 3)
        if style == 0:
            return "<ul>" + "".join(f'<li><a href="/{i}">{t}</a></li>' for i, t in enumerate(items)) + "</ul>"
        if style == 1:
            return "".join(f'<div><a href="#{i}">{t}</a></div>' for i, t in enumerate(items))
        if style == 2:
            return "<p>" + " | ".join(f'<a href="/{i}">{t}</a>' for i, t in enumerate(items)) + "</p>"
        return "<ul>" + "".join(f"<li>{t}" for t in items) + "</ul>"

    def paragraphs(self, n: int) -> str:
        tag = self.r.choice(["p", "p", "div", "li", "span"])
        inner = "".join(f"<{tag}>{self.other(self.sentence())}</{tag}>" for _ in range(n))
        return f"<ul>{inner}</ul>" if tag == "li" else f"<div>{inner}</div>" if tag == "span" else inner

    def part(self, tag: str, names: str, inner: str) -> str:
        own = self.r.choice([tag, tag, "div", "section"])
        return f"<{own}{self.attrs(names) if own != tag or self.r.random() < 0.6 else ''}>{inner}</{own}>"

    def menu(self) -> str:
        return self.part("nav", "nav|menu|navbar|navigation|topnav|breadcrumb|breadcrumbs|tabs|pagination", self.links())

    def head(self) -> str:
        name = self.other(self.some(1, 5))
        return self.part("header", "header|masthead|topbar|logo|branding|top", f"<{(t := self.r.choice(['div', 'h1', 'p', 'a']))}>{name}</{t}>" + (self.menu() if self.r.random() < 0.5 else ""))

    def notice(self) -> str:
        words = self.r.choice(["We use cookies", "This site uses cookies.", "Notice:", "Please enable JavaScript", "Accept", ""])
        inner = f"<p>{self.other(words + ' ' + self.sentence())}</p>" if self.r.random() < 0.6 else self.other(words + " " + self.sentence())
        return f"<div{self.attrs('cookie|cookie-banner|notice|alert|consent|gdpr|banner|popup|modal|message|announcement|warning|privacy')}{self.r.choice(['', ' role=alert', ' hidden'])}>{inner}</div>"

    def advert(self) -> str:
        own = self.r.choice(["div", "div", "aside", "ins", "section", "p"])
        inner = self.other(self.sentence())
        inner = inner if self.r.random() < 0.6 or own == "p" else f"<p>{inner}</p>"
        return f"<{own}{self.attrs('ad|ads|advert|advertisement|adbox|sponsor|sponsored|promo|promotion|adsbygoogle|banner-ad')}>{inner}</{own}>"

    def sidebar(self) -> str:
        inner = f"<h3>{self.other(self.some(1, 4))}</h3>" + (self.links() if self.r.random() < 0.6 else self.paragraphs(self.r.randint(1, 4)))
        return self.part("aside", "sidebar|widget|related|recent|trending|popular|rail|side|aside|more|recommended|tags|author-bio", inner)

    def form(self) -> str:
        label = self.r.choice(["Email", "Name", "Search", "Subscribe to our newsletter", "Your comment", "Log in", "Sign up", ""])
        inner = f"<label>{self.other(label + ' ' + self.some(1, 4))}</label><input name=q><button>Go</button>"
        if self.r.random() < 0.6:
            inner = f"<p>{self.other(self.sentence())}</p>" + inner
        return f"<form{self.r.choice(['', self.attrs('search|login|newsletter|subscribe|signup|contact')])}>{inner}</form>"

    def share(self) -> str:
        return f"<div{self.attrs('share|social|sharing|follow|byline|meta|tools|buttons')}>{self.links()}</div>"

    def comments(self) -> str:
        each = self.r.choice(["div", "li", "article", "section"])
        inner = ""
        for _ in range(self.r.randint(1, 5)):
            who = self.r.choice(["", f"<b>{self.other(self.some(1, 2))}</b>", f"<div class=author>{self.other(self.some(1, 2))} says:</div>", f"<h4>{self.other(self.some(1, 3))}</h4>"])
            said = "".join(f"<p>{self.other(self.sentence())}</p>" for _ in range(self.r.randint(1, 3)))
            mark = self.attrs("comment|reply|response|comment-body|review|post-reply") if self.r.random() < 0.8 else ""
            inner += f"<{each}{mark}>{who}{said}</{each}>"
        title = f"<h{self.r.randint(2, 4)}>{self.other(self.r.choice(['Comments', 'Responses', '3 replies', 'Discussion', self.some(1, 3)]))}</h2>" if self.r.random() < 0.7 else ""
        own = self.r.choice(["div", "section", "ol", "aside"])
        return f"<{own}{self.attrs('comments|commentlist|respond|discussion|disqus|comment-section|reader-comments|responses|replies|thread')}>{title}{inner}</{own}>"

    def foot(self) -> str:
        inner = self.r.choice(["&copy; ", "Copyright ", "", "All rights reserved "])
        text = self.other(f"{inner}{self.some(1, 4)} &middot; {self.sentence()}")
        inner = text if self.r.random() < 0.6 else f"<p>{text}</p>" + (self.links() if self.r.random() < 0.5 else "")
        return self.part("footer", "footer|colophon|bottom|copyright|legal|foot|imprint", inner)

    def inline(self, text: str) -> str:
        words = text.split(" ")
        if len(words) > 4 and self.r.random() < 0.4:
            k = self.r.randrange(len(words))
            tag = self.r.choice(["b", "i", "em", "strong", 'a href="/x"', "span", "code"])
            words[k] = f"<{tag}>{words[k]}</{tag.split()[0]}>"
            if self.r.random() < 0.2:
                words.insert(k, "<br>")
        return " ".join(words)

    def main(self) -> str:
        r, out = self.r, []
        if r.random() < 0.85:
            title = f"<h1>{_C}{self.some(2, 12)}</h1>"
            out.append(f"<header>{title}</header>" if r.random() < 0.15 else title)
        extra = [self.advert, self.share, self.form, self.sidebar, self.notice, self.menu]
        style = r.random()
        for k in range(r.randint(1, 14)):
            text = r.choice(self.texts) if self.texts and r.random() < 0.8 else self.some(1, 120) + "."
            text = self.inline(_C + (text if r.random() < 0.8 else " ".join(text.split()[: r.randint(1, 6)])))
            if style < 0.2 and k == 0:
                out.append(f"<p><b>{text}<br>")
                continue
            tags = ["p"] * 10 + ["h2", "h3", "blockquote", "li", "pre", "td", "div", "figcaption", "dd", "div p"]
            tag = r.choice(tags) if style < 0.75 else "p" if style < 0.9 else "div"
            wrapped = {
                "li": f"<ul><li>{text}</li><li>{_C}{self.some(1, 20)}</li></ul>",
                "td": f"<table><tr><td>{text}</td><td>{_C}{self.some(1, 5)}</td></tr></table>",
                "dd": f"<dl><dt>{_C}{self.some(1, 3)}</dt><dd>{text}</dd></dl>",
                "div p": f"<div{self.plain()}><p>{text}</p></div>",
                "figcaption": f"<figure><img src=x><figcaption>{text}</figcaption></figure>",
            }
            out.append(wrapped.get(tag) or f"<{tag}>{text}" + ("" if tag == "p" and r.random() < 0.15 else f"</{tag}>"))
            if r.random() < 0.08:
                out.append(r.choice(extra)())
        if r.random() < 0.12:
            out.append(self.comments())
        inner = "".join(out)
        names = "content|post|entry|entry-content|post-content|article-body|story|text|body|main-content|post-body|page-content|article|main|single"
        own = r.choice(["article", "article", "main", "div", "div", "section"])
        mark = r.choice([self.attrs(names), self.attrs(names), self.plain()]) if own in ("div", "section") else r.choice(["", self.attrs(names), self.plain()])
        inner = f"<{own}{mark}>{inner}</{own}>"
        if r.random() < 0.3:
            inner = f"<{(t := r.choice(['main', 'div', 'section']))}{self.plain()}>{inner}</{t}>"
        return inner

    def page(self) -> str:
        r = self.r
        before = [self.head, self.menu, self.notice, self.advert, self.form, self.sidebar, self.share]
        after = [self.comments, self.sidebar, self.share, self.form, self.advert, self.foot, self.menu, self.notice]
        parts = [r.choice(before)() for _ in range(r.randint(0, 4))] + [self.main()]
        parts += [r.choice(after)() for _ in range(r.randint(0, 4))]
        if r.random() < 0.6:
            parts.append(self.foot())
        if r.random() < 0.3:
            parts = [f"<div{self.plain()}>{p}</div>" for p in parts]
        return f"<html><head><title>t</title></head><body>{''.join(parts)}</body></html>"


def built(texts: list[str], n: int = BUILT_PAGES, seed: int = 5) -> tuple[list[list[Block]], list[np.ndarray]]:
    """Blocks and labels of built pages."""
    builder = _Builder(texts, seed)
    pages, labels = [], []
    for _ in range(n):
        found = [b for b in blocks(builder.page()) if b.text.strip(_C + _B + " ")]
        labels.append(np.array([1 if _C in b.text else 0 if _B in b.text else -1 for b in found], float))
        clean = [b._replace(text=" ".join(b.text.replace(_C, "").replace(_B, "").split()) or "-") for b in found]
        pages.append(clean)
    return pages, labels


def train(pages: DataFrame, sample: int = SAMPLE_PAGES, n: int = BUILT_PAGES, epochs: int = EPOCHS) -> Model:
    """Fit on the ``sample`` different pages first by the hash of their html, and ``n`` pages
    built from the texts in them.  Only hashes are ranked; then the chosen pages are read."""
    fit_for = pages.where(F.octet_length("html").between(1, SAMPLE_BYTES))
    fit_for = fit_for.select(F.xxhash64("html").alias("h"), "html")
    first = [r.h for r in fit_for.select("h").distinct().orderBy("h").limit(sample).collect()]
    chosen = fit_for.where(F.col("h").isin(first)).groupBy("h").agg(F.min("html").alias("html"))
    rows = chosen.orderBy("h").collect()
    return train_on([r.html for r in rows], n, epochs)


def train_on(sample: list[str], n: int = BUILT_PAGES, epochs: int = EPOCHS) -> Model:
    real = [blocks(h) for h in sample]
    texts = [b.text for page in real for b in page if tagged(b) == 1]
    made, labels = built(texts, n)
    pages = [vectors(p) for p in real + made]
    truth = [np.array([tagged(b) for b in page], float) for page in real] + labels
    return fit(pages, truth, epochs)


def main_text(page: Column, model: Model) -> Column:
    """The main text of a page: its blocks that are labelled so, in order, one a line.  Null
    and empty pages, and pages without main text, give the empty text."""

    @arrow_udf("string")
    def run(column: pa.Array) -> pa.Array:
        out = []
        for _, part in pieces(column, 1_000_000):
            found = [blocks(h.decode("utf-8", "replace")) for h in part]
            for page, p in zip(found, chances(model, [vectors(b) for b in found]), strict=True):
                out.append("\n".join(b.text for b, good in zip(page, p > 0.5, strict=True) if good))
        return pa.array(out, pa.string())

    return run(page)


def extract(pages: DataFrame, model: Model, *, html: str = "html") -> DataFrame:
    """``row`` (the columns of ``pages``), ``text`` and ``n_chars``, one row per page.

    Repeated rows get equal texts; an empty table gives an empty result.
    """
    found = pages.select(F.struct("*").alias("row")).withColumn("text", main_text(F.col(f"row.{html}"), model))
    return found.select("row", "text", F.length("text").cast("bigint").alias("n_chars"))
