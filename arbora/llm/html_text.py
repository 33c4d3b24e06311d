"""Main text of web pages: a recurrent block labeller.

A page is cut into leaf blocks: runs of text between block-level tags.  Each block has a tag-path vector (hashed tags,
classes and ids of its ancestors), a hashed-word vector and a few densities.  A bidirectional LSTM in numpy reads the
page's whole sequence of blocks and labels each as main text or not, so that a block is judged in the context of the
document.  It is trained on pages generated here, whose blocks are labelled as they are made: articles in many
layouts among menus, notices, adverts, forms, related links and reader comments.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections.abc import Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arbora.llm.tokens import encode, memo, slices

#: What follows "<" of a tag, matched in one pass without going back: a quote counts only where a value starts.
TAG = re.compile(r"(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>]*+)|[^\s/>=]++)*+)>")
#: Elements whose content is skipped up to their end tag; without one, those of the first kind hide the rest of the page.
RAW, ASIDE = frozenset("script style textarea".split()), frozenset("noscript template iframe svg select".split())
ENDS = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*+>", re.I) for t in RAW | ASIDE}
ATTRIBUTE = re.compile(r"\b(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
WORD = re.compile(r"\w+")
#: Elements that start and end blocks, and those without content.
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html label legend li main menu nav ol option p pre "
    "section summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("ul ol dl table body html div section article".split())
PATHS, WORDS, PATH_DIM, WORD_DIM, DENSE, HIDDEN = 1024, 2048, 24, 8, 9, 16
PAGES, EPOCHS, BATCH = 1_000, 6, 40


def tokens(page: str) -> Iterator[tuple[str, str, str, str]]:
    """(kind, text or tag name, attributes, slash) of a page's texts and tags, in one pass whatever the page holds.

    As in a browser: "<" starts a tag only before a letter or a slash, comments end at "-->", and what is left open at
    the end of the page is no text.
    """
    at, n, last = 0, len(page), page.rfind(">")
    gone: set[str] = set()  # elements without an end tag from here on
    while at < n:
        k = page.find("<", at)
        if k < 0:
            yield "text", page[at:], "", ""
            return
        if k > at:
            yield "text", page[at:k], "", ""
        c = page[k + 1 : k + 2]
        if c in "!?" and c or c == "/" and not page[k + 2 : k + 3].isalpha():
            if page.startswith("<!--", k):
                short = next((x for x in ("<!-->", "<!--->") if page.startswith(x, k)), None)
                end = page.find("-->", k + 4)
                at = k + len(short) if short else end + 3 if end >= 0 else n
            else:
                at = page.find(">", k) + 1 or n
            continue
        if not (c == "/" or c.isascii() and c.isalpha()):
            yield "text", "<", "", ""
            at = k + 1
            continue
        m = TAG.match(page, k + 1) if k < last else None
        if m is None:
            return
        at, name, slash = m.end(), m.group(2).lower(), m.group(1)
        if not slash and name in ENDS and name not in gone and not (name == "svg" and m.group(3).endswith("/")):
            end = ENDS[name].search(page, at)
            if end:
                at = end.end()
                continue
            gone.add(name)
            if name in RAW:
                return
        yield "tag", name, m.group(3), slash


#: Names of so many of the nearest ancestors, and of so many of each one's words, describe a block.
NEAR, NAMES = 48, 24


class Element:
    __slots__ = ("_path", "names", "parent", "tag")

    def __init__(self, tag: str, names: tuple[str, ...], parent: Element | None):
        self.tag, self.names, self.parent, self._path = tag, names, parent, None

    def path(self) -> tuple[str, ...]:
        if self._path is None:
            own, e = [], self
            while e is not None and len(own) < NEAR:
                own.append(e.names)
                e = e.parent
            self._path = tuple(x for names in reversed(own) for x in names)
        return self._path


def blocks(page: str) -> list[tuple[tuple[str, ...], str, int, int]]:
    """(path, text, linked characters, characters) of each leaf block; blank ones are left out."""
    out: list[tuple[tuple[str, ...], str, int, int]] = []
    stack: list[Element] = []
    where: dict[str, list[int]] = {}  # depths of open elements by tag
    block_at: list[int] = []  # and of those that are blocks
    run: list[str] = []
    linked = 0

    def close() -> None:
        nonlocal linked
        if run:
            text = " ".join("".join(run).split())
            if text:
                out.append((stack[-1].path() if stack else (), text, linked, len(text)))
            run.clear()
        linked = 0

    def pop_to(k: int) -> None:
        if block_at and block_at[-1] >= k:
            close()
        while len(stack) > k:
            where[stack.pop().tag].pop()
        while block_at and block_at[-1] >= k:
            block_at.pop()

    deepest = lambda tags: max((where[t][-1] for t in tags if where.get(t)), default=-1)
    for kind, tag, attributes, slash in tokens(page):
        if kind == "text":
            text = entities.unescape(tag) if "&" in tag else tag
            run.append(text)
            if where.get("a"):
                linked += len(text.strip())
            continue
        if slash:
            if where.get(tag):
                pop_to(where[tag][-1])
            elif tag in BLOCKS:
                close()
            continue
        if tag in BLOCKS:
            close()
            if block_at and stack[block_at[-1]].tag == "p":  # a paragraph ends where a block begins
                pop_to(block_at[-1])
            ends = CLOSES.get(tag)
            if ends and (k := deepest(ends)) > deepest(SCOPES):
                pop_to(k)
        if tag in VOID:
            if tag == "br":
                run.append("\n")
            continue
        names = [tag]
        if "=" in attributes:
            for a in ATTRIBUTE.finditer(attributes):
                names += [f".{x}" for x in re.split(r"[\s_-]+", (a.group(1) or a.group(2) or a.group(3) or "").lower()) if x]
                if len(names) > NAMES:
                    break
        stack.append(Element(tag, tuple(names[: NAMES + 1]), stack[-1] if stack else None))
        where.setdefault(tag, []).append(len(stack) - 1)
        if tag in BLOCKS:
            block_at.append(len(stack) - 1)
    close()
    return out


@memo(20_000)
def path_features(path: tuple[str, ...]) -> tuple[int, ...]:
    """Hashed names: each anywhere, the last block's tag, and pairs of the last names."""
    tags = [x for x in path if x in BLOCKS]
    last = tags[-2:]
    names = [f"a{x}" for x in dict.fromkeys(path)] + [f"l{tags[-1] if tags else ''}", f"p{'>'.join(last)}"]
    return tuple(crc32(x.encode("utf-8", "replace")) % PATHS for x in names)


def dense(found: list[tuple[tuple[str, ...], str, int, int]]) -> np.ndarray:
    n = len(found)
    rows = []
    for i, (_, text, linked, size) in enumerate(found):
        words = text.count(" ") + 1
        marks = text.count(".") + text.count(",") + text.count("!") + text.count("?")
        rows.append((np.log1p(size) / 6, np.log1p(words) / 5, min(1.0, linked / size), min(1.0, marks / words), text[-1] in ".!?:\"'", i / n, (n - i) / n, size < 25, "©" in text or "(c)" in text))
    return np.array(rows, dtype=np.float32).reshape(-1, DENSE)


class Sequences:
    """Blocks of several pages: features, and the layout of pages as columns sorted by length."""

    def __init__(self, pages: list[list[tuple[tuple[str, ...], str, int, int]]]):
        flat = [b for p in pages for b in p]
        self.starts = np.concatenate([[0], np.cumsum([len(p) for p in pages])]).astype(np.int64)
        lists = [path_features(b[0]) for b in flat]
        self.path_starts = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
        self.paths = np.array([y for x in lists for y in x], dtype=np.int64)
        codes, self.word_starts, words = encode([WORD.findall(b[1].lower()) for b in flat])
        ids = np.array([crc32(w.encode("utf-8", "replace")) % WORDS for w in words], dtype=np.int64)
        self.words = ids[codes] if len(codes) else codes
        self.dense = np.concatenate([dense(p) for p in pages if p]) if flat else np.zeros((0, DENSE), dtype=np.float32)
        length = np.diff(self.starts)
        self.pages = np.argsort(-length, kind="stable")
        self.length = length[self.pages]
        most = int(self.length[0]) if len(length) else 0
        self.active = np.searchsorted(-self.length, -np.arange(most), "left")
        at = np.arange(most)[:, None]
        first = self.starts[self.pages]
        self.forward = np.where(at < self.length, first + at, 0)
        self.backward = np.where(at < self.length, first + self.length - 1 - at, 0)

    def mean(self, table: np.ndarray, items: np.ndarray, starts: np.ndarray) -> np.ndarray:
        out = np.zeros((len(starts) - 1, table.shape[1]), dtype=np.float32)
        some = np.diff(starts) > 0
        if len(items):
            out[some] = np.add.reduceat(table[items], starts[:-1][some]) / np.diff(starts)[some, None]
        return out


def _sig(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


#: Blocks, and cells of the layout of pages as columns, that a run of pages holds (or one page); steps made at a time beyond.
CELLS, STEPS = 200_000, 4_096
#: Multiplications up to which BLAS stays in one thread; waiting threads would cost far more than these products.
SMALL = 1 << 18


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b by runs of rows."""
    step = max(1, SMALL // max(1, b.size))
    return a @ b if len(a) <= step else np.concatenate([a[i : i + step] @ b for i in range(0, len(a), step)])


def gram(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a.T @ b by runs of rows."""
    step = max(1, SMALL // max(1, a.shape[1] * b.shape[1]))
    out = a[:step].T @ b[:step]
    for i in range(step, len(a), step):
        out += a[i : i + step].T @ b[i : i + step]
    return out


class Labeller:
    def __init__(self, seed: int = 19):
        rng, wide = np.random.default_rng(seed), PATH_DIM + WORD_DIM + DENSE
        init = lambda *s: (rng.normal(size=s) / np.sqrt(s[0])).astype(np.float32)
        self.p = {"path": init(PATHS, PATH_DIM) * 10, "word": init(WORDS, WORD_DIM) * 5, "out": init(2 * HIDDEN + wide, 1)[:, 0], "bias": np.zeros(1, dtype=np.float32)}
        for d in "fb":
            self.p[f"x{d}"], self.p[f"h{d}"], self.p[f"b{d}"] = init(wide, 4 * HIDDEN), init(HIDDEN, 4 * HIDDEN), np.zeros(4 * HIDDEN, dtype=np.float32)
            self.p[f"b{d}"][HIDDEN : 2 * HIDDEN] = 1.0  # forget gates start open

    def inputs(self, s: Sequences) -> np.ndarray:
        return np.concatenate([s.mean(self.p["path"], s.paths, s.path_starts) * 2, s.mean(self.p["word"], s.words, s.word_starts), s.dense], 1)

    def scan(self, s: Sequences, x: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        """Hidden state at every block, of the LSTM that reads forward or backward."""
        where, n = s.forward if d == "f" else s.backward, len(s.pages)
        z = product(x, self.p[f"x{d}"]) + self.p[f"b{d}"]
        h, c, out, w = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32), np.zeros((len(x), HIDDEN), np.float32), self.p[f"h{d}"]
        for t, m in enumerate(s.active):
            at = where[t, :m]
            g = z[at] + product(h[:m], w)
            gates, new = _sig(g[:, : 3 * HIDDEN]), np.tanh(g[:, 3 * HIDDEN :])
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            before, was = c[:m].copy(), h[:m].copy()
            c[:m] = f * before + i * new
            squashed = np.tanh(c[:m])
            h[:m] = o * squashed
            out[at] = h[:m]
            if keep is not None:
                keep.append((at, i, f, o, new, before, squashed, was))
        return out

    def logits(self, s: Sequences) -> np.ndarray:
        if not len(s.dense):
            return np.zeros(0)
        x = self.inputs(s)
        hidden = [self.scan_one(x)] if len(s.pages) == 1 and len(x) > STEPS else [self.scan(s, x, "f"), self.scan(s, x, "b")]
        return np.concatenate([*hidden, x], 1) @ self.p["out"] + self.p["bias"]

    def scan_one(self, x: np.ndarray) -> np.ndarray:
        """Hidden states of one long page, both directions side by side; gate inputs are made for STEPS blocks at a time."""
        n, w = len(x), np.stack([self.p["hf"], self.p["hb"]])
        h, c, out = np.zeros((2, 1, HIDDEN), np.float32), np.zeros((2, 1, HIDDEN), np.float32), np.empty((n, 2 * HIDDEN), np.float32)
        with np.errstate(over="ignore"):
            for first in range(0, n, STEPS):
                last = min(n, first + STEPS)
                z = np.stack([product(x[first:last], self.p["xf"]) + self.p["bf"], product(x[n - last : n - first][::-1], self.p["xb"]) + self.p["bb"]], 1)[:, :, None]
                for t in range(last - first):
                    g = z[t] + np.matmul(h, w)
                    gates = 1 / (1 + np.exp(-g[..., : 3 * HIDDEN]))
                    c = gates[..., HIDDEN : 2 * HIDDEN] * c + gates[..., :HIDDEN] * np.tanh(g[..., 3 * HIDDEN :])
                    h = gates[..., 2 * HIDDEN :] * np.tanh(c)
                    out[first + t, :HIDDEN], out[n - 1 - first - t, HIDDEN:] = h[0, 0], h[1, 0]
        return out

    def gradients(self, s: Sequences, y: np.ndarray) -> dict[str, np.ndarray]:
        x, kept = self.inputs(s), {"f": [], "b": []}
        hidden = [self.scan(s, x, d, kept[d]) for d in "fb"]
        top = np.concatenate([*hidden, x], 1)
        off = (_sig(top @ self.p["out"] + self.p["bias"]) - y).astype(np.float32) / len(y)
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        g["out"], g["bias"] = top.T @ off, off.sum(keepdims=True)
        down = off[:, None] * self.p["out"]
        dx = down[:, 2 * HIDDEN :].copy()
        for j, d in enumerate("fb"):
            dh_of, w = down[:, j * HIDDEN : (j + 1) * HIDDEN], self.p[f"h{d}"]
            n = len(s.pages)
            dh, dc, dz = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32), np.zeros((len(x), 4 * HIDDEN), np.float32)
            for at, i, f, o, new, before, squashed, was in reversed(kept[d]):
                m = len(at)
                a = dh_of[at] + dh[:m]
                c = dc[:m] + a * o * (1 - squashed * squashed)
                grad = np.concatenate([c * new * i * (1 - i), c * before * f * (1 - f), a * squashed * o * (1 - o), c * i * (1 - new * new)], 1)
                dz[at] = grad
                g[f"h{d}"] += gram(was, grad)
                dh[:m], dc[:m] = product(grad, w.T), c * f
            g[f"x{d}"], g[f"b{d}"] = gram(x, dz), dz.sum(0)
            dx += product(dz, self.p[f"x{d}"].T)
        for name, cols, items, starts, scale in (("path", slice(0, PATH_DIM), s.paths, s.path_starts, 2.0), ("word", slice(PATH_DIM, PATH_DIM + WORD_DIM), s.words, s.word_starts, 1.0)):
            n = np.maximum(1, np.diff(starts))
            each = np.repeat(dx[:, cols] * scale / n[:, None], np.diff(starts), axis=0)
            for c in range(each.shape[1]):
                g[name][:, c] = np.bincount(items, each[:, c], len(g[name]))
        return g

    def fit(self, pages: list[tuple[list, np.ndarray]], epochs: int = EPOCHS, rate: float = 0.01, seed: int = 20) -> None:
        """Adam over shuffled batches."""
        rng, m, v, step = np.random.default_rng(seed), {}, {}, 0
        batches = []
        for i in range(0, len(pages), BATCH):
            own = pages[i : i + BATCH]
            batches.append((Sequences([b for b, _ in own]), np.concatenate([y for _, y in own])))
        for _ in range(epochs):
            for i in rng.permutation(len(batches)):
                step += 1
                for k, grad in self.gradients(*batches[i]).items():
                    m[k] = 0.9 * m.get(k, 0) + 0.1 * grad
                    v[k] = 0.99 * v.get(k, 0) + 0.01 * grad * grad
                    self.p[k] = (self.p[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)


class Layouts:
    """Pages in random layouts.  Main text is marked as it is written, so the labels are exact."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def word(self) -> str:
        return "".join(self.r.choice(["an", "er", "tion", "que", "sch", "os", "la", "th", "ble", "ei", "ou", "re", "mi"]) for _ in range(self.r.randint(1, 4)))

    def words(self, low: int, high: int) -> str:
        return " ".join(self.word() for _ in range(self.r.randint(low, high)))

    def sentence(self) -> str:
        text = self.words(4, 16).capitalize() + self.r.choice([".", ".", ".", "!", "?"])
        return text if self.r.random() > 0.12 else " ".join(w + self.r.choice(["&amp;&amp;", "***", "!!", "$$", "%%", " |"]) for w in text.split())

    def prose(self, low: int = 1, high: int = 7) -> str:
        text = " ".join(self.sentence() for _ in range(self.r.randint(low, high)))
        x = self.r.random()
        return text.upper() if x < 0.05 else text.replace(" ", f" <a href='/{self.word()}'>{self.word()}</a> ", 1) if x < 0.15 else text.replace(" ", " <em>x</em> ", 1) if x < 0.2 else text

    def pick(self, *options: str) -> str:
        return self.r.choice(options)

    def name(self, *options: str) -> str:
        return f'{self.pick("class", "class", "id")}="{self.pick("", "", "site-", "page-", "js-")}{self.pick(*options)}{self.pick("", "", "", " " + self.word(), "-" + self.word())}"'

    def article(self) -> str:
        mark = lambda text: f"\x01{text}"
        parts = []
        if self.r.random() < 0.85:
            h = self.pick("h1", "h1", "h1", "h2")
            title = self.words(2, 9).capitalize()
            parts.append(f"<{h}>{mark(title)}</{h}>" if self.r.random() < 0.75 else f"<header><{h}>{mark(title)}</{h}></header>")
        sloppy = self.r.random() < 0.3
        for _ in range(self.r.randint(1, 14) if self.r.random() < 0.9 else self.r.randint(15, 50)):
            x = self.r.random()
            if x < 0.72:
                text = mark(self.prose())
                lead = self.pick("", "", "", "<b>", "<br>")
                parts.append(f"<p>{lead}{text}" + ("<br>" if sloppy and self.r.random() < 0.5 else "</p>"))
            elif x < 0.78:
                parts.append(f"<{(h := self.pick('h2', 'h3', 'h4'))}>{mark(self.words(1, 7).capitalize())}</{h}>")
            elif x < 0.84:
                parts.append(f"<{(t := self.pick('ul', 'ol'))}>" + "".join(f"<li>{mark(self.prose(1, 2))}</li>" for _ in range(self.r.randint(2, 6))) + f"</{t}>")
            elif x < 0.88:
                parts.append(f"<blockquote>{self.pick('', '<p>')}{mark(self.prose(1, 3))}</blockquote>")
            elif x < 0.91:
                parts.append(f"<pre>{mark(self.words(3, 20))}</pre>")
            elif x < 0.94:
                parts.append("<table>" + "".join("<tr>" + "".join(f"<td>{mark(self.words(1, 4))}</td>" for _ in range(3)) + "</tr>" for _ in range(self.r.randint(1, 4))) + "</table>")
            elif x < 0.96:
                parts.append(f"<figure><img src='a.png'><figcaption>{mark(self.words(3, 10))}</figcaption></figure>")
            elif x < 0.98:
                parts.append(self.advert())
            else:
                parts.append(f"<div>{mark(self.prose(1, 3))}</div>")
        body = "\n".join(parts)
        wrap = self.r.random()
        if wrap < 0.5:
            return f"<article{self.pick('', ' ' + self.name('post', 'entry', 'article'))}>{body}</article>"
        if wrap < 0.65:
            return f"<main>{self.pick('', '<article>')}{body}</main>"
        if wrap < 0.9:
            return f"<div {self.name('content', 'main', 'post-body', 'entry-content', 'article-body', 'story', 'text', 'article')}>{body}</div>"
        return f"<div>{body}</div>"

    def links(self, low: int = 2, high: int = 9) -> str:
        style = self.r.random()
        each = [f'<a href="/{self.word()}">{self.words(1, 3).capitalize()}</a>' for _ in range(self.r.randint(low, high))]
        return "<ul>" + "".join(f"<li>{x}</li>" for x in each) + "</ul>" if style < 0.7 else " | ".join(each) if style < 0.85 else "".join(f"<div>{x}</div>" for x in each)

    def menu(self) -> str:
        return self.pick(f"<nav>{self.links()}</nav>", f"<nav {self.name('menu', 'navbar', 'nav')}>{self.links()}</nav>", f"<div {self.name('menu', 'nav', 'navigation', 'breadcrumb', 'topbar')}>{self.links()}</div>", f"<header><a href='/'>{self.word()}</a>{self.links()}</header>", f"<header><p>{self.words(1, 6)}</p><nav>{self.links()}</nav></header>")

    def advert(self) -> str:
        text = self.pick(self.prose(1, 2), self.words(2, 9), f"<a href='#'>{self.words(2, 6)}</a>")
        return f"<{(t := self.pick('div', 'div', 'aside', 'section'))} {self.name('ad', 'ad', 'ads', 'advert', 'advertisement', 'sponsored', 'promo', 'banner')}>{self.pick('', '<p>')}{text}</{t}>"

    def notice(self) -> str:
        cue = self.pick("We use cookies", "Cookie settings", "Accept all", "Subscribe to our newsletter", "This site uses cookies", "Sign in to continue", self.words(2, 8))
        return f"<{(t := self.pick('div', 'section', 'aside', 'dialog'))} {self.name('cookie', 'cookie-notice', 'notice', 'consent', 'gdpr', 'newsletter', 'popup', 'modal', 'alert', 'banner')}>{self.pick('', '<p>')}{cue} {self.prose(0, 2)}<button>{self.pick('Accept', 'OK', 'Close', self.word())}</button></{t}>"

    def form(self) -> str:
        return f"<form {self.pick('', self.name('search', 'login', 'subscribe', 'contact'))}><label>{self.words(1, 3)}</label><input name='q'>{self.pick('', '<p>' + self.prose(1, 2) + '</p>')}<button>{self.word()}</button></form>"

    def aside(self) -> str:
        inner = self.pick(f"<h3>{self.words(1, 3)}</h3>{self.links()}", f"<p>{self.prose(1, 3)}</p>", f"<h2>{self.words(1, 3)}</h2><p>{self.prose(1, 2)}</p>{self.links()}", self.links())
        return self.pick(f"<aside>{inner}</aside>", f"<aside {self.name('sidebar', 'related')}>{inner}</aside>", f"<div {self.name('sidebar', 'side', 'related', 'widget', 'recommended', 'more', 'share', 'social', 'author-bio', 'tags')}>{inner}</div>", f"<section {self.name('related', 'recommended', 'trending', 'widget')}>{inner}</section>")

    def comments(self) -> str:
        t, each = self.pick("div", "section", "section", "ol"), self.pick("div", "li", "p", "article")
        rows = "".join(f"<{each} {self.name('comment', 'reply', 'comment-body')}>{self.pick('', '<b>' + self.word() + '</b> ', '<span>' + self.word() + '</span>')}{self.pick('', '<p>')}{self.prose(1, 4)}</{each}>" for _ in range(self.r.randint(1, 8)))
        head = self.pick("", f"<h2>{self.pick('Comments', 'Replies', 'Discussion', self.word())}</h2>", f"<h3>{self.r.randint(1, 99)} comments</h3>")
        return f"<{t} {self.name('comments', 'comments', 'comment-list', 'discussion', 'replies', 'disqus', 'responses')}>{head}{rows}</{t}>"

    def footer(self) -> str:
        text = self.pick(f"&copy; {self.word()}.example &middot; {self.prose(1, 2)}", f"&copy; {self.r.randint(1999, 2030)} {self.words(1, 4)}", self.prose(1, 2), self.links())
        return self.pick(f"<footer>{text}</footer>", f"<footer>{text}</footer>", f"<footer>{self.links()}<p>{text}</p></footer>", f"<div {self.name('footer', 'copyright', 'legal', 'bottom')}>{self.pick('', '<p>')}{text}</div>")

    def page(self) -> tuple[str, bool]:
        top = [self.menu() if self.r.random() < 0.9 else ""]
        top += [f() for f, p in ((self.notice, 0.3), (self.advert, 0.4), (self.form, 0.2), (self.menu, 0.15), (self.aside, 0.2)) if self.r.random() < p]
        end = [f() for f, p in ((self.aside, 0.4), (self.advert, 0.3), (self.comments, 0.35), (self.form, 0.15), (self.notice, 0.2), (self.aside, 0.2)) if self.r.random() < p]
        if self.r.random() < 0.3:
            self.r.shuffle(top)
        end.append(self.footer() if self.r.random() < 0.9 else "")
        text = self.words(2, 8).capitalize()
        head = f"<!DOCTYPE html><html><head><meta charset='utf-8'><title>{text}</title><style>p{{margin:0}}</style><script>var t='</p>';</script></head>"
        wrap = self.pick(("", ""), ("<div id='wrap'>", "</div>"), ("<div class='container'><div class='row'>", "</div></div>"))
        main = "" if self.r.random() < 0.04 else self.article()
        body = f"{head}<body>{wrap[0]}{''.join(top)}<!-- x -->{main}{''.join(end)}{wrap[1]}</body></html>"
        return body if self.r.random() < 0.9 else body[: int(len(body) * self.r.uniform(0.7, 0.99))]

    def labelled(self) -> tuple[list, np.ndarray]:
        found = blocks(self.page())
        y = np.array(["\x01" in text for _, text, _, _ in found], dtype=np.float32)
        clean = [(path, t, linked, len(t)) for path, text, linked, _ in found for t in [text.replace("\x01", "") or "-"]]
        return clean, y


@lru_cache(1)
def trained() -> Labeller:
    """The labeller, trained once a process; its pages do not depend on any table."""
    layouts, model = Layouts(21), Labeller()
    pages = [p for p in (layouts.labelled() for _ in range(PAGES)) if p[0]]
    model.fit(pages)
    path_features.clear()  # else it would travel with every task
    return model


def runs_of(pages: list[list]) -> Iterator[tuple[int, int]]:
    """From-to of runs of pages whose layout has at most CELLS cells, or of one larger page."""
    first, most = 0, 0
    for i, own in enumerate(pages):
        if i > first and max(most, len(own)) * (i + 1 - first) > CELLS:
            yield first, i
            first, most = i, 0
        most = max(most, len(own))
    if first < len(pages):
        yield first, len(pages)


def main_texts(model: Labeller, pages: list[str | None]) -> tuple[list[str], list[int]]:
    """Main text of each page, and its number of blocks."""
    texts, counts = [""] * len(pages), [0] * len(pages)
    for first, run in slices(pages, 4_000_000):
        found = [blocks(p) for p in run]
        for a, b in runs_of(found):
            s = Sequences(found[a:b])
            main = model.logits(s) > 0
            for i in range(a, b):
                keep = main[s.starts[i - a] : s.starts[i - a + 1]]
                texts[first + i] = "\n\n".join(x[1] for x, k in zip(found[i], keep, strict=True) if k)
                counts[first + i] = len(found[i])
    return texts, counts


def extract(pages: DataFrame) -> DataFrame:
    """A row per row of ``pages``: page_id, url, text, n_chars, n_blocks.

    Null and blank html, and pages without main text, give an empty text.  Character references are decoded, white
    space inside a block is one space, blocks are joined by two line feeds in page order.  Rows with a null id or url
    are extracted like any other, repeated rows alike; other columns are not read.  A page is read in one pass, so
    very long ones, of any nesting and however broken, cost time and memory in proportion.  Blocks whose odds are even
    are left out.
    """
    shared = pages.sparkSession.sparkContext.broadcast(trained().p)

    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = Labeller()
        model.p = shared.value
        for htmls in batches:
            texts, counts = main_texts(model, htmls.tolist())
            yield pd.DataFrame({"text": texts, "n_chars": [len(t) for t in texts], "n_blocks": counts})

    udf = F.pandas_udf(judge, "text string, n_chars long, n_blocks int")
    return pages.select("page_id", "url", udf(F.col("html")).alias("x")).select("page_id", "url", "x.*")
