"""Main text of HTML pages: a bidirectional LSTM labels the blocks of a page.

A page becomes its sequence of leaf blocks, each with its tag path (tags,
classes and ids) and its text.  A block's input is the mean of hashed vectors of
its inner path, a mean over its whole path with learnt weights, the mean of
hashed word vectors and a few figures; an LSTM reads the sequence in both
directions, so every decision sees the whole page.  No block of the tables is
labelled, so the network learns from a bounded sample of pages labelled by the
meaning of their markup (``article`` against ``nav`` and so on).  Blocks of the
usual page furniture are planted in them, the naming of the main part is varied,
and copies are nested deeply in layout elements, so that it also learns forms
rare in the sample.
"""

from __future__ import annotations

import html
import random
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm.batches import hashed_sample, spread
from gristmill.llm.registry import query

TRAIN_PAGES = 400         # pages in the training sample
TRAIN_CHARS = 200_000     # longer pages are not sampled
PATH_ROWS, PATH_SIZE = 2048, 16
WORD_ROWS, WORD_SIZE = 1024, 8
INNER = 12                # innermost path tokens, which also have a plain mean
WHOLE = 256               # tokens of a path that is kept as it is
WORD_CHARS = 1 << 14      # of a block that are split into words at a time
FIGURES = 4
NOISE = "\0"              # begins names that stand for any unknown name in training
HIDDEN = 16
EPOCHS, STEPS = 10, 250   # passes over the sample, and batches seen at least
GROUP = 32                # pages in one numpy batch
STEP_CELLS = 20_000       # padded blocks in one numpy batch when labelling
READ_STEPS = 1 << 12      # steps whose inputs are multiplied at once

RAW = re.compile(r"<(script|style|template|textarea|title)(?=[\s/>])", re.I)
RAW_END = {name: re.compile(rf"</{name}\s*>", re.I)
           for name in ("script", "style", "template", "textarea", "title")}
TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
# Text, or a tag that ends before another begins; no part of it is tried twice.
PLAIN = re.compile(r"[^<]++|<(/?)([a-zA-Z][^\s/<>\"']*+)(?=[\s/>])"
                   r"((?:[^<>\"']++|\"[^\"<]*+\"|'[^'<]*+')*+)>")
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
INLINE = frozenset("a abbr b bdi bdo big cite code del dfn em font i ins kbd label mark q s samp "
                   "small span strike strong sub sup time tt u var wbr img".split())
EMBEDDED = frozenset("svg object iframe".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ENDS_P = frozenset("address article aside blockquote center details dialog div dl fieldset "
                   "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p "
                   "pre section table ul".split())
FURNITURE = frozenset("nav header footer aside form head ad ads advert advertisement sponsor promo "
                      "banner sidebar menu breadcrumb breadcrumbs comment comments replies cookie "
                      "notice popup newsletter subscribe share social related widget "
                      "button select".split())
MAIN = frozenset("article main content post entry story".split())


class _TagEnds:
    """Where the tag that begins at a place ends: at the first ``>`` outside quotes.

    Found for all places at once from the end of the page, so open quotes cost
    nothing more: a quote leads to what follows the next one like it.
    """

    def __init__(self, page: str):
        self.places = [m.start() for m in re.finditer("[>\"']", page)]
        self.ends, following = [0] * len(self.places), {}
        for k in range(len(self.places) - 1, -1, -1):
            mark = page[self.places[k]]
            if mark == ">":
                self.ends[k] = self.places[k]
                continue
            other, following[mark] = following.get(mark), k
            if other is None:
                self.ends[k] = -1       # a quote that never closes
            else:
                self.ends[k] = self.ends[other + 1] if other + 1 < len(self.places) else len(page)
        self.size = len(page)

    def after(self, place: int) -> int:
        """Place of the ``>``, the page's length without one, -1 for a quote left open."""
        k = bisect_left(self.places, place)
        return self.ends[k] if k < len(self.places) else self.size


def tokens(page: str) -> Iterator[tuple[str, str, str, str]]:
    """``(kind, name, attributes, text)``: ``text``, ``open`` and ``close`` tags, in order.

    Comments, declarations and raw elements are passed over.  A ``<`` that begins
    no tag, or one whose quotes are left open, is text.  Linear in the page.
    """
    ends, at = None, 0
    while at < len(page):
        if plain := PLAIN.match(page, at):
            closes, name, attributes = plain.groups()
            at = plain.end()
            if name is None:
                yield "text", "", "", plain[0]
                continue
            name = name.lower()
            if name not in RAW_END or closes or attributes.endswith("/"):
                yield ("close" if closes else "open"), name, attributes, ""
                continue
            found = RAW_END[name].search(page, at)
            at = found.end() if found else len(page)
            continue
        closing = next((end for begin, end in (("<!--", "-->"), ("<![CDATA[", "]]>"))
                        if page[at:at + len(begin)].upper() == begin), None)
        if closing is None and page[at + 1:at + 2] in ("!", "?") and at + 1 < len(page):
            closing = ">"
        if closing:
            found = page.find(closing, at + (4 if closing == "-->" else 2))
            at = len(page) if found < 0 else found + len(closing)
            continue
        tag, ends = TAG.match(page, at), ends or _TagEnds(page)
        end = ends.after(tag.end()) if tag else -1
        if end < 0:
            yield "text", "", "", "<"
            at += 1
            continue
        raw = RAW.match(page, at)
        if raw and end < len(page) and page[end - 1] != "/":
            found = RAW_END[raw[1].lower()].search(page, end + 1)
            at = found.end() if found else len(page)
            continue
        yield ("close" if tag[1] else "open"), tag[2].lower(), page[tag.end():end], ""
        at = end + 1


class _Path:
    """Open elements of a page, innermost last."""

    def __init__(self):
        self.open: list[tuple[str, tuple[str, ...]]] = []
        self.size = 0                                   # tokens of the whole path
        self.at: dict[str, list[int]] = {}              # places of each tag's open elements
        self.held: dict = {}                            # places of each row's tokens
        self.rows: dict[str, str | int] = {}

    def _row(self, token: str):
        """Tokens that a block's input tells apart; names with a meaning stay by themselves."""
        found = self.rows.get(token)
        if found is None:
            found = self.rows[token] = token if token in FURNITURE or token in MAIN else (
                zlib.crc32(token.encode()) % PATH_ROWS)
        return found

    def push(self, tag: str, names: tuple[str, ...]) -> None:
        self.at.setdefault(tag, []).append(len(self.open))
        self.open.append((tag, names))
        for token in (tag, *names):
            self.held.setdefault(self._row(token), []).append((self.size, token))
            self.size += 1

    def last(self, *tags: str) -> int:
        """Place of the innermost of these tags, -1 if none is open."""
        return max((self.at[tag][-1] for tag in tags if self.at.get(tag)), default=-1)

    def cut(self, place: int) -> None:
        while len(self.open) > place:
            tag, names = self.open.pop()
            self.at[tag].pop()
            for token in (*reversed(names), tag):
                row = self._row(token)
                self.held[row].pop()
                if not self.held[row]:
                    del self.held[row]
                self.size -= 1

    def tokens(self) -> tuple[str, ...]:
        """The whole path; of a very deep one the last token of each row, in order, and then
        the ``INNER`` innermost: what reads a path takes the set of its tokens, that of its
        innermost ones, and the last with a meaning."""
        if self.size <= WHOLE:
            return tuple(t for tag, names in self.open for t in (tag, *names))
        inner: list[str] = []
        for tag, names in reversed(self.open):
            if len(inner) >= INNER:
                break
            inner[:0] = (tag, *names)
        return (*(places[-1][1] for places in sorted(
            self.held.values(), key=lambda places: places[-1][0])), *inner[-INNER:])


def blocks(page: str) -> Iterator[tuple[tuple[str, ...], str, float]]:
    """``(path, text, share of linked characters)`` of every leaf block, in order.

    Only scripts, styles, templates, text areas and titles are dropped.  Inline
    tags don't part a block.  A button or a selection ends at the next part of
    the page at the latest.  Character references are decoded, white
    space becomes one space.  Unclosed and stray tags are borne; a page that
    breaks off ends its last block there.  Time and memory are linear in the
    page: a path has a bounded number of tokens.
    """
    path, parts, linked = _Path(), [], 0

    def flush():
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split())
        share = linked / max(1, sum(map(len, parts)))
        parts.clear()
        linked = 0
        if text:
            yield path.tokens(), text, min(1.0, share)

    for kind, tag, attributes, text in tokens(page):
        if kind == "text":
            if any(t == "a" for t, _ in path.open[-3:]):
                linked += len(text)
            parts.append(text)
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if kind == "close":
            if tag not in INLINE:
                yield from flush()
            if (place := path.last(tag)) >= 0:
                path.cut(place)
            continue
        if tag not in INLINE and not (tag in EMBEDDED and attributes.endswith("/")):
            yield from flush()
        if tag in ENDS_P:
            for open_tag in ("p", "button", "select"):
                if (place := path.last(open_tag)) >= 0:
                    path.cut(place)
        elif tag in ("li", "td", "th", "tr", "dd", "dt", "option"):
            place = path.last(tag, "ul", "ol", "table", "dl")
            if place >= 0 and path.open[place][0] == tag:
                path.cut(place)
        if tag in VOID or attributes.endswith("/") and tag not in ("p", "div", "a"):
            continue
        path.push(tag, tuple(part.lower() for found in _NAMED.findall(attributes)
                             for part in re.split(r"[\s_-]+", "".join(found)) if part))
    yield from flush()


class Inputs:
    """Hashed path tokens, hashed words and figures of a batch of block sequences."""

    def __init__(self, pages: list[list[tuple[tuple[str, ...], str, float]]]):
        self.length = np.array([len(p) for p in pages])
        flat = [b for p in pages for b in p]
        known: dict = {}
        crc = zlib.crc32

        def rows(path):
            found = known.get(path)
            if found is None:
                found = known[path] = [-1 if t[:1] == NOISE else crc(t.encode()) % PATH_ROWS
                                       for t in {"", *path}]
            return found

        def cells(text):
            """Rows of all words, and how often each occurs."""
            if len(text) <= WORD_CHARS:
                found = [crc(w.encode()) % WORD_ROWS for w in text.lower().split()]
                return found, [1] * len(found)
            counts, at = np.zeros(WORD_ROWS, np.int64), 0
            while at < len(text):
                end = text.find(" ", at + WORD_CHARS)
                end = len(text) if end < 0 else end
                counts += np.bincount([crc(w.encode()) % WORD_ROWS
                                       for w in text[at:end].lower().split()],
                                      minlength=WORD_ROWS)
                at = end + 1
            found = np.flatnonzero(counts)
            return found.tolist(), counts[found].tolist()

        # Every block has a path token (the empty one) and a word.
        inner = [rows(p[-INNER:]) for p, _, _ in flat]
        whole = [rows(p) for p, _, _ in flat]
        words = [cells(t) for _, t, _ in flat]
        self.path_n, self.whole_n, self.word_n = (
            np.array(list(map(len, x))) for x in (inner, whole, [w for w, _ in words]))
        self.path, self.whole, self.word = (
            np.array([x for r in each for x in r], np.int64)
            for each in (inner, whole, [w for w, _ in words]))
        self.noise = [(x, np.flatnonzero(x < 0)) for x in (self.path, self.whole)]
        self.redraw(np.random.default_rng(len(flat)))
        self.path_at, self.whole_at, self.word_at = (
            np.cumsum(n) - n for n in (self.path_n, self.whole_n, self.word_n))
        # Weight of each entry in the vector of its block.
        often = np.array([x for _, n in words for x in n], float)
        self.path_w = np.repeat(1 / self.path_n, self.path_n)[:, None]
        self.word_w = (often / np.repeat(np.add.reduceat(often, self.word_at),
                                         self.word_n))[:, None]
        size = np.array([len(t) for _, t, _ in flat], float)
        self.figures = np.stack([np.log1p(size) / 6, np.array([s for _, _, s in flat]),
                                 np.array([t[-1] in ".!?" for _, t, _ in flat], float),
                                 np.ones(len(flat))], 1)
        # Place of each block in the padded (step, page) grid.
        steps = int(self.length.max())
        self.page = np.repeat(np.arange(len(pages)), self.length)
        self.step = np.arange(len(flat)) - np.repeat(np.cumsum(self.length) - self.length,
                                                     self.length)
        self.mask = np.zeros((steps, len(pages), 1))
        self.mask[self.step, self.page] = 1


    def redraw(self, draw: np.random.Generator) -> None:
        """Other rows for the names that stand for any unknown name."""
        for rows, at in self.noise:
            rows[at] = draw.integers(0, PATH_ROWS, len(at))


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class BlockLabeller:
    """Bidirectional LSTM over the blocks of a page, one probability per block."""

    def __init__(self, seed: int = 7):
        draw = np.random.default_rng(seed)
        size = 2 * PATH_SIZE + WORD_SIZE + FIGURES

        def table(*shape):
            return draw.normal(0, 0.3 / np.sqrt(shape[0] if len(shape) > 1 and shape[0] < 200 else 1),
                               shape)

        self.p = {"path": table(PATH_ROWS, PATH_SIZE), "whole": table(PATH_ROWS, PATH_SIZE),
                  "weight": np.zeros(PATH_ROWS), "word": table(WORD_ROWS, WORD_SIZE)}
        for way in ("f", "b"):
            self.p["x" + way] = draw.normal(0, 1 / np.sqrt(size), (size, 4 * HIDDEN))
            self.p["h" + way] = draw.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 4 * HIDDEN))
            bias = np.zeros(4 * HIDDEN)
            bias[HIDDEN:2 * HIDDEN] = 1      # remember by default
            self.p["c" + way] = bias
        self.p["out"] = draw.normal(0, 0.2, (2 * HIDDEN + size, 1))
        self.p["bias"] = np.zeros(1)

    def _weights(self, batch: Inputs) -> np.ndarray:
        """Softmax over the path of each block, so that depth does not hide a telling name."""
        raw = self.p["weight"][batch.whole]
        raw = np.exp(raw - np.repeat(np.maximum.reduceat(raw, batch.whole_at), batch.whole_n))
        return (raw / np.repeat(np.add.reduceat(raw, batch.whole_at), batch.whole_n))[:, None]

    def _embed(self, batch: Inputs) -> np.ndarray:
        return np.concatenate([
            np.add.reduceat(self.p["path"][batch.path] * batch.path_w, batch.path_at),
            np.add.reduceat(self.p["whole"][batch.whole] * self._weights(batch), batch.whole_at),
            np.add.reduceat(self.p["word"][batch.word] * batch.word_w, batch.word_at),
            batch.figures], 1)

    def _read(self, x: np.ndarray, mask: np.ndarray, way: str, learn: bool):
        steps, pages, _ = x.shape
        order = range(steps) if way == "f" else range(steps - 1, -1, -1)
        parts: dict[int, np.ndarray] = {}       # one stretch of steps at a time
        h, c = np.zeros((pages, HIDDEN)), np.zeros((pages, HIDDEN))
        out, trace = np.zeros((steps, pages, HIDDEN)), {}
        for t in order:
            part, at = divmod(t, READ_STEPS)
            if part not in parts:
                parts = {part: x[part * READ_STEPS:(part + 1) * READ_STEPS] @ self.p["x" + way]
                         + self.p["c" + way]}
            z = parts[part][at] + h @ self.p["h" + way]
            i, f, o = (_sigmoid(z[:, k * HIDDEN:(k + 1) * HIDDEN]) for k in range(3))
            g = np.tanh(z[:, 3 * HIDDEN:])
            new = f * c + i * g
            tanh = np.tanh(new)
            if learn:
                trace[t] = (h, c, i, f, o, g, tanh)
            m = mask[t]     # padding keeps the state
            h, c = m * o * tanh + (1 - m) * h, m * new + (1 - m) * c
            out[t] = h
        return out, trace

    def forward(self, batch: Inputs, learn: bool = False):
        flat = self._embed(batch)
        x = np.zeros((*batch.mask.shape[:2], flat.shape[1]))
        x[batch.step, batch.page] = flat
        del flat
        ahead, trace_f = self._read(x, batch.mask, "f", learn)
        back, trace_b = self._read(x, batch.mask, "b", learn)
        joined = np.concatenate([ahead, back, x], 2)[batch.step, batch.page]
        return _sigmoid(joined @ self.p["out"] + self.p["bias"])[:, 0], (
            x, joined, trace_f, trace_b)

    def gradients(self, batch: Inputs, labels: np.ndarray) -> tuple[float, dict]:
        """Mean cross-entropy and its gradients, back through both readings."""
        found, (x, joined, *traces) = self.forward(batch, learn=True)
        n = len(labels)
        loss = -np.mean(np.log(np.where(labels > 0, found, 1 - found) + 1e-12))
        top = ((found - labels) / n)[:, None]
        grads = {"out": joined.T @ top, "bias": top.sum(0)}
        below = top @ self.p["out"].T
        steps, pages, size = x.shape
        dx = np.zeros((steps, pages, size))
        dx[batch.step, batch.page] = below[:, 2 * HIDDEN:]
        for way, trace, part in (("f", traces[0], slice(0, HIDDEN)),
                                 ("b", traces[1], slice(HIDDEN, 2 * HIDDEN))):
            dh_out = np.zeros((steps, pages, HIDDEN))
            dh_out[batch.step, batch.page] = below[:, part]
            dh, dc = np.zeros((pages, HIDDEN)), np.zeros((pages, HIDDEN))
            dz_all = np.zeros((steps, pages, 4 * HIDDEN))
            dw = np.zeros_like(self.p["h" + way])
            for t in range(steps - 1, -1, -1) if way == "f" else range(steps):
                h, c, i, f, o, g, tanh = trace[t]
                m = batch.mask[t]
                dh = dh + dh_out[t]
                live, dcell = m * dh, m * dc
                dcell = dcell + live * o * (1 - tanh ** 2)
                dz = np.concatenate([dcell * g * i * (1 - i), dcell * c * f * (1 - f),
                                     live * tanh * o * (1 - o), dcell * i * (1 - g ** 2)], 1)
                dz_all[t] = dz
                dw += h.T @ dz
                dh = (1 - m) * dh + dz @ self.p["h" + way].T
                dc = (1 - m) * dc + dcell * f
            grads["h" + way] = dw
            grads["x" + way] = np.einsum("tps,tpz->sz", x, dz_all)
            grads["c" + way] = dz_all.sum((0, 1))
            dx += dz_all @ self.p["x" + way].T
        flat = dx[batch.step, batch.page]
        at, soft = 0, self._weights(batch)
        for name, width, weight in (("path", PATH_SIZE, batch.path_w), ("whole", PATH_SIZE, soft),
                                    ("word", WORD_SIZE, batch.word_w)):
            rows, n = getattr(batch, name), getattr(batch, name + "_n")
            grads[name] = np.zeros_like(self.p[name])
            np.add.at(grads[name], rows, np.repeat(flat[:, at:at + width], n, 0) * weight)
            at += width
        pull = soft[:, 0] * (self.p["whole"][batch.whole] * np.repeat(
            flat[:, PATH_SIZE:2 * PATH_SIZE], batch.whole_n, 0)).sum(1)
        pull -= soft[:, 0] * np.repeat(np.add.reduceat(pull, batch.whole_at), batch.whole_n)
        grads["weight"] = np.bincount(batch.whole, pull, PATH_ROWS)
        return float(loss), grads

    def fit(self, pages: list, labels: list[np.ndarray], epochs: int = EPOCHS,
            rate: float = 0.02, seed: int = 7) -> None:
        """Adam over batches of pages of similar length."""
        order = sorted(range(len(pages)), key=lambda i: len(pages[i]))
        groups = [order[i:i + GROUP] for i in range(0, len(order), GROUP)]
        ready = [(Inputs([pages[i] for i in g]), np.concatenate([labels[i] for i in g]))
                 for g in groups]
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        draw, step, unknown = random.Random(seed), 0, np.random.default_rng(seed)
        for _ in range(max(epochs, -(-STEPS // len(ready)))):
            draw.shuffle(ready)
            for batch, wanted in ready:
                step += 1
                batch.redraw(unknown)
                _, grads = self.gradients(batch, wanted)
                for k, g in grads.items():
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.99 * second[k] + 0.01 * g * g
                    self.p[k] -= rate * (first[k] / (1 - 0.9 ** step)) / (
                        np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-8)

    def label(self, pages: list) -> list[np.ndarray]:
        """Probability that each block belongs to the main text."""
        out: list = [np.empty(0)] * len(pages)
        order = sorted((i for i in range(len(pages)) if pages[i]), key=lambda i: len(pages[i]))
        at = 0
        while at < len(order):
            size = max(1, min(256, STEP_CELLS // len(pages[order[at]])))
            while size > 1 and (at + size > len(order) or size * len(
                    pages[order[at + size - 1]]) > 2 * STEP_CELLS):
                size -= 1
            group = order[at:at + size]
            found, _ = self.forward(Inputs([pages[i] for i in group]))
            for i, part in zip(group, np.split(found, np.cumsum(
                    [len(pages[i]) for i in group])[:-1]), strict=True):
                out[i] = part
            at += size
        return out


def weak_label(path: tuple[str, ...]) -> bool:
    """Main text by the meaning of its markup: the innermost telling name decides."""
    for token in reversed(path):
        if token in FURNITURE:
            return False
        if token in MAIN:
            return True
    return False


_PLANTED = (
    ("aside", "aside"), ("div.sidebar", "div"), ("header", "header"), ("footer", "footer"),
    ("div.comments", "div"), ("section#comments", "section"), ("div.cookie-notice", "div"),
    ("form", "form"), ("div.advert", "div"), ("div.related", "div"), ("div.newsletter", "div"),
    ("ul.menu", "ul"), ("div.share", "div"), ("div.breadcrumbs", "div"), ("div.comment", "div"),
    ("div.notice", "div"), ("div.banner", "div"), ("div.promo", "div"), ("div.ad", "div"))
_MAIN_FORMS = ("article", "main", "div.content", "div#content", "div.post", "div.entry-content",
               "section.story", "article.post")


_LAYOUT = (("div", "container"), ("div", "row"), ("div", "col", "md", "4"), ("div", "wrapper"),
           ("div", "inner"), ("div",), ("section",), ("ul", "list", "unstyled"), ("li",), ("b",),
           ("span",), ("font",), ("table",), ("tr",), ("td",), ("center",), ("em",))


def nested(sequence: list, draw: random.Random) -> list:
    """The same blocks with layout elements between their telling ancestor and the rest."""
    chains: dict = {}

    def chain():
        return tuple(x for _ in range(draw.randint(1, 14)) for x in (
            draw.choice(_LAYOUT) if draw.random() < 0.3 else
            tuple(f"{NOISE}{draw.randrange(10_000)}" for _ in range(draw.randint(1, 3)))))

    out = []
    for path, text, share in sequence:
        at = next((i + 1 for i in range(len(path) - 1, -1, -1)
                   if path[i] in FURNITURE or path[i] in MAIN), min(2, len(path)))
        if path[:at] not in chains or draw.random() < 0.1:
            chains[path[:at]] = chain()
        out.append((path[:at] + chains[path[:at]] + path[at:], text, share))
    return out


def varied(pages: list[list], seed: int = 11) -> tuple[list[list], list[np.ndarray]]:
    """Training sequences: the pages as they are, copies with planted furniture, nested copies."""
    draw, deep = random.Random(seed), random.Random(seed + 1)
    texts = [t for p in pages for _, t, _ in p if len(t) > 20] or ["text"]

    def tokens(form: str) -> tuple[str, ...]:
        return tuple(x for x in re.split(r"[.#-]", form) if x)

    sequences, labels = [], []
    for page in pages:
        sequences.append(page)
        labels.append(np.array([weak_label(p) for p, _, _ in page], float))
        main = tokens(draw.choice(_MAIN_FORMS))
        copy, marks = [], []

        def plant(inside: tuple[str, ...], copy=copy, marks=marks):
            path = inside + tokens(draw.choice(_PLANTED)[0])
            for _ in range(draw.randint(1, 4)):
                inner = draw.choice(((), ("p",), ("li", "a"), ("h3",), ("a",), ("p", "a")))
                copy.append((path + inner, draw.choice(texts)[:draw.randint(8, 400)].strip() or "x",
                             1.0 if "a" in inner else 0.0))
                marks.append(0.0)

        for path, text, share in page:
            keep = weak_label(path)
            if draw.random() < 0.12:
                plant(("html", "body") + (main if draw.random() < 0.5 else ()))
            if keep:
                at = next(i for i, t in enumerate(path) if t in MAIN)
                inner = draw.choice((path[at + 1:], path[at + 1:], ("p",), ("h2",), ("ul", "li"),
                                     ("blockquote", "p"), ("div", "p"), ("section", "p")))
                path = path[:at] + main + inner
            copy.append((path, text, share))
            marks.append(float(keep))
        plant(("html", "body"))
        sequences += [copy, nested(copy, deep)]
        labels += [np.array(marks), np.array(marks)]
    return sequences, labels


def train(pages: DataFrame, key: str = "page_id", text: str = "html") -> BlockLabeller:
    """Fit on at most ``TRAIN_PAGES`` pages, picked by a hash of their id."""
    used = pages.filter(F.length(text).between(1, TRAIN_CHARS)).select(
        F.col(key).alias("k"), F.col(text).alias("t"))
    picked = hashed_sample(used.select("k").distinct(), "k", TRAIN_PAGES)
    sample = used.join(F.broadcast(picked), "k").dropDuplicates(["k"])
    sequences = [s for r in sorted(sample.collect()) if (s := list(blocks(r["t"])))]
    model = BlockLabeller()
    if sequences:
        model.fit(*varied(sequences))
    return model


def extract(pages: DataFrame, model: BlockLabeller, key: str = "page_id", text: str = "html",
            out: str = "text") -> DataFrame:
    """Add ``out`` and ``n_chars``: blocks of the main part, in order, joined by a space.

    Null and empty pages, and pages without main text, give an empty text.
    Repeated rows stay; other columns are kept except those of the two names.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model)
    rest = [c for c in pages.columns if c not in (text, out, "n_chars")]
    given = spread(pages.select(*rest, F.col(text).cast("string").alias("_html")))
    schema = given.drop("_html").schema.add(out, "string").add("n_chars", "long")

    def run(batches):
        own = shared.value
        for batch in batches:
            columns = {c: batch.column(c) for c in rest}
            raw = batch.column("_html").to_pylist()
            results, at = [], 0
            while at < len(raw):      # bounded groups, so long pages don't pile up
                end, size = at, 0
                while end < len(raw) and (end == at or size + len(raw[end] or "") < 1 << 22):
                    size += len(raw[end] or "")
                    end += 1
                sequences = [list(blocks(t)) if t else [] for t in raw[at:end]]
                for sequence, found in zip(sequences, own.label(sequences), strict=True):
                    results.append(" ".join(
                        b[1] for b, p in zip(sequence, found, strict=True) if p >= 0.5))
                at = end
            columns[out] = pa.array(results, pa.string())
            columns["n_chars"] = pa.array([len(t) for t in results], pa.int64())
            yield pa.RecordBatch.from_pydict(columns)

    return given.mapInArrow(run, schema)


@query("op4_html_main_text")
def op4(table):
    """Main text of every page."""
    pages = table("pages").select("page_id", "url", "html")
    return extract(pages, train(pages))
