"""Main text of web pages by a recurrent block labeller.

A page becomes a sequence of leaf blocks: runs of text between block-level tags, each with the
path of tags, classes and ids above it. A bidirectional LSTM in numpy reads a vector of the hashed
path and of the hashed words of every block, and labels it as content or not, with the whole page
as context. The content blocks, in page order, are the text.

The network is trained here on a bounded sample of pages (`SAMPLE_PAGES`), with a fixed seed.
Pages say themselves what their article is where they use the tags for it: blocks under `article`
or `main`, and not under a part that is named as something else, are content. So that the names of
parts that the sample happens not to have are known as well, each training page is varied: parts
named from `ASIDE` with blocks of other pages are put around and into its article, and the article's
own tag is renamed from `MAIN`.

Where fewer than `LEAST_MARKED` sampled pages mark their article, pages are composed as well, each from
some blocks of a given page as its article; the parts around it come from the variation. So something
is learned whenever the table has a block at all.

Of a training page the first `TRAIN_CHARS` characters are read, so that the sample is bounded in bytes;
extraction reads whole pages.

Defined results: a null or empty page and one without blocks has an empty text. Titles of pages, scripts, styles and templates are no blocks, nor is
anything else hidden. A head ends with its tag, or with the first tag or text that cannot stand in it.
Unclosed and unknown tags are taken as they come, a tag that the page ends in is dropped. White space is
what Unicode calls so. Repeated pages give a row each.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.llm.common import picked
from gleanery.llm.pieces import _slices

#: Bound of the training sample, and the longest training sequence.
SAMPLE_PAGES = 240
LEAST_MARKED = 60
TRAIN_CHARS = 40_000
#: Bytes of pages that are labelled together.
TOGETHER = 1 << 23
TRAIN_BLOCKS = 48
HIDDEN = 12
STEPS = 300
BATCH = 32
RATE = 0.02
#: Cells (pages times blocks) that are labelled together.
CELLS = 1 << 15

PATH_DIM, WORD_DIM, PLAIN_DIM = 96, 32, 4

# Tags that HTML defines as phrasing, void or invisible.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark math mi mn mo mrow ms msub msup mtext q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN_TAGS = frozenset("script style template title".split())
HEAD_TAGS = HIDDEN_TAGS | frozenset("base basefont bgsound link meta noframes noscript".split())
CLOSES_ITSELF = frozenset("p li dt dd tr td th option".split())
# Names under which pages keep their article, and other parts.
MAIN = ("article", "main", "div.content", "div.article", "div.post", "section.entry", "div.main", "div.story")
ASIDE = (
    "nav", "header", "footer", "aside", "form", "div.ad", "div.ads", "div.advert", "div.banner", "div.promo", "div.sponsored", "div.menu",
    "ul.menu", "div.navigation", "div.breadcrumb", "div.sidebar", "div.widget", "div.related", "div.cookie", "div.notice", "div.consent",
    "div.popup", "div.newsletter", "div.subscribe", "div.share", "div.social", "div.footer", "div.header", "div.copyright", "div.comments",
    "section.comments", "div.comment", "ol.comments", "div.replies", "div.login", "div.search", "div.tags", "div.legal",
)
_ASIDE_WORDS = frozenset(w for name in ASIDE for w in name.split(".") if w not in ("div", "section", "ul", "ol"))
_OPEN_END = re.compile(r"<[A-Za-z/!?][^<>]*\Z")


@dataclass
class Block:
    text: str
    path: tuple[str, ...]
    linked: int = 0  # characters inside links


class _Blocks(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, tuple[str, ...], bool]] = []  # tag, its names, whether it hides text
        self.found: list[Block] = []
        self.parts: list[str] = []
        self.hidden = self.links = self.linked = 0

    def end_head(self) -> None:
        """An open head ends before what cannot stand in it."""
        if self.stack and not self.hidden:
            at = next((i for i, (tag, _, _) in enumerate(self.stack) if tag == "head"), None)
            if at is not None:
                del self.stack[at:]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag not in HEAD_TAGS:
            self.end_head()
        if tag == "a":
            self.links += 1
        if tag in INLINE:
            return
        self.flush()
        if tag in VOID:
            return
        if tag in CLOSES_ITSELF and self.stack and self.stack[-1][0] == tag:
            self.stack.pop()
        if tag == "body":
            self.hidden = 0
            self.stack = [(t, names, False) for t, names, _ in self.stack]
        hides = tag in HIDDEN_TAGS and not (tag == "title" and any(t == "svg" for t, _, _ in self.stack))
        self.hidden += hides
        names = [w for k, v in attrs if k in ("class", "id", "role") and v for w in re.split(r"[^a-z]+", v.lower()) if w]
        self.stack.append((tag, (tag, *names), hides))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag not in INLINE:
            self.flush()

    def handle_endtag(self, tag: str) -> None:
        if tag == "a":
            self.links = max(0, self.links - 1)
        if tag in INLINE:
            return
        self.flush()
        at = next((i for i in range(len(self.stack) - 1, -1, -1) if self.stack[i][0] == tag), None)
        if at is not None:
            self.hidden -= sum(hides for _, _, hides in self.stack[at:])
            del self.stack[at:]

    def handle_data(self, data: str) -> None:
        if not self.hidden:
            if not data.isspace():
                self.end_head()
            self.parts.append(data)
            self.linked += len(data) if self.links else 0

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            path = tuple(w for _, names, _ in self.stack for w in names if w not in ("html", "body"))
            self.found.append(Block(text, path, self.linked))
        self.parts, self.linked = [], 0


def blocks(html: str | None) -> list[Block]:
    """The leaf blocks of a page, in page order."""
    if not html:
        return []
    parser = _Blocks()
    parser.feed(_OPEN_END.sub("", html))
    parser.close()
    parser.flush()
    return parser.found


def _slot(word: str, size: int, seed: int) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass"), seed) % size


def vectors(page: list[Block]) -> np.ndarray:
    """One row per block: hashed path, hashed words, length, links, digits, place."""
    out = np.zeros((len(page), PATH_DIM + WORD_DIM + PLAIN_DIM), np.float32)
    for i, b in enumerate(page):
        for w in set(b.path):
            out[i, _slot(w, PATH_DIM, 1)] = 1
            out[i, _slot(w, PATH_DIM, 2)] = 1
        words = b.text.lower().split()
        out[i, PATH_DIM : PATH_DIM + WORD_DIM] = np.bincount([_slot(w, WORD_DIM, 3) for w in words], minlength=WORD_DIM) / (1 + len(words))
        out[i, -4:] = np.log1p(len(b.text)) / 8, b.linked / len(b.text), sum(map(str.isdigit, b.text)) / len(b.text), i / len(page)
    return out


class Lstm:
    """One direction; gates in the order input, forget, output, proposal."""

    def __init__(self, w: np.ndarray, u: np.ndarray, b: np.ndarray, c: np.ndarray) -> None:
        self.w, self.u, self.b, self.c = w, u, b, c  # (d, 4h), (h, 4h), (4h,), (h,)

    @classmethod
    def random(cls, rng: np.random.Generator, inputs: int, hidden: int) -> Lstm:
        bias = np.zeros(4 * hidden)
        bias[hidden : 2 * hidden] = 1
        return cls(rng.normal(0, 0.2, (inputs, 4 * hidden)), rng.normal(0, 0.3, (hidden, 4 * hidden)), bias, rng.normal(0, 0.3, hidden))

    def run(self, x: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, list[tuple]]:
        """Scores (t, n) from inputs (t, n, d), and what going back needs. States stay put outside."""
        length, n, _ = x.shape
        hidden = len(self.c)
        h = s = np.zeros((n, hidden), x.dtype)
        parts, scores, trace = x @ self.w + self.b, np.empty((length, n), x.dtype), []
        for t in range(length):
            z = parts[t] + h @ self.u
            gates = 0.5 + 0.5 * np.tanh(0.5 * z[:, : 3 * hidden])
            i, f, o = (gates[:, k * hidden : (k + 1) * hidden] for k in range(3))
            g = np.tanh(z[:, 3 * hidden :])
            on = inside[t][:, None]
            s_new = f * s + i * g
            squashed = np.tanh(s_new)
            trace.append((h, s, i, f, o, g, squashed, on))
            h, s = np.where(on, o * squashed, h), np.where(on, s_new, s)
            scores[t] = h @ self.c
            trace[-1] += (h,)
        return scores, trace

    def back(self, x: np.ndarray, trace: list[tuple], d_score: np.ndarray) -> dict[str, np.ndarray]:
        grads = {k: np.zeros_like(getattr(self, k)) for k in ("w", "u", "b", "c")}
        dh, ds = np.zeros_like(trace[0][0]), np.zeros_like(trace[0][0])
        for t in range(len(trace) - 1, -1, -1):
            h, s, i, f, o, g, squashed, on, after = trace[t]
            grads["c"] += after.T @ d_score[t]
            dh = dh + d_score[t][:, None] * self.c
            d_new = np.where(on, dh, 0)
            d_cell = np.where(on, ds, 0) + d_new * o * (1 - squashed**2)
            dz = np.concatenate([d_cell * g * i * (1 - i), d_cell * s * f * (1 - f), d_new * squashed * o * (1 - o), d_cell * i * (1 - g * g)], 1)
            grads["w"] += x[t].T @ dz
            grads["u"] += h.T @ dz
            grads["b"] += dz.sum(0)
            dh = np.where(on, 0, dh) + dz @ self.u.T
            ds = np.where(on, d_cell * f, ds)
        return grads


class Labeller:
    """Both directions; a block is content if its logit is above 0."""

    def __init__(self, sides: tuple[Lstm, Lstm], bias: np.ndarray) -> None:
        self.sides, self.bias = sides, bias

    @classmethod
    def random(cls, hidden: int = HIDDEN, seed: int = 0) -> Labeller:
        rng = np.random.default_rng(seed)
        inputs = PATH_DIM + WORD_DIM + PLAIN_DIM
        return cls((Lstm.random(rng, inputs, hidden), Lstm.random(rng, inputs, hidden)), np.zeros(1))

    def plain(self) -> dict[str, np.ndarray]:
        return {f"{i}{k}": getattr(side, k) for i, side in enumerate(self.sides) for k in ("w", "u", "b", "c")} | {"bias": self.bias}

    @classmethod
    def of(cls, plain: dict[str, np.ndarray]) -> Labeller:
        p = {k: v.astype(np.float32) for k, v in plain.items()}
        return cls(tuple(Lstm(*[p[f"{i}{k}"] for k in ("w", "u", "b", "c")]) for i in range(2)), p["bias"])

    def logits(self, x: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, tuple]:
        ahead, trace = self.sides[0].run(x, inside)
        behind, trace2 = self.sides[1].run(x[::-1], inside[::-1])
        return ahead + behind[::-1] + self.bias, (trace, trace2)

    def loss(self, x: np.ndarray, inside: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        z, (trace, trace2) = self.logits(x, inside)
        n = inside.sum()
        loss = (np.logaddexp(0, z) - y * z)[inside].sum() / n
        d = np.where(inside, 0.5 + 0.5 * np.tanh(z / 2) - y, 0) / n
        grads = {f"0{k}": v for k, v in self.sides[0].back(x, trace, d).items()}
        grads |= {f"1{k}": v for k, v in self.sides[1].back(x[::-1], trace2, d[::-1]).items()}
        return loss, grads | {"bias": np.array([d.sum()])}

    def label(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """For each page, which blocks are content; pages of like length go together."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = sorted((i for i, p in enumerate(pages) if len(p)), key=lambda i: len(pages[i]))
        while order:
            count = 1
            while count < len(order) and (count + 1) * len(pages[order[count]]) <= CELLS:
                count += 1
            part, order = order[:count], order[count:]
            x, inside = _padded([pages[i] for i in part])
            z, _ = self.logits(x, inside)
            for k, i in enumerate(part):
                out[i] = z[: len(pages[i]), k] > 0
        return out


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    length = max(map(len, pages))
    x = np.zeros((length, len(pages), pages[0].shape[1]), pages[0].dtype)
    inside = np.zeros((length, len(pages)), bool)
    for i, p in enumerate(pages):
        x[: len(p), i] = p
        inside[: len(p), i] = True
    return x, inside


def own_labels(page: list[Block]) -> list[bool]:
    """What the page's own tags say."""
    return [bool({"article", "main"} & set(b.path)) and not _ASIDE_WORDS & set(b.path) for b in page]


def _varied(page: list[Block], other: list[Block], rng: np.random.Generator) -> tuple[list[Block], list[bool]]:
    """The page with its article under another name and with other parts around and inside it."""
    labels = own_labels(page)
    name = MAIN[rng.integers(len(MAIN))].split(".")
    out = [(Block(b.text, tuple(w for x in b.path for w in (name if x in ("article", "main") else (x,))), b.linked), y) for b, y in zip(page, labels, strict=True)]
    for _ in range(rng.integers(0, 5)):
        path = tuple(ASIDE[rng.integers(len(ASIDE))].split("."))
        at = int(rng.integers(len(out) + 1))
        inner = out[min(at, len(out) - 1)][0].path[: len(name)] if out and rng.random() < 0.4 else ()
        for _ in range(rng.integers(1, 4)):
            b = other[rng.integers(len(other))]
            words = b.text.split()
            text = " ".join(words[: int(rng.integers(1, len(words) + 1))])
            out.insert(at, (Block(text, inner + path + (("p",) if rng.random() < 0.5 else ()), len(text) if rng.random() < 0.3 else 0), False))
    begin = int(rng.integers(0, max(1, len(out) - TRAIN_BLOCKS + 1)))
    out = out[begin : begin + TRAIN_BLOCKS]
    return [b for b, _ in out], [y for _, y in out]


def train(pages: list[list[Block]], steps: int = STEPS, seed: int = 0) -> Labeller:
    """Adam on varied pages; the same input gives the same network."""
    rng = np.random.default_rng(seed)
    net = Labeller.random(seed=seed)
    params = net.plain()
    mean, square = ({k: np.zeros_like(v) for k, v in params.items()} for _ in range(2))
    varied = [_varied(pages[i % len(pages)], pages[rng.integers(len(pages))], rng) for i in range(3 * len(pages))]
    data = [(vectors(b), np.array(y, float)) for b, y in varied if b]
    for i in range(1, steps + 1):
        part = [data[k] for k in rng.integers(len(data), size=BATCH)]
        x, inside = _padded([v for v, _ in part])
        y = np.zeros(inside.shape)
        for k, (_, own) in enumerate(part):
            y[: len(own), k] = own
        _, grads = net.loss(x.astype(float), inside, y)
        norm = max(1, np.sqrt(sum((g * g).sum() for g in grads.values())))
        rate = RATE * min(1, 2 * (1 - i / (steps + 1)))
        for k, g in grads.items():
            mean[k] = 0.9 * mean[k] + 0.1 * g / norm
            square[k] = 0.99 * square[k] + 0.01 * (g / norm) ** 2
            params[k] -= rate * mean[k] / (1 - 0.9**i) / (np.sqrt(square[k] / (1 - 0.99**i)) + 1e-8)
    return net


def composed(page: list[Block], rng: np.random.Generator) -> list[Block]:
    """A page with some blocks of the given one as its article."""
    some = rng.permutation(len(page))[: int(rng.integers(1, 7))]
    return [Block(page[i].text, ("article", "h1" if n == 0 and rng.random() < 0.5 else "p"), 0) for n, i in enumerate(some)]


def fit(pages: DataFrame, html: str = "html", most: int = SAMPLE_PAGES) -> dict[str, np.ndarray]:
    """Weights from `most` distinct pages that mark their article, or all there are, and from composed ones.

    Empty if no page has a block.
    """
    parsed = [b for page in sample(pages, html, most) if any(own_labels(b := blocks(page)))]
    if len(parsed) < LEAST_MARKED:
        rng = np.random.default_rng(1)
        plain = [b for page in sample(pages, html, most, F.col("html") != "") if (b := blocks(page))]
        parsed += [composed(plain[i % len(plain)], rng) for i in range(most - len(parsed))] if plain else []
    return train(parsed).plain() if parsed else {}


def sample(pages: DataFrame, html: str = "html", most: int = SAMPLE_PAGES, good: Column | None = None) -> list[str]:
    """`most` distinct pages that are good (that have a tag for the article), or all there are, by the hash of the page.

    Their number is estimated first, and about four times the wanted share of them is looked at; if too
    few come, again with a larger share.
    """
    marked = picked(pages, html=html).where(F.col("html").rlike(r"(?i)<(article|main)[\s/>]") if good is None else good)
    h = F.xxhash64("html")
    share = min(1.0, (4 * most + 50) / max(1, marked.agg(F.approx_count_distinct(h)).first()[0]))
    while True:
        some = marked.where(F.shiftrightunsigned(h, 11) * F.lit(2.0**-53) < share)
        found = some.select(h.alias("h"), F.substring("html", 1, TRAIN_CHARS).alias("html")).groupBy("h").agg(F.min("html").alias("html")).orderBy("h").limit(most).collect()
        if len(found) == most or share == 1:
            return [r["html"] for r in found]
        share = min(1.0, 8 * share)


def extract(pages: DataFrame, weights: dict[str, np.ndarray], key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per page: its main text and the number of its code points."""
    rows = picked(pages, page_id=key, url=url, html=html)
    shared = rows.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Labeller.of(shared.value) if shared.value else None
        for batch in batches:
            sizes = pc.binary_length(batch.column(2)).fill_null(0).to_pylist()
            for a, b in _slices(sizes, TOGETHER):
                part = batch.slice(a, b - a)
                parsed = [blocks(x.as_py()) for x in part.column(2)]
                labels = net.label([vectors(p) for p in parsed]) if net else [np.zeros(len(p), bool) for p in parsed]
                texts = [" ".join([b.text for b, y in zip(p, own, strict=True) if y]) for p, own in zip(parsed, labels, strict=True)]
                columns = [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("page_id", "url")}
    return rows.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")


def report(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    return extract(pages, fit(pages, html), key, url, html)
