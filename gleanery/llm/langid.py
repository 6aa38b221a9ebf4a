"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads UTF-8 bytes in both directions and labels every position; the mean of the
position probabilities is the document's. It is trained here, in numpy, by backpropagation
through time, on a bounded sample of labelled excerpts (`SAMPLE_TEXTS` distinct texts per language,
`EXCERPT` characters of each), with a fixed seed. Prediction reads whole texts, cut into
stretches of `STRETCH` bytes that advance together.

Defined results: a text that is null or has no letter is `und` with score 0, as is every text
if nothing could be learned; languages are all values of the label column that have a text with a
letter among the rows not held out; repeated rows get equal results; a null key counts as held out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from gleanery.llm.common import free, picked
from gleanery.llm.pieces import _slices

UNKNOWN = "und"
#: Bound of the training sample: texts per language, characters of each.
SAMPLE_TEXTS = 150
EXCERPT = 512
HIDDEN = 8
WINDOW = 64
STEPS = 400
BATCH = 128
RATE = 0.02
#: Bytes that a stretch has when predicting, and stretches that advance together.
STRETCH = 128
TOGETHER = 4096
#: Bytes of texts that are read together; a longer text stands alone.
TEXT = 1 << 24


class Direction:
    """Gated recurrent unit; `x` holds the input part of all three gates for each byte."""

    NAMES = ("x", "u", "c")

    def __init__(self, x: np.ndarray, u: np.ndarray, c: np.ndarray) -> None:
        self.x, self.u, self.c = x, u, c  # (256, 3h), (h, 3h), (h, classes)

    @classmethod
    def random(cls, rng: np.random.Generator, hidden: int, classes: int) -> Direction:
        u = np.concatenate([np.linalg.qr(rng.normal(size=(hidden, hidden)))[0] for _ in range(3)], 1)
        return cls(rng.normal(0, 0.3, (256, 3 * hidden)), u * 0.7, rng.normal(0, 0.3, (hidden, classes)))

    def step(self, h: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, ...]:
        """Next state, with update gate, reset gate, proposal and recurrent part."""
        n = h.shape[1]
        x, part = self.x[codes], h @ self.u
        gates = np.tanh((x[:, : 2 * n] + part[:, : 2 * n]) * 0.5) * 0.5 + 0.5
        z, r, rest = gates[:, :n], gates[:, n:], part[:, 2 * n :]
        new = np.tanh(x[:, 2 * n :] + r * rest)
        return new + z * (h - new), z, r, new, rest

    def back(self, codes: np.ndarray, trace: list[tuple], d_out: list[np.ndarray]) -> dict[str, np.ndarray]:
        """Gradients through time; trace has (state before, z, r, proposal, recurrent part, state)."""
        grads = {"x": np.zeros_like(self.x), "u": np.zeros_like(self.u), "c": np.zeros_like(self.c)}
        dh = np.zeros_like(trace[0][0])
        for t in range(len(trace) - 1, -1, -1):
            before, z, r, new, rest, state = trace[t]
            grads["c"] += state.T @ d_out[t]
            dh = dh + d_out[t] @ self.c.T
            d_new = dh * (1 - z) * (1 - new * new)
            d_z = dh * (before - new) * z * (1 - z)
            d_r = d_new * rest * r * (1 - r)
            d_part = np.concatenate([d_z, d_r, d_new * r], 1)
            np.add.at(grads["x"], codes[:, t], np.concatenate([d_z, d_r, d_new], 1))
            grads["u"] += before.T @ d_part
            dh = dh * z + d_part @ self.u.T
        return grads


class Network:
    """Two directions and a softmax over their states at every position."""

    def __init__(self, forward: Direction, backward: Direction, bias: np.ndarray) -> None:
        self.forward, self.backward, self.bias = forward, backward, bias

    @classmethod
    def random(cls, classes: int, hidden: int = HIDDEN, seed: int = 0) -> Network:
        rng = np.random.default_rng(seed)
        return cls(Direction.random(rng, hidden, classes), Direction.random(rng, hidden, classes), np.zeros(classes))

    @classmethod
    def of(cls, plain: dict[str, np.ndarray]) -> Network:
        sides = [Direction(*[plain[f"{side}_{name}"].astype(np.float32) for name in Direction.NAMES]) for side in ("forward", "backward")]
        return cls(*sides, plain["bias"].astype(np.float32))

    def plain(self) -> dict[str, np.ndarray]:
        out = {f"{side}_{name}": getattr(getattr(self, side), name) for side in ("forward", "backward") for name in Direction.NAMES}
        return out | {"bias": self.bias}

    def loss(self, codes: np.ndarray, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross entropy of all positions, and its gradients."""
        length, size = codes.shape[1], len(codes)
        traces, logits = {}, np.tile(self.bias, (length, size, 1))
        for name, order in (("forward", range(length)), ("backward", range(length - 1, -1, -1))):
            side: Direction = getattr(self, name)
            h, trace = np.zeros((size, side.u.shape[0])), []
            for t in order:
                after, *gates = side.step(h, codes[:, t])
                trace.append((h, *gates, after))
                logits[t] += after @ side.c
                h = after
            traces[name] = trace
        p = _softmax(logits)
        rows = np.arange(size)
        loss = -np.log(p[:, rows, labels] + 1e-12).mean()
        p[:, rows, labels] -= 1
        p /= length * size
        grads = {"bias": p.sum((0, 1))}
        for name, flip in (("forward", 1), ("backward", -1)):
            found = getattr(self, name).back(codes[:, ::flip], traces[name], list(p[::flip]))
            grads |= {f"{name}_{k}": v for k, v in found.items()}
        return loss, grads

    def probabilities(self, codes: np.ndarray, inside: np.ndarray) -> np.ndarray:
        """Sums over the positions inside of the class probabilities, by row."""
        size, length = codes.shape
        columns = np.ascontiguousarray(codes.T)
        logits = np.empty((length, size, len(self.bias)), np.float32)
        h = np.zeros((size, self.forward.u.shape[0]), np.float32)
        for t in range(length):
            h = self.forward.step(h, columns[t])[0]
            np.matmul(h, self.forward.c, out=logits[t])
        full = inside.all(0)
        h = np.zeros((size, self.backward.u.shape[0]), np.float32)
        total = np.zeros((size, len(self.bias)))
        for t in range(length - 1, -1, -1):
            h = self.backward.step(h, columns[t])[0]
            if not full[t]:
                h *= inside[:, t, None]
            p = _softmax(logits[t] + h @ self.backward.c + self.bias)
            total += p if full[t] else p * inside[:, t, None]
        return total


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def train(texts: list[str], labels: list[int], classes: int, steps: int = STEPS, seed: int = 0) -> Network:
    """Adam on random batches of windows; the same input gives the same network."""
    windows, owners = [], []
    for text, label in zip(texts, labels, strict=True):
        raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        for i in range(0, max(1, len(raw) - WINDOW + 1), WINDOW):
            windows.append(np.resize(raw[i : i + WINDOW], WINDOW))
            owners.append(label)
    codes, owners = np.array(windows), np.array(owners)
    weight = 1 / np.bincount(owners, minlength=classes)[owners]
    rng = np.random.default_rng(seed)
    net = Network.random(classes, seed=seed)
    params = net.plain()
    mean, square = ({k: np.zeros_like(v) for k, v in params.items()} for _ in range(2))
    for i in range(1, steps + 1):
        take = rng.choice(len(codes), BATCH, p=weight / weight.sum())
        _, grads = net.loss(codes[take], owners[take])
        norm = np.sqrt(sum((g * g).sum() for g in grads.values()))
        rate = RATE * min(1, 2 * (1 - i / (steps + 1)))
        for k, g in grads.items():
            g = g / max(1, norm)
            mean[k] = 0.9 * mean[k] + 0.1 * g
            square[k] = 0.99 * square[k] + 0.01 * g * g
            params[k] -= rate * mean[k] / (1 - 0.9**i) / (np.sqrt(square[k] / (1 - 0.99**i)) + 1e-8)
    return net


def held_out(key: Column, folds: int = 5) -> Column:
    """One fold by the checksum of the key takes no part in training."""
    return F.coalesce(F.crc32(key.cast("string")), F.lit(0)) % folds == 0


def sample(docs: DataFrame, texts: int = SAMPLE_TEXTS, excerpt: int = EXCERPT, hold_out: bool = True) -> list[tuple[str, str]]:
    """(language, excerpt) of `texts` distinct texts per language, or all there are, by the hash of the text.

    `docs` has doc_id, text and lang. The number of distinct texts with a letter is estimated by language
    first; then only about twice the wanted share of texts is looked at, whatever the size of the
    corpus and however often texts are repeated. Languages of which too few come are drawn again
    with a larger share, until there are enough or all have been looked at.
    """
    taken = ~held_out(F.col("doc_id")) if hold_out else F.lit(True)
    known = docs.where(taken & F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("text").rlike(r"\p{L}"))
    h = F.xxhash64("text")
    counts = known.groupBy("lang").agg(F.approx_count_distinct(h).alias("n")).collect()
    shares = {r["lang"]: min(1.0, (2 * texts + 50) / max(1, r["n"])) for r in counts}
    chance = F.shiftrightunsigned(h, 11) * F.lit(2.0**-53)
    start = F.pmod(h, F.greatest(F.length("text") - excerpt, F.lit(0)) + 1).cast("int") + 1
    out: dict[str, list[str]] = {}
    while shares:
        share = F.element_at(F.create_map(*[F.lit(x) for pair in shares.items() for x in pair]), F.col("lang"))
        some = known.where(F.col("lang").isin(list(shares)) & (chance < share))
        cut = some.select("lang", h.alias("h"), F.substring("text", start, F.lit(excerpt)).alias("part"))
        cut = cut.groupBy("lang", "h").agg(F.min("part").alias("part"))
        ranked = cut.withColumn("at", F.row_number().over(Window.partitionBy("lang").orderBy("h")))
        drawn = dict.fromkeys(shares)
        for r in ranked.where(F.col("at") <= texts).orderBy("lang", "at").collect():
            drawn[r["lang"]] = [*(drawn[r["lang"]] or []), r["part"]]
        out |= {lang: parts or [] for lang, parts in drawn.items()}
        shares = {lang: min(1.0, 8 * s) for lang, s in shares.items() if s < 1 and len(out[lang]) < texts}
    return [(lang, part) for lang in sorted(out) for part in out[lang]]


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", hold_out: bool = True) -> tuple[list[str], dict[str, np.ndarray]]:
    """Languages and weights, learned from the rows that are not held out."""
    found = sample(picked(docs, doc_id=key, text=text, lang=lang), hold_out=hold_out)
    names = sorted({name for name, _ in found})
    if not names:
        return [], {}
    net = train([part for _, part in found], [names.index(name) for name, _ in found], len(names))
    return names, net.plain()


def _stretches(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, length and owner of every stretch of the joined texts."""
    sizes = np.array([len(r) for r in raw], np.int64)
    counts = -(-sizes // STRETCH)
    owner = np.repeat(np.arange(len(raw)), counts)
    at = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    first = np.repeat(np.cumsum(sizes) - sizes, counts) + at * STRETCH
    return first, np.minimum(STRETCH, sizes[owner] - at * STRETCH), owner


def predict_texts(texts: list[str | None], names: list[str], net: Network | None) -> tuple[list[str], list[float]]:
    raw = [t.encode("utf-8", "surrogatepass") if t is not None and any(map(str.isalpha, t)) else b"" for t in texts]
    if net is None:
        return [UNKNOWN] * len(texts), [0.0] * len(texts)
    joined = np.frombuffer(b"".join(raw), np.uint8)
    first, length, owner = _stretches(raw)
    total = np.zeros((len(raw), len(names)))
    for i in range(0, len(first), TOGETHER):
        part = slice(i, i + TOGETHER)
        inside = np.arange(STRETCH) < length[part, None]
        codes = joined[np.where(inside, first[part, None] + np.arange(STRETCH), 0)]
        np.add.at(total, owner[part], net.probabilities(codes, inside))
    sizes = np.array([max(1, len(r)) for r in raw])
    mean = total / sizes[:, None]
    best = mean.argmax(1)
    score = np.clip(mean[np.arange(len(raw)), best], 0, 1)
    return [names[b] if r else UNKNOWN for b, r in zip(best, raw, strict=True)], score.tolist()


def predict(df: DataFrame, model: tuple[list[str], dict[str, np.ndarray]], text: str = "text", into: tuple[str, str] = ("_lang", "_score")) -> DataFrame:
    """All columns, language and score; whole texts are read. `into` names no given column."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    columns = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, weights = shared.value
        net = Network.of(weights) if names else None
        for batch in batches:
            sizes = pc.binary_length(batch.column(columns.index(text))).fill_null(0).to_pylist()
            for a, b in _slices(sizes, TEXT):
                part = batch.slice(a, b - a)
                lang, score = predict_texts(part.column(columns.index(text)).to_pylist(), names, net)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64())], [*columns, *into])

    more = [T.StructField(into[0], T.StringType()), T.StructField(into[1], T.DoubleType())]
    return df.mapInArrow(run, T.StructType([*df.schema.fields, *more]))


def report(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per document: whether it was held out, predicted language and score."""
    model = fit(docs, key, text, lang)
    found = predict(picked(docs, doc_id=key, text=text), model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("_lang").alias("lang_pred"), F.col("_score").alias("score"))


def keep_known(docs: DataFrame, model: tuple[list[str], dict[str, np.ndarray]], wanted: list[str] | None = None, least: float = 0.0, text: str = "text") -> DataFrame:
    """Drop documents without language, of languages not wanted, or below the least score."""
    lang, score = free(docs, "_lang"), free(docs, "_score")
    found = predict(docs, model, text, (lang, score)).where((F.col(lang) != UNKNOWN) & (F.col(score) >= least))
    if wanted is not None:
        found = found.where(F.col(lang).isin(wanted))
    return found.drop(lang, score)
