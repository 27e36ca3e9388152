"""Toxicity by a convolutional text classifier.

Words are hashed to two embedding rows each (so that a chance collision of one is outvoted by the other); filters one, two
and three words wide pass over the whole text, each filter's greatest response is kept, and a logistic layer turns these
into a score, which a held-back part of the training rows calibrates. For each language that part also gives the threshold
with the best F1; the language takes no part in the score.

Training begins, unless evidence=False, with each word's weight of evidence (log odds of its documents) as one of its
numbers, which half of the filters average at first; from there all weights are trained. A random start learns as well, but
from few labels less (README).

The model is trained in NumPy on about TRAIN_DOCS labelled rows, chosen by a hash of the id, fewer where texts are so long
that they would hold over TRAIN_WORDS words; their whole texts count. The model's size is fixed (about 8 MB).

Null and empty texts are scored as texts without words. Without labels of both classes every score is the share of toxic
labels (0 without labels). A doc_id that is labelled more than once is toxic if any label says so; null labels do not
count. Repeated documents are scored each for itself.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import as_bytes, bundle, pieces
from pairloom.llm.decontaminate import words_of

TRAIN_DOCS, TRAIN_WORDS = 12_000, 12_000_000
BITS, HALF, WIDTHS, FILTERS = 17, 8, (1, 2, 3), 12
#: Words that pass through the filters at once; a longer text goes in parts that overlap by what a filter spans.
PART = 100_000
PAD = max(WIDTHS) - 1
THRESHOLD = 0.3


def hashed(text: bytes) -> np.ndarray:
    words = words_of(text)
    return np.fromiter(map(zlib.crc32, words), np.uint32, len(words))


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Classifier:
    first: np.ndarray  # rows by the hash's low bits; the last row is padding
    second: np.ndarray  # rows by its high bits
    filters: list[np.ndarray]  # by width: (width, 2 * HALF, FILTERS)
    offsets: list[np.ndarray]
    weights: np.ndarray
    bias: float
    scale: float = 1.0
    shift: float = 0.0
    constant: float | None = None
    thresholds: dict[str, float] = field(default_factory=dict)

    def embed(self, words: np.ndarray) -> np.ndarray:
        """words: hashes as int64, -1 for padding."""
        last = len(self.first) - 1
        low, high = np.where(words < 0, last, words & (last - 1)), np.where(words < 0, last, words >> (32 - BITS))
        return np.concatenate([self.first[low], self.second[high]], axis=1)

    def responses(self, x: np.ndarray):
        for filters, offset in zip(self.filters, self.offsets, strict=True):
            n = len(x) - PAD
            out = x[:n] @ filters[0]
            for k in range(1, len(filters)):
                out += x[k : n + k] @ filters[k]
            yield out + offset

    def pooled(self, texts: list[np.ndarray]) -> np.ndarray:
        """Each filter's greatest response, at least 0, in each text."""
        parts, owner = [], []
        for i, words in enumerate(texts):
            for at in range(0, max(1, len(words) - PAD), PART):
                parts.append(words[at : at + PART + PAD])
                owner.append(i)
        out = np.zeros((len(texts), len(WIDTHS) * FILTERS), np.float32)
        at = 0
        while at < len(parts):
            end, n = at, 0
            while end < len(parts) and (end == at or n + len(parts[end]) <= PART):
                n += len(parts[end])
                end += 1
            x, starts, _ = stacked(parts[at:end])
            pooled = np.concatenate([np.maximum.reduceat(r, starts) for r in self.responses(self.embed(x))], axis=1)
            np.maximum.at(out, owner[at:end], pooled)
            at = end
        return out

    def score(self, texts: list[np.ndarray]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        return sigmoid((self.pooled(texts) @ self.weights + self.bias).astype(np.float64) * self.scale + self.shift)


def stacked(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts one after another, each with padding behind it, and once more at the end; starts and ends of their windows."""
    sizes = np.array([len(p) for p in parts]) + PAD
    ends = np.cumsum(sizes)
    out = np.full(ends[-1] + PAD, -1, np.int64)
    for p, start in zip(parts, ends - sizes, strict=True):
        out[start : start + len(p)] = p
    return out, ends - sizes, ends


#: Training documents in which a hashed word occurs at least, to have an embedding of its own in a random start.
SEEN = 4


def _start(texts: list[np.ndarray], toxic: np.ndarray, rng: np.random.Generator, evidence: bool) -> Classifier:
    """Small random rows; with evidence, the first number of each is the word's weight of evidence in the training texts, and half of the filters begin as its average."""
    rows = 1 << BITS
    tables = []
    for low in (True, False):
        seen = np.zeros((2, rows))
        for words, y in zip(texts, toxic, strict=True):
            seen[int(y)][np.unique(words & (rows - 1) if low else words >> (32 - BITS))] += 1
        table = rng.normal(0, 0.05 if evidence else 0.1, (rows + 1, HALF)).astype(np.float32)
        if evidence:
            share = (seen + 0.5) / (np.bincount(toxic, minlength=2)[:, None] + 1)
            weight = np.where(seen.sum(0) > 0, np.log(share[1] / share[0]), 0) * np.minimum(1, seen.sum(0) / 4)
            table[:rows, 0] = np.clip(weight, -3, 3) / 3
        else:
            table[:rows][seen.sum(0) < SEEN] = 0
        table[rows] = 0
        tables.append(table)
    n = len(WIDTHS) * FILTERS
    if not evidence:
        filters = [rng.normal(0, (w * 2 * HALF) ** -0.5, (w, 2 * HALF, FILTERS)).astype(np.float32) for w in WIDTHS]
        return Classifier(*tables, filters, [np.zeros(FILTERS, np.float32) for _ in WIDTHS], rng.normal(0, 0.3, n).astype(np.float32), -1.0)
    filters = [rng.normal(0, 0.15, (w, 2 * HALF, FILTERS)).astype(np.float32) for w in WIDTHS]
    for f in filters:
        f[:, [0, HALF], : FILTERS // 2] = 1.0 / len(f)
    return Classifier(*tables, filters, [np.full(FILTERS, -0.2, np.float32) for _ in WIDTHS], rng.normal(0, 0.1, n).astype(np.float32), -2.0)


class _Adam:
    def __init__(self, value, rate: float):
        self.rate, self.m, self.v, self.t = rate, np.zeros_like(value), np.zeros_like(value), 0

    def step(self, grad):
        self.t += 1
        self.m += 0.1 * (grad - self.m)
        self.v += 0.01 * (grad * grad - self.v)
        return self.rate * (self.m / (1 - 0.9**self.t)) / (np.sqrt(self.v / (1 - 0.99**self.t)) + 1e-8)


def fit(texts: list[np.ndarray], toxic: list[int], langs: list[str], epochs: int | None = None, batch: int = 32, seed: int = 7, evidence: bool = True) -> Classifier:
    """texts: hashes as int64. Every fifth row is held back for calibration. epochs: 4 from a start by evidence, 8 from a random one."""
    epochs = epochs or (4 if evidence else 8)
    toxic = np.asarray(toxic, np.int64)
    rng = np.random.default_rng(seed)
    model = _start(texts[:1], np.zeros(1, np.int64), rng, evidence) if texts else Classifier(np.zeros((1, 1)), np.zeros((1, 1)), [], [], np.zeros(0), 0.0)
    if len(set(toxic.tolist())) < 2:
        model.constant = float(toxic.mean()) if len(toxic) else 0.0
        return model
    order = rng.permutation(len(texts))
    back, train = order[::5], np.array([i for k, i in enumerate(order) if k % 5])
    if len(set(toxic[train].tolist())) < 2:
        train = back = order
    model = _start([texts[i] for i in train], toxic[train], rng, evidence)
    dense = [_Adam(x, 0.005) for x in (*model.filters, *model.offsets, model.weights)]
    bias = _Adam(np.zeros(1), 0.005)
    squares = [np.full(len(model.first), 1e-3, np.float32) for _ in range(2)]
    for _ in range(epochs):
        rng.shuffle(train)
        for at in range(0, len(train), batch):
            chosen = train[at : at + batch]
            x, starts, ends = stacked([texts[i] for i in chosen])
            vectors = model.embed(x)
            tops, peaks = [], []
            for r in model.responses(vectors):
                where = np.stack([np.argmax(r[a:b], axis=0) + a for a, b in zip(starts, ends, strict=True)])
                peaks.append(where)
                tops.append(np.maximum(np.take_along_axis(r, where, 0), 0))
            h = np.concatenate(tops, axis=1)
            error = ((sigmoid(h @ model.weights + model.bias) - toxic[chosen]) / len(chosen)).astype(np.float32)
            dh = error[:, None] * model.weights * (h > 0)
            grads_f, grads_o, rows, deltas = [], [], [], []
            for k, (f, where) in enumerate(zip(model.filters, peaks, strict=True)):
                d = dh[:, k * FILTERS : (k + 1) * FILTERS]
                g = np.zeros_like(f)
                for j in range(len(f)):
                    g[j] = np.einsum("bfe,bf->ef", vectors[where + j], d)
                    rows.append(x[where + j].ravel())
                    deltas.append((d[:, :, None] * f[j].T).reshape(-1, 2 * HALF))
                grads_f.append(g)
                grads_o.append(d.sum(0))
            for value, adam, grad in zip((*model.filters, *model.offsets, model.weights), dense, (*grads_f, *grads_o, h.T @ error + 1e-5 * model.weights), strict=True):
                value -= adam.step(grad).astype(np.float32)
            model.bias -= float(bias.step(np.array([error.sum()]))[0])
            words, delta = np.concatenate(rows), np.concatenate(deltas)
            real = words >= 0
            words, delta = words[real], delta[real]
            for table, square, row, part in ((model.first, squares[0], words & ((1 << BITS) - 1), delta[:, :HALF]), (model.second, squares[1], words >> (32 - BITS), delta[:, HALF:])):
                ids, inverse = np.unique(row, return_inverse=True)
                total = np.zeros((len(ids), HALF), np.float32)
                np.add.at(total, inverse, part)
                square[ids] += (total**2).mean(1)
                step = 0.05 * total / np.sqrt(square[ids])[:, None]
                table[ids] -= step if evidence else step * (table[ids] != 0)
    logits = model.pooled([texts[i] for i in back]) @ model.weights + model.bias
    model.scale, model.shift = _calibrated(logits.astype(np.float64), toxic[back])
    scores = sigmoid(logits * model.scale + model.shift)
    for lang in sorted({langs[i] for i in back}):
        mine = np.array([langs[i] == lang for i in back])
        model.thresholds[lang] = _threshold(scores[mine], toxic[back][mine])
    return model


def _calibrated(logits: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Scale and shift of least log loss, by Newton steps with a slight pull to scale 1 and shift 0."""
    design, theta = np.stack([logits, np.ones_like(logits)], 1), np.array([1.0, 0.0])
    for _ in range(30):
        p = sigmoid(design @ theta)
        grad = design.T @ (p - toxic) + 0.1 * (theta - [1.0, 0.0])
        theta = theta - np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + 0.1 * np.eye(2), grad)
    return (float(theta[0]), float(theta[1])) if np.isfinite(theta).all() and theta[0] > 0 else (1.0, 0.0)


def _threshold(scores: np.ndarray, toxic: np.ndarray) -> float:
    """The score from which F1 is best; the common threshold where a language has under ten toxic rows."""
    if toxic.sum() < 10:
        return THRESHOLD
    order = np.argsort(-scores, kind="stable")
    hits = np.cumsum(toxic[order])
    f1 = 2 * hits / (np.arange(1, len(order) + 1) + toxic.sum())
    k = int(np.argmax(f1))
    below = scores[order[k + 1]] if k + 1 < len(order) else 0.0
    return float((scores[order[k]] + below) / 2)


def learn(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS, train_words: int = TRAIN_WORDS, evidence: bool = True) -> Classifier:
    """docs: doc_id, text, lang. labels: doc_id, toxic. Only the sample's ids are broadcast and only its hashed words are collected."""
    marked = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    n = marked.count()
    if not n:
        return fit([], [], [])
    sample = lambda k: marked.where(F.pmod(F.xxhash64(F.lit("toxicity"), "doc_id"), F.lit(1 << 30)) < int(min(1.0, k / n) * (1 << 30)))
    chosen = docs.join(F.broadcast(sample(train_docs)), "doc_id").select("text", F.col("lang").cast("string").alias("lang"), "toxic", F.xxhash64("doc_id", "text").alias("place"))
    size = chosen.agg(F.sum(F.length(F.coalesce("text", F.lit("")))).alias("n")).first().n or 0
    if size > 5 * train_words:
        chosen = chosen.where(F.pmod(F.xxhash64(F.lit("fewer"), "place"), F.lit(1 << 30)) < int(5 * train_words / size * (1 << 30)))

    def run(batches):
        schema = pa.schema([("place", pa.int64()), ("lang", pa.string()), ("toxic", pa.int32()), ("words", pa.binary())])
        for piece in pieces(batches):
            words = [hashed(t).astype("<u4").tobytes() for t in as_bytes(piece.column("text"))]
            yield bundle(schema, piece.column("place"), piece.column("lang"), piece.column("toxic"), words)

    rows = sorted(chosen.mapInArrow(run, "place long, lang string, toxic int, words binary").collect(), key=lambda r: (r.place, bytes(r.words)))
    return fit([np.frombuffer(bytes(r.words), "<u4").astype(np.int64) for r in rows], [r.toxic for r in rows], [r.lang or "" for r in rows], evidence=evidence)


def score(docs: DataFrame, model: Classifier, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = None) -> DataFrame:
    """
    One row per document: id and score; with lang_col also threshold (the one of the document's language, the common one
    where none was calibrated) and flagged (score reaches it). The language does not enter the score.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    lang = F.col(lang_col).cast("string") if lang_col else F.lit(None).cast("string")

    def run(batches):
        for piece in pieces(batches):
            ids = piece.column("id")
            scores = model.score([hashed(t).astype(np.int64) for t in as_bytes(piece.column("text"))]).tolist()
            limits = [model.thresholds.get(x, THRESHOLD) for x in piece.column("lang").to_pylist()]
            schema = pa.schema([("id", ids.type), ("score", pa.float64()), ("threshold", pa.float64()), ("flagged", pa.bool_())])
            yield bundle(schema, ids, scores, limits, [s >= t for s, t in zip(scores, limits, strict=True)])

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), lang.alias("lang"))
    out = source.mapInArrow(run, f"id {kind}, score double, threshold double, flagged boolean").withColumnRenamed("id", id_col)
    return out if lang_col else out.select(id_col, "score")
