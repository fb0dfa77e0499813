"""Quality classifier: random-indexing word vectors, pooled, then a small network.

Every word and every word shape (its letters, digits and marks reduced to
runs) falls in one of ``ROWS`` rows. A row has a fixed sparse random index
vector; its context vector is the sum of the index vectors seen next to it
over the whole corpus. A document is the mean of its words' and shapes'
context vectors and a few figures on how its index vectors repeat. A network
with one hidden layer, fitted on a bounded sample of labelled rows, scores it,
and a temperature fitted on held-back sample rows calibrates the score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Remembered, add_columns, kept_in_worker, split_remainder, summarise, unused

ROWS = 4096       # rows of the word-vector table
SHAPES = 512      # the first rows are shapes, the others words
DIMENSIONS = 32
NONZERO = 6       # of an index vector
REACH = 2         # neighbours to either side
SAMPLE = 8000     # labelled rows the network is fitted on, at most
HIDDEN = 24
THRESHOLD = 0.3

def index_vectors() -> np.ndarray:
    """Fixed sparse vectors of +1 and -1, one for each row."""
    rng = np.random.default_rng(20)
    out = np.zeros((ROWS, DIMENSIONS), np.float32)
    for row in out:
        row[rng.choice(DIMENSIONS, NONZERO, replace=False)] = rng.choice([-1.0, 1.0], NONZERO)
    return out


_MARKS = ".,;:!?*#%&$|"


def shape_of(chunk: str) -> str:
    """``Thre***`` is ``Aa*``, ``ERHE!!`` is ``A!``: runs of kinds of characters, each once."""
    core = chunk.rstrip(_MARKS)
    tail = chunk[len(core):]
    if core.isascii() and core.isalpha() and tail == tail[:1] * len(tail):  # most words
        known = "a" if core.islower() else "A" if core.isupper() else "Aa" if core.istitle() else ""
        if known:
            return known + tail[:1]
    out = []
    for c in chunk:
        kind = ("A" if c.isupper() else "a") if c.isalpha() else "0" if c.isdigit() else c
        if not out or out[-1] != kind:
            out.append(kind)
    return "".join(out)


class Reader:
    """Rows of a text's words and shapes."""

    def __init__(self):
        def row_of(chunk):
            word = chunk.strip(".,;:!?()\"'").lower()
            return (SHAPES + xxhash.xxh32_intdigest(word) % (ROWS - SHAPES)) * SHAPES \
                + xxhash.xxh32_intdigest(shape_of(chunk)) % SHAPES

        self.known = Remembered(row_of)

    def read(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word rows, shape rows, and how many words each text has."""
        chunks = [(t or "").split() for t in texts]
        known = self.known
        both = np.array([known[c] for chunk in chunks for c in chunk], np.int64)
        return both // SHAPES, both % SHAPES, np.array([len(c) for c in chunks], np.int64)


def corpus_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Context vectors of all rows, of unit length, from every text of ``docs``.

    Each task returns at most ``ROWS`` partial sums, which Spark adds up; only
    the finished table of fixed size comes to the driver.
    """
    index = index_vectors()

    def make():
        reader, total = kept_in_worker("quality reader", Reader), np.zeros((ROWS, DIMENSIONS))

        def add(texts):
            words, shapes, sizes = reader.read(texts)
            if not len(words):
                return
            own = index[words] + index[shapes]
            doc = np.repeat(np.arange(len(sizes)), sizes)
            near = np.zeros_like(own)
            for step in range(1, REACH + 1):
                same = (doc[step:] == doc[:-step])[:, None] if len(doc) > step else np.zeros((0, 1), bool)
                near[step:] += own[:-step] * same
                near[:len(own) - step] += own[step:] * same
            for rows in (words, shapes):
                order = np.argsort(rows.astype(np.int16), kind="stable")
                sorted_rows = rows[order]
                starts = np.flatnonzero(np.concatenate(([True], sorted_rows[1:] != sorted_rows[:-1])))
                total[sorted_rows[starts]] += np.add.reduceat(near[order], starts)

        def finish():
            rows = np.flatnonzero(np.abs(total).sum(axis=1))
            yield [rows.tolist(), *(total[rows, d] for d in range(DIMENSIONS))]

        return add, finish

    fields = [T.StructField("row", T.IntegerType()), *(T.StructField(f"v{d}", T.DoubleType()) for d in range(DIMENSIONS))]
    sums = summarise(docs, [text], fields, make).groupBy("row").agg(*(F.sum(f"v{d}").alias(f"v{d}") for d in range(DIMENSIONS)))
    out = np.zeros((ROWS, DIMENSIONS))
    for r in sums.collect():
        out[r[0]] = r[1:]
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return np.divide(out, norm, out=np.zeros_like(out), where=norm > 0).astype(np.float32)


def pooled(vectors: np.ndarray, index: np.ndarray, words: np.ndarray, shapes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A row of features for each document, given its words' and shapes' rows."""
    n, width = len(sizes), 2 * DIMENSIONS + 4
    out = np.zeros((n, width), np.float32)
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    starts = (np.cumsum(sizes) - sizes)[full]
    count = sizes[full].astype(np.float32)[:, None]
    both = np.hstack([vectors, index / np.float32(np.sqrt(NONZERO))])
    word_mean = np.add.reduceat(both[words], starts) / count
    doc = np.repeat(np.arange(n), sizes)
    # few shapes: how often each occurs in a text, times its vector
    often = np.bincount(doc * SHAPES + shapes, minlength=n * SHAPES).reshape(n, SHAPES)[full]
    shape_mean = often.astype(np.float32) @ both[:SHAPES] / count
    out[full, :DIMENSIONS], mean = word_mean[:, :DIMENSIONS], word_mean[:, DIMENSIONS:]
    out[full, DIMENSIONS:2 * DIMENSIONS] = shape_mean[:, :DIMENSIONS]
    again = np.concatenate(((words[1:] == words[:-1]) * (np.diff(doc) == 0), [0]))
    out[full, -4] = (mean ** 2).sum(axis=1)
    out[full, -3] = (shape_mean[:, DIMENSIONS:] ** 2).sum(axis=1)
    out[full, -2] = np.add.reduceat(again.astype(np.float32), starts) / count[:, 0]
    out[full, -1] = np.log1p(count[:, 0])
    return out


@dataclass
class Network:
    """Standardised input, one hidden layer of tanh units, a temperature on the output."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, epochs: int = 60, seed: int = 7) -> Network:
    """Adam on four fifths of the rows, the temperature on the rest. One class alone gives its score everywhere."""
    width = x.shape[1]
    if len(set(y.tolist())) < 2:
        bias = 0.0 if not len(y) else 3.0 if y[0] else -3.0
        return Network(np.zeros(width), np.ones(width), np.zeros((width, 1)), np.zeros(1), np.zeros(1), bias, 1.0)
    rng = np.random.default_rng(seed)
    held = np.arange(len(x)) % 5 == 4
    if len(set(y[held].tolist())) < 2:
        held = np.zeros(len(x), bool)
    tx, ty = x[~held], y[~held]
    mean, scale = tx.mean(axis=0), tx.std(axis=0) + 1e-3
    tx = (tx - mean) / scale
    weight = np.where(ty == 1, 0.5 / max(ty.mean(), 1e-9), 0.5 / max(1 - ty.mean(), 1e-9)) ** 0.5
    params = [rng.normal(0, 1 / np.sqrt(width), (width, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.3, HIDDEN), np.zeros(1)]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(len(tx)), max(1, len(tx) // 256)):
            a, w = tx[rows], weight[rows]
            h = np.tanh(a @ params[0] + params[1])
            p = 1 / (1 + np.exp(-np.clip(h @ params[2] + params[3], -30, 30)))
            g = (p - ty[rows]) * w / len(rows)
            gh = np.outer(g, params[2]) * (1 - h * h)
            grads = [a.T @ gh + 1e-4 * params[0], gh.sum(axis=0), h.T @ g + 1e-4 * params[2], np.array([g.sum()])]
            step += 1
            for i, grad in enumerate(grads):
                first[i] = 0.9 * first[i] + 0.1 * grad
                second[i] = 0.999 * second[i] + 0.001 * grad * grad
                params[i] = params[i] - 0.01 * (first[i] / (1 - 0.9 ** step)) / (np.sqrt(second[i] / (1 - 0.999 ** step)) + 1e-8)
    net = Network(mean, scale, params[0], params[1], params[2], float(params[3][0]), 1.0)
    if held.any():
        z, hy = net.logit(x[held]), y[held]
        loss = lambda t: np.logaddexp(0, np.where(hy == 1, -z, z) / t).mean()
        net.temperature = float(min(np.exp(np.linspace(-1, 2, 61)), key=loss))
    return net


@dataclass
class QualityModel:
    vectors: np.ndarray
    network: Network


def featurer(vectors: np.ndarray):
    """A function from texts to their features, with a task's memory of words."""
    reader, index = kept_in_worker("quality reader", Reader), index_vectors()
    return lambda texts: pooled(vectors, index, *reader.read(texts))


def labelled_sample(labels: DataFrame, label: str, learn_from: Column, key: str = "doc_id", rows: int = SAMPLE) -> DataFrame:
    """At most ``rows`` labelled keys that may be learnt from: those with the smallest hashes."""
    usable = labels.filter(learn_from & F.col(label).isNotNull() & F.col(key).isNotNull())
    return usable.select(key, F.col(label).cast("int").alias("label")).orderBy(F.xxhash64(key), "label").limit(rows)


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> QualityModel:
    """Word vectors from all of ``docs``; the network from a bounded sample with labels.

    Labels are learnt only where crc32(key) mod 5 is not 0. Null labels and
    keys are left out; a key with several labels or rows counts as often. Rows
    are taken in the order of their keys', labels' and texts' hashes.
    """
    vectors = corpus_vectors(docs, text)
    sample = labelled_sample(labels, label, split_remainder(key, 5) != 0, key)
    chosen = docs.select(key, text).join(F.broadcast(sample), key)
    last = unused("_order", chosen)
    chosen = chosen.withColumn(last, F.xxhash64(text))
    features = T.StructField("features", T.ArrayType(T.FloatType()))

    def make():
        of = featurer(vectors)
        return lambda texts: [list(of(texts))]

    found = (add_columns(chosen, [text], [features], make, [key, "label", last])
             .orderBy(F.xxhash64(key), "label", last).limit(SAMPLE).collect())
    x = np.array([r["features"] for r in found], np.float64).reshape(len(found), 2 * DIMENSIONS + 4)
    return QualityModel(vectors, fit(x, np.array([r["label"] for r in found], np.float64)))


def score_quality(docs: DataFrame, model: QualityModel, text: str = "text", keep: list[str] | None = None,
                  name: str = "score") -> DataFrame:
    """Append ``name`` (0 to 1, higher: likelier good) of each whole text.

    A null or empty text has no words: all its features are zero and it gets
    the network's score for that. Repeated rows score alike.
    """
    vectors, network = model.vectors, model.network

    def make():
        of = featurer(vectors)
        return lambda texts: [network.score(of(texts)).tolist()]

    return add_columns(docs, [text], [T.StructField(name, T.DoubleType())], make, keep)
