"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network in numpy.

A word's index vector is the normalised sum of sparse random vectors of its character trigrams, so unseen words have
one too.  Its context vector is the sum of the index vectors of its neighbours over the training texts, held in
hashed buckets.  A document is the mean and spread of its words' vectors; a two-layer network gives a logit, and a
temperature fitted on held-back training rows makes its sigmoid a calibrated probability.

Only fitting uses a sample: at most ``sample`` labelled rows of the training folds, whatever the corpus size.
Scoring reads every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapelake.llm.common import cut, held_out, map_batches, steps

#: Dimensions of a word vector, hash buckets of trigrams and of context vectors, nonzero entries of a sparse vector.
DIMENSIONS, TRIGRAMS, BUCKETS, NONZERO = 96, 1 << 14, 1 << 13, 6
#: Neighbours on each side that make a context.
REACH = 2
#: Words a worker keeps vectors of; common words come early.
CACHE = 100_000
#: Words pooled in one step, so that long texts take no more memory than short ones.
STRIDE = 1 << 14
#: Labelled rows at most that the classifier is fitted on.
SAMPLE = 6000
#: Values that describe a document.
FEATURES = 2 * DIMENSIONS + REACH + 1
HIDDEN, EPOCHS, RATE, DECAY = 32, 60, 3e-3, 1e-4
THRESHOLD = 0.3


def trigram_vectors(seed: int = 7) -> np.ndarray:
    """A sparse random vector of -1 and 1 for each trigram bucket."""
    random = np.random.default_rng(seed)
    table = np.zeros((TRIGRAMS, DIMENSIONS), dtype=np.float32)
    places = random.integers(0, DIMENSIONS, (TRIGRAMS, NONZERO))
    np.put_along_axis(table, places, random.choice(np.float32([-1, 1]), (TRIGRAMS, NONZERO)), axis=1)
    return table


def index_vectors(words: list[bytes], table: np.ndarray) -> np.ndarray:
    """Unit index vectors of words, from the trigrams of ``^word$``."""
    data = np.frombuffer(b"".join(b"^%b$" % w for w in words) + b"\0\0", dtype=np.uint8).astype(np.uint32)
    sizes = np.array([len(w) for w in words])  # a word of n bytes has n trigrams with its marks
    starts = np.cumsum(sizes + 2) - (sizes + 2)
    codes = (data[:-2] * np.uint32(0x9E3779B1)) ^ (data[1:-1] * np.uint32(0x85EBCA6B)) ^ (data[2:] * np.uint32(0xC2B2AE35))
    codes = (codes ^ (codes >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    rows = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
    out = np.add.reduceat(table[codes[rows] >> np.uint32(18)], np.cumsum(sizes) - sizes, axis=0)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-6)


def buckets(words: list[bytes]) -> np.ndarray:
    import zlib

    return np.array([zlib.crc32(w) for w in words], dtype=np.int64) % BUCKETS


class _Rows(dict):
    def __missing__(self, word: bytes) -> int:
        return -1


class Pooler:
    """Document vectors, with a cache of word vectors for each worker.

    A document is described by the mean and spread of its words' vectors, the likeness of words 1 to REACH apart and
    the logarithm of its word count; all are zero without words.
    """

    def __init__(self, context: np.ndarray | None):
        self.table = trigram_vectors()
        self.context = context
        self.row = _Rows()
        self.vectors = np.zeros((CACHE, DIMENSIONS), dtype=np.float32)

    def _make(self, words: list[bytes]) -> np.ndarray:
        out = index_vectors(words, self.table)
        if self.context is not None:
            out = out + self.context[buckets(words)]
        return out.astype(np.float32)

    def of(self, words: list[bytes]) -> np.ndarray:
        """One vector for each word."""
        rows = np.fromiter(map(self.row.__getitem__, words), dtype=np.int64, count=len(words))
        missing = np.flatnonzero(rows < 0)
        if not len(missing):
            return self.vectors[rows]
        at: dict[bytes, int] = {}
        places = [at.setdefault(words[i], len(at)) for i in missing.tolist()]
        new = list(at)
        made = self._make(new)
        out = self.vectors[np.maximum(rows, 0)]
        out[missing] = made[places]
        held = len(self.row)
        free = new[: CACHE - held]
        if free:
            self.vectors[held : held + len(free)] = made[: len(free)]
            self.row.update(zip(free, range(held, held + len(free)), strict=True))
        return out

    def _sums(self, words: list[bytes], doc: np.ndarray, n: int, own: int | None = None) -> np.ndarray:
        """Sums over each document's words, and over pairs that begin among the first ``own`` words."""
        part = self.of(words)
        own = len(words) if own is None else own
        first = np.flatnonzero(np.diff(doc[:own], prepend=-1))
        out = np.zeros((n, FEATURES))
        squares, ones = part[:own] * part[:own], np.ones(own, dtype=np.float32)
        for row, a, b in zip(doc[first], first, [*first[1:], own], strict=True):
            out[row, :DIMENSIONS] = ones[a:b] @ part[a:b]
            out[row, DIMENSIONS : 2 * DIMENSIONS] = ones[a:b] @ squares[a:b]
        for d in range(1, REACH + 1):
            end = max(0, min(own, len(words) - d))
            near = np.einsum("ij,ij->i", part[:end], part[d : end + d]) * (doc[:end] == doc[d : end + d])
            out[:, 2 * DIMENSIONS + d - 1] = np.bincount(doc[:end], near, minlength=n)
        return out

    def pool(self, texts: list[str | None]) -> np.ndarray:
        """A row of FEATURES for each text."""
        out, sizes = np.zeros((len(texts), FEATURES)), np.zeros(len(texts))
        waiting: list[bytes] = []
        rows: list[int] = []
        lengths: list[int] = []

        def flush() -> None:
            if waiting:
                out[rows] += self._sums(waiting, np.repeat(np.arange(len(rows)), lengths), len(rows))
            for held in (waiting, rows, lengths):
                held.clear()

        for i, text in enumerate(texts):
            words = (text or "").encode().split()
            sizes[i] = len(words)
            if len(words) > STRIDE:
                for k in range(0, len(words), STRIDE):
                    near = words[k : k + STRIDE + REACH]
                    out[i] += self._sums(near, np.zeros(len(near), dtype=np.int64), 1, min(STRIDE, len(words) - k))[0]
                continue
            waiting += words
            rows.append(i)
            lengths.append(len(words))
            if len(waiting) > STRIDE:
                flush()
        flush()
        out /= np.maximum(sizes, 1)[:, None]
        spread = slice(DIMENSIONS, 2 * DIMENSIONS)
        out[:, spread] = np.sqrt(np.maximum(out[:, spread] - out[:, :DIMENSIONS] ** 2, 0))
        out[:, -1] = np.log1p(sizes) / 10
        return out.astype(np.float32)


@dataclass
class Model:
    context: np.ndarray
    center: np.ndarray
    scale: np.ndarray
    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: float
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.tanh((x - self.center) / self.scale @ self.first + self.first_bias)
        return hidden @ self.second + self.second_bias

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def _context(sample: DataFrame) -> np.ndarray:
    """Normalised context vectors of the buckets, summed over the sample's partitions by the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((BUCKETS, DIMENSIONS), dtype=np.float32)
        pooler = Pooler(None)
        for batch in batches:
            for text in (t for part in steps(batch, "text") for t in part.column(0).to_pylist()):
                words = (text or "").encode().split()
                for i in range(0, len(words), STRIDE):
                    near = words[i : i + STRIDE]
                    vectors, at = pooler.of(near), buckets(near)
                    around = np.zeros_like(vectors)
                    for d in range(1, min(REACH, len(near) - 1) + 1):
                        around[d:] += vectors[:-d]
                        around[:-d] += vectors[d:]
                    order = np.argsort(at, kind="stable")
                    own, first = np.unique(at[order], return_index=True)
                    sums[own] += np.add.reduceat(around[order], first, axis=0)
        on = np.flatnonzero(sums.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(on, pa.int64()), pa.array(list(sums[on]), pa.list_(pa.float32()))], names=["bucket", "vector"])

    parts = sample.select("text").mapInArrow(run, "bucket long, vector array<float>")
    added = parts.groupBy("bucket").agg(*(F.sum(F.col("vector")[i]).alias(f"v{i}") for i in range(DIMENSIONS))).toPandas()
    out = np.zeros((BUCKETS, DIMENSIONS), dtype=np.float32)
    if len(added):
        values = added.drop(columns="bucket").to_numpy(dtype=np.float32)
        out[added["bucket"].to_numpy()] = values / np.maximum(np.linalg.norm(values, axis=1, keepdims=True), 1e-6)
    return out


def train_network(x: np.ndarray, y: np.ndarray, seed: int = 3) -> dict:
    """Fit the two layers by Adam on four fifths of the rows and the temperature on the rest."""
    random = np.random.default_rng(seed)
    if not len(x):
        x, y = np.zeros((1, FEATURES), np.float32), np.ones(1)
    order = random.permutation(len(x))
    back = order[: len(x) // 5]
    fit = order[len(x) // 5 :]
    center, scale = x[fit].mean(axis=0), x[fit].std(axis=0) + 1e-3
    weights = [random.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN), random.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    z, step = (x - center) / scale, 0
    for _ in range(EPOCHS):
        for at in np.array_split(random.permutation(fit), max(1, len(fit) // 64)):
            step += 1
            a, b = z[at], y[at]
            hidden = np.tanh(a @ weights[0] + weights[1])
            error = (1 / (1 + np.exp(-np.clip(hidden @ weights[2] + weights[3], -30, 30))) - b) / len(at)
            inner = np.outer(error, weights[2]) * (1 - hidden**2)
            slopes = [a.T @ inner + DECAY * weights[0], inner.sum(axis=0), hidden.T @ error + DECAY * weights[2], np.array([error.sum()])]
            for w, g, m, v in zip(weights, slopes, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    out = {"center": center, "scale": scale, "first": weights[0], "first_bias": weights[1], "second": weights[2], "second_bias": float(weights[3][0])}
    logits = Model(context=np.zeros(0), temperature=1.0, **out).logits(x[back])

    def loss(t: float) -> float:
        return float(np.logaddexp(0, np.where(y[back] > 0.5, -1, 1) * logits / t).mean()) if len(back) else t

    return out | {"temperature": min(np.geomspace(0.5, 8, 60), key=loss)}


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, text, _y) of at most ``sample`` labelled documents that aren't held out, chosen by a hash of their id.

    An id with several texts counts once, with the text of the least hash.  Null labels and null ids are left out.
    """
    known = labels.where("doc_id is not null and quality is not null").where(~held_out()).select(F.col("doc_id").alias("_id"), F.col("quality").cast("double").alias("_y"))
    chosen = known.orderBy(F.xxhash64("_id"), "_id", "_y").limit(sample)
    met = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    return met.groupBy("doc_id", "_y").agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("doc_id", "text", "_y")


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` rows of ``docs`` that have a label and aren't held out.

    The choice of rows doesn't depend on the layout.  Without any label every text gets a high score.
    """
    rows = cut(training_rows(docs, labels, sample))
    context = _context(rows)
    held = docs.sparkSession.sparkContext.broadcast(context)
    made: list[Pooler] = []

    def run(got: dict) -> dict:
        pooler = made[0] if made else made.append(Pooler(held.value)) or made[0]
        return {"doc_id": got["doc_id"], "y": got["_y"], "x": list(pooler.pool(got["text"]))}

    features = map_batches(rows, "doc_id long, y double, x array<float>", run, "text").orderBy("doc_id", "y").toPandas()
    x = np.array(features["x"].to_list(), dtype=np.float32).reshape(len(features), FEATURES)
    return Model(context=context, **train_network(x, features["y"].to_numpy()))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) for every row of ``docs`` from its whole text; null and empty texts get a score too."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    made: list[Pooler] = []

    def run(got: dict) -> dict:
        pooler = made[0] if made else made.append(Pooler(held.value.context)) or made[0]
        return {"doc_id": got["doc_id"], "score": held.value.score(pooler.pool(got["text"])).astype(float)}

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "doc_id long, score double", run, "text")


def filter_documents(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores at least ``threshold``.

    Null and empty texts have the score of a text without words; repeated rows are judged alike; an empty table stays
    empty; columns beside ``text`` may have any name.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    made: list[Pooler] = []
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pooler = made[0] if made else made.append(Pooler(held.value.context)) or made[0]
        for batch in batches:
            for part in steps(batch, "text"):
                x = pooler.pool(part.column(part.schema.names.index("text")).to_pylist())
                yield part.filter(pa.array(held.value.score(x) >= threshold))

    return docs.mapInArrow(run, schema)
