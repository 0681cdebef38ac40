"""Language-model scoring by masked pseudo-likelihood.

Every word is predicted from the words on both sides by a window network: embeddings by position, a hidden layer and a
softmax over word classes in two steps, first a group of classes, then the class in it.  A word's probability is its
class's times its share of the class among all *other* documents of the corpus; a word that no other document holds is
spelled out letter by letter.  The sum of the conditional log-probabilities scores a document.

The most frequent words have classes of their own; the rest fall into classes by their ending.  Counts cover the whole
corpus and stay in Spark, a row for each word.  A bounded number of frequent words travels with the tasks; the others
of a document meet their counts in a join, so every word has its exact share whatever the size of the corpus.

Training deals the texts, in blocks, to shards by a hash of id and content, about SHARD words each, so the shards
follow from the corpus and not from the layout of its files.  Each shard fits a copy of the network, its blocks in
the order of their hashes, and the copies are averaged, weighted by words.  A first round on one block in FIRST gives
the second, on all others, a common start; every word is trained on once.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapelake.llm.common import ascii_words, cut, map_batches, steps

#: Classes in groups of MEMBERS: frequent words, then endings, and one that pads the ends of a text.
GROUPS, MEMBERS = 16, 16
CLASSES = GROUPS * MEMBERS
TOP, ENDINGS = 191, 64
PADDING = TOP + ENDINGS
OFFSETS = (-2, -1, 1, 2)
HIDDEN, BATCH, RATE = 16, 4096, 4e-3
#: Words of a shard and of a block of a text, and the share of blocks (one in FIRST) that the first round takes.
SHARD, BLOCK, FIRST = 1 << 21, 1 << 16, 8
#: Frequent words at most whose counts travel with the tasks, and steps of a doubling in which frequencies are told apart.
KNOWN, FINENESS = 1 << 18, 16
#: Nats for each letter of a word that no other document holds.
LETTER = float(np.log(32))
#: Parts of a nat in which shares are summed, so that sums don't depend on the order of rows.
FINE = 1 << 30
#: Words scored in one step, and words a worker keeps.
STRIDE, CACHE = 1 << 14, 500_000


@lru_cache(maxsize=1 << 16)
def _ending(tail: bytes) -> int:
    return xxhash.xxh3_64_intdigest(tail) % ENDINGS


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, ending, n) over the whole corpus, words by their hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def flush() -> pa.RecordBatch:
            values = [xxhash.xxh3_64_intdigest(w) for w in held]
            out = [pa.array(np.array(values, dtype=np.uint64).astype(np.int64)), pa.array([_ending(w[-2:]) for w in held], pa.int32()), pa.array(list(held.values()), pa.int64())]
            held.clear()
            return pa.RecordBatch.from_arrays(out, names=["word", "ending", "n"])

        for batch in batches:
            for part in steps(batch, "text"):
                for text in part.column(0).to_pylist():
                    held.update(ascii_words(text))
                if len(held) > CACHE:
                    yield flush()
        yield flush()

    return docs.select("text").mapInArrow(run, "word long, ending int, n long").groupBy("word", "ending").agg(F.sum("n").alias("n"))


class _Codes(dict):
    """Codes of words, given in the order in which the words are met; ``new`` lists those just met."""

    def __init__(self):
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        code = self[word] = len(self)
        self.new.append(word)
        return code


class Vocabulary:
    """Classes of any word and counts of the frequent ones; ``counts``, a table in Spark, stays on the driver.

    ``words`` and ``seen`` hold the KNOWN most frequent words and their counts, the TOP ones first; ``totals`` the
    words of each class, and ``once`` the words that the corpus holds a single time.
    """

    def __init__(self, words: np.ndarray, seen: np.ndarray, totals: np.ndarray, once: int, top: int = TOP, counts: DataFrame | None = None):
        self.words, self.seen, self.totals, self.once, self.top, self.counts = words, seen, totals, once, top, counts
        self.place = {w: i for i, w in enumerate(words.tolist())}
        rest = max(float(totals[top:].sum()), 1.0)
        #: Share of a class that words of no other document have, and its logarithm.
        self.novel = min(max(once / rest, 1e-6), 0.5)
        self.novel_cost, self.seen_cost, self.log_totals = float(np.log(self.novel)), float(np.log1p(-self.novel)), np.log1p(totals)
        self._reset()

    def __reduce__(self) -> tuple:
        return Vocabulary, (self.words, self.seen, self.totals, self.once, self.top)

    def _reset(self) -> None:
        """Forget the words met so far; a word's code is its row in class, count (-1 where only the join knows it), hash and length."""
        self.codes = _Codes()
        self.table = np.zeros((4, 1 << 12), dtype=np.int64)
        self.filled = 0

    def _fill(self) -> None:
        """Look up the words that were first met in the last text."""
        new = self.codes.new
        if not new:
            return
        if len(self.codes) > self.table.shape[1]:
            self.table = np.concatenate([self.table, np.zeros((4, max(self.table.shape[1], len(new))), dtype=np.int64)], axis=1)
        place, top = self.place, min(self.top, len(self.words))
        values = np.array([xxhash.xxh3_64_intdigest(w) for w in new], dtype=np.uint64).astype(np.int64)
        at = np.array([place.get(v, -1) for v in values.tolist()], dtype=np.int64)
        ends = np.array([_ending(w[-2:]) for w in new], dtype=np.int64)
        known = self.seen[at] if len(self.seen) else at
        self.table[:, self.filled : len(self.codes)] = np.where((at >= 0) & (at < top), at, self.top + ends), np.where(at < 0, -1, known), values, [len(w) for w in new]
        self.filled = len(self.codes)
        new.clear()

    def encode(self, texts: list[str | None]) -> list[tuple]:
        """(classes padded at both ends, base, novel, words, times, spelled) of each text.

        ``base`` sums the log shares of words whose counts are at hand and ``novel`` counts those among them that no
        other document holds.  The rest are listed: ``base`` has their shares but for the logarithm of their count in
        other documents, in whose place ``spelled`` stands if there is none.
        """
        out = []
        for text in texts:
            if len(self.codes) > CACHE:
                self._reset()
            words = ascii_words(text)
            places = np.fromiter(map(self.codes.__getitem__, words), np.int64, len(words))
            self._fill()
            kinds = self.table[0][places]
            classes = np.full(len(words) + 4, PADDING, dtype=np.uint8)
            classes[2:-2] = kinds
            local, times = np.unique(places, return_counts=True)
            kind, seen, value, letters = self.table[:, local]
            near, far = (seen >= 0) & (kind >= self.top), seen < 0
            share = self.seen_cost - self.log_totals[kind]
            spelled = self.novel_cost - LETTER * (letters + 1) - share
            others = seen - times
            share[near] += np.where(others > 0, np.log(np.maximum(others, 1)), spelled)[near]
            base = float((times * share)[near | far].sum())
            out.append((classes, base, int(times[(seen >= 0) & (others <= 0)].sum()), value[far], times[far], spelled[far]))
        return out


def vocabulary(docs: DataFrame, top: int = TOP, known: int = KNOWN) -> Vocabulary:
    """Counts of all words; the driver gets ``known`` words at most, how many have which frequency, and one total for each class.

    At most TOP words have classes of their own, and at most as many as are known.
    """
    step = F.floor(F.log2("n") * FINENESS).cast("int")
    counts = cut(word_counts(docs))
    held, least = 0, 0
    for r in sorted(counts.groupBy(step.alias("step")).count().collect(), reverse=True):
        held, least = held + r["count"], r["step"] if held + r["count"] <= known else r["step"] + 1
        if held > known:
            break
    rows = counts.where(step >= least).toPandas().sort_values(["n", "word"], ascending=[False, True])
    words, seen = rows["word"].to_numpy(np.int64), rows["n"].to_numpy(np.int64)
    totals = np.zeros(CLASSES)
    sums = counts.groupBy("ending").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("n") == 1, 1).otherwise(0)).alias("once")).toPandas()
    totals[top + sums["ending"].to_numpy(np.int64)] = sums["n"]
    own = min(top, len(words))
    totals[:own] = seen[:own]
    np.subtract.at(totals, top + rows["ending"].to_numpy(np.int64)[:own], seen[:own])
    return Vocabulary(words, seen, totals, int(sums["once"].sum()), top, counts.select("word", "n"))


SHAPES = ((len(OFFSETS), CLASSES, HIDDEN), (HIDDEN,), (HIDDEN, GROUPS), (GROUPS,), (GROUPS, HIDDEN, MEMBERS), (GROUPS, MEMBERS))
SIZES = [int(np.prod(s)) for s in SHAPES]


def start(totals: np.ndarray, seed: int = 5) -> np.ndarray:
    """Small random weights, and biases by which classes have their shares of the corpus."""
    random = np.random.default_rng(seed)
    share = (totals + 1).reshape(GROUPS, MEMBERS)
    biases = np.log(share.sum(axis=1) / share.sum()), np.log(share / share.sum(axis=1, keepdims=True))
    parts = [random.normal(0, 0.1, SIZES[0]), np.zeros(SIZES[1]), random.normal(0, 0.1, SIZES[2]), biases[0], random.normal(0, 0.1, SIZES[4]), biases[1].reshape(-1)]
    return np.concatenate(parts).astype(np.float32)


def unpack(weights: np.ndarray) -> list[np.ndarray]:
    return [p.reshape(s) for p, s in zip(np.split(weights, np.cumsum(SIZES)[:-1]), SHAPES, strict=True)]


def hidden_layer(weights: list[np.ndarray], classes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hidden values of the words at padded places ``at``, from their neighbours only."""
    total = weights[1] + weights[0][0][classes[at + OFFSETS[0]]]
    for k, d in enumerate(OFFSETS[1:], 1):
        total += weights[0][k][classes[at + d]]
    return np.tanh(total, out=total)


def _runs(groups: np.ndarray) -> list[tuple[int, int, int]]:
    """(group, first, end) of the runs in sorted ``groups``."""
    bounds = np.searchsorted(groups, np.arange(GROUPS + 1))
    return [(g, int(a), int(b)) for g, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)) if b > a]


def _softmax(logits: np.ndarray) -> np.ndarray:
    """In place, over the first axis; each word's own greatest value is its shift."""
    logits -= logits.max(axis=0)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=0)
    return logits


def _forward(w: list[np.ndarray], classes: np.ndarray, at: np.ndarray) -> tuple:
    """Places sorted by the group of their word, its runs, hidden values and the two softmaxes, a column for each word."""
    groups = classes[at] // MEMBERS
    order = np.argsort(groups, kind="stable")
    at, groups = at[order], groups[order]
    hidden, runs = hidden_layer(w, classes, at), _runs(groups)
    inner = np.empty((len(at), MEMBERS), dtype=np.float32)
    for g, a, b in runs:
        np.matmul(hidden[a:b], w[4][g], out=inner[a:b])
    inner += w[5][groups]
    return at, groups, runs, hidden, _softmax(w[2].T @ hidden.T + w[3][:, None]), _softmax(np.ascontiguousarray(inner.T))


def log_probabilities(w: list[np.ndarray], classes: np.ndarray) -> np.ndarray:
    """Log-probability of each word's class given both sides; 0 at padding."""
    out = np.zeros(len(classes))
    words = np.flatnonzero(classes != PADDING)
    for i in range(0, len(words), STRIDE):
        at, groups, _, _, outer, inner = _forward(w, classes, words[i : i + STRIDE])
        rows = np.arange(len(at))
        out[at] = np.log(np.maximum(outer[groups, rows], 1e-37)) + np.log(np.maximum(inner[classes[at] % MEMBERS, rows], 1e-37))
    return out


class Trainer:
    """A copy of the network that takes Adam steps."""

    def __init__(self, weights: np.ndarray):
        self.flat = weights.copy()
        self.first, self.second, self.step = np.zeros_like(weights), np.zeros_like(weights), 0

    def fit(self, classes: np.ndarray, at: np.ndarray) -> None:
        for i in range(0, len(at), BATCH):
            self._step(classes, at[i : i + BATCH])

    def _step(self, classes: np.ndarray, at: np.ndarray) -> None:
        w = unpack(self.flat)
        at, groups, runs, hidden, outer, inner = _forward(w, classes, at)
        rows = np.arange(len(at))
        outer[groups, rows] -= 1
        inner[classes[at] % MEMBERS, rows] -= 1
        back = outer.T @ w[2].T
        slope = np.zeros_like(self.flat)
        parts = unpack(slope)
        for g, a, b in runs:
            own = inner[:, a:b].T
            back[a:b] += own @ w[4][g].T
            parts[4][g] = hidden[a:b].T @ own
            parts[5][g] = inner[:, a:b].sum(axis=1)
        back *= 1 - hidden * hidden
        columns = np.arange(HIDDEN)
        for k, d in enumerate(OFFSETS):
            cells = (classes[at + d] * HIDDEN)[:, None] + columns
            parts[0][k] = np.bincount(cells.reshape(-1), back.reshape(-1), minlength=CLASSES * HIDDEN).reshape(CLASSES, HIDDEN)
        parts[1][:] = back.sum(axis=0)
        parts[2][:] = hidden.T @ outer.T
        parts[3][:] = outer.sum(axis=1)
        slope /= len(at)
        self.step += 1
        self.first *= 0.9
        self.first += 0.1 * slope
        self.second *= 0.999
        slope *= slope
        slope *= 0.001
        self.second += slope
        np.sqrt(self.second, out=slope)
        slope += 1e-8
        np.divide(self.first, slope, out=slope)
        slope *= RATE * (1 - 0.999**self.step) ** 0.5 / (1 - 0.9**self.step)
        self.flat -= slope


CODED = "row long, doc_id long, base double, novel long, classes binary, words array<long>, times array<long>, spelled array<double>"


def code(docs: DataFrame, words: Vocabulary) -> DataFrame:
    """The encoded texts, stored: a byte for each word's class, padded at both ends, and what ``add_shares`` needs."""
    held = docs.sparkSession.sparkContext.broadcast(words)

    def run(rows: dict) -> dict:
        names = ("classes", "base", "novel", "words", "times", "spelled")
        coded = dict(zip(names, zip(*held.value.encode(rows["text"]), strict=True), strict=True)) if rows["row"] else dict.fromkeys(names, [])
        return {"row": rows["row"], "doc_id": rows["doc_id"]} | coded | {"classes": [c.tobytes() for c in coded["classes"]]}

    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return cut(map_batches(numbered, CODED, run, "text"))


def add_shares(coded: DataFrame, words: Vocabulary) -> DataFrame:
    """(doc_id, shares, novel, classes): the sum of the log shares of a document's words, and its novel words.

    The words of a document whose counts did not travel meet them in a join; the frequent ones, which very many
    documents hold, take no part in it.  Sums are of whole numbers, so they don't depend on the order of rows.
    """
    met = coded.select("row", F.explode(F.arrays_zip("words", "times", "spelled")).alias("w")).select("row", "w.*")
    others = F.coalesce(F.col("n"), F.lit(0)) - F.col("times")
    share = F.when(others > 0, F.log(others)).otherwise(F.col("spelled"))
    counted = met.join(words.counts, met["words"] == F.col("word"), "left")
    sums = counted.groupBy("row").agg(F.sum(F.round(share * FINE).cast("long") * F.col("times")).alias("far"), F.sum(F.when(others > 0, 0).otherwise(F.col("times"))).alias("more"))
    joined = coded.select("row", "doc_id", "base", "novel", "classes").join(sums, "row", "left")
    return joined.select("doc_id", (F.col("base") + F.coalesce(F.col("far") / FINE, F.lit(0.0))).alias("shares"), (F.col("novel") + F.coalesce("more", F.lit(0))).alias("novel"), "classes")


def encode(docs: DataFrame, words: Vocabulary) -> DataFrame:
    """(doc_id, shares, novel, classes) of every text."""
    return add_shares(code(docs, words), words)


def decoded(classes: bytes) -> np.ndarray:
    return np.frombuffer(classes, dtype=np.uint8).astype(np.int64)


def blocks(coded: DataFrame, shards: int) -> DataFrame:
    """(shard, hash, first, classes): blocks of about BLOCK words, with the two neighbours on either side of each.

    Shard and order follow from a document's id and content; texts that agree in both are interchangeable.
    """
    size = F.octet_length("classes") - 4
    cuts = coded.where(size > 0).select("doc_id", "classes", F.explode(F.sequence(F.lit(0), F.floor((size - 1) / BLOCK).cast("int"))).alias("block"))
    key = cuts.select(F.xxhash64("doc_id", F.xxhash64("classes"), "block").alias("hash"), F.substring("classes", F.col("block") * BLOCK + 1, F.lit(BLOCK + 4)).alias("classes"))
    return key.select(F.pmod("hash", F.lit(shards)).alias("shard"), "hash", (F.pmod(F.xxhash64("hash", F.lit(1)), F.lit(FIRST)) == 0).alias("first"), "classes")


def fit(coded: DataFrame, words: Vocabulary) -> np.ndarray:
    """Weights fitted on every word of the encoded texts; an empty corpus keeps the start."""
    weights = start(words.totals)
    shards = max(1, -(-int(words.totals.sum()) // SHARD))
    dealt = blocks(coded, shards)
    for first in (True, False):
        held = coded.sparkSession.sparkContext.broadcast(weights)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            total, seen = np.zeros(len(held.value)), 0
            trainer, shard, learned, waiting, size = None, None, 0, [], 0

            def learn() -> None:
                nonlocal learned, size
                classes = np.concatenate([decoded(c) for c in waiting])
                # A block's first and last two are its neighbours' or padding: they are seen, not predicted.
                bounds = np.cumsum([0, *map(len, waiting)])
                at = np.concatenate([np.arange(a + 2, b - 2) for a, b in zip(bounds[:-1], bounds[1:], strict=True)])
                trainer.fit(classes, np.random.default_rng(len(at)).permutation(at))
                learned += len(at)
                waiting.clear()
                size = 0

            def finish() -> None:
                nonlocal seen, learned
                if waiting:
                    learn()
                if trainer is not None:
                    np.add(total, trainer.flat.astype(np.float64) * learned, out=total)
                    seen += learned
                learned = 0

            for batch in batches:
                for part in steps(batch, "classes"):
                    for own, classes in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                        if own != shard:
                            finish()
                            trainer, shard = Trainer(held.value), own
                        waiting.append(classes)
                        size += len(classes)
                        if size > 1 << 18:
                            learn()
            finish()
            if seen:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, len(total))), pa.array(np.concatenate([[float(seen)], total]))], names=["place", "value"])

        ordered = dealt.where("first" if first else "not first").repartition("shard").sortWithinPartitions("shard", "hash", "classes").select("shard", "classes")
        sums = ordered.mapInArrow(run, "place long, value double").groupBy("place").agg(F.sum("value").alias("value")).toPandas().sort_values("place")
        if len(sums):
            values = sums["value"].to_numpy()
            weights = (values[1:] / values[0]).astype(np.float32)
    return weights


def train(docs: DataFrame, words: Vocabulary) -> np.ndarray:
    """Weights fitted on the texts of ``docs``."""
    return fit(code(docs, words), words)


def score(docs: DataFrame, words: Vocabulary, weights: np.ndarray) -> DataFrame:
    """(doc_id, n_words, log_likelihood, per_word, n_novel) of every whole text, as ``score_corpus`` says."""
    return rate(encode(docs, words), weights)


def rate(coded: DataFrame, weights: np.ndarray) -> DataFrame:
    """The scores of encoded texts."""
    held = coded.sparkSession.sparkContext.broadcast(weights)

    def run(rows: dict) -> dict:
        parts = [decoded(c) for c in rows["classes"]]
        n = np.array([len(p) - 4 for p in parts])
        each = log_probabilities(unpack(held.value), np.concatenate(parts)) if parts else np.zeros(0)
        sums = np.add.reduceat(each, np.cumsum([0, *(len(p) for p in parts)])[:-1]) if parts else each
        total = np.where(n > 0, sums + np.array(rows["shares"], dtype=float), 0.0).tolist()
        return {"doc_id": rows["doc_id"], "n_words": n.tolist(), "log_likelihood": total, "per_word": [t / k if k else None for t, k in zip(total, n.tolist(), strict=True)], "n_novel": rows["novel"]}

    return map_batches(coded, "doc_id long, n_words long, log_likelihood double, per_word double, n_novel long", run, "classes")


def score_corpus(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, log_likelihood, per_word, n_novel) of all texts by a network fitted on them.

    ``n_novel`` counts the words that no other row holds.  Null and blank texts have no words: their likelihood is 0
    and ``per_word`` is null.  Repeated rows are scored each, and count as other rows to one another.  An empty table
    gives no row.  Other columns are ignored.  The texts are encoded once for training and scoring.
    """
    words = vocabulary(docs)
    coded = code(docs, words)
    return rate(add_shares(coded, words), fit(coded, words))
