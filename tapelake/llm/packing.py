"""Lexical retrieval packing: sequences filled with related documents.

Documents are brought into an order of their content: a tree of hyperplanes, each the direction in which a node's BM25
vectors vary most, gives leaves, and inside a leaf the last direction goes on.  The order is cut into shards of SHARD
documents, so that neighbours tend to share a shard while no shard outgrows its size, however many documents are alike.
A shard holds an inverted index of its own documents with the document frequencies and mean length of the whole corpus;
neighbours in other shards are not found.  Whole windows of a long document are sequences of their own.  What remains
seeds windows, longest first: the index ranks the unused documents by BM25 against the seed and they fill its window
greedily.  The last one is cut at a multiple of GRAIN tokens; its rest stays unused and is indexed like any other
document.

Token ids never leave the task that makes them.  A document travels as its terms and one checksum for each GRAIN
tokens, from which the checksum of any piece follows, so the shuffle moves a fraction of the text.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tapelake.llm.bpe import CACHE, Found, byte_letters
from tapelake.llm.common import cut, map_batches

WINDOW, GRAIN, SHARD = 4096, 32, 1024
#: Id that ends a document.
END = 2
#: The usual BM25 constants.
K1, B = 1.2, 0.75
#: Dimensions of the projected vectors that order documents, leaves of the tree at most, and documents that shape a leaf.
DIMENSIONS, LEAVES, PER_LEAF = 64, 1024, 32

#: A term that more than one document in DENSE holds has its weights in a row; documents ranked first for a seed.
DENSE, FIRST = 8, 32

#: Fixed letters and pieces of the vocabulary's pattern within the range where no normalisation is needed.
LETTERS = "A-Za-zÀ-ÖØ-öø-įı-ɏ"
PIECES = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^{LETTERS}0-9]+")
PLAIN = re.compile(rf"[!-~{LETTERS}]+")


class WordCodec:
    """Ids of a word vocabulary, looked up word by word.

    The vocabulary drops white space and no piece spans it, so a text's ids are those of its words one after another.
    A word of plain letters and signs is cut into pieces that the model merges; any other word goes through the
    whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.merge = self.tokenizer.model.tokenize
        self.letters = {b: c for c, b in byte_letters().items()}
        self.words = Found(self._word, 2 * CACHE)
        self.words[""] = b""
        self.pieces = Found(self._piece)

    def _piece(self, piece: str) -> bytes:
        known = piece if piece.isascii() else "".join(map(self.letters.__getitem__, piece.encode()))
        return _packed([t.id for t in self.merge(known)])

    def _word(self, word: str) -> bytes:
        low = word.lower()
        if word.isascii() and word.isprintable() and "<|" not in word:
            if low.isalpha():
                return _packed([t.id for t in self.merge(low)])
            if low[:-1].isalpha() and low[-1] in ".,;:!?":
                return self.words[low[:-1]] + self.pieces[low[-1]]
            return b"".join(map(self.pieces.__getitem__, PIECES.findall(low)))
        # Some letters have their small form outside the plain range.
        if PLAIN.fullmatch(word) and PLAIN.fullmatch(low) and "<|" not in word:
            return b"".join(map(self.pieces.__getitem__, PIECES.findall(low)))
        return _packed(self.tokenizer.encode(word, add_special_tokens=False).ids)

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.words.__getitem__, text.replace("\n", " ").split(" ")))


_FORMS = [struct.Struct(f"<{n}I").pack for n in range(64)]


def _packed(ids: list[int]) -> bytes:
    return _FORMS[len(ids)](*ids) if len(ids) < 64 else np.array(ids, "<u4").tobytes()


@lru_cache(maxsize=2)
def codec(path: str) -> WordCodec:
    return WordCodec(path)


@lru_cache(maxsize=None)
def _shift_tables() -> np.ndarray:
    """tables[k][j][b]: byte j with value b of a checksum, carried over 4 * (k + 1) zero bytes."""
    table = np.zeros((GRAIN, 4, 256), dtype=np.uint32)
    for j in range(4):
        for b in range(256):
            table[0, j, b] = _advance(b << (8 * j))
    for k in range(1, GRAIN):
        table[k] = _carry(table[0], table[k - 1])
    return table


def _advance(register: int) -> int:
    """A raw checksum register after four zero bytes, by way of zlib's pre- and postconditioning."""
    ones = 0xFFFFFFFF
    return zlib.crc32(bytes(4), register ^ ones) ^ ones


def _carry(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return table[0][crc & 255] ^ table[1][(crc >> np.uint32(8)) & 255] ^ table[2][(crc >> np.uint32(16)) & 255] ^ table[3][crc >> np.uint32(24)]


def grain_checksums(ids: bytes) -> bytes:
    """crc32 of each GRAIN ids in turn; the last may have fewer."""
    step = 4 * GRAIN
    return np.array([zlib.crc32(ids[i : i + step]) for i in range(0, len(ids), step)], dtype="<u4").tobytes()


def join_checksums(grains: list[np.ndarray], tokens: np.ndarray) -> np.ndarray:
    """crc32 of runs of ids, at most WINDOW long, from the checksums of each run's grains."""
    tables = _shift_tables()
    whole, rest = np.divmod(tokens, GRAIN)
    held = np.zeros((len(grains), WINDOW // GRAIN), dtype=np.uint32)
    for row, g in zip(held, grains, strict=True):
        row[: len(g)] = g
    crc = np.zeros(len(grains), dtype=np.uint32)
    for k in range(int(whole.max(initial=0))):
        on = np.flatnonzero(whole > k)
        crc[on] = _carry(tables[GRAIN - 1], crc[on]) ^ held[on, k]
    for r in np.unique(rest[rest > 0]):
        on = np.flatnonzero(rest == r)
        crc[on] = _carry(tables[r - 1], crc[on]) ^ held[on, whole[on]]
    return crc.astype(np.int64)


def profile(df: DataFrame, path: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, tokens, terms, counts, grains): a document's length with its end id, its terms and its checksums."""

    def run(rows: dict) -> dict:
        out: dict[str, list] = {"id": rows["id"], "tokens": [], "terms": [], "counts": [], "grains": []}
        end = np.array([END], dtype="<u4").tobytes()
        for t in rows["text"]:
            raw = codec(path).encode(t or "") + end
            terms, counts = np.unique(np.frombuffer(raw, dtype="<u4")[:-1], return_counts=True)
            out["tokens"].append(len(raw) // 4)
            out["terms"].append(terms.astype("<u4").tobytes())
            out["counts"].append(counts.astype("<u4").tobytes())
            out["grains"].append(grain_checksums(raw))
        return out

    return map_batches(df.select(F.col(id_column).cast("long").alias("id"), F.col(text).alias("text")), "id long, tokens long, terms binary, counts binary, grains binary", run, "text")


@dataclass(frozen=True)
class Statistics:
    """What BM25 needs of the corpus: documents, their mean length, and how many hold each term (all below the vocabulary's size)."""

    n: int
    mean: float
    held: np.ndarray

    def __post_init__(self):
        object.__setattr__(self, "rarity", np.log1p((self.n - self.held + 0.5) / (self.held + 0.5)))

    def idf(self, terms: np.ndarray) -> np.ndarray:
        return self.rarity[terms]

    def saturated(self, counts: np.ndarray, length: np.ndarray | float) -> np.ndarray:
        return counts * (K1 + 1) / (counts + K1 * (1 - B + B * length / self.mean))


def statistics(profiles: DataFrame) -> Statistics:
    """Count over the whole corpus; the driver gets one row for each term of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, length = np.zeros(0, np.int64), 0, 0
        for batch in batches:
            for terms, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = np.frombuffer(terms, "<u4")
                if len(own) and own[-1] >= len(held):
                    held = np.append(held, np.zeros(int(own[-1]) + 1 - len(held), np.int64))
                held[own] += 1
                n += 1
                length += int(np.frombuffer(counts, "<u4").sum())
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-2, len(held))), pa.array(np.append([n, length], held))], names=["term", "n"])

    rows = profiles.select("terms", "counts").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    counted = np.zeros(3 + int(rows["term"].max()) if len(rows) else 2, dtype=np.int64)
    counted[rows["term"].to_numpy() + 2] = rows["n"].to_numpy()
    return Statistics(int(counted[0]), max(counted[1] / max(counted[0], 1), 1.0), counted[2:])


@lru_cache(maxsize=1)
def _places(terms: int) -> tuple[np.ndarray, np.ndarray]:
    """A random dimension and sign for each term."""
    random = np.random.default_rng(13)
    return random.integers(0, DIMENSIONS, terms), random.choice([-1.0, 1.0], terms)


def vector(corpus: Statistics, terms: bytes, counts: bytes) -> np.ndarray:
    """A document's BM25 weights added up, with their signs, in the dimensions of its terms, at unit length."""
    own, times = np.frombuffer(terms, "<u4"), np.frombuffer(counts, "<u4").astype(np.float64)
    place, sign = _places(len(corpus.held))
    out = np.bincount(place[own], corpus.saturated(times, times.sum()) * corpus.idf(own) * sign[own], minlength=DIMENSIONS)
    return (out / max(float(np.sqrt(out @ out)), 1e-9)).astype(np.float32)


class Tree:
    """Splits by hyperplanes at the median of a sample; leaves in the order of the tree, each with a direction of its own."""

    def __init__(self, sample: np.ndarray, leaves: int):
        self.normals, self.cuts, self.sides = [], [], []
        self.root = self._grow(sample, 0, leaves)
        self.normals, self.cuts = np.array(self.normals, np.float32).reshape(-1, DIMENSIONS), np.array(self.cuts, np.float32)

    def _grow(self, sample: np.ndarray, first: int, leaves: int) -> int:
        """Index of a node of ``leaves`` leaves, the first of which has the number ``first``."""
        normal = np.eye(1, DIMENSIONS, dtype=np.float32)[0]
        if len(sample):
            away = sample - sample.mean(axis=0)
            normal = np.linalg.eigh((away.T @ away).astype(np.float64))[1][:, -1].astype(np.float32)
        at = np.float32(np.quantile(sample @ normal, leaves // 2 / leaves)) if len(sample) else np.float32(0)
        node = len(self.normals)
        self.normals.append(normal)
        self.cuts.append(at)
        self.sides.append((-1 - first, -1 - first))
        if leaves > 1:
            low = sample @ normal < at
            self.sides[node] = self._grow(sample[low], first, leaves // 2), self._grow(sample[~low], first + leaves // 2, leaves - leaves // 2)
        return node

    def place(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leaf of each vector, and its place along the leaf's direction."""
        sides = np.array(self.sides, dtype=np.int64)
        node = np.full(len(x), self.root)
        while True:
            along = np.einsum("ij,ij->i", x, self.normals[node])
            inner = sides[node, 0] >= 0
            if not inner.any():
                return -1 - sides[node, 0], along
            node[inner] = np.where(along < self.cuts[node], sides[node, 0], sides[node, 1])[inner]


ORDERED = "id long, tokens long, terms binary, counts binary, grains binary, leaf int, along double, salt long"


def order(profiles: DataFrame, corpus: Statistics, shard: int = SHARD) -> DataFrame:
    """Add the place of each document in the order of content: leaf, place along the leaf, and a salt that parts what is alike.

    The tree has a leaf for each shard, LEAVES at most, and is shaped by about PER_LEAF documents a leaf, which a hash
    picks; what the driver gets and sends is bounded by that.  Every document is placed.
    """
    context = profiles.sparkSession.sparkContext
    salted = profiles.withColumn("salt", F.xxhash64(F.monotonically_increasing_id(), F.lit(1)))
    leaves = min(LEAVES, max(1, -(-corpus.n // shard)))
    known = context.broadcast(corpus)

    def project(rows: dict) -> dict:
        return {"x": [vector(known.value, t, c).tobytes() for t, c in zip(rows["terms"], rows["counts"], strict=True)]}

    share = PER_LEAF * leaves / max(corpus.n, 1)
    few = salted.where(F.pmod("salt", F.lit(1 << 30)) < int(share * (1 << 30))).select("terms", "counts")
    picked = sorted(bytes(r["x"]) for r in map_batches(few, "x binary", project, "terms").collect()) if leaves > 1 else []
    tree = context.broadcast(Tree(np.frombuffer(b"".join(picked), np.float32).reshape(-1, DIMENSIONS), leaves))

    def place(rows: dict) -> dict:
        if not rows["id"]:
            return rows | {"leaf": [], "along": []}
        leaf, along = tree.value.place(np.array([vector(known.value, t, c) for t, c in zip(rows["terms"], rows["counts"], strict=True)]))
        return rows | {"leaf": leaf.tolist(), "along": along.astype(float).tolist()}

    return map_batches(salted, ORDERED, place, "terms")


class _Index:
    """BM25 postings of one shard, in arrays sorted by term, weighted by the corpus' statistics or else the shard's own."""

    def __init__(self, terms: list[np.ndarray], counts: list[np.ndarray], corpus: Statistics | None = None):
        n = len(terms)
        sizes = np.array([len(t) for t in terms])
        owner = np.repeat(np.arange(n), sizes)
        term = np.concatenate(terms) if n else np.zeros(0, np.int64)
        tf = np.concatenate(counts).astype(np.float64) if n else np.zeros(0)
        length = np.bincount(owner, tf, minlength=n)
        order = np.argsort(term, kind="stable")
        self.n, self.owner = n, owner[order]
        self.vocabulary, self.start = np.unique(term[order], return_index=True)
        self.end = np.append(self.start[1:], len(term))
        self.size = self.end - self.start
        if corpus is None:
            corpus = Statistics(n, max(length.mean(), 1.0) if n else 1.0, np.bincount(term))
        self.at = np.searchsorted(self.vocabulary, term)
        self.bounds = np.append(0, np.cumsum(sizes))
        self.weight = (corpus.saturated(tf, length[owner]) * corpus.idf(term))[order]
        # Weights of terms that many documents hold lie in rows of their own, which are added up at once.
        common = np.flatnonzero(DENSE * self.size > n)
        self.row = np.full(len(self.size), -1)
        self.row[common] = np.arange(len(common))
        self.rows = np.zeros((len(common), n))
        held = np.repeat(self.row, self.size)
        self.rows[held[held >= 0], self.owner[held >= 0]] = self.weight[held >= 0]

    def search(self, seed: int) -> np.ndarray:
        """BM25 score of every document for all terms of the seed; those without another holder can't rank any."""
        at = self.at[self.bounds[seed] : self.bounds[seed + 1]]
        at = at[self.size[at] > 1]
        row = self.row[at]
        score = self.rows[row[row >= 0]].sum(axis=0)
        begins, ends = self.start[at[row < 0]].tolist(), self.end[at[row < 0]].tolist()
        if begins:
            parts = [slice(a, b) for a, b in zip(begins, ends, strict=True)]
            score += np.bincount(np.concatenate([self.owner[p] for p in parts]), np.concatenate([self.weight[p] for p in parts]), minlength=self.n)
        return score


def ranked(score: np.ndarray) -> Iterator[int]:
    """Documents by falling score, equal ones in their order; most seeds need the first few only."""
    if len(score) > 4 * FIRST:
        least = np.partition(score, -FIRST)[-FIRST]
        few = np.flatnonzero(score >= least)
        yield from few[np.argsort(-score[few], kind="stable")].tolist()
        rest = np.flatnonzero(score < least)
        yield from rest[np.argsort(-score[rest], kind="stable")].tolist()
    else:
        yield from np.argsort(-score, kind="stable").tolist()


def pack_shard(first: int, docs: pd.DataFrame, corpus: Statistics | None = None) -> pd.DataFrame:
    """Pack one shard's documents into sequences numbered from ``first`` on; rows are sorted first."""
    docs = docs.sort_values(["id", "tokens", "grains"], kind="stable", na_position="first").reset_index(drop=True)
    n = len(docs)
    tokens = docs["tokens"].to_numpy()
    grains = [np.frombuffer(g, dtype="<u4") for g in docs["grains"]]
    index = _Index([np.frombuffer(t, dtype="<u4").astype(np.int64) for t in docs["terms"]], [np.frombuffer(c, dtype="<u4") for c in docs["counts"]], corpus)
    start = np.zeros(n, dtype=np.int64)
    pieces: list[tuple[int, int, int, int, int]] = []
    sequence = 0

    def take(d: int, length: int, offset: int) -> None:
        pieces.append((d, int(start[d]), length, sequence, offset))
        start[d] += length

    for d in range(n):
        while tokens[d] - start[d] >= WINDOW:
            take(d, WINDOW, 0)
            sequence += 1
    left = tokens - start
    for seed in np.argsort(-left, kind="stable").tolist():
        if left[seed] == 0:
            continue
        used = int(left[seed])
        take(seed, used, 0)
        left[seed] = 0
        if used < WINDOW and left.any():
            score = np.where(left > 0, index.search(seed), -1.0)
            for d in ranked(score):
                room = WINDOW - used
                if score[d] < 0 or room < GRAIN:
                    break
                length = int(left[d]) if left[d] <= room else room // GRAIN * GRAIN
                take(d, length, used)
                left[d] -= length
                used += length
            # What is left holds no grain: only whole rests that are as short fit, the best ranked first.
            while used < WINDOW and len(fit := np.flatnonzero((left > 0) & (left <= WINDOW - used))):
                d = int(fit[np.argmax(score[fit])])
                take(d, int(left[d]), used)
                used += int(left[d])
                left[d] = 0
        sequence += 1
    out = pd.DataFrame(pieces, columns=["row", "start", "length", "sequence_id", "offset"])
    rows = out["row"].to_numpy()
    crc = join_checksums([grains[d][s // GRAIN : -(-(s + k) // GRAIN)] for d, s, k, _, _ in pieces], out["length"].to_numpy())
    return pd.DataFrame({"doc_id": docs["id"].to_numpy()[rows] if n else [], "start": out["start"], "length": out["length"], "ids_crc32": crc, "doc_tokens": tokens[rows] if n else [], "sequence_id": out["sequence_id"] + first, "offset": out["offset"]})


PACKED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(df: DataFrame, path: str, id_column: str = "doc_id", text: str = "text", exact: bool = False) -> DataFrame:
    """Pieces of sequences of at most WINDOW tokens; each of a document's ids lies in one piece.

    Null texts count as empty, so they hold their end id alone.  Each row is packed, repeated rows too; ties are
    broken by id, length and content.  An empty table gives no piece.  Other columns are ignored.  A shard holds SHARD
    rows, at the end of a partition up to half as many more, so its memory and cost do not grow with the input; a
    seed's neighbours in other shards are not found.  ``exact`` makes one shard of the whole corpus, so that every
    seed ranks all unused documents: for a corpus that one task can hold.
    """
    profiles = cut(profile(df, path, id_column, text))
    corpus = statistics(profiles)
    known = df.sparkSession.sparkContext.broadcast(corpus)
    size = max(corpus.n, 1) if exact else SHARD
    arrow = to_arrow_schema(StructType.fromDDL(PACKED))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pd.DataFrame] = []
        held, first = 0, TaskContext.get().partitionId() << 40

        def packed(rows: pd.DataFrame) -> pa.RecordBatch:
            nonlocal first
            out = pack_shard(first, rows, known.value)
            first = int(out["sequence_id"].max()) + 1
            return pa.RecordBatch.from_pandas(out, schema=arrow, preserve_index=False)

        for batch in batches:
            waiting.append(batch.to_pandas())
            held += len(batch)
            if held > 2 * size:
                rows = pd.concat(waiting, ignore_index=True)
                while len(rows) > 2 * size:
                    yield packed(rows.iloc[:size])
                    rows = rows.iloc[size:]
                waiting, held = [rows], len(rows)
        if held:
            rows = pd.concat(waiting, ignore_index=True)
            if len(rows) > size + size // 2:
                yield packed(rows.iloc[:size])
                rows = rows.iloc[size:]
            yield packed(rows)

    placed = order(profiles, corpus, size)
    keys = ("leaf", "along", "salt")
    ranged = (placed.coalesce(1) if exact else placed.repartitionByRange(*keys)).sortWithinPartitions(*keys)
    return ranged.select("id", "tokens", "terms", "counts", "grains").mapInArrow(run, PACKED)


def sequences(pieces: DataFrame, df: DataFrame, path: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(sequence_id, ids): the token ids of each sequence, for writing out training files.

    Document ids must be unique here.
    """

    def run(rows: dict) -> dict:
        return {"id": rows["id"], "ids": [codec(path).encode(t or "") + END.to_bytes(4, "little") for t in rows["text"]]}

    ids = map_batches(df.select(F.col(id_column).cast("long").alias("id"), F.col(text).alias("text")), "id long, ids binary", run, "text")
    cut_out = pieces.join(ids, F.col("doc_id") == F.col("id")).select("sequence_id", "offset", F.expr("substring(ids, int(start * 4 + 1), int(length * 4))").alias("part"))

    def assemble(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"sequence_id": [key[0]], "ids": [b"".join(rows.sort_values("offset")["part"])]})

    return cut_out.groupBy("sequence_id").applyInPandas(assemble, "sequence_id long, ids binary")


