"""MinHash near-duplicates, confirmed on full shingle sets.

A document's set holds the hashes of its distinct 5-word shingles.  Documents with equal sets form a class, which is
a node of the graph.  A class gets one-permutation hashes with optimal densification, banded into buckets; a bucket
gives star-shaped candidate edges, one from each member to the smallest, so the edges never exceed the members.  The
components of the candidate graph are families: every pair that shares a bucket lies within one.

Inside a family all links are found exactly.  A family is dealt into blocks of bounded size, and its hub, the node that
shares most buckets with others, meets every block.  Two nodes that are linked with the hub are connected already, and
as 1 - similarity is a metric, a pair with a node far from the hub needs no look if the other is near it.  So only
what is not linked with the hub meets the other blocks; of near copies of one text this is little, and the work grows
with their number and not with its square.  Components of the links give the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapelake.llm.common import ascii_words, cut, map_batches, steps

#: Words of a shingle, and the least Jaccard similarity of a link in hundredths where a caller names none.
WIDTH, PERCENT = 5, 85
#: Slots of a sketch, and the chance with which all bands of a pair of the least similarity may miss.
SLOTS, MISS = 240, 1e-7
#: Shingle hashes of a block, and bits at most of the filter that finds the texts of candidates.
BLOCK, FILTER = 1 << 15, 1 << 24
#: Edges that one task joins.
FINISH = 1 << 13
#: Words whose hash a worker keeps.
CACHE = 300_000
#: Attempts of the densification before it takes the first full slot.
ATTEMPTS = 4096


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < CACHE:
            self[word] = value
        return value


_HASHES = _Hashes()


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes; a text of fewer words is one shingle, one without words has none."""
    words = ascii_words(text)
    if not words:
        return np.zeros(0, dtype=np.uint64)
    hashes = np.fromiter(map(_HASHES.__getitem__, words), dtype=np.uint64, count=len(words))
    width = min(width, len(words))
    n = len(words) - width + 1
    out = np.full(n, width, dtype=np.uint64)
    for k in range(width):
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + n]
        out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    out *= np.uint64(0x94D049BB133111EB)
    out ^= out >> np.uint64(29)
    out.sort()
    return out[np.concatenate([[True], out[1:] != out[:-1]])]


@lru_cache(maxsize=1)
def _probes() -> np.ndarray:
    """Slot to try for each attempt and empty slot, the same for all documents."""
    return np.random.default_rng(11).integers(0, SLOTS, (ATTEMPTS, SLOTS))


def sketch(values: np.ndarray) -> np.ndarray:
    """One-permutation hashes: the least hash of each slot's range; an empty slot copies a full one found by probing."""
    slot = ((values >> np.uint64(32)) * np.uint64(SLOTS)) >> np.uint64(32)
    first = np.searchsorted(slot, np.arange(SLOTS, dtype=np.uint64))
    full = np.zeros(SLOTS, dtype=bool)
    full[slot.astype(np.int64)] = True
    out = values[np.minimum(first, len(values) - 1)].astype(np.uint32)
    empty = np.flatnonzero(~full)
    for probe in _probes():
        if not len(empty):
            return out
        hit = full[probe[empty]]
        out[empty[hit]] = out[probe[empty[hit]]]
        empty = empty[~hit]
    out[empty] = out[np.flatnonzero(full)[0]]
    return out


def set_key(values: np.ndarray) -> tuple[int, int]:
    """128-bit digest of a set as two signed longs."""
    digest = hashlib.blake2b(values.tobytes(), digest_size=16).digest()
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def _identified(df: DataFrame, id_column: str, text: str) -> DataFrame:
    """(id, hash, text): an id and a hash of the text tell rows apart that differ in either."""
    return df.select(F.col(id_column).cast("long").alias("id"), F.xxhash64(text).alias("hash"), F.col(text).alias("text"))


def sketches(df: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, hash, n_shingles, k1, k2, sketch): key and sketch are null for an empty set."""

    def run(rows: dict) -> dict:
        out: dict[str, list] = {"id": rows["id"], "hash": rows["hash"], "n_shingles": [], "k1": [], "k2": [], "sketch": []}
        for t in rows["text"]:
            values = shingles(t)
            k1, k2 = set_key(values) if len(values) else (None, None)
            for name, value in zip(("n_shingles", "k1", "k2", "sketch"), (len(values), k1, k2, sketch(values).tobytes() if len(values) else None), strict=True):
                out[name].append(value)
        return out

    return map_batches(_identified(df, id_column, text), "id long, hash long, n_shingles long, k1 long, k2 long, sketch binary", run, "text")


def classes_of(rows: DataFrame) -> DataFrame:
    """(node, k1, k2, at, n_shingles, sketch): a row for each distinct set, numbered, with one text that has it, stored."""
    at = F.min(F.struct("id", "hash")).alias("at")
    sets = rows.where("n_shingles > 0").groupBy("k1", "k2").agg(at, F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch"))
    return cut(sets).withColumn("node", F.monotonically_increasing_id())


def band_slots(percent: int) -> int:
    """Slots of a band: the most with which a pair of that similarity is missed by all bands with a chance below MISS."""
    fit = [w for w in range(1, SLOTS + 1) if SLOTS % w == 0 and (1 - (percent / 100) ** w) ** (SLOTS // w) < MISS]
    return max(fit, default=1)


def candidate_edges(classes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(a, b, weight), stored: each member of a bucket of two or more with the bucket's smallest node, itself included.

    ``weight`` sums the sizes of the buckets that give the edge.
    """
    band = band_slots(percent)
    wide = 4 * band
    hashes = F.array(*(F.xxhash64(F.substring("sketch", 1 + i * wide, wide), F.lit(i)) for i in range(SLOTS // band)))
    bands = classes.select("node", F.explode(hashes).alias("bucket"))
    stars = bands.groupBy("bucket").agg(F.min("node").alias("center"), F.count("node").alias("n")).where("n > 1")
    return cut(bands.join(stars, "bucket").groupBy(F.col("node").alias("a"), F.col("center").alias("b")).agg(F.sum("n").alias("weight")))


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(v, w) of a small graph's edges (a, b): each node and the smallest node of its component."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for batch in batches:
        for a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    yield pa.RecordBatch.from_arrays([pa.array(list(parent), pa.int64()), pa.array([root(x) for x in parent], pa.int64())], names=["v", "w"])


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of (a, b); the component is named by its smallest node.

    Contraction: each round every node moves to the least of itself and its neighbours, then the graph of the moved
    nodes is taken.  Odd rounds order nodes by id, which ends a star about its smallest node at once; even rounds
    order them by a random rank, which shrinks a graph of any shape by a constant factor, so that rounds grow with
    the logarithm of its size.  When FINISH edges or fewer are left, which is counted, one task joins them.
    """
    both = cut(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct())
    rounds: list[DataFrame] = []
    while both.count() > FINISH:
        turn = F.lit(len(rounds))

        def rank(column: str, turn: F.Column = turn) -> F.Column:
            return F.struct((F.xxhash64(F.col(column), turn) if len(rounds) % 2 else F.lit(0)).alias("r"), F.col(column).alias("v"))

        moves = cut(both.groupBy("a").agg(F.least(F.min(rank("b")), F.min(rank("a"))).alias("m")).select(F.col("a").alias("v"), F.col("m.v").alias("w")))
        left = both.join(moves.select(F.col("v").alias("a"), F.col("w").alias("x")), "a").select("x", "b")
        both = cut(left.join(moves.select(F.col("v").alias("b"), F.col("w").alias("y")), "b").where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct())
        rounds.append(moves)
    rounds.append(both.coalesce(1).mapInArrow(_finish, "v long, w long"))
    mapping = rounds[0].select(F.col("v").alias("node"), F.col("w").alias("to"))
    for moves in rounds[1:]:
        mapping = mapping.join(moves, mapping["to"] == moves["v"], "left").select("node", F.coalesce("w", "to").alias("to"))
    names = mapping.groupBy("to").agg(F.min("node").alias("component"))
    return cut(mapping.join(names, "to").select("node", "component"))


def block_links(ids: np.ndarray, sets: list[np.ndarray], side: np.ndarray, cross: bool, percent: int = PERCENT) -> list[tuple[int, int]]:
    """(member, smallest member) of what is linked among the sets, or between the two sides, by exact comparison; ``ids`` ascend.

    Shingles are ordered by how many of the sets hold them.  Two sets with the similarity asked for share a shingle
    among the first n - ceil(percent n / 100) + 1 of each, so only sets that meet there are compared, and none that
    are connected already.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(n), sizes)
    code, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)[1:]
    rank = np.empty(len(held), dtype=np.int64)
    rank[np.argsort(held, kind="stable")] = np.arange(len(held))
    code = rank[code.reshape(-1)]
    order = np.lexsort((code, owner))
    code = code[order]
    start = np.cumsum(sizes) - sizes
    prefix = sizes - -(-percent * sizes // 100) + 1
    short = np.arange(len(code)) - np.repeat(start, sizes) < np.repeat(prefix, sizes)
    if cross:
        listed = short & (side[owner] == 1)
    else:
        listed = short
    by = np.argsort(code[listed], kind="stable")
    post, key = owner[listed][by], code[listed][by]
    component = np.arange(n)
    mark = np.zeros(len(held), dtype=bool)
    for x in np.flatnonzero(side == 0) if cross else range(n):
        mine = code[start[x] : start[x] + sizes[x]]
        lo, hi = np.searchsorted(key, mine[: prefix[x]], "left"), np.searchsorted(key, mine[: prefix[x]], "right")
        met = _slices(post, lo, hi - lo)
        met = np.unique(met[component[met] != component[x]])
        met = met[(100 * np.minimum(sizes[met], sizes[x]) >= percent * np.maximum(sizes[met], sizes[x]))]
        if not len(met):
            continue
        mark[mine] = True
        shared = np.add.reduceat(mark[_slices(code, start[met], sizes[met])].astype(np.int64), np.cumsum(sizes[met]) - sizes[met])
        mark[mine] = False
        for y in met[100 * shared >= percent * (sizes[met] + sizes[x] - shared)]:
            if component[y] != component[x]:
                one, two = sorted((component[x], component[y]))
                component[component == two] = one
    least = ids[component]
    return [(int(a), int(b)) for a, b in zip(ids, least, strict=True) if a != b]


def _slices(values: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The slices values[start:start + size] one after another."""
    return values[np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]


def _filter(keys: DataFrame) -> np.ndarray:
    """Bits of a hash of (id, hash) of every row, FILTER of them at most: the driver gets one number for each 64."""
    bits = min(FILTER, 1 << max(10, int(16 * keys.count()).bit_length()))
    place = F.pmod(F.xxhash64("id", "hash"), F.lit(bits))
    words = keys.select(F.shiftright(place, 6).alias("w"), F.expr(f"shiftleft(1L, cast(pmod(xxhash64(id, hash), {bits}) % 64 as int))").alias("b"))
    out = np.zeros(bits // 64, dtype=np.int64)
    for r in words.groupBy("w").agg(F.bit_or("b").alias("b")).collect():
        out[r["w"]] = r["b"]
    return out


def _sets(docs: DataFrame, placed: DataFrame, id_column: str, text: str) -> DataFrame:
    """``placed`` with the set of each node, stored.  Sets are made where the texts lie, and only of candidates' texts."""
    bits = _filter(placed.select("id", "hash"))
    held = docs.sparkSession.sparkContext.broadcast(bits)
    mask = 64 * len(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(3).to_numpy(zero_copy_only=False)
            few = batch.filter(pa.array((held.value[at >> 6] >> (at & 63)) & 1 == 1))
            for part in steps(few, "text"):
                made = [shingles(t) for t in part.column(2).to_pylist()]
                keys = [set_key(v) for v in made]
                columns = [part.column(0), part.column(1), pa.array([k for k, _ in keys], pa.int64()), pa.array([k for _, k in keys], pa.int64()), pa.array([v.tobytes() for v in made], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "hash", "k1", "k2", "members"])

    texts = _identified(docs, id_column, text).withColumn("at", F.pmod(F.xxhash64("id", "hash"), F.lit(mask)))
    made = texts.mapInArrow(run, "id long, hash long, k1 long, k2 long, members binary").withColumnRenamed("k1", "s1").withColumnRenamed("k2", "s2")
    met = placed.alias("p").join(made.alias("m"), F.expr("p.id <=> m.id and p.hash = m.hash and p.k1 = m.s1 and p.k2 = m.s2"))
    return cut(met.select("node", "family", "block", "blocks", "hub", "members"))


def _members(rows: pd.DataFrame) -> list[np.ndarray]:
    return [np.frombuffer(m, dtype=np.uint64) for m in rows["members"]]


def links(docs: DataFrame, classes: DataFrame, id_column: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """(a, b): links between nodes, enough of them to connect all that are linked."""
    edges = candidate_edges(classes, percent)
    families = components(edges.select("a", "b")).select("node", F.col("component").alias("family"))
    degrees = edges.groupBy(F.col("a").alias("node")).agg(F.sum("weight").alias("degree"))
    members = cut(families.join(degrees, "node").join(classes.select("node", F.col("at.id").alias("id"), F.col("at.hash").alias("hash"), "n_shingles", "k1", "k2"), "node"))
    # What is counted by family is stored before it is joined, so that a very large family is a skewed join alone.
    sizes = cut(members.groupBy("family").agg(F.ceil(F.sum("n_shingles") / BLOCK).cast("int").alias("blocks"), F.max_by("node", F.struct("degree", "node")).alias("hub")))
    placed = members.join(sizes, "family").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    sets = _sets(docs, placed, id_column, text)

    def within(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        """Links of a block and the hub; ``away`` marks nodes that are not linked with the hub."""
        rows = rows.drop_duplicates("node").sort_values("node")
        held, nodes = _members(rows), rows["node"].to_numpy()
        near = dict(block_links(nodes, held, np.zeros(len(nodes), dtype=int), False, percent))
        away = np.zeros(len(nodes), dtype=bool)
        if rows["blocks"].iloc[0] > 1:
            hub = held[int(np.flatnonzero(nodes == rows["hub"].iloc[0])[0])]
            shared = np.array([np.isin(h, hub, assume_unique=True).sum() for h in held])
            sizes = np.array([len(h) for h in held])
            away = 100 * shared < percent * (sizes + len(hub) - shared)
        return pd.DataFrame({"family": key[0], "node": nodes, "to": [near.get(n, n) for n in nodes.tolist()], "away": away, "size": [len(h) for h in held]})

    hubs = sets.where("node = hub and blocks > 1").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    inner = cut(sets.unionByName(hubs).groupBy("family", "block").applyInPandas(within, "family long, node long, to long, away boolean, size long"))
    found = inner.where("node <> to").select(F.col("node").alias("a"), F.col("to").alias("b"))
    away = cut(inner.where("away").select("family", "node", "size").distinct())
    if away.isEmpty():
        return found
    chunks = cut(away.groupBy("family").agg(F.ceil(F.sum("size") / BLOCK).cast("int").alias("chunks")))

    def across(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates(["node", "side"]).sort_values(["node", "side"])
        return pd.DataFrame(block_links(rows["node"].to_numpy(), _members(rows), rows["side"].to_numpy(), True, percent), columns=["a", "b"])

    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = sets.join(chunks, "family").select("family", "block", every("chunks").alias("chunk"), "node", "members", F.lit(0).alias("side"))
    apart = sets.join(away.select("node"), "node").join(chunks, "family").withColumn("chunk", F.pmod(F.xxhash64("node", F.lit(1)), F.col("chunks")).cast("int"))
    sent = apart.select("family", every("blocks").alias("block"), "chunk", "node", "members", F.lit(1).alias("side"))
    # The joins deal by family; without a deal of their own all tiles of a family would stay in one task.
    tiles = own.unionByName(sent).repartition("family", "block", "chunk")
    return found.unionByName(tiles.groupBy("family", "block", "chunk").applyInPandas(across, "a long, b long"))


def _named(docs: DataFrame, id_column: str, text: str, percent: int) -> DataFrame:
    """(id, hash, n_shingles, k1, k2, node, component) of every row; the last two are null for an empty set."""
    rows = cut(sketches(docs, id_column, text))
    classes = classes_of(rows)
    joined = components(links(docs, classes, id_column, text, percent)).withColumnRenamed("node", "linked")
    named = classes.join(joined, F.col("node") == F.col("linked"), "left").select("k1", "k2", F.coalesce("component", "node").alias("component"))
    return rows.drop("sketch").join(named, ["k1", "k2"], "left")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row; kept marks one document of each component.

    Sets are linked from a Jaccard similarity of ``percent`` hundredths on.
    Null texts and texts without words have empty sets and are linked with nothing.  Rows that repeat an id share
    its verdict if their texts agree; with differing texts each row follows its own text.  A row with a null id is
    linked like any other but never names a component; without a neighbour that has an id its component is null and
    it is kept.  Other columns are ignored.
    """
    rows = _named(docs, id_column, text, percent)
    # Stored, so that a component with very many rows is a skewed join and not a part of the counting.
    names = cut(rows.where("component is not null").groupBy("component").agg(F.min("id").alias("least")))
    component = F.when(F.col("component").isNull(), F.col("id")).otherwise(F.col("least"))
    out = rows.join(names, "component", "left").select("id", "n_shingles", component.alias("component_id"))
    return out.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def deduplicate(docs: DataFrame, id_column: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs``, all columns, with exactly one row of each component and every row without words.

    A component keeps its smallest id, a null id only if there is no other, and of rows that repeat it the one with
    the least hash of its text; of rows that agree in id and text any one.  Names of columns may be anything.
    """
    rows = cut(_named(docs, id_column, text, percent).where("component is not null").groupBy("component", "id", "hash").agg(F.count("*").alias("n")))
    first = cut(rows.groupBy("component").agg(F.min(F.struct(F.col("id").isNull().alias("without"), "id", "hash")).alias("first")))
    judged = rows.join(first, "component").select("id", "hash", "n", F.expr("id <=> first.id and hash = first.hash").alias("stays"))
    own_id, own_hash = (f"_{name}_{len(''.join(docs.columns))}" for name in ("id", "hash"))  # longer than any column together
    known = docs.withColumns({own_id: F.col(id_column).cast("long"), own_hash: F.xxhash64(text)})

    def having(what: DataFrame, how: str) -> DataFrame:
        what = what.select(F.col("id").alias("_i"), F.col("hash").alias("_h"))
        return known.join(what, known[own_id].eqNullSafe(what["_i"]) & (known[own_hash] == what["_h"]), how)

    repeated = cut(judged.where("stays and n > 1"))
    if repeated.isEmpty():
        return having(judged.where("not stays"), "left_anti").drop(own_id, own_hash)
    once = having(judged.where("not stays or n > 1"), "left_anti")
    return once.unionByName(having(repeated, "left_semi").dropDuplicates([own_id, own_hash])).drop(own_id, own_hash)
