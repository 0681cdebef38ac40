"""Hard negatives: for each anchor and each of its nearest rows of the same label, the nearest rows of other labels in a band below.

Anchors meet all rows in tiles, a block of either side, whose scores one matrix product gives.  A tile keeps what can
still be among the first of an anchor, so that few scores travel.  Those are shuffled once under packed keys (anchor,
descending score, id), and each partition is read as a stream in that order: positives open windows, negatives fill them.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapelake.llm.common import cut

#: Rows of a block, anchors of a block, rows that a block has at least where there are more tasks than blocks, and scores that a task holds at once.
ROWS, ANCHORS, LEAST, SLAB = 1 << 15, 1 << 14, 1 << 10, 1 << 21
#: Anchor, score counted down, 0 for a positive and 1 for a negative, id; so positives come first among equal scores.
KEY = struct.Struct(">QQBQ")
SIGN = 1 << 63
BLOCK = "block long, n long, ids binary, labels binary, sizes binary, kind string, vectors binary, windows binary"
NO_WINDOW = -1


def _blocks(rows: DataFrame, count: int, width: int) -> DataFrame:
    """Rows (id, label, vector, windows) dealt evenly to ``count`` blocks, whatever they hold; a block's arrays are in the order of its ids."""
    arrow = _arrow(BLOCK)

    def pack(group: pa.Table) -> pa.Table:
        ids, labels = (group.column(c).combine_chunks().to_numpy(zero_copy_only=False).astype(np.int64) for c in ("id", "label"))
        order = np.lexsort((labels, ids))
        taken = group.take(pa.array(order)).combine_chunks()
        vectors, windows = taken.column("vector").combine_chunks(), taken.column("windows").to_pylist()
        flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        kind = next(k for k in (np.int16, np.int32, np.int64) if not len(flat) or (flat.min() >= np.iinfo(k).min and flat.max() <= np.iinfo(k).max))
        opened = np.full((len(order), width), NO_WINDOW, dtype=np.int64)
        for i, w in enumerate(windows):
            opened[i, : len(w or [])] = w or []
        sizes = np.diff(vectors.offsets.to_numpy()).astype(np.int64)
        arrays = [ids[order], labels[order], sizes, flat.astype(kind), opened]
        values = [group.column("block")[0].as_py(), len(order), *(x.tobytes() for x in arrays[:3]), np.dtype(kind).str, *(x.tobytes() for x in arrays[3:])]
        return pa.table([pa.array([v], f.type) for v, f in zip(values, arrow, strict=True)], schema=arrow)

    dealt = rows.withColumn("block", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(count)))
    return cut(dealt.groupBy("block").applyInArrow(pack, BLOCK))


def _arrow(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


class _Side:
    """One block of a tile."""

    def __init__(self, r: dict):
        self.ids, self.labels, self.sizes, self.windows = (np.frombuffer(r[c], dtype=np.int64) for c in ("ids", "labels", "sizes", "windows"))
        self.windows = self.windows.reshape(len(self.ids), -1)
        self.flat = np.frombuffer(r["vectors"], dtype=np.dtype(r["kind"]))
        self.starts = np.cumsum(self.sizes) - self.sizes

    def vectors(self, at: np.ndarray, size: int) -> np.ndarray:
        return self.flat[self.starts[at][:, None] + np.arange(size)]


def _most(x: np.ndarray) -> int:
    return max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact: in the smallest numbers that hold every partial sum."""
    most = _most(a) * _most(b) * a.shape[1]
    if most >= SIGN:
        raise OverflowError("scores don't fit into 64 bits")
    kind = np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64
    return (a.astype(kind) @ b.astype(kind).T).astype(np.int64)


def _first(found: np.ndarray, at: np.ndarray, most: int) -> np.ndarray:
    """The ``most`` places of ``at`` with the highest scores, lower places first among equal ones."""
    if len(at) > most:
        least = np.partition(found[at], len(at) - most)[len(at) - most]
        at = at[found[at] >= least]
    return at[np.argsort(-found[at], kind="stable")][:most]


def _tile(anchors: _Side, rows: _Side, pick) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(anchor, scores, ids) of the places in ``rows`` that ``pick`` chooses for each anchor; vectors of other lengths don't meet."""
    for size in np.unique(anchors.sizes).tolist():
        own, others = np.flatnonzero(anchors.sizes == size), np.flatnonzero(rows.sizes == size)
        if not len(others):
            continue
        right, ids, labels = rows.vectors(others, size), rows.ids[others], rows.labels[others]
        by_label = {int(v): np.flatnonzero(labels == v) for v in np.unique(labels)}
        step = max(1, SLAB // len(others))
        for i in range(0, len(own), step):
            some = own[i : i + step]
            for k, found in zip(some.tolist(), scores(anchors.vectors(some, size), right), strict=True):
                at = pick(anchors, k, found, ids, labels, by_label)
                if len(at):
                    yield int(anchors.ids[k]), found[at], ids[at]


def _meet(rows: DataFrame, anchors: DataFrame, count: int, anchor_count: int, pick) -> DataFrame:
    """(anchor, score, id) that ``pick`` chooses from each pair of blocks; every pair is a row of its own in one join."""
    schema = "anchor long, score long, id long"
    sides = [c.partition(" ")[0] for c in BLOCK.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                r = batch.slice(at, 1).to_pylist()[0]
                out = list(_tile(_Side({c: r[f"a_{c}"] for c in sides}), _Side({c: r[f"r_{c}"] for c in sides}), pick))
                if out:
                    columns = np.repeat([a for a, _, _ in out], [len(s) for _, s, _ in out]), np.concatenate([s for _, s, _ in out]), np.concatenate([i for _, _, i in out])
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["anchor", "score", "id"])

    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.select(*(F.col(c).alias(f"r_{c}") for c in sides), every(anchor_count).alias("with"))
    right = anchors.select(*(F.col(c).alias(f"a_{c}") for c in sides), every(count).alias("of"))
    met = left.join(right, (F.col("r_block") == F.col("of")) & (F.col("with") == F.col("a_block")))
    return met.select(*(f"{side}_{c}" for side in "ra" for c in sides)).mapInArrow(run, schema)


def packed(row: tuple[int, int, int, int]) -> tuple[bytes, None]:
    """The key of (anchor, score, id, kind)."""
    anchor, score, place, kind = row
    return KEY.pack(anchor + SIGN, SIGN - 1 - score, kind, place + SIGN), None


def lane(key: bytes) -> int:
    """What deals keys to partitions: a hash of their anchor."""
    return zlib.crc32(key[:8])


def stream(keys: Iterator[tuple[bytes, None]], negatives: int, low: int, high: int) -> Iterator[tuple[int, int, int, int, int, int]]:
    """Rows (anchor, positive, rank, negative, positive score, negative score) from sorted keys; only open windows are held."""
    anchor, windows = None, []
    for key, _ in keys:
        own, down, kind, place = KEY.unpack(key)
        score, place = SIGN - 1 - down, place - SIGN
        if own != anchor:
            anchor, windows = own, []
        if kind == 0:
            windows.append([place, score, 0])
            continue
        windows = [w for w in windows if w[2] < negatives and low * w[1] <= high * score]
        for w in windows:
            w[2] += 1
            yield own - SIGN, w[0], w[2], place, w[1], score


def mine(rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) from ``rows`` (id long, label long, vector array<long>).

    Anchors are the rows where ``anchors`` holds.  A score is the inner product with the anchor; higher ones come first,
    smaller ids first among equal ones.  An anchor's positives are its first ``positives`` other rows of its label; for each,
    the first ``negatives`` rows of other labels with low * positive score <= high * negative score <= high * positive
    score are ranked from 1.  low must be less than high, so a positive of negative score has no negatives.

    Rows with a null id, label, vector or component take no part.  Vectors of different lengths don't meet.  Rows that
    repeat an id are candidates each and can appear each, but never as positives of that id; as an anchor the least by label
    and vector stands for them.  An empty table, or one without anchors, gives no row.  Scores beyond 64 bits make the job
    fail.  Other columns are ignored.  ``rows`` should come from files, as rows are dealt by their place in the input.
    """
    spark = rows.sparkSession
    if not low < high:
        raise ValueError("low must be less than high")
    whole = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & F.forall("vector", lambda x: x.isNotNull()))
    whole = whole.select(F.col("id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), F.col("vector").cast("array<long>").alias("vector"), F.coalesce(anchors, F.lit(False)).alias("chosen"))
    chosen = cut(whole.where("chosen").groupBy("id").agg(F.min(F.struct("label", "vector")).alias("x")).select("id", "x.label", "x.vector"))
    n, many = whole.count(), chosen.count()
    if not many:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    tasks = spark.sparkContext.defaultParallelism
    count, anchor_count = max(-(-n // ROWS), min(tasks, -(-n // LEAST))), -(-many // ANCHORS)
    none = F.array().cast("array<long>").alias("windows")
    row_blocks = _blocks(whole.select("id", "label", "vector", none), count, 0)

    def same_label(a: _Side, k: int, found: np.ndarray, ids: np.ndarray, labels: np.ndarray, by_label: dict) -> np.ndarray:
        at = by_label.get(int(a.labels[k]), np.zeros(0, dtype=np.int64))
        return _first(found, at[ids[at] != a.ids[k]], positives)

    def in_windows(a: _Side, k: int, found: np.ndarray, ids: np.ndarray, labels: np.ndarray, by_label: dict) -> np.ndarray:
        tops = sorted({int(p) for p in a.windows[k] if p >= 0}, reverse=True)
        if not tops:
            return np.zeros(0, dtype=np.int64)
        least = [-(-low * p // high) for p in tops]
        at = np.flatnonzero((found >= least[-1]) & (found <= tops[0]) & (labels != a.labels[k]))
        at = at[np.argsort(-found[at], kind="stable")]
        down = -found[at]
        kept = [at[x : min(x + negatives, y)] for x, y in zip(np.searchsorted(down, [-p for p in tops], "left").tolist(), np.searchsorted(down, [-p for p in least], "right").tolist(), strict=True)]
        return np.unique(np.concatenate(kept))

    first = Window.partitionBy("anchor").orderBy(F.desc("score"), "id")
    near = _meet(row_blocks, _blocks(chosen.select("*", none), anchor_count, 0), count, anchor_count, same_label)
    opened = cut(near.withColumn("place", F.row_number().over(first)).where(F.col("place") <= positives).drop("place"))
    windows = opened.groupBy("anchor").agg(F.collect_list("score").alias("windows"))
    banded = _blocks(chosen.join(windows, F.col("id") == F.col("anchor")).select("id", "label", "vector", "windows"), anchor_count, positives)
    far = _meet(row_blocks, banded, count, anchor_count, in_windows)
    entries = opened.select("anchor", "score", "id", F.lit(0).alias("kind")).unionByName(far.withColumn("kind", F.lit(1)))

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = entries.rdd.map(packed).repartitionAndSortWithinPartitions(tasks, lane)
    mined = ordered.mapPartitions(lambda pairs: stream(pairs, negatives, low, high))
    return spark.createDataFrame(mined, "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
