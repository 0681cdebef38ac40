"""Sharding by a keyed permutation of global row numbers.

Rows are numbered 0..n-1 in the order of the sort columns, and a Feistel network with cycle walking permutes the
numbers.  Permuted number p goes to shard p mod k, slot p div k, so shard sizes differ by one at most and both the
place of a row and the row of a place can be computed without any lookup.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapelake.llm.common import cut

ROUNDS = 6
#: Multipliers of the public splitmix64 finaliser.
MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX[1])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX[2])
    return x ^ (x >> np.uint64(31))


def _keys(seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return _mix((np.arange(1, ROUNDS + 1, dtype=np.uint64) + np.uint64(seed)) * np.uint64(MIX[0]))


def _network(x: np.ndarray, half: np.uint64, keys: np.ndarray, inverse: bool) -> np.ndarray:
    mask = (np.uint64(1) << half) - np.uint64(1)
    left, right = x >> half, x & mask
    for key in keys[::-1] if inverse else keys:
        if inverse:
            left, right = right ^ (_mix(left ^ key) & mask), left
        else:
            left, right = right, left ^ (_mix(right ^ key) & mask)
    return (left << half) | right


def permute(numbers: np.ndarray, n: int, seed: int = 0, inverse: bool = False) -> np.ndarray:
    """Permute numbers below ``n``; walking the cycle until the value is below n again keeps it a bijection on 0..n-1."""
    half = np.uint64(max(1, ((n - 1).bit_length() + 1) // 2)) if n > 1 else np.uint64(1)
    keys = _keys(seed)
    out = np.asarray(numbers).astype(np.uint64)
    with np.errstate(over="ignore"):
        out = _network(out, half, keys, inverse)
        while (over := out >= np.uint64(max(n, 1))).any():
            out[over] = _network(out[over], half, keys, inverse)
    return out.astype(np.int64)


def _free(df: DataFrame, *names: str) -> list[str]:
    """Names like these that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def row_numbers(df: DataFrame, order: list[str], name: str = "row_number") -> tuple[DataFrame, int]:
    """Number the rows 0..n-1 in the order of ``order`` and return them with n.

    A range partitioning sorts at any size; a random last sort key splits runs of rows that are equal in ``order``,
    however long, over partitions.  The driver sees one count per partition and nothing else.
    """
    width = df.sparkSession.conf.get("spark.sql.shuffle.partitions")
    salt, part, within = _free(df, "salt", "part", "within")
    salted = df.withColumn(salt, F.rand(17))
    ranged = salted.repartitionByRange(int(width), *order, salt).sortWithinPartitions(*order, salt).drop(salt)
    at = F.monotonically_increasing_id()
    placed = cut(ranged).withColumns({part: F.shiftright(at, 33), within: at.bitwiseAND(F.lit((1 << 33) - 1))})
    counts = dict(placed.groupBy(part).count().collect())
    starts, total = [], 0
    for i in range(max(counts, default=-1) + 1):
        starts.append(total)
        total += counts.get(i, 0)
    offset = F.element_at(F.lit(np.array(starts or [0], dtype=np.int64)), (F.col(part) + 1).cast("int"))
    return placed.withColumn(name, offset + F.col(within)).drop(part, within), total


def shard(df: DataFrame, order: list[str], shards: int, seed: int = 0) -> DataFrame:
    """Add row_number, shard and slot.

    The order columns should tell rows apart; rows equal in all of them are interchangeable, so either may get either
    place.  Nulls sort first.  An empty table stays empty.  Columns of ``df`` keep their names; where one is named
    row_number, shard or slot, the new column of that name gets underscores before it.
    """
    number, to, slot, permuted = _free(df, "row_number", "shard", "slot", "permuted")
    numbered, total = row_numbers(df, order, number)

    @F.pandas_udf("long")
    def place(number: pd.Series) -> pd.Series:
        return pd.Series(permute(number.to_numpy(), total, seed))

    return numbered.withColumn(permuted, place(number)).withColumns({to: (F.col(permuted) % shards).cast("int"), slot: F.floor(F.col(permuted) / shards).cast("long")}).drop(permuted)


def locate(row_number: int, n: int, shards: int, seed: int = 0) -> tuple[int, int]:
    """(shard, slot) of a row number."""
    p = int(permute(np.array([row_number]), n, seed)[0])
    return p % shards, p // shards


def row_at(shard_number: int, slot: int, n: int, shards: int, seed: int = 0) -> int:
    """The row number that lies at a place."""
    return int(permute(np.array([slot * shards + shard_number]), n, seed, inverse=True)[0])
