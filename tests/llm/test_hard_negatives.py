"""Hard negatives against brute force, ties, hot labels and hard inputs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tapelake.llm import hard_negatives
from tapelake.llm.queries import QUERIES

SCHEMA = "id long, label int, vector array<long>, anchor_id string, score string, block int"


def expected(rows, chosen, positives=5, negatives=5):
    rows = [(i, c, v) for i, c, v in rows if i is not None and c is not None and v is not None and None not in v]
    anchors = {}
    for i, c, v in rows:
        if chosen(i):
            anchors[i] = min(anchors.get(i, (c, v)), (c, v))
    out = []
    for i, (c, v) in anchors.items():
        met = sorted((-sum(x * y for x, y in zip(v, w)), j, d) for j, d, w in rows if len(w) == len(v))
        for p, j, _ in [m for m in met if m[2] == c and m[1] != i][:positives]:
            band = [(n, k) for n, k, d in met if d != c and 80 * -p <= 100 * -n <= 100 * -p][:negatives]
            out += [(i, j, r + 1, k, -p, -n) for r, (n, k) in enumerate(band)]
    return sorted(out)


def run(spark, rows, monkeypatch=None, **sizes):
    df = spark.createDataFrame([(*r, "clash", "clash", 1) for r in rows], SCHEMA).repartition(3)
    return sorted(tuple(r) for r in hard_negatives.mine(df, F.col("id") % 10 == 0).collect())


@pytest.mark.parametrize("block", [7, 1 << 15])
def test_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(hard_negatives, "ROWS", block)
    monkeypatch.setattr(hard_negatives, "ANCHORS", max(3, block // 2))
    monkeypatch.setattr(hard_negatives, "LEAST", 5)
    random.seed(3)
    rows = [(i, 1 if i % 3 == 0 else random.randrange(4), [random.randrange(-3, 4) for _ in range(4)]) for i in range(90)]
    rows += [(200 + i, i % 3, [1, 2, 0, 1]) for i in range(30)]  # copies: ties everywhere
    rows += [(-10, 0, [1, 1, 1, 1]), (1000, 2, [1, 2]), (1001, 2, [1, 2]), (1002, 3, [1, 2]), (300, 0, []), (301, 0, []), (302, 1, [])]
    rows += [(None, 1, [1, 1, 1, 1]), (5000, None, [1, 1, 1, 1]), (5010, 1, None), (5020, 1, [1, None, 1, 1])]
    rows += [(20, 2, [3, 3, 3, 3]), (20, 2, [3, 3, 3, 3]), (41, 1, [2, 2, 2, 2]), (41, 1, [2, 2, 2, 2])]  # repeated ids
    assert run(spark, rows) == expected(rows, lambda i: i % 10 == 0)


def test_nothing_to_mine(spark):
    assert run(spark, [(1, 1, [1]), (2, 1, [2])]) == []
    assert run(spark, [(10, 1, [1]), (20, 2, [2])]) == []
    df = spark.createDataFrame([], SCHEMA)
    assert hard_negatives.mine(df, F.col("id") % 10 == 0).count() == 0


def test_large_numbers(spark):
    assert hard_negatives.scores(np.array([[1 << 20, 1]]), np.array([[1 << 20, 1]])).tolist() == [[(1 << 40) + 1]]
    assert hard_negatives.scores(np.array([[1 << 30, 1]]), np.array([[1 << 30, 1]])).tolist() == [[(1 << 60) + 1]]
    with pytest.raises(OverflowError):
        hard_negatives.scores(np.array([[1 << 40]]), np.array([[1 << 40]]))
    big = [(10, 1, [1 << 28, 3]), (11, 1, [1 << 28, 2]), (12, 2, [1 << 28, 1]), (13, 2, [1 << 28, 2]), (14, 2, [1 << 28, 4])]
    assert run(spark, big) == expected(big, lambda i: i % 10 == 0)


def test_stream_holds_open_windows_only():
    keys = [hard_negatives.packed((1, s, i, kind)) for s, kind, i in [(100, 0, 7), (100, 1, 3), (90, 1, 4), (85, 0, 8), (80, 1, 5), (79, 1, 6), (10, 1, 9)]]
    assert list(hard_negatives.stream(iter(keys), 5, 80, 100)) == [(1, 7, 1, 3, 100, 100), (1, 7, 2, 4, 100, 90), (1, 7, 3, 5, 100, 80), (1, 8, 1, 5, 85, 80), (1, 8, 2, 6, 85, 79)]


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r["vec_id"], (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"], [math.floor(256 * x) for x in r["embedding"]]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = sorted(tuple(r) for r in QUERIES["op12_hard_negatives"](spark, sf).collect())
    assert got and got == expected(rows, lambda i: i % 100 == 0)


def test_query_leaves_out_odd_rows(spark, tmp_path):
    nan = float("nan")
    rows = [(0, 1, [1.0, 0.5]), (1, 1, [0.9, 0.5]), (2, 2, [0.9, 0.4]), (3, 2, [0.9, nan]), (4, 2, [float("inf"), 1.0]), (5, 2, [None, 1.0]), (6, 2, None), (8, None, [1.0, 1.0])]
    spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    got = [tuple(r) for r in QUERIES["op12_hard_negatives"](spark, str(tmp_path)).collect()]
    # Row 0 is divisible by 7 too, so that its label becomes 2: row 2 is its positive and row 1 the other label.
    assert got == [] or all(r[3] == 1 for r in got)
    assert expected([(0, 2, [256, 128]), (1, 1, [230, 128]), (2, 2, [230, 102])], lambda i: i == 0) == sorted(got)
