"""Near-duplicates: rows that repeat an id, clashing names, and families of many blocks against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tapelake.llm import near_duplicates
from tests.llm.test_operators import brute_components


def near(words, changed, mark):
    return " ".join([*words[: len(words) - changed], *(f"{mark}{i}" for i in range(changed))])


@pytest.fixture
def two_pairs():
    a, b = ([f"{x}{i}" for i in range(104)] for x in "ab")
    return [(1, " ".join(a)), (1, " ".join(b)), (2, near(a, 5, "x")), (3, near(b, 5, "y"))]


def test_one_id_with_two_texts(spark, two_pairs):
    df = spark.createDataFrame(two_pairs, "doc_id long, text string")
    got = near_duplicates.near_duplicates(df).collect()
    assert sorted((r["doc_id"], r["component_id"], r["kept"]) for r in got) == [(1, 1, True), (1, 1, True), (2, 1, False), (3, 1, False)]
    kept = sorted(r["text"] for r in near_duplicates.deduplicate(df).collect())
    assert kept == sorted(t for i, t in two_pairs if i == 1)


def test_deduplicate_keeps_one_row_of_a_group_and_any_columns(spark, two_pairs):
    rows = [*two_pairs, *two_pairs, (None, two_pairs[0][1]), (9, "alone in this corpus with its words"), (9, "alone in this corpus with its words"), (None, "no id and no neighbour at all"), (None, "no id and no neighbour at all"), (5, None), (5, None), (6, " \n")]
    names = ("_dropped", "id", "hash", "node", "component", "k1", "n", "_i", "_h", "_id", "first")
    df = spark.createDataFrame([(i, t, *range(len(names))) for i, t in rows], "doc_id long, text string, " + ", ".join(f"{n} long" for n in names))
    got = near_duplicates.deduplicate(df)
    assert got.columns == df.columns
    found = sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in got.collect()))
    want = [(1, two_pairs[0][1]), (1, two_pairs[1][1]), (9, "alone in this corpus with its words"), (None, "no id and no neighbour at all"), (5, ""), (5, ""), (6, " \n")]
    assert found == sorted((i is None, i or 0, t) for i, t in want)
    assert near_duplicates.deduplicate(df.limit(0)).count() == 0
    assert near_duplicates.deduplicate(df.repartition(1)).count() == len(want)


@pytest.mark.parametrize(("block", "percent"), [(256, 85), (1024, 80)])
def test_families_of_many_blocks(spark, monkeypatch, block, percent):
    """Near copies about hubs, chains that drift away from them, and texts that share half: no link is lost or made."""
    monkeypatch.setattr(near_duplicates, "BLOCK", block)
    rng = np.random.default_rng(block + percent)
    lexicon = [f"w{i}" for i in range(3000)]
    texts = []
    for _ in range(3):
        base = rng.choice(lexicon, 120).tolist()
        texts.append(" ".join(base))
        for _ in range(30):  # copies of the base, with two to five words changed
            copy = list(base)
            for at in rng.choice(120, int(rng.integers(1, 6)), replace=False):
                copy[at] = str(rng.choice(lexicon))
            texts.append(" ".join(copy))
        drift = list(base)
        for _ in range(12):  # each differs from the one before
            for at in rng.choice(120, 2, replace=False):
                drift[at] = str(rng.choice(lexicon))
            texts.append(" ".join(drift))
        for _ in range(8):
            texts.append(" ".join([*base[:80], *rng.choice(lexicon, 40).tolist()]))
    order = rng.permutation(len(texts))
    texts = [texts[i] for i in order]
    sets = [set(near_duplicates.shingles(t).tolist()) for t in texts]
    parent = list(range(len(texts)))
    for _ in range(8):
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if 100 * len(a & b) >= percent * len(a | b):
                    parent[i] = parent[j] = min(parent[i], parent[j])
    got = near_duplicates.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), percent=percent).orderBy("doc_id").collect()
    assert [r["component_id"] for r in got] == parent
    if percent == 85:
        assert brute_components(texts)[1] == parent


def test_filter_passes_every_key(spark):
    keys = spark.range(3000).select(F.col("id"), F.xxhash64("id").alias("hash")).unionByName(spark.range(1).select(F.lit(None).cast("long").alias("id"), F.lit(5).cast("long").alias("hash")))
    bits = near_duplicates._filter(keys)
    at = keys.select(F.pmod(F.xxhash64("id", "hash"), F.lit(64 * len(bits))).alias("at")).toPandas()["at"].to_numpy()
    assert ((bits[at >> 6] >> (at & 63)) & 1).all() and np.bitwise_count(bits).sum() < 0.1 * 64 * len(bits)
