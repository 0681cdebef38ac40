"""The corpus operators do the whole job: each test holds what an earlier version cut."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

import corpus_pipeline
from tapelake.llm import near_duplicates, packing, quality_rules
from tapelake.llm.queries import vocabulary_file


def copies(spark, changed):
    """Two texts of 100 shingles each that share all but ``changed``."""
    words = [f"w{i}" for i in range(104)]
    texts = [" ".join(words), " ".join(words[: 104 - changed] + [f"x{i}" for i in range(changed)])]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_pipeline_links_from_80_percent(spark):
    near = copies(spark, 10)  # 90 of 110 shared: 0.818
    assert corpus_pipeline.drop_near_duplicates(spark, near, "").count() == 1
    assert near_duplicates.deduplicate(near, percent=85).count() == 2
    assert corpus_pipeline.drop_near_duplicates(spark, copies(spark, 12), "").count() == 2  # 88 of 112: 0.786
    assert [near_duplicates.band_slots(p) for p in (85, 80)] == [6, 5]


def test_pipeline_keeps_clean_text_of_any_length(spark):
    text = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(1_000_001)), lambda i: i.cast("string")), " ")
    docs = spark.range(1).select(F.col("id").alias("doc_id"), text.alias("text"))
    assert corpus_pipeline.apply_rules(spark, docs, "").count() == 1
    assert quality_rules.assess(docs).first()["kept"]


def profiles(rows):
    """Rows as ``packing.profile`` gives them, from (id, tokens, {term: count})."""
    packed = [(i, n, np.array(sorted(t), "<u4").tobytes(), np.array([t[k] for k in sorted(t)], "<u4").tobytes(), bytes(4 * -(-n // packing.GRAIN))) for i, n, t in rows]
    return pd.DataFrame(packed, columns=["id", "tokens", "terms", "counts", "grains"])


def test_packing_searches_with_all_terms_of_a_seed():
    seed = {term: 10 for term in range(60)} | {100: 1}
    got = packing.pack_shard(0, profiles([(1, 3000, seed), (2, 1500, {200: 9}), (3, 1400, {100: 9, 201: 9})]))
    assert got[got["sequence_id"] == 0]["doc_id"].tolist() == [1, 3]


def test_packing_counts_every_occurrence(spark):
    text = "word " * 1000
    row = packing.profile(spark.createDataFrame([(1, text)], "doc_id long, text string"), vocabulary_file("word_bpe_49k.json")).first()
    assert np.frombuffer(row["counts"], "<u4").sum() == row["tokens"] - 1 >= 1000


def test_packing_orders_by_content_with_statistics_of_the_corpus(spark):
    topics, n = 8, 4 * packing.SHARD
    rng = np.random.default_rng(1)
    made = profiles([(i, 31, dict.fromkeys(rng.choice(np.arange(40 * (i % topics), 40 * (i % topics) + 40), 30, replace=False).tolist(), 1)) for i in range(n)])
    df = spark.createDataFrame(made, "id long, tokens long, terms binary, counts binary, grains binary").repartition(3)
    corpus = packing.statistics(df)
    assert (corpus.n, corpus.mean, int(corpus.held.sum()), len(corpus.held)) == (n, 30.0, 30 * n, 40 * topics)
    placed = packing.order(df, corpus).select("id", "leaf", "along", "salt").toPandas().sort_values(["leaf", "along", "salt"]).reset_index()
    assert len(placed) == n and placed["salt"].nunique() == n
    shard = placed.index // packing.SHARD
    together = sum((shard[placed["id"] % topics == t].value_counts() ** 2).sum() for t in range(topics)) / topics / (n / topics) ** 2
    assert together > 0.4  # a hash gives 0.25
    assert packing.statistics(df.limit(0)).n == 0


def test_packing_spreads_equal_rows(spark):
    n, keys = 100_000, ("leaf", "along", "salt")
    docs = spark.range(n).select(F.lit(1).alias("doc_id"), F.lit("one text for all of these rows").alias("text"))
    held = packing.profile(docs.repartition(4), vocabulary_file("word_bpe_49k.json"))
    parts = packing.order(held, packing.statistics(held)).repartitionByRange(8, *keys).groupBy(F.spark_partition_id()).count().toPandas()["count"]
    assert parts.sum() == n and parts.max() < 2 * n / 8


def brute_bm25(docs, seed):
    n, mean = len(docs), sum(sum(d.values()) for d in docs) / len(docs)
    held = {t: sum(t in d for d in docs) for d in docs for t in d}
    idf = lambda t: np.log(1 + (n - held[t] + 0.5) / (held[t] + 0.5))
    norm = lambda d: packing.K1 * (1 - packing.B + packing.B * sum(d.values()) / mean)
    return [sum(idf(t) * d[t] * (packing.K1 + 1) / (d[t] + norm(d)) for t in seed if t in d) for d in docs]


def made_documents(n, rng):
    return [dict(zip((rng.zipf(1.3, 60) % 500).tolist(), rng.integers(1, 5, 60).tolist(), strict=True)) for _ in range(n)]


def test_bm25_against_brute_force():
    docs = made_documents(200, np.random.default_rng(6))
    index = packing._Index([np.array(sorted(d)) for d in docs], [np.array([d[t] for t in sorted(d)]) for d in docs])
    for seed in range(0, 200, 20):
        assert np.allclose(index.search(seed), brute_bm25(docs, docs[seed]))


def test_filling_against_brute_force():
    """The longest unused document seeds a sequence; unused ones follow by their score, the last of them cut."""
    rng = np.random.default_rng(7)
    docs = made_documents(60, rng)
    sizes = rng.integers(200, 9000, 60).tolist()
    got = packing.pack_shard(5, profiles([(i, n, d) for i, (n, d) in enumerate(zip(sizes, docs, strict=True))]))
    start, want, sequence = [0] * 60, [], 5
    for d in range(60):
        while sizes[d] - start[d] >= packing.WINDOW:
            want.append((d, start[d], packing.WINDOW, sequence, 0))
            start[d] += packing.WINDOW
            sequence += 1
    left = [n - s for n, s in zip(sizes, start, strict=True)]
    for seed in sorted(range(60), key=lambda d: -left[d]):
        if not left[seed]:
            continue
        used = 0
        score = brute_bm25(docs, docs[seed])
        for d in [seed, *(d for d in sorted(range(60), key=lambda d: -round(score[d], 9)) if d != seed)]:
            room = packing.WINDOW - used
            take = left[d] if left[d] <= room else room // packing.GRAIN * packing.GRAIN
            if take:
                want.append((d, start[d], take, sequence, used))
                start[d], left[d], used = start[d] + take, left[d] - take, used + take
        sequence += 1
    assert [tuple(r) for r in got[["doc_id", "start", "length", "sequence_id", "offset"]].itertuples(index=False)] == want
    assert got.groupby("sequence_id")["length"].sum().iloc[:-1].min() > packing.WINDOW - packing.GRAIN


def test_exact_packing_is_one_shard(spark):
    rng = np.random.default_rng(8)
    docs = spark.createDataFrame([(i, " ".join(f"word{k}" for k in rng.zipf(1.5, 300) % 900)) for i in range(100)], "doc_id long, text string").repartition(5)
    path = vocabulary_file("word_bpe_49k.json")
    got = packing.pack(docs, path, exact=True).toPandas()
    want = packing.pack_shard(0, packing.profile(docs, path).toPandas(), packing.statistics(packing.profile(docs, path)))
    key = ["sequence_id", "offset"]
    assert got.sort_values(key).reset_index(drop=True).equals(want.sort_values(key).reset_index(drop=True))
