"""Every registered corpus query on the smallest tables, against SQL, the libraries that the contracts name, or brute force."""

import hashlib
import os
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest

import corpus_pipeline
from tapelake.llm import media, packing, quality_classifier, queries
from tests.llm.test_operators import brute_components
from tests.llm.test_quality_rules import brute

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def base():
    con = duckdb.connect()
    for name in ("documents", "labels", "pages", "conversations", "embeddings"):
        con.execute(f"create view {name} as select * from '{DATA}/{name}.parquet'")
    return con


@pytest.fixture(scope="module")
def texts(base):
    return {i: t or "" for i, t in base.execute("select doc_id, text from documents").fetchall()}


def rows_of(spark, name):
    return queries.QUERIES[name](spark, DATA).collect()


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_against_sql(spark, base, name):
    got, want = queries.QUERIES[name](spark, DATA).toPandas(), base.execute(queries.ORACLE_SQL[name]).df()
    key = sorted(want.columns)
    same = lambda v: "" if pd.isna(v) else str(int(v)) if isinstance(v, float) and v == int(v) else str(v)  # noqa: E731  a column with nulls may come as floats
    plain = lambda df: sorted(tuple(map(same, r)) for r in df[key].astype(object).values.tolist())
    assert sorted(got.columns) == key and plain(got) == plain(want)


def test_op1(spark, texts):
    got = {r["doc_id"]: r for r in rows_of(spark, "op1_media_columns")}
    assert got.keys() == texts.keys()
    for i, t in texts.items():
        raw = t.encode()
        padded = raw + bytes(max(64, -(-len(raw) // 64) * 64) - len(raw))
        r, stored = got[i], media.write_container(padded)
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-64:]))
        assert (r["media_bytes"], r["media_sha256"]) == (len(stored), hashlib.sha256(stored).hexdigest()) and r["feature"]
        assert b"".join(stored[k["offset"] : k["offset"] + k["length"]] for k in r["keyframes"]) == b"".join(padded[k * media.FRAME :][: media.FRAME] for k in range(0, -(-len(padded) // media.FRAME), media.GROUP))


def test_op2(spark, texts):
    got = rows_of(spark, "op2_sharding")
    assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == sorted((i, len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t in texts.items())
    assert {r["law"] for r in got} == {"rows"} and {r["grown_shard"] for r in got} == {None}
    slots = {s: sorted(r["slot"] for r in got if r["shard"] == s) for s in range(16)}
    assert all(v == list(range(len(v))) for v in slots.values()) and {len(v) for v in slots.values()} <= {len(texts) // 16, -(-len(texts) // 16)}


def test_op3(spark, base, texts):
    got = {r["doc_id"]: r for r in rows_of(spark, "op3_quality_classifier")}
    assert got.keys() == texts.keys()
    for i, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3)
    labels = dict(base.execute("select doc_id, quality from labels where quality is not null").fetchall())
    fitted = [(got[i]["score"], y) for i, y in labels.items()]
    good, bad = [s for s, y in fitted if y], [s for s, y in fitted if not y]
    assert np.mean([g > b for g in good for b in bad]) > 0.85  # a few dozen labels only


def test_op3_on_rows_that_it_was_not_fitted_on(spark):
    data = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r["score"] for r in queries.QUERIES["op3_quality_classifier"](spark, data).where("held_out").collect()}
    labels = duckdb.execute(f"select doc_id, quality from '{data}/labels.parquet' where quality is not null").fetchall()
    good, bad = ([got[i] for i, y in labels if i in got and y == side] for side in (1, 0))
    assert good and bad and np.mean([g > b for g in good for b in bad]) > 0.95


def test_pooling_against_plain_formulas():
    pooler, d = quality_classifier.Pooler(None), quality_classifier.DIMENSIONS
    for text in ("moss", "moss by night by moss", "Ünï code wörds", "x " * 40, ""):
        words = text.encode().split()
        v = np.array([quality_classifier.index_vectors([w], pooler.table)[0] for w in words]).reshape(-1, d)
        got, n = pooler.pool(["other words", text])[1], max(1, len(words))
        assert np.allclose(got[:d], v.sum(axis=0) / n, atol=1e-5)
        assert np.allclose(got[d : 2 * d], v.std(axis=0) if words else 0, atol=2e-3)
        for k in range(1, quality_classifier.REACH + 1):
            assert got[2 * d + k - 1] == pytest.approx(sum(float(a @ b) for a, b in zip(v, v[k:], strict=False)) / n, abs=1e-4)
        assert got[-1] == pytest.approx(np.log1p(len(words)) / 10)


def test_network_is_calibrated():
    """Probabilities of a noisy rule agree with the shares, and the temperature does no harm."""
    rng = np.random.default_rng(2)
    x = rng.normal(0, 1, (4000, 12)).astype(np.float32)
    y = (rng.random(4000) < 1 / (1 + np.exp(-2 * x[:, 0]))).astype(float)
    parts = quality_classifier.train_network(x[:3000], y[:3000])
    model = quality_classifier.Model(context=np.zeros(0), **parts)
    loss = lambda t: np.logaddexp(0, np.where(y[3000:] > 0.5, -1, 1) * model.logits(x[3000:]) / t).mean()
    assert loss(model.temperature) <= loss(1.0) + 1e-3
    score = model.score(x[3000:])
    bins = np.minimum((score * 5).astype(int), 4)
    assert sum(abs(score[bins == b].mean() - y[3000:][bins == b].mean()) * (bins == b).mean() for b in set(bins)) < 0.08
    one = np.tanh((x[3001] - model.center) / model.scale @ model.first + model.first_bias) @ model.second + model.second_bias
    assert score[1] == pytest.approx(1 / (1 + np.exp(-one / model.temperature)), rel=1e-4)


def test_fitting_takes_a_bounded_number_of_rows(spark):
    """An id that is repeated, with one text or several, counts once."""
    rows = [(i % 3 + 1, f"text number {i % 4}") for i in range(300)] + [(None, "none"), (5, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(8)], "doc_id long, quality int")
    known = [i for i in (1, 2, 3, 5) if zlib.crc32(str(i).encode()) % 5]
    assert quality_classifier.training_rows(docs, labels, 6000).count() == len(known)
    assert quality_classifier.training_rows(docs, labels, 1).count() <= 1


def test_op4(spark, base):
    import html

    got = {r["page_id"]: r for r in rows_of(spark, "op4_html_extraction")}
    pages = base.execute("select page_id, url, html from pages").fetchall()
    assert len(got) == len(pages)
    for i, url, page in pages:
        inner = re.search(r"<article>(.*)</article>", page or "", re.S)
        want = " ".join(html.unescape(re.sub(r"<[^>]*>", " ", inner[1])).split()) if inner else ""
        assert got[i]["url"] == url and got[i]["n_chars"] == len(got[i]["text"])
        assert got[i]["text"].replace(" ", "") == want.replace(" ", "")


def test_op6(spark, texts):
    from tokenizers import Tokenizer

    truth = Tokenizer.from_file(queries.vocabulary_file("byte_bpe_50k.json"))
    got = {r["doc_id"]: r for r in rows_of(spark, "op6_bpe")}
    assert got.keys() == texts.keys()
    for i, t in texts.items():
        ids = truth.encode(t, add_special_tokens=False).ids
        digests = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(truth.decode(ids, skip_special_tokens=False).encode()).hexdigest()
        assert (got[i]["n_tokens"], got[i]["ids_sha256"], got[i]["decoded_sha256"]) == (len(ids), *digests)


def test_op7(spark, texts):
    counts = {i: Counter(t.encode().lower().split()) for i, t in texts.items()}
    total = sum(counts.values(), Counter())
    for r in rows_of(spark, "op7_lm_scoring"):
        own = counts[r["doc_id"]]
        assert r["n_words"] == sum(own.values()) and r["n_novel"] == sum(k for w, k in own.items() if total[w] == k)
        assert (r["per_word"] is None) == (not own) and r["log_likelihood"] <= 0
        assert not own or r["per_word"] == pytest.approx(r["log_likelihood"] / r["n_words"])


def packed_whole(pieces, texts):
    """Whether the pieces hold each document's ids once, and sequences are gapless and full."""
    from tokenizers import Tokenizer

    truth = Tokenizer.from_file(queries.vocabulary_file("word_bpe_49k.json"))
    of, sequences = {}, {}
    for r in pieces:
        of.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append(r)
    assert of.keys() == texts.keys()
    for i, t in texts.items():
        ids = np.array([*truth.encode(t, add_special_tokens=False).ids, 2], "<u4")
        at = 0
        for r in sorted(of[i], key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(ids)) and r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    fill = []
    for rows in sequences.values():
        at = 0
        for r in sorted(rows, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        fill.append(at)
    assert max(fill) <= packing.WINDOW
    return sum(fill) / packing.WINDOW / len(fill)


def test_op10(spark, texts):
    assert packed_whole(rows_of(spark, "op10_packing"), texts) > 0.9


def test_pipeline(spark, texts):
    """Each stage against brute force on what its predecessor kept, then run() as a whole."""
    docs = queries.table(spark, DATA, "documents")
    columns, kept = docs.columns, dict(texts)
    model = quality_classifier.fit(docs, queries.table(spark, DATA, "labels"))
    scores = {r["doc_id"]: r["score"] for r in quality_classifier.score(docs, model).collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_classifier", "quality_rules", "near_duplicates", "packing"]
    docs = stages["quality_classifier"](spark, docs, DATA)
    kept = {i: t for i, t in kept.items() if scores[i] >= quality_classifier.THRESHOLD}
    assert docs.columns == columns and {r["doc_id"] for r in docs.collect()} == kept.keys()
    docs = stages["quality_rules"](spark, docs, DATA)
    kept = {i: t for i, t in kept.items() if brute(t)[-1]}
    assert docs.columns == columns and {r["doc_id"] for r in docs.collect()} == kept.keys()
    docs = stages["near_duplicates"](spark, docs, DATA)
    ids = sorted(kept)
    parent = brute_components([kept[i] for i in ids], 80)[1]
    kept = {ids[p]: kept[ids[p]] for p in set(parent)}
    assert docs.columns == columns and {r["doc_id"] for r in docs.collect()} == kept.keys()
    assert packed_whole(rows_of(spark, "pipeline"), kept) > 0.9


def test_pipeline_stages_take_odd_tables(spark):
    """Nulls, repeated rows, clashing names and no rows at all; a stage keeps the columns."""
    clean = " ".join(f"word{i}" for i in range(120)) + "."
    rows = [(1, clean, "a", 0), (1, clean, "a", 0), (None, clean, None, None), (2, None, None, 1), (3, "", "x", None), (4, clean + " and more", None, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _dropped string, score int")
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        assert stage(spark, docs, DATA).columns == docs.columns
        assert stage(spark, docs.limit(0), DATA).count() == 0, name
    assert corpus_pipeline.apply_rules(spark, docs, DATA).count() == 4
    assert sorted(r["doc_id"] or 0 for r in corpus_pipeline.drop_near_duplicates(spark, docs, DATA).collect()) == [1, 2, 3]
    assert corpus_pipeline.classify(spark, docs, DATA).columns == docs.columns
    assert corpus_pipeline.classify(spark, docs.limit(0), DATA).count() == 0
    assert corpus_pipeline.pack(spark, docs.limit(0), DATA).count() == 0
