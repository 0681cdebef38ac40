"""The corpus operators against brute force, exact round trips and hard inputs."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tapelake.llm import bpe, chat, near_duplicates, packing, quality_classifier, sharding
from tapelake.llm.queries import vocabulary_file

HARD = [(1, None), (2, ""), (3, " \n\t "), (4, "a"), (5, "word " * 30_000), (6, "x" * 50_000), (7, "same text of six words here"), (7, "same text of six words here"), (8, "same text of six words here"), (9, "日本語 <|endoftext|> é́ don't  stop"), (None, "no id at all but some words")]
SCHEMA = "doc_id long, text string, id string, tokens string, n_words string, family int, shard string"


@pytest.fixture(scope="module")
def hard(spark):
    return spark.createDataFrame([(i, t, "clash", "clash", "clash", 0, "clash") for i, t in HARD], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 17, 1000])
def test_permutation(n):
    p = sharding.permute(np.arange(n), n, 5)
    assert sorted(p) == list(range(n))
    assert (sharding.permute(p, n, 5, inverse=True) == np.arange(n)).all()


def test_sharding(spark, empty):
    rows = spark.range(1001).select((F.col("id") % 400).alias("doc_id")).repartition(3)
    got = sharding.shard(rows, ["doc_id"], 16).collect()
    by = {s: sorted(r["slot"] for r in got if r["shard"] == s) for s in range(16)}
    assert all(v == list(range(len(v))) and len(v) in (62, 63) for v in by.values())
    for r in got[:20]:
        assert sharding.locate(r["row_number"], 1001, 16) == (r["shard"], r["slot"])
        assert sharding.row_at(r["shard"], r["slot"], 1001, 16) == r["row_number"]
    assert sharding.shard(empty.select("doc_id"), ["doc_id"], 16).count() == 0
    odd = spark.createDataFrame([(None, "a", 1, 2), (None, "a", 1, 2), (3, None, None, None)], "doc_id long, Shard string, salt int, slot int")
    placed = sharding.shard(odd, ["doc_id", "Shard"], 2)
    assert placed.columns == ["doc_id", "Shard", "salt", "slot", "row_number", "_shard", "_slot"]
    assert sorted((r["_shard"], r["_slot"]) for r in placed.collect()) == [(0, 0), (0, 1), (1, 0)]


def test_chat(spark):
    rows = [(1, 1, "assistant", chat.STOP + "a<\\|b"), (1, 0, "user", None), (1, 1, "assistant", chat.STOP + "a<\\|b"), (2, 0, None, ""), (None, None, "user", "x" * 20_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    path = vocabulary_file("byte_bpe_50k.json")
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_turns(df, path), path).collect()}
    learned = 2 * (chat.STOP + "a<\\|b")
    assert (got[1]["n_turns"], got[1]["loss_chars"], got[1]["loss_sha256"]) == (3, len(learned), hashlib.sha256(learned.encode()).hexdigest())
    assert (got[2]["loss_chars"], got[None]["n_turns"]) == (0, 1)
    assert chat.loss_mask([2, 0, 3], [False, True, True]).tolist() == [False, False, True, True, True]
    roles = ["us\ner", "a\\nb", "\\", "\n", "<|\n", "c\\\n<\\|", "assistant"]
    odd = spark.createDataFrame([(i, 0, r, "x\ny") for i, r in enumerate(roles)], "conv_id long, turn long, role string, text string")
    for r in chat.read_back(chat.format_turns(odd, path), path).collect():
        assert r["turns_sha256"] == hashlib.sha256(f"{roles[r['conv_id']]}\nx\ny\n".encode()).hexdigest()
    for text in ("<|", "<\\|", "<\\\\|x<|", "\\<|\\"):
        assert chat.unescape(chat.escape(text)) == text and not re.search(r"<\|", chat.escape(text))
    starts = chat.with_offsets(chat.format_turns(df, path)).where("conv_id = 1").orderBy("token_start").collect()
    assert starts[0]["token_start"] == 0 and starts[1]["token_start"] == starts[0]["n_tokens"]


def test_bpe(hard, empty):
    from tokenizers import Tokenizer

    path = vocabulary_file("byte_bpe_50k.json")
    truth = Tokenizer.from_file(path)
    texts = {i: t or "" for i, t in HARD}
    got = bpe.decode(bpe.encode(hard, path), path).collect()
    assert len(got) == len(HARD)
    for r in got:
        want = truth.encode(texts[r["id"]], add_special_tokens=False).ids
        assert np.frombuffer(r["ids"], "<u4").tolist() == want and r["text"] == truth.decode(want, skip_special_tokens=False)
    assert bpe.encode(empty, path).count() == 0
    codec = bpe.codec(path)
    for piece in (b"the quick brown", b"aaaaaaaa", "ééé".encode()):
        assert codec.merge(piece) == codec._merge_long(piece)


def test_word_codec():
    from tokenizers import Tokenizer

    path = vocabulary_file("word_bpe_49k.json")
    truth = Tokenizer.from_file(path)
    for text in ["", "Don't STOP", "a b", "İstanbul ΣΑΣ", "éa", "12ab!!'s'S", "<|startoftext|>q", "日本 ½", "ƻ ŉ \x1c 　z\n\n", "aƁb Ⱥ1 ȾȾ Ǆ"]:
        assert np.frombuffer(packing.codec(path).encode(text), "<u4").tolist() == truth.encode(text, add_special_tokens=False).ids


def test_packing(hard, empty):
    path = vocabulary_file("word_bpe_49k.json")
    pieces = packing.pack(hard, path).toPandas()
    by = pieces.sort_values(["sequence_id", "offset"])
    assert (by.groupby("sequence_id")["length"].cumsum() - by["length"] == by["offset"]).all()
    assert by.groupby("sequence_id")["length"].sum().max() <= packing.WINDOW
    assert pieces["length"].sum() == sum(len(packing.codec(path).encode(t or "")) // 4 + 1 for _, t in HARD)
    five = pieces[pieces.doc_id == 5].sort_values("start")
    ids = packing.codec(path).encode(HARD[4][1]) + packing.END.to_bytes(4, "little")
    for r in five.itertuples():
        assert zlib.crc32(ids[4 * r.start : 4 * (r.start + r.length)]) == r.ids_crc32
    assert packing.pack(empty, path).count() == 0
    unique = hard.where("doc_id in (2, 4, 9)")
    made = packing.sequences(packing.pack(unique, path), unique, path).collect()
    assert sum(len(r["ids"]) for r in made) == 4 * packing.pack(unique, path).agg(F.sum("length")).first()[0]


def brute_components(texts, percent=85):
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    parent = list(range(len(texts)))
    for _ in texts:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets[:i]):
                if a and b and 100 * len(a & b) >= percent * len(a | b):
                    parent[i] = parent[j] = min(parent[i], parent[j])
    return [len(s) for s in sets], parent


def test_near_duplicates(spark, hard, empty):
    random = np.random.default_rng(2)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(12):
        base = list(random.choice(words, int(random.integers(3, 120))))
        texts.append(" ".join(base))
        for _ in range(int(random.integers(0, 9))):
            base = [w if random.random() > 0.012 else str(random.choice(words)).upper() for w in base]
            texts.append(" ".join(base))
    sizes, parent = brute_components(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = near_duplicates.near_duplicates(df).orderBy("doc_id").collect()
    assert [(r["n_shingles"], r["component_id"], r["kept"]) for r in got] == [(n, p, p == i) for i, (n, p) in enumerate(zip(sizes, parent, strict=True))]
    odd = near_duplicates.near_duplicates(hard).collect()
    assert len(odd) == len(HARD)
    assert {(r["component_id"], r["kept"]) for r in odd if r["doc_id"] in (7, 8)} == {(7, True), (7, False)}
    assert near_duplicates.near_duplicates(empty).count() == 0
    assert near_duplicates.deduplicate(hard).columns == hard.columns


@pytest.mark.parametrize("block", [64, 1 << 19])
def test_blocks_lose_no_link(spark, monkeypatch, block):
    monkeypatch.setattr(near_duplicates, "BLOCK", block)
    base = [f"w{i}" for i in range(60)]
    texts = [" ".join([*base[:k], f"x{k}", *base[k + 1 :]]) if k else " ".join(base) for k in range(0, 60, 5)]
    sizes, parent = brute_components(texts)
    got = near_duplicates.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r["component_id"] for r in got] == parent


@pytest.mark.parametrize("finish", [0, 5, 1 << 13])
def test_components_of_a_path(spark, monkeypatch, finish):
    monkeypatch.setattr(near_duplicates, "FINISH", finish)
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a long, b long")
    assert {(r["node"], r["component"]) for r in near_duplicates.components(edges).collect()} == {(i, 0) for i in range(61)} | {(100, 100), (101, 100)}


def test_classifier(spark, hard, empty):
    random = np.random.default_rng(0)
    good = [" ".join(random.choice(["the", "river", "runs", "over", "stones", "and", "moss", "by", "night"], 60)) for _ in range(80)]
    bad = [" ".join(random.choice(["BUY!!", "NOW!!", "###", "$$$", "WIN!!"], 60)) for _ in range(80)]
    docs = spark.createDataFrame(list(enumerate(good + bad)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 80)) for i in range(160)] + [(3, None), (None, 1)], "doc_id long, quality int")
    model = quality_classifier.fit(docs, labels)
    scores = {r["doc_id"]: r["score"] for r in quality_classifier.score(docs, model).collect()}
    held = [i for i in range(160) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(scores[i] >= 0.3) == (i < 80) for i in held]) > 0.95
    odd = quality_classifier.score(hard, model).collect()
    assert len(odd) == len(HARD) and all(0 <= r["score"] <= 1 for r in odd)
    assert quality_classifier.score(empty, model).count() == 0
    assert quality_classifier.filter_documents(hard, model).columns == hard.columns
    quality_classifier.fit(empty, labels)


def test_long_texts_pool_alike(monkeypatch):
    pooler = quality_classifier.Pooler(None)
    text = " ".join(f"word{i % 37}" for i in range(2000))
    whole = pooler.pool([text])
    monkeypatch.setattr(quality_classifier, "STRIDE", 64)
    assert np.allclose(pooler.pool([text, "a"])[0], whole[0], atol=1e-5)
