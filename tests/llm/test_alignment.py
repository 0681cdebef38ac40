"""Cross-tokenizer alignment against brute force, and the laws of its fragments."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tapelake.llm import alignment
from tapelake.llm.queries import QUERIES, vocabulary_file

A, B = vocabulary_file("byte_bpe_50k.json"), vocabulary_file("piece_bpe_32k.model")
HARD = ["", None, " ", "a", "word " * 3000, "x" * 9000, "same text", "same text", "日本語 <|endoftext|> <s> é́ don't  stop\n\n end ", "two\nlines and\ttabs \n x", "a▁b", "trailing  ", "\n", "\r\nmixed\x1c x\x85y　z", "nul\x00 byte", "🙂 🙂🙂", "  lead"]


def tokens(text, cache={}):
    if not cache:
        cache["a"] = Tokenizer.from_file(A)
        cache["a"].encode_special_tokens = True
        cache["b"] = sentencepiece.SentencePieceProcessor(model_file=B)
    a, b = cache["a"], cache["b"]
    letters = alignment.byte_letters()
    ids, pieces = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    raw_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids]
    raw_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, b.id_to_piece(i)) for i in pieces)]
    whole = (" " + text).encode()
    return (ids, raw_a, pieces, raw_b) if text and b"".join(raw_a) == whole == b"".join(raw_b) else ([], [], [], [])


def expected(texts):
    found, holders = [], Counter()
    for text in texts:
        ids, raw_a, pieces, raw_b = tokens(text or "")
        ends_a, ends_b = np.cumsum([0, *map(len, raw_a)]).tolist(), np.cumsum([0, *map(len, raw_b)]).tolist()
        links, j = [], 0
        for i in range(len(ids)):
            while j and ends_b[j] > ends_a[i]:
                j -= 1
            while j < len(pieces) and ends_b[j] < ends_a[i + 1]:
                if ends_b[j + 1] > ends_a[i]:
                    links.append((ids[i], pieces[j]))
                j += 1
        common = sorted(set(ends_a) & set(ends_b))
        groups = [",".join(str(x) for x, e in zip(ids, ends_a[1:]) if lo < e <= hi) + "|" + ",".join(str(x) for x, e in zip(pieces, ends_b[1:]) if lo < e <= hi) for lo, hi in zip(common, common[1:])] if len(ids) < 400 else None
        found.append((len(ids), len(pieces), max(0, len(common) - 1), links, groups))
        holders.update(set(links))
    most = defaultdict(int)
    for (a, _), n in holders.items():
        most[a] = max(most[a], n)
    return [(a, b, g, len(links), sum(holders[x] == most[x[0]] for x in links), sum(holders[x] for x in links), groups) for a, b, g, links, groups in found]


@pytest.mark.parametrize(("size", "known"), [(alignment.RANGE, alignment.KNOWN), (50, 7)])
def test_hard_texts(spark, size, known):
    df = spark.createDataFrame([(i, t, "clash", 1) for i, t in enumerate(HARD)], "doc_id long, text string, groups string, key int").repartition(3)
    rows, pairs = alignment.with_counts(alignment.align(df, A, B, size=size), known)
    got = {r["doc_id"]: r for r in rows.collect()}
    assert pairs.count() == pairs.select("code").distinct().count() > 0
    for i, e in enumerate(expected(HARD)):
        assert tuple(got[i][c] for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")) == e[:6], HARD[i][:20]
        if e[6] is not None:
            assert got[i]["groups"] == ";".join(e[6])
    none, no_pairs = alignment.with_counts(alignment.align(df.where("false"), A, B))
    assert none.count() == no_pairs.count() == 0
    odd = spark.createDataFrame([(None, "no id"), (None, "no id")], "doc_id long, text string")
    assert [r["n_links"] for r in alignment.with_counts(alignment.align(odd, A, B))[0].collect()] == [2, 2]


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    ids = sorted(docs)
    got = {r["doc_id"]: r for r in QUERIES["op11_alignment"](spark, sf).collect()}
    assert sorted(got) == ids
    for i, e in zip(ids, expected([docs[i] for i in ids])):
        assert tuple(got[i][c] for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")) == e[:6]
        if e[6] is not None:
            assert got[i]["groups_sha256"] == (hashlib.sha256(";".join(e[6]).encode()).hexdigest() if e[0] else "")


def same(x, y):
    return (x.bound, x.groups, x.n_a, x.n_b, x.n_groups, x.n_links, sorted(np.repeat(x.codes, x.times).tolist()), x.bad) == (y.bound, y.groups, y.n_a, y.n_b, y.n_groups, y.n_links, sorted(np.repeat(y.codes, y.times).tolist()), y.bad) and all((p == q).all() for p, q in zip((*x.prefix, *x.suffix), (*y.prefix, *y.suffix)))


def test_fragments_compose():
    """Any cut of the bytes and any order of composition gives the whole; an empty fragment is neutral."""
    random.seed(1)
    for text in ("Grüße an alle, die unterwegs sind. 日本語のテキスト", "internationalization of tokenizers", "x" * 40):
        ids, raw_a, pieces, raw_b = tokens(text)
        a, b = (alignment._tokens(np.array(i), np.array([len(x) for x in raw])) for i, raw in ((ids, raw_a), (pieces, raw_b)))
        n = int(a[1].sum())
        whole = alignment.fragment(a, b, 0, n)
        for _ in range(20):
            edges = [0, *sorted(random.sample(range(1, n), 5)), n]
            parts = [alignment.fragment(a, b, x, y) for x, y in zip(edges, edges[1:])]
            left = alignment.Fragment()
            for p in parts:
                left = left + p
            right = alignment.Fragment()
            for p in reversed(parts):
                right = p + right
            tree = ((parts[0] + parts[1]) + (parts[2] + parts[3])) + (parts[4] + parts[5])
            assert same(left, right) and same(left, tree) and same(left, whole + alignment.Fragment())
            assert same(left.closed(), whole.closed())


def test_ranges_cut_as_the_whole_text_is_cut():
    tool = alignment.aligner(A, B)
    random.seed(2)
    for _ in range(20):
        text = " " + "".join(random.choice(["word", " ", "  ", "\n", "é", "longerword", "日本", "\t", "x" * 60, ", "]) for _ in range(300))
        whole = next(alignment.align_texts(tool, [text]))
        made = alignment.Fragment()
        for start, stop, first, last in alignment.ranges(text, 37, 400):
            made = made + alignment.align_range(tool, text[start:stop], first, last)
        assert same(made.closed(), whole)
        ids = tokens(text[1:])
        assert (whole.n_a, whole.n_b) == (len(ids[0]), len(ids[2]))
