"""Language-model scoring: exact shares, every word trained on, and scores that don't depend on the layout."""

import zlib

import numpy as np
import pytest

from tapelake.llm import lm_score

HARD = [(1, None), (2, ""), (3, " \n\t "), (4, "a"), (5, "word " * 30_000), (6, "x" * 50_000), (7, "same text of six words here"), (7, "same text of six words here"), (8, "same text of six words here"), (9, "日本語 é́ don't  stop"), (None, "no id at all but some words")]
SCHEMA = "doc_id long, text string, row string, words string, classes int, n string, word string"


@pytest.fixture(scope="module")
def hard(spark):
    return spark.createDataFrame([(i, t, "clash", "clash", 0, "clash", "clash") for i, t in HARD], SCHEMA)


def test_hard_inputs(spark, hard):
    got = lm_score.score_corpus(hard).collect()
    assert len(got) == len(HARD)
    assert all((r["per_word"] is None) == (r["n_words"] == 0) and r["log_likelihood"] <= 0 for r in got)
    by = {r["doc_id"]: r for r in got}
    assert (by[7]["n_novel"], by[8]["n_novel"], by[5]["n_novel"], by[6]["n_novel"], by[9]["n_novel"]) == (0, 0, 30_000, 1, 4)
    assert len({r["log_likelihood"] for r in got if r["doc_id"] in (7, 8)}) == 1
    assert lm_score.score_corpus(spark.createDataFrame([], SCHEMA)).count() == 0


def test_network_against_plain_formula(hard):
    words = lm_score.vocabulary(hard)
    w = [x.astype(np.float64) for x in lm_score.unpack(lm_score.start(words.totals))]
    random = np.random.default_rng(3)
    w = [x + random.normal(0, 3, x.shape) for x in w]  # far apart, so that a shift shared by rows would fail
    classes = np.concatenate([words.encode([t])[0][0].astype(np.int64) for _, t in HARD[6:]])
    got = lm_score.log_probabilities([x.astype(np.float32) for x in w], classes)
    for i in np.flatnonzero(classes != lm_score.PADDING):
        h = np.tanh(w[1] + sum(w[0][k][classes[i + d]] for k, d in enumerate(lm_score.OFFSETS)))
        g, m = divmod(int(classes[i]), lm_score.MEMBERS)
        outer, inner = h @ w[2] + w[3], h @ w[4][g] + w[5][g]
        want = outer[g] - np.logaddexp.reduce(outer) + inner[m] - np.logaddexp.reduce(inner)
        assert got[i] == pytest.approx(want, rel=1e-3, abs=1e-3)


def test_steps_follow_the_slope():
    """One step moves every weight against the numeric slope of the mean loss."""
    random = np.random.default_rng(1)
    weights = lm_score.start(np.ones(lm_score.CLASSES)) + random.normal(0, 0.1, sum(lm_score.SIZES)).astype(np.float32)
    classes = np.concatenate([[lm_score.PADDING] * 2, random.integers(0, lm_score.PADDING, 40), [lm_score.PADDING] * 2])
    trainer = lm_score.Trainer(weights)
    trainer.fit(classes, np.arange(2, 42))
    slope = trainer.first / 0.1
    loss = lambda x: -lm_score.log_probabilities(lm_score.unpack(x), classes).sum() / 40
    for i in np.argsort(-np.abs(slope))[:40:3]:
        up, down = weights.astype(np.float64), weights.astype(np.float64)
        up[i] += 1e-3
        down[i] -= 1e-3
        assert slope[i] == pytest.approx((loss(up) - loss(down)) / 2e-3, rel=0.02, abs=1e-4)


@pytest.mark.parametrize("known", [0, 1 << 17])
def test_shares_are_exact(spark, known):
    """By the join alone and by the counts at hand alone."""
    words = [f"w{i}ng" for i in range(5000)]  # one ending
    docs = spark.createDataFrame([(0, " ".join(words)), (1, " ".join(words[:1] * 999)), (None, "w1ng w1ng"), (None, None)], "doc_id long, text string")
    held = lm_score.vocabulary(docs, 0, known)
    got = sorted((r["shares"], r["novel"]) for r in lm_score.encode(docs, held).collect())
    total = 4998 + 1000 + 3
    assert held.totals.sum() == total and held.once == 4998
    spelled = sum(np.log(held.novel) - lm_score.LETTER * (len(w) + 1) for w in words[2:])
    seen = lambda k: np.log1p(-held.novel) + np.log(k) - np.log1p(total)
    assert got == [(pytest.approx(v), n) for v, n in sorted([(spelled + seen(999) + seen(2), 4998), (999 * seen(1), 0), (2 * seen(1), 0), (0.0, 0)])]
    other = lm_score.encode(spark.createDataFrame([(0, "neverng")], "doc_id long, text string"), held).first()
    assert other["shares"] == pytest.approx(np.log(held.novel) - lm_score.LETTER * 8) and other["novel"] == 1


def test_every_word_is_trained_on_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(lm_score, "BLOCK", 7)
    docs = spark.createDataFrame([(0, " ".join(f"v{i}" for i in range(100))), (1, "a b c"), (2, None)], "doc_id long, text string").coalesce(1)
    words = lm_score.vocabulary(docs)
    coded = lm_score.code(docs, words)
    path, step = str(tmp_path), lm_score.Trainer.fit

    class Noting(lm_score.Trainer):
        def fit(self, classes, at):
            np.save(f"{path}/{zlib.crc32(classes.tobytes())}.npy", classes[at[:, None] + np.arange(-2, 3)])
            step(self, classes, at)

    monkeypatch.setattr(lm_score, "Trainer", Noting)
    lm_score.fit(coded, words)
    got = sorted(map(tuple, np.concatenate([np.load(p) for p in tmp_path.iterdir()]).tolist()))
    whole = [lm_score.decoded(r["classes"]) for r in coded.collect()]
    assert got == sorted(tuple(c[i - 2 : i + 3].tolist()) for c in whole for i in range(2, len(c) - 2))


def test_scores_do_not_depend_on_the_layout(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "SHARD", 4000)
    random = np.random.default_rng(4)
    lexicon = ["w" + "".join(random.choice(list("abcdefgh"), 3)) for _ in range(300)]
    docs = spark.createDataFrame([(i, " ".join(random.choice(lexicon, 60))) for i in range(400)], "doc_id long, text string")
    runs = [{r["doc_id"]: r["per_word"] for r in lm_score.score_corpus(docs.repartition(n)).collect()} for n in (1, 4, 8)]
    assert max(abs(a - b) for other in runs[1:] for a, b in zip(runs[0].values(), (other[k] for k in runs[0]), strict=True)) < 0.05


def test_training_helps(spark):
    """Pairs of words that go together are likelier after training than before."""
    random = np.random.default_rng(5)
    text = [" ".join(x for k in random.integers(0, 40, 1000) for x in (f"a{k}", f"b{k}")) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(text)), "doc_id long, text string")
    words = lm_score.vocabulary(docs)
    coded = lm_score.encode(docs, words)
    before = lm_score.rate(coded, lm_score.start(words.totals)).agg({"per_word": "avg"}).first()[0]
    assert lm_score.rate(coded, lm_score.train(docs, words)).agg({"per_word": "avg"}).first()[0] > before + 0.1
