"""Quality rules: measures and verdicts by brute force, laziness, and an order that doesn't depend on the layout."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tapelake.llm import quality_rules
from tests.llm.test_operators import HARD, SCHEMA


@pytest.fixture(scope="module")
def hard(spark):
    return spark.createDataFrame([(i, t, "clash", "clash", "clash", 0, "clash") for i, t in HARD], SCHEMA)


def test_hard_rows(spark, hard):
    got = {(r["doc_id"], r["n_words"]): r for r in quality_rules.assess(hard).collect()}
    assert got[(1, 0)]["base_failed"] and not got[(3, 0)]["kept"]
    assert got[(5, 30_000)]["n_repeat_words"] == 30_000
    text = spark.createDataFrame([(1, "a b c x a b c\nq\nq\n \n##")], "doc_id long, text string")
    r = quality_rules.assess(text).first()
    assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (10, 11, 2, 1, 6)
    assert quality_rules.keep(hard).columns == hard.columns
    assert quality_rules.keep(hard.drop("doc_id")).count() == 0
    assert quality_rules.assess(hard.limit(0)).count() == quality_rules.keep(hard.limit(0)).count() == 0


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
    n, chars = len(words), sum(map(len, words))
    count = lambda letters: sum(text.count(c) for c in letters)
    base = n < 50 or 100 * len(covered) > 50 * n
    fails = [chars < 2 * n, chars > 15 * n, 10 * count("#*$%&|<>") > 3 * n, 10 * (len(lines) - len(set(lines))) > n, 2 * count(quality_rules.CAPITALS) > chars, 10 * count("!?") > 3 * n]
    return n, chars, count("#*$%&|<>"), len(lines) - len(set(lines)), len(covered), base, not base and not any(fails)


def made_texts():
    rng = np.random.default_rng(5)
    kinds = [["the", "river", "Runs", "over", "stones"], ["WIN", "NOW!!", "CASH"], ["a", "b", "c"], ["12", "345", "x9"], ["#x", "$$$", "ok"], ["averyveryverylongwordindeed", "more"], ["é", "日本", "word\u3000x"]]
    texts = []
    for _ in range(200):
        words = kinds[int(rng.integers(len(kinds)))] + [f"w{k}" for k in range(int(rng.integers(1, 300)))]
        texts.append("".join(str(rng.choice(words)) + str(rng.choice([" ", " ", "  ", "\n", "\t"])) for _ in range(int(rng.integers(0, 120)))))
    return texts


def test_against_brute_force(spark):
    texts = made_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: tuple(r)[1:] for r in quality_rules.assess(df).collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts)}
    assert len({v[-1] for v in got.values()}) == 2
    assert {r["doc_id"] for r in quality_rules.keep(df).collect()} == {i for i, v in got.items() if v[-1]}


def test_later_rules_are_not_evaluated(spark):
    """A rule that raises where an earlier one has rejected shows that it is not reached there."""
    df = spark.createDataFrame([(1, "short"), (2, "long enough here")], "doc_id long, text string")
    first = quality_rules.Rule("first", lambda m: m["n_words"] < 2)
    trap = quality_rules.Rule("trap", lambda m: F.when(m["n_words"] < 2, F.raise_error(F.lit("reached"))).otherwise(F.lit(0)) > 1)
    words = quality_rules.words_of(F.col("text"))
    at = quality_rules.measures(F.col("text"), words)
    assert [r["doc_id"] for r in df.where(quality_rules.cascade([first, trap], at)).collect()] == [2]
    with pytest.raises(Exception, match="reached"):
        df.where(quality_rules.cascade([trap, first], at)).collect()


def test_order_follows_rejections_per_cost(spark, monkeypatch):
    a, b, c = (quality_rules.Rule(n, lambda m: None) for n in "abc")
    assert quality_rules.ordered([(a, 1e3, 0.1), (b, 1e3, 0.5), (c, 1e2, 0.1)]) == [c, b, a]
    monkeypatch.setattr(quality_rules, "SAMPLE", 2)
    df = spark.createDataFrame(list(enumerate(made_texts())), "doc_id long, text string")
    orders = [[r.name for r in quality_rules.plan(df.repartition(n), quality_rules.BASE + quality_rules.RULES)] for n in (1, 5)]
    assert orders[0] == orders[1] and orders[0][0] == "few_words" and orders[0].index("repeated_words") > orders[0].index("symbols")
