"""Quality rules as a short-circuit cascade of native columns.

Measures are plain DataFrame expressions.  The cost and selectivity of each rule are estimated in one job on a sample
that a hash picks, and the rules are ordered by rejections per cost: a chain of conditions evaluates the next rule,
and the measures that it alone needs, only for rows that passed the ones before.  The verdict is the conjunction of
the rules, so it doesn't depend on the order.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Blanks of the word pattern and the symbols counted.
BLANKS = "\\x20\\x09-\\x0D"
SYMBOLS = "#*$%&|<>"
#: One row in so many is in the sample on which cost and selectivity are estimated; only the order of evaluation depends on it.
SAMPLE = 64
#: Letters counted as capitals.
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times."""
    return F.transform(F.array(value), use)[0]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{BLANKS}]+"), "")


def n_of(text: Column, letters: str) -> Column:
    """Characters of ``text`` that are among ``letters``."""
    return (F.length(text) - F.length(F.translate(text, letters, ""))).cast("long")


def n_symbols(text: Column) -> Column:
    size = F.octet_length(text)
    parts = [size - F.octet_length(F.replace(text, F.lit(c), F.lit(""))) for c in SYMBOLS]
    total = parts[0]
    for part in parts[1:]:
        total = total + part
    return F.coalesce(total, F.lit(0)).cast("long")


def n_dup_lines(text: Column) -> Column:
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: line.rlike(f"[^{BLANKS}]"))
    return _bind(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def n_repeat_words(words: Column, width: int = 3) -> Column:
    """Words that lie in a window of ``width`` words found twice or more.

    Windows are sorted by hash beside their places; a place whose hash equals a neighbour's is repeated.  The sorted
    places then cover min(width, distance to the next place) words each.
    """

    def measure(w: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(w) - width)
        windows = F.sort_array(F.transform(places, lambda i: F.struct(F.xxhash64(*(F.get(w, i + k) for k in range(width))).alias("h"), i.alias("i"))))

        def repeated(s: Column) -> Column:
            hits = F.filter(s, lambda x, k: (F.coalesce(x["h"] == F.get(s, k - 1)["h"], F.lit(False))) | F.coalesce(x["h"] == F.get(s, k + 1)["h"], F.lit(False)))
            return F.sort_array(F.transform(hits, lambda x: x["i"]))

        def covered(p: Column) -> Column:
            return F.aggregate(p, F.struct(F.lit(0).alias("n"), F.lit(-width).alias("last")), lambda a, x: F.struct((a["n"] + F.least(F.lit(width), x - a["last"])).alias("n"), x.alias("last")), lambda a: a["n"])

        return _bind(_bind(windows, repeated), covered)

    return _bind(words, lambda w: F.when(F.size(w) < width, F.lit(0)).otherwise(measure(w))).cast("long")


#: Measures of every row, and those that only a rule asks for, each with its cost: nanoseconds a character and a word.
MEASURES = {"n_words": (0, 1), "word_chars": (0, 30), "n_symbols": (8, 0), "n_dup_lines": (6, 0), "n_repeat_words": (0, 700)}
LAZY = {"n_capitals": (9, 0), "n_marks": (9, 0)}


def measures(text: Column, words: Column) -> dict[str, Column]:
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.array_join(words, "")).cast("long"),
        "n_symbols": n_symbols(text),
        "n_dup_lines": n_dup_lines(text),
        "n_repeat_words": n_repeat_words(words),
    }


def lazy_measures(text: Column) -> dict[str, Column]:
    return {"n_capitals": n_of(text, CAPITALS), "n_marks": n_of(text, "!?")}


@dataclass(frozen=True)
class Rule:
    """A row fails where ``fails`` holds; ``fails`` gets the measures by name, of which it takes those in ``uses``."""

    name: str
    fails: Callable[[dict[str, Column]], Column]
    uses: tuple[str, ...] = ()


#: Base rules of every use, then the method's own; all in whole numbers, so that other engines decide alike.  None
#: depends on the length of a text alone but for the first.
BASE = (
    Rule("few_words", lambda m: m["n_words"] < 50, ("n_words",)),
    Rule("repeated_words", lambda m: m["n_repeat_words"] * 100 > m["n_words"] * 50, ("n_repeat_words",)),
)
RULES = (
    Rule("short_words", lambda m: m["word_chars"] < m["n_words"] * 2, ("word_chars",)),
    Rule("long_words", lambda m: m["word_chars"] > m["n_words"] * 15, ("word_chars",)),
    Rule("symbols", lambda m: m["n_symbols"] * 10 > m["n_words"] * 3, ("n_symbols",)),
    Rule("duplicate_lines", lambda m: m["n_dup_lines"] * 10 > m["n_words"], ("n_dup_lines",)),
    Rule("capitals", lambda m: m["n_capitals"] * 2 > m["word_chars"], ("n_capitals", "word_chars")),
    Rule("marks", lambda m: m["n_marks"] * 10 > m["n_words"] * 3, ("n_marks",)),
)


def estimate(docs: DataFrame, rules: tuple[Rule, ...], text: str = "text", at_hand: tuple[str, ...] = (), id_column: str = "doc_id") -> list[tuple[Rule, float, float]]:
    """(rule, nanoseconds a row, share of rows that fail) of each rule on the sample, in one job that gives the driver one row.

    A hash of id and text picks the sample, so it is the same whatever the layout; it grows with the table and is a
    fixed share of it.  The cost of a rule is that of its measures, by the characters and words of the sampled texts;
    measures ``at_hand`` cost nothing.  Without a sampled row all costs are 0 and no rule rejects anything.
    """
    keys = [F.col(c) for c in (id_column, text) if c in docs.columns]
    picked = docs.where(F.pmod(F.xxhash64(*keys), F.lit(SAMPLE)) == 0).select(F.col(text).alias("_text"), words_of(F.col(text)).alias("_words"))
    counted = picked.select(F.coalesce(F.length("_text"), F.lit(0)).alias("_chars"), F.size("_words").alias("_n"), *(c.alias(k) for k, c in (measures(F.col("_text"), F.col("_words")) | lazy_measures(F.col("_text"))).items()))
    at = {k: F.col(k) for k in (*MEASURES, *LAZY)}
    sums = counted.agg(F.count("*").alias("rows"), F.sum("_chars").alias("chars"), F.sum("_n").alias("words"), *(F.sum(F.coalesce(r.fails(at), F.lit(False)).cast("long")).alias(f"f{i}") for i, r in enumerate(rules))).first()
    rows = max(1, sums["rows"])
    costs = {k: (c * (sums["chars"] or 0) + w * (sums["words"] or 0)) / rows for k, (c, w) in (MEASURES | LAZY).items()}
    return [(r, sum(costs[k] for k in r.uses if k not in at_hand), (sums[f"f{i}"] or 0) / rows) for i, r in enumerate(rules)]


def ordered(estimates: list[tuple[Rule, float, float]]) -> list[Rule]:
    """Most rejections per cost first; rules that reject nothing come last, the cheap ones before the dear ones."""
    return [r for r, _, _ in sorted(estimates, key=lambda x: (-x[2] / (x[1] + 1), x[1], x[0].name))]


def plan(docs: DataFrame, rules: tuple[Rule, ...], text: str = "text", at_hand: tuple[str, ...] = (), id_column: str = "doc_id") -> list[Rule]:
    """The order of the rules for these documents."""
    return ordered(estimate(docs, rules, text, at_hand, id_column))


def cascade(rules: list[Rule], at: dict[str, Column]) -> Column:
    """True where no rule fails; a rule is evaluated only where all before it passed."""
    chain = F
    for rule in rules:
        chain = chain.when(rule.fails(at), F.lit(False))
    return chain.otherwise(F.lit(True)) if rules else F.lit(True)


def assess(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, the measures, base_failed, kept) of every row.

    Null and blank texts have no words, so they fail the base rules.  Repeated rows are judged alike, an empty table
    gives no row, and other columns are ignored.  The five measures are made for every row; those that only a rule of
    the cascade asks for are made where it is reached.
    """
    order = plan(docs, rules, text, tuple(MEASURES), id_column)
    base = docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("_text"), words_of(F.col(text)).alias("_words"))
    counted = base.select("doc_id", "_text", *(c.alias(k) for k, c in measures(F.col("_text"), F.col("_words")).items()))
    at = {k: F.col(k) for k in MEASURES} | lazy_measures(F.col("_text"))
    failed = BASE[0].fails(at) | BASE[1].fails(at)
    return counted.select("doc_id", *MEASURES, failed.alias("base_failed"), F.when(failed, F.lit(False)).otherwise(cascade(order, at)).alias("kept"))


def keep(docs: DataFrame, rules: tuple[Rule, ...] = BASE + RULES, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """The rows of ``docs``, all columns, that pass every rule.

    A text is split once, and a measure is made only for rows that reach a rule that asks for it.  Null and blank
    texts fail; repeated rows are judged alike; an empty table stays empty; columns may have any name, and ``docs``
    needs no id.
    """
    order = plan(docs, rules, text, (), id_column)
    passes = _bind(words_of(F.col(text)), lambda words: cascade(order, measures(F.col(text), words) | lazy_measures(F.col(text))))
    return docs.where(passes)
