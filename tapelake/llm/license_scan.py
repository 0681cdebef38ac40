"""License scans: phrases at their places, and licence notices by templates with optional and replaceable regions.

A template's markup is compiled into an automaton over words.  It accepts a run of words if all mandatory words are
there in order; optional regions may be left out, replaceable regions stand for a bounded number of any words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapelake.llm.common import steps

#: Phrases of the base scan and their labels: fixed values.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: Notices as people write them.  Words are mandatory, ``[...]`` is optional with bars between alternatives, ``{name:n}``
#: stands for one to n words.  The wording is that of the public licences: fixed values.
TEMPLATES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this {what:4} and associated documentation files [the software] to deal in the {what:4} without restriction [including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software]"),
    ("mit", "released under the [terms of the] mit [x11|expat] license"),
    ("isc", "permission to use copy modify and [or] distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd-3", "neither the name of {holder:12} nor the names of [its|his|other] contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("apache-2", "licensed under the apache license version 2 [0]"),
    ("gpl-2", "licensed under the gnu general public license [gpl] [as published by the free software foundation] [either] version 2 [of the license] [or at your option any later version]"),
    ("gpl-3", "licensed under the gnu general public license [gpl] [as published by the free software foundation] [either] version 3 [of the license] [or at your option any later version]"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu [lesser|affero] general public license as published by the free software foundation either version {version:2} of the license"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by", "licensed under [a|the] creative commons attribution [sharealike|noncommercial] {version:2} [international|unported|generic] license"),
    ("cc-by-nc-4", "licensed under [a|the] [creative commons] cc by nc 4 0 [international] [license]"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)

MARKUP = re.compile(r"\s*(?:\[([a-z0-9 |]+)\]|\{[a-z]+:(\d+)\}|([a-z0-9]+))")
#: Bytes that stand in no word become blanks, and A-Z small letters.
FOLD = bytes(b if b > 127 or 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
RESULT = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels array<string>, labels array<string>, score double, matches array<struct<label: string, first: int, stop: int>>"


def parts_of(template: str) -> list[tuple[str, list[list[str]] | int | str]]:
    """A template's regions: ("word", word), ("any", most words) or ("optional", alternatives)."""
    out, end = [], 0
    while end < len(template):
        m = MARKUP.match(template, end)
        if not m:
            raise ValueError(f"bad markup in {template[end:]!r}")
        out.append(("optional", [x.split() for x in m[1].split("|")]) if m[1] else ("any", int(m[2])) if m[2] else ("word", m[3]))
        end = m.end()
    if not out or out[0][0] != "word":
        raise ValueError("a template begins with a mandatory word")
    return out


@dataclass(frozen=True)
class Automaton:
    """``arcs[s]`` has (word, state) for each arc from state s; no word is an arc that takes none, ANY one that takes any.

    ``head`` are the mandatory words that it begins with.  States only lead to later ones, so that there is no cycle.
    """

    arcs: tuple[tuple[tuple[bytes | None, int], ...], ...]
    head: bytes

    def _closed(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for word, to in self.arcs[todo.pop()]:
                if word is None and to not in states:
                    states.add(to)
                    todo.append(to)
        return states

    def match(self, words: list[bytes], at: int) -> int | None:
        """Where the longest accepted run of words from ``at`` stops; None if there is none."""
        states, stop, final = self._closed({0}), None, len(self.arcs) - 1
        while states:
            if final in states:
                stop = at
            if at >= len(words):
                break
            states = self._closed({to for s in states for word, to in self.arcs[s] if word == words[at] or word == ANY})
            at += 1
        return stop


#: Marks an arc that takes any word; no word holds a blank.
ANY = b" "


def compile_template(template: str) -> Automaton:
    arcs: list[list[tuple[bytes | None, int]]] = [[]]

    def chain(start: int, words: list[bytes]) -> int:
        """Arcs from a state to a new one by way of these words."""
        for word in words:
            arcs.append([])
            arcs[start].append((word, len(arcs) - 1))
            start = len(arcs) - 1
        return start

    at, head = 0, []
    for kind, value in parts_of(template):
        if kind == "word":
            at = chain(at, [value.encode()])
            if len(head) == at - 1:
                head.append(value.encode())
            continue
        ends = [at] if kind == "optional" else []
        if kind == "any":
            for _ in range(value):
                at = chain(at, [ANY])
                ends.append(at)
        else:
            ends += [chain(at, [w.encode() for w in words]) for words in value]
        arcs.append([])
        at = len(arcs) - 1
        for end in ends:
            arcs[end].append((None, at))
    return Automaton(tuple(map(tuple, arcs)), b" " + b" ".join(head) + b" ")


@lru_cache(maxsize=4)
def automata(templates: tuple[tuple[str, str], ...]) -> list[tuple[str, Automaton]]:
    return [(label, compile_template(t)) for label, t in templates]


def places(joined: bytes, phrase: bytes) -> Iterator[int]:
    """Numbers of the words at which a phrase stands; both are words with a blank before and after each."""
    at, seen, number = joined.find(phrase), 0, 0
    while at >= 0:
        number += joined.count(b" ", seen, at)
        yield number
        seen, at = at, joined.find(phrase, at + 1)


def scan_text(text: str, templates: tuple[tuple[str, str], ...] = TEMPLATES) -> tuple[int, list[tuple[int, str]], list[tuple[str, int, int]]]:
    """(words, base phrases by place, matches of templates as label, first word and the word after the last)."""
    words = text.encode().translate(FOLD).split()
    joined = b" " + b" ".join(words) + b" "
    base = [(at, label) for phrase, label in PHRASES.items() for at in places(joined, f" {phrase} ".encode())]
    found = []
    for label, automaton in automata(templates):
        for at in places(joined, automaton.head):
            stop = automaton.match(words, at)
            if stop is not None:
                found.append((label, at, stop))
    return len(words), sorted(base), sorted(found, key=lambda m: (m[1], m[2], m[0]))


def scan(docs: DataFrame, id_column: str = "doc_id", text: str = "text", templates: tuple[tuple[str, str], ...] = TEMPLATES) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, matches) of every row.

    Words are runs of digits, letters a-z (A-Z are folded) and characters beyond ASCII, counted from 0.  ``n_base`` counts the
    places of all phrases, ``first_word`` and ``last_word`` are the least and greatest of them, null without any.  ``matches`` are
    what templates accept; where several runs begin at a place, the longest.  ``labels`` are those of phrases and templates,
    each once and sorted.  ``score`` is 1 - 2 ** -(n_base + 3 * labels of templates): 0 without any sign.

    Whole texts are scanned.  Null texts count as empty: no words, no labels, score 0.  Repeated rows stay, a null id stays null,
    an empty table gives no row, and other columns are ignored.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(RESULT))

    def row(doc: int | None, content: str | None) -> tuple:
        n, base, found = scan_text(content or "", templates)
        of_base, of_templates = {label for _, label in base}, {label for label, _, _ in found}
        score = 1 - 0.5 ** (len(base) + 3 * len(of_templates))
        spans = [{"label": label, "first": first, "stop": stop} for label, first, stop in found]
        return doc, n, len(base), base[0][0] if base else None, base[-1][0] if base else None, sorted(of_base), sorted(of_base | of_templates), score, spans

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, "text"):
                rows = [row(d, t) for d, t in zip(*(c.to_pylist() for c in part.columns), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), type=f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)], schema=arrow)

    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, RESULT)


def pattern(template: str) -> str:
    """A regular expression for texts of words with a blank before each, which says what the automaton accepts."""
    out = []
    for kind, value in parts_of(template):
        if kind == "word":
            out.append(f" {value}")
        elif kind == "any":
            out.append(rf"( [^ ]+){{1,{value}}}")
        else:
            out.append("(" + "|".join("".join(f" {w}" for w in words) for words in value) + ")?")
    return "".join(out) + " "
