"""License scans: templates against regular expressions and by hand, places of phrases by brute force."""

import random
import re

import pytest

from tapelake.llm import license_scan as scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def labels(text):
    return sorted({label for label, _, _ in scan.scan_text(text)[2]})


@pytest.mark.parametrize(("text", "expected"), [
    ("Released under the MIT License.", ["mit"]),
    ("released under the terms of the MIT (X11) license", ["mit"]),
    ("released under the terms of MIT license", []),
    ("This work is licensed under the GNU General Public License, version 3.", ["gpl-3"]),
    ("licensed under the GNU General Public License as published by the Free Software Foundation, either version 2 of the License", ["gpl-2"]),
    ("licensed under the GNU General Public License as published by the software foundation, version 2", []),
    ("Licensed under CC BY-NC 4.0.", ["cc-by-nc-4"]),
    ("Licensed under the Apache License, Version 2.0.", ["apache-2"]),
    ("Neither the name of the University of Somewhere nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.", ["bsd-3"]),
    ("Neither the name of " + "x " * 13 + "nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.", []),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction", ["mit"]),
    ("the mit building and its license", []),
    ("", []),
])
def test_templates(text, expected):
    assert labels(text) == expected
    assert labels("before " + text + " after") == expected


def test_automata_accept_what_their_patterns_say():
    random.seed(4)
    for template in (*(t for _, t in scan.TEMPLATES), "a [b|c d] {x:2} e [f]", "a [b] [b c] {x:3} b"):
        automaton, expression = scan.compile_template(template), re.compile(scan.pattern(template)[:-1] + "$")
        words = [w for w in re.findall(r"[a-z0-9]+", template) if not w.isdigit()] + ["other"]
        for _ in range(300):
            made = []
            for kind, value in scan.parts_of(template):
                if random.random() < 0.03:
                    made.append(random.choice(words))
                if kind == "word" and random.random() > 0.03:
                    made.append(value)
                elif kind == "any":
                    made += random.choices(words, k=random.randint(0, value + 1))
                elif kind == "optional" and random.random() < 0.5:
                    made += random.choice(value)
            whole = expression.match(" " + " ".join(made)) is not None
            assert (automaton.match([w.encode() for w in made], 0) == len(made)) == whole


@pytest.mark.parametrize("bad", ["", "[a] b", "{x:2} a", "a {x}", "a [b", "A"])
def test_bad_markup(bad):
    with pytest.raises(ValueError):
        scan.compile_template(bad)


def test_places():
    random.seed(5)
    phrases = [p.split() for p in scan.PHRASES]
    for _ in range(200):
        words = random.choices(["under", "the", "mit", "license", "cc", "by", "nc", "apache", "version", "2", "é"], k=80) + random.choice(phrases) * 2
        n, base, _ = scan.scan_text("-".join(words).upper().replace("É", "é"))
        assert n == len(words) and base == sorted((i, scan.PHRASES[" ".join(p)]) for p in phrases for i in range(len(words)) if words[i : i + len(p)] == p)


def test_hard_rows(spark):
    rows = [(1, None), (2, ""), (3, "under the mit license " * 20_000), (4, "cc by nc"), (4, "cc by nc"), (None, "Straße 2 naïve under_the_mit_license"), (6, "\x00under\x1fthe mit  LICENSE")]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, labels string, n_words int").repartition(3)
    got = {(r["doc_id"], r["n_words"]): r for r in scan.scan(df).collect()}
    assert scan.scan(df).count() == len(rows) and scan.scan(df.where("false")).count() == 0
    assert (got[1, 0]["labels"], got[1, 0]["first_word"], got[1, 0]["score"]) == ([], None, 0.0)
    assert (got[3, 80_000]["n_base"], got[3, 80_000]["first_word"], got[3, 80_000]["last_word"]) == (20_000, 0, 79_996)
    assert got[None, 7]["base_labels"] == ["mit"] and got[6, 4]["base_labels"] == ["mit"]
    assert len(WORD.findall("straße 2 naïve under_the_mit_license")) == 7
