"""Cross-tokenizer alignment: which tokens of one vocabulary cover the bytes of which tokens of another.

A text is a row of bytes that both vocabularies cut.  Where both have a cut, a group ends.  A fragment describes a
range of bytes without what lies around it: the tokens before its first common cut (open prefix), the groups between
common cuts (closed), and the tokens after its last (open suffix).  Fragments of neighbouring ranges compose, and
composition is associative, so ranges of a very long text are cut up by many tasks and put together by a tree.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapelake.llm.common import cut, steps

#: Characters of a range; longer texts are cut.  A stretch of SPAN characters without any blank is never cut.
RANGE, SPAN = 1 << 15, 1 << 12
#: Ranges that one step of the tree composes.
FAN = 16
#: Units that a worker remembers, and the longest of them in characters.
CACHE, LONGEST = 150_000, 48
#: Characters of texts that a worker cuts up at once.
STEP = 1 << 19
#: Counts of pairs that travel with the tasks at most, and how finely frequencies are told apart to choose them.
KNOWN, FINENESS = 1 << 18, 4
#: Bytes of results that a task gives away together.
OUT = 4 << 20
#: Distinct pairs that a task holds before it gives their counts away.
HELD = 1 << 20
#: Places where both vocabularies always cut: before a blank or a line feed that follows a non-blank.
CUT = re.compile(r"(?<=\S)(?=[ \n])")
WIDE = re.compile(r"\s\s|\x01")
HALF = 32
NONE = np.zeros(0, dtype=np.int64)

#: The bytes that stand for themselves in byte-level vocabularies; the others follow from 256 on.
PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]

FRAGMENT = "key long, doc_id long, part long, bad boolean, bound boolean, groups string, n_a long, n_b long, n_groups long, n_links long, links binary, prefix_a binary, prefix_b binary, suffix_a binary, suffix_b binary"


def byte_letters() -> dict[str, int]:
    """The letter of each byte in byte-level vocabularies."""
    rest = [b for b in range(256) if b not in set(PLAIN)]
    return {chr(b): b for b in PLAIN} | {chr(256 + i): b for i, b in enumerate(rest)}


def units_of(text: str) -> list[str]:
    """The text between neighbouring places of CUT; where no two blanks meet, each blank is such a place, which is found faster."""
    if not text[:1].isspace() or WIDE.search(text):
        return CUT.split(text)
    return text.replace(" ", "\x01 ").replace("\n", "\x01\n").lstrip("\x01").split("\x01")


# Fragments


def _tokens(ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return np.stack([np.asarray(ids, dtype=np.int64), np.asarray(sizes, dtype=np.int64)])


EMPTY = _tokens(NONE, NONE)


def said(a: list[int], b: list[int]) -> str:
    """One group as text: the first vocabulary's ids, a bar, the other's."""
    return f"{','.join(map(str, a))}|{','.join(map(str, b))};"


def overlaps(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Codes of all pairs of tokens whose byte ranges overlap; both sides (ids, sizes) cover the same bytes.

    Between two neighbouring cuts of either side lies one token of each, and every overlapping pair has one such place.
    """
    ends_a, ends_b = np.cumsum(a[1]), np.cumsum(b[1])
    ends = np.union1d(ends_a, ends_b)
    return (a[0][np.searchsorted(ends_a, ends)] << HALF) | b[0][np.searchsorted(ends_b, ends)]


@dataclass
class Fragment:
    """A range of bytes: what is closed, and the open tokens (ids, sizes) of both sides before and after it.

    ``bound`` tells that it holds a common cut; without one all its tokens are prefix.  ``codes`` are linked pairs, each
    ``times`` times, in any order.  ``bad`` tells that the two sides don't cover the same bytes.
    """

    bound: bool = False
    groups: str = ""
    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0
    n_links: int = 0
    codes: np.ndarray = field(default_factory=lambda: NONE)
    times: np.ndarray = field(default_factory=lambda: NONE)
    prefix: tuple[np.ndarray, np.ndarray] = (EMPTY, EMPTY)
    suffix: tuple[np.ndarray, np.ndarray] = (EMPTY, EMPTY)
    bad: bool = False

    def __add__(self, right: Fragment) -> Fragment:
        """The fragment of both ranges; ``Fragment()`` is neutral."""
        bad = self.bad or right.bad
        joined = tuple(np.concatenate([x, y], axis=1) for x, y in zip(self.suffix if self.bound else self.prefix, right.prefix, strict=True))
        if not self.bound:
            return Fragment(right.bound, right.groups, right.n_a, right.n_b, right.n_groups, right.n_links, right.codes, right.times, joined, right.suffix, bad)
        if not right.bound:
            return Fragment(True, self.groups, self.n_a, self.n_b, self.n_groups, self.n_links, self.codes, self.times, self.prefix, joined, bad)
        a, b = joined
        bad = bad or int(a[1].sum()) != int(b[1].sum())
        links = NONE if bad else overlaps(a, b)
        middle = said(a[0].tolist(), b[0].tolist())
        return Fragment(
            True, self.groups + middle + right.groups, self.n_a + a.shape[1] + right.n_a, self.n_b + b.shape[1] + right.n_b, self.n_groups + 1 + right.n_groups, self.n_links + len(links) + right.n_links,
            np.concatenate([self.codes, links, right.codes]), np.concatenate([self.times, np.ones(len(links), dtype=np.int64), right.times]), self.prefix, right.suffix, bad,
        )

    def closed(self) -> Fragment:
        """The fragment as a whole text: its beginning is a common cut, and so must be its end."""
        whole = Fragment(bound=True) + self
        if whole.suffix[0].shape[1] or whole.suffix[1].shape[1]:
            whole.bad = True
        return whole


def fragment(a: np.ndarray, b: np.ndarray, first: int, last: int) -> Fragment:
    """The tokens that end in (first, last]; both sides begin at byte 0, and a byte range knows nothing of its neighbours."""
    ends = [np.cumsum(side[1]) for side in (a, b)]
    held = [slice(*np.searchsorted(e, [first, last], "right")) for e in ends]
    common = np.intersect1d(ends[0][held[0]], ends[1][held[1]])
    if not len(common):
        return Fragment(prefix=(a[:, held[0]], b[:, held[1]]))
    cut_a, cut_b = (np.searchsorted(e, common, "right") for e in ends)
    closed_a, closed_b = a[:, cut_a[0] : cut_a[-1]], b[:, cut_b[0] : cut_b[-1]]
    ids_a, ids_b = a[0].tolist(), b[0].tolist()
    cuts = list(zip(cut_a.tolist(), cut_b.tolist(), strict=True))
    groups = "".join(said(ids_a[x:p], ids_b[y:q]) for (x, y), (p, q) in zip(cuts, cuts[1:]))
    codes = overlaps(closed_a, closed_b)
    return Fragment(
        True, groups, closed_a.shape[1], closed_b.shape[1], len(cuts) - 1, len(codes), codes, np.ones(len(codes), dtype=np.int64),
        (a[:, held[0].start : cut_a[0]], b[:, held[1].start : cut_b[0]]), (a[:, cut_a[-1] : held[0].stop], b[:, cut_b[-1] : held[1].stop]),
    )


# Vocabularies


class Aligner:
    """Both tokenizers, and the alignment of units of text that were met before.

    A unit lies between two neighbouring places of CUT.  Neither vocabulary has a token across such a place, so units
    are encoded apart; each is a closed fragment that a worker remembers.
    """

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(path_a), sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        letters = byte_letters()
        entries = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(entries.values()) + 1)
        for token, i in entries.items():
            self.bytes_a[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        if any("▁" in p.lstrip("▁") or "\n" in p for p in pieces):
            raise ValueError("the second vocabulary has pieces across blanks; texts can't be cut there")
        self.blank = self.b.piece_to_id("▁")
        self.size_a, self.size_b = (np.array([len(x) for x in side], dtype=np.int64) for side in (self.bytes_a, self.bytes_b))
        self._forget()

        self.words_a, self.words_b = ([np.array([f"{i}{mark}" for i in range(len(side))], dtype=object) for mark in marks] for side, marks in ((self.bytes_a, ",|"), (self.bytes_b, ",;")))
        self._forget()

    def _forget(self) -> None:
        self.index: dict[str, int] = {}
        self.groups: list[str] = []
        self.codes, self.sizes, self.table = NONE, NONE, np.zeros((0, 5), dtype=np.int64)

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, bool]:
        """The tokens (ids, sizes) of both sides for one unit or several in a row, and whether a side can't give back its bytes.

        The second side puts a blank before what it encodes: the text's own, or one to leave out.
        """
        spaced = text.startswith(" ")
        a = self.a.encode(text, add_special_tokens=False).ids
        b = [self.blank] if text == " " else self.b.encode(text[1:] if spaced else text)[0 if spaced else 1 :]
        raw = text.encode()
        bad = b"".join(map(self.bytes_a.__getitem__, a)) != raw or b"".join(map(self.bytes_b.__getitem__, b)) != raw
        return _tokens(a, self.size_a[a]), _tokens(b, self.size_b[b]), bad

    def learn(self, units: set[str]) -> None:
        """Align units that weren't met yet, all in one go; beyond CACHE of them all are forgotten first.

        Units with U+2581, which stands for a blank in the second vocabulary, can't be given back.
        """
        if len(self.index) > CACHE:
            self._forget()
        new = [u for u in units if u not in self.index]
        broken = [u for u in new if "▁" in u]
        whole = [u for u in new if "▁" not in u]
        for some, made in ((whole, self._aligned(whole)), (broken, None)) if new else ():
            if made is None and len(some) > 1 and some is whole:  # one of them can't be given back
                parts = [self._aligned([u]) for u in some]
                groups = [g for p in parts for g in (p[0] if p else [""])]
                table = np.concatenate([p[1] if p else self._unknown(1) for p in parts])
                codes = np.concatenate([p[2] if p else NONE for p in parts])
            elif made is None:
                groups, table, codes = [""] * len(some), self._unknown(len(some)), NONE
            else:
                groups, table, codes = made
            self.index.update(zip(some, range(len(self.groups), len(self.groups) + len(some)), strict=True))
            self.groups += groups
            self.table, self.codes = np.concatenate([self.table, table]), np.concatenate([self.codes, codes])
        self.starts = np.cumsum(self.table[:, 3]) - self.table[:, 3]

    @staticmethod
    def _unknown(n: int) -> np.ndarray:
        return np.tile(np.array([0, 0, 0, 0, 1], dtype=np.int64), (n, 1))

    def _aligned(self, units: list[str]) -> tuple[list[str], np.ndarray, np.ndarray] | None:
        """(groups as text, numbers, codes) of units, encoded in a row; None if they can't be given back."""
        if not units:
            return [], np.zeros((0, 5), dtype=np.int64), NONE
        a, b, bad = self.encode("".join(units))
        stops = np.cumsum([len(u.encode()) for u in units])
        ends_a, ends_b = np.cumsum(a[1]), np.cumsum(b[1])
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)
        if bad or not np.isin(stops, common, assume_unique=True).all():
            return None
        every = np.union1d(ends_a, ends_b)
        codes = (a[0][np.searchsorted(ends_a, every)] << HALF) | b[0][np.searchsorted(ends_b, every)]
        in_a, in_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)  # group of each token
        last_a, last_b = np.searchsorted(ends_a, common, "right"), np.searchsorted(ends_b, common, "right")
        words = np.empty(len(ends_a) + len(ends_b), dtype=object)
        closes_a, closes_b = np.isin(np.arange(len(ends_a)), last_a - 1), np.isin(np.arange(len(ends_b)), last_b - 1)
        before_b = np.concatenate([[0], last_b[:-1]])
        words[np.arange(len(ends_a)) + before_b[in_a]] = np.where(closes_a, self.words_a[1][a[0]], self.words_a[0][a[0]])
        words[np.arange(len(ends_b)) + last_a[in_b]] = np.where(closes_b, self.words_b[1][b[0]], self.words_b[0][b[0]])
        counts = [np.diff(np.searchsorted(x, stops, "right"), prepend=0) for x in (ends_a, ends_b, common, every)]
        edges = np.cumsum(counts[0] + counts[1]).tolist()
        words = words.tolist()
        groups = ["".join(words[x:y]) for x, y in zip([0, *edges], edges)]
        return groups, np.stack([*counts, np.zeros(len(units), dtype=np.int64)], axis=1), codes

    def known(self, units: list[str]) -> Fragment:
        """The closed fragment of units that were learnt."""
        at = list(map(self.index.__getitem__, units))
        places, times = np.unique(np.array(at, dtype=np.int64), return_counts=True)
        sums, sizes = times @ self.table[places], self.table[places, 3]
        codes = self.codes[np.repeat(self.starts[places] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))]
        return Fragment(True, "".join(map(self.groups.__getitem__, at)), *map(int, sums[:4]), codes, np.repeat(times, sizes), bad=bool(sums[4]))


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    """One aligner for each worker process and pair of vocabularies."""
    return Aligner(path_a, path_b)


def align_texts(tool: Aligner, texts: list[str]) -> Iterator[Fragment]:
    """The closed fragments of whole texts, given with their blank in front."""
    start = 0
    while start < len(texts):
        stop, size = start, 0
        while stop < len(texts) and (stop == start or size + len(texts[stop]) <= STEP):
            size += len(texts[stop])
            stop += 1
        cut_up = [units_of(t) for t in texts[start:stop]]
        tool.learn({u for units in cut_up for u in units if len(u) <= LONGEST})
        for units in cut_up:
            if max(map(len, units)) <= LONGEST:
                yield tool.known(units)
                continue
            whole, run = Fragment(bound=True), []
            for unit in units:
                if len(unit) <= LONGEST:
                    run.append(unit)
                    continue
                a, b, bad = tool.encode(unit)
                long = Fragment(bad=True) if bad else Fragment(bound=True) + fragment(a, b, 0, int(a[1].sum()))
                whole, run = _append(_append(whole, tool.known(run)), long), []
            yield _append(whole, tool.known(run))
        start = stop


def _append(left: Fragment, right: Fragment) -> Fragment:
    """Two fragments that meet at a common cut, the left one closed at its end."""
    return Fragment(
        True, left.groups + right.groups, left.n_a + right.n_a, left.n_b + right.n_b, left.n_groups + right.n_groups, left.n_links + right.n_links,
        np.concatenate([left.codes, right.codes]), np.concatenate([left.times, right.times]), left.prefix, right.suffix, left.bad or right.bad,
    )


def align_range(tool: Aligner, text: str, first: int, last: int) -> Fragment:
    """The fragment of the bytes that characters first to last take; ``text`` reaches to the next places of CUT around them.

    The units at both ends are cut anywhere; those between them are known whole.
    """
    if first == last:
        return Fragment()
    units = units_of(text)
    starts = np.concatenate([[0], np.cumsum([len(u) for u in units])]).tolist()
    whole, run = Fragment(), []

    def flush() -> None:
        nonlocal whole
        if run:
            tool.learn({*run})
            whole = _append(whole, tool.known(run))
            run.clear()

    for unit, start, stop in zip(units, starts, starts[1:]):
        if first <= start and stop <= last and len(unit) <= LONGEST and whole.bound and not whole.suffix[0].shape[1] and not whole.suffix[1].shape[1]:
            run.append(unit)
            continue
        flush()
        a, b, bad = tool.encode(unit)
        if bad:
            return Fragment(bad=True)
        low, high = (len(unit[: max(0, x - start)].encode()) for x in (first, last))
        whole = whole + fragment(a, b, low, high)
    flush()
    return whole


def ranges(text: str, size: int = RANGE, span: int = SPAN) -> list[tuple[int, int, int, int]]:
    """(from, to, first, last): the character ranges of a text, and how far one must read to cut their edges as the whole text is cut."""
    edges = [0]
    while edges[-1] + size < len(text):
        edge = edges[-1] + size
        before = [m.start() for m in CUT.finditer(text, max(0, edge - span), edge)]
        after = CUT.search(text, edge, min(len(text), edge + span))
        if not before or after is None:
            found = CUT.search(text, edge)
            edge = found.start() if found else len(text)
        if edge >= len(text):
            break
        edges.append(edge)
    edges.append(len(text))
    out = []
    for first, last in zip(edges, edges[1:]):
        low, high = max(0, first - span), min(len(text), last + span)
        start = max([m.start() for m in CUT.finditer(text, low, first + 1) if m.start() <= first], default=0)
        stop = CUT.search(text, last, high) if last < len(text) else None
        out.append((start, stop.start() if stop else len(text), first - start, last - start))
    return out


# Jobs


def _row(key: int, doc: int | None, part: int, f: Fragment) -> tuple:
    return key, doc, part, f.bad, f.bound, f.groups, f.n_a, f.n_b, f.n_groups, f.n_links, packed_links(f.codes, f.times), *(x.tobytes() for x in (*f.prefix, *f.suffix))


def _fragment_of(r) -> Fragment:
    sides = [np.frombuffer(r[n], dtype=np.int64).reshape(2, -1) for n in ("prefix_a", "prefix_b", "suffix_a", "suffix_b")]
    return Fragment(r["bound"], r["groups"], r["n_a"], r["n_b"], r["n_groups"], r["n_links"], *unpacked_links(r["links"]), (sides[0], sides[1]), (sides[2], sides[3]), r["bad"])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(list(c), type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Batches of about OUT bytes of texts and bytes; a row may be larger."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(x) for x in row if isinstance(x, (str, bytes)))
        if size > OUT:
            yield _batch(held, schema)
            held, size = [], 0
    yield _batch(held, schema)


def _schema(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def long_fragments(docs: DataFrame, path_a: str, path_b: str, size: int = RANGE) -> DataFrame:
    """One fragment row of each of ``docs`` (key, doc_id, text), whose ranges are aligned by many tasks and composed by a tree."""
    arrow, parts = _schema(FRAGMENT), _schema("key long, doc_id long, part long, text string, first long, last long")

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, doc, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                spaced = " " + text
                yield from _batches(((key, doc, i, spaced[a:b], x, y) for i, (a, b, x, y) in enumerate(ranges(spaced, size))), parts)

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = aligner(path_a, path_b)
        for batch in batches:
            for part in steps(batch, "text"):
                yield from _batches((_row(key, doc, i, align_range(tool, text, first, last)) for key, doc, i, text, first, last in zip(*(c.to_pylist() for c in part.columns), strict=True)), arrow)

    def compose(rows: pd.DataFrame) -> pd.DataFrame:
        whole = Fragment()
        ordered = rows.sort_values("part").to_dict("records")
        for r in ordered:
            whole = whole + _fragment_of(r)
        doc = ordered[0]["doc_id"]
        return pd.DataFrame([_row(ordered[0]["key"], None if pd.isna(doc) else int(doc), int(ordered[0]["part"]) // FAN, whole)], columns=arrow.names)

    longest = docs.agg(F.max(F.length("text"))).first()[0] or 0
    made = docs.mapInArrow(cut_up, "key long, doc_id long, part long, text string, first long, last long").repartition("key", "part").mapInArrow(align, FRAGMENT)
    most = longest // size + 2
    while most > 1:
        made = made.groupBy("key", F.floor(F.col("part") / FAN).alias("node")).applyInPandas(lambda key, rows: compose(rows), FRAGMENT)
        most = -(-most // FAN)
    return made


RESULT = "key long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, links binary"


def align(docs: DataFrame, path_a: str, path_b: str, id_column: str = "doc_id", text: str = "text", size: int = RANGE) -> DataFrame:
    """(key, doc_id, n_a, n_b, n_groups, n_links, groups, links): the alignment of every row of ``docs``.

    ``path_a`` is a byte-level tokenizer file, ``path_b`` a piece model; both encode a blank and the text.  ``groups`` says which
    ids of both cover the same bytes, ``a1,a2|b1;a3|b2``.  A link is a pair of token occurrences whose bytes overlap; ``links``
    has a row's distinct pairs of ids for ``with_counts``.  ``key`` tells rows apart.

    Null and empty texts, and those that either vocabulary can't give back byte by byte, get zeros and ''.  Repeated
    rows have equal results; a null id stays null; an empty table gives no row; other columns are ignored.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("key"), F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    arrow = _schema(RESULT)

    def out(key: int, doc: int | None, f: Fragment) -> tuple:
        return (key, doc, 0, 0, 0, 0, "", b"") if f.bad else (key, doc, f.n_a, f.n_b, f.n_groups, f.n_links, f.groups[:-1], packed_links(f.codes, f.times))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = aligner(path_a, path_b)
        for batch in batches:
            for part in steps(batch, "text"):
                keys, ids, texts = (c.to_pylist() for c in part.columns)
                found = align_texts(tool, [" " + t for t in texts])
                yield from _batches((out(k, d, f if t else Fragment(bad=True)) for k, d, t, f in zip(keys, ids, texts, found, strict=True)), arrow)

    def composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                yield _batch([out(r["key"], r["doc_id"], _fragment_of(r).closed())], arrow)

    short, long = rows.where(F.length("text") < size), rows.where(F.length("text") >= size)
    return short.mapInArrow(whole, RESULT).unionByName(long_fragments(long, path_a, path_b, size).mapInArrow(composed, RESULT))


def packed_links(codes: np.ndarray, times: np.ndarray) -> bytes:
    """Distinct codes, sorted, and how often each occurs: differences, low halves and counts, compressed."""
    distinct, place = np.unique(codes, return_inverse=True)
    counts = np.bincount(place, weights=times, minlength=len(distinct)).astype("<u4")
    planes = np.diff(distinct >> HALF, prepend=0).astype("<u4"), (distinct & 0xFFFFFFFF).astype("<u4"), counts
    raw = b"".join(x.tobytes() for x in planes)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpacked_links(links: bytes) -> tuple[np.ndarray, np.ndarray]:
    if not links:
        return NONE, NONE
    raw = pa.decompress(links[8:], decompressed_size=int.from_bytes(links[:8], "little"), codec="zstd", asbytes=True)
    a, b, times = np.frombuffer(raw, dtype="<u4").reshape(3, -1).astype(np.int64)
    return (np.cumsum(a) << HALF) | b, times


def with_counts(rows: DataFrame, known: int = KNOWN) -> tuple[DataFrame, DataFrame]:
    """The rows of ``align`` with ``n_best`` and ``count_sum`` instead of key and links, and all pairs as (code, n, best).

    A pair of ids counts the rows that hold it linked; its code is ``a << 32 | b``, and it is best if no other pair of its
    first id counts more.  ``n_best`` counts a row's links whose pair is best, ``count_sum`` adds up the counts of its links.
    Up to ``known`` frequent pairs travel with the tasks, the others meet their counts in a join.  Rows are stored on the
    way, so leave out or digest ``groups`` where they are long.  An empty table gives no row and no pair.
    """
    stored = cut(rows)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, waiting, total = (NONE, NONE), [], 0
        for batch in batches:
            for links in batch.column(0).to_pylist():
                waiting.append(unpacked_links(links)[0])
                total += len(waiting[-1])
                if total > HELD:
                    held, waiting, total = _summed(held, waiting), [], 0
                    if len(held[0]) > HELD:
                        yield pa.RecordBatch.from_arrays(list(map(pa.array, held)), names=["code", "n"])
                        held = NONE, NONE
        yield pa.RecordBatch.from_arrays(list(map(pa.array, _summed(held, waiting))), names=["code", "n"])

    counts = cut(stored.select("links").mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")))
    first = F.shiftright("code", HALF)
    best = counts.groupBy(first.alias("a")).agg(F.max("n").alias("most"))
    pairs = cut(counts.join(best, first == F.col("a")).select("code", "n", (F.col("n") == F.col("most")).cast("long").alias("best")))
    lookup = rows.sparkSession.sparkContext.broadcast(_frequent(pairs, known))
    sums = "key long, n_best long, count_sum long, rest array<struct<code: long, times: long>>"
    arrow = _schema(sums)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, n, best = lookup.value
        for batch in batches:
            out = []
            for key, links in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                mine, times = unpacked_links(links)
                at = np.searchsorted(codes, mine)
                there = np.append(codes, -1)[at] == mine
                rest = [{"code": c, "times": t} for c, t in zip(mine[~there].tolist(), times[~there].tolist(), strict=True)]
                at, times = at[there], times[there]
                out.append((key, int((times * best[at]).sum()), int((times * n[at]).sum()), rest))
            yield _batch(out, arrow)

    added = cut(stored.select("key", "links").mapInArrow(add, sums))
    left = added.select("key", F.explode("rest").alias("r")).select("key", "r.code", "r.times")
    more = left.join(pairs, "code").groupBy("key").agg(F.sum(F.col("times") * F.col("best")).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    whole = added.drop("rest") if left.isEmpty() else added.drop("rest").unionByName(more).groupBy("key").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    kept = [c for c in rows.columns if c not in ("key", "links")]
    return stored.join(whole, "key").select(*kept, "n_best", "count_sum"), pairs


def _summed(held: tuple[np.ndarray, np.ndarray], more: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(codes, counts) with one more for each code in ``more``."""
    if not more:
        return held
    codes, place = np.unique(np.concatenate([held[0], *more]), return_inverse=True)
    weights = np.concatenate([held[1], np.ones(sum(map(len, more)), dtype=np.int64)])
    return codes, np.bincount(place, weights=weights, minlength=len(codes)).astype(np.int64)


def _frequent(pairs: DataFrame, known: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, counts, whether best) of the most frequent pairs, ``known`` at most: whole steps of frequency, so that ties go together."""
    step = F.floor(F.log2("n") * FINENESS).cast("int")
    held, least = 0, 0
    for r in sorted(pairs.groupBy(step.alias("step")).count().collect(), reverse=True):
        held += r["count"]
        if held > known:
            least = r["step"] + 1
            break
    rows = pairs.where(step >= least).toArrow().sort_by("code")
    return tuple(rows.column(c).to_numpy().astype(np.int64) for c in ("code", "n", "best"))
