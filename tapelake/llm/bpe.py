"""Byte-level BPE: encoding by a contiguous rank array, and decoding.

The vocabulary file is a parameter (a tokenizers JSON file that every executor can read); nothing of it is copied.
A text is cut into pieces by the vocabulary's public pattern.  A piece keeps its part boundaries and the ranks of
adjacent pairs in two flat lists: the least rank is found by a scan, its boundary deleted, and the two neighbouring
ranks refreshed.  Pieces longer than SHORT use a heap over a linked list, which merges in the same order.
"""

from __future__ import annotations

import heapq
import json
import struct
from functools import lru_cache

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapelake.llm.common import map_batches

#: Fixed pattern of the byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Bytes up to which a piece is merged by scanning.
SHORT = 256
#: Entries at which a worker's caches stop growing; common words come early.
CACHE = 250_000
NEVER = 1 << 60


def byte_letters() -> dict[str, int]:
    """The public byte-to-letter table: printable Latin-1 stands for itself, other bytes follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Found(dict):
    """Values looked up once by ``find``, as long as there is room."""

    def __init__(self, find, room: int = CACHE):
        super().__init__()
        self.find, self.room = find, room

    def __missing__(self, key: str) -> bytes:
        value = self.find(key)
        if len(self) < self.room:
            self[key] = value
        return value


class BytePairCodec:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_letters()
        special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.bytes_of = {i: bytes(letters[c] for c in t) for t, i in spec["model"]["vocab"].items() if t not in special}
        self.id_of = {b: i for i, b in self.bytes_of.items()}
        merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in spec["model"]["merges"]]
        self.rank = {bytes(letters[c] for c in m): r for r, m in enumerate(merged)}
        self.bytes_of |= {i: s.encode() for s, i in special.items()}
        self.special = special
        self.first = {x[0] for x in special}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.pattern = regex.compile(PATTERN)
        self.wide_blank = regex.compile(r"\s\s|^\s|\s$")
        self.pieces = Found(lambda piece: self._packed(piece.encode()))
        self.chunks = Found(lambda word: self._chunk(" " + word))
        self.begins = Found(self._chunk)
        self.line = self._packed(b"\n") if b"\n" in self.id_of else b""
        self.simple = bool(self.line) and not any(c.isspace() for x in special for c in x)

    def merge(self, piece: bytes) -> list[bytes]:
        """The parts of one piece after all merges, lowest rank and leftmost first."""
        if len(piece) > SHORT:
            return self._merge_long(piece)
        rank = self.rank
        edge = list(range(len(piece) + 1))
        ranks = [rank.get(piece[i : i + 2], NEVER) for i in range(len(piece) - 1)]
        while ranks:
            least = min(ranks)
            if least == NEVER:
                break
            i = ranks.index(least)
            del edge[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = rank.get(piece[edge[i] : edge[i + 2]], NEVER)
            if i:
                ranks[i - 1] = rank.get(piece[edge[i - 1] : edge[i + 1]], NEVER)
        return [piece[a:b] for a, b in zip(edge, edge[1:])]

    def _merge_long(self, piece: bytes) -> list[bytes]:
        n, rank = len(piece), self.rank
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n
        heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := rank.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, j, end = heapq.heappop(heap)
            if not alive[i] or after[i] != j or j >= n or after[j] != end:
                continue
            alive[j], after[i] = False, end
            if end < n:
                before[end] = i
                stop = after[end]
                if (r := rank.get(piece[i:stop])) is not None:
                    heapq.heappush(heap, (r, i, end, stop))
            if (b := before[i]) >= 0 and (r := rank.get(piece[b:end])) is not None:
                heapq.heappush(heap, (r, b, i, end))
        out, i = [], 0
        while i < n:
            out.append(piece[i : after[i]])
            i = after[i]
        return out

    def ids_of(self, piece: bytes) -> list[int]:
        """The ids of one piece of the pattern."""
        return [self.id_of[p] for p in self.merge(piece)]

    def _packed(self, piece: bytes) -> bytes:
        ids = self.ids_of(piece)
        return struct.pack(f"<{len(ids)}I", *ids)

    def _chunk(self, chunk: str) -> bytes:
        """Ids of a word with the blank before it; letters alone make one piece."""
        word = chunk[1:] if chunk.startswith(" ") else chunk
        return self._packed(chunk.encode()) if word.isascii() and word.isalpha() else self._span(chunk)

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.pattern.findall(text)))

    def _span(self, text: str) -> bytes:
        if not any(map(text.__contains__, self.first)):
            return self._plain(text)
        return b"".join(struct.pack("<I", self.special[p]) if p in self.special else self._plain(p) for p in self.cut.split(text) if p)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers.

        A blank between two non-blanks always begins a piece, and a line feed between two is a piece, so texts without
        wider blanks are cut there and each chunk's ids are looked up whole.
        """
        if self.wide_blank.search(text) or not self.simple:
            return self._span(text)
        if not text:
            return b""
        out = []
        for line in text.split("\n"):
            first, *rest = line.split(" ")
            out.append(self.begins[first] + b"".join(map(self.chunks.__getitem__, rest)))
        return self.line.join(out)

    def decode(self, ids: bytes) -> str:
        """The text of ids; special tokens give their names, and broken UTF-8 gives replacement characters."""
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, dtype="<u4").tolist())).decode("utf-8", "replace")


@lru_cache(maxsize=4)
def codec(path: str) -> BytePairCodec:
    """One codec for each worker process and vocabulary."""
    return BytePairCodec(path)


def encode(df: DataFrame, path: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_tokens, ids) of every row: ids as binary, four bytes each.

    Null texts count as empty; repeated rows stay; an empty table gives no row; other columns are ignored.
    """

    def run(rows: dict) -> dict:
        ids = [codec(path).encode(t or "") for t in rows["text"]]
        return {"id": rows["id"], "n_tokens": [len(x) // 4 for x in ids], "ids": ids}

    return map_batches(df.select(F.col(id_column).cast("long").alias("id"), F.col(text).alias("text")), "id long, n_tokens long, ids binary", run, "text")


def decode(df: DataFrame, path: str) -> DataFrame:
    """Add ``text`` to (id, n_tokens, ids); null ids give null."""

    def run(rows: dict) -> dict:
        return {k: rows[k] for k in ("id", "n_tokens", "ids")} | {"text": [None if x is None else codec(path).decode(x) for x in rows["ids"]]}

    return map_batches(df.select("id", "n_tokens", "ids"), "id long, n_tokens long, ids binary, text string", run, "ids")


def digests(encoded: DataFrame) -> DataFrame:
    """Hexadecimal digests of ids and decoded text."""
    return encoded.select(F.col("id").alias("doc_id"), "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))


