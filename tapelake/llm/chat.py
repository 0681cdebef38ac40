"""Chat formatting at token level.

Every segment of a turn (opening mark, role, text, closing mark) is encoded by itself; the marks are reserved ids
beyond the vocabulary, which no text can encode to.  Control strings inside texts are escaped besides, so that the
formatted string can be read back as well: a ``<`` followed by k backslashes and a ``|`` gets one more backslash.
The loss mask comes from prefix sums over segment lengths.  A turn is one row, so encoding spreads over all rows
whatever the length of a conversation, and so does decoding; only digests walk a conversation in order, as a stream.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapelake.llm.bpe import BytePairCodec, byte_letters
from tapelake.llm.common import map_batches, steps

START, STOP = "<|im_start|>", "<|im_end|>"
#: Roles whose text is learned from.
LEARNED = ("assistant",)
_CONTROL = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")
_IN_ROLE = re.compile(r"\\(n|\\)")


def tie() -> F.Column:
    """Order of turns with the same number and role, the same whatever the layout."""
    return F.xxhash64("ids")


def escape(text: str) -> str:
    return _CONTROL.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def said_role(role: str) -> str:
    """A role in one line, as a line feed ends it."""
    return escape(role).replace("\\", "\\\\").replace("\n", "\\n")


def meant_role(said: str) -> str:
    return unescape(_IN_ROLE.sub(lambda m: "\n" if m[1] == "n" else "\\", said))


def loss_mask(lengths: list[int], learned: list[bool]) -> np.ndarray:
    """Mask over the tokens of consecutive segments: +1 where a learned segment begins, -1 after it, then sums."""
    ends = np.cumsum([0, *lengths])
    steps = np.zeros(ends[-1] + 1, dtype=np.int32)
    for begin, end, on in zip(ends[:-1], ends[1:], learned, strict=True):
        steps[begin] += on
        steps[end] -= on
    return np.cumsum(steps)[:-1].astype(bool)


class _Segments(BytePairCodec):
    """Ids of segments, whose pieces the tokenizers library merges."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path).model.tokenize
        self.letters = {b: c for c, b in byte_letters().items()}
        super().__init__(path)

    def ids_of(self, piece: bytes) -> list[int]:
        return [t.id for t in self.library(piece.decode("latin-1").translate(self.letters))]


class ChatCodec:
    def __init__(self, path: str):
        self.segments = _Segments(path)
        size = max(self.segments.bytes_of) + 1
        self.start, self.stop = size, size + 1
        self.open, self.close, self.line = self.start.to_bytes(4, "little"), self.stop.to_bytes(4, "little"), self.segments.encode("\n")
        self.head = lru_cache(maxsize=1 << 12)(lambda role: self.segments.encode(said_role(role)))
        self.head_text = lru_cache(maxsize=1 << 12)(self.segments.decode)

    def turn(self, role: str, text: str) -> tuple[bytes, np.ndarray]:
        """Ids and loss mask of one turn: start, role, line feed, text, stop, line feed."""
        parts = [self.open, self.head(role), self.line, self.segments.encode(escape(text)), self.close, self.line]
        return b"".join(parts), loss_mask([len(p) // 4 for p in parts], [False, False, False, role in LEARNED, False, False])

    def read(self, ids: bytes, mask: np.ndarray) -> tuple[str, str, str, str]:
        """(formatted, role, text, learned text) of one turn, from its tokens alone.

        Where tokens are learned, they are a run of their own and everything before them is the head.
        """
        tail = self.close + self.line
        if not ids.startswith(self.open) or not ids.endswith(tail):
            raise ValueError("a turn is not between its marks")
        end = len(ids) - len(tail)
        on = np.flatnonzero(mask)
        if len(on):
            begin, stop = 4 * int(on[0]), 4 * int(on[-1]) + 4
            if stop - begin != 4 * len(on):
                raise ValueError("the learned tokens of a turn are not one run")
            learned = self.segments.decode(ids[begin:stop])
            inner = self.head_text(ids[4:begin]) + learned + (self.segments.decode(ids[stop:end]) if stop < end else "")
        else:
            learned, inner = "", self.segments.decode(ids[4:end])
        role, _, text = inner.partition("\n")
        return START + inner + STOP + "\n", meant_role(role), unescape(text), unescape(learned)


@lru_cache(maxsize=2)
def codec(path: str) -> ChatCodec:
    return ChatCodec(path)


def format_turns(df: DataFrame, path: str) -> DataFrame:
    """Token rows of the turns in (conv_id, turn, role, text): ids and mask (one byte a token) as binary.

    Null roles and texts count as empty, null conversations stay together, an empty table gives no row; a role's
    backslashes and line feeds are escaped, as a line feed ends the role.  Other columns are ignored.  Turns with the same number are ordered by role and ``tie``; repeated rows stay.
    """

    def run(rows: dict) -> dict:
        made = [codec(path).turn(r, t) for r, t in zip(rows["role"], rows["text"], strict=True)]
        return {k: rows[k] for k in ("conv_id", "turn", "role")} | {"n_tokens": [len(m) for _, m in made], "ids": [i for i, _ in made], "mask": [m.astype(np.uint8).tobytes() for _, m in made]}

    clean = df.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return map_batches(clean, "conv_id long, turn long, role string, n_tokens long, ids binary, mask binary", run, "text")


def with_offsets(turns: DataFrame) -> DataFrame:
    """Add token_start, the turn's place in its conversation's token stream."""
    window = Window.partitionBy("conv_id").orderBy("turn", "role", tie()).rowsBetween(Window.unboundedPreceding, -1)
    return turns.withColumn("token_start", F.coalesce(F.sum("n_tokens").over(window), F.lit(0)))


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(turns: DataFrame, path: str) -> DataFrame:
    """Digests of each conversation, decoded from its tokens.

    Turns are decoded where they lie.  Then they are sorted by conversation within a partition and read as a stream
    with running digests, so a conversation of any length takes constant memory and its one task hashes only.
    """
    arrow = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def decode(rows: dict) -> dict:
        read = [codec(path).read(i, np.frombuffer(m, dtype=bool)) for i, m in zip(rows["ids"], rows["mask"], strict=True)]
        return {k: rows[k] for k in ("conv_id", "turn", "tie")} | {
            "formatted_chars": [len(formatted) for formatted, *_ in read],
            "role": [role for _, role, *_ in read],
            "text": [text for _, _, text, _ in read],
            "learned": [None if learned == text else learned for *_, text, learned in read],  # null: the whole text
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, done = None, None, []

        def finish() -> None:
            if state is not None:
                done.append((key, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*done, strict=True), arrow, strict=True)], schema=arrow)
            done.clear()
            return batch

        for batch in batches:
            for part in steps(batch, "text"):
                for conv, role, text, learned, size in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    if state is None or conv != key:
                        finish()
                        key, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                    learned = text if learned is None else learned
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                    state[2] += len(learned)
                    state[3].update(learned.encode())
                    state[4] += size
            if done:
                yield flush()
        finish()
        if done:
            yield flush()

    read = map_batches(turns.select("conv_id", "turn", tie().alias("tie"), "ids", "mask"), "conv_id long, turn long, tie long, role string, text string, learned string, formatted_chars long", decode, "ids")
    ordered = read.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "tie").select("conv_id", "role", "text", "learned", "formatted_chars")
    return ordered.mapInArrow(run, DIGESTS)
