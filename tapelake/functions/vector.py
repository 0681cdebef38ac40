"""Record bytes to columns and back by whole Arrow batches: the codec of the scans and sinks.

A batch of records is one matrix of bytes, a row for each record.  Integers are views of its columns, packed decimals
go through tables of pairs of digits, texts through a table of their charset.  What stays after that (dates, times and
numbers out of texts, charsets of several bytes) is left to column expressions over the plain values; see ``codec``.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapelake.functions import codec
from tapelake.functions.layout import Field, Layout

UTF8 = ("UTF-8", "UTF8")
WRONG = 0xFF
#: Two digits as a byte, and what two digits a byte stands for.
TENS = np.array([(x // 10) << 4 | x % 10 for x in range(100)], dtype=np.uint8)
PAIR = np.array([(b >> 4) * 10 + (b & 15) if b >> 4 < 10 and b & 15 < 10 else WRONG for b in range(256)], dtype=np.uint8)


# Charsets


@dataclass(frozen=True)
class Letters:
    """A charset of one byte: the letter of each byte, and the byte of each letter that it can say."""

    of: str
    byte: dict[str, int]

    @property
    def ascii(self) -> np.ndarray:
        """The ASCII letter of each byte, WRONG where it is another."""
        return np.array([ord(c) if ord(c) < 128 else WRONG for c in self.of], dtype=np.uint8)

    @property
    def widths(self) -> np.ndarray:
        """How many bytes of UTF-8 each letter takes."""
        return np.array([len(c.encode("utf-8", "surrogatepass")) for c in self.of], dtype=np.int64)


_letters: dict[str, Letters | None] = {}


def letters(spark: SparkSession, name: str, reading: bool = False) -> Letters | None:
    """The table of a charset as the JVM has it, or None if it isn't one of single bytes; ``reading`` has brackets as mainframe text means them."""
    name = codec.charset(name)
    if name not in _letters:
        every = bytes(range(256))
        text = None if name.upper() in UTF8 else spark.sql("select 1").select(F.decode(F.lit(every), name)).first()[0]
        back = spark.sql("select 1").select(F.encode(F.lit(text), name)).first()[0] if text and len(text) == 256 else None
        single = back is not None and len(back) == 256
        _letters[name] = Letters(text, {c: b for c, b in zip(text, bytes(back)) if c != "�" and text[b] == c}) if single else None
    found = _letters[name]
    if found and reading and name == "IBM1047":
        return Letters(found.of.translate(str.maketrans(*codec.EBCDIC_READ)), found.byte)
    return found


# Decoding


def _bits(mask: np.ndarray | None) -> pa.Buffer | None:
    return None if mask is None or mask.all() else pa.py_buffer(np.packbits(mask, bitorder="little"))


def _whole_blank(m: np.ndarray) -> np.ndarray:
    return (m == 0x40).all(axis=1) | (m == 0).all(axis=1)


def _begins(m: np.ndarray, prefix: bytes) -> np.ndarray:
    if not prefix or len(prefix) > m.shape[1]:
        return np.zeros(len(m), dtype=bool)
    return (m[:, : len(prefix)] == np.frombuffer(prefix, dtype=np.uint8)).all(axis=1)


def _lengths(filled: np.ndarray) -> np.ndarray:
    """The place after the last true value of each row."""
    size = filled.shape[1]
    return np.where(filled.any(axis=1), size - np.argmax(filled[:, ::-1], axis=1), 0)


def _strings(data: bytes | np.ndarray, sizes: np.ndarray, valid: np.ndarray) -> pa.Array:
    offsets = np.zeros(len(sizes) + 1, dtype=np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.StringArray.from_buffers(len(sizes), pa.py_buffer(offsets), pa.py_buffer(data), _bits(valid))


def texts(m: np.ndarray, table: Letters, sizes: np.ndarray, valid: np.ndarray) -> pa.Array:
    """The first ``sizes`` bytes of each row as text."""
    sizes = np.where(valid, sizes, 0)
    kept = m[np.arange(m.shape[1]) < sizes[:, None]]
    plain = table.ascii[kept]
    if not (plain == WRONG).any():
        return _strings(plain, sizes, valid)
    import codecs

    widths = np.concatenate([[0], np.cumsum(table.widths[kept])])
    return _strings(codecs.charmap_decode(kept.tobytes(), "strict", table.of)[0].encode(), np.diff(widths[np.concatenate([[0], np.cumsum(sizes)])]), valid)


def utf8_texts(m: np.ndarray, sizes: np.ndarray, valid: np.ndarray) -> pa.Array:
    sizes = np.where(valid, sizes, 0)
    made = _strings(m[np.arange(m.shape[1]) < sizes[:, None]], sizes, valid)
    try:
        made.validate(full=True)
    except pa.ArrowInvalid:
        return pa.array([bytes(row[:n]).decode("utf-8", "replace") if v else None for row, n, v in zip(m, sizes.tolist(), valid.tolist(), strict=True)], pa.string())
    return made


def integers(m: np.ndarray, signed: bool = True) -> np.ndarray:
    """Big-endian numbers of up to eight bytes; eight unsigned bytes wrap."""
    n, size = m.shape
    wide = np.zeros((n, 8), dtype=np.uint8)
    wide[:, 8 - size :] = m
    if signed and size < 8:
        wide[:, : 8 - size] = np.where(m[:, :1] > 0x7F, 0xFF, 0)
    return wide.view(">i8").reshape(n).astype(np.int64)


def packed(m: np.ndarray, f: Field) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(unscaled values, which are valid, which are wrong) of packed decimals; blank fields are neither."""
    size = m.shape[1]
    null = _whole_blank(m)
    high = m[:, -1] >> 4
    wrong = high > 9
    value = np.zeros(len(m), dtype=np.uint64)
    for i in range(size - 1):
        pair = PAIR[m[:, i]]
        wrong |= pair == WRONG
        if i < size - 10:
            wrong |= pair != 0  # beyond 18 digits, which no field has
        else:
            value = value * np.uint64(100) + pair
    value = value * np.uint64(10) + high
    wrong = (wrong | (value >= np.uint64(10 ** (f.precision + f.scale)))) & ~null
    valid = ~(wrong | null)
    value = np.where(valid, value, 0).astype(np.int64)
    sign = m[:, -1] & 15
    return np.where((sign == 0xB) | (sign == 0xD), -value, value), valid, wrong


def decimals(values: np.ndarray, valid: np.ndarray, digits: int, scale: int) -> pa.Array:
    wide = np.stack([values, values >> 63], axis=1)
    return pa.Array.from_buffers(pa.decimal128(digits, scale), len(values), [_bits(valid), pa.py_buffer(np.ascontiguousarray(wide))])


def days(numbers: np.ndarray, clamp: bool) -> tuple[np.ndarray, np.ndarray]:
    """(days since 1970, which are dates) of numbers yyyymmdd, of which the first eight digits count; ``clamp`` cuts days to the month's end."""
    v = numbers.copy()
    while (v >= 100_000_000).any():
        v = np.where(v >= 100_000_000, v // 10, v)
    year, month, day = v // 10_000, v // 100 % 100, v % 100
    valid = (v > 0) & (year >= 1) & (month >= 1) & (month <= 12) & (day >= 1) & (day <= 31)
    months = np.where(valid, (year - 1970) * 12 + month - 1, 0).astype("datetime64[M]")
    first, after = months.astype("datetime64[D]").astype(np.int64), (months + 1).astype("datetime64[D]").astype(np.int64)
    last = after - first
    if not clamp:
        valid &= day <= last
    return first + np.minimum(day, last) - 1, valid


def matrix(records: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(the first ``size`` bytes of each record, padded with zeros; which records are shorter)."""
    n = len(records)
    if pa.types.is_large_binary(records.type):
        records = records.cast(pa.binary())
    _, offsets, data = records.buffers()
    ends = np.frombuffer(offsets, np.int32, n + 1, records.offset * 4).astype(np.int64) if n else np.zeros(1, dtype=np.int64)
    lengths = np.diff(ends)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    if n and lengths[0] >= size and (lengths == lengths[0]).all():
        return raw[ends[0] : ends[-1]].reshape(n, -1)[:, :size], np.zeros(n, dtype=bool)
    out = np.zeros((n, size), dtype=np.uint8)
    held = np.arange(size) < lengths[:, None]
    rows, places = np.nonzero(held)
    out[rows, places] = raw[ends[rows] + places]
    return out, lengths < size


Reader = Callable[[np.ndarray], list[pa.Array]]


@dataclass(frozen=True)
class Lane:
    """How one field is read: the columns that a batch gives, and the (value, error) expressions over them."""

    types: list[T.DataType]
    read: Reader
    finish: Callable[[list[Column]], codec.Pair]


def _text_lane(f: Field, table: Letters, mode: str) -> Lane:
    """``mode``: plain keeps blank fields, null makes them null; latin keeps trailing blanks, localized cuts zero bytes as well."""
    space = np.array([c == " " for c in table.of])
    pad = 0x20 if codec.charset(f.charset).upper() in (*UTF8, "US-ASCII", "ISO-8859-1") else 0x40
    prefix = f.nullif

    def read(m: np.ndarray) -> list[pa.Array]:
        valid = ~_begins(m, prefix)
        if mode == "latin":
            return [texts(m, table, np.full(len(m), m.shape[1]), valid)]
        if mode == "localized":
            filled = (m != 0) & (m != pad)
            valid &= ~(_whole_blank(m) | (m == pad).all(axis=1))
            return [texts(m, table, _lengths(filled), valid)]
        if mode == "null":
            valid &= ~_whole_blank(m)
        return [texts(m, table, _lengths(~space[m]), valid)]

    return Lane([T.StringType()], read, lambda c: (c[0], codec.ok()))


def _utf8_lane(f: Field) -> Lane:
    prefix = f.nullif

    def read(m: np.ndarray) -> list[pa.Array]:
        valid = ~(_begins(m, prefix) | _whole_blank(m) | (m == 0x20).all(axis=1))
        return [utf8_texts(m, _lengths((m != 0) & (m != 0x20)), valid)]

    return Lane([T.StringType()], read, lambda c: (c[0], codec.ok()))


def _bytes_of(m: np.ndarray, valid: np.ndarray) -> pa.Array:
    n, size = m.shape
    fixed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(size), n, [_bits(valid), pa.py_buffer(np.ascontiguousarray(m))])
    return fixed.cast(pa.binary())


def lane(spark: SparkSession, f: Field, encoding: str) -> Lane:
    """How a field of this stored type and cast is read."""
    cast = f.cast

    def raw(finish: Callable[[Column], codec.Pair], keep_null: bool = False) -> Lane:
        prefix = f.nullif if keep_null else b""
        return Lane([T.BinaryType()], lambda m: [_bytes_of(m, ~_begins(m, prefix))], lambda c: finish(c[0]))

    def whole() -> Lane:
        """Left to column expressions."""
        return raw(lambda c: codec.decode_field(c, f, 0, encoding))

    if f.typ in ("LATIN_STRING", "LOCALIZED_STRING") or (f.typ == "STRING" and cast in ("LATIN_STRING", "LOCALIZED_STRING")):
        if "LATIN_STRING" in (f.typ, cast) and f.typ != "LOCALIZED_STRING":
            return _text_lane(f, letters(spark, "ISO-8859-1"), "latin")
        if codec.charset(f.charset).upper() in UTF8:
            return _utf8_lane(f)
        table = letters(spark, f.charset)
        return _text_lane(f, table, "localized") if table else whole()
    if f.typ == "STRING":
        table = letters(spark, encoding, reading=True)
        if not table:
            return whole()
        if cast in ("INTEGER", "LONG", "DECIMAL"):
            made = _text_lane(f, table, "plain")
            return Lane(made.types, made.read, (lambda c: codec.text_decimal(c[0], f)) if cast == "DECIMAL" else (lambda c: codec.text_long(c[0])))
        made = _text_lane(f, table, "null" if f.nullable or cast == "DATE" else "plain")
        if cast == "DATE":
            return Lane(made.types, made.read, lambda c: codec.text_date(c[0], f.format))
        return Lane(made.types, made.read, lambda c: codec.text_timestamp(c[0])) if cast in ("TIMESTAMP", "DATETIME") else made
    if f.typ in ("INTEGER", "UNSIGNED_INTEGER", "DATE") and f.size <= 8:
        signed = f.typ != "UNSIGNED_INTEGER"

        def dated(m: np.ndarray) -> list[pa.Array]:
            numbers = integers(m[:, :4] if f.typ == "DATE" else m, signed)
            there = numbers != 0 if f.typ == "DATE" else numbers > 0
            found, valid = days(numbers + 19_000_000 if f.typ == "DATE" else numbers, clamp=f.typ != "DATE")
            return [pa.array(found.astype(np.int32), mask=~(there & valid)).cast(pa.date32()), pa.array(there & ~valid)]

        if f.typ == "DATE" or cast == "DATE":
            return Lane([T.DateType(), T.BooleanType()], dated, lambda c: (c[0], c[1]))
        return Lane([T.LongType()], lambda m: [pa.array(integers(m, signed))], lambda c: (c[0].cast("string") if cast == "STRING" else c[0], codec.ok()))
    if f.typ == "DECIMAL":

        def read(m: np.ndarray) -> list[pa.Array]:
            values, valid, wrong = packed(m, f)
            return [decimals(values, valid, f.precision + f.scale, f.scale), pa.array(wrong)]

        kind = {"STRING": "string", "INTEGER": "long", "LONG": "long"}.get(cast)
        return Lane([T.DecimalType(f.precision + f.scale, f.scale), T.BooleanType()], read, lambda c: (c[0].cast(kind) if kind else c[0], c[1]))
    if f.typ == "BYTES":
        return raw(lambda c: (c, codec.ok()), keep_null=True)
    return whole()


@dataclass(frozen=True)
class Reading:
    """A layout's reader: the columns of a batch of records, what they are called, and the fields' expressions over them."""

    schema: T.StructType
    read: Callable[[pa.Array], pa.RecordBatch]
    short: Column
    found: list[tuple[Field, Column, Column]]


def reading(spark: SparkSession, layout: Layout, columns: list[str] | None = None) -> Reading:
    """Readers of the fields that are no filler and, if ``columns`` are named, are among them."""
    from pyspark.sql.pandas.types import to_arrow_schema

    lanes = [(f, at, lane(spark, f, layout.encoding)) for f, at in zip(layout.fields, layout.offsets, strict=True) if not f.filler and (columns is None or f.name in columns)]
    names = [[f"_v{i}_{j}" for j in range(len(x.types))] for i, (_, _, x) in enumerate(lanes)]
    schema = T.StructType([T.StructField(n, t) for x, ns in zip(lanes, names, strict=True) for n, t in zip(ns, x[2].types, strict=True)] + [T.StructField("_short", T.BooleanType()), T.StructField("rec", T.BinaryType())])
    arrow = to_arrow_schema(schema)
    size, readers = layout.lrecl, [(at, at + f.size, x.read) for f, at, x in lanes]

    def read(records: pa.Array) -> pa.RecordBatch:
        m, short = matrix(records, size)
        made = [a for at, end, r in readers for a in r(m[:, at:end])]
        return pa.RecordBatch.from_arrays([*made, pa.array(short), records.cast(pa.binary())], schema=arrow)

    found = [(f, *x.finish([F.col(n) for n in ns])) for (f, _, x), ns in zip(lanes, names, strict=True)]
    return Reading(schema, read, F.col("_short"), found)


# Encoding


def _filled(n: int, size: int, fill: int, data: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    out = np.full((n, size), fill, dtype=np.uint8)
    out[np.arange(size) < sizes[:, None]] = data
    return out


def _utf8_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, lengths) of a column of texts; null has none."""
    column = column.cast(pa.string()).fill_null("")
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int32, len(column) + 1, column.offset * 4).astype(np.int64) if len(column) else np.zeros(1, dtype=np.int64)
    raw = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    return raw, np.diff(ends)


def put_texts(column: pa.Array, size: int, table: Letters | None, pad: int) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, which are wrong): padded; longer or unmappable texts are wrong.  No table is UTF-8."""
    raw, sizes = _utf8_of(column)
    if (raw == 0xEF).any():
        raw, sizes = _utf8_of(pc.replace_substring(column.cast(pa.string()), "�", " "))
    if table is None:
        wrong = sizes > size
    else:
        to = np.array([table.byte.get(chr(i), -1) for i in range(128)])
        if len(raw) and (raw.max() > 127 or (to[raw] < 0).any()):
            made = [None if t is None else [table.byte.get(c, -1) for c in t] for t in pc.replace_substring(column.cast(pa.string()), "�", " ").to_pylist()]
            wrong = np.array([t is not None and (len(t) > size or -1 in t) for t in made], dtype=bool)
            sizes = np.array([0 if t is None or w else len(t) for t, w in zip(made, wrong, strict=True)], dtype=np.int64)
            return _filled(len(made), size, pad, np.array([b for t, w in zip(made, wrong, strict=True) if t and not w for b in t], dtype=np.uint8), sizes), wrong
        raw, wrong = to[raw].astype(np.uint8), sizes > size
    if wrong.any():
        raw, sizes = raw[np.repeat(~wrong, sizes)], np.where(wrong, 0, sizes)
    return _filled(len(sizes), size, pad, raw, sizes), wrong


def put_integers(values: np.ndarray, size: int) -> np.ndarray:
    """Big-endian, low bytes kept."""
    wide = values.astype(">i8").view(np.uint8).reshape(len(values), 8)
    if size <= 8:
        return wide[:, 8 - size :]
    return np.concatenate([np.where(values[:, None] < 0, 0xFF, 0).astype(np.uint8).repeat(size - 8, axis=1), wide], axis=1)


def unscaled(column: pa.Array) -> tuple[np.ndarray, int, np.ndarray | None]:
    """(whole numbers, scale, exact magnitudes where some don't fit) of a decimal or integer column; null is 0."""
    if pa.types.is_integer(column.type):
        return column.cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False), 0, None
    wide = np.frombuffer(column.buffers()[1], np.int64)[2 * column.offset : 2 * (column.offset + len(column))].reshape(-1, 2)
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    low, high = np.where(valid, wide[:, 0], 0), np.where(valid, wide[:, 1], 0)
    if (high == low >> 63).all() and not (low == np.iinfo(np.int64).min).any():
        return low, column.type.scale, None
    exact = np.array([(int(h) << 64) | (int(x) & ((1 << 64) - 1)) for x, h in zip(low, high, strict=True)], dtype=object)
    return low, column.type.scale, exact


def put_packed(column: pa.Array, f: Field) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, which are wrong): cut toward zero at the field's scale, sign C or D, zero always C."""
    values, scale, exact = unscaled(column)
    most = 10 ** (f.precision + f.scale)
    given = values if exact is None else exact
    negative = given < 0
    size = np.where(negative, -given, given)
    if scale >= f.scale:
        size = size // 10 ** (scale - f.scale) if scale - f.scale < 19 or exact is not None else np.zeros_like(size)
        wrong = size >= most
    else:
        up = 10 ** (f.scale - scale)
        wrong = size >= -(-most // up)
        size = np.where(wrong, 0, size) * up
    wrong = wrong.astype(bool)
    left = np.where(wrong, 0, size).astype(np.uint64)
    sign = np.where(negative.astype(bool) & (left > 0), 0xD, 0xC)
    out = np.zeros((len(left), f.size), dtype=np.uint8)
    out[:, -1] = ((left % np.uint64(10)) << np.uint64(4)).astype(np.uint8) | sign.astype(np.uint8)
    left = left // np.uint64(10)
    for i in range(f.size - 2, -1, -1):
        out[:, i] = TENS[left % np.uint64(100)]
        left = left // np.uint64(100)
    return out, wrong | (left > 0)


def put_dates(column: pa.Array) -> np.ndarray:
    """(year - 1900) * 10000 + month * 100 + day; null is 0."""
    day = column.cast(pa.date32()).cast(pa.int32()).fill_null(0).to_numpy(zero_copy_only=False).astype("datetime64[D]")
    month = day.astype("datetime64[M]")
    year = month.astype("datetime64[Y]").astype(np.int64) + 70
    return year * 10_000 + (month.astype(np.int64) % 12 + 1) * 100 + (day - month).astype(np.int64) + 1


def put_bytes(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, which are wrong): as long as the field, or none at all, which counts as null."""
    values = [v or b"" for v in column.to_pylist()]
    wrong = np.array([len(v) not in (0, size) for v in values], dtype=bool)
    return np.frombuffer(b"".join(v if len(v) == size else bytes(size) for v in values), dtype=np.uint8).reshape(len(values), size), wrong


Writer = Callable[[pa.Array], tuple[np.ndarray, np.ndarray | None]]


def writer(spark: SparkSession, column: Column, kind: T.DataType, f: Field, encoding: str) -> tuple[Column, Writer]:
    """(the plain value of a field, how a batch of them becomes bytes)."""
    size = f.size
    if f.typ in ("STRING", "LATIN_STRING", "LOCALIZED_STRING"):
        text = column if isinstance(kind, T.StringType) else codec.text_of(column, kind)
        name = codec.charset(f.charset or ("ISO-8859-1" if f.typ == "LATIN_STRING" else encoding))
        if name.upper() in UTF8 and f.charset:
            return text, lambda c: put_texts(c, size, None, 0x20)
        if table := letters(spark, name):
            pad = 0x40 if f.charset else table.byte[" "]
            return text, lambda c: put_texts(c, size, table, pad)
        raw, _ = codec.encode_field(column, kind, f, encoding)
        fits = codec.encode_field(column, kind, f, encoding)[1]

        def copy(c: pa.Array) -> tuple[np.ndarray, np.ndarray]:
            return put_bytes(c.field("raw"), size)[0], c.field("wrong").to_numpy(zero_copy_only=False)

        return F.struct(raw.alias("raw"), fits.alias("wrong")), copy
    if f.typ in ("INTEGER", "UNSIGNED_INTEGER", "DATE"):
        if isinstance(kind, T.DateType) and (f.typ == "DATE" or size == 4):
            return column, lambda c: (put_integers(put_dates(c), size), None)
        if f.typ == "DATE":
            return column.cast("date"), lambda c: (put_integers(put_dates(c), size), None)
        return column.cast("long"), lambda c: (put_integers(c.fill_null(0).to_numpy(zero_copy_only=False), size), None)
    if f.typ == "DECIMAL":
        exact = column if isinstance(kind, (T.DecimalType, T.IntegralType)) else column.cast(T.DecimalType(38, 10))
        return exact, lambda c: put_packed(c, f)
    if f.typ == "BYTES":
        return column, lambda c: put_bytes(c, size)
    raise ValueError(f"{f.name}: type {f.typ} can't be encoded")


class EncodeError(RuntimeError):
    pass


@dataclass(frozen=True)
class Writing:
    """A layout's writer: the plain values of a row, and how a batch of them becomes records; rows that can't be encoded raise."""

    columns: list[Column]
    encode: Callable[[pa.RecordBatch], np.ndarray]


def writing(df: DataFrame, layout: Layout, lrecl: int | None = None) -> Writing:
    size = lrecl or layout.lrecl
    pairs = [writer(df.sparkSession, F.col(f"`{c.name}`"), c.dataType, f, layout.encoding) for c, f in zip(df.schema, layout.fields, strict=True)]
    writers = [w for _, w in pairs]
    fields = [(f.name, at, at + f.size) for f, at in zip(layout.fields, layout.offsets, strict=True)]
    kinds = ", ".join(f"{f.name} {f.typ}({f.size})" for f in layout.fields)
    names = df.columns

    def encode(batch: pa.RecordBatch) -> np.ndarray:
        out = np.zeros((batch.num_rows, size), dtype=np.uint8)
        failed = {}
        for (name, at, end), put, column in zip(fields, writers, batch.columns, strict=True):
            raw, wrong = put(column)
            there = column.is_valid().to_numpy(zero_copy_only=False)
            out[:, at:end] = raw if there.all() else np.where(there[:, None], raw, 0)
            if wrong is not None and (wrong & there).any():
                failed[name] = int(np.flatnonzero(wrong & there)[0])
        if failed:
            at = min(failed.values())
            row = {n: None if v is None else str(v) for n, v in zip(names, (c[at].as_py() for c in batch.columns), strict=True)}
            raise EncodeError(f"can't encode {', '.join(n for n, i in failed.items() if i == at)} of layout [{kinds}] from row {json.dumps(row, ensure_ascii=False)}")
        return out

    return Writing([c.alias(f"_v{i}") for i, (c, _) in enumerate(pairs)], encode)
