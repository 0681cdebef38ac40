"""Record bytes to columns and back, as pure column expressions.

A decoder returns (value, error): error is a boolean column, true where the bytes are not a value of the type.
Encoders return (bytes, error) likewise.  Nothing here raises on bad data and nothing runs in Python.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapelake.functions.layout import Field, Layout

Pair = tuple[Column, Column]

#: Letters whose bytes stand for brackets and caret in mainframe text, and charset names that differ.
EBCDIC_READ = ("Ý¨¬", "[]^")
CHARSETS = {"JPNEBCDIC1399_4IJ": "x-IBM939", "SCHEBCDIC935_6IJ": "x-IBM935", "IBM939": "x-IBM939", "IBM935": "x-IBM935", "CP1047": "IBM1047", "EBCDIC": "IBM1047"}


def charset(name: str) -> str:
    return CHARSETS.get(name.upper(), name)


def ok() -> Column:
    return F.lit(False)


def piece(rec: Column, offset: int, size: int) -> Column:
    return F.substring(rec, offset + 1, size)


def _bytes(pattern: str) -> Column:
    return F.lit(bytes.fromhex(pattern))


def blank(raw: Column, size: int) -> Column:
    """All blanks or all zero bytes."""
    return (raw == _bytes("40" * size)) | (raw == _bytes("00" * size))


def _ebcdic(raw: Column, encoding: str) -> Column:
    name = charset(encoding)
    text = F.decode(raw, name)
    return F.rtrim(F.translate(text, *EBCDIC_READ) if name == "IBM1047" else text)


def decode_string(raw: Column, f: Field, encoding: str) -> Pair:
    text = _ebcdic(raw, encoding)
    if f.nullable:
        text = F.when(~blank(raw, f.size), text)
    return _nullif(text, raw, f), ok()


def _nullif(value: Column, raw: Column, f: Field) -> Column:
    return F.when(~F.startswith(raw, F.lit(f.nullif)), value) if f.nullif else value


def decode_latin(raw: Column, f: Field) -> Pair:
    return _nullif(F.decode(raw, "ISO-8859-1"), raw, f), ok()


def decode_localized(raw: Column, f: Field) -> Pair:
    """Trailing zero bytes and blanks of the charset go before decoding."""
    name = charset(f.charset)
    space = "20" if name.upper() in ("UTF-8", "UTF8", "US-ASCII", "ISO-8859-1") else "40"
    kept = F.unhex(F.regexp_replace(F.hex(raw), f"(00|{space})+$", ""))
    return _nullif(F.when(~(blank(raw, f.size) | (raw == _bytes(space * f.size))), F.decode(kept, name)), raw, f), ok()


def _unsigned(raw: Column) -> Column:
    return F.conv(F.hex(raw), 16, 10).cast("decimal(20,0)")


def decode_integer(raw: Column, size: int, signed: bool = True) -> Pair:
    """Big-endian; eight unsigned bytes wrap as in two's complement."""
    if size == 8:
        return F.conv(F.hex(raw), 16, -10).cast("long"), ok()
    value = F.conv(F.hex(raw), 16, 10).cast("long")
    if signed:
        value = F.when(value >= 1 << (8 * size - 1), value - (1 << 8 * size)).otherwise(value)
    return value, ok()


def decode_packed(raw: Column, f: Field) -> Pair:
    """Sign nibble B or D is negative; other digits than 0-9 and more digits than declared are errors."""
    digits, sign = F.left(F.hex(raw), F.lit(2 * f.size - 1)), F.right(F.hex(raw), F.lit(1))
    whole = F.concat(F.when(sign.isin("B", "D"), "-").otherwise(""), F.left(digits, F.lit(2 * f.size - 1 - f.scale)))
    text = F.concat(whole, F.lit("."), F.right(digits, F.lit(f.scale))) if f.scale else whole
    value = F.when(digits.rlike("^[0-9]+$"), text).try_cast(T.DecimalType(f.precision + f.scale, f.scale))
    null = blank(raw, f.size)
    return F.when(~null, value), ~null & value.isNull()


def text_long(text: Column) -> Pair:
    """Digits and signs of a text as a number."""
    value = F.regexp_replace(text, "[^0-9-]", "").try_cast("long")
    return value, text.isNotNull() & value.isNull()


def text_decimal(text: Column, f: Field) -> Pair:
    value = (F.regexp_replace(text, "[^0-9-]", "").try_cast("decimal(38,0)") * F.lit(10 ** -f.scale).cast(f"decimal(38,{f.scale})")).try_cast(T.DecimalType(f.precision + f.scale, f.scale))
    return value, text.isNotNull() & value.isNull()


def text_date(text: Column, pattern: str, zeros: str = "0{8,}") -> Pair:
    """A date by the places of Y, M and D in ``pattern``; separators count in neither, and days clamp to the month's end."""
    letters = re.sub("[^YMD]", "", (pattern or "YYYY-MM-DD").upper())
    digits = F.regexp_replace(text, "[^0-9]", "")

    def part(letter: str) -> Column:
        return F.substring(digits, letters.index(letter) + 1, letters.count(letter)).try_cast("int")

    year = part("Y") if letters.count("Y") > 2 else part("Y") + 2000
    month, day = part("M"), part("D")
    valid = (F.length(digits) == len(letters)) & month.between(1, 12) & day.between(1, 31) & year.between(1, 9999)
    first = F.when(valid, F.make_date(year, month, F.lit(1)))
    value = F.date_add(first, F.least(day, F.day(F.last_day(first))) - 1)
    null = text.isNull() | (F.trim(text) == "") | digits.rlike(f"^{zeros}$") | (digits == "")
    return F.when(~null, value), ~null & value.isNull()


def text_timestamp(text: Column) -> Pair:
    """``yyyy-MM-dd HH:mm:ss.ffffff``, or with a hyphen and points between its parts; all zeros are null."""
    plain = F.concat(F.substring(text, 1, 10), F.lit(" "), F.translate(F.substring(text, 12, 8), ".", ":"), F.substring(text, 20, 7))
    value = plain.try_cast("timestamp_ntz")
    null = text.isNull() | (F.trim(text) == "") | F.regexp_replace(text, "[^0-9]", "").rlike("^0+$")
    return F.when(~null, value), ~null & value.isNull()


def integer_date(value: Column) -> Pair:
    """yyyymmdd as a number; zero and below are null."""
    date, wrong = text_date(F.when(value > 0, F.lpad(value.cast("string"), 8, "0")), "YYYYMMDD")
    return date, F.coalesce(wrong, F.lit(False))


def offset_date(value: Column) -> Pair:
    """(year - 1900) * 10000 + month * 100 + day; zero is null, days are not clamped."""
    date = F.try_to_date(F.lpad((value + 19_000_000).cast("string"), 8, "0"), "yyyyMMdd")
    return F.when(value != 0, date), (value != 0) & date.isNull()


def decode_field(rec: Column, f: Field, offset: int, encoding: str) -> Pair:
    """Dispatch by stored type and cast."""
    raw, cast = piece(rec, offset, f.size), f.cast
    if f.typ == "STRING":
        if cast == "LATIN_STRING":
            return decode_latin(raw, f)
        if cast == "LOCALIZED_STRING":
            return decode_localized(raw, f)
        text, _ = decode_string(raw, f, encoding)
        plain = _nullif(_ebcdic(raw, encoding), raw, f)
        if cast in ("INTEGER", "LONG"):
            value, wrong = text_long(plain)
        elif cast == "DECIMAL":
            value, wrong = text_decimal(plain, f)
        elif cast == "DATE":
            value, wrong = text_date(F.when(~blank(raw, f.size), text), f.format)
        elif cast in ("TIMESTAMP", "DATETIME"):
            value, wrong = text_timestamp(text)
        else:
            return text, ok()
        return value, wrong
    if f.typ in ("LATIN_STRING", "LOCALIZED_STRING"):
        return decode_latin(raw, f) if f.typ == "LATIN_STRING" else decode_localized(raw, f)
    if f.typ in ("INTEGER", "UNSIGNED_INTEGER"):
        value, wrong = decode_integer(raw, f.size, f.typ == "INTEGER")
        if cast == "DATE":
            return integer_date(value)
        return (value.cast("string"), wrong) if cast == "STRING" else (value, wrong)
    if f.typ == "DECIMAL":
        value, wrong = decode_packed(raw, f)
        return (value.cast("string"), wrong) if cast == "STRING" else (value.cast("long"), wrong) if cast in ("INTEGER", "LONG") else (value, wrong)
    if f.typ == "DATE":
        return offset_date(decode_integer(raw, 4)[0])
    if f.typ == "BYTES":
        return _nullif(raw, raw, f), ok()
    raise ValueError(f"{f.name}: type {f.typ} can't be decoded")


# Delimited text


def vartext_field(text: Column, f: Field) -> Pair:
    """Decode one piece of a delimited record."""
    target = f.cast or f.typ
    if f.nullif:
        text = F.nullif(text, F.lit(f.nullif.decode()))
    if target in ("INTEGER", "UNSIGNED_INTEGER", "LONG"):
        plain = F.regexp_replace(text, r"^([^.]*)\.0+$", "$1")
        value = F.when(plain.rlike(r"^-?\d+$"), plain).try_cast("long")
    elif target == "DATE" and f.typ in ("INTEGER", "UNSIGNED_INTEGER"):
        number = text.try_cast("long")
        value, wrong = integer_date(number)
        return value, F.coalesce(wrong, F.lit(False)) | (text.isNotNull() & number.isNull())
    elif target == "DATE":
        value, wrong = text_date(text, f.format, "0{8}")
        return value, wrong | F.coalesce(F.trim(text) == "", F.lit(False))
    elif target == "DECIMAL":
        point = rf"\.\d{{{f.scale}}}" if f.scale else ""
        value = F.when(text.rlike(rf"^-?\d+{point}$"), text).try_cast(T.DecimalType(f.precision + f.scale, f.scale))
    elif target in ("TIMESTAMP", "DATETIME"):
        return text_timestamp(text)
    else:
        return text, ok()
    return value, text.isNotNull() & value.isNull()


# Encoding


def _zeros(size: int) -> Column:
    return _bytes("00" * size)


def encode_string(value: Column, f: Field, encoding: str) -> Pair:
    """Padded with blanks; longer or unmappable text is an error."""
    name = charset(f.charset or encoding)
    text = F.translate(value, "�", " ")
    if f.charset:
        raw = F.encode(text, name)
        pad = _bytes("20" if name.upper() == "UTF-8" else "40")
        fits = (F.octet_length(raw) <= f.size) & (F.decode(raw, name) == text)
        return F.when(fits, F.rpad(raw, f.size, pad)), value.isNotNull() & ~fits
    fits = (F.length(text) <= f.size) & (F.decode(F.encode(text, name), name) == text)
    return F.when(fits, F.encode(F.rpad(text, f.size, " "), name)), value.isNotNull() & ~fits


def encode_integer(value: Column, size: int) -> Pair:
    """Big-endian, low bytes kept."""
    return F.unhex(F.right(F.lpad(F.hex(value.cast("long")), 16, "0"), F.lit(2 * size))), ok()


def encode_packed(value: Column, f: Field, kind: T.DataType | None = None) -> Pair:
    """Cut toward zero at the field's scale; sign C or D, zero always C; too many digits before the point are an error."""
    width = 2 * f.size - 1
    exact = value if isinstance(kind, T.DecimalType) else value.cast(T.DecimalType(38, 0) if isinstance(kind, T.IntegralType) else T.DecimalType(38, 10))
    # Cut in the value's own scale: a product would first be rounded to 38 digits.
    cut = F.floor(F.abs(exact), F.lit(f.scale)).try_cast(T.DecimalType(38, f.scale))
    digits = F.translate(cut.cast("string"), ".", "").try_cast("decimal(38,0)")
    fits = digits < F.lit(10 ** (f.precision + f.scale)).cast("decimal(38,0)")
    sign = F.when((value < 0) & (digits > 0), "D").otherwise("C")
    return F.when(fits, F.unhex(F.concat(F.lpad(digits.cast("string"), width, "0"), sign))), value.isNotNull() & ~F.coalesce(fits, F.lit(False))


def encode_date(value: Column) -> Pair:
    day = value.cast("date")
    return encode_integer((F.year(day) - 1900) * 10_000 + F.month(day) * 100 + F.day(day), 4)


def encode_bytes(value: Column, f: Field) -> Pair:
    fits = (F.octet_length(value) == f.size) | (F.octet_length(value) == 0)
    return F.when(F.octet_length(value) == f.size, value), value.isNotNull() & ~fits


def text_of(value: Column, kind: T.DataType) -> Column:
    """How a value of another type is written into a text field."""
    if isinstance(kind, T.DecimalType):
        plain = value.cast("string")
        return F.when(F.contains(plain, F.lit(".")), F.regexp_replace(plain, r"\.?0+$", "")).otherwise(plain)
    if isinstance(kind, T.TimestampType):
        return (F.unix_micros(value).cast("decimal(26,6)") / 1_000_000).cast("decimal(26,6)").cast("string")
    if isinstance(kind, T.TimestampNTZType):
        return F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return value.cast("string")


def time_text(micros: Column) -> Column:
    """Microseconds of a day as h:m:s, not padded."""
    seconds = F.floor(micros / 1_000_000)
    return F.concat_ws(":", F.floor(seconds / 3600).cast("string"), (F.floor(seconds / 60) % 60).cast("string"), (seconds % 60).cast("string"))


def encode_field(value: Column, kind: T.DataType, f: Field, encoding: str) -> Pair:
    """Dispatch by layout field; null of any type is zero bytes."""
    if f.typ in ("STRING", "LATIN_STRING", "LOCALIZED_STRING"):
        text = value if isinstance(kind, T.StringType) else text_of(value, kind)
        raw, wrong = encode_string(text, f, "ISO-8859-1" if f.typ == "LATIN_STRING" else encoding)
    elif f.typ in ("INTEGER", "UNSIGNED_INTEGER"):
        raw, wrong = encode_date(value) if isinstance(kind, T.DateType) and f.size == 4 else encode_integer(value, f.size)
    elif f.typ == "DECIMAL":
        raw, wrong = encode_packed(value, f, kind)
    elif f.typ == "DATE":
        raw, wrong = encode_date(value)
    elif f.typ == "BYTES":
        raw, wrong = encode_bytes(value, f)
    else:
        raise ValueError(f"{f.name}: type {f.typ} can't be encoded")
    return F.coalesce(raw, _zeros(f.size)), F.coalesce(wrong, F.lit(False))


def decode_columns(layout: Layout, rec: Column) -> list[tuple[Field, Column, Column]]:
    """(field, value, error) of every field that is no filler; a field that a delimited record doesn't have is an error."""
    if layout.vartext:
        text = F.decode(rec, charset(layout.encoding))
        parts = F.split(text, re.escape(layout.delimiter))
        pairs = [(f, i, *vartext_field(F.substring(F.get(parts, F.lit(i)), 1, f.size), f)) for i, f in enumerate(layout.fields) if not f.filler]
        return [(f, v, F.coalesce(e, F.lit(False)) | (F.size(parts) <= i)) for f, i, v, e in pairs]
    return [(f, *decode_field(rec, f, at, layout.encoding)) for f, at in zip(layout.fields, layout.offsets, strict=True) if not f.filler]
