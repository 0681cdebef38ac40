"""Record layouts: ordered fields, read from a copybook or from JSON, that yield schemas and column expressions."""

from __future__ import annotations

import re
from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

#: A copybook picture, the encoded type it stands for, and how its sizes follow; all kinds that layouts accept.
_PICTURES = (
    (re.compile(r"PIC X\((\d+)\)"), "text"),
    (re.compile(r"PIC X"), "text"),
    (re.compile(r"PIC T\((\d+)\)"), "localized"),
    (re.compile(r"PIC 9\((\d+)\)"), "digits"),
    (re.compile(r"PIC (S?)9(?:\((\d+)\))? COMP"), "binary"),
    (re.compile(r"PIC S9\((\d+)\)(?:V9\((\d+)\)|V(9{1,6}))? COMP-3"), "packed"),
)
_FIELD = re.compile(r"\d{1,2}\s+([A-Z0-9-]+)\s*(PIC\s.*?)\.?", re.I)
_TITLE = re.compile(r"(?:\d{1,2}\s+)?[A-Z0-9-]+\s*\.?", re.I)


@dataclass(frozen=True)
class Field:
    """One field.  ``precision`` counts the digits before the point, ``scale`` those after it."""

    name: str
    typ: str
    size: int
    precision: int = 0
    scale: int = 0
    filler: bool = False
    nullable: bool = True
    nullif: bytes = b""
    cast: str = ""
    format: str = ""
    charset: str = ""

    def __post_init__(self) -> None:
        if self.typ == "DECIMAL" and not 0 < self.precision + self.scale <= 18:
            raise ValueError(f"{self.name}: {self.precision + self.scale} digits; packed fields have 1 to 18")
        if (self.typ == "LOCALIZED_STRING" or self.cast == "LOCALIZED_STRING") and not self.charset:
            raise ValueError(f"{self.name}: a localized string needs a charset")

    @property
    def spark_type(self) -> T.DataType:
        target = self.cast or self.typ
        if target in ("DECIMAL", "PACKED"):
            return T.DecimalType(self.precision + self.scale, self.scale)
        kinds = {"INTEGER": T.LongType(), "UNSIGNED_INTEGER": T.LongType(), "DATE": T.DateType(), "TIMESTAMP": T.TimestampNTZType(), "DATETIME": T.TimestampNTZType(), "BYTES": T.BinaryType()}
        return kinds.get(target, T.StringType())


def _binary_size(digits: int) -> int:
    for most, size in ((4, 2), (9, 4), (18, 8)):
        if digits <= most:
            return size
    raise ValueError(f"a binary integer of {digits} digits")


def field_of(name: str, picture: str, charset: str = "") -> Field:
    """The field of one copybook line."""
    picture = re.sub(r"\s+", " ", picture.strip().rstrip(".")).upper()
    clean = name.replace("-", "_").upper()
    filler = clean.startswith("FILLER")
    for pattern, kind in _PICTURES:
        hit = pattern.fullmatch(picture)
        if not hit:
            continue
        got = hit.groups()
        if kind == "text":
            size = int(got[0]) if got else 1
            if got and len(got[0].lstrip("0")) > 3:
                return Field(clean, "BYTES", size, filler=filler)
            dated = size == 10 and clean.endswith(("DT", "DATE"))
            return Field(clean, "STRING", size, filler=filler, nullif=b"\xf0" * 10 if dated else b"")
        if kind == "localized":
            return Field(clean, "LOCALIZED_STRING", int(got[0]), filler=filler, charset=charset or "UTF-8")
        if kind == "digits":
            return Field(clean, "STRING", int(got[0]), filler=filler, nullable=False)
        if kind == "binary":
            return Field(clean, "INTEGER" if got[0] else "UNSIGNED_INTEGER", _binary_size(int(got[1] or 1)), filler=filler)
        p, s = int(got[0]), int(got[1]) if got[1] else len(got[2] or "")
        return Field(clean, "DECIMAL", (p + s) // 2 + 1, p, s, filler)
    raise ValueError(f"{name}: picture {picture!r} is not supported")


@dataclass(frozen=True)
class Layout:
    """Fields of a record; ``lrecl`` is its length in bytes."""

    fields: tuple[Field, ...]
    encoding: str = "IBM1047"
    vartext: bool = False
    delimiter: str = "|"
    offsets: tuple[int, ...] = field(init=False, repr=False)

    def __post_init__(self) -> None:
        names = [f.name for f in self.fields if not f.filler]
        if len(set(names)) < len(names):
            raise ValueError(f"field names repeat: {names}")
        at, out = 0, []
        for f in self.fields:
            out.append(at)
            at += f.size
        object.__setattr__(self, "offsets", tuple(out))

    @property
    def lrecl(self) -> int:
        return sum(f.size for f in self.fields)

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.spark_type) for f in self.fields if not f.filler])

    @classmethod
    def from_copybook(cls, text: str, encoding: str = "IBM1047", charset: str = "") -> Layout:
        """Read a copybook, one statement a line; what follows ``*`` is a comment.  OCCURS is refused: fields after it would be misaligned."""
        found = []
        for number, line in enumerate(text.splitlines(), 1):
            line = line.split("*")[0].strip()
            if not line:
                continue
            if re.search(r"\bOCCURS\b", line, re.I):
                raise ValueError(f"line {number}: OCCURS is not supported")
            if hit := _FIELD.fullmatch(line):
                found.append(field_of(hit[1], hit[2], charset))
            elif not _TITLE.fullmatch(line):
                raise ValueError(f"line {number}: not a field or a title: {line!r}")
        return cls(tuple(found), encoding)

    @classmethod
    def from_json(cls, spec: dict) -> Layout:
        """Read {"field": [{name, typ, size, …}], "encoding", "vartext", "delimiter"}."""
        found = []
        for f in spec["field"]:
            nullif = f.get("nullif") or b""
            known = {k: f[k] for k in ("name", "typ", "size", "precision", "scale", "filler", "cast", "format") if k in f}
            found.append(Field(**known, nullif=nullif.encode("latin-1") if isinstance(nullif, str) else bytes(nullif), charset=f.get("localized_charset", f.get("charset", ""))))
        return cls(tuple(found), spec.get("encoding") or "IBM1047", bool(spec.get("vartext")), spec.get("delimiter") or "|")

    def override(self, changes: dict[str, dict]) -> Layout:
        """Replace named fields in place; the others and all offsets that sizes don't change stay."""
        unknown = set(changes) - {f.name for f in self.fields}
        if unknown:
            raise ValueError(f"no such field: {sorted(unknown)}")
        return replace(self, fields=tuple(replace(f, **changes.get(f.name, {})) for f in self.fields))
