"""The codec by whole batches against the codec by column expressions, over random bytes and values."""

import datetime
import random
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapelake.functions import codec, vector
from tapelake.functions.layout import Field, Layout
from tapelake.operators import quality
from tapelake.sources import records

FIELDS = [
    *(Field(f"I{n}", "INTEGER", n) for n in (1, 2, 3, 4, 8)), *(Field(f"U{n}", "UNSIGNED_INTEGER", n) for n in (1, 2, 4, 8)),
    Field("P1", "DECIMAL", 4, 5, 2), Field("P2", "DECIMAL", 10, 16, 2), Field("P3", "DECIMAL", 3, 4, 0), Field("P4", "DECIMAL", 2, 1, 2, cast="STRING"), Field("P5", "DECIMAL", 5, 9, 0, cast="LONG"), Field("P6", "DECIMAL", 12, 18, 0),
    Field("S1", "STRING", 6), Field("S2", "STRING", 6, nullable=False), Field("S3", "STRING", 5, nullif=b"\xf1"), Field("S4", "STRING", 8, cast="DATE", format="YYYYMMDD"), Field("S5", "STRING", 4, cast="INTEGER"), Field("S6", "STRING", 5, 3, 2, cast="DECIMAL"),
    Field("S7", "STRING", 26, cast="TIMESTAMP"), Field("S8", "STRING", 5, cast="LATIN_STRING"), Field("L1", "LATIN_STRING", 5), Field("L2", "LOCALIZED_STRING", 6, charset="UTF-8"), Field("L3", "LOCALIZED_STRING", 6, charset="IBM037"), Field("L4", "LOCALIZED_STRING", 8, charset="IBM939"),
    Field("D1", "DATE", 4), Field("D2", "INTEGER", 4, cast="DATE"), Field("I5", "INTEGER", 2, cast="STRING"), Field("B1", "BYTES", 4), Field("B2", "BYTES", 4, nullif=b"\x00\x00"),
]


def likely(f, random):
    """Bytes that a field often holds, and now and then any."""
    if random.random() < 0.15:
        return random.choice([b"\x00", b"\x40", b"\x20", b"\xff"]) * f.size
    if random.random() < 0.1:
        return random.randbytes(f.size)
    if f.typ == "DECIMAL":
        digits = "".join(random.choice("0123456789") for _ in range(2 * f.size - 1))
        digits = digits if random.random() < 0.3 else ("0" * len(digits) + digits[: f.precision + f.scale])[-len(digits) :]
        return bytes.fromhex(digits + random.choice("cdfb"))
    if f.typ == "DATE":
        return (random.choice([0, 1200209, 1991231, 1230001, 1200230, -5, 1 << 30, -18_000_000, 81_001_231, -18_990_000, 2_000_000_000]) & 0xFFFFFFFF).to_bytes(4, "big")
    if f.typ in ("INTEGER", "UNSIGNED_INTEGER"):
        return (random.choice([0, 1, 20200209, 7, 20200231, 99991231, 2_020_020_912, 10101]) & ((1 << 8 * f.size) - 1)).to_bytes(f.size, "big")
    if f.name == "L2":
        return random.choice(["aé ", "日本", "plain ", "  x"]).encode()[: f.size].ljust(f.size, b" ")
    text = random.choice(["20200230", "0000", "12-4", "A[b]^ ", " x", "2020-01-02-03.04.05.678901", "99999999", "é"])
    return text.encode("cp1140").ljust(f.size, b"\x40")[: f.size]


def test_decoding_agrees_with_expressions(spark):
    chosen = random.Random(7)
    layout = Layout(tuple(FIELDS))
    rows = [b"".join(likely(f, chosen) for f in FIELDS) for _ in range(600)]
    rows = [r + b"extra" if i % 3 == 0 else r for i, r in enumerate(rows)] + [rows[0][:7], b""]
    df = spark.createDataFrame([(bytearray(r),) for r in rows], "rec binary").repartition(2).cache()
    got = sorted(map(str, quality.decode(df.where("length(rec) >= 100"), layout).drop("_err").collect()))
    plain = codec.decode_columns(layout, F.col("rec"))
    whole = df.where("length(rec) >= 100")
    want = sorted(map(str, whole.select(*(v.alias(f.name) for f, v, _ in plain), "rec").collect()))
    # Java and Python put different numbers of replacement letters for broken UTF-8.
    assert [g for g in got if "�" not in g] == [w for w in want if "�" not in w] and len(got) == 600
    flags = {bytes(r["rec"]): r["_err"] for r in quality.decode(df, layout).collect()}
    wrong = whole.select("rec", quality.names_of([(f.name, e) for f, _, e in plain]).alias("e"))
    assert all(flags[bytes(r["rec"])] == r["e"] for r in wrong.collect())
    assert flags[b""][0] == flags[rows[0][:7]][0] == "record"
    few = quality.decode(df, layout, columns=["P1", "S1"])
    assert few.columns == ["P1", "S1", "rec", "_err"]


VALUES = [
    (Field("A", "INTEGER", 2), "long", [None, 0, 1, -1, 70_000, -70_000]),
    (Field("A", "INTEGER", 8), "long", [None, 1 << 62, -(1 << 63)]),
    (Field("A", "DECIMAL", 4, 5, 2), "decimal(12,4)", [None, Decimal("12345.6789"), Decimal("-0.0010"), Decimal("-1.5"), Decimal("123456"), Decimal("-99999.99")]),
    (Field("A", "DECIMAL", 9, 15, 2), "decimal(38,10)", [None, Decimal("1234567890123456789012345678"), Decimal("-123456789012345.9999999999"), Decimal("0.0099999999"), Decimal("-0.0000000001")]),
    (Field("A", "DECIMAL", 9, 12, 5), "decimal(10,1)", [None, Decimal("1.5"), Decimal("-99999999.9")]),
    (Field("A", "DECIMAL", 3, 2, 3), "decimal(10,0)", [Decimal("99"), Decimal("100"), Decimal("-100")]),
    (Field("A", "DECIMAL", 4, 7, 0), "int", [None, 5, -5, 1234567, 12345678]),
    (Field("A", "STRING", 6), "string", [None, "", "abc", "abcdef", "abcdefg", "日", "é", "[a]^", "a�b"]),
    (Field("A", "LATIN_STRING", 4), "string", [None, "é", "abcde", "日"]),
    (Field("A", "LOCALIZED_STRING", 6, charset="UTF-8"), "string", [None, "é", "日本", "日本x", "a�b"]),
    (Field("A", "LOCALIZED_STRING", 6, charset="IBM037"), "string", [None, "abc", "日", "toolong"]),
    (Field("A", "LOCALIZED_STRING", 8, charset="IBM939"), "string", [None, "日本", "日本日本", "abc"]),
    (Field("A", "STRING", 12), "decimal(9,2)", [None, Decimal("1.50"), Decimal("-3.00")]),
    (Field("A", "DATE", 4), "date", [None, datetime.date(2020, 2, 9), datetime.date(1899, 12, 31), datetime.date(1, 1, 1)]),
    (Field("A", "INTEGER", 4), "date", [None, datetime.date(2020, 2, 29)]),
    (Field("A", "BYTES", 3), "binary", [None, b"", b"abc", b"ab"]),
]


@pytest.mark.parametrize(("f", "kind", "values"), VALUES)
def test_encoding_agrees_with_expressions(spark, f, kind, values):
    df = spark.createDataFrame([(i, bytearray(v) if isinstance(v, bytes) else v) for i, v in enumerate(values)], f"i int, A {kind}").coalesce(1)
    raw, wrong = codec.encode_field(F.col("A"), df.schema["A"].dataType, f, "IBM1047")
    want = df.select("i", raw.alias("r"), wrong.alias("w")).orderBy("i").collect()
    column, put = vector.writer(spark, F.col("A"), df.schema["A"].dataType, f, "IBM1047")
    values_ = df.orderBy("i").select(column.alias("v")).toArrow().column("v").combine_chunks()
    made, failed = put(values_)
    there = values_.is_valid().to_numpy(zero_copy_only=False)
    for i, w in enumerate(want):
        bad = failed is not None and bool(failed[i] and there[i])
        assert bad == w["w"], values[i]
        if not bad:
            assert (made[i].tobytes() if there[i] else bytes(f.size)) == bytes(w["r"]), values[i]


def test_slices_of_batches_and_no_rows():
    column = pa.array([b"\x00\x01", b"\x00\x02", b"\x00\x03"], pa.binary())
    assert vector.integers(vector.matrix(column.slice(1), 2)[0]).tolist() == [2, 3]
    assert vector.matrix(column.slice(3), 2)[0].shape == (0, 2)
    assert vector.unscaled(pa.array([Decimal("1.5"), None, Decimal("-2.5")]).slice(1))[0].tolist() == [0, -25]
    assert vector.packed(np.frombuffer(bytes.fromhex("123c"), dtype=np.uint8).reshape(1, 2), Field("A", "DECIMAL", 2, 3, 0))[0].tolist() == [123]


def test_write_and_read_many_kinds(spark, tmp_path):
    layout = Layout((Field("K", "INTEGER", 8), Field("V", "DECIMAL", 8, 13, 2), Field("S", "STRING", 9), Field("D", "DATE", 4)))
    rows = spark.range(1000).select(F.col("id").alias("K"), ((F.col("id") - 500) / 4).cast("decimal(13,2)").alias("V"), F.concat(F.lit("n["), F.col("id").cast("string"), F.lit("]")).alias("S"), F.date_add(F.lit("1950-01-01").cast("date"), F.col("id").cast("int") * 50).alias("D"))
    assert records.write_records(rows, layout, str(tmp_path / "a")) == 1000
    got = quality.split(records.read_layout(spark, str(tmp_path / "a"), layout))[0]
    # Letters for brackets are read as brackets, but written as the charset has them.
    assert got.select("K", "V", "D").exceptAll(rows.select("K", "V", "D")).count() == 0 and got.count() == 1000
    with pytest.raises(Exception, match="can't encode S"):
        records.write_records(rows.withColumn("S", F.lit("much too long")), layout, str(tmp_path / "b"))
    assert not (tmp_path / "b").exists()
    assert isinstance(got.schema["V"].dataType, T.DecimalType)
