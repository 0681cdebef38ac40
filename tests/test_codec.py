"""Golden byte vectors of the record functions."""

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapelake.functions import codec
from tapelake.functions.layout import Field, Layout, field_of

PARCELS = """
01 PARCEL-SCAN.
  05 DEPOT       PIC S9(4) COMP.
  05 PARCEL-ID   PIC S9(18) COMP.
  05 WEIGHT-KG   PIC S9(5)V9(3) COMP-3.   * a comment
  05 FEE         PIC S9(7)V99 COMP-3.
  05 LANE        PIC X.
  05 SCAN-CODE   PIC X(06).
"""


def decode(spark, f, *hexes, encoding="IBM1047"):
    rows = spark.createDataFrame([(i, bytearray.fromhex(h)) for i, h in enumerate(hexes)], "i int, rec binary")
    value, wrong = codec.decode_field(F.col("rec"), f, 0, encoding)
    return [(r["v"], bool(r["e"])) for r in rows.select("i", value.alias("v"), F.coalesce(wrong, F.lit(False)).alias("e")).orderBy("i").collect()]


def encode(spark, f, kind, *values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], T.StructType([T.StructField("i", T.IntegerType()), T.StructField("v", kind)]))
    raw, wrong = codec.encode_field(F.col("v"), kind, f, "IBM1047")
    return [(bytes(r["r"]).hex(), r["e"]) for r in rows.select("i", raw.alias("r"), wrong.alias("e")).orderBy("i").collect()]


def test_copybook():
    layout = Layout.from_copybook(PARCELS)
    assert (layout.lrecl, len(layout.fields)) == (27, 6)
    assert layout.fields[-1].name == "SCAN_CODE"
    assert [f.dataType.simpleString() for f in layout.schema] == ["bigint"] * 2 + ["decimal(8,3)", "decimal(9,2)", "string", "string"]
    with pytest.raises(ValueError, match="OCCURS"):
        Layout.from_copybook("05 A PIC X OCCURS 3 TIMES.")
    with pytest.raises(ValueError, match="line 1"):
        Layout.from_copybook("05 A = 7")
    assert field_of("LONG", "PIC X(4064).").typ == "BYTES"
    assert field_of("PAY-DT", "PIC X(10)").nullif == b"\xf0" * 10


def test_layout_from_json_and_override():
    layout = Layout.from_json({"field": [{"name": "A", "typ": "STRING", "size": 4}, {"name": "B", "typ": "INTEGER", "size": 2, "filler": True}]})
    changed = layout.override({"A": {"size": 6}})
    assert (layout.lrecl, changed.lrecl, changed.offsets, changed.schema.names) == (6, 8, (0, 6), ["A"])
    with pytest.raises(ValueError, match="no such field"):
        layout.override({"C": {}})


@pytest.mark.parametrize(("size", "hexes", "values"), [(2, ["8000", "ffff", "0000", "7fff"], [-32768, -1, 0, 32767]), (4, ["80000000", "ffffffff", "7fffffff"], [-(1 << 31), -1, (1 << 31) - 1]), (8, ["8000000000000000", "ffffffffffffffff", "7fffffffffffffff"], [-(1 << 63), -1, (1 << 63) - 1])])
def test_integers(spark, size, hexes, values):
    assert decode(spark, Field("A", "INTEGER", size), *hexes) == [(v, False) for v in values]
    assert encode(spark, Field("A", "INTEGER", size), T.LongType(), *values) == [(h, False) for h in hexes]


def test_unsigned(spark):
    assert decode(spark, Field("A", "UNSIGNED_INTEGER", 2), "ffff") == [(65535, False)]
    assert decode(spark, Field("A", "UNSIGNED_INTEGER", 8), "ffffffffffffffff") == [(-1, False)]


def test_packed(spark):
    f = Field("A", "DECIMAL", 4, 5, 2)
    assert decode(spark, f, "1234567c", "1234567d", "1234567b", "1234567f", "00000000", "ffffffff", "40404040") == [
        (Decimal("12345.67"), False), (Decimal("-12345.67"), False), (Decimal("-12345.67"), False), (Decimal("12345.67"), False), (None, False), (None, True), (None, False)]
    assert decode(spark, Field("A", "DECIMAL", 3, 4, 0), "01234c", "12345c") == [(Decimal(1234), False), (None, True)]
    got = encode(spark, f, T.DecimalType(12, 4), Decimal("12345.6789"), Decimal("-0.0010"), Decimal("-1.5"), None, Decimal("123456"), Decimal("-123456"))
    assert got == [("1234567c", False), ("0000000c", False), ("0000150d", False), ("00000000", False), ("00000000", True), ("00000000", True)]


def test_strings(spark):
    f = Field("A", "STRING", 4)
    assert decode(spark, f, "e4c94040", "adbd5f40", "babbb040", "40404040", "00000000") == [("UI", False), ("[]^", False), ("[]^", False), (None, False), (None, False)]
    assert decode(spark, Field("A", "STRING", 2, nullable=False), "4040") == [("", False)]
    assert decode(spark, Field("A", "STRING", 3, nullif=b"\xc1"), "c1c2c3", "c2c1c3") == [(None, False), ("BAC", False)]
    assert encode(spark, f, T.StringType(), "UI", "too long", None, "日") == [("e4c94040", False), ("00000000", True), ("00000000", False), ("00000000", True)]


def test_localized(spark):
    f = Field("A", "LOCALIZED_STRING", 10, charset="IBM939")
    assert decode(spark, f, "0e459c0fc10e43810f40", "40" * 10, "00" * 10) == [("水Aア", False), (None, False), (None, False)]
    u = Field("A", "LOCALIZED_STRING", 8, charset="UTF-8")
    assert encode(spark, u, T.StringType(), "āō", "āāāāā") == [("c481c58d20202020", False), ("00" * 8, True)]


def test_dates(spark):
    day = datetime.date
    text = Field("A", "STRING", 10, cast="DATE", format="MM/DD/YYYY")
    hexed = [s.encode("cp1140").hex() for s in ("02/09/2020", "00/00/0000", "02/30/2020", "13/01/2020")]
    assert decode(spark, text, *hexed) == [(day(2020, 2, 9), False), (None, False), (day(2020, 2, 29), False), (None, True)]
    packed = Field("A", "DATE", 4)
    assert encode(spark, packed, T.DateType(), day(2020, 2, 9), day(1899, 12, 31), None)[0] == ("00125051", False)
    assert decode(spark, packed, "00125051", "00000000", "001250ff") == [(day(2020, 2, 9), False), (None, False), (None, True)]


def test_timestamps(spark):
    f = Field("A", "STRING", 26, cast="TIMESTAMP")
    want = datetime.datetime(2020, 1, 2, 3, 4, 5, 678901)
    hexed = [s.encode("cp1140").hex() for s in ("2020-01-02 03:04:05.678901", "2020-01-02-03.04.05.678901", "0000-00-00-00.00.00.000000", "2020-99-02-03.04.05.678901")]
    assert decode(spark, f, *hexed) == [(want, False), (want, False), (None, False), (None, True)]


def test_text_casts(spark):
    assert decode(spark, Field("A", "STRING", 4, cast="INTEGER"), "f0f0f0f8", "c1c1c1c1") == [(8, False), (None, True)]
    assert decode(spark, Field("A", "STRING", 7, 5, 2, cast="DECIMAL"), "f0f0f0f44bf8f2") == [(Decimal("4.82"), False)]
    assert decode(spark, Field("A", "DECIMAL", 2, 1, 2, cast="STRING"), "003c") == [("0.03", False)]


def test_vartext(spark):
    layout = Layout((Field("A", "STRING", 2), Field("B", "INTEGER", 9), Field("C", "STRING", 10, cast="DATE", format="MM/DD/YYYY"), Field("D", "DECIMAL", 10, 7, 2)), encoding="UTF-8", vartext=True)
    lines = ["US|000000001|02/01/2020|0000002.10", "US|7.000|00/00/0000|2.1", "US|x||1.00"]
    rows = spark.createDataFrame([(s.encode(),) for s in lines], "rec binary")
    from tapelake.operators import quality

    got = [tuple(r) for r in quality.decode(rows, layout).select("A", "B", "C", "D", "_err").collect()]
    assert got[0] == ("US", 1, datetime.date(2020, 2, 1), Decimal("2.10"), [])
    assert got[1] == ("US", 7, None, None, ["D"])
    assert got[2] == ("US", None, None, Decimal("1.00"), ["B", "C"])


def test_time_text(spark):
    assert spark.range(1).select(codec.time_text(F.lit((3 * 3600 + 4 * 60 + 5) * 1_000_000))).first()[0] == "3:4:5"
