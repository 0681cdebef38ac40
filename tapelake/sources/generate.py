"""Synthetic records of a layout, for tests and load trials."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapelake.functions.layout import Field, Layout
from tapelake.operators import quality


def _value(f: Field, i: Column, today: str) -> Column:
    day = F.lit(today).cast("date")
    if f.typ == "DECIMAL":
        return (i % (10 ** (f.precision + f.scale)) * F.lit(10 ** -f.scale).cast(f"decimal(18,{f.scale})")).cast(f.spark_type)
    if f.typ == "DATE" or (f.typ in ("INTEGER", "UNSIGNED_INTEGER") and f.cast == "DATE"):
        moved = F.date_add(day, i.cast("int") - 30)
        return moved if f.typ == "DATE" else F.date_format(moved, "yyyyMMdd").cast("long")
    if f.typ in ("INTEGER", "UNSIGNED_INTEGER"):
        return i % ((1 << (8 * f.size - 1)) - 1) + 1
    if f.cast == "DATE":
        return F.date_format(day, (f.format or "YYYY-MM-DD").replace("Y", "y").replace("D", "d"))
    if f.typ == "BYTES":
        return F.unhex(F.left(F.repeat(F.sha2(i.cast("string"), 256), f.size // 32 + 1), F.lit(2 * f.size)))
    return F.lpad(F.conv(i, 10, 36), f.size, "0")


def values(spark: SparkSession, layout: Layout, rows: int, today: str = "2024-01-31") -> DataFrame:
    """Rows that count up in every field; the base date is a parameter, so equal calls give equal rows."""
    return spark.range(rows).select(*(_value(f, F.col("id"), today).alias(f.name) for f in layout.fields))


def gen_records(spark: SparkSession, layout: Layout, rows: int, today: str = "2024-01-31") -> DataFrame:
    """(rec): the rows encoded."""
    return quality.encode_or_fail(values(spark, layout, rows, today), layout)
