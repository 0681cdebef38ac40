"""Registered queries do the whole job below what their SQL twins show."""

import glob
import os

import pytest

from tapelake.plans import catalog

DATA = "/root/testdata/sf0.001"


def test_localized_texts_come_back_whole(spark):
    texts = ["a" * 254 + "  " + "b" * 600 + "   ", "   ", "\u00e9\u65e5\U0001f600 " * 300, "x", ".", " lead"]
    df = spark.createDataFrame([*enumerate(texts), (90, None), (91, ""), (0, "same id")], "k long, text string")
    assert sorted(map(tuple, catalog.localized_texts(df).collect())) == sorted([*enumerate(texts), (0, "same id")])


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_day_partitions_cover_the_table(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(catalog, "scratch", lambda spark: str(tmp_path / "days"))
    catalog.day_partition_read(spark, DATA).collect()
    days = catalog.table(spark, DATA, "orders").selectExpr("cast(o_orderdate as date)").distinct().count()
    assert len(glob.glob(str(tmp_path / "days/o_orderdate=*"))) == days
