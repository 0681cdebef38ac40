"""Record files, gates, tables, merges and SQL jobs."""

import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tapelake.functions.layout import Field, Layout
from tapelake.operators import merge, quality, sqljob
from tapelake.sources import generate, records, tables

LAYOUT = Layout((Field("A", "INTEGER", 4), Field("B", "STRING", 8), Field("C", "DECIMAL", 6, 9, 2)))


def test_round_trip_ragged_and_limits(spark, tmp_path):
    path = f"{tmp_path}/data"
    rows = generate.values(spark, LAYOUT, 1000)
    assert records.write_records(rows, LAYOUT, path, 20) == 1000
    assert records.resolve_lrecl(path) == 20
    good, bad = quality.split(records.read_layout(spark, path, LAYOUT))
    assert sorted(map(tuple, good.collect())) == sorted(map(tuple, rows.collect()))
    assert bad.count() == 0
    part = sorted(Path(path).glob("part-*"))[0]
    with part.open("ab") as file:
        file.write(b"\x01\x02")
    assert records.read_layout(spark, path, LAYOUT).where(F.size("_err") > 0).select("_err").first()[0][0] == "record"
    assert records.compose(spark, path, f"{tmp_path}/one") == 20_002
    assert records.copy_records(spark, f"{tmp_path}/one", f"{tmp_path}/few", 20, 10) == 10
    assert records.compose(spark, f"{tmp_path}/few", f"{tmp_path}/two.gz") > 0


def test_empty(spark, tmp_path):
    path = f"{tmp_path}/none"
    assert records.write_records(generate.values(spark, LAYOUT, 0), LAYOUT, path) == 0
    target = f"{tmp_path}/orc"
    assert records.ingest(spark, path, LAYOUT, target).activity_count == 0
    assert spark.read.schema(LAYOUT.schema).orc(target).count() == 0


def test_thresholds_and_rejects(spark, tmp_path):
    path = f"{tmp_path}/bad"
    raw = quality.encode(generate.values(spark, LAYOUT, 10), LAYOUT).select(F.when(F.col("A") == 3, F.concat(F.substring("rec", 1, 12), F.unhex(F.lit("FF" * 6)))).otherwise(F.col("rec")).alias("rec"))
    records.write_bytes(raw, path, LAYOUT.lrecl)
    with pytest.raises(quality.TooManyErrors):
        records.ingest(spark, path, LAYOUT, f"{tmp_path}/t1")
    done = records.ingest(spark, path, LAYOUT, f"{tmp_path}/t2", most_errors=0.1, rejects=f"{tmp_path}/r")
    assert done.exported == {"records": 10, "errors": 1, "bytes_in": 180}
    assert spark.read.parquet(f"{tmp_path}/r").first()["_err"] == ["C"]
    with pytest.raises(Exception, match="exists"):
        records.ingest(spark, path, LAYOUT, f"{tmp_path}/t2", most_errors=0.1)


def test_encode_failure_names_the_field(spark):
    bad = spark.createDataFrame([(1, "much too long", None)], "a long, b string, c decimal(11,2)")
    with pytest.raises(Exception, match="can't encode B"):
        quality.encode_or_fail(bad, LAYOUT).collect()
    with pytest.raises(ValueError, match="columns for"):
        quality.check_export(bad.select("a"), LAYOUT)
    with pytest.raises(ValueError, match="field of type"):
        quality.check_export(bad.select("b", "b", "c"), LAYOUT)
    with pytest.raises(ValueError, match="records have"):
        quality.check_export(bad, LAYOUT, 5)


def test_names_and_generations(tmp_path):
    for name, path in (("N1.R6.MDS", "N1.R6.MDS"), ("N1.R6.MDS(TD11)", "N1.R6.MDS/TD11"), ("N1.R6.MDS.G1234V56", "N1.R6.MDS"), ("N1.R6.MDS.G0001V00(-3)", "N1.R6.MDS.G0001V00"), ("N1.R6.MDS(0)", "N1.R6.MDS(0)")):
        assert records.dataset_path("r", name) == f"r/{path}"
    for name in ("A.B.G0002V00", "A.B.G0001V00", "A.BC"):
        (tmp_path / name).write_bytes(b"")
    assert [p.rpartition("/")[2] for p in records.generations(str(tmp_path), "A.B")] == ["A.B.G0001V00", "A.B.G0002V00"]
    (tmp_path / "A.B").write_bytes(b"")
    with pytest.raises(ValueError, match="both"):
        records.generations(str(tmp_path), "A.B")


def test_csv(spark, tmp_path):
    (tmp_path / "x.csv").write_text("skip\nA,B\n1,x\n2,\n3,a,b\n")
    schema = tables.schema_of("A:INT64,B:STRING")
    with pytest.raises(ValueError, match="malformed"):
        tables.read_csv(spark, str(tmp_path / "x.csv"), schema=schema, skip=2)
    rows = tables.read_csv(spark, str(tmp_path / "x.csv"), schema=schema, skip=2, most_bad=1)
    assert sorted(map(tuple, rows.collect())) == [(1, "x"), (2, None)]
    with pytest.raises(ValueError, match="not supported"):
        tables.read_any(spark, str(tmp_path), "XML")


def test_dispositions_partitions_and_merge(spark):
    rows = spark.createDataFrame([(1, datetime.date(2024, 1, 1), 5), (2, datetime.date(2024, 1, 2), 6)], "k long, d date, v int")
    assert tables.load(rows, "lake_t", partition="d", cluster=["k"]) == 2
    with pytest.raises(ValueError, match="not empty"):
        tables.load(rows, "lake_t")
    assert tables.load(rows, "lake_t", "APPEND", partition="d") == 2
    with pytest.raises(ValueError, match="not in the table"):
        tables.load(rows.withColumn("w", F.lit(1)), "lake_t", "APPEND", partition="d")
    assert tables.expire_partitions(spark, "lake_t", "d", 86400, datetime.date(2024, 1, 3)) == [datetime.date(2024, 1, 1)]
    with pytest.raises(ValueError, match="filter"):
        tables.check_partition_filter(spark.table("lake_t"), "d")
    tables.check_partition_filter(spark.table("lake_t").where("d = date'2024-01-02'"), "d")
    assert tables.load(rows, "lake_m", "TRUNCATE") == 2
    source = spark.createDataFrame([(2, datetime.date(2024, 1, 2), 9), (3, datetime.date(2024, 1, 3), 7)], "k long, d date, v int")
    assert merge.merge_table(spark, "lake_m", source, ["k"], ["v"]) == merge.MergeCounts(2, 3, 1, 1, 1)
    assert sorted((r["k"], r["v"]) for r in spark.table("lake_m").collect()) == [(1, 5), (2, 9), (3, 7)]
    with pytest.raises(Exception, match="repeated"):
        merge.merge(rows, source.union(source), ["k"], ["v"]).collect()
    assert merge.formula_counts(2, 3, 2) == merge.MergeCounts(2, 3, 1, 1, 1)


def test_sql_jobs(spark):
    assert sqljob.run_query(spark, "select :a + 1 as x, :b as y", ["a:INT64:4", "b:STRING:NULL"]).first() == (5, None)
    assert sqljob.run_query(spark, "select ? as x", ["::a:b"]).first() == ("a:b",)
    with pytest.raises(ValueError, match="mix"):
        sqljob.parameters(["a::1", "::2"])
    with pytest.raises(ValueError, match="empty"):
        sqljob.run_query(spark, " ")
    assert sqljob.run_query(spark, "select 1", dry_run=True) is None
    assert sqljob.run_script(spark, "select ';'; select 2 as x -- done").first() == (2,)
    assert sqljob.query_to_table(spark, "select 1 as x", "lake_q").activity_count == 1


def test_job_log(spark, tmp_path):
    quality.append_log(spark, f"{tmp_path}/log", {"job_name": "j", "rows_written": 3, "unknown": 1, "source": ""})
    row = spark.read.parquet(f"{tmp_path}/log").first()
    assert (row["job_name"], row["rows_written"], row["source"]) == ("j", 3, None)


def test_text_lines(spark, tmp_path):
    (tmp_path / "t").write_bytes("SELECT 1  ".encode("cp1140") + "FROM T    ".encode("cp1140"))
    assert sorted(r[0] for r in records.read_lines(spark, str(tmp_path / "t"), 10).collect()) == ["FROM T", "SELECT 1"]


# What broke before


def test_gzip_parts_among_plain_ones(spark, tmp_path):
    import gzip

    (tmp_path / "a").write_bytes(b"0001" * 3)
    (tmp_path / "b.gz").write_bytes(gzip.compress(b"0002" * 4))
    (tmp_path / "unnamed").write_bytes(gzip.compress(b"0003") + gzip.compress(b"0004"))
    got = sorted(bytes(r["rec"]) for r in records.read_records(spark, str(tmp_path), 4).collect())
    assert got == [b"0001"] * 3 + [b"0002"] * 4 + [b"0003", b"0004"]
    assert records.read_records(spark, [str(tmp_path / "b.gz"), str(tmp_path / "a")], 4).count() == 7


def test_generations_must_agree_on_the_record_length(spark, tmp_path):
    paths = []
    for i, size in enumerate((5, 6)):
        path = str(tmp_path / f"N.X.G000{i}V00")
        records.write_bytes(spark.createDataFrame([(bytearray(b"x" * size),)], "rec binary"), path, size)
        paths.append(path)
    layout = Layout((Field("V", "STRING", 5),))
    with pytest.raises(ValueError, match="record lengths differ"):
        records.read_layout(spark, paths, layout)
    assert records.read_layout(spark, paths[:1], layout).count() == 1


def test_ingest_leaves_nothing_behind_when_errors_are_too_many(spark, tmp_path):
    path, target = str(tmp_path / "in"), tmp_path / "out"
    recs = spark.createDataFrame([(bytearray(b"\x12\x3c"),), (bytearray(b"\xff\xff"),)], "rec binary")
    records.write_bytes(recs, path, 2)
    layout = Layout((Field("V", "DECIMAL", 2, 3, 0),))
    with pytest.raises(quality.TooManyErrors):
        records.ingest(spark, path, layout, str(target))
    assert sorted(p.name for p in tmp_path.iterdir()) == ["in", "in.lrecl"]
    done = records.ingest(spark, path, layout, str(target), most_errors=0.5, rejects=str(tmp_path / "bad"))
    assert done.activity_count == 1 and done.exported == {"records": 2, "errors": 1, "bytes_in": 4}
    assert spark.read.parquet(str(tmp_path / "bad")).count() == 1
    with pytest.raises(FileExistsError):
        records.ingest(spark, path, layout, str(target), most_errors=0.5)
    records.ingest(spark, path, layout, str(target), most_errors=0.5, replace=True)
    assert [int(r[0]) for r in spark.read.orc(str(target)).collect()] == [123]


def test_compose_keeps_the_order_of_parts(spark, tmp_path):
    rows = spark.range(1000).repartitionByRange(7, "id").select(F.encode(F.lpad(F.col("id").cast("string"), 4, "0"), "UTF-8").alias("rec"))
    records.write_bytes(rows, str(tmp_path / "parts"), 4)
    assert records.compose(spark, str(tmp_path / "parts"), str(tmp_path / "one")) == 4000
    assert (tmp_path / "one").read_bytes() == b"".join(b"%04d" % i for i in range(1000))
    records.write_bytes(rows.limit(0), str(tmp_path / "none"), 4)
    assert records.compose(spark, str(tmp_path / "none"), str(tmp_path / "empty")) == 0 and (tmp_path / "empty").read_bytes() == b""


def test_merge_with_null_keys(spark):
    target = spark.createDataFrame([(1, "a"), (None, "kept")], "k long, v string")
    source = spark.createDataFrame([(None, "x"), (None, "y"), (1, "b")], "k long, v string")
    got = merge.merge(target, source, ["k"], ["v"])
    assert sorted((r["k"] or 0, r["v"]) for r in got.collect()) == [(0, "kept"), (0, "x"), (0, "y"), (1, "b")]
    counts = merge.merge_counts(target, source, ["k"], ["v"])
    assert (counts.before, counts.written, counts.inserted, counts.updated, counts.unmodified) == (2, 4, 2, 1, 1)
    two = spark.createDataFrame([(1, None, "p"), (1, None, "q")], "k long, l long, v string")
    assert merge.merge(two.limit(0), two, ["k", "l"], ["v"]).count() == 2
    with pytest.raises(Exception, match="repeated"):
        merge.merge(target, source.where("k is not null").union(source.where("k is not null")), ["k"], ["v"]).collect()


def test_packed_values_are_cut_in_their_own_scale(spark):
    from decimal import Decimal

    rows = spark.createDataFrame([(Decimal("0.0099999999"),), (Decimal("-1.2399999999"),), (Decimal("9.9999999999"),), (None,)], "v decimal(38,10)")
    layout = Layout((Field("V", "DECIMAL", 4, 5, 2),))
    made = quality.encode(rows, layout)
    assert [r[0] for r in made.select(F.size("_err")).collect()] == [0, 0, 0, 0]
    got = [r["V"] for r in quality.decode(made.select("rec"), layout).collect()]
    assert got == [Decimal("0.00"), Decimal("-1.23"), Decimal("9.99"), Decimal("0.00")] or got == [Decimal("0.00"), Decimal("-1.23"), Decimal("9.99"), None]


def test_unmappable_localized_text_is_an_error(spark):
    rows = spark.createDataFrame([("abc",), ("日本",), (None,)], "v string")
    made = quality.encode(rows, Layout((Field("V", "LOCALIZED_STRING", 8, charset="IBM037"),))).collect()
    assert [r["_err"] for r in made] == [[], ["V"], []]


def test_csv_skip_with_quoted_line_breaks(spark, tmp_path):
    schema = tables.schema_of("k:INT64,v:STRING")
    for i in range(3):
        (tmp_path / f"{i}.csv").write_text(f'head one\nhead, two\n{i},"a\nb,c"\n{i + 10},plain\n')
    got = sorted(map(tuple, tables.read_csv(spark, str(tmp_path), schema=schema, skip=2, multiline=True).collect()))
    assert got == [(0, "a\nb,c"), (1, "a\nb,c"), (2, "a\nb,c"), (10, "plain"), (11, "plain"), (12, "plain")]
    (tmp_path / "plain").mkdir()
    (tmp_path / "plain/x.csv").write_text("h\nh\n1,a\n2,b\nx,c\n3,d,e\n")
    read = lambda **o: tables.read_csv(spark, str(tmp_path / "plain"), schema=schema, skip=2, **o)
    assert read(most_bad=2).count() == 2
    with pytest.raises(ValueError, match="2 malformed"):
        read(most_bad=1)
    assert read(most_bad=1, ignore_unknown=True).count() == 3


# Order and prefixes of records


def numbers(path, lrecl=8):
    data = b"".join(p.read_bytes() for p in sorted(Path(path).glob("part-*")))
    return [int(data[i : i + lrecl]) for i in range(0, len(data), lrecl)]


def test_copies_keep_the_order_over_more_ranges_than_tasks(spark, tmp_path):
    (tmp_path / "in").write_bytes(b"".join(b"%08d" % i for i in range(5000)))
    path, options = str(tmp_path / "in"), {"range_bytes": 800}
    assert records.ranges(spark, path, 8, range_bytes=800).count() == 50
    assert records.copy_records(spark, path, str(tmp_path / "all"), 8, compress=False, **options) == 5000
    assert records.compose(spark, str(tmp_path / "all"), str(tmp_path / "one")) == 40_000
    assert (tmp_path / "one").read_bytes() == (tmp_path / "in").read_bytes()
    assert [int(r[0]) for r in records.read_lines(spark, path, 8, "US-ASCII").collect()] == list(range(5000))
    for most in (0, 1, 99, 100, 101, 2345, 5000, 9999):
        target = str(tmp_path / f"few{most}")
        assert records.copy_records(spark, path, target, 8, most, compress=False, **options) == min(most, 5000)
        assert numbers(target) == list(range(min(most, 5000)))
    assert records.ranges(spark, path, 8, most=150, range_bytes=800).count() == 2


def test_prefix_over_generations_plain_and_gzipped(spark, tmp_path):
    import gzip

    expected, paths = [], []
    for g in range(7):
        data = b"".join(b"%08d" % (100 * g + i) for i in range(30))
        paths.append(str(tmp_path / f"N.G000{g}V00"))
        Path(paths[-1]).write_bytes(gzip.compress(data) if g % 2 else data)
        expected += [100 * g + i for i in range(30)]
    for most in (None, 5, 30, 31, 61, 200, 500):
        got = [int(bytes(r[0])) for r in records.read_records(spark, paths, 8, most=most, range_bytes=80).collect()]
        assert got == expected[:most]
    turned = [int(bytes(r[0])) for r in records.read_records(spark, paths[::-1], 8, most=31).collect()]
    assert turned == [600 + i for i in range(30)] + [500]


def test_gzip_is_told_by_more_than_two_bytes(spark, tmp_path):
    plain = (8075).to_bytes(2, "big") + b"\x08\x00rest"
    (tmp_path / "plain").write_bytes(plain * 4)
    (tmp_path / "named.gz").write_bytes(b"12345678")
    assert [bytes(r[0]) for r in records.read_records(spark, str(tmp_path / "plain"), 8).collect()] == [plain] * 4
    assert [bytes(r[0]) for r in records.read_records(spark, str(tmp_path / "named.gz"), 8).collect()] == [b"12345678"]
    import gzip

    packed = gzip.compress(b"x" * 16)
    (tmp_path / "p").write_bytes(packed)
    assert records.read_records(spark, str(tmp_path / "p"), 8).count() == 2
    assert records.read_records(spark, str(tmp_path / "p"), len(packed), compression="none").count() == 1
    assert records.read_records(spark, str(tmp_path / "p"), 8, compression="gzip").count() == 2


def test_a_used_target_is_refused_or_replaced(spark, tmp_path):
    path, rows = f"{tmp_path}/data", generate.values(spark, LAYOUT, 5)
    assert records.write_records(rows, LAYOUT, path) == 5
    with pytest.raises(FileExistsError):
        records.write_records(rows, LAYOUT, path)
    assert records.read_records(spark, path, LAYOUT.lrecl).count() == 5
    assert records.write_records(rows.limit(2), LAYOUT, path, mode="replace") == 2
    assert records.read_records(spark, path, LAYOUT.lrecl).count() == 2
    recs = spark.createDataFrame([(bytearray(b"z" * LAYOUT.lrecl),)], "rec binary")
    (tmp_path / "data/notes").write_text("mine")
    with pytest.raises(FileExistsError, match="other files"):
        records.write_records(rows, LAYOUT, path, mode="replace")
    assert (tmp_path / "data/notes").read_text() == "mine"
    (tmp_path / "data/notes").unlink()
    assert records.write_bytes(recs, path) == 1
    assert bytes(records.read_records(spark, path, LAYOUT.lrecl).collect()[-1][0]) == b"z" * LAYOUT.lrecl
    assert sorted(p.name for p in tmp_path.iterdir()) == ["data", "data.lrecl"]


def test_a_range_is_handed_on_in_pieces(tmp_path):
    """A worker holds about a megabyte of a range, whole records in order, whatever the range's size."""
    import pyarrow as pa

    size, lrecl = 3_000_017, 40
    data = bytes(range(251)) * (size // 251 + 1)
    (tmp_path / "in").write_bytes(data[:size])

    def run(start, length, take, lrecl=lrecl):
        row = pa.RecordBatch.from_pydict({"path": [str(tmp_path / "in")], "start": [start], "size": [length], "take": [take], "number": [0]})
        ((_, first, n, found),) = ((file, first, n, list(found)) for file, first, n, found in records.blocks(iter([row]), lrecl))
        assert (first, n) == (start // lrecl, take)
        assert max(b.nbytes for b in found) < 3 << 19 or lrecl > 1 << 20
        return [bytes(r) for b in found for r in b.column(0).to_pylist()]

    cut = lambda start, end, lrecl=lrecl: [data[i : min(i + lrecl, end)] for i in range(start, end, lrecl)]
    assert run(0, 16 << 20, -1) == cut(0, size)
    assert run(400, 2_000_000, -1) == cut(400, 2_000_400)
    assert run(400, 2_000_000, 30_000) == cut(400, 1_200_400)
    assert run(0, 6_000_000, -1, 2_000_000) == cut(0, size, 2_000_000)


def test_ranges_come_without_python_workers(spark, tmp_path):
    """Only what reads records runs in Python; workers that unpickle the driver's list would stay beside it in memory."""
    (tmp_path / "in").write_bytes(b"0123456789" * 100)
    for options in ({}, {"most": 30}):
        made = records.ranges(spark, str(tmp_path), 10, range_bytes=100, **options)
        assert "ExistingRDD" not in made._jdf.queryExecution().executedPlan().toString()
        assert sorted((r["start"], r["take"]) for r in made.collect()) == ([(100 * i, -1) for i in range(10)] if not options else [(100 * i, 10) for i in range(3)])
    assert records.ranges(spark, str(tmp_path), 10, most=0).collect() == []


# Malformed rows and partition filters


def test_malformed_rows_without_a_schema_and_of_json(spark, tmp_path):
    (tmp_path / "c").mkdir()
    (tmp_path / "c/x.csv").write_text("a,b\n1,2\n3\n4,5,6\n7,8\n")
    read = lambda **o: tables.read_csv(spark, str(tmp_path / "c"), skip=1, **o)
    with pytest.raises(ValueError, match="2 malformed"):
        read()
    assert sorted(map(tuple, read(most_bad=2).collect())) == [(1, 2), (7, 8)]
    assert read(most_bad=1, jagged=True).count() == 3
    (tmp_path / "j").mkdir()
    (tmp_path / "j/x.json").write_text('{"k": 1, "v": "a"}\nnot json\n{"k": 2}\n{"k": \n')
    with pytest.raises(ValueError, match="2 malformed"):
        tables.read_any(spark, str(tmp_path / "j"), "NEWLINE_DELIMITED_JSON")
    for schema in (None, tables.schema_of("k:INT64,v:STRING")):
        got = tables.read_any(spark, str(tmp_path / "j"), "JSON", schema, most_bad=2)
        assert sorted((r["k"], r["v"]) for r in got.collect()) == [(1, "a"), (2, None)]
    assert tables.load_files(spark, str(tmp_path / "j"), "lake_j", "JSON", most_bad=2) == (2, 2)
    with pytest.raises(ValueError, match="not empty"):
        tables.load_files(spark, str(tmp_path / "j"), "lake_j", "JSON", most_bad=2)
    with pytest.raises(ValueError, match="2 malformed"):
        tables.load_files(spark, str(tmp_path / "j"), "lake_j", "JSON", disposition="TRUNCATE", most_bad=1)
    assert tables.load_files(spark, str(tmp_path / "j"), "lake_j", "JSON", disposition="APPEND", most_bad=2) == (2, 2)
    assert spark.table("lake_j").count() == 4 and not [t for t in spark.catalog.listTables() if t.name.startswith("_")]


def test_a_partition_filter_is_one_on_the_column_itself(spark):
    rows = spark.createDataFrame([(datetime.date(2024, 1, d), f"2024-01-0{d}", d) for d in (1, 2)], "day date, birthday string, v int")
    tables.load(rows, "lake_days", "TRUNCATE", partition="day")
    t = spark.table("lake_days")
    for fine in (t.where("day > date'2024-01-01'"), t.where("v = 1 and day in (date'2024-01-01', date'2024-01-02')"), t.where("day = date'2024-01-01'").groupBy("v").count()):
        tables.check_partition_filter(fine, "day")
    for bad in (t, t.where("birthday = '2024-01-01'"), t.where("day is not null"), t.where("day > date'2024-01-01' or v = 1").union(t), t.where("day > date'2024-01-01'").join(t.select("v"), "v").join(t.select("day", F.col("v").alias("w")), "day")):
        with pytest.raises(ValueError, match="filter on day"):
            tables.check_partition_filter(bad, "day")


def test_avro_says_what_it_lacks(spark, tmp_path):
    with pytest.raises(Exception, match="(?i)avro"):
        tables.read_any(spark, str(tmp_path), "AVRO")
