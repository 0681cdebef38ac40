"""Loads into tables: formats, dispositions, partitions, clustering and schema changes."""

from __future__ import annotations

import datetime
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tapelake.operators import publish

CORRUPT = "_corrupt_record"


def schema_of(spec: str) -> T.StructType:
    """NAME:TYPE,… as a schema, with warehouse type names."""
    kinds = {"INT64": "bigint", "INTEGER": "bigint", "FLOAT64": "double", "NUMERIC": "decimal(38,9)", "BOOL": "boolean", "BYTES": "binary", "DATETIME": "timestamp_ntz"}
    fields = [f.strip().split(":") for f in spec.split(",") if f.strip()]
    return T.StructType.fromDDL(", ".join(f"`{n}` {kinds.get(t.upper(), t)}" for n, t in fields))


def parsed_csv(spark: SparkSession, path: str, *, schema: T.StructType | None = None, sep: str = ",", quote: str = '"', encoding: str = "UTF-8", skip: int = 0, null: str = "", multiline: bool = False, ignore_unknown: bool = False, jagged: bool = False) -> DataFrame:
    """The rows of CSV files, and in ``_corrupt_record`` the text of those that are malformed.

    Without a schema types are inferred first, from all rows.  More rows than one to skip are cut off the beginning of each
    file: lines before they are parsed, or, where quoted line breaks are allowed, rows once they are; the latter needs a schema.
    """
    options = {"sep": sep, "quote": quote, "encoding": encoding, "nullValue": null, "multiLine": multiline, "enforceSchema": True, "header": skip == 1}
    if skip > 1 and multiline and schema is None:
        raise ValueError("a schema is needed to skip several rows of files with quoted line breaks")

    def lines() -> object:
        text = _after(spark.read.option("encoding", encoding).text(path), skip, T.StructType([T.StructField("value", T.StringType())])).where("value <> ''")
        return getattr(text._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())

    cut_lines = skip > 1 and not multiline
    if schema is None:
        reader = spark.read.options(**options).option("inferSchema", True)
        schema = DataFrame(reader._jreader.csv(lines()), spark).schema if cut_lines else reader.csv(path).schema
    wide = T.StructType([*schema, T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.options(**options).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).schema(wide)
    rows = DataFrame(reader._jreader.csv(lines()), spark) if cut_lines else reader.csv(path)
    if skip > 1 and multiline:
        rows = _after(rows, skip, wide)
    q = re.escape(quote)
    unquoted = F.regexp_replace(CORRUPT, f"{q}[^{q}]*{q}", "") if quote else F.col(CORRUPT)
    pieces, tolerated = F.size(F.split(unquoted, f"\\Q{sep}\\E")), F.lit(False)
    if ignore_unknown:
        tolerated = tolerated | (pieces > len(schema))
    if jagged:
        tolerated = tolerated | (pieces < len(schema))
    return rows.withColumn(CORRUPT, F.when(~tolerated, F.col(CORRUPT)))


def parsed_json(spark: SparkSession, path: str, schema: T.StructType | None = None, **options) -> DataFrame:
    """The rows of line-delimited JSON files, and in ``_corrupt_record`` the text of those that are malformed."""
    reader = spark.read.options(**options).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    inferred = schema or T.StructType([f for f in reader.json(path).schema if f.name != CORRUPT])
    return reader.schema(T.StructType([*inferred, T.StructField(CORRUPT, T.StringType())])).json(path)


def _judged(rows: DataFrame) -> tuple[DataFrame, Column]:
    """(rows, which are malformed).  All columns are read: a row is malformed by any of them, and Spark doesn't read the corrupt one alone."""
    names = [f"`{n}`" for n in rows.columns if n != CORRUPT]
    whole = F.hash(*map(F.col, names)) >= -(1 << 31) if names else F.lit(True)  # always true
    return rows.where(whole), F.col(CORRUPT).isNotNull()


def _good(rows: DataFrame, most_bad: int) -> DataFrame:
    rows, bad = _judged(rows)
    found = rows.where(bad).count()
    if found > most_bad:
        raise ValueError(f"{found} malformed rows, more than {most_bad}")
    return rows.where(~bad).drop(CORRUPT)


def read_csv(spark: SparkSession, path: str, *, most_bad: int = 0, **options) -> DataFrame:
    """Read CSV, see ``parsed_csv``.  More than ``most_bad`` malformed rows fail, with or without a schema; they are counted
    before the rows are read, so that ``load_files`` is cheaper where rows go to a table.
    """
    return _good(parsed_csv(spark, path, **options), most_bad)


def _after(rows: DataFrame, skip: int, schema: T.StructType) -> DataFrame:
    """The rows of each file after the first ``skip``: those of the split that begins the file are counted as they stream by."""
    names, arrow = schema.names, to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, int] = {}
        for batch in batches:
            kept = np.ones(len(batch), dtype=bool)
            for i, (file, start) in enumerate(zip(batch.column(len(names)).to_pylist(), batch.column(len(names) + 1).to_pylist(), strict=True)):
                if start == 0 and seen.get(file, 0) < skip:
                    seen[file] = seen.get(file, 0) + 1
                    kept[i] = False
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(batch.columns, arrow, strict=False)], schema=arrow).filter(pa.array(kept))

    placed = rows.select(*(F.col(f"`{n}`") for n in names), F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"))
    return placed.mapInArrow(run, schema)


FORMATS = {"NEWLINE_DELIMITED_JSON": "json", "JSON": "json", "CSV": "csv", "ORC": "orc", "PARQUET": "parquet", "AVRO": "avro"}


def _format(kind: str) -> str:
    if kind.upper() not in FORMATS:
        raise ValueError(f"source format {kind.upper()} is not supported")
    return FORMATS[kind.upper()]


def read_any(spark: SparkSession, path: str, kind: str = "ORC", schema: T.StructType | None = None, **options) -> DataFrame:
    """Read a file set by its format's name; Avro needs its Spark module on the classpath and says so otherwise.

    More than ``most_bad`` malformed rows of CSV or JSON fail.
    """
    name = _format(kind)
    if name == "csv":
        return read_csv(spark, path, schema=schema, **options)
    if name == "json":
        most = options.pop("most_bad", 0)
        return _good(parsed_json(spark, path, schema, **options), most)
    reader = spark.read.format(name).options(**options)
    return (reader.schema(schema) if schema else reader).load(path)


def load_files(spark: SparkSession, path: str, table: str, kind: str = "ORC", schema: T.StructType | None = None, disposition: str = "EMPTY", most_bad: int = 0, loading: dict | None = None, **options) -> tuple[int, int]:
    """Load files into a table and return (rows loaded, malformed rows left out); more than ``most_bad`` of these leave the table as it was.

    Text files are parsed once: rows are counted as they are written to a table of their own, which takes the place of the
    target, or is added to it, only if few enough are malformed.  ``loading`` goes to ``load``.
    """
    name = _format(kind)
    if name not in ("csv", "json"):
        return load(read_any(spark, path, kind, schema, **options), table, disposition, **(loading or {})), 0
    rows, bad = _judged(parsed_csv(spark, path, schema=schema, **options) if name == "csv" else parsed_json(spark, path, schema, **options))
    if disposition == "EMPTY" and _exists(spark, table) and not spark.table(table).isEmpty():
        raise ValueError(f"{table} is not empty")
    seen, staged = Observation(), f"{table.rpartition('.')[0]}.`_{uuid.uuid4().hex}`".lstrip(".")
    counted = rows.observe(seen, F.count_if(~bad).alias("rows"), F.count_if(bad).alias("bad"))
    try:
        counted.where(~bad).drop(CORRUPT).write.format("parquet").saveAsTable(staged)
        if seen.get["bad"] > most_bad:
            raise ValueError(f"{seen.get['bad']} malformed rows, more than {most_bad}")
        return load(spark.table(staged), table, disposition, **(loading or {})), seen.get["bad"]
    finally:
        spark.sql(f"drop table if exists {staged}")


def _exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def evolve(df: DataFrame, target: T.StructType, *, addition: bool = False, relaxation: bool = False) -> DataFrame:
    """Suit rows to a table: new columns need ``addition``, missing or nullable ones ``relaxation`` where the table says NOT NULL."""
    have, want = {f.name: f for f in df.schema}, {f.name: f for f in target}
    if extra := [n for n in have if n not in want]:
        if not addition:
            raise ValueError(f"columns not in the table: {extra}")
    for n, f in want.items():
        if n in have and have[n].dataType != f.dataType:
            raise ValueError(f"{n}: {have[n].dataType.simpleString()} for a column of {f.dataType.simpleString()}")
        if not f.nullable and (n not in have or have[n].nullable) and not relaxation:
            raise ValueError(f"{n} is required")
    return df.select(*(F.col(f"`{n}`") if n in have else F.lit(None).cast(f.dataType).alias(n) for n, f in want.items()), *(F.col(f"`{n}`") for n in extra))


def load(df: DataFrame, table: str, disposition: str = "EMPTY", *, partition: str | None = None, cluster: list[str] | None = None, expire_seconds: int | None = None, require_filter: bool = False, addition: bool = False, relaxation: bool = False, format: str = "parquet") -> int:
    """Write rows to a table, which is made if there is none; returns the rows written.

    EMPTY fails if the table holds a row, TRUNCATE replaces it once all rows are written, APPEND adds.  ``partition`` is a date column;
    ``cluster`` range-partitions and sorts rows, so that scans can skip files.
    """
    spark = df.sparkSession
    there = _exists(spark, table)
    if disposition == "EMPTY" and there and not spark.table(table).isEmpty():
        raise ValueError(f"{table} is not empty")
    if disposition == "APPEND" and there:
        old = spark.table(table)
        df = evolve(df, old.schema, addition=addition, relaxation=relaxation)
        have = {f.name: f.nullable for f in df.schema}
        if loose := [f.name for f in old.schema if not f.nullable and have[f.name]]:
            relax(spark, table, loose)
        if len(df.columns) > len(old.columns):
            names = set(old.columns)
            spark.sql(f"alter table {table} add columns ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in df.schema if f.name not in names)})")
    if partition and not isinstance(df.schema[partition].dataType, T.DateType):
        raise ValueError(f"{partition}: tables are partitioned by a date")
    if cluster:
        df = df.repartitionByRange(*cluster).sortWithinPartitions(*([partition] if partition else []), *cluster)
    if there and disposition == "TRUNCATE":
        rows = publish.replace_table(spark, table, df, format, [partition] if partition else None)
    else:
        seen = Observation()
        writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.format(format).mode("append" if disposition == "APPEND" else "overwrite")
        (writer.partitionBy(partition) if partition else writer).saveAsTable(table)
        rows = seen.get["rows"]
    props = {"expire_seconds": expire_seconds, "require_partition_filter": require_filter or None, "cluster": ",".join(cluster) if cluster else None}
    if kept := ", ".join(f"'lake.{k}'='{v}'" for k, v in props.items() if v is not None):
        spark.sql(f"alter table {table} set tblproperties ({kept})")
    return rows


def relax(spark: SparkSession, table: str, columns: list[str]) -> None:
    """Let columns of a table hold nulls from now on."""
    database, _, name = table.rpartition(".")
    schema = T.StructType([T.StructField(f.name, f.dataType, f.nullable or f.name in columns, f.metadata) for f in spark.table(table).schema])
    parts = {r[0] for r in spark.sql(f"show partitions {table}").collect()} if spark.catalog.listColumns(table) and any(c.isPartition for c in spark.catalog.listColumns(table)) else set()
    data = T.StructType([f for f in schema if f.name not in {c.name for c in spark.catalog.listColumns(table) if c.isPartition}]) if parts else schema
    catalog = spark._jsparkSession.sharedState().externalCatalog()
    catalog.alterTableDataSchema(database or spark.catalog.currentDatabase(), name, spark._jvm.org.apache.spark.sql.types.DataType.fromJson(data.json()))
    spark.catalog.refreshTable(table)


def create(spark: SparkSession, table: str, spec: str, partition: str | None = None) -> None:
    """An empty table of NAME:TYPE columns."""
    load(spark.createDataFrame([], schema_of(spec)), table, "EMPTY", partition=partition)


def create_view(spark: SparkSession, view: str, query: str) -> None:
    spark.sql(f"create or replace view {view} as {query}")


def external_orc(spark: SparkSession, table: str, location: str, schema: T.StructType, lifetime: int = 604_800) -> None:
    """(Re)create a table over ORC files; a lifetime of up to a minute counts as seven days."""
    spark.sql(f"drop table if exists {table}")
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(f"create table {table} ({ddl}) using orc location '{location}' tblproperties ('lake.expire_seconds'='{lifetime if lifetime > 60 else 604_800}')")


def expire_partitions(spark: SparkSession, table: str, column: str, seconds: int, today: datetime.date) -> list[datetime.date]:
    """Drop day partitions older than this many seconds; returns the days."""
    last = today - datetime.timedelta(seconds=seconds)
    days = [datetime.date.fromisoformat(r[0].split("=")[1]) for r in spark.sql(f"show partitions {table}").collect()]
    old = sorted(d for d in days if d < last)
    for i in range(0, len(old), 200):
        spark.sql(f"alter table {table} drop " + ", ".join(f"partition ({column}='{day}')" for day in old[i : i + 200]))
    return old


def _seq(x) -> list:
    return [x.apply(i) for i in range(x.size())]


def _conjuncts(expression) -> list:
    if expression.getClass().getSimpleName() == "And":
        return _conjuncts(expression.left()) + _conjuncts(expression.right())
    return [expression]


def check_partition_filter(df: DataFrame, column: str) -> None:
    """Fail unless every scan that has the partition column is filtered by it.

    The optimised plan is walked: a condition counts if it refers to this column of the scan by more than IS NOT NULL.
    """

    def ids(expression, name: str | None = None) -> set[str]:
        return {a.exprId().toString() for a in _seq(expression.references().toSeq()) if name is None or a.name().lower() == name}

    def walk(node, filtered: set[str]) -> None:
        kind = node.getClass().getSimpleName()
        if kind == "Filter":
            for c in _conjuncts(node.condition()):
                if c.getClass().getSimpleName() != "IsNotNull":
                    filtered = filtered | ids(c)
        if kind in ("LogicalRelation", "DataSourceV2ScanRelation", "HiveTableRelation", "LogicalRDD"):
            own = {a.exprId().toString() for a in _seq(node.output()) if a.name().lower() == column.lower()}
            if own and not own & filtered:
                raise ValueError(f"a filter on {column} is required")
        for child in _seq(node.children()):
            walk(child, filtered)

    plan = df._jdf.queryExecution().optimizedPlan()
    walk(plan, set())
