"""Quality gates: rejects, error thresholds, export checks, reconciliation and the job log."""

from __future__ import annotations

import datetime
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapelake.functions import codec, vector
from tapelake.functions.layout import Layout

ERRORS = "_err"


def names_of(errors: list[tuple[str, Column]]) -> Column:
    """Names of the fields whose error column is true; the list is made only for rows that have an error.

    Errors are added up and not joined by OR, so that each is evaluated together with the value it belongs to.
    """
    none = F.array().cast("array<string>")
    if not errors:
        return none
    flags = [(n, F.coalesce(e, F.lit(False))) for n, e in errors]
    total = sum((e.cast("int") for _, e in flags), F.lit(0))
    return F.when(total > 0, F.array_compact(F.array(*(F.when(e, F.lit(n)) for n, e in flags)))).otherwise(none)


def finished(raw: DataFrame, made: vector.Reading) -> DataFrame:
    """The fields of what a reader's batches gave, with the record and ``_err``."""
    return raw.select(*(v.alias(f.name) for f, v, _ in made.found), F.col("rec"), names_of([("record", made.short)] + [(f.name, e) for f, _, e in made.found]).alias(ERRORS))


def decode(records: DataFrame, layout: Layout, rec: str = "rec", columns: list[str] | None = None) -> DataFrame:
    """Every field of the layout, or those in ``columns``, with the record and ``_err``, the names of the fields that failed.

    Bytes beyond the layout are ignored; a record shorter than the layout fails under the name ``record``.  Fixed-length
    records are decoded by whole batches, delimited ones by column expressions.
    """
    if layout.vartext:
        found = [x for x in codec.decode_columns(layout, F.col(rec)) if columns is None or x[0].name in columns]
        return records.select(*(v.alias(f.name) for f, v, _ in found), F.col(rec), names_of([(f.name, e) for f, _, e in found]).alias(ERRORS))
    made = vector.reading(records.sparkSession, layout, columns)
    read = made.read

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield read(batch.column(0))

    out = finished(records.select(rec).mapInArrow(run, made.schema), made)
    return out if rec == "rec" else out.withColumnRenamed("rec", rec)


def split(decoded: DataFrame, rec: str = "rec") -> tuple[DataFrame, DataFrame]:
    """(good rows without bookkeeping, rejects: the raw record and the failed fields)."""
    good = decoded.where(F.size(ERRORS) == 0).drop(rec, ERRORS)
    return good, decoded.where(F.size(ERRORS) > 0).select(rec, ERRORS)


class TooManyErrors(RuntimeError):
    pass


def check_errors(errors: int, records: int, most: float = 0.0) -> None:
    """Fail if errors are more than this share of the records; no records pass."""
    if records and errors / records > most:
        raise TooManyErrors(f"{errors} of {records} records are in error, more than {most:g}")


def counts(decoded: DataFrame) -> tuple[int, int]:
    """(records, records in error) in one pass."""
    row = decoded.agg(F.count("*").alias("n"), F.count_if(F.size(ERRORS) > 0).alias("e")).first()
    return row["n"], row["e"]


def check_export(df: DataFrame, layout: Layout, lrecl: int | None = None, recfm: str = "FB") -> None:
    """Column count and types must suit the layout, which must fit the file's record length."""
    if recfm != "FB":
        raise ValueError(f"record format {recfm}; only FB can be written")
    if len(df.columns) != len(layout.fields):
        raise ValueError(f"{len(df.columns)} columns for {len(layout.fields)} fields")
    if lrecl is not None and layout.lrecl > lrecl:
        raise ValueError(f"the layout takes {layout.lrecl} bytes, records have {lrecl}")
    suits = {"INTEGER": T.IntegralType, "UNSIGNED_INTEGER": T.IntegralType, "DECIMAL": (T.DecimalType, T.IntegralType), "DATE": T.DateType, "BYTES": T.BinaryType}
    for column, f in zip(df.schema, layout.fields, strict=True):
        if isinstance(column.dataType, (T.ArrayType, T.MapType, T.StructType)):
            raise ValueError(f"{column.name}: nested columns can't be written")
        dated = isinstance(column.dataType, T.DateType) and f.typ == "INTEGER" and f.size == 4
        if f.typ in suits and not isinstance(column.dataType, suits[f.typ]) and not dated:
            raise ValueError(f"{column.name}: {column.dataType.simpleString()} for a field of type {f.typ}")


EncodeError = vector.EncodeError


def encode(df: DataFrame, layout: Layout, lrecl: int | None = None) -> DataFrame:
    """(rec, _err, then the row's columns): records padded with zero bytes to ``lrecl``."""
    made = [codec.encode_field(F.col(f"`{c.name}`"), c.dataType, f, layout.encoding) for c, f in zip(df.schema, layout.fields, strict=True)]
    rec = F.rpad(F.concat(*(r for r, _ in made)), lrecl or layout.lrecl, F.lit(b"\0"))
    return df.select(rec.alias("rec"), names_of([(f.name, e) for f, (_, e) in zip(layout.fields, made, strict=True)]).alias(ERRORS), "*")


def encode_or_fail(df: DataFrame, layout: Layout, lrecl: int | None = None) -> DataFrame:
    """(rec), encoded by whole batches; the job fails at the first row that can't be encoded, naming fields, types and values."""
    made = vector.writing(df, layout, lrecl)
    encode = made.encode

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = encode(batch)
            fixed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(m.shape[1]), len(m), [None, pa.py_buffer(m)])
            yield pa.RecordBatch.from_arrays([fixed.cast(pa.binary())], names=["rec"])

    return df.select(*made.columns).mapInArrow(run, "rec binary")


def reconcile(written: int, expected: int) -> None:
    if written != expected:
        raise RuntimeError(f"{written} rows were written, the result has {expected}")


# Job log

#: Columns of the log: one row for a run.
LOG_SCHEMA = (
    "job_name string, job_date date, job_time timestamp, timestamp timestamp, job_id string, job_json string, step_name string, proc_step_name string, system_id string, dataset string, job_type string, "
    "source string, destination string, query string, statement_type string, query_plan string, timeline string, records_in long, records_out long, errors long, rows_read long, rows_written long, rows_affected long, "
    "rows_inserted long, rows_deleted long, rows_updated long, rows_unmodified long, rows_loaded long, rows_before_merge long, bytes_processed long, bytes_in long, bytes_out long, "
    "duration_ms long, start_time timestamp, end_time timestamp, slot_ms long, shuffle_bytes long, spill_bytes long, exit_code int, message string"
)


@dataclass
class Result:
    """Outcome of a job: exit code, activity count, message and exported values."""

    exit_code: int = 0
    activity_count: int = 0
    message: str = ""
    exported: dict = field(default_factory=dict)


def log_rows(spark: SparkSession, entries: list[dict]) -> DataFrame:
    """Rows of the job log; empty values and unknown names are left out, what is missing is null."""
    schema = T.StructType.fromDDL(LOG_SCHEMA)
    rows = [tuple(e.get(f.name) if e.get(f.name) not in ("", None) else None for f in schema) for e in entries]
    return spark.createDataFrame(rows, schema)


def append_log(spark: SparkSession, path: str, entry: dict) -> None:
    """Append one run, partitioned by its date."""
    now = datetime.datetime.now(datetime.timezone.utc)
    log_rows(spark, [{"job_date": now.date(), "timestamp": now} | entry]).write.mode("append").partitionBy("job_date").parquet(path)
