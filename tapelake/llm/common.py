"""Helpers shared by the corpus operators: Arrow batch plumbing, lineage cuts and byte words."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text handled together in one step of a task; it bounds a task's memory whatever the batch size is.
STEP_BYTES = 8 << 20


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and return it with its lineage cut.

    The folder is the session's ``spark.checkpoint.dir``.  Where that is unset, a run on one machine (a local master,
    as in tests) gets a temporary one; a cluster gets an error, as its machines share no local folder.
    """
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir is not set; it names the folder that driver and executors share")
            folder = tempfile.mkdtemp(prefix="spark-")
        context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_batches(df: DataFrame, schema: str, function: Callable[[dict[str, list]], dict[str, list]], weigh: str) -> DataFrame:
    """Map rows to rows in Arrow batches.

    ``function`` gets columns as Python lists, at most about STEP_BYTES of the column ``weigh`` at once, and returns
    columns named as in ``schema``.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, weigh):
                out = function({n: c.to_pylist() for n, c in zip(part.schema.names, part.columns, strict=True)})
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def steps(batch: pa.RecordBatch, weigh: str) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with about STEP_BYTES in column ``weigh``; a row is never cut."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.names.index(weigh))), 0).to_pylist()
    start = held = 0
    for i, size in enumerate(sizes):
        if held and held + size > STEP_BYTES:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield batch.slice(start)


def ascii_words(text: str | None) -> list[bytes]:
    """Lower-case A-Z and cut at the blanks x20 and x09 to x0D; null gives no word."""
    return text.encode().lower().split() if text else []


def held_out(doc_id: str = "doc_id") -> F.Column:
    """Whether a document belongs to the test fold: crc32 of its id as text is divisible by 5."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))
