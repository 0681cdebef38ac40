"""Record files: scans of fixed-length bytes, and sinks that write them part by part."""

from __future__ import annotations

import gzip
import re
import uuid
import zlib
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import nullcontext

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapelake.functions import codec, vector
from tapelake.functions.layout import Layout
from tapelake.operators import quality

#: Bytes that one range of a file and one task cover, and schemes that Arrow has clients for.
RANGE, TASK = 16 << 20, 128 << 20
#: Bytes of a range that are read and handed on together: a worker holds one such piece and not a range in several copies.
READ = 1 << 20
GZIP = b"\x1f\x8b"
CLIENTS = ("file", "s3", "gs", "abfs", "abfss")
#: Bytes of an export part that a sink buffers before it writes.
BUFFER = 8 << 20
#: Records that are decoded together.
RECORDS = 1 << 14
#: Bytes of a file's beginning that tell whether it is gzipped.
HEAD = 4 << 10
SIDECAR = ".lrecl"


def _fs(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def dataset_path(root: str, name: str) -> str:
    """Where a dataset lies: members are files below it, a generation's name stands for all generations unless it has a member."""
    hit = re.fullmatch(r"([A-Z0-9@#$.-]+?)(\.G\d{4}V\d{2})?(?:\(([^)]*)\))?", name)
    if not hit:
        raise ValueError(f"not a dataset name: {name!r}")
    base, generation, member = hit.groups()
    if generation:
        return f"{root}/{base}{generation if member is not None else ''}"
    if member is None:
        return f"{root}/{base}"
    return f"{root}/{name}" if re.fullmatch(r"[+-]?\d+", member) else f"{root}/{base}/{member}"


def generations(root: str, name: str) -> list[str]:
    """Files of a dataset in the order of their names: the plain file, or its generations, never both."""
    fs, at = _fs(root)
    found = sorted(i.base_name for i in fs.get_file_info(pafs.FileSelector(at)) if not i.base_name.endswith(SIDECAR))
    plain, numbered = [f for f in found if f == name], [f for f in found if re.fullmatch(re.escape(name) + r"\.G\d{4}V\d{2}", f)]
    if plain and numbered:
        raise ValueError(f"{name} exists both as a file and as generations")
    if not plain and not numbered:
        raise FileNotFoundError(f"{root}/{name}")
    return [f"{root}/{f}" for f in plain or numbered]


def resolve_lrecl(path: str, lrecl: int | None = None, layout: Layout | None = None) -> int:
    """The record length: as given, else from the file beside the data, else the layout's."""
    if lrecl:
        return lrecl
    fs, at = _fs(path + SIDECAR)
    if fs.get_file_info(at).type == pafs.FileType.File:
        return int(fs.open_input_stream(at).read())
    if layout:
        return layout.lrecl
    raise ValueError(f"{path}: the record length is not known")


def files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, length) of the data files; contents are not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length").where(~F.endswith("path", F.lit(SIDECAR)))


def _few(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Rows of the driver's as a relation of Spark's own; from a plain list executors would start more Python workers to unpickle them."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(T.StructType.fromDDL(schema))
    columns = zip(*rows, strict=True) if rows else [()] * len(arrow)
    return spark.createDataFrame(pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow))


def _qualified(spark: SparkSession, path: str) -> str:
    fs, at = _hadoop(spark, path)
    return fs.makeQualified(at).toString().rstrip("/")


def listed(spark: SparkSession, path: str | list[str]) -> list[tuple[str, int]]:
    """(path, length) of the data files that hold anything, in the order in which they are read: by the paths given, then by name.

    The driver holds names and lengths only.
    """
    given = [_qualified(spark, p) for p in ([path] if isinstance(path, str) else path)]
    place = {p: i for i, p in reversed(list(enumerate(given)))}

    def order(file: str) -> tuple[int, str]:
        above = file
        while above and above not in place:
            above = above.rpartition("/")[0]
        return place.get(above, len(given)), file

    found = files(spark, path).where("length > 0").select("path", "length").collect()
    return sorted(((r["path"], r["length"]) for r in found), key=lambda f: order(f[0]))


def read_records(spark: SparkSession, path: str | list[str], lrecl: int, *, most: int | None = None, compression: str = "auto", range_bytes: int = RANGE) -> DataFrame:
    """(rec): the files' bytes cut every ``lrecl`` bytes; a shorter record at a file's end is kept and later fails.

    ``path`` is a file, a folder or a list of them.  Records come in order: partitions hold runs of ranges of about
    ``range_bytes``, in the order of ``listed``, so that what is written partition by partition keeps it.  With ``most`` only
    the first records are read, and only the ranges that hold them are opened.  Plain files of any size are split over
    tasks by ranges of whole records; a gzipped file can't be split and is one task's work, unpacked as a stream.

    ``compression`` says which files are gzipped: ``gzip`` all, ``none`` none; ``auto`` those whose names end in .gz and whose
    first bytes agree, and others whose beginning can be unpacked.

    Where Arrow has no client for the file system, Hadoop's record reader splits plain files instead, which must hold
    whole records, files named .gz are unpacked whole, and records come in no particular order.
    """
    paths = [path] if isinstance(path, str) else path
    if all(p.partition(":")[0] in CLIENTS for p in paths if "://" in p):
        return ranged_records(spark, paths, lrecl, most=most, compression=compression, range_bytes=range_bytes)
    found = [p for p, _ in listed(spark, paths)]
    packed, plain = [p for p in found if p.lower().endswith(".gz")], [p for p in found if not p.lower().endswith(".gz")]
    parts = [spark.read.format("binaryFile").load(packed).select("content").mapInArrow(_unpacker(lrecl), "rec binary")] if packed else []
    if plain or not packed:
        parts.append(spark.createDataFrame(spark.sparkContext.binaryRecords(",".join(plain or paths), lrecl).map(lambda b: (bytearray(b),)), "rec binary"))
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return out if most is None else out.limit(most)


def gzipped(head: bytes) -> bool:
    """Whether a file that begins so is gzipped: its header says so and what follows can be unpacked."""
    if not head.startswith(GZIP + b"\x08") or len(head) < 4 or head[3] & 0xE0:
        return False
    try:
        zlib.decompressobj(wbits=31).decompress(head)
    except zlib.error:
        return False
    return True


def _packed_files(spark: SparkSession, found: list[tuple[str, int]], compression: str) -> set[str]:
    """Which of the files are gzipped; tasks look at the beginnings of those whose names don't tell."""
    if compression != "auto":
        return {p for p, _ in found} if compression == "gzip" else set()

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for file in batch.column(0).to_pylist():
                fs, at = _fs(file)
                with fs.open_input_file(at) as opened:
                    if gzipped(opened.read(HEAD)):
                        kept.append(file)
            yield pa.RecordBatch.from_arrays([pa.array(kept, pa.string())], names=["path"])

    unnamed = [(p,) for p, _ in found if not p.lower().endswith(".gz")]
    tasks = min(len(unnamed), 4 * spark.sparkContext.defaultParallelism)
    told = _few(spark, unnamed, "path string").repartition(tasks).mapInArrow(look, "path string").collect() if unnamed else []
    return {p for p, _ in found if p.lower().endswith(".gz")} | {r["path"] for r in told}


def _held(spark: SparkSession, files_: list[str], lrecl: int, most: int) -> list[int]:
    """How many records each gzipped file holds; counting stops at ``most``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column(0).to_pylist():
                n = 0
                for part in _unpacked_file(file, lrecl):
                    n += len(part)
                    if n >= most:
                        break
                yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([min(n, most)], pa.int64())], names=["path", "n"])

    told = dict(_few(spark, [(f,) for f in files_], "path string").repartition(len(files_)).mapInArrow(count, "path string, n long").collect())
    return [told[f] for f in files_]


def _first_files(spark: SparkSession, found: list[tuple[str, int]], packed: set[str], lrecl: int, most: int) -> list[tuple[str, int, int]]:
    """(path, length, records to take) of the files that hold the first ``most`` records.

    A plain file's length tells how many it holds; gzipped ones are counted in growing groups until there are enough.
    """
    out, left, at, group = [], most, 0, 1
    while at < len(found) and left > 0:
        run = [f for f, _ in found[at : at + group] if f in packed]
        counts = dict(zip(run, _held(spark, run, lrecl, left), strict=True)) if run else {}
        for file, length in found[at : at + group]:
            take = min(left, counts[file] if file in packed else -(-length // lrecl))
            if take:
                out.append((file, length, take))
            left -= take
        at, group = at + group, 2 * group
    return out


def _unpacked(stream, lrecl: int) -> Iterator[pa.RecordBatch]:
    with gzip.GzipFile(fileobj=stream) as unpacked:
        while block := unpacked.read(max(1, BUFFER // lrecl) * lrecl):
            yield cut_records(block, lrecl)


def _unpacked_file(file: str, lrecl: int) -> Iterator[pa.RecordBatch]:
    """A file that is gzipped by its name; if its first bytes disagree it is read as it is."""
    fs, at = _fs(file)
    with fs.open_input_file(at) as opened:
        told = opened.read(2) == GZIP
    with fs.open_input_stream(at, compression=None) as stream:
        if told:
            yield from _unpacked(stream, lrecl)
            return
        while block := stream.read(max(1, BUFFER // lrecl) * lrecl):
            yield cut_records(block, lrecl)


def _unpacker(lrecl: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import io

        for batch in batches:
            for data in batch.column(0).to_pylist():
                yield from _unpacked(io.BytesIO(data), lrecl)

    return run


def cut_records(data: bytes, lrecl: int) -> pa.RecordBatch:
    """Records of one block without copying them one by one."""
    n, rest = divmod(len(data), lrecl)
    parts = [pa.FixedSizeBinaryArray.from_buffers(pa.binary(lrecl), n, [None, pa.py_buffer(data[: n * lrecl])]).cast(pa.binary())]
    if rest:
        parts.append(pa.array([data[n * lrecl :]], pa.binary()))
    return pa.RecordBatch.from_arrays([pa.concat_arrays(parts)], names=["rec"])


def numbered_records(spark: SparkSession, path: str | list[str], lrecl: int, **options) -> DataFrame:
    """(path, number, rec): records with their place, so that ``orderBy("path", "number")`` restores the order of the input.

    Generations sort by name as they were made.  It takes a file system that Arrow has a client for.
    """
    return ranged_records(spark, path, lrecl, numbered=True, **options)


def _placed(records: Iterator[pa.RecordBatch], file: str, first: int, take: int, numbered: bool) -> Iterator[pa.RecordBatch]:
    """The first ``take`` records, or all for -1."""
    for batch in records:
        batch = batch if take < 0 else batch.slice(0, take)
        n = len(batch)
        if numbered:
            columns = [pa.array([file]).take(pa.array(np.zeros(n, dtype=np.int64))), pa.array(np.arange(first, first + n)), batch.column(0)]
            batch = pa.RecordBatch.from_arrays(columns, names=["path", "number", "rec"])
        yield batch
        first += n
        if take >= 0:
            take -= n
            if not take:
                return


RANGES = "path string, start long, size long, take long, number long"


def ranges(spark: SparkSession, path: str | list[str], lrecl: int, *, most: int | None = None, compression: str = "auto", range_bytes: int = RANGE) -> DataFrame:
    """(path, start, size, take, number): byte ranges of whole records, dealt to tasks in runs of their running number.

    A task gets about TASK bytes, however many ranges that are.  ``start`` is -1 for a gzipped file, ``take`` -1 for all records.
    """
    step = max(1, range_bytes // lrecl) * lrecl
    found = listed(spark, path)
    packed = _packed_files(spark, found, compression)
    chosen = [(f, n, -1) for f, n in found] if most is None else _first_files(spark, found, packed, lrecl, most)
    rows, number, offset = [], 0, 0
    for file, length, take in chosen:
        used = length if take < 0 or file in packed else min(length, take * lrecl)
        many = 1 if file in packed else -(-used // step)
        rows.append((file, file in packed, used, take, many, number, offset))
        number, offset = number + many, offset + used
    tasks = max(1, min(number, max(spark.sparkContext.defaultParallelism, -(-offset // TASK))))
    held = _few(spark, rows, "path string, packed boolean, used long, take long, many long, first long, offset long")
    each = held.withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("many") - 1)))
    start = F.col("i") * step
    left = F.when(F.col("packed") | (F.col("take") < 0), F.col("take")).otherwise(F.least(F.lit(step // lrecl).cast("long"), F.col("take") - F.col("i") * (step // lrecl)))
    slot = F.floor((F.col("offset") + start).cast("double") * tasks / max(1, offset)).cast("int")
    placed = each.select("path", F.when(F.col("packed"), -1).otherwise(start).alias("start"), F.lit(step).cast("long").alias("size"), left.alias("take"), (F.col("first") + F.col("i")).alias("number"), F.least(slot, F.lit(tasks - 1)).alias("slot"))
    return placed.repartitionById(tasks, "slot").drop("slot").sortWithinPartitions("number")


def _pieces(opened: pa.NativeFile, lrecl: int, left: int) -> Iterator[pa.RecordBatch]:
    """Records of the next ``left`` bytes, READ bytes or one record at a time; shorter only at the file's end."""
    piece = max(1, READ // lrecl) * lrecl
    while left > 0 and (block := opened.read(min(piece, left))):
        left -= len(block)
        yield cut_records(block, lrecl)


def blocks(batches: Iterator[pa.RecordBatch], lrecl: int) -> Iterator[tuple[str, int, int, Iterator[pa.RecordBatch]]]:
    """(path, first record, records to take, records) of each range."""
    for batch in batches:
        for file, start, size, take, _ in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if start < 0:
                yield file, 0, take, _unpacked_file(file, lrecl)
                continue
            fs, at = _fs(file)
            with fs.open_input_file(at) as opened:
                opened.seek(start)
                yield file, start // lrecl, take, _pieces(opened, lrecl, size if take < 0 else min(size, take * lrecl))


def ranged_records(spark: SparkSession, path: str | list[str], lrecl: int, numbered: bool = False, **options) -> DataFrame:
    """(rec), or (path, number, rec), by the byte ranges of ``ranges``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file, first, take, records in blocks(batches, lrecl):
            yield from _placed(records, file, first, take, numbered)

    return ranges(spark, path, lrecl, **options).mapInArrow(run, "path string, number long, rec binary" if numbered else "rec binary")


def read_gzip(spark: SparkSession, path: str | list[str], lrecl: int) -> DataFrame:
    """(rec) of gzipped files, which ``read_records`` tells by their first bytes."""
    return read_records(spark, path, lrecl)


def agreed_lrecl(path: str | list[str], lrecl: int | None = None, layout: Layout | None = None) -> int:
    """The record length that all inputs agree on; generations of different lengths can't be read as one."""
    lengths = {p: resolve_lrecl(p, lrecl, layout) for p in ([path] if isinstance(path, str) else path)}
    if len(set(lengths.values())) > 1:
        raise ValueError(f"record lengths differ: {lengths}")
    return next(iter(lengths.values()))


def read_layout(spark: SparkSession, path: str | list[str], layout: Layout, lrecl: int | None = None, columns: list[str] | None = None, **options) -> DataFrame:
    """Decoded rows, all fields or those in ``columns``, with the record and its failed fields.

    An empty input has the layout's schema and no row.  Fixed-length records are decoded in the batches that cut the ranges.
    """
    size = agreed_lrecl(path, lrecl, layout)
    paths = [path] if isinstance(path, str) else path
    if layout.vartext or not all(p.partition(":")[0] in CLIENTS for p in paths if "://" in p):
        return quality.decode(read_records(spark, path, size, **options), layout, columns=columns)
    made = vector.reading(spark, layout, columns)
    read = made.read

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file, first, take, found in blocks(batches, size):
            for batch in _placed(found, file, first, take, False):
                # Few enough records at a time that a batch's columns stay in the processor's caches.
                for at in range(0, len(batch), RECORDS):
                    yield read(batch.column(0).slice(at, RECORDS))

    return quality.finished(ranges(spark, paths, size, **options).mapInArrow(run, made.schema), made)


def read_lines(spark: SparkSession, path: str, lrecl: int, encoding: str = "IBM1047") -> DataFrame:
    """(line): text records without their trailing blanks."""
    name = codec.charset(encoding)
    text = F.decode("rec", name)
    return read_records(spark, path, lrecl).select(F.rtrim(F.translate(text, *codec.EBCDIC_READ) if name == "IBM1047" else text).alias("line"))


def ingest(spark: SparkSession, path: str | list[str], layout: Layout, target: str, *, lrecl: int | None = None, replace: bool = False, most_errors: float = 0.0, rejects: str | None = None, rows_a_file: int = 0) -> quality.Result:
    """Decode records into ORC parts in one pass.

    Parts are written beside the target and counted as they are; only if the error share allows it they are moved to
    the target, which must be empty unless it is replaced.  Rejected records go to ``rejects``, by a pass of their own
    over the errors, and never to the target.
    """
    decoded = read_layout(spark, path, layout, lrecl)
    if not replace and _holds_files(spark, target):
        raise FileExistsError(f"{target} exists and is not empty")
    seen = Observation()
    counted = decoded.observe(seen, F.count(F.lit(1)).alias("records"), F.count_if(F.size(quality.ERRORS) > 0).alias("errors"), F.sum(F.octet_length("rec")).alias("bytes_in"))
    staged = f"{target.rstrip('/')}__staged-{uuid.uuid4().hex}"
    try:
        quality.split(counted)[0].write.option("maxRecordsPerFile", rows_a_file).orc(staged)
        n, errors, size = (seen.get[k] or 0 for k in ("records", "errors", "bytes_in"))
        quality.check_errors(errors, n, most_errors)
        _move(spark, staged, target)
    finally:
        _remove(spark, staged)
    if rejects and errors:
        quality.split(decoded)[1].write.mode("overwrite" if replace else "error").parquet(rejects)
    return quality.Result(activity_count=n - errors, exported={"records": n, "errors": errors, "bytes_in": size})


def _hadoop(spark: SparkSession, path: str) -> tuple:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _holds_files(spark: SparkSession, path: str) -> bool:
    fs, at = _hadoop(spark, path)
    return fs.exists(at) and any(not f.getPath().getName().startswith(("_", ".")) for f in fs.listStatus(at))


def _remove(spark: SparkSession, path: str) -> None:
    fs, at = _hadoop(spark, path)
    fs.delete(at, True)


def _move(spark: SparkSession, source: str, target: str) -> None:
    """Put a folder in the place of another, or of none; the old one steps aside first and goes last, so nothing is lost in between."""
    fs, at = _hadoop(spark, target)
    fs.mkdirs(at.getParent())
    aside = _hadoop(spark, f"{target.rstrip('/')}__old-{uuid.uuid4().hex}")[1] if fs.exists(at) else None
    if aside is not None and not fs.rename(at, aside):
        raise OSError(f"{target} can't be replaced")
    if not fs.rename(_hadoop(spark, source)[1], at):
        if aside is not None:
            fs.rename(aside, at)
        raise OSError(f"{source} can't be moved to {target}")
    if aside is not None:
        fs.delete(aside, True)


# Sinks


def _body(column: pa.Array) -> pa.Buffer:
    """The bytes of a binary column's values one after another, as they lie."""
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, kind, len(column) + 1, column.offset * kind().itemsize)
    return pa.py_buffer(b"") if data is None else data.slice(int(ends[0]), int(ends[-1] - ends[0]))


def _publish(fs: pafs.FileSystem, staged: str, target: str) -> None:
    """Put a staged folder in the place of another, or of none: the old one steps aside first and goes last, so nothing is lost in between."""
    old = f"{target}__old-{uuid.uuid4().hex}"
    there = fs.get_file_info(target).type != pafs.FileType.NotFound
    if there:
        fs.move(target, old)
    fs.move(staged, target)
    if there:
        fs.delete_dir(old)


def _part(number: int, run_id: str, compress: bool) -> str:
    return f"part-{number:07d}-{run_id}" + (".gz" if compress else "")


def write_bytes(records: DataFrame, path: str, lrecl: int | None = None, compress: bool = False, mode: str = "append", encode=None) -> int:
    """Write the column ``rec`` as part files, and a sidecar with the record length; returns the rows written.

    Parts are numbered as the partitions are, so that their names keep the order of the rows.  Where the target holds parts
    already, ``mode`` says whether to ``append`` to them, to ``replace`` them once all is written, or that this is an ``error``.
    A task writes under a name of its own and only names that successful tasks report become parts, so a task that runs
    twice leaves no duplicate.  ``path`` must be a folder that all executors share.  ``encode`` makes the bytes of a batch of
    other columns.
    """
    run_id = uuid.uuid4().hex
    fs, at = _fs(path)
    at = at.rstrip("/")
    staged = f"{at}__staged-{run_id}"
    there = fs.get_file_info(at).type == pafs.FileType.Directory
    held = [i.base_name for i in fs.get_file_info(pafs.FileSelector(at))] if there else []
    old = [n for n in held if n.startswith("part-")]
    if old and mode == "error":
        raise FileExistsError(f"{path} holds records already")
    if len(old) < len(held) and mode == "replace":
        raise FileExistsError(f"{path} holds other files than records, which replacing it would remove")
    first = 1 + max((int(n.split("-")[1]) for n in old), default=-1) if mode != "replace" else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        fs, _ = _fs(path)
        number, name = TaskContext.get().partitionId(), uuid.uuid4().hex
        rows, out = 0, None
        for batch in batches:
            if batch.num_rows and out is None:
                out = fs.open_output_stream(f"{staged}/{name}", compression="gzip" if compress else None, buffer_size=BUFFER)
            if batch.num_rows:
                out.write(encode(batch) if encode else _body(batch.column(0)))
            rows += batch.num_rows
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([name]), pa.array([rows], pa.int64())], names=["number", "name", "rows"])

    fs.create_dir(staged, recursive=True)
    try:
        done = sorted(tuple(r) for r in (records if encode else records.select("rec")).mapInArrow(run, "number long, name string, rows long").collect())
        kept = {name for _, name, _ in done}
        with ThreadPoolExecutor(16) as pool:
            list(pool.map(lambda x: fs.move(f"{staged}/{x[1][1]}", f"{staged}/{_part(first + x[0], run_id, compress)}"), enumerate(done)))
            left = [i.path for i in fs.get_file_info(pafs.FileSelector(staged)) if not i.base_name.startswith("part-") and i.base_name not in kept]
            list(pool.map(fs.delete_file, left))
            if there and mode != "replace":
                list(pool.map(lambda i: fs.move(i.path, f"{at}/{i.base_name}"), fs.get_file_info(pafs.FileSelector(staged))))
            else:
                _publish(fs, staged, at)
    finally:
        if fs.get_file_info(staged).type == pafs.FileType.Directory:
            fs.delete_dir(staged)
    if lrecl:
        with fs.open_output_stream(f"{at}{SIDECAR}") as side:
            side.write(str(lrecl).encode())
    return sum(rows for _, _, rows in done)


def write_records(df: DataFrame, layout: Layout, path: str, lrecl: int | None = None, mode: str = "error") -> int:
    """Check, encode and write a result as fixed-length records; the count is reconciled with the bytes on disk.

    A target that holds records is refused before anything is written, or replaced where ``mode`` is ``replace``.
    """
    quality.check_export(df, layout, lrecl)
    size = lrecl or layout.lrecl
    made = vector.writing(df, layout, size)
    rows = write_bytes(df.select(*made.columns), path, size, mode=mode, encode=made.encode)
    stored = files(df.sparkSession, path).agg(F.sum("length")).first()[0] or 0
    quality.reconcile(stored // size, rows)
    return rows


def vartext_records(df: DataFrame, lrecl: int, delimiter: str = "|", encoding: str = "IBM1047") -> DataFrame:
    """(rec): values joined by the delimiter, null as nothing, cut to ``lrecl`` - 1 and closed with a blank."""
    parts = [F.coalesce(codec.text_of(F.col(f"`{c.name}`"), c.dataType), F.lit("")) for c in df.schema]
    line = F.rpad(F.rpad(F.concat_ws(delimiter, *parts), lrecl - 1, " "), lrecl, " ")
    return df.select(F.encode(line, codec.charset(encoding)).alias("rec"))


def write_vartext(df: DataFrame, path: str, lrecl: int, delimiter: str = "|", encoding: str = "IBM1047") -> int:
    return write_bytes(vartext_records(df, lrecl, delimiter, encoding), path, lrecl)


def copy_records(spark: SparkSession, path: str, target: str, lrecl: int, most: int | None = None, compress: bool = True, **options) -> int:
    """Copy records unchanged and in their order, the first ``most`` of them or all: parts in the order of their names hold them as the input does."""
    return write_bytes(read_records(spark, path, lrecl, most=most, **options), target, lrecl, compress)


def compose(spark: SparkSession, path: str, target: str) -> int:
    """Join a folder's part files, in the order of their names, into one file; an empty folder gives an empty file.

    A job copies the parts.  In a shared file system each task writes its part at its place; a store that can't write
    within a file gets the whole as one task's stream.  The driver sees names and lengths only.
    """
    fs, at = _fs(path)
    parts = sorted((i.path, i.size) for i in fs.get_file_info(pafs.FileSelector(at)) if i.is_file and i.base_name.startswith("part-"))
    starts = np.cumsum([0, *(n for _, n in parts)]).tolist()
    to, out = _fs(target)
    with to.open_output_stream(out):
        pass
    local = isinstance(to, pafs.LocalFileSystem)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (here, _), (there, place) = _fs(path), _fs(target)
        joined = None if local else there.open_output_stream(place)
        for batch in batches:
            for part, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with here.open_input_stream(part, compression=None) as opened, nullcontext(joined) if joined else open(place, "r+b") as file:
                    if local:
                        file.seek(start)
                    while block := opened.read(BUFFER):
                        file.write(block)
        if joined:
            joined.close()
        yield from ()

    if parts:
        rows = _few(spark, [(p, s) for (p, _), s in zip(parts, starts, strict=False)], "part string, start long")
        spread = rows.repartition(min(len(parts), 4 * spark.sparkContext.defaultParallelism)) if local else rows.coalesce(1).sortWithinPartitions("start")
        spread.mapInArrow(run, "part string").write.format("noop").mode("overwrite").save()
    return starts[-1]
