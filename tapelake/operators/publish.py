"""Tables in files: new rows come to stand in the place of old ones in a step that can't be seen half done.

A table whose rows mostly change gets a new folder, a version, and one change of its location in the metastore.  A table
of which few files change keeps the others: rewritten files are staged in a folder that readers don't see, and a
journal, whose creation is the commit, says which to add and which to remove; whoever comes next finishes a journal
that was left.  A partitioned table gets a new location for each partition that changes.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

VERSION, STAGED, JOURNAL = "__v-", "_staged-", "_journal-"
#: Share of a table's files up to which only those that change are rewritten.
SHARE = 0.5
#: Seconds for which readers may still use a version that was replaced.
GRACE = 3600


@dataclass(frozen=True)
class Table:
    """What the metastore says of a table."""

    name: str
    location: str
    provider: str
    partitions: list[str]

    @property
    def base(self) -> str:
        """Its location without the name of a version."""
        return self.location.partition(VERSION)[0]


def _scala_list(x) -> list:
    return [x.apply(i) for i in range(x.size())]


def described(spark: SparkSession, name: str) -> Table:
    state = spark._jsparkSession.sessionState()
    meta = state.catalog().getTableMetadata(state.sqlParser().parseTableIdentifier(name))
    return Table(name, meta.location().toString().rstrip("/"), meta.provider().get() if meta.provider().isDefined() else "parquet", _scala_list(meta.partitionColumnNames()))


def _fs(spark: SparkSession, path: str) -> tuple:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def quoted(text: str) -> str:
    """A string of SQL."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    """A file that is there as a whole or not at all."""
    fs, at = _fs(spark, path)
    draft = _path(spark, f"{path.rpartition('/')[0]}/_draft-{uuid.uuid4().hex}")
    with_bytes = fs.create(draft, False)
    with_bytes.write(bytearray(text.encode()))
    with_bytes.close()
    if not fs.rename(draft, at):
        raise OSError(f"{path} can't be written")


def _read_text(spark: SparkSession, path) -> str:
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _roll_forward(spark: SparkSession, journal) -> None:
    """Do what a journal says; what is done already is left alone."""
    fs, said = journal.getFileSystem(spark._jsc.hadoopConfiguration()), json.loads(_read_text(spark, journal))
    folder = journal.getParent().toString()
    staged = f"{folder}/{STAGED}{said['id']}"
    for name in said["add"]:
        if fs.exists(_path(spark, f"{staged}/{name}")):
            fs.rename(_path(spark, f"{staged}/{name}"), _path(spark, f"{folder}/{name}"))
    for name in said["remove"]:
        fs.delete(_path(spark, f"{folder}/{name}"), False)
    fs.delete(_path(spark, staged), True)
    fs.delete(journal, False)


def recover(spark: SparkSession, name: str) -> int:
    """Finish the journals that killed jobs left in a table's folder; returns how many there were."""
    fs, at = _fs(spark, described(spark, name).location)
    left = [s.getPath() for s in fs.listStatus(at) if s.getPath().getName().startswith(JOURNAL)] if fs.exists(at) else []
    for journal in left:
        _roll_forward(spark, journal)
    if left:
        spark.catalog.refreshTable(name)
    return len(left)


def plain(path: str) -> str:
    """A path as it may be compared: without the scheme of local files, and unquoted."""
    return "/" + unquote(path).removeprefix("file:").strip("/") if path.startswith(("file:", "/")) else unquote(path).rstrip("/")


def drop_versions(spark: SparkSession, table: Table, grace: float = GRACE) -> list[str]:
    """Delete the folders of a table's old versions whose successors are more than ``grace`` seconds old."""
    fs, base = _fs(spark, table.base)
    if table.partitions or not fs.exists(base.getParent()):
        return []
    own = [s for s in fs.listStatus(base.getParent()) if s.getPath().getName() == base.getName() or s.getPath().getName().startswith(base.getName() + VERSION)]
    own.sort(key=lambda s: s.getModificationTime())
    current, gone = plain(described(spark, table.name).location), []
    for old, successor in zip(own, own[1:]):
        if plain(old.getPath().toString()) != current and successor.getModificationTime() / 1000 < time.time() - grace:
            fs.delete(old.getPath(), True)
            gone.append(old.getPath().getName())
    return gone


def replace_rows(spark: SparkSession, name: str, rows: DataFrame, grace: float = GRACE) -> None:
    """Give a table other rows of the same columns: a new folder, and then its location, which is one change of the metastore."""
    table = described(spark, name)
    version = f"{table.base}{VERSION}{uuid.uuid4().hex}"
    rows.write.format(table.provider).save(version)
    spark.sql(f"alter table {name} set location {quoted(version)}")
    spark.catalog.refreshTable(name)
    drop_versions(spark, table, grace)


def replace_table(spark: SparkSession, name: str, rows: DataFrame, provider: str = "parquet", partitions: list[str] | None = None) -> int:
    """Make a table anew from rows, whatever it was before, and return their number.

    The rows are written under a name that no other table has; only then the old table goes and the name passes on, so
    that a job which is killed leaves the old table or all new rows.
    """
    fresh = f"{name.rpartition('.')[0]}.`_{uuid.uuid4().hex}`".lstrip(".")
    seen = Observation()
    writer = rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.format(provider)
    (writer.partitionBy(*partitions) if partitions else writer).saveAsTable(fresh)
    if spark.catalog.tableExists(name):
        old = described(spark, name)
        spark.sql(f"drop table {name}")
        fs, base = _fs(spark, old.base)
        if fs.exists(base.getParent()):
            for s in fs.listStatus(base.getParent()):
                if s.getPath().getName().startswith(base.getName() + VERSION) or (VERSION in old.location and s.getPath().getName() == base.getName()):
                    fs.delete(s.getPath(), True)
    spark.sql(f"alter table {fresh} rename to {name}")
    if partitions:
        spark.sql(f"msck repair table {name} sync partitions")  # a rename moves their folders, but not what is known of them
    return seen.get["rows"]


def _replace_partitions(spark: SparkSession, table: Table, rows: DataFrame, touched: list) -> None:
    """Give the partitions in ``touched`` other rows, one by one; a partition without any gets an empty folder."""
    version = f"{table.base}{VERSION}{uuid.uuid4().hex}"
    keys = table.partitions
    chosen = spark.createDataFrame(touched, rows.select(*(f"`{k}`" for k in keys)).schema)
    on = None
    for k in keys:
        same = rows[f"`{k}`"].eqNullSafe(chosen[f"`{k}`"])
        on = same if on is None else on & same
    rows.join(F.broadcast(chosen) if len(touched) < 10_000 else chosen, on, "left_semi").write.format(table.provider).partitionBy(*keys).save(version)
    util = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    for row in touched:
        texts = {k: None if row[k] is None else str(row[k]) for k in keys}
        folder = version + "".join(f"/{util.getPartitionPathString(k, v)}" for k, v in texts.items())
        _fs(spark, folder)[0].mkdirs(_path(spark, folder))
        spec = ", ".join(f"`{k}` = " + ("null" if v is None else quoted(v)) for k, v in texts.items())
        spark.sql(f"alter table {table.name} add if not exists partition ({spec})")
        spark.sql(f"alter table {table.name} partition ({spec}) set location {quoted(folder)}")
    spark.catalog.refreshTable(table.name)


def rewrite(spark: SparkSession, name: str, touched: DataFrame | None, change: Callable[[DataFrame], DataFrame], tallied: Callable[[DataFrame], tuple[DataFrame, Callable[[], dict]]], action: str, share: float = SHARE) -> dict:
    """Rewrite a table's rows by ``change``, which adds the column ``action``, and return the tallies of its actions.

    ``touched`` gives the rows whose files change, as the column ``file``; without it all files do.  Rows of other files
    aren't read again, and count as unmodified.  ``tallied`` counts actions as rows pass.
    """
    recover(spark, name)
    table, whole = described(spark, name), spark.table(name)
    columns = whole.columns

    def kept(rows: DataFrame) -> tuple[DataFrame, Callable[[], dict]]:
        counted, tallies = tallied(rows)
        return counted.where(F.col(f"`{action}`").isin("inserted", "updated", "unmodified")).select(*(f"`{c}`" for c in columns)), tallies

    if table.partitions:
        flagged = change(whole)
        changed = flagged.where(F.col(f"`{action}`").isNotNull() & (F.col(f"`{action}`") != "unmodified")).select(*(f"`{k}`" for k in table.partitions)).distinct().collect()
        sums, tallies = tallied(flagged)
        sums.agg(F.count(F.lit(1))).collect()
        if changed:
            _replace_partitions(spark, table, kept(flagged)[0], changed)
        return tallies()
    files = [unquote(r["file"]) for r in touched.select("file").distinct().collect()] if touched is not None else None
    every = whole.inputFiles()
    if files is None or len(files) > share * len(every) or {plain(f.rpartition("/")[0]) for f in files} - {plain(table.location)}:
        rows, tallies = kept(change(whole))
        replace_rows(spark, name, rows)
        return tallies()
    before = whole.count()
    old = spark.read.format(table.provider).schema(whole.schema).load(files) if files else whole.limit(0)
    held = old.count() if files else 0
    run = uuid.uuid4().hex
    staged = f"{table.location}/{STAGED}{run}"
    rows, tallies = kept(change(old))
    rows.write.format(table.provider).save(staged)
    fs, at = _fs(spark, staged)
    add = [s.getPath().getName() for s in fs.listStatus(at) if not s.getPath().getName().startswith(("_", "."))]
    journal = f"{table.location}/{JOURNAL}{run}"
    _write_text(spark, journal, json.dumps({"id": run, "add": add, "remove": [f.rpartition("/")[2] for f in files]}))
    _roll_forward(spark, _path(spark, journal))
    spark.catalog.refreshTable(name)
    found = dict(tallies())
    found["unmodified"] = (found.get("unmodified") or 0) + before - held
    return found
