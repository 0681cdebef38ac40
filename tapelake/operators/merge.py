"""Upserts, updates and deletes as joins that rewrite the target, with exact accounting of rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tapelake.operators import publish
from tapelake.session import scratch

ACTION = "_action"


@dataclass(frozen=True)
class MergeCounts:
    before: int
    written: int
    inserted: int
    updated: int
    unmodified: int
    deleted: int = 0

    @property
    def affected(self) -> int:
        return self.inserted + self.updated + self.deleted


def free_name(name: str, *frames: DataFrame) -> str:
    """The name, or with as many underscores at its end as it takes to be no column of these."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def action_of(target: DataFrame) -> str:
    """What the column of actions is called beside the target's columns."""
    return free_name(ACTION, target)


@dataclass(frozen=True)
class Clause:
    """WHEN …: what to do with a row to which ``condition`` applies, the first clause that does: update, insert or delete.

    ``values`` are by column; an update leaves other columns alone, an insert makes them null.
    """

    kind: str
    values: dict[str, Column] = field(default_factory=dict)
    condition: Column | None = None

    def applies(self) -> Column:
        return F.lit(True) if self.condition is None else F.coalesce(self.condition, F.lit(False))


DONE = {"update": "updated", "insert": "inserted", "delete": "deleted"}


@dataclass(frozen=True)
class Merge:
    """A merge of a source into a target.  ``on`` names columns by the aliases ``t`` and ``s`` or those given.

    ``exact`` tells that ``on`` compares keys for equality and nothing else.  ``keys`` are the source's sides of the equalities.
    """

    source: DataFrame
    on: Column
    keys: list[Column]
    matched: list[Clause] = field(default_factory=list)
    not_matched: list[Clause] = field(default_factory=list)
    by_source: list[Clause] = field(default_factory=list)
    t: str = "t"
    s: str = "s"
    exact: bool = True

    def flags(self, target: DataFrame) -> DataFrame:
        """The target's columns after the merge and each row's action: inserted, updated, deleted or unmodified; source rows that no clause takes go.

        A key that is null matches nothing.  A target row that several source rows match makes the job fail, if it is to change.
        """
        mark_t, mark_s, many = (free_name(n, target, self.source) for n in ("_of_target", "_of_source", "_same_keys"))
        action, known = action_of(target), F.lit(True)
        for k in self.keys:
            known = known & k.isNotNull()
        source = self.source.alias(self.s)
        same = F.count(F.lit(1)).over(Window.partitionBy(*self.keys)) if self.matched else F.lit(1)
        whole = source.where(known).withColumn(many, same).withColumn(mark_s, F.lit(True)).alias(self.s)
        # Rows without a key match nothing; in the join they would meet in one task.
        loose = source.where(~known).withColumn(many, F.lit(1)).withColumn(mark_s, F.lit(True)).alias(self.s)
        marked = target.withColumn(mark_t, F.monotonically_increasing_id())
        both = marked.alias(self.t).join(whole, self.on, "full_outer")
        alone = marked.limit(0).alias(self.t).join(loose, F.lit(False), "right_outer")
        in_t, in_s = F.col(mark_t).isNotNull(), F.col(mark_s).isNotNull()
        cases = [(in_t & in_s & c.applies(), c) for c in self.matched] + [(~in_t & c.applies(), c) for c in self.not_matched] + [(~in_s & c.applies(), c) for c in self.by_source]
        if self.matched and not self.exact:
            repeated = both.where(in_t & in_s & (F.col(many) > 1)).groupBy(mark_t).count().where("count > 1")
            if not repeated.isEmpty():
                raise ValueError("a source key is repeated: several source rows match one target row")
        told = F.coalesce(*(F.when(when, F.lit(DONE[c.kind])) for when, c in cases), F.when(in_t, F.lit("unmodified")))
        if self.matched and self.exact:
            told = F.when(in_t & in_s & (F.col(many) > 1), F.raise_error(F.lit("a source key is repeated")).cast("string")).otherwise(told)
        out = []
        for f in target.schema:
            value = F.col(f"{self.t}.`{f.name}`")
            for when, c in reversed(cases):
                if c.kind == "insert":
                    value = F.when(when, c.values[f.name].cast(f.dataType) if f.name in c.values else F.lit(None).cast(f.dataType)).otherwise(value)
                elif f.name in c.values:
                    value = F.when(when, c.values[f.name].cast(f.dataType)).otherwise(value)
            out.append(value.alias(f.name))
        made = [rows.select(*out, told.alias(action)) for rows in (both, alone)]
        return made[0].unionByName(made[1]).where(F.col(f"`{action}`").isNotNull())

    def into(self, spark: SparkSession, table: str) -> MergeCounts:
        """Merge into a table; only files that hold a matching row are rewritten where they are few.

        The source is read more than once, so one that is not deterministic is stored first.
        """
        if not self.source._jdf.queryExecution().analyzed().deterministic():
            at = scratch(spark)
            self.source.write.parquet(at)
            return replace(self, source=spark.read.parquet(at)).into(spark, table)
        rows = spark.table(table)
        touched = None if self.by_source else rows.withColumn(free_name("file", rows, self.source), F.col("_metadata.file_path"))
        if touched is not None:
            file = touched.columns[-1]
            touched = touched.alias(self.t).join(self.source.alias(self.s), self.on, "left_semi").select(F.col(f"`{file}`").alias("file"))
        return _rewritten(spark, table, touched, self.flags)


def upsert(source: DataFrame, keys: list[str], columns: list[str], set_columns: list[str]) -> Merge:
    """The merge that updates ``set_columns`` of rows with the same keys and inserts the others."""
    on = F.lit(True)
    for k in keys:
        on = on & (F.col(f"t.`{k}`") == F.col(f"s.`{k}`"))
    new = {c: F.col(f"s.`{c}`") for c in columns}
    return Merge(source, on, [F.col(f"s.`{k}`") for k in keys], [Clause("update", {c: new[c] for c in set_columns})], [Clause("insert", new)])


def merge_flags(target: DataFrame, source: DataFrame, keys: list[str], set_columns: list[str]) -> DataFrame:
    """The target's columns after an upsert, and whether each row was inserted, updated or unmodified.

    A key that is null, in part or whole, matches nothing: each such source row is inserted as it is.  A source that
    repeats a key of the target makes the job fail, as it would be ambiguous.  The column of actions is called
    ``action_of(target)``.
    """
    return upsert(source, keys, target.columns, set_columns).flags(target)


def merge(target: DataFrame, source: DataFrame, keys: list[str], set_columns: list[str]) -> DataFrame:
    """The target's rows after the merge."""
    return merge_flags(target, source, keys, set_columns).drop(action_of(target))


ACTIONS = ("inserted", "updated", "unmodified", "deleted")


def _tallies(action: str) -> list[Column]:
    return [F.count_if(F.col(f"`{action}`") == a).alias(a) for a in ACTIONS]


def _counts(found: dict) -> MergeCounts:
    i, u, k, d = (found.get(a) or 0 for a in ACTIONS)
    return MergeCounts(before=u + k + d, written=i + u + k, inserted=i, updated=u, unmodified=k, deleted=d)


def merge_counts(target: DataFrame, source: DataFrame, keys: list[str], set_columns: list[str]) -> MergeCounts:
    return _counts(merge_flags(target, source, keys, set_columns).agg(*_tallies(action_of(target))).first().asDict())


def _rewritten(spark: SparkSession, table: str, touched: DataFrame | None, change: Callable[[DataFrame], DataFrame]) -> MergeCounts:
    action = action_of(spark.table(table))

    def tallied(rows: DataFrame) -> tuple[DataFrame, Callable[[], dict]]:
        seen = Observation()
        return rows.observe(seen, *_tallies(action)), lambda: seen.get

    return _counts(publish.rewrite(spark, table, touched, change, tallied, action))


def merge_table(spark: SparkSession, table: str, source: DataFrame, keys: list[str], set_columns: list[str]) -> MergeCounts:
    """Merge into a table."""
    return upsert(source, keys, spark.table(table).columns, set_columns).into(spark, table)


def change_table(spark: SparkSession, table: str, condition: Column | None, changes: dict[str, Column] | None, alias: str = "t") -> MergeCounts:
    """Update a table's rows where the condition is true, or delete them where there are no ``changes``; no condition is all rows."""
    rows = spark.table(table)
    action, file = action_of(rows), free_name("file", rows)
    hit = F.lit(True) if condition is None else F.coalesce(condition, F.lit(False))

    def change(df: DataFrame) -> DataFrame:
        flag = F.when(hit, "deleted" if changes is None else "updated").otherwise("unmodified").alias(action)
        kinds = {f.name: f.dataType for f in df.schema}
        df = df.alias(alias)
        return df.select(*(F.when(hit, changes[c].cast(kinds[c])).otherwise(F.col(f"`{c}`")).alias(c) if changes and c in changes else F.col(f"`{c}`") for c in df.columns), flag)

    touched = rows.withColumn(file, F.col("_metadata.file_path")).alias(alias).where(hit).select(F.col(f"`{file}`").alias("file"))
    return _rewritten(spark, table, touched, change)


def update_table(spark: SparkSession, table: str, condition: Column, changes: dict[str, Column]) -> MergeCounts:
    """Update a table's rows where the condition is true."""
    return change_table(spark, table, condition, changes)


def formula_counts(before: int, written: int, affected: int) -> MergeCounts:
    """Accounting from totals alone, where rows can't be flagged."""
    inserted, deleted = max(0, written - before), max(0, before - written)
    return MergeCounts(before, written, inserted, affected - inserted, written - affected, deleted)


def update(df: DataFrame, condition: Column, changes: dict[str, Column]) -> DataFrame:
    """Rows with ``changes`` applied where the condition is true."""
    return df.select(*(F.when(condition, changes[c]).otherwise(F.col(c)).alias(c) if c in changes else F.col(c) for c in df.columns))
