"""SQL jobs: queries, scripts, parameters, dry runs and activity counts.

Spark's own parser reads every statement.  What Spark's file tables can't do themselves (MERGE, UPDATE, DELETE, CREATE OR
REPLACE TABLE) is taken from the parsed statement and done by the rewriting joins of ``merge``.
"""

from __future__ import annotations

import datetime
import decimal
import re
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapelake.operators import publish
from tapelake.operators.merge import Clause, Merge, MergeCounts, change_table
from tapelake.operators.quality import Result
from tapelake.sources.tables import load


def moment(text: str) -> datetime.datetime:
    """A timestamp, with an offset or the name of a zone behind it or none."""
    hit = re.fullmatch(r"(.*\d)\s*([A-Za-z][\w/+-]*)", text.strip())
    if not hit or hit[2] == "T":
        return datetime.datetime.fromisoformat(text.strip())
    return datetime.datetime.fromisoformat(hit[1]).replace(tzinfo=datetime.timezone.utc if hit[2].upper() in ("Z", "UTC") else ZoneInfo(hit[2]))


_CASTS = {
    "STRING": str, "INT64": int, "INTEGER": int, "NUMERIC": decimal.Decimal, "FLOAT64": float, "BOOL": lambda v: v.lower() == "true",
    "DATE": datetime.date.fromisoformat, "TIMESTAMP": moment, "DATETIME": datetime.datetime.fromisoformat, "BYTES": str.encode,
}


def parameters(given: list[str]) -> dict | list:
    """NAME:TYPE:VALUE as arguments of a query; no name is positional, no type a string, and NULL null.  Kinds don't mix."""
    named, placed = {}, []
    for text in given:
        name, kind, value = text.split(":", 2)
        read = None if value == "NULL" else _CASTS[(kind or "STRING").upper()](value)
        if name:
            named[name] = read
        else:
            placed.append(read)
    if named and placed:
        raise ValueError("named and positional parameters don't mix")
    return named or placed


def run_query(spark: SparkSession, sql: str, given: list[str] | None = None, *, dry_run: bool = False) -> DataFrame | None:
    """A query's rows.  A dry run only analyses it."""
    if not sql or not sql.strip():
        raise ValueError("the query is empty")
    args = parameters(given or [])
    out = spark.sql(sql, args=args) if args else spark.sql(sql)
    if dry_run:
        out.schema
        return None
    return out


def _seq(x) -> list:
    return [x.apply(i) for i in range(x.size())]


def _kind(plan) -> str:
    return plan.getClass().getSimpleName()


#: What a statement is made of: comments, quoted texts and names, words, and any other character.
_PIECE = re.compile(r"--[^\n]*|/\*.*?\*/|'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.)*\"|`(?:[^`]|``)*`|\w+|\s+|.", re.S)


def ordered_merges(text: str) -> str:
    """The statements with the clauses of each MERGE in the order that Spark's parser wants: matched, not matched, not matched by source.

    Warehouses take them in any order, and clauses of different kinds never apply to the same row.
    """
    pieces = _PIECE.findall(text)
    words = [(i, p.lower()) for i, p in enumerate(pieces) if not p.isspace() and not p.startswith(("--", "/*"))]
    out, depth, start, cuts, in_merge, cases = [], 0, 0, [], False, 0

    def flush(end: int) -> None:
        edges = [*(i for i, _ in cuts), end]
        parts = sorted(((rank, "".join(pieces[a:b])) for (a, rank), b in zip(cuts, edges[1:])), key=lambda x: x[0])
        out.append("".join(pieces[start : edges[0]]) + " ".join(p.strip() for _, p in parts) + (" " if parts and end < len(pieces) else ""))

    for n, (i, word) in enumerate(words):
        following = [w for _, w in words[n + 1 : n + 5]]
        depth += {"(": 1, ")": -1}.get(word, 0)
        cases += 1 if word == "case" else -1 if word == "end" and cases else 0
        in_merge = word == "merge" if n == 0 or words[n - 1][1] == ";" else in_merge
        if word == ";" and depth == 0:
            flush(i)
            start, cuts, in_merge, cases = i, [], False, 0
        elif in_merge and word == "when" and depth == 0 and not cases and (following[:1] == ["matched"] or following[:2] == ["not", "matched"]):
            cuts.append((i, 0 if following[0] == "matched" else 2 if following[2:4] == ["by", "source"] else 1))
    flush(len(pieces))
    return "".join(out)


def run_statements(spark: SparkSession, script: str) -> tuple[list[Result], DataFrame | None]:
    """Run a script's statements in order; each one's outcome, and the rows of the last.  The first error ends the script.

    Statements within control flow are run by Spark's interpreter of scripts, which counts nothing: no outcomes then.
    """
    body = script.strip()
    if not body:
        raise ValueError("the script is empty")
    if not body.endswith(";"):
        body += "\n;"
    whole = f"BEGIN\n{ordered_merges(body)}\nEND"
    parts = _seq(spark._jsparkSession.sessionState().sqlParser().parsePlan(whole).collection())
    if any(_kind(p) != "SingleStatement" or _kind(p.parsedPlan()) in ("CreateVariable", "SetVariable") for p in parts):
        return [], spark.sql(whole)
    results, rows = [], None
    for p in parts:
        done, rows = _run(spark, p.getText())
        results.append(done)
    return results, rows


def run_script(spark: SparkSession, script: str) -> DataFrame:
    """Run statements in order and return the last one's rows; the first error ends the script."""
    return run_statements(spark, script)[1]


def query_to_table(spark: SparkSession, sql: str, table: str, disposition: str = "TRUNCATE", given: list[str] | None = None, **options) -> Result:
    """Write a query's rows to a table; the activity count is the rows written."""
    rows = load(run_query(spark, sql, given), table, disposition, **options)
    return Result(activity_count=rows, message=f"{rows} rows written to {table}")


def run_statement(spark: SparkSession, sql: str, given: list[str] | None = None) -> Result:
    """Run a MERGE, UPDATE, DELETE, INSERT, CREATE [OR REPLACE] TABLE [… AS] or another command.

    The activity count is the rows that it wrote or changed; a merge's counts are in ``exported``.
    """
    return _run(spark, sql, given)[0]


def _run(spark: SparkSession, sql: str, given: list[str] | None = None) -> tuple[Result, DataFrame]:
    args = parameters(given or [])
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(ordered_merges(sql))
    own = {"MergeIntoTable": _merge, "UpdateTable": _update, "DeleteFromTable": _delete, "ReplaceTableAsSelect": _replace_as, "ReplaceTable": _replace}.get(_kind(plan))
    if own:
        done = own(spark, _bound(spark, plan, args))
        return done, spark.createDataFrame([(done.activity_count,)], "num_affected_rows long")
    out = spark.sql(sql, args=args) if args else spark.sql(sql)
    rows = _rows_written(spark, out._jdf.queryExecution().executedPlan())
    return Result(activity_count=rows, message=f"{rows} rows written"), out


def _literal(value) -> str:
    """A value as SQL."""
    if value is None or isinstance(value, bool):
        return "null" if value is None else str(value).lower()
    if isinstance(value, datetime.datetime):
        return f"{'timestamp' if value.tzinfo else 'timestamp_ntz'}'{value.isoformat(sep=' ')}'"
    if isinstance(value, datetime.date):
        return f"date'{value}'"
    if isinstance(value, decimal.Decimal):
        return f"{value:f}bd"
    if isinstance(value, bytes):
        return f"X'{value.hex()}'"
    return f"{value!r}d" if isinstance(value, float) else str(value) if isinstance(value, int) else publish.quoted(value)


def _bound(spark: SparkSession, plan, args: dict | list):
    """A parsed statement with its parameters in place."""
    if not args:
        return plan
    analysis = spark._jvm.org.apache.spark.sql.catalyst.analysis
    parse = spark._jsparkSession.sessionState().sqlParser().parseExpression
    values = _to_seq(spark, [parse(_literal(v)) for v in (args.values() if isinstance(args, dict) else args)])
    query = analysis.NameParameterizedQuery(plan, _to_seq(spark, list(args)), values) if isinstance(args, dict) else analysis.PosParameterizedQuery(plan, values)
    return analysis.BindParameters.apply(query)


def _to_seq(spark: SparkSession, values: list):
    out = spark._jvm.java.util.ArrayList()
    for v in values:
        out.add(v)
    return spark._jvm.PythonUtils.toSeq(out)


def _frame(spark: SparkSession, plan) -> DataFrame:
    return DataFrame(spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, plan), spark)


def _expr(expression) -> Column:
    return F.expr(expression.sql())


def _option(value) -> Column | None:
    return _expr(value.get()) if value.isDefined() else None


def _target(plan) -> tuple[str, str]:
    """(table, alias) of a statement's table."""
    alias = None
    if _kind(plan) == "SubqueryAlias":
        alias, plan = plan.alias(), plan.child()
    parts = _seq(plan.multipartIdentifier())
    return ".".join(f"`{p}`" for p in parts), alias or parts[-1]


def _column(name: str, columns: list[str]) -> str:
    hit = [c for c in columns if c.lower() == name.lower()]
    if not hit:
        raise ValueError(f"no such column: {name}")
    return hit[0]


def _assigned(assignments, columns: list[str]) -> dict[str, Column]:
    return {_column(_seq(a.key().nameParts())[-1], columns): _expr(a.value()) for a in _seq(assignments)}


def _clauses(actions, columns: list[str], star: dict[str, Column]) -> list[Clause]:
    out = []
    for a in _seq(actions):
        kind = _kind(a)
        values = {} if kind == "DeleteAction" else star if kind in ("UpdateStarAction", "InsertStarAction") else _assigned(a.assignments(), columns)
        out.append(Clause(kind[:6].lower(), values, _option(a.condition())))
    return out


def _conjuncts(expression) -> list:
    return _conjuncts(expression.left()) + _conjuncts(expression.right()) if _kind(expression) == "And" else [expression]


def _fits(df: DataFrame, expression) -> bool:
    """Whether an expression is one over these rows alone."""
    try:
        df.select(_expr(expression))
    except Exception as error:
        if "UNRESOLVED" in str(error) or "cannot be resolved" in str(error):
            return False
        raise
    return True


def merge_of(spark: SparkSession, plan) -> tuple[str, Merge]:
    """The table and the merge of a parsed MERGE statement."""
    table, t = _target(plan.targetTable())
    source, side = _frame(spark, plan.sourceTable()), plan.sourceTable()
    s = side.alias() if _kind(side) == "SubqueryAlias" else _seq(side.multipartIdentifier())[-1]
    target, given = spark.table(table).alias(t), source.alias(s)
    keys, exact = [], True
    for c in _conjuncts(plan.mergeCondition()):
        sides = [c.left(), c.right()] if _kind(c) == "EqualTo" else []
        ours = [x for x in sides if _fits(given, x) and not _fits(target, x)]
        if len(ours) == 1 and all(_fits(target, x) for x in sides if x is not ours[0]):
            keys.append(_expr(ours[0]))
        else:
            exact = False
    if not keys:
        raise ValueError("a merge needs an equality between the target and its source")
    columns = spark.table(table).columns
    star = {_column(c, columns): F.col(f"{s}.`{c}`") for c in source.columns if c.lower() in {x.lower() for x in columns}}
    actions = [_clauses(x, columns, star) for x in (plan.matchedActions(), plan.notMatchedActions(), plan.notMatchedBySourceActions())]
    return table, Merge(source, _expr(plan.mergeCondition()), keys, *actions, t=t, s=s, exact=exact)


def _outcome(counts: MergeCounts) -> Result:
    said = {"before": counts.before, "inserted": counts.inserted, "updated": counts.updated, "deleted": counts.deleted, "unmodified": counts.unmodified}
    return Result(activity_count=counts.affected, message=f"{counts.inserted} rows inserted, {counts.updated} updated, {counts.deleted} deleted", exported=said)


def _merge(spark: SparkSession, plan) -> Result:
    table, merge = merge_of(spark, plan)
    return _outcome(merge.into(spark, table))


def _update(spark: SparkSession, plan) -> Result:
    table, alias = _target(plan.table())
    return _outcome(change_table(spark, table, _option(plan.condition()), _assigned(plan.assignments(), spark.table(table).columns), alias))


def _delete(spark: SparkSession, plan) -> Result:
    table, alias = _target(plan.table())
    return _outcome(change_table(spark, table, _expr(plan.condition()), None, alias))


def _named(plan) -> str:
    return ".".join(f"`{p}`" for p in _seq(plan.nameParts()))


def _provider(spec) -> str:
    if spec.location().isDefined():
        raise ValueError("a table that is replaced can't be given a location")
    return spec.provider().get() if spec.provider().isDefined() else "parquet"


def _replace_as(spark: SparkSession, plan) -> Result:
    rows = publish.replace_table(spark, _named(plan.name()), _frame(spark, plan.query()), _provider(plan.tableSpec()), [p.describe() for p in _seq(plan.partitioning())])
    return Result(activity_count=rows, message=f"{rows} rows written")


def _replace(spark: SparkSession, plan) -> Result:
    fields = [T.StructField(c.name(), T._parse_datatype_json_string(c.dataType().json()), c.nullable()) for c in _seq(plan.columns())]
    publish.replace_table(spark, _named(plan.name()), spark.createDataFrame([], T.StructType(fields)), _provider(plan.tableSpec()), [p.describe() for p in _seq(plan.partitioning())])
    return Result(message="table made")


def _rows_written(spark: SparkSession, plan) -> int:
    """The writer's own count of its rows, from the plan that has run; 0 if it wrote none.

    The command that makes a table from a query keeps no count; all rows of the new table are its rows.
    """
    kind = _kind(plan)
    if kind == "CommandResultExec":
        return _rows_written(spark, plan.commandPhysicalPlan())
    if kind == "ExecutedCommandExec":
        made = _kind(plan.cmd()) == "CreateDataSourceTableAsSelectCommand"
        return spark.table(plan.cmd().table().identifier().quotedString()).count() if made else 0
    return int(plan.metrics().apply("numOutputRows").value()) if kind == "DataWritingCommandExec" else 0
