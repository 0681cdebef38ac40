"""Registered queries over loads, tables and SQL jobs."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import functions as F

from tapelake.operators import merge as merging
from tapelake.operators import quality, sqljob
from tapelake.plans.catalog import fresh, money, orders_rows, register, table
from tapelake.session import scratch
from tapelake.sources import tables


@register("select p_brand, count(*) as n from part group by 1")
def load_parquet(spark, sf_dir):
    path = scratch(spark)
    table(spark, sf_dir, "part").write.parquet(path)
    return tables.read_any(spark, path, "PARQUET").groupBy("p_brand").agg(F.count("*").alias("n"))


@register("select p_brand, count(*) as n, cast(max(p_partkey) as bigint) as last from part group by 1")
def external_orc(spark, sf_dir):
    """A table over ORC files that lie elsewhere."""
    path, name = scratch(spark), fresh()
    rows = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    rows.write.orc(path)
    tables.external_orc(spark, name, path, rows.schema)
    return spark.table(name).groupBy("p_brand").agg(F.count("*").alias("n"), F.max("p_partkey").cast("long").alias("last"))


def with_two_headers(lines):
    """Text files that begin with two lines of their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array(["first header,with a comma", "second header"])], names=["value"])
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0)], names=["value"])

    path = scratch(lines.sparkSession)
    lines.mapInArrow(run, "value string").write.text(path)
    return path


@register("select count(*) as n, cast(sum(c_custkey) as bigint) as keys, count(*) filter (c_custkey % 3 = 0) as broken from customer")
def csv_skip_lines(spark, sf_dir):
    """Two lines to skip in files whose quoted names hold line breaks and separators."""
    name = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit('"'), "c_name", F.lit('\n,next"'))).otherwise(F.col("c_name"))
    path = with_two_headers(table(spark, sf_dir, "customer").select(F.concat_ws(",", F.col("c_custkey").cast("string"), name).alias("value")))
    rows = tables.read_csv(spark, path, schema=tables.schema_of("k:INT64,name:STRING"), skip=2, multiline=True)
    return rows.agg(F.count("*").alias("n"), F.sum("k").alias("keys"), F.count_if(F.contains("name", F.lit("\n,next"))).alias("broken"))


@register("select count(*) as n, cast(sum(c_custkey) as bigint) as keys from customer")
def csv_skip_plain(spark, sf_dir):
    """Two lines to skip in files that are split between tasks."""
    path = with_two_headers(table(spark, sf_dir, "customer").select(F.concat_ws(",", F.col("c_custkey").cast("string"), "c_name").alias("value")))
    return tables.read_csv(spark, path, schema=tables.schema_of("k:INT64,name:STRING"), skip=2).agg(F.count("*").alias("n"), F.sum("k").alias("keys"))


@register("select count(*) filter (o_orderkey % 50 <> 0) as good, count(*) filter (o_orderkey % 50 = 0) as bad from orders")
def bad_records(spark, sf_dir):
    """Malformed rows up to a limit are left out; separators within quotes don't make a row malformed."""
    key = F.when(F.col("o_orderkey") % 50 == 0, F.lit("x")).otherwise(F.col("o_orderkey").cast("string"))
    path, rows = scratch(spark), table(spark, sf_dir, "orders")
    rows.select(F.concat_ws(",", key, F.concat(F.lit('"'), "o_orderpriority", F.lit(',a"'))).alias("value")).write.text(path)
    total = rows.count()
    good = tables.read_csv(spark, path, schema=tables.schema_of("k:INT64,v:STRING"), most_bad=total)
    return good.agg(F.count("*").alias("good"), (F.lit(total) - F.count("*")).alias("bad"))


@register("select count(*) as n, cast(sum(o_custkey) as bigint) as keys, 1 as refused from orders")
def dispositions(spark, sf_dir):
    """EMPTY, APPEND and TRUNCATE, and what EMPTY refuses."""
    rows, name, refused = orders_rows(spark, sf_dir), fresh(), 0
    tables.load(rows.limit(5), name, "EMPTY")
    try:
        tables.load(rows, name, "EMPTY")
    except ValueError:
        refused = 1
    first = tables.load(rows.where("o_orderkey % 2 = 0"), name, "TRUNCATE")
    more = tables.load(rows.where("o_orderkey % 2 <> 0"), name, "APPEND")
    quality.reconcile(first + more, spark.table(name).count())
    return spark.table(name).agg(F.count("*").alias("n"), F.sum("o_custkey").alias("keys"), F.lit(refused).alias("refused"))


@register("select cast(o_orderdate as date)::varchar as day, count(*) as n from orders group by 1")
def day_partition_load(spark, sf_dir):
    """A table loaded by day, read by its partitions."""
    name = fresh()
    tables.load(orders_rows(spark, sf_dir).repartition("o_orderdate"), name, partition="o_orderdate")
    return spark.table(name).groupBy(F.col("o_orderdate").cast("string").alias("day")).agg(F.count("*").alias("n"))


@register("select count(*) as n, cast(sum(o_orderkey) as bigint) as keys from orders where o_custkey between 10 and 60")
def clustered_table(spark, sf_dir):
    """Rows that lie together by a column, so that a scan can skip files."""
    name = fresh()
    tables.load(orders_rows(spark, sf_dir), name, cluster=["o_custkey"])
    return spark.table(name).where("o_custkey between 10 and 60").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"))


@register("select c_mktsegment as segment, count(*) as n from customer where c_nationkey < 10 group by 1")
def typed_table_and_view(spark, sf_dir):
    """An empty typed table, filled, and a view of it."""
    name, view = fresh(), fresh()
    tables.create(spark, name, "k:INT64,nation:INT64,segment:STRING")
    tables.load(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_nationkey").cast("long").alias("nation"), F.col("c_mktsegment").alias("segment")), name, "APPEND")
    tables.create_view(spark, view, f"select segment, count(*) as n from {name} where nation < 10 group by segment")
    return spark.table(view)


@register("select count(*) as n, count(*) filter (c_custkey % 2 = 0) as missing from customer")
def relaxed_column(spark, sf_dir):
    """A required column that an append makes nullable."""
    name = fresh()
    spark.sql(f"create table {name} (k bigint not null, segment string not null) using parquet")
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("long").alias("k"), F.when(F.col("c_custkey") % 2 == 1, F.col("c_mktsegment")).alias("segment"))
    tables.load(rows, name, "APPEND", relaxation=True)
    return spark.table(name).agg(F.count("*").alias("n"), F.count_if(F.col("segment").isNull()).alias("missing"))


@register("select o_orderpriority as priority, count(*) as n from orders group by 1")
def query_to_table(spark, sf_dir):
    name, view = fresh(), fresh()
    table(spark, sf_dir, "orders").createOrReplaceTempView(view)
    done = sqljob.query_to_table(spark, f"select o_orderpriority as priority, count(*) as n from {view} group by 1", name)
    quality.reconcile(done.activity_count, spark.table(name).count())
    return spark.table(name)


@register("select count(*) as n, true as analysed, true as refused from orders where o_custkey > 5")
def dry_run(spark, sf_dir):
    """A dry run analyses a query and runs nothing; a wrong one fails."""
    view = fresh()
    table(spark, sf_dir, "orders").createOrReplaceTempView(view)
    query, refused = f"select count(*) as n from {view} where o_custkey > :k", False
    analysed = sqljob.run_query(spark, query, ["k:INT64:5"], dry_run=True) is None
    try:
        sqljob.run_query(spark, f"select no_such_column from {view}", dry_run=True)
    except Exception:
        refused = True
    return sqljob.run_query(spark, query, ["k:INT64:5"]).withColumns({"analysed": F.lit(analysed), "refused": F.lit(refused)})


@register(
    "select count(*) filter (s % 2 = 0) as made, count(*) filter (s % 2 = 1) as inserted, count(*) filter (b < 0) as updated, count(*) as n, cast(sum(case when b < 0 then 0 else b end) as double) as total "
    "from (select s_suppkey as s, cast(round(s_acctbal, 2) as decimal(13,2)) as b from supplier)"
)
def statements(spark, sf_dir):
    """CREATE TABLE AS, INSERT and UPDATE, each with the rows that it touched."""
    name, view = fresh(), fresh()
    table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("s"), money("s_acctbal").alias("b")).createOrReplaceTempView(view)
    made = sqljob.run_statement(spark, f"create table {name} using parquet as select * from {view} where s % 2 = 0").activity_count
    inserted = sqljob.run_statement(spark, f"insert into {name} select * from {view} where s % 2 = 1").activity_count
    updated = merging.update_table(spark, name, F.col("b") < 0, {"b": F.lit(0).cast("decimal(13,2)")}).updated
    return spark.table(name).agg(F.lit(made).cast("long").alias("made"), F.lit(inserted).cast("long").alias("inserted"), F.lit(updated).cast("long").alias("updated"), F.count("*").alias("n"), F.sum("b").cast("double").alias("total"))


@register("select coalesce(c_custkey, -1) as k, segment, count(*) as n from (select case when c_custkey % 4 <> 0 then c_custkey end as c_custkey, case when c_custkey % 2 = 0 then 'new' else c_mktsegment end as segment from customer) group by 1, 2")
def merge_null_keys(spark, sf_dir):
    """Source rows without a key match nothing and are inserted each."""
    key = F.when(F.col("c_custkey") % 4 != 0, F.col("c_custkey")).alias("k")
    rows = table(spark, sf_dir, "customer").select("c_custkey", key, F.col("c_mktsegment").alias("segment"))
    target = rows.where("c_custkey % 4 <> 0").select("k", "segment")
    source = rows.where("c_custkey % 2 = 0").select("k", F.lit("new").alias("segment"))
    return merging.merge(target, source, ["k"], ["segment"]).groupBy(F.coalesce("k", F.lit(-1)).alias("k"), "segment").agg(F.count("*").alias("n"))


@register(
    "select o_orderkey as k, cast(cast(o_orderdate as date) as varchar) as day, cast(cast(o_orderkey as decimal(20,2)) as varchar) as num, cast(o_custkey as varchar) as text, "
    "cast(extract(hour from timestamp '2020-01-02 03:04:05') as bigint) as h, cast(epoch_us(cast(strftime(o_orderdate, '%Y-%m-%d') || ' 01:02:03' as timestamp)) as bigint) as at from orders"
)
def casts(spark, sf_dir):
    """CAST to date, numeric, text and timestamp, of columns and literals."""
    view = fresh()
    table(spark, sf_dir, "orders").createOrReplaceTempView(view)
    return sqljob.run_query(
        spark,
        f"select o_orderkey as k, cast(cast(o_orderdate as date) as string) as day, cast(cast(o_orderkey as decimal(20,2)) as string) as num, cast(o_custkey as string) as text, "
        f"cast(extract(hour from timestamp '2020-01-02 03:04:05') as bigint) as h, unix_micros(cast(concat(date_format(o_orderdate, 'yyyy-MM-dd'), ' 01:02:03') as timestamp)) as at from {view}",
    )


@register("select extract(year from o_orderdate) as y, extract(month from o_orderdate) as m, count(*) as n, count(*) filter (cast(o_orderdate as date) < current_date) as past from orders group by 1, 2")
def date_functions(spark, sf_dir):
    view = fresh()
    table(spark, sf_dir, "orders").createOrReplaceTempView(view)
    return sqljob.run_query(spark, f"select cast(extract(year from o_orderdate) as bigint) as y, cast(extract(month from o_orderdate) as bigint) as m, count(*) as n, count_if(cast(o_orderdate as date) < current_date()) as past from {view} group by 1, 2")


@register("select o_orderpriority as job_name, count(*) as records_in, cast(0 as bigint) as errors, true as dated from orders group by 1")
def job_log(spark, sf_dir):
    """One row of the log for each priority's run."""
    path = scratch(spark)
    for r in table(spark, sf_dir, "orders").groupBy("o_orderpriority").count().collect():
        quality.append_log(spark, path, {"job_name": r["o_orderpriority"], "records_in": r["count"], "errors": 0, "message": ""})
    return spark.read.parquet(path).where("message is null").select("job_name", "records_in", "errors", F.col("job_date").isNotNull().alias("dated"))


@register("select o_orderkey || '|' || o_orderstatus || '|' || o_orderpriority as line from orders")
def vartext_export_orders(spark, sf_dir):
    """Delimited records written as files and read back as lines."""
    from tapelake.sources import records

    path = scratch(spark)
    records.write_vartext(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority"), path, 60)
    return records.read_lines(spark, path, 60)


@register("select c_custkey as k, c_name as name, null::varchar as note from customer union all select s_suppkey, s_name, 'supplier' from supplier")
def append_evolve_table(spark, sf_dir):
    """An append to a table that adds a column to it."""
    name = fresh()
    tables.load(table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("long").alias("k"), F.col("c_name").alias("name")), name)
    more = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("long").alias("k"), F.col("s_name").alias("name"), F.lit("supplier").alias("note"))
    tables.load(more, name, "APPEND", addition=True)
    return spark.table(name)


@register("select o_orderkey as k, case when o_orderstatus = 'F' then 'final' else 'other' end as kind, substring(o_orderpriority, 1, 3) as short, cast(o_custkey as double) as key from orders where o_orderpriority is not null")
def scalar_functions_orders(spark, sf_dir):
    """CASE, SUBSTRING from 0, CAST and WHERE over orders."""
    view = fresh()
    table(spark, sf_dir, "orders").createOrReplaceTempView(view)
    return sqljob.run_query(spark, f"select o_orderkey as k, case when o_orderstatus = 'F' then 'final' else 'other' end as kind, substring(o_orderpriority, 0, 3) as short, cast(o_custkey as double) as key from {view} where o_orderpriority is not null")


