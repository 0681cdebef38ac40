"""Registered queries over ordered copies, SQL statements that change tables, and loads with malformed rows."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from tapelake.functions.layout import Field, Layout
from tapelake.operators import merge as merging
from tapelake.operators import quality, sqljob
from tapelake.plans.catalog import ORDERS, fresh, money, orders_rows, register, table
from tapelake.session import scratch
from tapelake.sources import generate, records, tables

#: Bytes of a range, so small that there are many more ranges than tasks.
SMALL = 16 << 10


def ordered_orders(spark, sf_dir) -> str:
    """Order records, in the order of their keys."""
    path = scratch(spark)
    records.write_records(orders_rows(spark, sf_dir).repartitionByRange(7, "o_orderkey").sortWithinPartitions("o_orderkey"), ORDERS, path)
    return path


@register("select count(*) as n, count(*) as in_order, count(*) filter (o_orderstatus = 'F') as final from orders")
def record_copy_order(spark, sf_dir):
    """A copy, composed to one file, has each record at its place: keys count up from the first on."""
    source, target, whole = ordered_orders(spark, sf_dir), scratch(spark), scratch(spark) + ".bin"
    records.copy_records(spark, source, target, ORDERS.lrecl, compress=False, range_bytes=SMALL)
    records.compose(spark, target, whole)
    least = table(spark, sf_dir, "orders").agg(F.min("o_orderkey")).first()[0]
    numbered = records.numbered_records(spark, whole, ORDERS.lrecl, range_bytes=SMALL)
    key, status = F.conv(F.hex(F.substring("rec", 1, 8)), 16, -10).cast("long"), F.decode(F.substring("rec", 17, 1), "IBM1047")
    return numbered.agg(F.count("*").alias("n"), F.count_if(key - F.lit(least) == F.col("number")).alias("in_order"), F.count_if(status == "F").alias("final"))


@register("select o_orderkey as k, o_custkey as customer, o_orderpriority as priority from orders order by o_orderkey limit 1000")
def record_prefix(spark, sf_dir):
    """The first records of a dataset, by content."""
    source, target = ordered_orders(spark, sf_dir), scratch(spark)
    records.copy_records(spark, source, target, ORDERS.lrecl, 1000, range_bytes=SMALL)
    good, _ = quality.split(records.read_layout(spark, target, ORDERS))
    return good.select(F.col("O_ORDERKEY").alias("k"), F.col("O_CUSTKEY").alias("customer"), F.col("O_ORDERPRIORITY").alias("priority"))


@register("select count(*) as n, true as refused, cast(sum(o_custkey) as bigint) as keys from orders")
def used_target(spark, sf_dir):
    """A target that holds records or rows is refused, and replaced where that is asked for."""
    path, target, refused = ordered_orders(spark, sf_dir), scratch(spark), 0
    rows = orders_rows(spark, sf_dir)
    records.ingest(spark, path, ORDERS, target)
    for again in (lambda: records.write_records(rows, ORDERS, path), lambda: records.ingest(spark, path, ORDERS, target)):
        try:
            again()
        except FileExistsError:
            refused += 1
    records.write_records(rows, ORDERS, path, mode="replace")
    records.ingest(spark, path, ORDERS, target, replace=True)
    return spark.read.orc(target).agg(F.count("*").alias("n"), F.lit(refused == 2).alias("refused"), F.sum("O_CUSTKEY").alias("keys"))


@register("select i + 1 as a, cast(i as double) / 100 as b, lpad(cast(i % 10 as varchar), 1, '0') as c from (select row_number() over () - 1 as i from orders)")
def generated_records(spark, sf_dir):
    """As many made-up records as there are orders, written and read: fields count up."""
    layout = Layout((Field("A", "INTEGER", 4), Field("B", "DECIMAL", 6, 9, 2), Field("C", "STRING", 8)))
    path, n = scratch(spark), table(spark, sf_dir, "orders").count()
    records.write_bytes(generate.gen_records(spark, layout, n), path, layout.lrecl)
    good, _ = quality.split(records.read_layout(spark, path, layout))
    return good.select(F.col("A").alias("a"), F.col("B").cast("double").alias("b"), F.substring(F.conv("C", 36, 10), -1, 1).alias("c"))


MERGED = """
with target as (select c_custkey as k, c_nationkey as nation, c_mktsegment as segment from customer where c_custkey % 3 <> 0),
source as (select o_custkey as k, count(*) as n, max(o_orderpriority) as p from orders group by 1),
flagged as (
  select coalesce(t.k, s.k) as k, coalesce(t.nation, s.n)::bigint as nation, case when s.k is not null then s.p else t.segment end as segment,
    case when t.k is null then 'inserted' when s.k is null then 'unmodified' when s.n % 5 = 0 then 'deleted' else 'updated' end as action
  from target t full join source s on t.k = s.k)
"""


def _merge(spark, sf_dir) -> tuple[str, sqljob.Result]:
    name, view = fresh(), fresh()
    table(spark, sf_dir, "customer").where("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("k"), F.col("c_nationkey").cast("long").alias("nation"), F.col("c_mktsegment").alias("segment")).write.saveAsTable(name)
    table(spark, sf_dir, "orders").createOrReplaceTempView(view)
    done = sqljob.run_statement(
        spark,
        f"MERGE INTO {name} D USING (select o_custkey as k, count(*) as n, max(o_orderpriority) as p from {view} group by 1) S ON D.k = S.k "
        "WHEN NOT MATCHED THEN INSERT (k, nation, segment) VALUES (S.k, S.n, S.p) WHEN MATCHED AND S.n % 5 = 0 THEN DELETE WHEN MATCHED THEN UPDATE SET D.segment = S.p",
    )
    return name, done


@register(MERGED + "select k, nation, segment from flagged where action <> 'deleted'")
def merge_statement(spark, sf_dir):
    """MERGE as SQL text: an aggregated source, rows inserted, updated and deleted."""
    return spark.table(_merge(spark, sf_dir)[0])


@register(MERGED + "select count(*) filter (action = 'inserted') as inserted, count(*) filter (action = 'updated') as updated, count(*) filter (action = 'deleted') as deleted, count(*) filter (action = 'unmodified') as unmodified, count(*) filter (action <> 'deleted') as n from flagged")
def merge_statement_counts(spark, sf_dir):
    """What a MERGE as SQL text says that it did."""
    name, done = _merge(spark, sf_dir)
    return spark.table(name).agg(*(F.lit(done.exported[a]).cast("long").alias(a) for a in ("inserted", "updated", "deleted", "unmodified")), F.count("*").alias("n"))


@register("select s_suppkey as k, case when s_acctbal < 0 then 0.0 else cast(cast(round(s_acctbal, 2) as decimal(13,2)) as double) end as balance, (select count(*) from supplier where s_acctbal < 0) as updated, (select count(*) from supplier where s_suppkey % 10 = 3) as deleted from supplier where s_suppkey % 10 <> 3")
def update_delete_statements(spark, sf_dir):
    """UPDATE and DELETE as SQL text, with parameters."""
    name = fresh()
    table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), money("s_acctbal").alias("balance")).write.saveAsTable(name)
    updated = sqljob.run_statement(spark, f"update {name} set balance = :to where balance < :least", ["to:NUMERIC:0", "least:INT64:0"]).activity_count
    deleted = sqljob.run_statement(spark, f"delete from {name} as x where x.k % 10 = 3").activity_count
    return spark.table(name).select("k", F.col("balance").cast("double").alias("balance"), F.lit(updated).cast("long").alias("updated"), F.lit(deleted).cast("long").alias("deleted"))


@register("select p_brand as brand, count(*) as n, (select count(distinct p_brand) from part) as written from part group by 1")
def replace_table_statement(spark, sf_dir):
    """CREATE OR REPLACE TABLE AS, over a table of other columns."""
    name, view = fresh(), fresh()
    table(spark, sf_dir, "part").createOrReplaceTempView(view)
    sqljob.run_statement(spark, f"create or replace table {name} as select p_partkey as k from {view}")
    written = sqljob.run_statement(spark, f"create or replace table {name} as select p_brand as brand, count(*) as n from {view} group by 1").activity_count
    return spark.table(name).withColumn("written", F.lit(written).cast("long"))


@register("select count(*) filter (o_orderkey % 2 = 0) as made, count(*) filter (o_orderkey % 2 = 1) as inserted, count(*) filter (o_orderkey % 10 = 0) as merged, count(*) filter (o_orderkey % 10 <> 0) as n from orders")
def script_counts(spark, sf_dir):
    """A script's statements in order, each with its own count."""
    name, view = fresh(), fresh()
    table(spark, sf_dir, "orders").createOrReplaceTempView(view)
    done, rows = sqljob.run_statements(
        spark,
        f"create or replace table {name} as select o_orderkey as k, ';' as v from {view} where o_orderkey % 2 = 0; insert into {name} select o_orderkey, 'odd' from {view} where o_orderkey % 2 = 1; -- one more;\n"
        f"merge into {name} t using (select o_orderkey as k from {view} where o_orderkey % 10 = 0) s on t.k = s.k when matched then delete; select count(*) as n from {name}",
    )
    made, inserted, merged, _ = (r.activity_count for r in done)
    return rows.select(F.lit(made).cast("long").alias("made"), F.lit(inserted).cast("long").alias("inserted"), F.lit(merged).cast("long").alias("merged"), "n")


@register("select count(*) as n, count(*) filter (o_orderkey < (select count(*) / 50 from orders)) as updated, true as kept from orders")
def merge_few_files(spark, sf_dir):
    """A merge into a clustered table keeps the files that hold none of its keys."""
    name, n = fresh(), table(spark, sf_dir, "orders").count()
    rows = orders_rows(spark, sf_dir)
    rows.repartitionByRange(20, "o_orderkey").write.saveAsTable(name)
    before = set(spark.table(name).inputFiles())
    source = rows.where(F.col("o_orderkey") < n / 50).withColumn("o_orderstatus", F.lit("M"))
    merging.merge_table(spark, name, source, ["o_orderkey"], ["o_orderstatus"])
    kept = len(before & set(spark.table(name).inputFiles())) >= 0.8 * len(before)
    return spark.table(name).agg(F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "M").alias("updated"), F.lit(kept).alias("kept"))


@register("select event_type, count(*) as n, (select count(*) from events where event_id % 9 = 0) as bad from events where event_id % 9 <> 0 group by 1")
def json_bad_records(spark, sf_dir):
    """Lines that are no JSON are counted and left out, types inferred, files parsed once."""
    path, name = scratch(spark), fresh()
    whole = F.to_json(F.struct("event_id", "event_type"))
    table(spark, sf_dir, "events").select(F.when(F.col("event_id") % 9 == 0, F.concat(F.lit("x"), whole)).otherwise(whole).alias("value")).write.text(path)
    _, bad = tables.load_files(spark, path, name, "NEWLINE_DELIMITED_JSON", most_bad=1 << 40)
    return spark.table(name).groupBy("event_type").agg(F.count("*").alias("n")).withColumn("bad", F.lit(bad).cast("long"))


@register("select cast(sum(c_custkey) as bigint) as keys, count(*) as n, (select count(*) from customer where c_custkey % 11 = 5) as bad from customer where c_custkey % 11 <> 5")
def csv_inferred_bad(spark, sf_dir):
    """Rows with a column too many among rows whose types are inferred."""
    path, name = scratch(spark), fresh()
    more = F.when(F.col("c_custkey") % 11 == 5, F.lit(",more")).otherwise(F.lit(""))
    table(spark, sf_dir, "customer").select(F.concat(F.concat_ws(",", F.col("c_custkey").cast("string"), "c_mktsegment"), more).alias("value")).write.text(path)
    _, bad = tables.load_files(spark, path, name, "CSV", most_bad=1 << 40)
    key = F.col(spark.table(name).columns[0])
    return spark.table(name).agg(F.sum(key).cast("long").alias("keys"), F.count("*").alias("n"), F.lit(bad).cast("long").alias("bad"))


@register("with m as (select cast(date_trunc('month', o_orderdate) as date) as day from orders), l as (select max(day) - 100 as least from m) select count(*) filter (day >= least) as n, true as refused, count(distinct day) filter (day < least) as expired from m, l")
def partition_filter_and_expiry(spark, sf_dir):
    """A table by the first days of months that must be filtered by them, and whose old partitions go."""
    name, rows = fresh(), orders_rows(spark, sf_dir)
    rows = rows.withColumn("birthday", F.col("o_orderdate").cast("string")).withColumn("day", F.trunc("o_orderdate", "MM"))
    tables.load(rows.repartition("day"), name, partition="day", require_filter=True)
    last, refused = rows.agg(F.max("day")).first()[0], False
    try:
        tables.check_partition_filter(spark.table(name).where("birthday > '1990'"), "day")
    except ValueError:
        refused = True
    expired = tables.expire_partitions(spark, name, "day", 100 * 86_400, last)
    kept = spark.table(name).where(F.col("day") >= F.lit(last - datetime.timedelta(days=100)))
    tables.check_partition_filter(kept, "day")
    return kept.agg(F.count("*").alias("n"), F.lit(refused).alias("refused"), F.lit(len(expired)).cast("long").alias("expired"))


@register("select event_id as k, strftime(ts, '%H:%M:%S') as t, strftime(ts, '%Y-%m-%d %H:%M:%S') as d, cast(extract(hour from ts) * 3600 + extract(minute from ts) * 60 as bigint) as s from events")
def casts_time(spark, sf_dir):
    """CAST to time and to datetime, of timestamps and texts."""
    view = fresh()
    table(spark, sf_dir, "events").createOrReplaceTempView(view)
    return sqljob.run_query(
        spark,
        "select event_id as k, date_format(cast(date_format(ts, 'yyyy-MM-dd HH:mm:ss') as timestamp_ntz), 'HH:mm:ss') as t, date_format(cast(ts as timestamp_ntz), 'yyyy-MM-dd HH:mm:ss') as d, "
        f"cast(hour(cast(date_format(ts, 'HH:mm:ss') as time)) * 3600 + minute(cast(date_format(ts, 'HH:mm:ss') as time)) * 60 as bigint) as s from {view}",
    )
