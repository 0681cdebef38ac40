"""Registered queries over the star-schema tables, each with its SQL twin.

A round trip encodes a table's columns to record bytes and decodes them again, so its twin is a plain query.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapelake.functions import codec
from tapelake.functions.layout import Field, Layout
from tapelake.operators import merge as merging
from tapelake.operators import quality, sqljob
from tapelake.session import configure, scratch
from tapelake.sources import records, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def register(sql: str) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return query(configure(spark), sf_dir)

        run.__name__, run.__doc__ = query.__name__, query.__doc__
        QUERIES[query.__name__] = run
        ORACLE_SQL[query.__name__] = sql
        return run

    return add


def fresh() -> str:
    """A name that no table or view has."""
    return f"lake_{uuid.uuid4().hex}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money(column: str, digits: int = 13) -> F.Column:
    return F.round(F.col(column), 2).cast(f"decimal({digits},2)")


ORDERS = Layout.from_copybook(
    """
    01 ORDER-REC.
       05 O-ORDERKEY      PIC S9(18) COMP.
       05 O-CUSTKEY       PIC S9(18) COMP.
       05 O-ORDERSTATUS   PIC X.
       05 O-TOTALPRICE    PIC S9(11)V99 COMP-3.
       05 O-ORDERDATE     PIC S9(9) COMP.
       05 O-ORDERPRIORITY PIC X(15).
    """
).override({"O_ORDERDATE": {"typ": "DATE"}})

LINEITEM = Layout.from_copybook(
    """
    01 LINE-REC.
       05 L-ORDERKEY      PIC S9(18) COMP.
       05 L-PARTKEY       PIC S9(18) COMP.
       05 L-LINENUMBER    PIC S9(9) COMP.
       05 L-QUANTITY      PIC S9(5)V99 COMP-3.
       05 L-EXTENDEDPRICE PIC S9(11)V99 COMP-3.
       05 FILLER-1        PIC X(02).
       05 L-DISCOUNT      PIC S9(1)V99 COMP-3.
       05 L-RETURNFLAG    PIC X.
       05 L-SHIPDATE      PIC S9(9) COMP.
    """
).override({"L_SHIPDATE": {"typ": "DATE"}})


def orders_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", money("o_totalprice").alias("o_totalprice"), F.to_date("o_orderdate").alias("o_orderdate"), "o_orderpriority")


def line_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", money("l_quantity", 7).alias("l_quantity"), money("l_extendedprice").alias("l_extendedprice"), F.lit("").alias("filler_1"), money("l_discount", 3).alias("l_discount"), "l_returnflag", F.to_date("l_shipdate").alias("l_shipdate"))


def stored(recs: DataFrame, lrecl: int) -> DataFrame:
    """Records written as bytes and scanned again, so that nothing of how they were made is left in the plan."""
    path = scratch(recs.sparkSession)
    records.write_bytes(recs, path, lrecl)
    return records.read_records(recs.sparkSession, path, lrecl)


def encoded(df: DataFrame, layout: Layout) -> DataFrame:
    return stored(quality.encode_or_fail(df, layout), layout.lrecl)


def through(df: DataFrame, layout: Layout) -> DataFrame:
    """Encode, write, read and decode; errors would lose rows and so show."""
    path = scratch(df.sparkSession)
    records.write_records(df, layout, path)
    return quality.split(records.read_layout(df.sparkSession, path, layout))[0]


def one(df: DataFrame, f: Field) -> DataFrame:
    """Round trip of (k, v) through one field."""
    key = Field("K", "INTEGER", 8)
    return through(df, Layout((key, f))).select(F.col("K").alias("k"), F.col(f.name).alias("v"))


#: A piece of a text: 255 characters of up to four bytes and a mark that keeps blanks at their end.
PIECE = 255
PIECES = Layout((Field("K", "INTEGER", 8), Field("R", "INTEGER", 8), Field("I", "INTEGER", 4), Field("V", "LOCALIZED_STRING", 4 * (PIECE + 1), charset="UTF-8")))


def localized_texts(df: DataFrame) -> DataFrame:
    """Round trip of (k, text) by whole texts: cut into numbered pieces, written, read and joined again; null and empty texts have no piece."""
    rows = df.toDF("k", "text").withColumn("r", F.monotonically_increasing_id()).where("length(text) > 0")
    numbered = rows.withColumn("i", F.explode(F.sequence(F.lit(0), F.floor((F.length("text") - 1) / PIECE).cast("int"))))
    good = through(numbered.select("k", "r", "i", F.concat(F.substring(F.col("text"), F.col("i") * PIECE + 1, F.lit(PIECE)), F.lit(".")).alias("v")), PIECES)
    pieces = good.groupBy("K", "R").agg(F.sort_array(F.collect_list(F.struct("I", "V"))).alias("p"))
    return pieces.select(F.col("K").alias("k"), F.array_join(F.transform("p", lambda x: x["V"].substr(F.lit(1), F.length(x["V"]) - 1)), "").alias("text"))


@register("select o_orderstatus, cast(sum(cast(round(o_totalprice, 2) as decimal(13,2))) as double) as total, count(*) as n from orders group by 1")
def roundtrip_orders(spark, sf_dir):
    """Flagship: encode, write bytes, read back, decode, aggregate."""
    path = scratch(spark)
    records.write_records(orders_rows(spark, sf_dir), ORDERS, path)
    good, _ = quality.split(records.read_layout(spark, path, ORDERS))
    return good.groupBy(F.col("O_ORDERSTATUS").alias("o_orderstatus")).agg(F.sum("O_TOTALPRICE").cast("double").alias("total"), F.count("*").alias("n"))


@register("select l_returnflag, count(*) as n, cast(sum(cast(round(l_extendedprice, 2) as decimal(13,2))) as double) as price, cast(sum(cast(round(l_discount, 2) as decimal(3,2))) as double) as discount, cast(max(cast(l_shipdate as date)) as varchar) as last_day from lineitem group by 1")
def roundtrip_lineitem(spark, sf_dir):
    good = through(line_rows(spark, sf_dir), LINEITEM)
    return good.groupBy(F.col("L_RETURNFLAG").alias("l_returnflag")).agg(F.count("*").alias("n"), F.sum("L_EXTENDEDPRICE").cast("double").alias("price"), F.sum("L_DISCOUNT").cast("double").alias("discount"), F.max("L_SHIPDATE").cast("string").alias("last_day"))


@register("select p_partkey as k, nullif(rtrim(p_name), '') as v from part")
def roundtrip_string(spark, sf_dir):
    return one(table(spark, sf_dir, "part").select("p_partkey", "p_name"), Field("V", "STRING", 64))


@register("select doc_id as k, substring(text, 1, 8) as v from documents where length(rtrim(substring(text, 1, 8))) > 0 and rtrim(substring(text, 1, 8)) = substring(text, 1, 8)")
def roundtrip_localized(spark, sf_dir):
    """Whole texts go through; the result shows their beginnings."""
    texts = localized_texts(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return texts.select("k", F.substring("text", 1, 8).alias("v")).where((F.length(F.rtrim("v")) > 0) & (F.rtrim("v") == F.col("v")))


@register("select p_partkey as k, cast(p_size as bigint) as v from part")
def roundtrip_int16(spark, sf_dir):
    return one(table(spark, sf_dir, "part").select("p_partkey", "p_size"), Field("V", "INTEGER", 2))


@register("select o_orderkey as k, -o_custkey as v from orders")
def roundtrip_int32(spark, sf_dir):
    return one(table(spark, sf_dir, "orders").select("o_orderkey", -F.col("o_custkey")), Field("V", "INTEGER", 4))


@register("select o_orderkey as k, -1000000007 * o_custkey as v from orders")
def roundtrip_int64(spark, sf_dir):
    return one(table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey") * F.lit(-1_000_000_007).cast("long")), Field("V", "INTEGER", 8))


@register("select o_orderkey as k, 3000000000 + o_custkey as v from orders")
def roundtrip_uint(spark, sf_dir):
    return one(table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey") + F.lit(3_000_000_000).cast("long")), Field("V", "UNSIGNED_INTEGER", 4))


@register("select l_orderkey * 10 + l_linenumber as k, cast(cast(round(l_extendedprice, 2) as decimal(13,2)) as double) as v from lineitem")
def roundtrip_packed(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey") * 10 + F.col("l_linenumber"), money("l_extendedprice"))
    return one(rows, Field("V", "DECIMAL", 7, 11, 2)).withColumn("v", F.col("v").cast("double"))


@register("select c_custkey as k, cast(cast(round(c_acctbal, 2) as decimal(13,2)) as double) as v from customer union all select -s_suppkey, cast(cast(round(s_acctbal, 2) as decimal(13,2)) as double) from supplier")
def roundtrip_packed_negative(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey"), money("c_acctbal")).union(table(spark, sf_dir, "supplier").select(-F.col("s_suppkey"), money("s_acctbal")))
    return one(rows, Field("V", "DECIMAL", 7, 11, 2)).withColumn("v", F.col("v").cast("double"))


@register("select o_orderkey as k, cast(cast(o_orderdate as date) as varchar) as v from orders")
def roundtrip_date4(spark, sf_dir):
    return one(table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate")), Field("V", "DATE", 4)).withColumn("v", F.col("v").cast("string"))


@register("select o_orderkey as k, cast(cast(o_orderdate as date) as varchar) as v from orders")
def roundtrip_text_date(spark, sf_dir):
    return one(table(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "MM/dd/yyyy")), Field("V", "STRING", 10, cast="DATE", format="MM/DD/YYYY")).withColumn("v", F.col("v").cast("string"))


@register("select o_orderkey as k, cast(cast(o_orderdate as date) as varchar) as v from orders")
def roundtrip_integer_date(spark, sf_dir):
    return one(table(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyyMMdd").cast("long")), Field("V", "INTEGER", 4, cast="DATE")).withColumn("v", F.col("v").cast("string"))


@register("select event_id as k, cast(epoch_us(ts) as bigint) as v from events")
def roundtrip_timestamp(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd-HH.mm.ss.SSSSSS"))
    out = one(rows, Field("V", "STRING", 26, cast="TIMESTAMP"))
    return out.withColumn("v", F.unix_micros(F.col("v").cast("timestamp")))


@register("select c_custkey as k, md5(c_name) as v from customer")
def roundtrip_bytes(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.unhex(F.md5(F.col("c_name").cast("binary"))))
    return one(rows, Field("V", "BYTES", 16)).withColumn("v", F.lower(F.hex("v")))


@register("select c_custkey as k, cast(c_nationkey as bigint) as v, cast(cast(round(c_acctbal, 2) as decimal(9,2)) as double) as w from customer")
def text_numbers(spark, sf_dir):
    """Numbers written as text, read as long and decimal."""
    cents = F.concat(F.when(F.col("c_acctbal") < 0, "-").otherwise(""), F.lpad(F.abs(F.round(F.col("c_acctbal") * 100)).cast("long").cast("string"), 10, "0"))
    layout = Layout((Field("K", "INTEGER", 8), Field("V", "STRING", 4, cast="INTEGER"), Field("W", "STRING", 12, 7, 2, cast="DECIMAL")))
    out = through(table(spark, sf_dir, "customer").select("c_custkey", F.lpad(F.col("c_nationkey").cast("string"), 4, "0"), cents), layout)
    return out.select(F.col("K").alias("k"), F.col("V").alias("v"), F.col("W").cast("double").alias("w"))


VARTEXT = Layout((Field("K", "INTEGER", 18), Field("STATUS", "STRING", 1), Field("PRICE", "DECIMAL", 16, 13, 2), Field("DAY", "STRING", 10, cast="DATE", format="YYYY-MM-DD"), Field("PRIORITY", "STRING", 15)), vartext=True)


@register("select o_orderkey as k, o_orderstatus as status, cast(cast(round(o_totalprice, 2) as decimal(15,2)) as double) as price, cast(cast(o_orderdate as date) as varchar) as day, o_orderpriority as priority from orders")
def vartext_scan(spark, sf_dir):
    """Delimited records, split and decoded by field."""
    rows = orders_rows(spark, sf_dir)
    line = F.concat_ws("|", F.col("o_orderkey").cast("string"), "o_orderstatus", F.col("o_totalprice").cast("string"), F.date_format("o_orderdate", "yyyy-MM-dd"), "o_orderpriority", F.lit(""))
    recs = rows.select(F.encode(F.rpad(line, 80, " "), "IBM1047").alias("rec"))
    good, _ = quality.split(quality.decode(stored(recs, 80), VARTEXT))
    return good.select(F.col("K").alias("k"), F.col("STATUS").alias("status"), F.col("PRICE").cast("double").alias("price"), F.col("DAY").cast("string").alias("day"), F.col("PRIORITY").alias("priority"))


@register("select rpad(n_nationkey || '|' || n_name || '|' || n_regionkey, 39, ' ') || ' ' as line from nation")
def vartext_export(spark, sf_dir):
    recs = records.vartext_records(table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey"), 40)
    return stored(recs, 40).select(F.decode("rec", "IBM1047").alias("line"))


@register("select l_returnflag, cast(sum(cast(round(l_quantity, 2) as decimal(7,2))) as double) as quantity from lineitem group by 1")
def filler_pruning(spark, sf_dir):
    """Only two of the fields are decoded; fillers never are."""
    out = quality.decode(encoded(line_rows(spark, sf_dir), LINEITEM), LINEITEM, columns=["L_RETURNFLAG", "L_QUANTITY"])
    return out.groupBy(F.col("L_RETURNFLAG").alias("l_returnflag")).agg(F.sum("L_QUANTITY").cast("double").alias("quantity"))


@register("select o_orderkey as k, cast(cast(round(o_totalprice, 2) as decimal(13,2)) as varchar) as price from orders")
def layout_override(spark, sf_dir):
    """A packed field read as text."""
    recs = encoded(orders_rows(spark, sf_dir), ORDERS)
    good, _ = quality.split(quality.decode(recs, ORDERS.override({"O_TOTALPRICE": {"cast": "STRING"}})))
    return good.select(F.col("O_ORDERKEY").alias("k"), F.col("O_TOTALPRICE").alias("price"))


@register("select p_partkey as k, case when p_brand not like 'Brand#1%' then p_brand end as v from part")
def nullif(spark, sf_dir):
    return one(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), Field("V", "STRING", 12, nullif="Brand#1".encode("cp1140")))


@register("select count(*) as records, count(*) filter (o_orderkey % 7 = 0) as errors from orders")
def rejects_count(spark, sf_dir):
    """A broken packed nibble in every seventh order is rejected."""
    recs = quality.encode(orders_rows(spark, sf_dir), ORDERS)
    broken = recs.select(F.when(F.col("o_orderkey") % 7 == 0, F.concat(F.substring("rec", 1, 17), F.unhex(F.lit("FFFFFFFFFFFFFF")), F.substring("rec", 25, 100))).otherwise(F.col("rec")).alias("rec"))
    return quality.decode(stored(broken, ORDERS.lrecl), ORDERS).agg(F.count("*").alias("records"), F.count_if(F.size(quality.ERRORS) > 0).alias("errors"))


@register("select o_orderkey as k, o_orderpriority as v from orders")
def excess_bytes(spark, sf_dir):
    """Records longer than the layout, read back from files."""
    path = scratch(spark)
    records.write_records(orders_rows(spark, sf_dir), ORDERS, path, ORDERS.lrecl + 5)
    good, _ = quality.split(records.read_layout(spark, path, ORDERS))
    return good.select(F.col("O_ORDERKEY").alias("k"), F.col("O_ORDERPRIORITY").alias("v"))


@register("select o_orderkey % 3 as generation, count(*) as n, cast(sum(o_custkey) as bigint) as keys from orders group by 1")
def generation_union(spark, sf_dir):
    """Three generations written apart and read together."""
    root, rows = scratch(spark), orders_rows(spark, sf_dir)
    for g in range(3):
        records.write_records(rows.where(F.col("o_orderkey") % 3 == g), ORDERS, f"{root}/N1.ORDERS.G000{g + 1}V00")
    good, _ = quality.split(records.read_layout(spark, records.generations(root, "N1.ORDERS"), ORDERS))
    return good.groupBy((F.col("O_ORDERKEY") % 3).alias("generation")).agg(F.count("*").alias("n"), F.sum("O_CUSTKEY").alias("keys"))


@register("select least(100, count(*)) as n from orders")
def record_limit(spark, sf_dir):
    """At most so many records are copied, gzipped, and read again."""
    source, target = scratch(spark), scratch(spark)
    records.write_records(orders_rows(spark, sf_dir), ORDERS, source)
    records.copy_records(spark, source, target, ORDERS.lrecl, 100)
    return records.read_gzip(spark, target, ORDERS.lrecl).agg(F.count("*").alias("n"))


@register("select count(*) as records, 0 as errors, cast(sum(o_custkey) as bigint) as keys from orders")
def ingest_orc(spark, sf_dir):
    """Records decoded to ORC behind an error threshold."""
    path, target = scratch(spark), scratch(spark)
    records.write_records(orders_rows(spark, sf_dir), ORDERS, path)
    done = records.ingest(spark, path, ORDERS, target)
    return spark.read.orc(target).agg(F.count("*").alias("records"), F.lit(done.exported["errors"]).alias("errors"), F.sum("O_CUSTKEY").alias("keys"))


@register("select c_mktsegment, count(*) as n, cast(sum(cast(round(c_acctbal, 2) as decimal(13,2))) as double) as balance from customer group by 1")
def load_csv(spark, sf_dir):
    path = scratch(spark)
    table(spark, sf_dir, "customer").withColumn("c_acctbal", money("c_acctbal")).write.option("header", True).csv(path)
    rows = tables.read_csv(spark, path, schema=tables.schema_of("c_custkey:INT64,c_name:STRING,c_nationkey:INT64,c_acctbal:NUMERIC,c_mktsegment:STRING"), skip=1)
    return rows.groupBy("c_mktsegment").agg(F.count("*").alias("n"), F.sum("c_acctbal").cast("double").alias("balance"))


@register("select event_type, count(*) as n from events group by 1")
def load_json(spark, sf_dir):
    path = scratch(spark)
    table(spark, sf_dir, "events").select("event_id", "event_type").write.json(path)
    return tables.read_any(spark, path, "NEWLINE_DELIMITED_JSON").groupBy("event_type").agg(F.count("*").alias("n"))


@register("select p_brand, count(*) as n from part group by 1")
def load_orc(spark, sf_dir):
    path = scratch(spark)
    table(spark, sf_dir, "part").write.orc(path)
    return tables.read_any(spark, path, "ORC").groupBy("p_brand").agg(F.count("*").alias("n"))


@register("select n_nationkey as k, n_name as name, null::varchar as note from nation union all select r_regionkey, r_name, 'region' from region")
def append_evolve(spark, sf_dir):
    """An append that adds a column."""
    first = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("name"))
    more = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("k"), F.col("r_name").alias("name"), F.lit("region").alias("note"))
    wide = tables.evolve(more, first.schema, addition=True)
    return first.unionByName(wide, allowMissingColumns=True)


@register("select count(*) as n, cast(sum(o_custkey) as bigint) as keys from orders where cast(o_orderdate as date) = (select max(cast(o_orderdate as date)) from orders)")
def day_partition_read(spark, sf_dir):
    """One day of a table that is partitioned by month and day; other partitions aren't read."""
    path, rows = scratch(spark), orders_rows(spark, sf_dir)
    last = rows.agg(F.max("o_orderdate")).first()[0]
    rows.repartition("o_orderdate").write.partitionBy("o_orderdate").parquet(path)
    return spark.read.parquet(path).where(F.col("o_orderdate") == F.lit(last)).agg(F.count("*").alias("n"), F.sum("o_custkey").alias("keys"))


MERGE_SQL = """
with target as (select c_custkey as k, c_nationkey as nation, cast(cast(round(c_acctbal, 2) as decimal(13,2)) as double) as amount from customer where c_custkey % 2 = 0),
source as (select o_custkey as k, cast(count(*) as int) as nation, cast(sum(cast(round(o_totalprice, 2) as decimal(13,2))) as double) as amount from orders group by 1)
"""


def _merge_inputs(spark, sf_dir):
    target = table(spark, sf_dir, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("k"), F.col("c_nationkey").alias("nation"), money("c_acctbal").cast("double").alias("amount"))
    source = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").cast("int").alias("nation"), F.sum(money("o_totalprice")).cast("double").alias("amount"))
    return target, source


@register("select c_custkey as k, c_name as name, case when c_custkey % 3 = 0 then 'new' else c_mktsegment end as segment from customer where c_custkey % 2 = 0 union all select c_custkey, c_name, 'new' from customer where c_custkey % 2 <> 0 and c_custkey % 3 = 0")
def merge_upsert(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return merging.merge(rows.where("k % 2 = 0"), rows.where("k % 3 = 0").withColumn("segment", F.lit("new")), ["k"], ["segment"])


@register(MERGE_SQL + "select coalesce(t.k, s.k) as k, coalesce(t.nation, s.nation) as nation, coalesce(s.amount, t.amount) as amount from target t full join source s on t.k = s.k")
def merge_aggregate_source(spark, sf_dir):
    return merging.merge(*_merge_inputs(spark, sf_dir), ["k"], ["amount"])


@register(MERGE_SQL + "select action, count(*) as n from (select case when t.k is null then 'inserted' when s.k is null then 'unmodified' else 'updated' end as action from target t full join source s on t.k = s.k) group by 1")
def merge_counts(spark, sf_dir):
    flags = merging.merge_flags(*_merge_inputs(spark, sf_dir), ["k"], ["amount"])
    return flags.groupBy(F.col(merging.ACTION).alias("action")).agg(F.count("*").alias("n"))


@register("select s_suppkey as k, case when s_acctbal < 0 then 0.0 else s_acctbal end as balance from supplier")
def update_table(spark, sf_dir):
    rows = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_acctbal").alias("balance"))
    return merging.update(rows, F.col("balance") < 0, {"balance": F.lit(0.0)})


@register("select o_orderpriority, count(*) as n from orders where o_orderstatus = 'F' and o_totalprice > 1000 and o_orderdate >= date '1995-01-01' group by 1")
def sql_params(spark, sf_dir):
    view = fresh()
    table(spark, sf_dir, "orders").createOrReplaceTempView(view)
    return sqljob.run_query(spark, f"select o_orderpriority, count(*) as n from {view} where o_orderstatus = :s and o_totalprice > :p and o_orderdate >= :d group by 1", ["s::F", "p:INT64:1000", "d:DATE:1995-01-01"])


@register("select n_name, count(*) as n from customer join nation on c_nationkey = n_nationkey group by 1")
def sql_script(spark, sf_dir):
    customer, nation = fresh(), fresh()
    for name, view in (("customer", customer), ("nation", nation)):
        table(spark, sf_dir, name).createOrReplaceTempView(view)
    return sqljob.run_script(spark, f"select 'a;b'; -- a comment; with a mark\n/* another; */ select n_name, count(*) as n from {customer} join {nation} on c_nationkey = n_nationkey group by 1;")


@register("select distinct o_orderpriority, o_orderstatus from orders order by 1, 2 limit 7")
def distinct_limit(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderstatus").distinct().orderBy("o_orderpriority", "o_orderstatus").limit(7)


@register("select count(*) as written, count(*) as expected from lineitem")
def reconcile_counts(spark, sf_dir):
    """Rows written against rows of the result and bytes on disk."""
    rows = line_rows(spark, sf_dir)
    written = records.write_records(rows, LINEITEM, scratch(spark))
    return rows.agg(F.lit(written).cast("long").alias("written"), F.count("*").alias("expected"))


@register("select event_id as k, hour(ts) || ':' || minute(ts) || ':' || second(ts) as t, cast(cast(epoch_us(ts) as decimal(26,0)) / 1000000 as double) as s from events")
def time_texts(spark, sf_dir):
    micros = F.unix_micros(F.date_trunc("second", "ts")) % 86_400_000_000
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("k"), codec.time_text(micros).alias("t"), codec.text_of(F.col("ts").cast("timestamp"), T.TimestampType()).cast("double").alias("s"))


@register("select n_name, case when n_regionkey = 0 then 'first' else 'other' end as kind, substring(n_name, 1, 3) as short, cast(n_nationkey as double) as key from nation where n_name is not null")
def scalar_functions(spark, sf_dir):
    """CASE, SUBSTRING from 0, CAST and WHERE."""
    view = fresh()
    table(spark, sf_dir, "nation").createOrReplaceTempView(view)
    return sqljob.run_query(spark, f"select n_name, case when n_regionkey = 0 then 'first' else 'other' end as kind, substring(n_name, 0, 3) as short, cast(n_nationkey as double) as key from {view} where n_name is not null")
