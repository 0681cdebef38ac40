"""Registered queries over single fields: each decoder and encoder that the catalog's round trips leave out."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tapelake.functions.layout import Field, Layout
from tapelake.operators import quality
from tapelake.plans.catalog import ORDERS, encoded, money, one, orders_rows, register, stored, table, through
from tapelake.session import scratch
from tapelake.sources import records

KEY = Field("K", "INTEGER", 8)


@register("select count(*) as records, 1 as errors from orders")
def trailing_partial(spark, sf_dir):
    """The last order's record is cut short at the end of a file of its own."""
    path, recs = scratch(spark), quality.encode(orders_rows(spark, sf_dir), ORDERS)
    last = recs.agg(F.max("o_orderkey")).first()[0]
    records.write_bytes(recs.where(F.col("o_orderkey") != last).select("rec"), path, ORDERS.lrecl)
    records.write_bytes(recs.where(F.col("o_orderkey") == last).select(F.substring("rec", 1, 10).alias("rec")), path, ORDERS.lrecl)
    decoded = quality.decode(records.read_records(spark, path, ORDERS.lrecl), ORDERS)
    return decoded.agg(F.count("*").alias("records"), F.count_if(F.array_contains(quality.ERRORS, "record")).cast("int").alias("errors"))


@register("select 2 * count(*) as n, cast(2 * sum(o_custkey) as bigint) as keys from orders")
def gzip_folder(spark, sf_dir):
    """Gzipped and plain parts in one folder."""
    source, target = scratch(spark), scratch(spark)
    records.write_records(orders_rows(spark, sf_dir), ORDERS, source)
    records.copy_records(spark, source, target, ORDERS.lrecl)
    records.copy_records(spark, source, target, ORDERS.lrecl, compress=False)
    good, _ = quality.split(records.read_layout(spark, target, ORDERS))
    return good.agg(F.count("*").alias("n"), F.sum("O_CUSTKEY").alias("keys"))


@register("select p_partkey as k, rpad(p_name, 64, ' ') as v from part")
def latin_string(spark, sf_dir):
    return one(table(spark, sf_dir, "part").select("p_partkey", "p_name"), Field("V", "LATIN_STRING", 64))


@register("select doc_id as k, count(*) over () as n, length(text) as chars, md5(text) as v from documents where length(text) > 0 qualify true")
def roundtrip_localized_whole(spark, sf_dir):
    """Whole texts, blanks at their ends included."""
    from tapelake.plans.catalog import localized_texts

    texts = localized_texts(table(spark, sf_dir, "documents").select("doc_id", "text"))
    total = table(spark, sf_dir, "documents").where("length(text) > 0").count()
    return texts.select("k", F.lit(total).cast("long").alias("n"), F.length("text").cast("long").alias("chars"), F.md5(F.col("text").cast("binary")).alias("v"))


@register("select count(*) as n, count(*) filter (regexp_matches(substring(text, 1, 20), '[^\\x00-\\x7F]')) as errors from documents where length(text) > 0")
def unmappable_text(spark, sf_dir):
    """Text that the field's charset lacks is an error, not a substitute."""
    rows = table(spark, sf_dir, "documents").where("length(text) > 0").select("doc_id", F.substring("text", 1, 20).alias("v"))
    made = quality.encode(rows, Layout((KEY, Field("V", "LOCALIZED_STRING", 20, charset="US-ASCII"))))
    return made.agg(F.count("*").alias("n"), F.count_if(F.size(quality.ERRORS) > 0).alias("errors"))


@register("select o_orderkey as k, cast(trunc(cast(round(o_totalprice, 2) as decimal(13,2))) as bigint) as v from orders")
def packed_to_long(spark, sf_dir):
    return one(orders_rows(spark, sf_dir).select("o_orderkey", "o_totalprice"), Field("V", "DECIMAL", 7, 11, 2, cast="LONG"))


@register("select o_orderkey as k, cast(((cast(round(o_totalprice * 100) as bigint) * 999999) // 100000000) as double) / 100 as v from orders")
def packed_truncation(spark, sf_dir):
    """More digits than the field holds are cut, never rounded."""
    price = (money("o_totalprice") * F.lit(999_999).cast("decimal(6,0)")).cast("decimal(30,2)") * F.lit("0.00000001").cast("decimal(8,8)")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", price.cast("decimal(30,10)"))
    return one(rows, Field("V", "DECIMAL", 7, 11, 2)).withColumn("v", F.col("v").cast("double"))


@register("select o_orderkey as k, cast(o_custkey as varchar) as v from orders")
def int_to_string(spark, sf_dir):
    return one(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), Field("V", "INTEGER", 8, cast="STRING"))


@register("select p_partkey as k, case when p_partkey % 3 = 0 then '' else rtrim(p_name) end as v from part")
def string_not_null(spark, sf_dir):
    """Blank fields of a type that holds no null are empty."""
    rows = table(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_partkey") % 3 == 0, F.lit("")).otherwise(F.col("p_name")))
    return one(rows, Field("V", "STRING", 64, nullable=False))


@register("select p_partkey as k, case when p_partkey % 3 <> 0 then rtrim(p_name) end as v from part")
def blank_fields(spark, sf_dir):
    """Blanks and zero bytes are null."""
    value = F.when(F.col("p_partkey") % 6 == 0, F.lit("")).when(F.col("p_partkey") % 3 != 0, F.col("p_name"))
    return one(table(spark, sf_dir, "part").select("p_partkey", value), Field("V", "STRING", 64))


@register("select p_partkey as k, '[' || p_brand || ']^' as v from part")
def charset_rule(spark, sf_dir):
    """The letters that stand for brackets and caret."""
    rows = table(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit("Ý"), "p_brand", F.lit("¨¬")))
    return one(rows, Field("V", "STRING", 20))


@register("select o_orderkey as k, case when o_orderkey % 5 <> 0 then cast(cast(o_orderdate as date) as varchar) end as v from orders")
def zero_dates(spark, sf_dir):
    """Ten zeros stand for no date."""
    text = F.when(F.col("o_orderkey") % 5 == 0, F.lit("0000000000")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return one(table(spark, sf_dir, "orders").select("o_orderkey", text), Field("V", "STRING", 10, cast="DATE", format="YYYY-MM-DD")).withColumn("v", F.col("v").cast("string"))


@register("select o_orderkey as k, nullif(o_orderstatus, 'F') as status, case when o_orderkey % 4 <> 0 then cast(cast(o_orderdate as date) as varchar) end as day from orders")
def vartext_nulls(spark, sf_dir):
    """A nullable text and a date written as a number, zero for none."""
    day = F.when(F.col("o_orderkey") % 4 == 0, F.lit("0")).otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    line = F.concat_ws("|", F.col("o_orderkey").cast("string"), "o_orderstatus", day, F.lit(""))
    recs = table(spark, sf_dir, "orders").select(F.encode(F.rpad(line, 60, " "), "IBM1047").alias("rec"))
    layout = Layout((Field("K", "INTEGER", 18), Field("STATUS", "STRING", 1, nullif=b"F"), Field("DAY", "INTEGER", 8, cast="DATE")), vartext=True)
    good, _ = quality.split(quality.decode(stored(recs, 60), layout))
    return good.select(F.col("K").alias("k"), F.col("STATUS").alias("status"), F.col("DAY").cast("string").alias("day"))


@register("select o_orderkey as k, case when o_orderkey % 2 = 1 then o_orderpriority end as v, case when o_orderkey % 2 = 1 then cast(cast(round(o_totalprice, 2) as decimal(13,2)) as double) end as w, case when o_orderkey % 2 = 1 then o_custkey else 0 end as n from orders")
def null_fields(spark, sf_dir):
    """Null of any type is zero bytes: a number reads as 0, the rest as null."""
    odd = lambda c: F.when(F.col("o_orderkey") % 2 == 1, c)
    layout = Layout((KEY, Field("V", "STRING", 15), Field("W", "DECIMAL", 7, 11, 2), Field("N", "INTEGER", 8)))
    good = through(table(spark, sf_dir, "orders").select("o_orderkey", odd(F.col("o_orderpriority")), odd(money("o_totalprice")), odd(F.col("o_custkey"))), layout)
    return good.select(F.col("K").alias("k"), F.col("V").alias("v"), F.col("W").cast("double").alias("w"), F.col("N").alias("n"))


@register("select p_partkey as k, p_brand || ' x' as v from part")
def replacement_letter(spark, sf_dir):
    """U+FFFD is written as a blank."""
    return one(table(spark, sf_dir, "part").select("p_partkey", F.concat("p_brand", F.lit("�x"))), Field("V", "STRING", 20))


@register("select c_custkey as k, rtrim(c_name) as line from customer")
def text_lines(spark, sf_dir):
    """Text records as lines without their trailing blanks, beside the keys that they hold."""
    recs = table(spark, sf_dir, "customer").select(F.encode(F.concat(F.lpad(F.col("c_custkey").cast("string"), 12, "0"), F.rpad("c_name", 60, " ")), "IBM1047").alias("rec"))
    path = scratch(spark)
    records.write_bytes(recs, path, 72)
    line = records.read_lines(spark, path, 72)
    return line.select(F.substring("line", 1, 12).cast("long").alias("k"), F.substring("line", 13, 60).alias("line"))


@register("select 0 as empty, count(*) as n from orders")
def empty_input(spark, sf_dir):
    """A folder without a record has the layout's columns and no row."""
    rows, path = orders_rows(spark, sf_dir), scratch(spark)
    records.write_records(rows.where("false"), ORDERS, path)
    none = records.read_layout(spark, path, ORDERS).count()
    good, _ = quality.split(quality.decode(encoded(rows, ORDERS), ORDERS))
    return good.agg(F.lit(none).cast("int").alias("empty"), F.count("O_ORDERKEY").alias("n"))


@register("select count(*) as n, cast(sum(o_custkey) as bigint) as keys from orders")
def dataset_member(spark, sf_dir):
    """A member written and read under its dataset's name."""
    path = records.dataset_path(scratch(spark), "N1.ORDERS(DAILY)")
    records.write_records(orders_rows(spark, sf_dir), ORDERS, path)
    good, _ = quality.split(records.read_layout(spark, path, ORDERS))
    return good.agg(F.count("*").alias("n"), F.sum("O_CUSTKEY").alias("keys"))


@register("select count(*) as n, cast(sum(o_custkey) as bigint) as keys from orders")
def composed_file(spark, sf_dir):
    """Parts joined into one file."""
    path, target = scratch(spark), scratch(spark) + ".bin"
    records.write_records(orders_rows(spark, sf_dir), ORDERS, path)
    records.compose(spark, path, target)
    good, _ = quality.split(records.read_layout(spark, target, ORDERS))
    return good.agg(F.count("*").alias("n"), F.sum("O_CUSTKEY").alias("keys"))


@register("select count(*) as n, count(*) filter (length(p_name) > 12) as errors, case when count(*) filter (length(p_name) > 12) > 0 then 'P_NAME' end as fields from part")
def encode_failures(spark, sf_dir):
    """Texts that are too long, by the names of their fields."""
    made = quality.encode(table(spark, sf_dir, "part").select("p_partkey", "p_name"), Layout((KEY, Field("P_NAME", "STRING", 12))))
    return made.agg(F.count("*").alias("n"), F.count_if(F.size(quality.ERRORS) > 0).alias("errors"), F.max(F.array_join(F.when(F.size(quality.ERRORS) > 0, F.col(quality.ERRORS)), ",")).alias("fields"))


@register("select count(*) as n, 3 as refused from orders")
def export_checks(spark, sf_dir):
    """Layouts that a result can't be written with are refused."""
    rows, refused = orders_rows(spark, sf_dir), 0
    for df, length in ((rows.drop("o_custkey"), None), (rows, ORDERS.lrecl - 1), (rows.withColumn("o_custkey", F.col("o_orderpriority")), None)):
        try:
            quality.check_export(df, ORDERS, length)
        except ValueError:
            refused += 1
    quality.check_export(rows, ORDERS)
    return rows.agg(F.count("*").alias("n"), F.lit(refused).alias("refused"))


@register("select event_id as k, (epoch_us(ts) // 1000000)::varchar || '.' || lpad((epoch_us(ts) % 1000000)::varchar, 6, '0') as v from events")
def timestamp_texts(spark, sf_dir):
    """A timestamp written into a text field: seconds since 1970 with six decimals."""
    rows = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp"))
    return one(rows, Field("V", "STRING", 20))


@register("select p_partkey as k, rtrim(p_name) as a, p_brand || '日本' as b, rtrim(p_name) as c from part")
def localized_charsets(spark, sf_dir):
    """One-byte and two-byte mainframe charsets."""
    layout = Layout((KEY, Field("A", "LOCALIZED_STRING", 64, charset="IBM037"), Field("B", "LOCALIZED_STRING", 24, charset="JPNEBCDIC1399_4IJ"), Field("C", "LOCALIZED_STRING", 64, charset="SCHEBCDIC935_6IJ")))
    good = through(table(spark, sf_dir, "part").select("p_partkey", "p_name", F.concat("p_brand", F.lit("日本")), F.col("p_name").alias("again")), layout)
    return good.select(F.col("K").alias("k"), F.col("A").alias("a"), F.col("B").alias("b"), F.col("C").alias("c"))


@register("select count(*) as n, count(*) as in_order from orders")
def record_order(spark, sf_dir):
    """Places of records within their files, as they were written."""
    rows, path = orders_rows(spark, sf_dir), scratch(spark)
    records.write_records(rows.repartitionByRange(5, "o_orderkey").sortWithinPartitions("o_orderkey"), ORDERS, path)
    numbered = records.numbered_records(spark, path, ORDERS.lrecl)
    key = F.conv(F.hex(F.substring("rec", 1, 8)), 16, -10).cast("long")
    placed = numbered.select("path", "number", key.alias("k")).withColumn("place", F.row_number().over(Window.partitionBy("path").orderBy("k")) - 1)
    return placed.agg(F.count("*").alias("n"), F.count_if(F.col("place") == F.col("number")).alias("in_order"))


@register("select count(*) as n, count(*) filter (o_orderkey % 6 = 0) as errors from orders")
def vartext_short_lines(spark, sf_dir):
    """Records that lack a field are rejected."""
    line = F.when(F.col("o_orderkey") % 6 == 0, F.col("o_orderkey").cast("string")).otherwise(F.concat_ws("|", F.col("o_orderkey").cast("string"), "o_orderstatus", F.lit("")))
    recs = table(spark, sf_dir, "orders").select(F.encode(F.rpad(line, 40, " "), "IBM1047").alias("rec"))
    decoded = quality.decode(stored(recs, 40), Layout((Field("K", "STRING", 18), Field("STATUS", "STRING", 1)), vartext=True))
    return decoded.agg(F.count("*").alias("n"), F.count_if(F.size(quality.ERRORS) > 0).alias("errors"))
