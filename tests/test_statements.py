"""MERGE, UPDATE, DELETE and CREATE OR REPLACE TABLE as SQL text, their counts, and what is left when a job is killed."""

import datetime
import os
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tapelake.operators import merge, publish, sqljob


@pytest.fixture
def name():
    return f"st_{uuid.uuid4().hex}"


def rows(spark, name, *columns):
    return sorted(map(tuple, spark.table(name).select(*(columns or ["*"])).collect()), key=str)


def files(spark, name):
    return {f.rpartition("/")[2] for f in spark.table(name).inputFiles()}


def test_the_merge_of_a_nightly_load(spark, name):
    """Two tables made anew and filled by one script, and an upsert of whole keys, as in a warehouse."""
    other = name + "_u"
    ddl = "(ITEM_NBR bigint, YR_WK bigint, QTY bigint, AMT decimal(38,9))"
    done, _ = sqljob.run_statements(spark, f"create or replace table {name} {ddl}; create or replace table {other} {ddl}; insert into {name} values (1,1,1,1.01), (0,1,1,1.01); insert into {other} values (1,1,7,9.99), (2,1,1,1.01);")
    assert [r.activity_count for r in done] == [0, 0, 2, 2]
    sql = f"MERGE INTO {name} D USING {other} S ON D.ITEM_NBR = S.ITEM_NBR AND D.YR_WK = S.YR_WK WHEN NOT MATCHED THEN INSERT (ITEM_NBR, YR_WK, QTY, AMT) VALUES (S.ITEM_NBR, S.YR_WK, S.QTY, S.AMT) WHEN MATCHED THEN UPDATE SET D.QTY = S.QTY, D.AMT = S.AMT"
    got = sqljob.run_statement(spark, sql)
    assert got.activity_count == 2 and got.exported == {"before": 2, "inserted": 1, "updated": 1, "deleted": 0, "unmodified": 1}
    assert rows(spark, name, "ITEM_NBR", "QTY") == [(0, 1), (1, 7), (2, 1)]
    spark.sql(f"insert into {other} values (1,1,1,1)")
    with pytest.raises(Exception, match="repeated"):
        sqljob.run_statement(spark, sql)
    assert rows(spark, name, "ITEM_NBR", "QTY") == [(0, 1), (1, 7), (2, 1)]
    grouped = sql.replace(f"USING {other} S", f"USING (select ITEM_NBR, YR_WK, sum(QTY) as QTY, sum(AMT) as AMT from {other} group by ITEM_NBR, YR_WK) S")
    assert sqljob.run_statement(spark, grouped).exported == {"before": 3, "inserted": 0, "updated": 2, "deleted": 0, "unmodified": 1}
    assert rows(spark, name, "ITEM_NBR", "QTY") == [(0, 1), (1, 8), (2, 1)]


def test_merge_with_many_clauses(spark, name):
    spark.range(10).select("id", F.lit("old").alias("v"), F.col("id").cast("int").alias("_n")).write.saveAsTable(name)
    spark.createDataFrame([(1, "d"), (2, "u"), (3, "x"), (20, "i"), (21, "no"), (None, "i")], "k long, w string").createOrReplaceTempView(name + "_s")
    got = sqljob.run_statement(spark, f"""
        merge into {name} as t using {name}_s on t.id = k and w <> 'x'
        when matched and w = 'd' then delete
        when matched then update set v = concat(v, w), _n = t._n + 100
        when not matched and w = 'i' then insert (id, v) values (k, w)
        when not matched by source and id > 7 then delete""")
    assert got.exported == {"before": 10, "inserted": 2, "updated": 1, "deleted": 3, "unmodified": 6} and got.activity_count == 6
    assert rows(spark, name) == sorted([(0, "old", 0), (2, "oldu", 102), *((i, "old", i) for i in range(3, 8)), (20, "i", None), (None, "i", None)], key=str)
    with pytest.raises(ValueError, match="equality"):
        sqljob.run_statement(spark, f"merge into {name} t using {name}_s s on t.id > s.k when matched then delete")
    star = sqljob.run_statement(spark, f"merge into {name} t using (select 2L as id, 'star' as v, 5 as _n union all select 99L, 'new', 6) s on t.id = s.id when matched then update set * when not matched then insert *")
    assert star.exported["updated"] == star.exported["inserted"] == 1
    assert (2, "star", 5) in rows(spark, name) and (99, "new", 6) in rows(spark, name)


def test_residual_conditions_may_choose_among_repeated_keys(spark, name):
    spark.createDataFrame([(1, 5), (2, 5)], "k int, v int").write.saveAsTable(name)
    source = "(select 1 as k, 4 as v, 'a' as x union all select 1, 9, 'b')"
    assert sqljob.run_statement(spark, f"merge into {name} t using {source} s on t.k = s.k and s.v > t.v when matched then update set v = s.v").exported["updated"] == 1
    assert rows(spark, name) == [(1, 9), (2, 5)]
    with pytest.raises(ValueError, match="repeated"):
        sqljob.run_statement(spark, f"merge into {name} t using {source} s on t.k = s.k and s.v < t.v + 10 when matched then update set v = s.v")


def test_update_and_delete(spark, name):
    spark.range(100).select("id", (F.col("id") % 10).cast("int").alias("v")).write.saveAsTable(name)
    assert sqljob.run_statement(spark, f"update {name} set v = v + 1000 where id >= 95").exported == {"before": 100, "inserted": 0, "updated": 5, "deleted": 0, "unmodified": 95}
    assert sqljob.run_statement(spark, f"update {name} as q set v = -1 where q.id < :n", ["n:INT64:3"]).activity_count == 3
    assert sqljob.run_statement(spark, f"delete from {name} where id = ?", [":INT64:50"]).activity_count == 1
    assert spark.table(name).where("v > 999 or v = -1").count() == 8 and spark.table(name).count() == 99
    assert sqljob.run_statement(spark, f"update {name} set v = null").activity_count == 99


def test_create_or_replace_as(spark, name):
    for n in (3, 5):
        assert sqljob.run_statement(spark, f"create or replace table {name} as select id, 'a' as b, -3.14bd as c, timestamp'2014-09-27 12:30:00.45-08' as e, current_date() as f, cast(id % 2 as int) as p from range({n})").activity_count == n
        assert spark.table(name).count() == n
    sqljob.run_statement(spark, f"create or replace table {name} using orc partitioned by (p) as select id, cast(id % 2 as int) as p from range(4)")
    assert publish.described(spark, name).partitions == ["p"] and spark.table(name).where("p = 1").count() == 2
    sqljob.run_statement(spark, f"update {name} set id = 100 where p = 1")
    sqljob.run_statement(spark, f"create or replace table {name} as select 1 as x")
    assert rows(spark, name) == [(1,)]


def test_a_merge_that_touches_few_files_keeps_the_others(spark, name):
    spark.range(1000).repartitionByRange(20, "id").select("id", F.lit("old").alias("v")).write.saveAsTable(name)
    before = files(spark, name)
    source = spark.createDataFrame([(5, "new"), (7, "new"), (5000, "new")], "id long, v string")
    assert merge.merge_table(spark, name, source, ["id"], ["v"]) == merge.MergeCounts(1000, 1001, 1, 2, 998)
    after = files(spark, name)
    assert len(before & after) == 19 and spark.table(name).count() == 1001 and spark.table(name).where("v = 'new'").count() == 3
    assert merge.update_table(spark, name, F.col("id") == 999, {"v": F.lit("last")}).updated == 1
    assert len(after & files(spark, name)) >= len(after) - 2
    assert not [f for f in os.listdir(publish.plain(publish.described(spark, name).location)) if f.startswith((publish.STAGED, publish.JOURNAL))]


def test_a_journal_that_was_left_is_finished(spark, name, monkeypatch):
    spark.range(100).repartitionByRange(10, "id").select("id", F.lit(0).alias("v")).write.saveAsTable(name)
    real, killed = publish._roll_forward, []

    def die(session, journal):
        killed.append(journal)
        raise KeyboardInterrupt

    monkeypatch.setattr(publish, "_roll_forward", die)
    with pytest.raises(KeyboardInterrupt):
        merge.update_table(spark, name, F.col("id") == 3, {"v": F.lit(1)})
    spark.catalog.refreshTable(name)
    assert spark.table(name).where("v = 1").count() == 0 and spark.table(name).count() == 100  # the old rows
    monkeypatch.setattr(publish, "_roll_forward", real)
    assert publish.recover(spark, name) == 1
    assert spark.table(name).where("v = 1").count() == 1 and spark.table(name).count() == 100  # the new ones
    assert publish.recover(spark, name) == 0


def test_a_job_killed_before_its_commit_leaves_the_old_rows(spark, name, monkeypatch):
    spark.range(10).select("id", F.lit(0).alias("v")).coalesce(1).write.saveAsTable(name)
    monkeypatch.setattr(publish, "drop_versions", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
    bad = F.when(F.col("id") == 9, F.raise_error(F.lit("killed"))).otherwise(F.lit(1))
    with pytest.raises(Exception, match="killed"):
        merge.update_table(spark, name, F.col("id") >= 0, {"v": bad.cast("int")})
    assert spark.table(name).where("v = 0").count() == 10
    with pytest.raises(KeyboardInterrupt):
        merge.update_table(spark, name, F.col("id") >= 0, {"v": F.lit(2)})
    assert spark.table(name).where("v = 2").count() == 10


def test_foreign_tables_are_left_alone_and_versions_go(spark, name):
    for n in (name, f"{name}_new", f"{name}_old"):
        spark.createDataFrame([(1, "a")], "k int, v string").coalesce(1).write.saveAsTable(n)
    for i in range(3):
        merge.merge_table(spark, name, spark.createDataFrame([(1, str(i))], "k int, v string"), ["k"], ["v"])
    assert rows(spark, f"{name}_new") == rows(spark, f"{name}_old") == [(1, "a")] and rows(spark, name) == [(1, "2")]
    table = publish.described(spark, name)
    parent = Path(publish.plain(table.base)).parent
    held = [p.name for p in parent.iterdir() if p.name == name or p.name.startswith(name + publish.VERSION)]
    assert len(held) > 1 and len(publish.drop_versions(spark, table, -1)) == len(held) - 1
    assert rows(spark, name) == [(1, "2")]


def test_partitions_change_one_by_one(spark, name):
    spark.range(60).select("id", F.lit("old").alias("v"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 6).cast("int")).alias("d")).write.partitionBy("d").saveAsTable(name)
    before = files(spark, name)
    day = datetime.date(2024, 1, 3)
    source = spark.createDataFrame([(2, "new", day), (900, "new", datetime.date(2025, 5, 5))], "id long, v string, d date")
    assert merge.merge_table(spark, name, source, ["id", "d"], ["v"]) == merge.MergeCounts(60, 61, 1, 1, 59)
    assert spark.table(name).where("d = date'2024-01-03' and v = 'new'").count() == 1 and spark.table(name).where("d = date'2025-05-05'").count() == 1
    assert spark.table(name).count() == 61 and len(before - files(spark, name)) <= len(before) // 5
    assert sqljob.run_statement(spark, f"delete from {name} where d = date'2024-01-01'").activity_count == 10
    assert spark.table(name).count() == 51


def test_scripts_count_each_statement(spark, name):
    done, last = sqljob.run_statements(spark, f"create table {name} using parquet as select id as k, 'a;b' as v from range(4); -- a comment; here\ninsert into {name} values (9, 'x'); merge into {name} t using (select 9L as k) s on t.k = s.k when matched then delete; select count(*) as n from {name}")
    assert [r.activity_count for r in done] == [4, 1, 1, 0] and last.first()["n"] == 4


def test_clauses_of_merges_may_stand_in_any_order():
    text = "select 'merge when matched;'; merge into t using (select case when matched then 1 end as k from s) s on t.k = s.k when not matched then insert (k) values ('when matched') /* when matched ; */ when not matched by source then delete when matched and s.k = 1 then delete when matched then update set k = 2 ; select 2"
    assert sqljob.ordered_merges(text) == "select 'merge when matched;'; merge into t using (select case when matched then 1 end as k from s) s on t.k = s.k when matched and s.k = 1 then delete when matched then update set k = 2 when not matched then insert (k) values ('when matched') /* when matched ; */ when not matched by source then delete ; select 2"
    assert sqljob.ordered_merges("select 1; -- merge ; when\nselect 2") == "select 1; -- merge ; when\nselect 2"


def test_timestamps_with_zones():
    utc = datetime.timezone.utc
    for text, want in (("2020-01-01 00:00:00 UTC", 0), ("2020-01-01 00:00:00Z", 0), ("2020-01-01 01:00:00 Europe/Paris", 0), ("2019-12-31 16:00:00-08", 0)):
        assert sqljob.parameters([f"a:TIMESTAMP:{text}"])["a"].astimezone(utc) == datetime.datetime(2020, 1, 1, want, tzinfo=utc)
    assert sqljob.parameters(["a:TIMESTAMP:2020-01-01T00:00:00"])["a"] == datetime.datetime(2020, 1, 1)


def test_a_source_that_is_not_deterministic_is_read_once(spark, name):
    spark.range(50).select("id", F.lit(0.5).alias("v")).write.saveAsTable(name)
    source = spark.range(100).select("id", F.rand().alias("v")).where("v < 0.5")
    counts = merge.merge_table(spark, name, source, ["id"], ["v"])
    assert spark.table(name).count() == counts.written == 50 + counts.inserted


def test_columns_named_as_the_marks_are(spark, name):
    spark.createDataFrame([(1, "a", "b", "c")], "k int, _n string, _t string, _action string").write.saveAsTable(name)
    source = spark.createDataFrame([(1, "x", "y", "z"), (2, "p", "q", "r")], "k int, _n string, _t string, _action string")
    assert merge.merge_table(spark, name, source, ["k"], ["_n", "_action"]).affected == 2
    assert rows(spark, name) == [(1, "x", "b", "z"), (2, "p", "q", "r")]
