import os

import pytest
from helpers import as_text, frame
from pyspark.sql import functions as F

from tallyframe.operators.metrics import load_metrics
from tallyframe.sinks.files import (
    complete_snapshots,
    read_latest_snapshot,
    write_frame,
    write_partitioned,
    write_snapshot,
)
from tallyframe.sinks.jdbc import append_table, replace_months, replace_table
from tallyframe.sources.jdbc import keep_table, read_table


def months(spark, *rows):
    return frame(spark, rows, "sales_month string, store_id long, total long")


def test_plain_write(spark, tmp_path):
    df = months(spark, ("2023-03", 121, 5))
    write_frame(df, str(tmp_path / "p"))
    write_frame(df, str(tmp_path / "p"))
    assert as_text(spark.read.parquet(str(tmp_path / "p"))) == [("2023-03", "121", "5")]
    write_frame(df, str(tmp_path / "c"), "csv", "append")
    assert as_text(spark.read.option("header", True).csv(str(tmp_path / "c")), "total") == [("5",)]
    with pytest.raises(Exception, match="already exists|ALREADY_EXISTS"):
        write_frame(df, str(tmp_path / "p"), mode="errorifexists")


def test_partitioned_write_replaces_touched_folders_only(spark, tmp_path):
    path = str(tmp_path / "mart")
    write_partitioned(months(spark, ("2023-03", 121, 1), ("2023-04", 121, 2), (None, 122, 3)), path, ["sales_month"])
    write_partitioned(months(spark, ("2023-04", 122, 9)), path, ["sales_month"], touched_only=True)
    back = spark.read.parquet(path)
    assert dict(back.dtypes)["sales_month"] == "string"
    assert as_text(back, "sales_month", "store_id", "total") == [(None, "122", "3"), ("2023-03", "121", "1"), ("2023-04", "122", "9")]
    write_partitioned(months(spark, ("2023-05", 1, 1)), path, ["sales_month", "store_id"])
    assert as_text(spark.read.parquet(path)) == [("1", "2023-05", "1")]


def test_a_large_folder_is_written_by_several_tasks(spark, tmp_path):
    df = spark.range(400_000).selectExpr("'2023-03' as sales_month", "id", "uuid() as text")
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    try:
        spark.conf.set(key, "1m")
        write_partitioned(df, str(tmp_path / "hot"), ["sales_month"])
    finally:
        spark.conf.unset(key)
    files = [f for f in os.listdir(tmp_path / "hot" / "sales_month=2023-03") if f.endswith(".parquet")]
    assert len(files) > 1
    assert spark.read.parquet(str(tmp_path / "hot")).count() == 400_000


def test_snapshots_ignore_unfinished_runs(spark, tmp_path):
    root = str(tmp_path / "snap")
    assert complete_snapshots(spark, root) == []
    with pytest.raises(FileNotFoundError):
        read_latest_snapshot(spark, root)
    write_snapshot(months(spark, ("2023-03", 121, 1)), root, 1000)
    write_snapshot(months(spark, ("2023-03", 121, 2)), root, 3000, by=["sales_month", "store_id"])
    write_snapshot(months(spark, ("2023-03", 121, 3)), root, 20000)
    (tmp_path / "snap" / "run_epoch_ms=20000" / "_SUCCESS").unlink()
    assert complete_snapshots(spark, root) == [1000, 3000]
    assert as_text(read_latest_snapshot(spark, root), "total", "sales_month", "store_id") == [("2", "2023-03", "121")]


DERBY = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def test_database_roundtrip(spark, tmp_path):
    spark._jvm.java.lang.System.setProperty("derby.stream.error.file", os.devnull)
    url = "jdbc:derby:memory:sinks;create=true"
    df = spark.range(1000).selectExpr("id", "cast(id / 3 as decimal(18,2)) as total", "string(id % 7) as month")
    append_table(df, url, "mart", DERBY)
    append_table(df, url, "mart", DERBY, max_connections=2)
    assert read_table(spark, url, "mart", DERBY).count() == 2000
    replace_table(df, url, "mart", DERBY)
    replace_table(df, url, "mart", DERBY)
    split = read_table(spark, url, "mart", DERBY, key="id", rows_per_task=300)
    assert split.rdd.getNumPartitions() == 4
    assert as_text(split) == as_text(df)
    assert read_table(spark, url, "mart", DERBY, key="id").rdd.getNumPartitions() == 1
    assert as_text(keep_table(split, str(tmp_path / "kept"))) == as_text(df)
    with pytest.raises(Exception, match="(?i)no_such|does not exist|schema"):
        append_table(df.selectExpr("id as no_such_column"), url, "mart", DERBY)


def test_load_metrics(spark):
    df = frame(spark, [(1, None), (2, "x"), (None, None)], "a long, b string")
    assert as_text(load_metrics(df)) == [("a", "3", "1"), ("b", "3", "2")]


def test_key_ranges_of_a_key_with_gaps_are_even(spark):
    """Half of the keys lie in one thousandth of their range, some rows have no key."""
    spark._jvm.java.lang.System.setProperty("derby.stream.error.file", os.devnull)
    url = "jdbc:derby:memory:gaps;create=true"
    rows = spark.range(2000).selectExpr("case when id % 100 = 7 then null when id < 1000 then id else id * 1000000 end as k", "id")
    rows.write.jdbc(url, "gaps", mode="overwrite", properties=DERBY)
    read = read_table(spark, url, "gaps", DERBY, key="k", rows_per_task=250)
    sizes = read.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 8 and max(r["count"] for r in sizes) <= 270
    assert read.agg(F.count_distinct("id")).first()[0] == read.count() == 2000
    assert read_table(spark, url, "gaps", DERBY, key="k", rows_per_task=250, max_tasks=3).count() == 2000


def test_an_export_that_comes_late_takes_nothing_back(spark):
    spark._jvm.java.lang.System.setProperty("derby.stream.error.file", os.devnull)
    url = "jdbc:derby:memory:fence;create=true"

    def export(token, *rows):
        df = frame(spark, rows, "month string, total long")
        return replace_months(df, url, "mart", DERBY, "month", [r[0] for r in rows], token)

    def state():
        return as_text(spark.read.jdbc(url, "mart", properties=DERBY))

    assert export(5, ("2023-03", 10), (None, 3)) == ["2023-03", None]
    # The older state comes after the newer one: only the month that the newer one has not touched is taken.
    assert export(4, ("2023-03", 1), (None, 2), ("2023-04", 7)) == ["2023-04"]
    assert state() == [(None, "3"), ("2023-03", "10"), ("2023-04", "7")]
    assert export(5, ("2023-03", 10)) == ["2023-03"] and export(6, ("2023-04", 8)) == ["2023-04"]
    assert state() == [(None, "3"), ("2023-03", "10"), ("2023-04", "8")]
    # No staging table is left.
    tables = spark.read.jdbc(url, "(SELECT TABLENAME FROM SYS.SYSTABLES WHERE TABLETYPE = 'T') t", properties=DERBY)
    assert sorted(r[0] for r in tables.collect()) == ["MART", "MART_EXPORTS"]
