from __future__ import annotations

import datetime
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidelake.sinks import tables as ddl
from tidelake.sinks.partitioned import compact, write_partitioned
from tidelake.sinks.text import line_values, partition_lines, write_partition_lines
from tidelake.sources.files import read_csv

SCHEMA = "id int, amount decimal(10,2), store_id int, rental_dt string"


def layout(spark, rows):
    return spark.createDataFrame(rows, "id int, amount double, store_id int, rental_dt string").withColumn(
        "amount", F.col("amount").cast("decimal(10,2)")
    )


def files(folder):
    found = {}
    for file in Path(folder).glob("*/*/part-*"):
        found.setdefault(f"{file.parent.parent.name}/{file.parent.name}", []).append(file)
    return found


@pytest.fixture
def sample(spark):
    return layout(spark, [(i, i / 4, i % 2, f"2007-02-{14 + i % 3}") for i in range(600)])


KEYS = ["store_id", "rental_dt"]


def test_one_file_per_directory_and_a_rerun_changes_nothing(spark, sample, tmp_path, rows):
    path = str(tmp_path / "lake")
    write_partitioned(sample.repartition(7), path, KEYS)
    write_partitioned(sample, path, KEYS)
    assert set(files(path)) == {f"store_id={s}/rental_dt=2007-02-{d}" for s in (0, 1) for d in (14, 15, 16)}
    assert {len(f) for f in files(path).values()} == {1}
    assert rows(spark.read.schema(SCHEMA).parquet(path)) == rows(sample)


def test_append_adds(spark, sample, tmp_path):
    path = str(tmp_path / "lake")
    write_partitioned(sample, path, KEYS, mode="append")
    write_partitioned(sample, path, KEYS, mode="append")
    assert spark.read.parquet(path).count() == 1200
    with pytest.raises(ValueError):
        write_partitioned(sample, path, KEYS, mode="errorifexists")


def test_overwrite_spares_other_partitions(spark, tmp_path, rows):
    path = str(tmp_path / "csv")
    write_partitioned(layout(spark, [(1, 1.0, 1, "a"), (2, 2.0, 2, "b")]), path, KEYS, file_format="csv")
    write_partitioned(layout(spark, [(9, 9.0, 2, "b")]), path, KEYS, file_format="csv")
    back = read_csv(spark, path, schema=SCHEMA)
    assert [(r[0], r[2]) for r in rows(back)] == [(1, 1), (9, 2)]


def test_null_partition_key_comes_back_as_null(spark, tmp_path, rows):
    path = str(tmp_path / "lake")
    write_partitioned(layout(spark, [(1, 1.0, 1, None), (2, 2.0, None, "b")]), path, KEYS)
    back = spark.read.schema(SCHEMA).parquet(path)
    assert [(r[0], r[2], r[3]) for r in rows(back)] == [(1, 1, None), (2, None, "b")]


def test_hot_partition_is_written_by_many_tasks(spark, tmp_path):
    path = str(tmp_path / "lake")
    wide = spark.range(200_000, numPartitions=8).select(
        F.md5(F.col("id").cast("string")).alias("text"),
        F.when(F.col("id") % 3 == 0, F.col("id") % 30).otherwise(0).alias("store_id"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        write_partitioned(wide, path, ["store_id"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    hot = list(Path(path).glob("store_id=0/part-*"))
    assert len(hot) > 1
    assert spark.read.parquet(path).count() == 200_000


def test_compaction_keeps_the_rows(spark, sample, tmp_path, rows):
    loose, tight = str(tmp_path / "loose"), str(tmp_path / "tight")
    sample.repartition(5).write.partitionBy(*KEYS).parquet(loose)
    assert {len(f) for f in files(loose).values()} == {5}
    compact(spark, loose, tight, KEYS)
    assert {len(f) for f in files(tight).values()} == {1}
    assert spark.read.parquet(tight).count() == 600


def test_compaction_keeps_directory_names(spark, tmp_path):
    df = spark.createDataFrame([(1, "01"), (2, "1"), (3, None), (4, "a/b")], "id int, store_id string")
    df.write.partitionBy("store_id").parquet(str(tmp_path / "loose"))
    compact(spark, str(tmp_path / "loose"), str(tmp_path / "tight"), ["store_id"])
    names = [sorted(p.name for p in (tmp_path / name).glob("store_id=*")) for name in ("loose", "tight")]
    assert names[0] == names[1]
    assert "store_id=01" in names[1]


def test_external_table_reads_empty_until_its_partitions_are_registered(spark, sample, tmp_path, rows):
    path = str(tmp_path / "ext")
    write_partitioned(sample, path, KEYS, file_format="csv", escape="\\")
    ddl.create_csv_table(spark, "ext_test", SCHEMA, KEYS, path)
    try:
        assert spark.table("ext_test").count() == 0
        ddl.recover_partitions(spark, "ext_test")
        assert rows(spark.table("ext_test")) == rows(sample)
        assert spark.sql("show partitions ext_test").count() == 6
        ddl.set_table_properties(spark, "ext_test", **{"skip.header.line.count": "1", "note": "it's \\ here"})
        stored = {r.key: r.value for r in spark.sql("show tblproperties ext_test").collect()}
        assert stored["skip.header.line.count"] == "1"
        assert stored["note"] == "it's \\ here"
    finally:
        spark.sql("drop table ext_test")


def test_table_names_are_checked(spark, tmp_path):
    with pytest.raises(ValueError):
        ddl.create_parquet_table(spark, "a; drop table b", "x int", str(tmp_path))


def test_insert_by_name_fills_missing_columns(spark, tmp_path, rows):
    ddl.create_parquet_table(spark, "ins_test", "id bigint, name string, born date", str(tmp_path / "t"))
    try:
        ddl.insert_rows(spark.createDataFrame([("a", 1)], "name string, id int"), "ins_test")
        ddl.insert_rows(
            spark.createDataFrame([(datetime.date(2024, 1, 1), 2)], "born date, id int"), "ins_test"
        )
        assert rows(spark.table("ins_test")) == [(1, "a", None), (2, None, datetime.date(2024, 1, 1))]
        with pytest.raises(ValueError):
            ddl.insert_rows(spark.createDataFrame([(1,)], "other int"), "ins_test")
    finally:
        spark.sql("drop table ins_test")


def test_partition_lines_are_in_order_whole_and_bounded(spark):
    df = spark.range(0, 25, numPartitions=2)
    lines = {(r.partition, r.part): json.loads(r.line) for r in partition_lines(df, F.col("id"), per_line=5).collect()}
    assert lines[(0, 0)] == ["0", "1", "2", "3", "4"]
    assert lines[(0, 2)] == ["10", "11"]
    assert lines[(1, 0)] == ["12", "13", "14", "15", "16"]
    assert sorted(int(v) for line in lines.values() for v in line) == list(range(25))


def test_any_text_survives_partition_lines(spark, tmp_path):
    texts = ["x", None, "null", "Lee, Ann", "two\nlines", 'a "quote"', "back\\slash", "", "é"]
    df = spark.createDataFrame([(t,) for t in texts], "v string").coalesce(1)
    write_partition_lines(df, F.col("v"), str(tmp_path / "out"), per_line=4)
    lines = spark.read.text(str(tmp_path / "out"))
    assert lines.count() == 3
    back = [r[0] for r in lines.select(F.explode(line_values(F.col("value")))).collect()]
    assert sorted(map(str, back)) == sorted(map(str, texts)) and back.count(None) == 1


def test_jdbc_tables_are_declared_with_their_options():
    text = ddl.jdbc_ddl("db.t", "jdbc:x://h/d?q='1'", "public.people", user="me")
    assert text == (
        "CREATE TABLE `db`.`t` USING jdbc OPTIONS (`url` 'jdbc:x://h/d?q=\\'1\\'', `dbtable` 'public.people', `user` 'me')"
    )
