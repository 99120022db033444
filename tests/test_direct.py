"""Plain Spark calls that jobs use as they are."""

from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F


@pytest.fixture
def people(spark):
    return spark.createDataFrame([("Tom", 80, "1"), ("Alice", 100, "01")], "name string, height long, store_id string")


def test_projection_by_list_and_drop(people):
    assert people.select(["name", "height"]).columns == ["name", "height"]
    assert people.drop("height", "absent").columns == ["name", "store_id"]


def test_first_field_of_each_row(people):
    assert sorted(r[0] for r in people.select("name").collect()) == ["Alice", "Tom"]


def test_foreach_runs_for_every_row(spark, people):
    seen = spark.sparkContext.accumulator(0)
    people.foreach(lambda row: seen.add(row.height))
    assert seen.value == 180


def test_show_and_schema_print(people, capsys):
    people.show()
    people.printSchema()
    printed = capsys.readouterr().out
    assert "Alice" in printed and "height: long" in printed


def test_typed_comparison_instead_of_an_implicit_one(spark, people):
    assert people.filter(F.col("store_id") == 1).count() == 2  # text is read as a number
    typed = people.withColumn("store_id", F.col("store_id").try_cast("int"))
    assert typed.filter(F.col("store_id") == 1).count() == 2


def test_a_replaced_view_is_seen_by_later_sql(spark, people):
    people.createOrReplaceTempView("direct_people")
    assert spark.sql("select * from direct_people").count() == 2
    people.limit(1).createOrReplaceTempView("direct_people")
    assert spark.sql("select * from direct_people").count() == 1
    spark.catalog.dropTempView("direct_people")
    with pytest.raises(AnalysisException):
        spark.table("direct_people")


def test_values_go_into_sql_as_arguments(spark, people):
    people.createOrReplaceTempView("direct_people")
    found = spark.sql("select * from direct_people where name = :name", args={"name": "Tom' or '1'='1"})
    assert found.count() == 0
