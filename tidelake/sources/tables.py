"""Catalog tables, literal rows and temporary views."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession, types as T


def read_table(spark: SparkSession, name: str, database: str | None = None) -> DataFrame:
    """A catalog table; location, format and schema come from the catalog."""
    return spark.table(f"{database}.{name}" if database else name)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    column: str,
    lower: int,
    upper: int,
    partitions: int,
    **options,
) -> DataFrame:
    """A relational table, read in parallel ranges of a numeric column.

    The bounds only place the cuts; rows outside them are read too.
    """
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn=column)
        .options(lowerBound=lower, upperBound=upper, numPartitions=partitions)
        .options(**options)
        .load()
    )


def literal_rows(spark: SparkSession, rows: Iterable[tuple], schema: T.StructType | str) -> DataFrame:
    """Rows written in the program, such as a small rule table."""
    return spark.createDataFrame(list(rows), schema)


def register_views(views: Mapping[str, DataFrame]) -> None:
    """Give DataFrames a name for later SQL; an older view of a name is replaced."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
