"""Reports as whole jobs: the profile of the rentals, and a pivot with its text form."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidelake.functions.columns import iso_text
from tidelake.operators import rental as ops
from tidelake.operators.profile import schema_report
from tidelake.operators.reshape import pivot_max
from tidelake.plans.rental_mart import ROLES
from tidelake.sinks.text import write_partition_lines
from tidelake.sources.files import read_csv


def rental_profile(rental: DataFrame, payment: DataFrame, customer: DataFrame) -> dict[str, DataFrame]:
    """``schema`` of the joined table, its (store, day) ``partitions`` with their
    ``counts``, and the ``latest`` day of each store."""
    partitions = ops.mart_partitions(rental, payment, customer)
    return {
        "schema": schema_report(ops.rental_wide(rental, payment, customer)),
        "partitions": partitions,
        "counts": ops.distinct_counts(partitions, "store_id", "rental_date"),
        "latest": ops.latest_day_per_store(rental, payment, customer),
    }


def write_rental_profile(
    spark: SparkSession, files: Mapping[str, str], target: str, schemas: Mapping[str, str] | None = None
) -> None:
    """Read the three CSV inputs and write each part of the profile below ``target``."""
    schemas = schemas or {}
    tables = [read_csv(spark, files[role], schema=schemas.get(role)) for role in ROLES]
    for name, result in rental_profile(*tables).items():
        result.write.mode("overwrite").parquet(f"{target}/{name}")


def profile_rows(rental: DataFrame, payment: DataFrame, customer: DataFrame) -> DataFrame:
    """Counts and latest days as rows ``measure, store_id, value``."""
    found = rental_profile(rental, payment, customer)
    counts = F.array(*[
        F.struct(F.lit(name).alias("measure"), F.col(name).cast("string").alias("value"))
        for name in ("pairs", "store_id_values", "rental_date_values")
    ])
    numbers = found["counts"].select(F.inline(counts)).select(
        "measure", F.lit(None).cast("int").alias("store_id"), "value"
    )
    latest = found["latest"].select(
        F.lit("latest").alias("measure"), F.col("store_id").cast("int").alias("store_id"), iso_text(F.col("rental_date")).alias("value")
    )
    return numbers.unionByName(latest)


def write_pivot(df: DataFrame, key: str, column: str, value: str, target: str) -> None:
    """The wide table of greatest values below ``target/wide``, and its rows as text
    lines, one JSON array of JSON objects for each part of a partition, in ``target/lines``."""
    pivot_max(df, key, column, value).write.mode("overwrite").parquet(f"{target}/wide")
    stored = df.sparkSession.read.parquet(f"{target}/wide")
    row = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    write_partition_lines(stored, row, f"{target}/lines")
