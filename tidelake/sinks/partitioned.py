"""Write a DataFrame as a directory tree ``key=value/…`` in one job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

from tidelake.sources.files import MOMENT_FORMAT


def write_partitioned(
    df: DataFrame,
    path: str,
    keys: list[str],
    file_format: str = "parquet",
    mode: str = "overwrite",
    **options,
) -> None:
    """One job for all partitions.

    ``overwrite`` replaces just the partitions present in ``df``, so a re-run
    leaves no duplicates; ``append`` adds files.

    The rebalance hint brings the rows of a partition together, which gives
    one file per directory, and lets adaptive execution cut a partition beyond
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` into several files:
    a partition with a third of all rows is still written by many tasks.
    """
    if mode not in ("overwrite", "append"):
        raise ValueError("mode must be overwrite or append")
    writer = df.hint("rebalance", *keys).write.format(file_format).mode(mode).partitionBy(*keys)
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if file_format == "csv":
        writer = writer.option("header", True).option("timestampNTZFormat", MOMENT_FORMAT)
    writer.options(**options).save(path)


def compact(spark: SparkSession, source: str, target: str, keys: list[str]) -> None:
    """Rewrite a Parquet layout with one file per directory, hot ones cut by size.

    The keys are read as text, so that a directory such as ``store_id=01``
    keeps its name.
    """
    stored = spark.read.parquet(source).schema
    as_text = T.StructType([
        T.StructField(field.name, T.StringType() if field.name in keys else field.dataType)
        for field in stored
    ])
    write_partitioned(spark.read.schema(as_text).parquet(source), target, keys)
