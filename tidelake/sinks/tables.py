"""External tables over files, partition registration and inserts."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidelake.sources.files import MOMENT_FORMAT

ESCAPE = "\\"
_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)*")


def _checked(name: str) -> str:
    if not _NAME.fullmatch(name):
        raise ValueError(f"not a table name: {name!r}")
    return ".".join(f"`{part}`" for part in name.split("."))


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_csv_table(
    spark: SparkSession, name: str, columns: str, partitions: list[str], location: str, **options: str
) -> None:
    """External table over CSV files with a header line and ``\\`` as escape.

    ``options`` are added to these, such as ``ANY_TEXT`` of the reader.

    ``columns`` is a DDL list such as ``"rental_id INT, amount DECIMAL(10,2)"``
    and names the partition columns too. Partitions that exist as directories
    are seen after :func:`recover_partitions`.
    """
    given = {"header": "true", "escape": ESCAPE, "timestampNTZFormat": MOMENT_FORMAT, **options}
    listed = ", ".join(f"{key} {_text(value)}" for key, value in given.items())
    spark.sql(
        f"CREATE TABLE {_checked(name)} ({columns}) USING csv OPTIONS ({listed}) "
        f"PARTITIONED BY ({', '.join(_checked(p) for p in partitions)}) "
        f"LOCATION {_text(location)}"
    )


def create_parquet_table(spark: SparkSession, name: str, columns: str, location: str) -> None:
    """External Parquet table."""
    spark.sql(
        f"CREATE TABLE {_checked(name)} ({columns}) USING parquet LOCATION {_text(location)}"
    )


def create_jdbc_table(spark: SparkSession, name: str, url: str, table: str, **options: str) -> None:
    """Catalog table over a table of a relational database; its columns come from there.

    ``options`` are those of the reader, such as ``user`` or ``partitionColumn``.
    """
    spark.sql(jdbc_ddl(name, url, table, **options))


def jdbc_ddl(name: str, url: str, table: str, **options: str) -> str:
    given = {"url": url, "dbtable": table, **options}
    listed = ", ".join(f"{_checked(key)} {_text(str(value))}" for key, value in given.items())
    return f"CREATE TABLE {_checked(name)} USING jdbc OPTIONS ({listed})"


def recover_partitions(spark: SparkSession, name: str) -> None:
    """Register every ``key=value`` directory below the table's location."""
    spark.catalog.recoverPartitions(name)


def set_table_properties(spark: SparkSession, name: str, **properties: str) -> None:
    listed = ", ".join(f"{_text(k)} = {_text(v)}" for k, v in properties.items())
    spark.sql(f"ALTER TABLE {_checked(name)} SET TBLPROPERTIES ({listed})")


def insert_rows(rows: DataFrame, name: str) -> None:
    """Append rows by column name; table columns that ``rows`` lacks become null."""
    target = rows.sparkSession.table(name)
    unknown = set(rows.columns) - set(target.columns)
    if unknown:
        raise ValueError(f"{name} has no column {sorted(unknown)}")
    rows.select(*[
        (F.col(field.name) if field.name in rows.columns else F.lit(None))
        .cast(field.dataType)
        .alias(field.name)
        for field in target.schema
    ]).write.insertInto(name)
    rows.sparkSession.catalog.refreshTable(name)
