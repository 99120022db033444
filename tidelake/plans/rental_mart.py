"""Rental, payment and customer files to a partitioned mart."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidelake.operators.rental import rental_fact
from tidelake.sinks.partitioned import write_partitioned
from tidelake.sources.files import read_csv

ROLES = ("rental", "payment", "customer")


def build_mart(
    spark: SparkSession,
    files: Mapping[str, str],
    target: str,
    keys: Sequence[str] = ("store_id", "rental_dt"),
    schemas: Mapping[str, str] | None = None,
    mode: str = "overwrite",
) -> None:
    """Join the three CSV inputs and write the fact table below ``target``.

    ``files`` maps the roles to paths. Without a schema for a role its columns
    are text. The rental day stays in the files as ``rental_date`` and names
    the directory as ``rental_dt``. One job writes all partitions.
    """
    schemas = schemas or {}
    tables = {role: read_csv(spark, files[role], schema=schemas.get(role)) for role in ROLES}
    fact = rental_fact(tables["rental"], tables["payment"], tables["customer"])
    if "rental_dt" in keys:
        fact = fact.withColumn("rental_dt", F.col("rental_date"))
    write_partitioned(fact, target, list(keys), mode=mode)


def build_from_manifest(spark: SparkSession, manifest: DataFrame, root: str, target: str, **options) -> bool:
    """Run :func:`build_mart` if the one-row manifest names a file for every role.

    Keys are paths relative to ``root``. Returns whether the mart was built; an
    incomplete manifest starts nothing.
    """
    row = manifest.select(*ROLES).first()
    if row is None or any(row[role] is None for role in ROLES):
        return False
    build_mart(spark, {role: f"{root}/{row[role]}" for role in ROLES}, target, **options)
    return True
