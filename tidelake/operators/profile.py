"""Counts, schema and partition reports."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def schema_report(df: DataFrame) -> DataFrame:
    """One row per column: ``position, name, type, nullable`` and the table's row count."""
    columns = F.array(*[
        F.struct(
            F.lit(field.name).alias("name"),
            F.lit(field.dataType.simpleString()).alias("type"),
            F.lit(field.nullable).alias("nullable"),
        )
        for field in df.schema
    ])
    return row_count(df).select("rows", F.posexplode(columns).alias("position", "column")).select(
        "position", "column.name", "column.type", "column.nullable", "rows"
    )


def partition_profile(df: DataFrame) -> DataFrame:
    """``partition, rows`` for every partition that holds rows."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count(F.lit(1)).alias("rows"))


def skew_report(df: DataFrame, columns: list[str], share: float = 0.01) -> DataFrame:
    """``column, value, rows``: every value that at least ``share`` of all rows hold, with its exact count.

    A frequent-items summary of each column, some ``16 / share`` counters that merge
    without a shuffle of the rows, names the candidates: its error is below half of the
    share, so that no such value is missing. A second pass counts just these. Values are
    given as text; a null is a value like others.
    """
    if not 2e-5 <= share <= 1:
        raise ValueError("share must lie between 0.00002 and 1")
    counters, most = 1 << math.ceil(math.log2(16 / share)), math.ceil(2 / share)
    # An empty text and a null stay apart by the letter before.
    texts = [F.when(F.col(c).isNull(), "n").otherwise(F.concat(F.lit("v"), F.col(c).cast("string"))).alias(f"_{i}") for i, c in enumerate(columns)]
    rows = df.select(*texts)
    tops = rows.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.expr(f"approx_top_k(_{i}, {most}, {counters})").alias(f"_{i}") for i in range(len(columns))],
    )

    def listed(i: int):
        return F.transform(f"_{i}", lambda t: F.struct(F.lit(i).alias("at"), t["item"].alias("item")))

    candidates = tops.select("total", F.inline(F.flatten(F.array(*map(listed, range(len(columns)))))))
    cells = rows.select(F.inline(F.array(*[F.struct(F.lit(i).alias("at"), F.col(f"_{i}").alias("item")) for i in range(len(columns))])))
    counted = cells.join(candidates, ["at", "item"]).groupBy("at", "item", "total").agg(F.count(F.lit(1)).alias("rows"))
    held = counted.filter(F.col("rows") >= F.col("total") * share)
    names = F.array(*map(F.lit, columns))
    value = F.when(F.col("item").startswith("v"), F.expr("substring(item, 2)"))
    return held.select(names[F.col("at")].alias("column"), value.alias("value"), "rows")
