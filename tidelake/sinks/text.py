"""Text files that list the values of each source partition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# monotonically_increasing_id() holds the partition in its upper bits and the
# row's place within the partition in the lower 33.
_PLACE_BITS = 33


def partition_lines(df: DataFrame, value: Column, per_line: int = 1_000) -> DataFrame:
    """Rows ``partition, part, line``: the values of one partition in order, as a JSON array.

    A partition of any size is cut into lines of at most ``per_line`` values,
    so no task holds more than that in one row. :func:`line_values` reads a
    line back: any text, and null, comes out as it went in.
    """
    place = F.col("_place").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    numbered = df.select(
        value.cast("string").alias("_value"),
        F.monotonically_increasing_id().alias("_place"),
    )
    grouped = numbered.groupBy(
        F.shiftright("_place", _PLACE_BITS).cast("int").alias("partition"),
        F.floor(place / per_line).alias("part"),
    ).agg(F.sort_array(F.collect_list(F.struct("_place", "_value"))).alias("_values"))
    return grouped.select(
        "partition",
        "part",
        F.to_json(F.transform("_values", lambda v: v["_value"])).alias("line"),
    )


def line_values(line: Column) -> Column:
    """The array of texts that a line of :func:`partition_lines` holds."""
    return F.from_json(line, "array<string>")


def write_partition_lines(df: DataFrame, value: Column, path: str, per_line: int = 1_000) -> None:
    """Write :func:`partition_lines` as text files."""
    partition_lines(df, value, per_line).select("line").write.mode("overwrite").text(path)
