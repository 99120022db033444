"""CSV and text readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

# Six fraction digits: the default of three would cut microseconds.
MOMENT_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

# Options for CSV files whose texts may hold anything but the control character
# that ends a record: files stay splittable, and quotes are doubled. To be given
# to the writer, the reader and the table alike.
ANY_TEXT = {
    "lineSep": "\x1e",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str | None = None,
    infer: bool = False,
    **options,
) -> DataFrame:
    """CSV with a header line.

    Without ``schema`` every column is text. ``infer=True`` reads the files
    once more for the types, and turns digit-only identifiers into numbers
    (leading zeros are lost); a schema avoids both.
    """
    if schema is not None and infer:
        raise ValueError("give a schema or ask for inference, not both")
    reader = spark.read.option("header", True).option("inferSchema", infer)
    reader = reader.option("timestampNTZFormat", MOMENT_FORMAT).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row ``value`` per line of text."""
    return spark.read.text(path)
