"""Dates, conditions and JSON text as column expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T


def quoted(name: str) -> Column:
    """Column by its exact name, also when the name holds a dot."""
    return F.col("`" + name.replace("`", "``") + "`")


def free_name(name: str, *tables: DataFrame) -> str:
    """``name``, with underscores until no column of the tables is called that, in any case."""
    taken = {column.lower() for table in tables for column in table.columns}
    while name.lower() in taken:
        name += "_"
    return name


def day_of(df: DataFrame, name: str) -> Column:
    """Date part of a column, named in any case; text that is no date gives null.

    A plain cast is kept for typed columns, so that a comparison with a day
    becomes a range on the raw column and reaches the Parquet reader.
    """
    if isinstance(df.select(quoted(name)).schema[0].dataType, T.StringType):
        return quoted(name).try_cast("date")
    return quoted(name).cast("date")


def cast_to_date(df: DataFrame, name: str) -> DataFrame:
    """Replace a column by its date; the time of day is dropped."""
    return df.withColumn(name, day_of(df, name))


def iso_text(day: Column) -> Column:
    """The day as ``yyyy-MM-dd``; the cast is cheaper than a format pattern."""
    return day.cast("date").cast("string")


def plus_days(moment: Column, days: int) -> Column:
    """Moment plus whole days, keeping the time of day and the type."""
    return moment + F.make_dt_interval(days=F.lit(days))


def value_where(column: Column, match, value: Column, name: str) -> Column:
    """``value`` where ``column`` equals ``match``, else null."""
    return F.when(column == F.lit(match), value).alias(name)


def spread(df: DataFrame, keep: Iterable[str], column: str, values: Iterable[str], value: str) -> DataFrame:
    """One conditional column per listed value, next to the kept columns."""
    wide = [value_where(quoted(column), v, quoted(value), str(v)) for v in values]
    return df.select(*map(quoted, keep), *wide)


def result_json(result: Column) -> Column:
    """``{"Result": …}`` with proper escaping."""
    return F.to_json(F.struct(result.alias("Result")))


def snake_names(df: DataFrame) -> DataFrame:
    """Lower snake case names: ``First Name`` becomes ``first_name``."""
    return df.toDF(*["_".join(name.strip().lower().split()) for name in df.columns])
