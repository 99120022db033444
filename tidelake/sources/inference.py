"""Types of text columns, found in one aggregation that never loses a text.

Each value has the narrowest kind whose column gives it back; kinds are joined by a lattice:

    bigint < decimal(p, s) < double      date < timestamp_ntz      boolean

and everything that meets outside one of these chains is text. So is a value with a leading
zero or plus, blanks around it, a negative zero, or a day that does not exist. Nulls fit
every kind; a column without a value is text. Beyond 18 digits a whole number is a decimal,
and a number beyond 38 digits is text. A double is only met where an exponent is written.
What is kept of a column are a few flags and lengths, so that parts of any size merge before
the one shuffle, whose result is a single row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidelake.sources.files import read_csv

_WHOLE = r"^(0|-?[1-9][0-9]*)\z"
_FRACTION = r"^(0|-?[1-9][0-9]*|-0(?=\.0*[1-9]))\.[0-9]+\z"
_EXPONENT = r"^-?[0-9](\.[0-9]{1,15})?[eE][+-]?[0-9]{1,2}\z"
_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
_MOMENT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?\z"
_BOOLEAN = r"^(true|false)\z"

_MOST_DIGITS = 38
_BIGINT_DIGITS = 18
# Whole digits that a double tells apart.
_DOUBLE_DIGITS = 15


def _named(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _facts(value: Column) -> Column:
    """Flags over all values of a column, and the most digits on either side of the point."""
    whole, fraction = value.rlike(_WHOLE), value.rlike(_FRACTION)
    date = value.rlike(_DATE) & value.try_cast("date").isNotNull()
    moment = value.rlike(_MOMENT) & value.try_cast("timestamp_ntz").isNotNull()
    number = F.when(whole | fraction, value)
    # A lone zero before the point takes no digit of a decimal.
    before = F.length(F.regexp_replace(F.substring_index(number, ".", 1), "^-?0?", ""))
    after = F.when(fraction, F.length(F.substring_index(value, ".", -1))).otherwise(0)

    def every(test: Column) -> Column:
        return F.coalesce(F.bool_and(F.when(value.isNotNull(), test)), F.lit(True))

    return F.struct(
        F.count(value).alias("filled"),
        every(whole).alias("whole"),
        every(whole | fraction).alias("exact"),
        every(whole | fraction | value.rlike(_EXPONENT)).alias("number"),
        every(date).alias("date"),
        every(date | moment).alias("moment"),
        every(value.rlike(_BOOLEAN)).alias("boolean"),
        F.coalesce(F.max(before), F.lit(0)).alias("before"),
        F.coalesce(F.max(F.when(number.isNotNull(), after)), F.lit(0)).alias("after"),
    )


def _type(facts: Column) -> Column:
    """The lattice: the least type that holds every value."""
    digits = F.greatest(facts["before"] + facts["after"], F.lit(1))
    exact = F.format_string("decimal(%d,%d)", digits, facts["after"])
    return (
        F.when(facts["filled"] == 0, "string")
        .when(facts["whole"] & (facts["before"] <= _BIGINT_DIGITS), "bigint")
        .when(facts["exact"] & (digits <= _MOST_DIGITS), exact)
        .when(facts["number"] & ~facts["exact"] & (digits <= _DOUBLE_DIGITS), "double")
        .when(facts["date"], "date")
        .when(facts["moment"], "timestamp_ntz")
        .when(facts["boolean"], "boolean")
        .otherwise("string")
    )


def infer_types(texts: DataFrame) -> DataFrame:
    """``column``, ``type`` and ``filled`` (values that are not null) of each column of text.

    One row per column, in no order. Columns of other types have the type that they have.
    """
    if not texts.columns:
        raise ValueError("there is no column")
    kinds = [(field.name, field.dataType.simpleString()) for field in texts.schema]
    facts = [
        _facts(_named(name)) if kind == "string" else F.struct(F.count(_named(name)).alias("filled"))
        for name, kind in kinds
    ]
    seen = texts.agg(*[fact.alias(f"c{at}") for at, fact in enumerate(facts)])
    rows = [
        F.struct(
            F.lit(name).alias("column"),
            (_type(F.col(f"c{at}")) if kind == "string" else F.lit(kind)).alias("type"),
            F.col(f"c{at}.filled").alias("filled"),
        )
        for at, (name, kind) in enumerate(kinds)
    ]
    return seen.select(F.inline(F.array(*rows)))


def typed(texts: DataFrame) -> DataFrame:
    """The columns of text in their inferred types, which hold every value.

    Infers first, with one scan of ``texts``; the result is a cast above another one.
    """
    types = {row["column"]: row["type"] for row in infer_types(texts).collect()}  # a row per column
    return texts.select(*[_named(name).cast(types[name]).alias(name) for name in texts.columns])


def read_csv_typed(spark: SparkSession, path: str | list[str], **options) -> DataFrame:
    """CSV with a header line, in types that lose nothing; see :func:`infer_types`."""
    return typed(read_csv(spark, path, **options))
