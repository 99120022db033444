"""Bring birth dates and identifiers of two files to one form."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The year from which a two-digit year counts as 19xx. Known examples allow
# any value from 24 to 74; with this one nobody is born in the future.
CENTURY_CUT = 25

# Width of the identifier before a reader took it for a number.
IDENTIFIER_WIDTH = 9


def short_date(text: Column, cut: int = CENTURY_CUT) -> Column:
    """``M/d/yy`` or ``M/d/yyyy`` text as a date; anything else, or an impossible day, is null."""
    trimmed = F.trim(text)
    year = F.substring_index(trimmed, "/", -1)
    century = F.when(F.length(year) == 4, "").when(year.try_cast("int") >= F.lit(cut), "19").otherwise("20")
    long_form = F.concat(F.substring_index(trimmed, "/", 2), F.lit("/"), century, year)
    return F.when(
        trimmed.rlike(r"^\d{1,2}/\d{1,2}/(\d{2}|\d{4})$"), F.try_to_date(long_form, "M/d/yyyy")
    )


def iso_date(text: Column) -> Column:
    """``yyyy-MM-dd`` text, with or without a time of day; partial dates and others are null."""
    trimmed = F.trim(text)
    day = F.try_to_date(F.substring(trimmed, 1, 10), "yyyy-MM-dd")
    return F.when(trimmed.rlike(r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}(:\d{2}(\.\d+)?)?)?$"), day)


def birth_date(text: Column, cut: int = CENTURY_CUT) -> Column:
    """A date from ISO, ``M/d/yy`` or ``M/d/yyyy`` text."""
    return F.coalesce(iso_date(text), short_date(text, cut))


def identifier(text: Column, width: int = IDENTIFIER_WIDTH) -> Column:
    """Digits with their lost leading zeros; more digits are kept whole.

    Blank text and text with anything but digits is null, so that it matches nothing.
    """
    trimmed = F.trim(text.cast("string"))
    padded = F.when(F.length(trimmed) < width, F.lpad(trimmed, width, "0")).otherwise(trimmed)
    return F.when(trimmed.rlike("^[0-9]+$"), padded)
