"""Find the rows of an extract in a master table, and where the two disagree."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidelake.functions.columns import snake_names
from tidelake.functions.match_keys import CENTURY_CUT, birth_date, identifier
from tidelake.operators.matching import match_conflicts, match_growth, match_join
from tidelake.sources.files import read_csv


def normalised(people: DataFrame, cut: int = CENTURY_CUT) -> DataFrame:
    """Snake case names, ``dob`` as a date and ``ssn`` as nine-digit text."""
    renamed = snake_names(people)
    return renamed.withColumns(
        {"dob": birth_date(F.col("dob").cast("string"), cut), "ssn": identifier(F.col("ssn"))}
    )


def find_matches(extract: DataFrame, master: DataFrame, cut: int = CENTURY_CUT) -> DataFrame:
    """Extract rows with the master row of the same ``ssn``."""
    return match_join(normalised(extract, cut), normalised(master, cut), "ssn", "ssn")


def birth_date_growth(extract: DataFrame, master: DataFrame, cut: int = CENTURY_CUT) -> DataFrame:
    """How many pairs of an extract and a master row with the same ``dob`` there are per day.

    They are counted and not built, as they grow with the product of both files.
    """
    return match_growth(normalised(extract, cut), normalised(master, cut), "dob", "dob")


def find_conflicts(extract: DataFrame, master: DataFrame, cut: int = CENTURY_CUT) -> DataFrame:
    """Matches on ``ssn`` whose ``dob`` differs or is missing."""
    return match_conflicts(normalised(extract, cut), normalised(master, cut), "ssn", "dob")


def write_report(
    spark: SparkSession, extract: str, master: str, target: str, cut: int = CENTURY_CUT
) -> None:
    """Read both CSV files as text and write matches and conflicts as Parquet.

    Below ``target``: ``by_ssn``, ``conflicts`` and ``by_dob``, the last as
    counts per day, because the pairs of equal birth dates grow with the
    product of both files.
    """
    ours, theirs = read_csv(spark, extract), read_csv(spark, master)
    results = {
        "by_ssn": find_matches(ours, theirs, cut),
        "conflicts": find_conflicts(ours, theirs, cut),
        "by_dob": birth_date_growth(ours, theirs, cut),
    }
    for name, result in results.items():
        result.write.mode("overwrite").parquet(f"{target}/{name}")
