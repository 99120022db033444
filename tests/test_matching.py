from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from tidelake.operators.matching import match_conflicts, match_growth, match_join
from tidelake.plans.patient_finder import (
    birth_date_growth,
    find_conflicts,
    find_matches,
    write_report,
)

D = datetime.date


@pytest.fixture
def files(spark):
    """Extract and master in their raw forms; people, numbers and days are invented.

    Of the shape of the recorded case: one match by birth date, two by identifier,
    and one of these in conflict, a two-digit year read a century apart.
    """
    extract = spark.createDataFrame(
        [("1988-03-02", "1000007"), ("1907-11-30", "700000021"), ("1990-07-07", "800000005"), ("1961-02-03", None), ("1990", " ")],
        "DOB string, ssn string",
    )
    master = spark.createDataFrame(
        [
            (1, "Ann", "Lee", "3/2/88", "001000007"),
            (2, "Bob", "Ray", "11/30/07", "700000021"),
            (3, "Cy", "Poe", "2/4/61", None),
            (4, "Di", "Fox", "7/8/90", "900000001"),
            (5, "Ed", "Orr", "", ""),
            (6, "Flo", "Kay", "1990-7", "N/A"),
        ],
        "id int, `First Name` string, `Last Name` string, DOB string, SSN string",
    )
    return extract, master


def test_finder_matches_after_normalising(files, rows):
    matches = find_matches(*files)
    assert matches.columns == [".dob", ".ssn", "id", "first_name", "last_name", "dob", "ssn"]
    assert [(r[0], r[2], r[5]) for r in rows(matches)] == [
        (D(1907, 11, 30), 2, D(2007, 11, 30)), (D(1988, 3, 2), 1, D(1988, 3, 2))
    ]


def test_finder_conflict_carries_both_dates(files):
    (row,) = find_conflicts(*files).collect()
    assert (row["id"], row[".dob"], row["dob"]) == (2, D(1907, 11, 30), D(2007, 11, 30))


def test_the_recorded_counts_hold_for_invented_rows(files):
    by_day = birth_date_growth(*files).selectExpr("key", "cast(pairs as int)").collect()
    assert [tuple(r) for r in by_day] == [(D(1988, 3, 2), 1)]
    assert (len(by_day), find_matches(*files).count(), find_conflicts(*files).count()) == (1, 2, 1)


def test_blank_and_wrong_identifiers_match_nothing(spark):
    extract = spark.createDataFrame([("1988-03-02", s) for s in ("", "  ", "N/A", None, "12-3")], "DOB string, ssn string")
    master = extract.withColumnRenamed("ssn", "SSN")
    assert find_matches(extract, master).count() == 0


def test_finder_report_from_files(spark, tmp_path, rows):
    (tmp_path / "e.csv").write_bytes("\ufeffDOB,ssn\n1988-03-02,1000007\n1907-11-30,700000021\n".encode())
    (tmp_path / "m.csv").write_bytes(
        "\ufeffFirst Name,Last Name,DOB,SSN\nAnn,Lee,3/2/88,1000007\nBob,Ray,11/30/07,700000021\n".encode()
    )
    write_report(spark, str(tmp_path / "e.csv"), str(tmp_path / "m.csv"), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out/by_ssn")).count() == 2
    assert [r["first_name"] for r in spark.read.parquet(str(tmp_path / "out/conflicts")).collect()] == ["Bob"]
    assert spark.read.parquet(str(tmp_path / "out/by_dob")).count() == 1


def test_repeating_key_gives_every_pair_and_null_none(spark, rows):
    left = spark.createDataFrame([(1, "a"), (2, "a"), (3, None)], "id int, k string")
    right = spark.createDataFrame([("a", 7), ("a", 8), (None, 9)], "k string, n int")
    joined = match_join(left, right, "k", "k")
    assert joined.columns == ["id", ".k", "k", "n"]
    assert [(r[0], r[3]) for r in rows(joined)] == [(1, 7), (1, 8), (2, 7), (2, 8)]
    growth = match_growth(left, right, "k", "k")
    assert rows(growth) == [("a", 2, 2, 4)]
    assert growth.agg(F.sum("pairs")).first()[0] == joined.count()


def test_names_collide_in_any_case_and_keys_may_differ(spark):
    left = spark.createDataFrame([(1, 2)], "ID int, ref int")
    right = spark.createDataFrame([(2, 5)], "id int, x int")
    joined = match_join(left, right, "ref", "id")
    assert joined.columns == [".ID", "ref", "id", "x"]
    assert tuple(joined.first()) == (1, 2, 2, 5)


def test_conflicts_equal_the_set_difference(spark, rows):
    left = spark.createDataFrame(
        [(1, 1), (1, 1), (2, 5), (3, None), (4, 4), (None, 1), (2, 5)], "id int, attr int"
    )
    right = spark.createDataFrame(
        [(1, 1, "a"), (1, 2, "b"), (2, 6, "c"), (3, None, "d"), (3, 3, "e"), (4, 4, "f"), (2, 6, "c")],
        "id int, attr int, name string",
    )
    expected = match_join(left, right, "id", "id").subtract(match_join(left, right, "attr", "attr"))
    assert rows(match_conflicts(left, right, "id", "attr")) == rows(expected)
    assert expected.count() == 4
