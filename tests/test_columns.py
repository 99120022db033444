from __future__ import annotations

import datetime
import json

from pyspark.sql import functions as F

from tidelake.functions.columns import (
    cast_to_date,
    iso_text,
    plus_days,
    result_json,
    snake_names,
    spread,
)
from tidelake.functions.match_keys import birth_date, identifier, short_date

D = datetime.date


def test_text_that_is_no_date_becomes_null(spark):
    df = spark.createDataFrame(
        [("2007-02-14 21:21:59.996577",), ("2007-02-14",), ("2007-02-31",), ("soon",), (None,)], "d string"
    )
    assert [r.d for r in cast_to_date(df, "d").collect()] == [D(2007, 2, 14)] * 2 + [None] * 3


def test_typed_columns_keep_a_plain_cast(spark):
    df = spark.sql("select timestamp_ntz '2007-02-14 23:59:59.999999' as d")
    assert cast_to_date(df, "d").first().d == D(2007, 2, 14)


def test_day_filter_on_a_moment_becomes_a_range(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    day = cast_to_date(df, "o_orderdate").filter(F.col("o_orderdate") == F.lit(D(1998, 2, 6)))
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan


def test_iso_text_and_interval(spark):
    df = spark.sql("select timestamp_ntz '2024-02-27 10:30:00.000001' as t")
    row = df.select(iso_text(F.col("t")).alias("day"), plus_days(F.col("t"), 4).alias("due")).first()
    assert row.day == "2024-02-27"
    assert row.due == datetime.datetime(2024, 3, 2, 10, 30, 0, 1)


def test_spread_keeps_unmatched_and_null_as_null(spark, rows):
    df = spark.createDataFrame([(1, "a", 5), (2, "b", 6), (3, None, 7), (4, "a", None)], "id int, k string, v int")
    assert rows(spread(df, ["id"], "k", ["a", "b"], "v")) == [
        (1, 5, None), (2, None, 6), (3, None, None), (4, None, None)
    ]


def test_result_json_escapes(spark):
    df = spark.createDataFrame([('a "quoted"\\ line\n',)], "x string")
    text = df.select(result_json(F.col("x")).alias("j")).first().j
    assert json.loads(text) == {"Result": 'a "quoted"\\ line\n'}


def test_snake_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`First Name` int, `DOB` int, ` ssn ` int")
    assert snake_names(df).columns == ["first_name", "dob", "ssn"]


def test_short_dates(spark):
    texts = ["3/2/88", "11/30/07", "12/1/24", "12/1/25", "2/29/00", "2/30/01", "13/1/01", "1988-03-02", "x", None, "03/02/1988", "1/1/198"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r.d for r in df.select(short_date(F.col("t")).alias("d")).collect()] == [
        D(1988, 3, 2), D(2007, 11, 30), D(2024, 12, 1), D(1925, 12, 1), D(2000, 2, 29),
        None, None, None, None, None, D(1988, 3, 2), None,
    ]
    early = df.select(short_date(F.col("t"), cut=0).alias("d")).collect()
    assert early[1].d == D(1907, 11, 30)
    assert early[4].d is None  # 1900 had no 29 February


def test_birth_date_takes_whole_dates_only(spark):
    whole = ["1988-03-02", "3/2/88", " 3/2/88 ", "03/02/1988", "1988-03-02 10:11:12", "1988-03-02T10:11"]
    wrong = ["2.3.88", "1988", "1988-3", "12345", "1988-03-02 xyz", "1988-02-30", "", " ", None]
    df = spark.createDataFrame([(t,) for t in whole + wrong], "t string")
    found = [r.d for r in df.select(birth_date(F.col("t")).alias("d")).collect()]
    assert found == [D(1988, 3, 2)] * len(whole) + [None] * len(wrong)


def test_no_birth_date_lies_in_the_future(spark):
    df = spark.range(100).select(F.format_string("1/1/%02d", F.col("id")).alias("t"))
    assert max(r.d for r in df.select(birth_date(F.col("t")).alias("d")).collect()) < D.today()


def test_dates_are_found_in_any_case(spark):
    df = spark.createDataFrame([("2024-01-02 03:04:05",)], "Rental_Date string")
    assert cast_to_date(df, "rental_date").first()[0] == D(2024, 1, 2)


def test_wrong_identifiers_are_null(spark):
    df = spark.createDataFrame([("",), ("  ",), ("N/A",), ("12-3",), (" 12 ",)], "t string")
    assert [r[0] for r in df.select(identifier(F.col("t"))).collect()] == [None] * 4 + ["000000012"]


def test_identifier_gets_its_zeros_back_and_is_never_cut(spark):
    df = spark.createDataFrame([("1234567",), ("123456789",), ("12345678901",), (None,)], "t string")
    assert [r.i for r in df.select(identifier(F.col("t")).alias("i")).collect()] == [
        "001234567", "123456789", "12345678901", None
    ]
    numbers = spark.createDataFrame([(1234567,)], "t long")
    assert numbers.select(identifier(F.col("t"))).first()[0] == "001234567"
