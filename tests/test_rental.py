from __future__ import annotations

import datetime

import pytest

from tidelake.operators import rental as ops

D = datetime.date


@pytest.fixture
def tables(spark):
    rental = spark.createDataFrame(
        [
            (1, 10, "2005-05-24 22:53:30"),
            (2, 10, "2005-05-25 01:00:00"),
            (3, 11, "2005-05-24 08:00:00"),
            (4, 12, "no date"),
            (5, None, "2005-05-24 00:00:00"),
            (6, 99, "2005-05-24 00:00:00"),
            (7, 10, "2005-05-30 00:00:00"),
        ],
        "rental_id int, customer_id int, rental_date string",
    )
    payment = spark.createDataFrame(
        [(1, 10, "p1", 2.99), (1, 10, "p2", 0.99), (2, 10, "p3", 1.0), (3, 11, "p4", 4.0), (4, 12, "p5", 5.0),
         (5, None, "p6", 6.0), (6, 99, "p7", 7.0), (None, 10, "p8", 8.0)],
        "rental_id int, customer_id int, payment_date string, amount double",
    )
    customer = spark.createDataFrame([(10, 1), (11, 2), (12, 2), (13, 3)], "customer_id int, store_id int")
    return rental, payment, customer


def test_fact_fans_out_payments_and_drops_the_unmatched(tables, rows):
    assert rows(ops.rental_fact(*tables)) == [
        (1, "2005-05-24", "p1", 2.99),
        (1, "2005-05-24", "p2", 0.99),
        (1, "2005-05-25", "p3", 1.0),
        (2, None, "p5", 5.0),
        (2, "2005-05-24", "p4", 4.0),
    ]


def test_slice(tables, rows):
    assert rows(ops.fact_slice(*tables, 1, D(2005, 5, 24))) == [
        (1, "2005-05-24", "p1", 2.99), (1, "2005-05-24", "p2", 0.99)
    ]


def test_wide_names_are_unambiguous(tables):
    wide = ops.rental_wide(*tables)
    assert wide.columns == [
        "rental_id", "rental_customer_id", "rental_date",
        "payment_rental_id", "payment_customer_id", "payment_date", "amount",
        "customer_id", "store_id",
    ]
    assert wide.count() == 5
    assert dict(wide.dtypes)["rental_date"] == "date"


def test_sorted_ascending_with_nulls_first(tables):
    wide = ops.rental_wide(*tables)
    ordered = ops.sorted_by_store(wide, ["rental_id", "payment_date"]).select("store_id", "rental_date", "payment_date")
    assert [tuple(r) for r in ordered.collect()] == [
        (1, D(2005, 5, 24), "p1"),
        (1, D(2005, 5, 24), "p2"),
        (1, D(2005, 5, 25), "p3"),
        (2, None, "p5"),
        (2, D(2005, 5, 24), "p4"),
    ]


def test_partitions_equal_those_of_the_fact(tables, rows):
    pairs = ops.mart_partitions(*tables)
    assert rows(pairs.selectExpr("store_id", "cast(rental_date as string)")) == rows(
        ops.rental_fact(*tables).select("store_id", "rental_date").distinct()
    )


def test_distinct_counts_count_null_as_a_value(tables, spark):
    days = ops.paid_days(*tables)
    assert tuple(ops.distinct_counts(days, "store_id", "rental_date").first()) == (4, 2, 3)
    nulls = spark.createDataFrame([(None, None), (None, 1), (None, 1), (2, None)], "a int, b int")
    assert tuple(ops.distinct_counts(nulls, "a", "b").first()) == (3, 2, 2)
    assert tuple(ops.distinct_counts(nulls.limit(0), "a", "b").first()) == (0, 0, 0)


def test_latest_day_per_store(tables, spark, rows):
    assert rows(ops.latest_per_key(ops.paid_days(*tables), "store_id", "rental_date")) == [
        (1, D(2005, 5, 25)), (2, D(2005, 5, 24))
    ]
    assert rows(ops.latest_day_per_store(*tables)) == rows(
        ops.latest_per_key(ops.paid_days(*tables), "store_id", "rental_date")
    )
    odd = spark.createDataFrame([(None, 1), (None, 2), ("k", None)], "k string, v int")
    assert rows(ops.latest_per_key(odd, "k", "v")) == [(None, 2), ("k", None)]


def test_empty_inputs(tables):
    rental, payment, customer = tables
    assert ops.rental_fact(rental, payment.limit(0), customer).count() == 0
    assert ops.mart_partitions(rental.limit(0), payment, customer).count() == 0
