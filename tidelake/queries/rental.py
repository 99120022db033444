"""Rental queries on orders, lineitem and customer."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from tidelake.functions.columns import cast_to_date, iso_text, plus_days
from tidelake.operators import rental as ops
from tidelake.operators.filters import filter_equal
from tidelake.operators.surrogate_keys import next_keys
from tidelake.plans.reports import profile_rows
from tidelake.queries import tables as t

_FACT = """
    SELECT c_nationkey AS store_id, strftime(o_orderdate, '%Y-%m-%d') AS rental_date,
           l_shipdate AS payment_date, l_extendedprice AS amount
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN customer ON o_custkey = c_custkey
"""


def rental_fact(spark, sf_dir):
    return ops.rental_fact(*t.rental_tables(spark, sf_dir))


def rental_wide(spark, sf_dir):
    return ops.rental_wide(*t.rental_tables(spark, sf_dir))


def distinct_partitions(spark, sf_dir):
    pairs = ops.mart_partitions(*t.rental_tables(spark, sf_dir))
    return pairs.select("store_id", iso_text(F.col("rental_date")).alias("rental_date"))


def distinct_values(spark, sf_dir):
    return ops.paid_days(*t.rental_tables(spark, sf_dir)).select("rental_date").distinct()


def distinct_counts(spark, sf_dir):
    return ops.distinct_counts(
        ops.paid_days(*t.rental_tables(spark, sf_dir)), "store_id", "rental_date"
    )


def latest_per_key(spark, sf_dir):
    return ops.latest_day_per_store(*t.rental_tables(spark, sf_dir))


def sort_multi(spark, sf_dir):
    wide = ops.rental_wide(*t.rental_tables(spark, sf_dir))
    narrow = wide.select("store_id", "rental_date", "rental_id", "payment_no", "amount")
    return ops.sorted_by_store(narrow, ["rental_id", "payment_no"])


def filter_partition(spark, sf_dir):
    return ops.fact_slice(*t.rental_tables(spark, sf_dir), 1, datetime.date(1998, 2, 6))


def filter_point(spark, sf_dir):
    return filter_equal(t.rental(spark, sf_dir), customer_id=4)


def max_global(spark, sf_dir):
    return t.customer(spark, sf_dir).agg(F.max("customer_id").alias("customer_id"))


def max_filtered(spark, sf_dir):
    return filter_equal(t.rental(spark, sf_dir), customer_id=4).agg(
        F.max("rental_id").alias("rental_id")
    )


def project_alias(spark, sf_dir):
    r = t.rental(spark, sf_dir).alias("r")
    return r.select("r.rental_id", F.col("r.rental_date").alias("rented_at"), F.col("r.total").alias("amount"))


def rename_column(spark, sf_dir):
    rental = t.rental(spark, sf_dir).withColumnRenamed("customer_id", "rental_customer_id")
    return rental.withColumnRenamed("status", "rental_status")


def cast_date(spark, sf_dir):
    return cast_to_date(t.rental(spark, sf_dir), "rental_date")


def date_parse(spark, sf_dir):
    orders = t.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("rental_id"),
        F.col("o_orderdate").cast("string").alias("rental_date"),
        F.concat("o_orderpriority", F.lit("-01-01")).alias("no_date"),
    )
    return cast_to_date(cast_to_date(orders, "rental_date"), "no_date")


def date_text(spark, sf_dir):
    return t.rental(spark, sf_dir).select("rental_id", iso_text(F.col("rental_date")).alias("rental_date"))


def interval_add(spark, sf_dir):
    rental = t.rental(spark, sf_dir)
    return rental.select("rental_id", plus_days(F.col("rental_date"), 4).alias("return_date"))


def next_key(spark, sf_dir):
    new = t.table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_name").alias("name"))
    return next_keys(t.customer(spark, sf_dir), "customer_id", new, ["s_suppkey"])


def rental_profile(spark, sf_dir):
    """The profile job's numbers and latest days."""
    return profile_rows(*t.rental_tables(spark, sf_dir))


QUERIES = {
    "rental_profile": rental_profile,
    "rental_fact": rental_fact,
    "rental_wide": rental_wide,
    "distinct_partitions": distinct_partitions,
    "distinct_values": distinct_values,
    "distinct_counts": distinct_counts,
    "latest_per_key": latest_per_key,
    "sort_multi": sort_multi,
    "filter_partition": filter_partition,
    "filter_point": filter_point,
    "max_global": max_global,
    "max_filtered": max_filtered,
    "project_alias": project_alias,
    "rename_column": rename_column,
    "cast_to_date": cast_date,
    "date_parse": date_parse,
    "date_text": date_text,
    "interval_add": interval_add,
    "next_key": next_key,
}

SQL = {
    "rental_fact": _FACT,
    "rental_wide": """
        SELECT o_orderkey AS rental_id, o_custkey AS rental_customer_id,
               CAST(o_orderdate AS DATE) AS rental_date, o_orderstatus AS status, o_totalprice AS total,
               l_orderkey AS payment_rental_id, l_linenumber AS payment_no, l_shipdate AS payment_date,
               l_extendedprice AS amount, l_linestatus AS payment_status,
               c_custkey AS customer_id, c_nationkey AS store_id, c_name AS name, c_acctbal AS balance
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN customer ON o_custkey = c_custkey
    """,
    "distinct_partitions": f"SELECT DISTINCT store_id, rental_date FROM ({_FACT})",
    "distinct_values": f"SELECT DISTINCT CAST(rental_date AS DATE) AS rental_date FROM ({_FACT})",
    "distinct_counts": f"""
        SELECT (SELECT count(*) FROM (SELECT DISTINCT store_id, rental_date FROM f)) AS pairs,
               count(DISTINCT store_id) AS store_id_values,
               count(DISTINCT rental_date) AS rental_date_values
        FROM ({_FACT}) AS f
    """.replace("FROM f)", f"FROM ({_FACT}))"),
    "latest_per_key": f"""
        SELECT store_id, max(CAST(rental_date AS DATE)) AS rental_date FROM ({_FACT}) GROUP BY store_id
    """,
    "sort_multi": """
        SELECT c_nationkey AS store_id, CAST(o_orderdate AS DATE) AS rental_date,
               o_orderkey AS rental_id, l_linenumber AS payment_no, l_extendedprice AS amount
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN customer ON o_custkey = c_custkey
        ORDER BY store_id, rental_date, rental_id, payment_no
    """,
    "filter_partition": f"SELECT * FROM ({_FACT}) WHERE store_id = 1 AND rental_date = '1998-02-06'",
    "filter_point": """
        SELECT o_orderkey AS rental_id, o_custkey AS customer_id, o_orderdate AS rental_date,
               o_orderstatus AS status, o_totalprice AS total
        FROM orders WHERE o_custkey = 4
    """,
    "max_global": "SELECT max(c_custkey) AS customer_id FROM customer",
    "max_filtered": "SELECT max(o_orderkey) AS rental_id FROM orders WHERE o_custkey = 4",
    "project_alias": """
        SELECT o_orderkey AS rental_id, o_orderdate AS rented_at, o_totalprice AS amount FROM orders
    """,
    "rename_column": """
        SELECT o_orderkey AS rental_id, o_custkey AS rental_customer_id, o_orderdate AS rental_date,
               o_orderstatus AS rental_status, o_totalprice AS total
        FROM orders
    """,
    "cast_to_date": """
        SELECT o_orderkey AS rental_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS rental_date,
               o_orderstatus AS status, o_totalprice AS total
        FROM orders
    """,
    "date_parse": """
        SELECT o_orderkey AS rental_id, CAST(o_orderdate AS DATE) AS rental_date,
               TRY_CAST(concat(o_orderpriority, '-01-01') AS DATE) AS no_date
        FROM orders
    """,
    "date_text": """
        SELECT o_orderkey AS rental_id, strftime(o_orderdate, '%Y-%m-%d') AS rental_date FROM orders
    """,
    "interval_add": """
        SELECT o_orderkey AS rental_id, o_orderdate + INTERVAL '4' DAY AS return_date FROM orders
    """,
    "next_key": """
        SELECT s_suppkey, s_name AS name,
               (SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY s_suppkey) AS customer_id
        FROM supplier
    """,
    "rental_profile": f"""
        WITH pairs AS (SELECT DISTINCT store_id, rental_date FROM ({_FACT}))
        SELECT 'pairs' AS measure, NULL::INTEGER AS store_id, CAST(count(*) AS VARCHAR) AS value FROM pairs
        UNION ALL SELECT 'store_id_values', NULL, CAST(count(DISTINCT store_id) AS VARCHAR) FROM pairs
        UNION ALL SELECT 'rental_date_values', NULL, CAST(count(DISTINCT rental_date) AS VARCHAR) FROM pairs
        UNION ALL SELECT 'latest', store_id, max(rental_date) FROM pairs GROUP BY store_id
    """,
}
