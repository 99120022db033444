"""Match queries: suppliers as the extract, customers as the master."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelake.functions.match_keys import birth_date, identifier
from tidelake.operators.filters import contains_row, filter_isin
from tidelake.operators.matching import match_conflicts, match_growth, match_join
from tidelake.plans.patient_finder import find_conflicts
from tidelake.queries import tables as t

_ON_ID = """
    SELECT s_suppkey AS ".id", s_nationkey AS ".attr", c_custkey AS id, c_nationkey AS attr, c_name AS name
    FROM supplier JOIN customer ON s_suppkey = c_custkey
"""
_ON_ATTR = _ON_ID.replace("ON s_suppkey = c_custkey", "ON s_nationkey = c_nationkey")


def match_on_id(spark, sf_dir):
    return match_join(t.extract(spark, sf_dir), t.master(spark, sf_dir), "id", "id")


def match_on_attr(spark, sf_dir):
    """Events matched on an attribute instead of their id.

    The attribute repeats on the event side only, so the result grows with the
    events; :func:`growth` covers the case where it repeats on both sides.
    """
    visits = t.events(spark, sf_dir).select(F.col("event_id").alias("id"), F.col("user_id").alias("attr"))
    people = t.customer(spark, sf_dir).select(
        F.col("store_id").alias("id"), F.col("customer_id").alias("attr"), "name"
    )
    return match_join(visits, people, "attr", "attr")


def growth(spark, sf_dir):
    """Pairs per attribute value of extract and master, which repeats on both sides."""
    return match_growth(t.extract(spark, sf_dir), t.master(spark, sf_dir), "attr", "attr")


def conflicts(spark, sf_dir):
    return match_conflicts(t.extract(spark, sf_dir), t.master(spark, sf_dir), "id", "attr")


def match_names(spark, sf_dir):
    """Differently named keys, and a key that repeats on one side only."""
    payment = t.payment(spark, sf_dir).withColumnRenamed("rental_id", "paid_rental")
    rental = t.rental(spark, sf_dir).select("rental_id", "customer_id", "status")
    return match_join(payment, rental, "paid_rental", "rental_id")


def normalise_match_keys(spark, sf_dir):
    raw = t.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.date_format("o_orderdate", "M/d/yy").alias("short_dob"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("iso_dob"),
        F.date_format("o_orderdate", "MM/dd/yyyy").alias("long_dob"),
        # Partial, doubtful and wrong forms of both.
        F.when(F.col("o_orderkey") % 3 == 0, F.date_format("o_orderdate", "yyyy"))
        .when(F.col("o_orderkey") % 3 == 1, F.date_format("o_orderdate", "yyyy-M"))
        .otherwise(F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(" xyz")))
        .alias("odd_dob"),
        F.col("o_custkey").cast("string").alias("ssn"),
        F.when(F.col("o_orderkey") % 3 == 0, "  ")
        .when(F.col("o_orderkey") % 3 == 1, "N/A")
        .otherwise(F.concat(F.lit(" "), F.col("o_custkey").cast("string")))
        .alias("odd_ssn"),
    )
    return raw.select(
        "o_orderkey",
        birth_date(F.col("short_dob")).alias("dob"),
        birth_date(F.col("iso_dob")).alias("same_dob"),
        birth_date(F.col("long_dob")).alias("long_dob"),
        birth_date(F.col("odd_dob")).alias("odd_dob"),
        identifier(F.col("ssn")).alias("ssn"),
        identifier(F.col("odd_ssn")).alias("odd_ssn"),
    )


def patient_finder(spark, sf_dir):
    """The whole finder: raw date and identifier forms in, conflicts out."""
    born = F.date_add(F.lit("1975-01-01").cast("date"), F.col("day"))
    extract = t.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("ssn"), F.col("s_nationkey").alias("day")
    ).select(F.date_format(born, "yyyy-MM-dd").alias("DOB"), "ssn")
    master = t.table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("Full Name"),
        F.col("c_nationkey").alias("day"),
        F.lpad(F.col("c_custkey").cast("string"), 9, "0").alias("SSN"),
    ).select("Full Name", F.date_format(born, "M/d/yy").alias("DOB"), "SSN")
    return find_conflicts(extract, master)


def isin(spark, sf_dir):
    return filter_isin(t.events(spark, sf_dir), "event_type", ["click", "error"])


def contains(spark, sf_dir):
    found = contains_row(t.customer(spark, sf_dir), "name", "Customer#000000007")
    absent = contains_row(t.customer(spark, sf_dir), "name", ["nobody", None])
    return found.select(F.lit("present").alias("probe"), "found").union(
        absent.select(F.lit("absent").alias("probe"), "found")
    )


QUERIES = {
    "match_join": match_names,
    "match_on_id": match_on_id,
    "match_on_attr": match_on_attr,
    "match_growth": growth,
    "match_conflicts": conflicts,
    "normalise_match_keys": normalise_match_keys,
    "patient_finder": patient_finder,
    "filter_isin": isin,
    "contains_value": contains,
}

SQL = {
    "match_join": """
        SELECT l_orderkey AS paid_rental, l_linenumber AS payment_no, l_shipdate AS payment_date,
               l_extendedprice AS amount, l_linestatus AS ".status",
               o_orderkey AS rental_id, o_custkey AS customer_id, o_orderstatus AS status
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    """,
    "match_on_id": _ON_ID,
    "match_on_attr": """
        SELECT event_id AS ".id", user_id AS ".attr", c_nationkey AS id, c_custkey AS attr, c_name AS name
        FROM events JOIN customer ON user_id = c_custkey
    """,
    "match_growth": """
        SELECT key, left_rows, right_rows, CAST(left_rows * right_rows AS DECIMAL(38,0)) AS pairs
        FROM (SELECT s_nationkey AS key, count(*) AS left_rows FROM supplier GROUP BY 1)
        JOIN (SELECT c_nationkey AS key, count(*) AS right_rows FROM customer GROUP BY 1) USING (key)
    """,
    "match_conflicts": f"({_ON_ID}) EXCEPT ({_ON_ATTR})",
    "normalise_match_keys": """
        SELECT o_orderkey, CAST(o_orderdate AS DATE) AS dob, CAST(o_orderdate AS DATE) AS same_dob,
               CAST(o_orderdate AS DATE) AS long_dob, NULL::DATE AS odd_dob,
               lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS ssn,
               CASE WHEN o_orderkey % 3 = 2 THEN lpad(CAST(o_custkey AS VARCHAR), 9, '0') END AS odd_ssn
        FROM orders
    """,
    "patient_finder": """
        SELECT DATE '1975-01-01' + CAST(s_nationkey AS INTEGER) AS ".dob",
               lpad(CAST(s_suppkey AS VARCHAR), 9, '0') AS ".ssn",
               c_name AS full_name,
               DATE '1975-01-01' + CAST(c_nationkey AS INTEGER) AS dob,
               lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS ssn
        FROM supplier JOIN customer ON s_suppkey = c_custkey
        WHERE s_nationkey <> c_nationkey
    """,
    "filter_isin": "SELECT * FROM events WHERE event_type IN ('click', 'error')",
    "contains_value": """
        SELECT 'present' AS probe, coalesce(bool_or(c_name = 'Customer#000000007'), false) AS found FROM customer
        UNION ALL
        SELECT 'absent', coalesce(bool_or(c_name IN ('nobody')), false) FROM customer
    """,
}
