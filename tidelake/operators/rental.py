"""Rentals joined with their payments and customers.

Inputs: ``rental(rental_id, customer_id, rental_date, …)``,
``payment(rental_id, payment_date, amount, …)`` and
``customer(customer_id, store_id, …)``. All joins are inner equi-joins, so
null keys never match and rentals without payment vanish.

The customer join comes first: it runs on rentals, before the payments fan
them out, so the widest and longest side is shuffled once only. No side is
broadcast by force; Spark checks the size. A hot key is split at run time by
``spark.sql.adaptive.skewJoin.enabled`` (on by default).
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, functions as F

from tidelake.functions.columns import day_of, iso_text


def rental_fact(rental: DataFrame, payment: DataFrame, customer: DataFrame) -> DataFrame:
    """``store_id, rental_date, payment_date, amount``, the day as ISO text.

    The day travels through the shuffles as a date, a third of the text's size.
    """
    days = rental.select("rental_id", "customer_id", day_of(rental, "rental_date").alias("rental_date"))
    return (
        days.join(customer.select("customer_id", "store_id"), "customer_id")
        .join(payment.select("rental_id", "payment_date", "amount"), "rental_id")
        .select("store_id", iso_text(F.col("rental_date")).alias("rental_date"), "payment_date", "amount")
    )


def fact_slice(
    rental: DataFrame, payment: DataFrame, customer: DataFrame, store_id, day: datetime.date
) -> DataFrame:
    """The fact rows of one store and day; both filters run below the joins."""
    return rental_fact(
        rental.filter(day_of(rental, "rental_date") == F.lit(day)),
        payment,
        customer.filter(F.col("store_id") == F.lit(store_id)),
    )


def _prefixed(df: DataFrame, taken: set[str], prefix: str) -> tuple[DataFrame, dict[str, str]]:
    """Rename the columns whose name is taken, in any case; also the new name of each old one."""
    used = {name.lower() for name in taken} | {name.lower() for name in df.columns}
    clashing = {name.lower() for name in taken}
    names = {}
    for name in df.columns:
        new = name
        if name.lower() in clashing:
            new = f"{prefix}_{name}"
            while new.lower() in used:
                new += "_"
            used.add(new.lower())
        names[name.lower()] = new
    return df.toDF(*names.values()), names


def rental_wide(rental: DataFrame, payment: DataFrame, customer: DataFrame) -> DataFrame:
    """All columns of the three sides under unambiguous names.

    ``customer`` keeps its names; a rental column of the same name becomes
    ``rental_…``, a payment column that clashes becomes ``payment_…``, with
    underscores at the end where that is taken too. The rental date loses its
    time of day.
    """
    rentals, ours = _prefixed(
        rental.withColumn("rental_date", day_of(rental, "rental_date")), set(customer.columns), "rental"
    )
    payments, theirs = _prefixed(payment, set(customer.columns) | set(rentals.columns), "payment")
    return (
        rentals.join(customer, rentals[ours["customer_id"]] == customer["customer_id"])
        .join(payments, rentals[ours["rental_id"]] == payments[theirs["rental_id"]])
        .select(*rentals.columns, *payments.columns, *customer.columns)
    )


def sorted_by_store(wide: DataFrame, ties: list[str]) -> DataFrame:
    """Total order by store and day, ascending, nulls first.

    The tie-break columns make the order repeatable, and let the range
    partitioning cut a store and day that holds a large share of the rows.
    """
    return wide.orderBy("store_id", "rental_date", *ties)


def _paid(rental: DataFrame, payment: DataFrame) -> DataFrame:
    """``customer_id, rental_date`` of every paid rental, the day as a date.

    The payments are reduced to their distinct rental numbers, so they fan out
    nothing, and a rental with very many payments is one number before the
    shuffle. The join reuses the partitioning of that distinct. ``rental_id``
    is the key of the rentals and so never hot on their side.
    """
    days = rental.select("rental_id", "customer_id", day_of(rental, "rental_date").alias("rental_date"))
    paid = days.join(payment.select("rental_id").distinct(), "rental_id", "left_semi")
    return paid.select("customer_id", "rental_date")


def paid_days(rental: DataFrame, payment: DataFrame, customer: DataFrame) -> DataFrame:
    """``store_id, rental_date`` of every paid rental, the day as a date."""
    stores = customer.select("customer_id", "store_id")
    return _paid(rental, payment).join(stores, "customer_id").select("store_id", "rental_date")


def mart_partitions(rental: DataFrame, payment: DataFrame, customer: DataFrame) -> DataFrame:
    """The distinct (store, day) pairs of the fact table."""
    return paid_days(rental, payment, customer).distinct()


def distinct_counts(pairs: DataFrame, first: str, second: str) -> DataFrame:
    """How many distinct pairs, first values and second values there are.

    The pairs are made distinct once, and the two further counts run over that
    small set. The structs make a null count as a value, as ``distinct`` does.
    """
    return (
        pairs.select(first, second)
        .distinct()
        .agg(
            F.count(F.lit(1)).alias("pairs"),
            F.count_distinct(F.struct(first)).alias(f"{first}_values"),
            F.count_distinct(F.struct(second)).alias(f"{second}_values"),
        )
    )


def latest_per_key(df: DataFrame, key: str, value: str) -> DataFrame:
    """The greatest value of every key."""
    return df.groupBy(key).agg(F.max(value).alias(value))


def latest_day_per_store(rental: DataFrame, payment: DataFrame, customer: DataFrame) -> DataFrame:
    """The last paid rental day of every store.

    The maximum is taken per customer first: only one row per customer is
    shuffled, the join reuses that partitioning, and no customer is hot.
    """
    per_customer = latest_per_key(_paid(rental, payment), "customer_id", "rental_date")
    stores = customer.select("customer_id", "store_id")
    return latest_per_key(per_customer.join(stores, "customer_id"), "store_id", "rental_date")
