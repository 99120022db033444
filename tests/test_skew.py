"""Plans under skew: a hot key must be split at run time."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidelake.operators.matching import match_conflicts, match_join
from tidelake.operators.rental import mart_partitions, rental_fact

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
}


@pytest.fixture(autouse=True)
def small_thresholds(spark):
    old = {key: spark.conf.get(key, None) for key in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield
    for key, value in old.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def numbered(spark, n):
    return spark.range(0, n, numPartitions=8)


def hot(rest=0):
    """A third of all rows share the key 7."""
    return F.when(F.col("id") % 3 == rest, F.lit(7)).otherwise(F.col("id"))


@pytest.fixture
def tables(spark):
    rental = numbered(spark, 90_000).select(
        F.col("id").alias("rental_id"),
        hot().alias("customer_id"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 50).cast("int")).alias("rental_date"),
    )
    payment = numbered(spark, 90_000).select(
        hot(1).alias("rental_id"), F.md5(F.col("id").cast("string")).alias("payment_date"), F.rand(1).alias("amount")
    )
    customer = numbered(spark, 90_000).select(F.col("id").alias("customer_id"), (F.col("id") % 5).alias("store_id"))
    return rental, payment, customer


def test_hot_customer_and_hot_rental_are_split(tables):
    fact = rental_fact(*tables)
    assert final_plan(fact).count("SortMergeJoin(skew=true)") == 2
    assert fact.count() == 90_000


def test_hot_rental_is_one_number_in_the_partition_list(tables):
    pairs = mart_partitions(*tables)
    assert "SortMergeJoin(skew=true)" in final_plan(pairs)
    paid = [i for i in range(90_000) if i % 3 != 1 or i == 7]
    assert pairs.count() == len({((7 if i % 3 == 0 else i) % 5, i % 50) for i in paid})


def test_match_on_a_hot_key_is_split(spark):
    left = numbered(spark, 90_000).select(hot().alias("k"), F.md5(F.col("id").cast("string")).alias("x"))
    right = numbered(spark, 1_000).select(F.col("id").alias("k"))
    joined = match_join(left, right, "k", "k")
    assert "SortMergeJoin(skew=true)" in final_plan(joined)
    assert joined.count() == 30_000 + sum(i % 3 != 0 for i in range(1_000))


def test_conflicts_of_a_hot_key_are_split(spark):
    left = numbered(spark, 90_000).select(hot().alias("k"), F.md5(F.col("id").cast("string")).alias("x"))
    right = numbered(spark, 1_000).select(F.col("id").alias("k"), F.lit("-").alias("x"))
    conflicts = match_conflicts(left, right, "k", "x")
    assert "SortMergeJoin(skew=true)" in final_plan(conflicts)
    assert conflicts.count() == 30_000 + sum(i % 3 != 0 for i in range(1_000))
