"""Match an extract to a master table and report where the two disagree."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidelake.functions.columns import quoted


def match_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Inner equi-join that keeps all columns of both sides.

    Where both sides have a name (in any case), the left column gets the
    prefix ``.``. Columns come in order: left, then right. A null key matches
    nothing. A key that repeats on both sides gives every pair of its rows;
    :func:`match_growth` tells beforehand how many that will be.
    """
    theirs = {name.lower() for name in right.columns}

    def marked(name: str) -> str:
        return f".{name}" if name.lower() in theirs else name

    ours = left.select(*[quoted(name).alias(marked(name)) for name in left.columns])
    left_column = ours["`" + marked(left_key) + "`"]
    return ours.join(right, left_column == right["`" + right_key + "`"], "inner")


def match_growth(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """``key, left_rows, right_rows, pairs`` of the matches, without building them.

    Both sides are counted per key before they meet, so a hot key costs no more
    than any other. The product is a decimal, as it can exceed 64 bits.
    """
    ours = left.groupBy(quoted(left_key).alias("key")).agg(F.count(F.lit(1)).alias("left_rows"))
    theirs = right.groupBy(quoted(right_key).alias("key")).agg(F.count(F.lit(1)).alias("right_rows"))
    pairs = F.col("left_rows").cast("decimal(19,0)") * F.col("right_rows").cast("decimal(19,0)")
    return ours.join(theirs, "key").withColumn("pairs", pairs.cast("decimal(38,0)"))


def match_conflicts(left: DataFrame, right: DataFrame, key: str, attribute: str) -> DataFrame:
    """Distinct matches on ``key`` whose ``attribute`` is not equal on both sides.

    The same rows as the matches on ``key`` minus the matches on ``attribute``,
    without building the second join. A null attribute equals nothing.

    The rebalancing moves only the conflicts. It separates the distinct from
    the join, which lets adaptive execution split a hot key, and it spreads
    many copies of one row before they are reduced.
    """
    matched = match_join(left, right, key, key)
    agree = F.coalesce(quoted(f".{attribute}") == quoted(attribute), F.lit(False))
    return matched.filter(~agree).hint("rebalance").distinct()
