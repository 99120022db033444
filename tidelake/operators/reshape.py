"""Long to wide, grouped values and maxima."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidelake.functions.columns import quoted, value_where


def group_max(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """The maximum of several columns per key; nulls are ignored."""
    return df.groupBy(quoted(key)).agg(*[F.max(quoted(name)).alias(name) for name in columns])


def pivot_values(df: DataFrame, column: str) -> DataFrame:
    """The distinct values of a column in order, without null."""
    return df.select(quoted(column)).filter(quoted(column).isNotNull()).distinct().orderBy(quoted(column))


def listed_pivot_values(df: DataFrame, column: str) -> list:
    """:func:`pivot_values` on the driver; more than a table may have columns is an error."""
    most = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues", "10000"))
    found = pivot_values(df, column).limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"{column} has more than {most} values (spark.sql.pivotMaxValues)")
    return [row[0] for row in found]


def fill_zero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null to zero in the given numeric columns; a numeric key stays as it is.

    NaN is a value and stays.
    """
    named = {name.lower() for name in columns}
    return df.select(*[
        F.coalesce(quoted(name), F.lit(0)).alias(name) if name.lower() in named else quoted(name) for name in df.columns
    ])


def wide_names(key: str, values: Sequence) -> list[str]:
    """Column names for pivoted values: their text, with ``_2``, ``_3`` … where a name
    is taken in any case, by the key or by an earlier value."""
    taken, names = {key.lower()}, []
    for value in values:
        name, n = str(value), 1
        while name.lower() in taken:
            n += 1
            name = f"{value}_{n}"
        taken.add(name.lower())
        names.append(name)
    return names


def pivot_max(
    df: DataFrame, key: str, column: str, value: str, values: Sequence | None = None
) -> DataFrame:
    """One row per key, one column per value of ``column``: the greatest ``value`` or 0.

    The maxima of all columns are taken in one pass and one shuffle. Columns are
    named by :func:`wide_names`. NaN counts as the greatest value, as in Spark.
    """
    wanted = list(values) if values is not None else listed_pivot_values(df, column)
    maxima = [
        F.coalesce(F.max(value_where(quoted(column), v, quoted(value), "_")), F.lit(0)).alias(f"_{i}")
        for i, v in enumerate(wanted)
    ]
    keyed = df.groupBy(quoted(key))
    wide = keyed.agg(*maxima) if maxima else df.select(quoted(key)).distinct()
    return wide.toDF(key, *wide_names(key, wanted))


def group_values(
    df: DataFrame,
    key: str,
    value: str,
    per_row: int = 10_000,
    partitions: int | None = None,
) -> DataFrame:
    """All values per key: rows ``key, part, values`` with ``values`` a sorted
    array of ``(value, n)``, ``n`` being how often the value occurs.

    Nothing is dropped, and no task holds a whole hot key. Equal values are
    counted before the shuffle, so a value that fills a third of the table is
    one entry. A key with more than ``per_row`` distinct values is cut into
    parts by a stable hash of the value, each of about ``per_row`` entries;
    all other keys have the one part 0. ``partitions`` fixes the number of
    output partitions.
    """
    counted = df.groupBy(F.col(key), F.col(value).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    # Only the keys that need cutting go into the join; Spark checks their size.
    # Counting over ``n`` keeps this branch the same as ``counted``, so that its
    # scan and shuffle run once and are reused.
    large = (
        counted.groupBy(F.col(key).alias("_key"))
        .agg(F.ceil(F.count_if(F.col("n") > 0) / per_row).alias("_parts"))
        .filter(F.col("_parts") > 1)
    )
    # First 32 bits of the MD5, a hash that any engine can repeat.
    digest = F.conv(F.substring(F.md5(F.col("value").cast("string")), 1, 8), 16, 10).cast("bigint")
    part = F.when(F.col("_parts") > 1, F.coalesce(digest % F.col("_parts"), F.lit(0))).otherwise(0)
    cut = counted.join(large, F.col(key).eqNullSafe(F.col("_key")), "left").withColumn("part", part.cast("int"))
    if partitions is not None:
        cut = cut.repartition(partitions, key, "part")
    return cut.groupBy(key, "part").agg(
        F.sort_array(F.collect_list(F.struct("value", "n"))).alias("values")
    )


def pivot_map(df: DataFrame, key: str, column: str, value: str, per_row: int = 10_000) -> DataFrame:
    """:func:`pivot_max` for any number of values: rows ``key, part, values``, a map by name.

    No list of the values exists anywhere. A key with more than ``per_row`` of them is cut
    into parts by a hash of the value; all others have the one part 0. A name that a key
    does not have, or only with nulls, is not in its map, where :func:`pivot_max` has 0.
    """
    name = F.coalesce(F.col(column).cast("string"), F.lit("null"))
    cells = df.groupBy(F.col(key), name.alias("name")).agg(F.max(value).alias("value")).filter(F.col("value").isNotNull())
    # Only the keys that need cutting go into the join; Spark checks their size.
    large = (
        cells.groupBy(F.col(key).alias("_key"))
        .agg(F.ceil(F.count_if(F.col("value").isNotNull()) / per_row).alias("_parts"))
        .filter(F.col("_parts") > 1)
    )
    part = F.when(F.col("_parts") > 1, F.pmod(F.xxhash64("name"), F.col("_parts"))).otherwise(0)
    cut = cells.join(large, F.col(key).eqNullSafe(F.col("_key")), "left").withColumn("part", part.cast("int"))
    entries = F.collect_list(F.struct("name", "value"))
    return cut.groupBy(key, "part").agg(F.map_from_entries(entries).alias("values"))
