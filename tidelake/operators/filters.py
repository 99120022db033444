"""Point filters, membership, prefix routing and exact look-ups."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from tidelake.functions.columns import free_name, quoted


def filter_equal(df: DataFrame, **wanted) -> DataFrame:
    """Rows where every named column equals its value; values are never SQL text."""
    for name, value in wanted.items():
        df = df.filter(F.col(name) == F.lit(value))
    return df


def filter_isin(df: DataFrame, column: str, values) -> DataFrame:
    """Rows whose column is one of ``values``: a scalar, a list or a one-column DataFrame.

    A null never matches, and values are cast as in any comparison. A list is
    part of the plan, so values that come from data belong into a DataFrame;
    that becomes a semi join, in which a hot value of ``df`` can be split at
    run time.
    """
    if isinstance(values, DataFrame):
        name = free_name("_wanted", df)
        return df.join(values.toDF(name), quoted(column) == F.col(name), "left_semi")
    listed = list(values) if isinstance(values, (list, tuple, set, frozenset)) else [values]
    return df.filter(quoted(column).isin(list(dict.fromkeys(v for v in listed if v is not None))))


def contains_value(df: DataFrame, column: str, values) -> bool:
    """Whether any row matches; the scan stops at the first one."""
    return not filter_isin(df, column, values).limit(1).isEmpty()


def contains_row(df: DataFrame, column: str, values) -> DataFrame:
    """:func:`contains_value` as a one-row table ``found``."""
    return filter_isin(df, column, values).limit(1).agg((F.count(F.lit(1)) > 0).alias("found"))


def route_prefix(keys: DataFrame, routes: Mapping[str, str], key: str = "key") -> DataFrame:
    """Add ``role``: that of the first prefix the key starts with, null for none."""
    role = F.lit(None).cast("string")
    for prefix, name in reversed(list(routes.items())):
        role = F.when(F.col(key).startswith(prefix), F.lit(name)).otherwise(role)
    return keys.withColumn("role", role)


def route_by_rules(keys: DataFrame, rules: DataFrame, key: str = "key", first: str | None = None) -> DataFrame:
    """Add ``role`` by any number of rules, a DataFrame of (prefix, role); null for none.

    The longest prefix wins, or with ``first`` the rule that is least by that column of
    ``rules``; ties go to the least role. Each distinct key is cut at the lengths that
    prefixes have, which are as many as the longest one has characters, and its beginnings
    meet the rules in a join on equal texts. A null key has no role.
    """
    found, role = free_name("_key", keys), free_name("role", keys)
    place = F.col(first) if first else F.lit(0)
    ranked = rules.filter(F.col("prefix").isNotNull()).groupBy("prefix").agg(F.min(F.struct(place.alias("place"), "role")).alias("rule"))
    # The empty prefix would be one join key for all rows.
    anything = ranked.filter("prefix = ''").select("rule").first()
    ranked = ranked.filter("prefix <> ''")
    lengths = sorted(row[0] for row in ranked.select(F.length("prefix")).distinct().collect())
    distinct = keys.select(quoted(key).alias(found)).filter(F.col(found).isNotNull()).distinct()
    cuts = F.filter(F.lit(lengths).cast("array<int>"), lambda n: n <= F.length(found))
    cut = distinct.select(found, F.explode(cuts).alias("_length"))
    cut = cut.select(found, "_length", F.substring(found, F.lit(1), F.col("_length")).alias("prefix"))
    order = F.struct("rule.place", F.lit(0).alias("length"), "rule.role") if first else F.struct(
        F.lit(0).alias("place"), (-F.col("_length")).alias("length"), "rule.role"
    )
    best = cut.join(ranked, "prefix").groupBy(found).agg(F.min(order).alias("_best"))
    routed = keys.join(best, quoted(key) == F.col(found), "left")
    chosen = F.col("_best.role")
    if anything:
        rule = anything["rule"]
        other = F.lit(rule["role"])
        better = F.col("_best").isNull()
        if first:
            better = better | (F.lit(rule["place"]) < F.col("_best.place"))
        chosen = F.when(F.col(key).isNotNull(), F.when(better, other).otherwise(chosen))
    return routed.withColumn(role, chosen).drop(found, "_best")


def unrouted(routed: DataFrame) -> DataFrame:
    """Keys that no prefix took."""
    return routed.filter(F.col("role").isNull())


def _rules(keys: DataFrame, targets, name: str) -> DataFrame:
    """``(name, target)`` from a mapping, which is one value of the plan, or a DataFrame.

    Spark chooses the join by size in either case.
    """
    if isinstance(targets, DataFrame):
        return targets.toDF(name, "target")
    rules = json.dumps([{"k": key, "v": target} for key, target in targets.items()])
    listed = F.from_json(F.lit(rules), "array<struct<k:string,v:string>>")
    return keys.sparkSession.range(1).select(F.inline(listed).alias(name, "target"))


def lookup_exact(keys: DataFrame, targets, key: str = "key") -> DataFrame:
    """Add ``target`` by exact key; null where there is none.

    ``targets`` is a mapping written in the program, or a DataFrame of
    (key, target) with unique keys.
    """
    name = free_name("_key", keys)
    return keys.join(_rules(keys, targets, name), quoted(key) == F.col(name), "left").drop(name)


def unmatched_keys(keys: DataFrame, targets, key: str = "key") -> DataFrame:
    """Rows whose key has no target."""
    name = free_name("_key", keys)
    return keys.join(_rules(keys, targets, name), quoted(key) == F.col(name), "left_anti")
