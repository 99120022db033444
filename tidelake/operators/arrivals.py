"""From arrived file keys to a job manifest and an all-arrived gate.

Every function takes a batch or a streaming DataFrame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

# The four extracts a batch waits for.
AWAITED_EXTRACTS = ("IDR", "MDS", "ECE", "FPVS")


def manifest_row(routed: DataFrame, roles: Sequence[str], order: Sequence[str], key: str = "key") -> DataFrame:
    """One row with a column per role: the key that came last by ``order``, or null.

    The key itself breaks ties. There is no grouping column, so each task
    reduces its rows to one in a single pass, without a sort.
    """
    last = F.struct(*[F.col(name) for name in order], F.col(key).alias("_key"))
    return routed.agg(*[
        F.max(F.when(F.col("role") == role, last))["_key"].alias(role) for role in roles
    ])


def manifest_latest(
    routed: DataFrame, roles: Sequence[str], order: Sequence[str], key: str = "key"
) -> DataFrame:
    """:func:`manifest_row` as rows ``role, key``; roles without a key are left out."""
    entries = F.array(*[F.struct(F.lit(role).alias("role"), F.col(role).alias("key")) for role in roles])
    rows = manifest_row(routed, roles, order, key).select(F.inline(entries))
    return rows.filter(F.col("key").isNotNull())


def latest_by_role(routed: DataFrame, order: Sequence[str], key: str = "key") -> DataFrame:
    """``role, key``: the key of each role that came last by ``order``; for any number of roles.

    In a stream the state is one row for each role.
    """
    last = F.struct(*[F.col(name) for name in order], F.col(key).alias("_key"))
    found = routed.filter(F.col("role").isNotNull()).groupBy("role").agg(F.max(last).alias("_last"))
    return found.select("role", F.col("_last._key").alias("key"))


def _first_seen(
    arrivals: DataFrame, batch: str, source: str, moment: str, required: Sequence[str]
) -> DataFrame:
    """Per batch a struct with the first arrival of every required source.

    One aggregation with one small row per batch, so a source that arrives
    many times is reduced before the shuffle.
    """
    firsts = [
        F.min(F.when(F.col(source) == name, F.col(moment))).alias(f"_first{i}")
        for i, name in enumerate(required)
    ]
    return arrivals.groupBy(batch).agg(*firsts)


def arrival_gate(
    arrivals: DataFrame,
    batch: str,
    source: str,
    moment: str,
    required: Sequence[str] = AWAITED_EXTRACTS,
) -> DataFrame:
    """``batch, ready_at``: batches for which every required source has come.

    In a stream the state is one row per batch; it takes a source that comes
    late whenever that is, so no arrival is dropped.
    """
    awaited = arrivals.filter(F.col(source).isin(list(required)))
    seen = _first_seen(awaited, batch, source, moment, required)
    firsts = [F.col(f"_first{i}") for i in range(len(required))]
    complete = seen
    for first in firsts:
        complete = complete.filter(first.isNotNull())
    ready = F.greatest(*firsts) if len(firsts) > 1 else firsts[0]
    return complete.select(batch, ready.alias("ready_at"))


def arrival_missing(
    arrivals: DataFrame,
    batch: str,
    source: str,
    moment: str,
    required: Sequence[str] = AWAITED_EXTRACTS,
) -> DataFrame:
    """``batch, source``: the required sources that a known batch still lacks."""
    seen = _first_seen(arrivals, batch, source, moment, required)
    absent = F.array(*[
        F.when(F.col(f"_first{i}").isNull(), F.lit(name)) for i, name in enumerate(required)
    ])
    return seen.select(batch, F.explode(F.array_compact(absent)).alias(source))
