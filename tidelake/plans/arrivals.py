"""Arrived files, by way of their notifications, to a finished mart."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidelake.functions.notifications import created, malformed_notifications, parse_notifications
from tidelake.operators.arrivals import arrival_gate, arrival_missing, manifest_row
from tidelake.operators.filters import route_prefix
from tidelake.plans.rental_mart import ROLES, build_from_manifest
from tidelake.streaming.drain import drain_to_table

# Where a reader of JSON lines puts a line that it cannot read.
CORRUPT = "_corrupt_record"


def _table(spark: SparkSession, path: str, schema) -> DataFrame:
    """A table of the state folder, empty before it is first written."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def drain_and_build(
    spark: SparkSession,
    messages: DataFrame,
    routes: Mapping[str, str],
    order: Sequence[str],
    state: str,
    root: str,
    target: str,
    **options,
) -> bool:
    """Drain the message stream, then build the mart once from the last new file per role.

    ``messages`` is a stream with ``body`` and the sequence columns ``order``.
    The parsed keys are kept below ``state`` before anything is started, so a
    failed build loses no notification; bodies that cannot be parsed are set
    aside in ``state/malformed``, with the whole line in ``_corrupt_record``
    where the reader could not even find a body. Only files that came after
    those of the last successful build count, whose place in the sequence
    ``state/built`` keeps: no build mixes runs, and a failed one is tried again.
    Returns whether the mart was built.
    """
    routed = route_prefix(parse_notifications(messages.drop(CORRUPT)), routes)
    drain_to_table(routed, f"{state}/keys", f"{state}/keys-checkpoint")
    drain_to_table(
        malformed_notifications(messages), f"{state}/malformed", f"{state}/malformed-checkpoint"
    )
    names = [*order, "record_no"]
    place = F.struct(*names)
    arrived = created(_table(spark, f"{state}/keys", routed.schema))
    # One row for each build that succeeded.
    done = _table(spark, f"{state}/built", arrived.select(*names).schema)
    last = done.agg(F.max(place)).first()[0]
    if last is not None:
        arrived = arrived.filter(place > F.struct(*[F.lit(last[name]).cast(arrived.schema[name].dataType).alias(name) for name in names]))
    newest = arrived.agg(F.max(place).alias("place")).first()[0]
    if newest is None or not build_from_manifest(spark, manifest_row(arrived, ROLES, names), root, target, **options):
        return False
    spark.createDataFrame([newest], done.schema).write.mode("append").parquet(f"{state}/built")
    return True


def drain_and_open(
    spark: SparkSession,
    arrivals: DataFrame,
    state: str,
    required: Sequence[str],
    batch: str = "batch",
    source: str = "source",
    moment: str = "ts",
) -> tuple[DataFrame, DataFrame]:
    """Drain arrivals; open the gate of each complete batch once, and say what others lack.

    Returns the batches that this run opened, with ``ready_at``, and ``batch,
    source`` of what is still missing. Opened batches are kept below ``state``
    with the number of the run, before they are returned: a batch is opened by
    one run only.
    """
    drain_to_table(arrivals, f"{state}/arrived", f"{state}/arrived-checkpoint")
    arrived = _table(spark, f"{state}/arrived", arrivals.schema)
    ready = arrival_gate(arrived, batch, source, moment, required)
    kept = ready.withColumn("run", F.lit(0)).schema
    opened = _table(spark, f"{state}/opened", kept)
    run = (opened.agg(F.max("run")).first()[0] or 0) + 1
    before = opened.select(F.col(batch).alias("_opened"))
    new = ready.join(before, F.col(batch).eqNullSafe(F.col("_opened")), "left_anti")
    new.withColumn("run", F.lit(run)).write.mode("append").parquet(f"{state}/opened")
    mine = _table(spark, f"{state}/opened", kept).filter(F.col("run") == run).drop("run")
    return mine, arrival_missing(arrived, batch, source, moment, required)
