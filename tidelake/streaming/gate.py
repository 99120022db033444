"""The all-arrived gate as a stream whose state is bounded by a watermark.

The state of a batch is the first arrival of each required source. A batch opens in the
micro-batch that brings the last of them. Once the watermark, the latest batch time seen
less a delay, has passed a batch, its state goes; sources it still lacks are reported as
missing, and whatever comes for it from then on is reported as late, row by row. Spark's
own watermark would drop such rows unseen, so the state is a table here: one row for each
batch within the delay, written anew by each micro-batch below its own number, with the
watermark beside it. A redone micro-batch starts from the state before it and overwrites
what it wrote, so that nothing is said twice or lost.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidelake.session import folder_names, path_exists, remove_folder

OPENED, MISSING, LATE = "opened", "missing", "late"
_RESULT = "state string, batch timestamp_ntz, source string, ts timestamp_ntz"
_MARK = "passed timestamp_ntz"


def _epochs(spark: SparkSession, folder: str) -> list[int]:
    if not path_exists(spark, folder):
        return []
    return sorted(int(n.removeprefix("epoch=")) for n in folder_names(spark, folder) if n.startswith("epoch="))


def drain_gate(
    arrivals: DataFrame,
    folder: str,
    required: Sequence[str],
    delay: str = "1 day",
    batch: str = "batch",
    source: str = "source",
    moment: str = "ts",
) -> StreamingQuery:
    """Take in what has arrived, keep what :func:`gate_rows` gives, then stop.

    Batches are moments. Rows without a batch or a moment take no part, other sources only
    make a batch known, and of a source that comes again the earliest moment counts until
    the batch opens. Within a micro-batch rows are reduced to one for each batch and source
    before they are shuffled, so that a hot batch does no harm.
    """
    spark = arrivals.sparkSession
    wanted = list(dict.fromkeys(required))
    firsts = [f"first{i}" for i in range(len(wanted))]
    kept = f"batch timestamp_ntz, {', '.join(f'{name} timestamp_ntz' for name in firsts)}, opened boolean"
    spark.createDataFrame([], _RESULT).write.mode("ignore").parquet(f"{folder}/said/epoch=-1")

    def step(rows: DataFrame, epoch: int) -> None:
        before = [e for e in _epochs(spark, f"{folder}/mark") if e < epoch]
        passed, state = None, spark.createDataFrame([], kept)
        if before:
            passed = spark.read.schema(_MARK).parquet(f"{folder}/mark/epoch={before[-1]}").first()["passed"]
            state = spark.read.schema(kept).parquet(f"{folder}/open/epoch={before[-1]}")
        mark = F.lit(passed).cast("timestamp_ntz")
        known = rows.select(
            F.col(batch).cast("timestamp_ntz").alias("batch"), F.col(source).alias("source"), F.col(moment).cast("timestamp_ntz").alias("ts")
        ).filter(F.col("batch").isNotNull() & F.col("ts").isNotNull())
        is_late = F.coalesce(F.col("batch") < mark, F.lit(False))
        come = known.filter(~is_late).groupBy("batch").agg(
            *[F.min(F.when(F.col("source") == name, F.col("ts"))).alias(first) for name, first in zip(wanted, firsts, strict=True)],
            F.lit(False).alias("opened"),
        )
        # An opened batch keeps what it opened with.
        own = [F.coalesce(F.max(F.when(F.col("opened"), F.col(first))), F.min(first)).alias(first) for first in firsts]
        merged = state.unionByName(come).groupBy("batch").agg(*own, F.max("opened").alias("opened")).persist()
        latest = merged.agg((F.max("batch") - F.expr(f"INTERVAL {delay}")).alias("passed"))
        now = latest.select(F.greatest(mark, F.col("passed")).alias("passed")).first()["passed"]
        over = F.coalesce(F.col("batch") < F.lit(now).cast("timestamp_ntz"), F.lit(False))
        ready = F.lit(True)
        for first in firsts:
            ready = ready & F.col(first).isNotNull()
        lacking = F.array(*[F.when(F.col(first).isNull(), F.lit(name)) for name, first in zip(wanted, firsts, strict=True)])
        no_source, no_moment = F.lit(None).cast("string"), F.lit(None).cast("timestamp_ntz")
        last = F.greatest(*firsts) if len(firsts) > 1 else F.col(firsts[0])
        said = (
            merged.filter(ready & ~F.col("opened")).select(F.lit(OPENED).alias("state"), "batch", no_source.alias("source"), last.alias("ts"))
            .union(merged.filter(over).select(F.lit(MISSING), "batch", F.explode(F.array_compact(lacking)), no_moment))
            .union(known.filter(is_late & F.col("source").isin(wanted)).select(F.lit(LATE), "batch", "source", "ts"))
        )
        said.write.mode("overwrite").parquet(f"{folder}/said/epoch={epoch}")
        merged.filter(~over).withColumn("opened", ready).write.mode("overwrite").parquet(f"{folder}/open/epoch={epoch}")
        spark.createDataFrame([(now,)], _MARK).coalesce(1).write.mode("overwrite").parquet(f"{folder}/mark/epoch={epoch}")
        merged.unpersist()
        for old in before[:-1]:
            remove_folder(spark, f"{folder}/open/epoch={old}")
            remove_folder(spark, f"{folder}/mark/epoch={old}")

    query = (
        arrivals.writeStream.outputMode("append")
        .foreachBatch(step)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def gate_rows(spark: SparkSession, folder: str) -> DataFrame:
    """``state, batch, source, ts``: opened (ts is when it was ready), missing and late, so far."""
    return spark.read.schema(f"{_RESULT}, epoch long").parquet(f"{folder}/said").drop("epoch")


def gate_state(spark: SparkSession, folder: str) -> DataFrame:
    """The batches that are still kept, with the first arrival of each source."""
    return spark.read.parquet(f"{folder}/open/epoch={_epochs(spark, f'{folder}/open')[-1]}")
