"""Consecutive surrogate keys for a batch of new rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidelake.session import folder_names, new_folder, path_exists, publish_file, remove_folder

# Layout of monotonically_increasing_id(): partition above, place in the
# partition in the lower 33 bits.
_PLACE_BITS = 33


def number_rows(
    batch: DataFrame, order: list[str], name: str, after: int = 0, folder: str | None = None
) -> DataFrame:
    """Add ``name``: ``after`` + 1, 2, 3 … in the given order, in parallel.

    The batch is range-partitioned and sorted, each partition counts its own
    rows, and the sums of the partitions before it are added. Only one number
    per partition meets in a single task. The sorted batch is written to the
    shared folder before it is counted: that fixes which row sits in which
    partition, so a lost executor cannot change keys already given, and the
    count reads one column. The result is read from that copy, in ``folder``
    or a new one; :func:`insert_with_keys` removes it. ``order`` should end in
    a unique column.
    """
    spark = batch.sparkSession
    ordered = (
        batch.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    folder = folder or new_folder(spark, "numbered")
    ordered.write.parquet(folder)
    stored = spark.read.schema(ordered.schema).parquet(folder)
    placed = stored.withColumn("_partition", F.shiftright("_place", _PLACE_BITS))
    sizes = placed.groupBy("_partition").agg(F.count(F.lit(1)).alias("_rows"))
    before = F.sum("_rows").over(
        Window.orderBy("_partition").rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = sizes.select("_partition", F.coalesce(before, F.lit(0)).alias("_before"))
    place = F.col("_place").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    # One row per shuffle partition: bounded by the plan, not by the data.
    return (
        placed.join(F.broadcast(starts), "_partition")
        .withColumn(name, F.lit(after) + F.col("_before") + place + 1)
        .drop("_partition", "_place", "_before")
    )


def read_mark(spark: SparkSession, mark: str) -> int | None:
    """The greatest key that a state table has noted, if any."""
    try:
        return spark.read.schema("last long").parquet(mark).agg(F.max("last")).first()[0]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


# Entries of a ledger in one folder, so that no listing grows with its history.
_ENTRIES = 1_000


def _entry(ledger: str, number: int) -> str:
    return f"{ledger}/{number // _ENTRIES:012d}/{number:015d}"


def _last_entry(spark: SparkSession, ledger: str) -> int | None:
    """Number of the last entry of a ledger; the numbers have no gaps."""
    groups = folder_names(spark, ledger) if path_exists(spark, ledger) else []
    if not groups:
        return None
    entries = [name for name in folder_names(spark, f"{ledger}/{max(groups)}") if not name.startswith("_")]
    # A folder may be there before its first entry.
    number = int(max(entries)) if entries else int(max(groups)) * _ENTRIES - 1
    return number if number >= 0 else None


def reserve_keys(spark: SparkSession, ledger: str, count: int, floor: Callable[[], int]) -> int:
    """Take a range of ``count`` keys that no other writer gets; they follow the returned one.

    A ledger is a folder with one small file for each range, which holds the last key of
    it. A writer reads the last entry and tries to make the next; if another one was
    faster, it reads again. So a range is taken by the making of one file, without a lock
    that a dead writer could hold. ``floor`` gives the greatest existing key for an empty
    ledger. A writer that fails later leaves a gap. Keys given past the ledger are not seen.
    """
    if count < 0:
        raise ValueError("a range has no negative length")
    while True:
        number = _last_entry(spark, ledger)
        after = floor() if number is None else int(spark.read.text(_entry(ledger, number)).first()[0])
        if publish_file(spark, _entry(ledger, 0 if number is None else number + 1), str(after + count)):
            return after


def next_keys(
    existing: DataFrame,
    key: str,
    batch: DataFrame,
    order: list[str],
    mark: str | None = None,
    folder: str | None = None,
    ledger: str | None = None,
) -> DataFrame:
    """Give the batch the keys that follow the greatest existing one.

    Not a sequence: one batch at a time may take keys for a table. With
    ``mark``, a small state table that notes the greatest key given, only the
    first batch scans the keys of the whole table. The note is written before
    the keys are used, so a batch that fails leaves a gap and no key twice.
    With ``ledger`` instead (see :func:`reserve_keys`) several batches may take
    keys at once; the range is taken when the batch is numbered and counted.
    """
    if mark and ledger:
        raise ValueError("keys are noted in a mark or in a ledger, not in both")
    spark = batch.sparkSession
    if ledger:
        folder = folder or new_folder(spark, "numbered")
        numbered = number_rows(batch, order, key, folder=folder)
        rows = spark.read.schema(batch.schema).parquet(folder).count()
        if not rows:
            return numbered
        after = reserve_keys(spark, ledger, rows, lambda: existing.agg(F.max(key)).first()[0] or 0)
        return numbered.withColumn(key, F.col(key) + after)
    after = read_mark(spark, mark) if mark else None
    if after is None:
        after = existing.agg(F.max(key)).first()[0] or 0
    folder = folder or new_folder(spark, "numbered")
    numbered = number_rows(batch, order, key, after=after, folder=folder)
    if mark:
        rows = spark.read.schema(batch.schema).parquet(folder).count()  # from the footers of the copy
        spark.range(1).select(F.lit(after + rows).cast("long").alias("last")).write.mode("append").parquet(mark)
    return numbered


def insert_with_keys(
    existing: DataFrame,
    key: str,
    batch: DataFrame,
    order: list[str],
    insert,
    mark: str | None = None,
    ledger: str | None = None,
) -> None:
    """Hand the batch with its new keys to ``insert``, then remove the numbered copy."""
    spark = batch.sparkSession
    folder = new_folder(spark, "numbered")
    insert(next_keys(existing, key, batch, order, mark, folder, ledger))
    remove_folder(spark, folder)
