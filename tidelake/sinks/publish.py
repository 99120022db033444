"""Change a Parquet layout by whole batches: each is published once, however often it is tried.

A change is staged below ``_published/<name>`` in the layout, where readers do not look.
A plan of the files that come and go is written next, and only then are files moved and
removed; a mark says that all is done. What dies before the plan leaves nothing behind but
the staged files, which the next try replaces; what dies after it is finished by the next
try from the plan, as each step can be repeated. A reader in the middle of the moves may
see some of the files of a batch, as with any plain folder of files.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidelake.session import (
    files_below, folder_names, mark_file, move_file, new_folder, path_exists, remove_file, remove_folder,
)
from tidelake.sinks.partitioned import write_partitioned

LEDGER = "_published"
_DONE = "done"
# Files that one job of a compaction takes in, since their names are part of its plan.
FILES_PER_ROUND = 10_000


def _log(path: str, name: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9.-]*", name):
        raise ValueError("a batch is named by letters, digits, dots and dashes")
    return f"{path}/{LEDGER}/{name}"


def is_published(spark: SparkSession, path: str, name: str) -> bool:
    return path_exists(spark, f"{_log(path, name)}/{_DONE}")


def _finish(spark: SparkSession, path: str, name: str) -> None:
    """Carry out a plan, from wherever it was left."""
    log = _log(path, name)
    for step in spark.read.schema("source string, target string").parquet(f"{log}/plan").toLocalIterator():
        if step["target"] is not None:
            move_file(spark, step["source"], step["target"])
    for step in spark.read.schema("source string, target string").parquet(f"{log}/plan").toLocalIterator():
        if step["target"] is None:
            remove_file(spark, step["source"])
    mark_file(spark, f"{log}/{_DONE}")
    remove_folder(spark, f"{log}/staged")


def _commit(spark: SparkSession, path: str, name: str, removed: list[str]) -> None:
    """Plan the staged files in and others out, and do it."""
    log = _log(path, name)
    steps = []
    for file in files_below(spark, f"{log}/staged"):
        folder, _, leaf = file.rpartition("/")
        if not leaf.startswith(("_", ".")):
            steps.append((f"{log}/staged/{file}", "/".join(filter(None, [path, folder, f"{name}-{leaf}"]))))
    steps += [(file, None) for file in removed]
    plan = spark.createDataFrame(steps, "source string, target string")
    plan.coalesce(1).write.mode("overwrite").parquet(f"{log}/plan")
    _finish(spark, path, name)


def recover(spark: SparkSession, path: str) -> None:
    """Finish what was planned and not done."""
    if not path_exists(spark, f"{path}/{LEDGER}"):
        return
    for name in folder_names(spark, f"{path}/{LEDGER}"):
        if path_exists(spark, f"{_log(path, name)}/plan/_SUCCESS") and not is_published(spark, path, name):
            _finish(spark, path, name)


def publish_batch(df: DataFrame, path: str, keys: list[str], batch: str) -> bool:
    """Append a batch to a partitioned Parquet layout once; says whether this call did it.

    A batch whose name is published already adds nothing, whatever ``df`` holds now. One
    that was planned is finished with the rows it had then.
    """
    spark, log = df.sparkSession, _log(path, batch)
    if is_published(spark, path, batch):
        return False
    if path_exists(spark, f"{log}/plan/_SUCCESS"):
        _finish(spark, path, batch)
        return True
    remove_folder(spark, f"{log}/staged")
    if keys:
        write_partitioned(df, f"{log}/staged", keys, mode="append")
    else:
        df.write.parquet(f"{log}/staged")
    _commit(spark, path, batch, [])
    return True


def stored_files(spark: SparkSession, path: str) -> DataFrame:
    """path, directory and bytes of the files of a layout; nothing of them is read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return listed.select("path", F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("directory"), F.col("length").alias("bytes"))


def small_files(files: DataFrame, target: int) -> DataFrame:
    """The files worth merging, with the bin of their directory that they go into.

    Small is below half of ``target``. The small files of a directory are put into bins
    of some ``target`` bytes, by size; a bin of one file has nothing to merge with.
    """
    small = files.filter(F.col("bytes") < target / 2)
    before = "sum(bytes) OVER (PARTITION BY directory ORDER BY bytes, path ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    binned = small.withColumn("bin", F.floor(F.coalesce(F.expr(before), F.lit(0)) / target))
    several = F.expr("count(*) OVER (PARTITION BY directory, bin)")
    return binned.withColumn("files", several).filter("files > 1").drop("files")


def compact_small(spark: SparkSession, path: str, keys: list[str], target: int = 128 << 20) -> None:
    """Merge the small files of each directory of a Parquet layout, in place.

    Files that are large, or alone in their bin, are neither read nor renamed. A hot
    directory is cut by ``spark.sql.adaptive.advisoryPartitionSizeInBytes``, which should
    not be below ``target``. Each round takes ``FILES_PER_ROUND`` files and leaves fewer.
    """
    recover(spark, path)
    stored = spark.read.parquet(path).schema
    # Keys as text, so that a directory such as store_id=01 keeps its name.
    as_text = T.StructType([T.StructField(f.name, T.StringType() if f.name in keys else f.dataType) for f in stored])
    while True:
        chosen = small_files(stored_files(spark, path), target).orderBy("directory", "bin", "path")
        files = chosen.limit(FILES_PER_ROUND + 1).collect()
        if len(files) > FILES_PER_ROUND:  # the last bin may go on in the next round
            last = files.pop()
            whole = [f for f in files if (f["directory"], f["bin"]) != (last["directory"], last["bin"])]
            files = whole or files
        if not files:
            return
        name = new_folder(spark, "compact").rpartition("/")[2]
        rows = spark.read.schema(as_text).option("basePath", path).parquet(*[f["path"] for f in files])
        write_partitioned(rows, f"{_log(path, name)}/staged", keys, mode="append")
        _commit(spark, path, name, [f["path"] for f in files])
