"""A ledger of the files that were read, kept as a table and not in the memory of a checkpoint.

A run lists the inbox, leaves out what the ledger has by an anti join, and reads the rest
in batches. The files of a batch are written to the ledger before they are read, under
the number of the batch; its rows are then published under that number, once. A batch
that died on the way is redone with the files it had. Read files can be moved to an
archive, so that the inbox, whose listing the driver holds, only has what is new.

A file counts by its name below the inbox, not by its time: an old file that comes late
is read, and a name that comes again is not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidelake.session import folder_names, move_file, path_exists, remove_folder
from tidelake.sinks.publish import is_published, publish_batch

# Files of one batch, whose names are part of its plan.
FILES_PER_BATCH = 10_000
_FILES = "path string, name string"


def _batches(spark: SparkSession, ledger: str) -> list[int]:
    """Numbers of the batches whose list of files was written whole."""
    if not path_exists(spark, ledger):
        return []
    numbers = [int(n.removeprefix("batch=")) for n in folder_names(spark, ledger) if n.startswith("batch=")]
    return sorted(n for n in numbers if path_exists(spark, f"{ledger}/batch={n}/_SUCCESS"))


def seen_files(spark: SparkSession, ledger: str) -> DataFrame:
    """batch, path and name of every file that was taken in."""
    schema = f"{_FILES}, batch long"
    if not _batches(spark, ledger):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(ledger)


def new_files(spark: SparkSession, inbox: str, ledger: str) -> DataFrame:
    """path and name of the files in the inbox that the ledger does not have."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(inbox)
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(inbox)
    root = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(root).toString().rstrip("/")
    files = listed.select("path", F.substring("path", len(root) + 2, 1 << 30).alias("name"))
    return files.join(seen_files(spark, ledger).select("name"), "name", "left_anti")


def drain_files(
    spark: SparkSession,
    inbox: str,
    schema: T.StructType,
    table: str,
    ledger: str,
    file_format: str = "parquet",
    files_per_batch: int = FILES_PER_BATCH,
    archive: str | None = None,
    **options,
) -> int:
    """Append the rows of all new files to a Parquet table, each file once; says how many batches ran."""

    def read(number: int) -> None:
        name = f"batch-{number}"
        taken = spark.read.schema(_FILES).parquet(f"{ledger}/batch={number}")
        if not is_published(spark, table, name):
            paths = [row["path"] for row in taken.select("path").collect()]  # at most files_per_batch
            rows = spark.read.format(file_format).schema(schema).options(**options).load(paths)
            publish_batch(rows, table, [], name)
        if archive:
            for row in taken.toLocalIterator():
                move_file(spark, row["path"], f"{archive}/{row['name']}")

    known, ran = _batches(spark, ledger), 0
    if known:
        read(known[-1])  # does nothing if it was finished
    number = known[-1] + 1 if known else 0
    while True:
        remove_folder(spark, f"{ledger}/batch={number}")
        found = new_files(spark, inbox, ledger).orderBy("name").limit(files_per_batch)
        found.select("path", "name").coalesce(1).write.parquet(f"{ledger}/batch={number}")
        if spark.read.schema(_FILES).parquet(f"{ledger}/batch={number}").isEmpty():
            remove_folder(spark, f"{ledger}/batch={number}")
            return ran
        read(number)
        number, ran = number + 1, ran + 1
