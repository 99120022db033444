"""Drain a file source into tables, exactly once per file."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tidelake.session import folder_names, path_exists, remove_folder


def read_new_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    file_format: str = "parquet",
    files_per_batch: int = 10_000,
    **options,
) -> DataFrame:
    """A stream of the files below ``path`` that its checkpoint has not seen.

    Files of any age are read, as copies keep old times. For that the
    checkpoint remembers the name of each file it has ever seen.
    """
    return (
        spark.readStream.format(file_format)
        .schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("maxFileAge", "36500d")
        .options(**options)
        .load(path)
    )


def drain_to_table(stream: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Append everything that has arrived to a Parquet table, then stop.

    Progress is committed after the write. A second run with the same
    checkpoint adds only new input; after a failure the open batch is redone
    and its half-written files are not part of the table.
    """
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", table)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def _stored(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    fields = [field for field in schema.fields if field.name != "epoch"]
    return spark.read.schema(T.StructType([*fields, T.StructField("epoch", T.LongType())])).parquet(table)


def drain_aggregate(
    stream: DataFrame, table: str, checkpoint: str, keys: list[str], mode: str = "update"
) -> StreamingQuery:
    """Keep the last row of every key of an aggregating stream, then stop.

    Each batch writes the whole keyed table below ``epoch=N``: its own rows and
    those of the epoch before whose key it lacks. A redone batch overwrites its
    own folder, so the table stays right, and older folders are removed at the
    end. An empty first folder makes the table readable before anything has
    arrived.
    """
    spark = stream.sparkSession
    spark.createDataFrame([], stream.schema).write.mode("ignore").parquet(f"{table}/epoch=-1")

    def write(rows: DataFrame, epoch: int) -> None:
        before = _stored(spark, table, stream.schema).filter(F.col("epoch") < epoch)
        last = before.agg(F.max("epoch")).first()[0]
        kept = before.filter(F.col("epoch") == F.lit(last)).drop("epoch")
        names = {name: f"_new_{i}" for i, name in enumerate(keys)}
        changed = rows.select(*[F.col(name).alias(new) for name, new in names.items()])
        same = [F.col(name).eqNullSafe(F.col(new)) for name, new in names.items()]
        merged = rows.unionByName(kept.join(changed, same, "left_anti")).hint("rebalance")
        merged.write.mode("overwrite").parquet(f"{table}/epoch={epoch}")

    query = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    epochs = [int(name.removeprefix("epoch=")) for name in folder_names(spark, table) if name.startswith("epoch=")]
    for epoch in epochs:
        if 0 <= epoch < max(epochs):
            remove_folder(spark, f"{table}/epoch={epoch}")
    return query


def drain_changes(stream: DataFrame, table: str, checkpoint: str, mode: str = "update") -> StreamingQuery:
    """Write only the rows that a batch of an aggregating stream has changed, then stop.

    Spark's state store keeps one row for each key, from which a restart goes on; each
    batch writes what it changed below ``epoch=N``, which it overwrites if it is redone.
    :func:`current_rows` reads the last row of each key, :func:`fold_changes` keeps the
    number of folders small.
    """
    stream.sparkSession.createDataFrame([], stream.schema).write.mode("ignore").parquet(f"{table}/epoch=-1")

    def write(rows: DataFrame, epoch: int) -> None:
        rows.hint("rebalance").write.mode("overwrite").parquet(f"{table}/epoch={epoch}")

    query = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def _changes(spark: SparkSession, table: str) -> list[int]:
    return sorted(int(name.removeprefix("epoch=")) for name in folder_names(spark, table) if name.startswith("epoch="))


def current_rows(spark: SparkSession, table: str, schema: T.StructType, keys: list[str]) -> DataFrame:
    """The rows of a :func:`drain_changes` table, one for each key: that of its last batch.

    A folder that :func:`fold_changes` wrote is named by the last batch that went into it
    and read instead of all up to that.
    """
    folded = [int(name.removeprefix("folded-")) for name in folder_names(spark, table) if re.fullmatch(r"folded-\d+", name)]
    whole = max((n for n in folded if path_exists(spark, f"{table}/folded-{n}/_SUCCESS")), default=None)
    later = [epoch for epoch in _changes(spark, table) if whole is None or epoch > whole]
    folders = [f"{table}/epoch={epoch}" for epoch in later] + ([f"{table}/folded-{whole}"] if whole is not None else [])
    if not folders:
        return spark.createDataFrame([], schema)
    at = F.regexp_extract("_metadata.file_path", r"/(?:epoch=|folded-)(-?\d+)/[^/]*$", 1).cast("long")
    rows = spark.read.schema(schema).parquet(*folders).withColumn("_epoch", at)
    values = F.struct(*[F.col(f"`{name}`") for name in schema.names])
    return rows.groupBy(*keys).agg(F.max_by(values, "_epoch").alias("_row")).select("_row.*")


def fold_changes(spark: SparkSession, table: str, schema: T.StructType, keys: list[str]) -> None:
    """Write the current row of each key to one folder and remove those it stands for.

    Readers go by the folded folder as soon as it is whole, so that this may die anywhere.
    """
    epochs = _changes(spark, table)
    if epochs[-1] < 0:
        return
    target = f"folded-{epochs[-1]}"
    if not path_exists(spark, f"{table}/{target}/_SUCCESS"):
        current_rows(spark, table, schema, keys).hint("rebalance").write.mode("overwrite").parquet(f"{table}/{target}")
    for epoch in epochs[:-1]:
        remove_folder(spark, f"{table}/epoch={epoch}")
    for name in folder_names(spark, table):
        if name.startswith("folded-") and name != target:
            remove_folder(spark, f"{table}/{name}")


def latest_rows(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    """The rows of a :func:`drain_aggregate` table, one for each key."""
    rows = _stored(spark, table, schema)
    last = rows.agg(F.max("epoch")).first()[0]
    return rows.filter(F.col("epoch") == F.lit(last)).drop("epoch")
