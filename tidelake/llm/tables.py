"""Small helpers that the operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidelake.session import new_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Rows and bytes of one Arrow batch: texts may be long, and a task has a batch on both sides.
BATCH_ROWS = 1_000
BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Let this session hand texts to Python in small batches, to bound memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def keyed(df: DataFrame, key: str, value: str, names: tuple[str, str] = ("doc_id", "text")) -> DataFrame:
    """Only the two columns an operator works on, so that no other name can clash."""
    small_batches(df.sparkSession)
    return df.select(df[key].cast("long").alias(names[0]), df[value].alias(names[1]))


# The identity of a row where ids may be null or repeat.
ROW = "_row_hash"


def row_hash(key: str, text: str) -> Column:
    """64 bits of id and text; rows that repeat both are the same to any decision."""
    return F.xxhash64(F.col(key).isNull(), F.col(key), F.col(text).isNull(), F.col(text))


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows, written to the shared folder and read again.

    Cuts the lineage in a way that outlives executors, and gives the planner the true size.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# Bits of a sieve: 8 MB, whatever the number of keys.
SIEVE_BITS = 1 << 26


def _bit(hash_: Column) -> Column:
    return F.pmod(hash_, F.lit(SIEVE_BITS)) + 1


def sieve_pages(hashes: DataFrame) -> DataFrame:
    """page and bits (4,096 bytes) of the sieve of the one column of 64-bit hashes."""
    bit = _bit(F.col(hashes.columns[0]))
    return hashes.groupBy(F.bitmap_bucket_number(bit).alias("page")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits")
    )


def sieve(hashes: DataFrame) -> np.ndarray:
    """A bit for each remainder of the one column of 64-bit hashes, for `probable`.

    A fixed size bounds what is collected; with too many keys it lets more rows through,
    so that an exact join has to follow.
    """
    found = np.zeros(SIEVE_BITS // 8, np.uint8)
    for row in sieve_pages(hashes).collect():
        part = np.frombuffer(row["bits"], np.uint8)
        found[(row["page"] - 1) * len(part) : row["page"] * len(part)] = part
    return found


def probable(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """False only where no key had this hash."""
    bit = hashes % SIEVE_BITS
    return bits[bit >> 3] >> (bit & 7).astype(np.uint8) & 1 > 0


def sifted(df: DataFrame, sieves: dict[str, np.ndarray]) -> DataFrame:
    """The rows that pass the sieves of the columns of 64-bit hashes.

    Spares a join where a few rows too many do no harm, or fall out later.
    """
    shared = df.sparkSession.sparkContext.broadcast({df.columns.index(name): bits for name, bits in sieves.items()})

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [probable(bits, batch.column(at).to_numpy()) for at, bits in shared.value.items()]
            yield batch.filter(pa.array(np.logical_and.reduce(kept)))

    return df.mapInArrow(work, df.schema)


def with_sieve(df: DataFrame, hash_: str, pages: DataFrame, found: str) -> DataFrame:
    """The rows with a boolean column ``found``, false only where no key of the sieve has the hash.

    Wide rows are neither shuffled nor handed to Python; the sieve is broadcast.
    """
    page, bits = f"{found}_page", f"{found}_bits"
    bit = _bit(F.col(hash_))
    at = F.bitmap_bit_position(bit)
    byte = F.conv(F.hex(F.substring(F.col(bits), F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
    is_set = F.floor(byte / F.pow(F.lit(2), at % 8)) % 2 == 1
    joined = df.join(F.broadcast(pages.toDF(page, bits)), F.bitmap_bucket_number(bit) == F.col(page), "left")
    return joined.withColumn(found, F.coalesce(is_set, F.lit(False))).drop(page, bits)


def slices(batch: pa.RecordBatch, column: int, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in parts of some ``size`` bytes of a column of texts; a longer text is a part of its own."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy())
    at = 0
    while at < batch.num_rows:
        to = max(int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, "right")), at + 1)
        yield batch.slice(at, to - at)
        at = to


def texts(column: pa.Array) -> Iterator[str]:
    """The texts of an Arrow column one by one; null is empty."""
    for value in column:
        yield value.as_py() or ""


def with_columns(df: DataFrame, added: str) -> str:
    """The schema of ``df`` and what is added to it, as DDL."""
    kept = [f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema]
    return ", ".join([*kept, added])
