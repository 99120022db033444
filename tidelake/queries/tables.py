"""The given tables in the roles that the operators expect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidelake.functions.columns import iso_text
from tidelake.session import new_folder
from tidelake.sources.files import MOMENT_FORMAT
from tidelake.streaming.drain import read_new_files

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]

# Event types in the role of the extracts a batch waits for.
AWAITED = ["click", "view", "purchase", "signup"]

# What waits for each of them.
ACTIVITIES = {
    "click": "receive clicks",
    "view": "receive views",
    "purchase": "receive purchases",
    "signup": "receive signups",
}

# Leading path segments in the role of the key prefixes.
ROUTES = {"en/": "rental", "fr/": "customer", "de/": "payment"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("rental_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("rental_date"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("total"),
    )


def payment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("rental_id"),
        F.col("l_linenumber").alias("payment_no"),
        F.col("l_shipdate").alias("payment_date"),
        F.col("l_extendedprice").alias("amount"),
        F.col("l_linestatus").alias("status"),
    )


def customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_nationkey").alias("store_id"),
        F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"),
    )


def rental_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return rental(spark, sf_dir), payment(spark, sf_dir), customer(spark, sf_dir)


def extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("attr")
    )


def master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_nationkey").alias("attr"),
        F.col("c_name").alias("name"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def layout_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events under (store, day): five stores, one directory per day."""
    return events(spark, sf_dir).select(
        "event_id",
        F.col("ts").alias("payment_date"),
        F.col("value").cast("decimal(10,2)").alias("amount"),
        F.col("event_type").alias("store_id"),
        iso_text(F.col("ts")).alias("rental_dt"),
    )


# Texts that a careless file format would not give back.
_ODD = ["two\nlines", 'a, "quoted"\\ text', "null", "back\\", " spaced ", None]


def odd_text(number):
    """One of some odd texts, or null, by number."""
    text = F.lit(_ODD[-1]).cast("string")
    for i, value in enumerate(_ODD[:-1]):
        text = F.when(number % len(_ODD) == i, value).otherwise(text)
    return text


def odd_sql(number: str) -> str:
    """:func:`odd_text` in SQL."""
    cases = "".join(
        f" WHEN {i} THEN " + "'" + value.replace("'", "''") + "'" for i, value in enumerate(_ODD[:-1])
    )
    return f"CASE {number} % {len(_ODD)}{cases} END"


LAYOUT_SCHEMA = (
    "event_id BIGINT, payment_date TIMESTAMP_NTZ, amount DECIMAL(10,2), "
    "store_id STRING, rental_dt STRING"
)


def hourly(df: DataFrame) -> DataFrame:
    """Events as arrivals: the hour is the batch, the type is the source.

    The hour is found by subtraction; ``date_trunc`` would go through the time
    zone of the session.
    """
    past_hour = F.make_dt_interval(mins=F.minute("ts"), secs=F.extract(F.lit("SECOND"), F.col("ts")))
    return df.select(
        (F.col("ts") - past_hour).alias("batch"),
        F.col("event_type").alias("source"),
        "ts",
    )


def messages(pages: DataFrame) -> DataFrame:
    """Pages as notifications: one body with two records, a put and a removal."""
    path = F.regexp_replace("url", "^https?://[^/]+/", "")

    def record(event, key):
        return F.struct(
            F.lit(event).alias("eventName"),
            F.struct(F.struct(key.alias("key")).alias("object")).alias("s3"),
        )

    records = F.array(
        record("ObjectCreated:Put", path),
        record("ObjectRemoved:Delete", F.concat(path, F.lit(".old"))),
    )
    return pages.select("page_id", F.to_json(F.struct(records.alias("Records"))).alias("body"))


def stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a stream of its files, be it one file or a folder of files."""
    schema = table(spark, sf_dir, name).schema
    # The bracket makes the path a pattern, which a single file needs.
    return read_new_files(spark, f"{sf_dir}/{name}.parque[t]", schema)


def kept(df: DataFrame) -> DataFrame:
    """The rows as they are now, written to the shared folder."""
    path = new_folder(df.sparkSession, "kept")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_csv(df: DataFrame, path: str) -> str:
    df.write.option("header", True).option("timestampNTZFormat", MOMENT_FORMAT).csv(path)
    return path
