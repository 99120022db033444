"""Read file-arrival notifications out of JSON message bodies.

All functions take a batch or a streaming DataFrame with a text column
``body``; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Fixed message layout: Records[].eventName and Records[].s3.object.key.
NOTIFICATION = T.StructType([
    T.StructField("Records", T.ArrayType(T.StructType([
        T.StructField("eventName", T.StringType()),
        T.StructField("s3", T.StructType([
            T.StructField("object", T.StructType([T.StructField("key", T.StringType())])),
        ])),
    ]))),
])


def _records(body: str) -> Column:
    return F.from_json(F.col(body), NOTIFICATION)["Records"]


def _others(messages: DataFrame, body: str) -> list[str]:
    return [name for name in messages.columns if name != body]


def parse_notifications(messages: DataFrame, body: str = "body") -> DataFrame:
    """One row per record of every message: ``record_no, event_name, key``."""
    kept = _others(messages, body)
    records = messages.select(*kept, F.posexplode(_records(body)).alias("record_no", "_record"))
    return records.select(
        *kept,
        "record_no",
        F.col("_record.eventName").alias("event_name"),
        F.col("_record.s3.object.key").alias("key"),
    )


def first_record(messages: DataFrame, body: str = "body") -> DataFrame:
    """Only the first record of every message; null where there is none."""
    kept = _others(messages, body)
    records = messages.select(*kept, F.get(_records(body), F.lit(0)).alias("_record"))
    return records.select(
        *kept,
        F.col("_record.eventName").alias("event_name"),
        F.col("_record.s3.object.key").alias("key"),
    )


def created(records: DataFrame) -> DataFrame:
    """Only the records of files that have come; others, such as removals, start nothing."""
    return records.filter(F.col("event_name").startswith("ObjectCreated"))


def malformed_notifications(messages: DataFrame, body: str = "body") -> DataFrame:
    """Messages whose body holds no record list, kept whole for a later look."""
    return messages.filter(_records(body).isNull())
