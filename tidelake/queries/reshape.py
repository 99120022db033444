"""Reshape and profile queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelake.functions.columns import iso_text, spread
from tidelake.operators import profile, reshape
from tidelake.queries import tables as t

_SPREAD = ", ".join(f"CASE WHEN event_type = '{e}' THEN value END AS \"{e}\"" for e in t.EVENT_TYPES)
_MAXIMA = ", ".join(f"max(CASE WHEN event_type = '{e}' THEN value END) AS \"{e}\"" for e in t.EVENT_TYPES)
_ZEROED = ", ".join(f"coalesce(\"{e}\", 0.0) AS \"{e}\"" for e in t.EVENT_TYPES)


def conditional_column(spark, sf_dir):
    return spread(t.events(spark, sf_dir), ["event_id"], "event_type", t.EVENT_TYPES, "value")


def group_max(spark, sf_dir):
    wide = spread(t.events(spark, sf_dir), ["user_id"], "event_type", t.EVENT_TYPES, "value")
    return reshape.group_max(wide, "user_id", t.EVENT_TYPES)


def fill_zero(spark, sf_dir):
    return reshape.fill_zero(conditional_column(spark, sf_dir), t.EVENT_TYPES)


def pivot_values(spark, sf_dir):
    return reshape.pivot_values(t.events(spark, sf_dir), "event_type")


def pivot_max(spark, sf_dir):
    return reshape.pivot_max(t.events(spark, sf_dir), "user_id", "event_type", "value")


def group_values(spark, sf_dir):
    """Users per event type: few groups, each with a large share of all rows."""
    grouped = reshape.group_values(t.events(spark, sf_dir), "event_type", "user_id", per_row=1_000)
    listed = F.transform("values", lambda v: F.concat_ws(":", v["value"], v["n"]))
    return grouped.select("event_type", "part", F.array_join(listed, ",").alias("values"))


def pivot_odd_names(spark, sf_dir):
    """The pivot over values that are awkward as names: dots, twins in case, the key's own, a backtick."""
    odd = {"click": "v1.2", "error": "Click", "purchase": "click", "signup": "user_id", "view": "a`b"}
    name = F.col("event_type")
    for old, new in odd.items():
        name = F.when(F.col("event_type") == old, new).otherwise(name)
    renamed = t.events(spark, sf_dir).withColumn("event_type", name)
    wide = reshape.pivot_max(renamed, "user_id", "event_type", "value", list(odd.values()))
    return wide.toDF("user_id", *[f"c{i}" for i in range(len(odd))])


def partition_profile(spark, sf_dir):
    """Rows per partition of a known split: by the id modulo five."""
    split = t.events(spark, sf_dir).repartitionById(5, (F.col("event_id") % 5).cast("int"))
    return profile.partition_profile(split)


def row_count(spark, sf_dir):
    return profile.row_count(t.table(spark, sf_dir, "lineitem"))


def schema_report(spark, sf_dir):
    return profile.schema_report(t.table(spark, sf_dir, "orders"))


def pivot_map(spark, sf_dir):
    """The pivot over types and days, as maps, taken apart again."""
    named = t.events(spark, sf_dir).withColumn("name", F.concat_ws(" ", "event_type", iso_text(F.col("ts"))))
    maps = reshape.pivot_map(named, "user_id", "name", "value", per_row=20)
    return maps.select("user_id", F.explode("values").alias("name", "value"))


def skew_report(spark, sf_dir):
    return profile.skew_report(t.events(spark, sf_dir), ["event_type", "user_id", "event_id"], share=0.002)


QUERIES = {
    "conditional_column": conditional_column,
    "group_max": group_max,
    "fill_zero": fill_zero,
    "pivot_values": pivot_values,
    "pivot_max": pivot_max,
    "pivot_odd_names": pivot_odd_names,
    "group_values": group_values,
    "partition_profile": partition_profile,
    "pivot_map": pivot_map,
    "skew_report": skew_report,
    "row_count": row_count,
    "schema_report": schema_report,
}

SQL = {
    "conditional_column": f"SELECT event_id, {_SPREAD} FROM events",
    "group_max": f"SELECT user_id, {_MAXIMA} FROM events GROUP BY user_id",
    "fill_zero": f"SELECT event_id, {_ZEROED} FROM (SELECT event_id, {_SPREAD} FROM events)",
    "pivot_values": "SELECT DISTINCT event_type FROM events WHERE event_type IS NOT NULL",
    "pivot_max": f"""
        SELECT user_id, {_ZEROED} FROM (SELECT user_id, {_MAXIMA} FROM events GROUP BY user_id)
    """,
    "group_values": """
        WITH counted AS (
            SELECT event_type, user_id, count(*) AS n FROM events GROUP BY ALL
        ), cut AS (
            SELECT event_type, CAST(ceil(count(*) / 1000.0) AS BIGINT) AS parts FROM counted GROUP BY ALL
        ), placed AS (
            SELECT c.*, CASE WHEN parts > 1
                THEN CAST('0x' || substr(md5(CAST(user_id AS VARCHAR)), 1, 8) AS BIGINT) % parts
                ELSE 0 END AS part
            FROM counted c JOIN cut USING (event_type)
        )
        SELECT event_type, CAST(part AS INTEGER) AS part,
               string_agg(concat(user_id, ':', n), ',' ORDER BY user_id) AS values
        FROM placed GROUP BY event_type, part
    """,
    "pivot_odd_names": "SELECT user_id, " + ", ".join(
        f"coalesce(max(CASE WHEN event_type = '{e}' THEN value END), 0.0) AS c{i}"
        for i, e in enumerate(["click", "error", "purchase", "signup", "view"])
    ) + " FROM events GROUP BY user_id",
    "partition_profile": "SELECT CAST(event_id % 5 AS INTEGER) AS partition, count(*) AS rows FROM events GROUP BY 1",
    "row_count": "SELECT count(*) AS rows FROM lineitem",
    "schema_report": """
        SELECT CAST(row_number() OVER () - 1 AS INTEGER) AS position, column_name AS name,
               CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz'
                    ELSE lower(column_type) END AS type,
               true AS nullable, (SELECT count(*) FROM orders) AS rows
        FROM (DESCRIBE SELECT * FROM orders)
    """,
    "pivot_map": """
        SELECT user_id, event_type || ' ' || strftime(ts, '%Y-%m-%d') AS name, max(value) AS value FROM events GROUP BY ALL
        HAVING max(value) IS NOT NULL
    """,
    "skew_report": " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS value, count(*) AS rows FROM events
        GROUP BY {c} HAVING count(*) >= (SELECT count(*) FROM events) * 0.002::DOUBLE"""
        for c in ("event_type", "user_id", "event_id")
    ),
}
