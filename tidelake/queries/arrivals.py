"""Arrival queries: pages as notifications, events as awaited extracts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelake.functions.columns import result_json
from tidelake.functions.notifications import (
    created,
    first_record,
    malformed_notifications,
    parse_notifications,
)
from tidelake.operators import arrivals as ops
from tidelake.operators.filters import lookup_exact, route_by_rules, route_prefix, unmatched_keys
from tidelake.plans.arrivals import drain_and_open
from tidelake.queries import tables as t
from tidelake.session import new_folder
from tidelake.streaming.drain import current_rows, drain_aggregate, drain_changes, drain_to_table, fold_changes, latest_rows
from tidelake.streaming.gate import drain_gate, gate_rows
from tidelake.streaming.ledger import drain_files

_ROLES = list(t.ROUTES.values())
_ORDER = ["page_id", "record_no"]

_PATH = "regexp_replace(url, '^https?://[^/]+/', '')"
_KEYS = f"""
    SELECT page_id, 0 AS record_no, 'ObjectCreated:Put' AS event_name, {_PATH} AS key FROM pages
    UNION ALL
    SELECT page_id, 1, 'ObjectRemoved:Delete', {_PATH} || '.old' FROM pages
"""
_ROLE = """
    CASE WHEN starts_with(key, 'en/') THEN 'rental' WHEN starts_with(key, 'fr/') THEN 'customer'
         WHEN starts_with(key, 'de/') THEN 'payment' END
"""
_MANIFEST = f"""
    SELECT role, arg_max(key, page_id * 2 + record_no) AS key
    FROM (SELECT *, {_ROLE} AS role FROM ({_KEYS}) WHERE event_name LIKE 'ObjectCreated%')
    WHERE role IS NOT NULL GROUP BY role
"""
_ARRIVED = "SELECT date_trunc('hour', ts) AS batch, event_type AS source, ts FROM events"
_GATE = f"""
    SELECT batch, max(first) AS ready_at
    FROM (SELECT batch, source, min(ts) AS first FROM ({_ARRIVED})
          WHERE source IN ('click', 'view', 'purchase', 'signup') GROUP BY ALL)
    GROUP BY batch HAVING count(*) = 4
"""
_MISSING = f"""
    SELECT batch, unnest(['click', 'view', 'purchase', 'signup']) AS source
    FROM (SELECT DISTINCT batch FROM ({_ARRIVED}))
    EXCEPT SELECT batch, source FROM ({_ARRIVED})
"""
_BODY = f"""
    '{{"Records":[{{"eventName":"ObjectCreated:Put","s3":{{"object":{{"key":"' || {_PATH}
    || '"}}}}}},{{"eventName":"ObjectRemoved:Delete","s3":{{"object":{{"key":"' || {_PATH} || '.old"}}}}}}]}}'
"""


def _messages(spark, sf_dir):
    return t.messages(t.table(spark, sf_dir, "pages"))


def _keys(spark, sf_dir):
    return parse_notifications(_messages(spark, sf_dir))


def _arrived(spark, sf_dir):
    return t.hourly(t.events(spark, sf_dir))


def _routed(spark, sf_dir):
    return route_prefix(_keys(spark, sf_dir), t.ROUTES)


def parse(spark, sf_dir):
    return _keys(spark, sf_dir)


def first(spark, sf_dir):
    return first_record(_messages(spark, sf_dir))


def malformed(spark, sf_dir):
    """Raw page text among the bodies is set aside, notifications are not."""
    pages = t.table(spark, sf_dir, "pages")
    mixed = t.messages(pages).union(pages.select("page_id", F.col("html").alias("body")))
    return malformed_notifications(mixed)


def route(spark, sf_dir):
    return _routed(spark, sf_dir)


def lookup(spark, sf_dir):
    return lookup_exact(_arrived(spark, sf_dir), t.ACTIVITIES, key="source")


def unmatched(spark, sf_dir):
    return unmatched_keys(_arrived(spark, sf_dir), t.ACTIVITIES, key="source")


def json_build(spark, sf_dir):
    return _keys(spark, sf_dir).select(
        "page_id", "record_no", result_json(F.concat(F.lit('File "'), "key", F.lit('" is received'))).alias("json")
    )


def manifest_latest(spark, sf_dir):
    return ops.manifest_latest(created(_routed(spark, sf_dir)), _ROLES, _ORDER)


def manifest_row(spark, sf_dir):
    return ops.manifest_row(created(_routed(spark, sf_dir)), [*_ROLES, "refund"], _ORDER)


def arrival_gate(spark, sf_dir):
    return ops.arrival_gate(_arrived(spark, sf_dir), "batch", "source", "ts", t.AWAITED)


def arrival_missing(spark, sf_dir):
    return ops.arrival_missing(_arrived(spark, sf_dir), "batch", "source", "ts", t.AWAITED)


def incremental_files(spark, sf_dir):
    """Two runs over the same files; the second one finds nothing new."""
    folder = new_folder(spark, "stream")
    for _ in range(2):
        drain_to_table(t.stream(spark, sf_dir, "events"), f"{folder}/table", f"{folder}/checkpoint")
    return spark.read.parquet(f"{folder}/table")


def stream_drain(spark, sf_dir):
    folder = new_folder(spark, "stream")
    bodies = t.messages(t.stream(spark, sf_dir, "pages"))
    drain_to_table(bodies, f"{folder}/table", f"{folder}/checkpoint")
    return spark.read.parquet(f"{folder}/table")


def stream_parse(spark, sf_dir):
    folder = new_folder(spark, "stream")
    keys = parse_notifications(t.messages(t.stream(spark, sf_dir, "pages")))
    drain_to_table(keys, f"{folder}/table", f"{folder}/checkpoint")
    return spark.read.parquet(f"{folder}/table")


def _aggregated(spark, rows, keys):
    folder = new_folder(spark, "stream")
    drain_aggregate(rows, f"{folder}/table", f"{folder}/checkpoint", keys)
    return latest_rows(spark, f"{folder}/table", rows.schema)


def stream_manifest(spark, sf_dir):
    routed = route_prefix(parse_notifications(t.messages(t.stream(spark, sf_dir, "pages"))), t.ROUTES)
    return _aggregated(spark, ops.manifest_latest(created(routed), _ROLES, _ORDER), ["role"])


def stream_gate(spark, sf_dir):
    arrived = t.hourly(t.stream(spark, sf_dir, "events"))
    return _aggregated(spark, ops.arrival_gate(arrived, "batch", "source", "ts", t.AWAITED), ["batch"])


def route_rules(spark, sf_dir):
    """Routing by rules that come from the data: a beginning of each path is a prefix."""
    keys = _keys(spark, sf_dir)
    rules = keys.filter("record_no = 0").select(
        F.expr("substring(key, 1, 4 + CAST(page_id % 9 AS INT))").alias("prefix"), F.concat(F.lit("r"), F.col("page_id") % 7).alias("role")
    )
    return route_by_rules(keys, rules)


def stream_latest(spark, sf_dir):
    """The last key of each role, from the changes that the batches of a stream wrote."""
    folder = new_folder(spark, "stream")
    routed = route_prefix(parse_notifications(t.messages(t.stream(spark, sf_dir, "pages"))), t.ROUTES)
    rows = ops.latest_by_role(created(routed), _ORDER)
    drain_changes(rows, f"{folder}/table", f"{folder}/checkpoint")
    fold_changes(spark, f"{folder}/table", rows.schema, ["role"])
    return current_rows(spark, f"{folder}/table", rows.schema, ["role"])


def gate_states(spark, sf_dir):
    """Opened and missing batches of a stream that forgets what is a day older than the latest."""
    folder = new_folder(spark, "gate")
    drain_gate(t.hourly(t.stream(spark, sf_dir, "events")), folder, t.AWAITED, delay="1 day")
    return gate_rows(spark, folder)


def ledger_files(spark, sf_dir):
    """Files read once by a ledger of their names, over two runs, with an archive."""
    folder = new_folder(spark, "ledger")
    rows = t.events(spark, sf_dir)
    for part in range(2):
        rows.filter(F.col("event_id") % 2 == part).write.mode("append").parquet(f"{folder}/inbox")
        for _ in range(2):
            drain_files(
                spark, f"{folder}/inbox", rows.schema, f"{folder}/table", f"{folder}/ledger", archive=f"{folder}/archive"
            )
    return spark.read.schema(rows.schema).parquet(f"{folder}/table")


def wait_for_all(spark, sf_dir):
    """The wait-for-all job, run twice: batches opened by each run, and what others lack."""
    folder = new_folder(spark, "waiting")
    runs = [
        drain_and_open(spark, t.hourly(t.stream(spark, sf_dir, "events")), folder, t.AWAITED) for _ in range(2)
    ]
    opened = [
        run.select("batch", F.lit(f"opened {i}").alias("state"), F.lit(None).cast("string").alias("source"), "ready_at")
        for i, (run, _) in enumerate(runs)
    ]
    missing = runs[1][1].select(
        "batch", F.lit("missing").alias("state"), "source", F.lit(None).cast("timestamp_ntz").alias("ready_at")
    )
    return opened[0].union(opened[1]).union(missing)


QUERIES = {
    "parse_notifications": parse,
    "first_record": first,
    "malformed_notifications": malformed,
    "route_prefix": route,
    "lookup_exact": lookup,
    "unmatched_keys": unmatched,
    "json_build": json_build,
    "manifest_latest": manifest_latest,
    "manifest_row": manifest_row,
    "arrival_gate": arrival_gate,
    "arrival_missing": arrival_missing,
    "incremental_files": incremental_files,
    "stream_drain": stream_drain,
    "stream_parse": stream_parse,
    "stream_manifest": stream_manifest,
    "stream_gate": stream_gate,
    "wait_for_all": wait_for_all,
    "route_rules": route_rules,
    "stream_latest": stream_latest,
    "gate_states": gate_states,
    "ledger_files": ledger_files,
}

SQL = {
    "parse_notifications": _KEYS,
    "first_record": f"SELECT page_id, 'ObjectCreated:Put' AS event_name, {_PATH} AS key FROM pages",
    "malformed_notifications": "SELECT page_id, html AS body FROM pages",
    "route_prefix": f"SELECT *, {_ROLE} AS role FROM ({_KEYS})",
    "lookup_exact": f"""
        SELECT a.*, r.target FROM ({_ARRIVED}) AS a LEFT JOIN (VALUES ('click', 'receive clicks'),
            ('view', 'receive views'), ('purchase', 'receive purchases'), ('signup', 'receive signups'))
            AS r(source, target) ON a.source = r.source
    """,
    "unmatched_keys": f"""
        SELECT * FROM ({_ARRIVED}) WHERE source NOT IN ('click', 'view', 'purchase', 'signup')
    """,
    "json_build": f"""
        SELECT page_id, record_no, CAST(to_json({{'Result': 'File "' || key || '" is received'}}) AS VARCHAR) AS json
        FROM ({_KEYS})
    """,
    "manifest_latest": _MANIFEST,
    "manifest_row": f"""
        SELECT max(key) FILTER (role = 'rental') AS rental, max(key) FILTER (role = 'payment') AS payment,
               max(key) FILTER (role = 'customer') AS customer, NULL::VARCHAR AS refund
        FROM ({_MANIFEST})
    """,
    "arrival_gate": _GATE,
    "arrival_missing": _MISSING,
    "incremental_files": "SELECT * FROM events",
    "stream_drain": f"SELECT page_id, {_BODY} AS body FROM pages",
    "stream_parse": _KEYS,
    "stream_manifest": _MANIFEST,
    "stream_gate": _GATE,
    "wait_for_all": f"""
        SELECT batch, 'opened 0' AS state, NULL::VARCHAR AS source, ready_at FROM ({_GATE})
        UNION ALL SELECT batch, 'missing', source, NULL::TIMESTAMP FROM ({_MISSING})
    """,
    "route_rules": f"""
        SELECT k.page_id, k.record_no, any_value(k.event_name) AS event_name, any_value(k.key) AS key,
               min_by(r.role, {{'length': -length(r.prefix), 'role': r.role}}) AS role
        FROM ({_KEYS}) AS k LEFT JOIN (
            SELECT substr(key, 1, CAST(4 + page_id % 9 AS INT)) AS prefix, 'r' || page_id % 7 AS role
            FROM ({_KEYS}) WHERE record_no = 0
        ) AS r ON starts_with(k.key, r.prefix) GROUP BY k.page_id, k.record_no
    """,
    "stream_latest": _MANIFEST,
    "gate_states": f"""
        SELECT 'opened' AS state, batch, NULL::VARCHAR AS source, ready_at AS ts FROM ({_GATE})
        UNION ALL SELECT 'missing', batch, source, NULL::TIMESTAMP FROM ({_MISSING})
        WHERE batch < (SELECT max(date_trunc('hour', ts)) - INTERVAL 1 DAY FROM events)
    """,
    "ledger_files": "SELECT * FROM events",
}
