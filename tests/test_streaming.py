from __future__ import annotations

import datetime
import json
import os
from pathlib import Path

import pytest

from tidelake.functions.notifications import parse_notifications
from tidelake.operators.arrivals import arrival_gate, latest_by_role, manifest_latest
from tidelake.operators.filters import route_prefix
from tidelake.plans.arrivals import drain_and_build, drain_and_open
from tidelake.streaming.drain import (
    current_rows,
    drain_aggregate,
    drain_changes,
    drain_to_table,
    fold_changes,
    latest_rows,
    read_new_files,
)

MESSAGES = "seq long, body string"


def schema_of(spark, text):
    return spark.createDataFrame([], text).schema


def post(spark, folder, rows, text=MESSAGES):
    spark.createDataFrame(rows, text).coalesce(1).write.mode("append").parquet(folder)


def body(*keys):
    return json.dumps({"Records": [{"eventName": "ObjectCreated:Put", "s3": {"object": {"key": k}}} for k in keys]})


@pytest.fixture
def box(tmp_path):
    return {name: str(tmp_path / name) for name in ("inbox", "table", "checkpoint", "state", "mart")}


def test_only_new_files_are_added(spark, box):
    schema = schema_of(spark, MESSAGES)

    def drain():
        drain_to_table(read_new_files(spark, box["inbox"], schema), box["table"], box["checkpoint"])
        return sorted(r.seq for r in spark.read.parquet(box["table"]).collect())

    post(spark, box["inbox"], [(1, "a"), (2, "b")])
    assert drain() == [1, 2]
    assert drain() == [1, 2]
    post(spark, box["inbox"], [(3, "c")])
    assert drain() == [1, 2, 3]


def test_old_files_are_read(spark, box):
    schema = schema_of(spark, MESSAGES)

    def drain():
        drain_to_table(read_new_files(spark, box["inbox"], schema), box["table"], box["checkpoint"])
        return sorted(r.seq for r in spark.read.parquet(box["table"]).collect())

    post(spark, box["inbox"], [(1, "new")])
    assert drain() == [1]
    known = set(Path(box["inbox"]).glob("part-*"))
    post(spark, box["inbox"], [(2, "copied with its time")])
    for part in set(Path(box["inbox"]).glob("part-*")) - known:
        os.utime(part, (1_000_000_000, 1_000_000_000))
    assert drain() == [1, 2]


def test_manifest_follows_later_files(spark, box, rows):
    schema = schema_of(spark, MESSAGES)

    def manifest():
        keys = parse_notifications(read_new_files(spark, box["inbox"], schema, files_per_batch=1))
        latest = manifest_latest(
            route_prefix(keys, {"r/": "rental", "p/": "payment"}), ["rental", "payment"], ["seq", "record_no"]
        )
        drain_aggregate(latest, box["table"], box["checkpoint"], ["role"])
        return rows(latest_rows(spark, box["table"], latest.schema))

    Path(box["inbox"]).mkdir()
    assert manifest() == []
    post(spark, box["inbox"], [(5, body("r/5", "r/6")), (6, "not json")])
    post(spark, box["inbox"], [(4, body("r/4", "x/1"))])
    assert manifest() == [("rental", "r/6")]
    post(spark, box["inbox"], [(7, body("p/7")), (8, body("r/8"))])
    assert manifest() == [("payment", "p/7"), ("rental", "r/8")]


def test_gate_opens_across_runs(spark, box, rows):
    text = "batch string, source string, ts timestamp_ntz"
    schema = schema_of(spark, text)
    day = datetime.datetime(2024, 1, 1)

    def gate():
        arrived = read_new_files(spark, box["inbox"], schema, files_per_batch=1)
        ready = arrival_gate(arrived, "batch", "source", "ts", ["a", "b"])
        drain_aggregate(ready, box["table"], box["checkpoint"], ["batch"])
        assert len(list(Path(box["table"]).glob("epoch=*"))) == 2  # the last one and the empty one
        return rows(latest_rows(spark, box["table"], ready.schema))

    post(spark, box["inbox"], [("x", "a", day), ("y", "a", day)], text)
    post(spark, box["inbox"], [("x", "b", day.replace(hour=5))], text)
    assert gate() == [("x", day.replace(hour=5))]
    post(spark, box["inbox"], [("y", "b", day.replace(hour=6)), ("x", "b", day.replace(hour=7))], text)
    assert gate() == [("x", day.replace(hour=5)), ("y", day.replace(hour=6))]


def test_leftovers_of_a_failed_run_do_not_count(spark, box, rows):
    """Half-written files of a batch that is redone are replaced or ignored."""
    text = "batch string, source string, ts timestamp_ntz"
    schema, day = schema_of(spark, text), datetime.datetime(2024, 1, 1)
    stale = spark.createDataFrame([("stale", day)], "batch string, ready_at timestamp_ntz")
    stale.write.parquet(f"{box['table']}/epoch=0")
    post(spark, box["inbox"], [("x", "a", day)], text)
    ready = arrival_gate(read_new_files(spark, box["inbox"], schema), "batch", "source", "ts", ["a"])
    drain_aggregate(ready, box["table"], box["checkpoint"], ["batch"])
    assert rows(latest_rows(spark, box["table"], ready.schema)) == [("x", day)]

    appended = box["table"] + "-appended"
    drain_to_table(read_new_files(spark, box["inbox"], schema), appended, box["checkpoint"] + "-appended")
    spark.createDataFrame([("stale", "a", day)], text).write.mode("append").parquet(box["state"])
    for part in Path(box["state"]).glob("part-*"):
        (Path(appended) / part.name).write_bytes(part.read_bytes())
    assert [r.batch for r in spark.read.parquet(appended).collect()] == ["x"]


ROUTES = {"in/rental/": "rental", "in/payment/": "payment", "in/customer/": "customer"}


def test_an_empty_inbox_starts_nothing(spark, box, tmp_path):
    (tmp_path / "inbox").mkdir()
    stream = read_new_files(spark, box["inbox"], schema_of(spark, MESSAGES))
    assert drain_and_build(spark, stream, ROUTES, ["seq"], box["state"], str(tmp_path), box["mart"]) is False
    assert not (tmp_path / "mart").exists()


def test_a_table_may_be_a_file_or_a_folder(spark, tmp_path):
    from tidelake.queries.tables import stream

    spark.range(5).repartition(2).write.parquet(str(tmp_path / "events.parquet"))
    drain_to_table(stream(spark, str(tmp_path), "events"), str(tmp_path / "t"), str(tmp_path / "c"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 5


def test_mart_is_built_only_for_a_complete_manifest(spark, box, tmp_path, rows):
    (tmp_path / "in" / "rental").mkdir(parents=True)
    (tmp_path / "in" / "payment").mkdir()
    (tmp_path / "in" / "customer").mkdir()
    (tmp_path / "in/rental/old.csv").write_text("rental_id,customer_id,rental_date\n9,9,2001-01-01\n")
    (tmp_path / "in/rental/new.csv").write_text("rental_id,customer_id,rental_date\n1,5,2007-02-14 21:21:59\n")
    (tmp_path / "in/payment/f.csv").write_text("rental_id,payment_date,amount\n1,2007-02-15,5.99\n1,2007-02-16,0.99\n")
    (tmp_path / "in/customer/f.csv").write_text("customer_id,store_id\n5,1\n")
    schema = schema_of(spark, MESSAGES)

    def run():
        stream = read_new_files(spark, box["inbox"], schema)
        return drain_and_build(spark, stream, ROUTES, ["seq"], box["state"], str(tmp_path), box["mart"])

    post(spark, box["inbox"], [(1, body("in/rental/old.csv")), (2, body("in/customer/f.csv", "other/x"))])
    post(spark, box["inbox"], [(9, "no json")])
    assert run() is False
    assert rows(spark.read.parquet(box["state"] + "/malformed")) == [(9, "no json")]
    post(spark, box["inbox"], [(3, body("in/rental/new.csv")), (4, body("in/payment/f.csv"))])
    assert run() is True
    assert run() is False  # nothing new
    mart = spark.read.schema(
        "rental_date string, payment_date string, amount string, store_id string, rental_dt string"
    ).parquet(box["mart"])
    assert rows(mart) == [
        ("2007-02-14", "2007-02-15", "5.99", "1", "2007-02-14"),
        ("2007-02-14", "2007-02-16", "0.99", "1", "2007-02-14"),
    ]
    assert (tmp_path / "mart/store_id=1/rental_dt=2007-02-14").is_dir()


def event(name, key):
    return json.dumps({"Records": [{"eventName": name, "s3": {"object": {"key": key}}}]})


def test_builds_do_not_mix_and_are_tried_again(spark, box, tmp_path, rows):
    for role, header, line in (
        ("rental", "rental_id,customer_id,rental_date", "1,5,2007-02-14"),
        ("payment", "rental_id,payment_date,amount", "1,2007-02-15,5.99"),
        ("customer", "customer_id,store_id", "5,1"),
    ):
        (tmp_path / "in" / role).mkdir(parents=True)
        (tmp_path / f"in/{role}/a.csv").write_text(f"{header}\n{line}\n")
    schema = schema_of(spark, MESSAGES)

    def run():
        stream = read_new_files(spark, box["inbox"], schema)
        return drain_and_build(spark, stream, ROUTES, ["seq"], box["state"], str(tmp_path), box["mart"])

    post(spark, box["inbox"], [(1, body("in/rental/a.csv", "in/payment/missing.csv", "in/customer/a.csv"))])
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        run()
    (tmp_path / "in/payment/missing.csv").write_text("rental_id,payment_date,amount\n1,2007-02-15,1.00\n")
    assert run() is True  # the failed build again
    post(spark, box["inbox"], [(2, body("in/rental/a.csv"))])
    assert run() is False  # a rental alone is not joined with old payments
    post(spark, box["inbox"], [(3, event("ObjectRemoved:Delete", "in/payment/a.csv"))])
    assert run() is False  # a removal brings no file
    post(spark, box["inbox"], [(4, body("in/payment/a.csv", "in/customer/a.csv"))])
    assert run() is True
    assert [r.amount for r in spark.read.parquet(box["mart"]).collect()] == ["5.99"]
    assert spark.read.parquet(box["state"] + "/built").count() == 2


def test_batches_are_opened_once(spark, box, rows):
    text = "batch string, source string, ts timestamp_ntz"
    schema, day = schema_of(spark, text), datetime.datetime(2024, 1, 1)

    def run():
        stream = read_new_files(spark, box["inbox"], schema)
        return [rows(df) for df in drain_and_open(spark, stream, box["state"], ["a", "b"])]

    Path(box["inbox"]).mkdir()
    assert run() == [[], []]
    post(spark, box["inbox"], [("x", "a", day), ("x", "b", day), ("y", "a", day), (None, "b", day)], text)
    assert run() == [[("x", day)], [(None, "a"), ("y", "b")]]
    post(spark, box["inbox"], [("y", "b", day), ("x", "a", day)], text)
    assert run() == [[("y", day)], [(None, "a")]]
    assert run() == [[], [(None, "a")]]


def test_a_batch_writes_only_the_roles_it_changed(spark, box):
    schema = schema_of(spark, "seq long, role string, key string")
    kept = ["role"]

    def drain():
        rows = latest_by_role(read_new_files(spark, box["inbox"], schema), ["seq"])
        drain_changes(rows, box["table"], box["checkpoint"])
        return {r.role: r.key for r in current_rows(spark, box["table"], rows.schema, kept).collect()}

    def changed(epoch):
        return {r.role: r.key for r in spark.read.parquet(f"{box['table']}/epoch={epoch}").collect()}

    Path(box["inbox"]).mkdir()
    assert drain() == {}
    post(spark, box["inbox"], [(1, "a", "a1"), (2, "b", "b2"), (3, None, "none")], "seq long, role string, key string")
    assert drain() == {"a": "a1", "b": "b2"}
    # The query is started anew: what it knows comes from the state store.
    post(spark, box["inbox"], [(5, "b", "b5"), (0, "a", "a0"), (4, "c", "c4")], "seq long, role string, key string")
    assert drain() == {"a": "a1", "b": "b5", "c": "c4"}
    last = max(int(p.name.removeprefix("epoch=")) for p in Path(box["table"]).glob("epoch=*"))
    assert changed(last)["b"] == "b5" and changed(last).get("a", "a1") == "a1"
    rows_schema = schema_of(spark, "role string, key string")
    for _ in range(2):
        fold_changes(spark, box["table"], rows_schema, kept)
        assert {r.role: r.key for r in current_rows(spark, box["table"], rows_schema, kept).collect()} == {"a": "a1", "b": "b5", "c": "c4"}
    post(spark, box["inbox"], [(9, "a", "a9")], "seq long, role string, key string")
    assert drain() == {"a": "a9", "b": "b5", "c": "c4"}
    assert len(list(Path(box["table"]).glob("epoch=*"))) <= 3
