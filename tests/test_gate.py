from __future__ import annotations

import datetime

import pytest

from tidelake.streaming.drain import read_new_files
from tidelake.session import remove_folder
from tidelake.streaming.gate import drain_gate, gate_rows, gate_state

SCHEMA = "batch timestamp_ntz, source string, ts timestamp_ntz"
START = datetime.datetime(2024, 1, 1)


def hour(n, minute=0):
    return START + datetime.timedelta(hours=n, minutes=minute)


class Gate:
    def __init__(self, spark, folder):
        self.spark, self.inbox, self.folder = spark, f"{folder}/inbox", f"{folder}/gate"

    def post(self, rows):
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(self.inbox)

    def drain(self):
        arrivals = read_new_files(self.spark, self.inbox, self.spark.createDataFrame([], SCHEMA).schema)
        drain_gate(arrivals, self.folder, ["a", "b"], "3 hours")
        return sorted(((r.state, r.batch, r.source or "", r.ts) for r in gate_rows(self.spark, self.folder).collect()), key=str)


@pytest.fixture
def gate(spark, tmp_path):
    return Gate(spark, tmp_path)


def test_opens_once_and_reports_missing_and_late(spark, gate):
    post, drain = gate.post, gate.drain
    post([(hour(0), "a", hour(0, 5)), (hour(0), "x", hour(0, 9)), (hour(1), "a", hour(1, 1)), (None, "a", hour(0)), (hour(0), "a", None)])
    rows = drain()
    assert rows == []
    post([(hour(0), "b", hour(0, 7)), (hour(0), "a", hour(0, 6)), (hour(0), "b", hour(0, 30))])
    rows = drain()
    assert rows == [("opened", hour(0), "", hour(0, 7))]
    post([(hour(9), "a", hour(9)), (hour(9), "b", hour(9, 2))])  # passes hours 0 and 1
    drain()
    post([(hour(1), "b", hour(10)), (hour(0), "a", hour(11)), (hour(8), "a", hour(11))])
    rows = drain()
    assert rows == [
        ("late", hour(0), "a", hour(11)),
        ("late", hour(1), "b", hour(10)),
        ("missing", hour(1), "b", None),
        ("opened", hour(0), "", hour(0, 7)),
        ("opened", hour(9), "", hour(9, 2)),
    ]


def test_state_stays_bounded_over_many_batches(spark, gate):
    post, drain = gate.post, gate.drain
    most = 0
    for start in range(0, 100, 20):
        post([(hour(n), s, hour(n, 1)) for n in range(start, start + 20) for s in ("a", "b") if n % 7 or s == "a"])
        rows = drain()
        most = max(most, gate_state(spark, gate.folder).count())
    assert most <= 4  # what the delay keeps
    opened = sorted(b for s, b, _, _ in rows if s == "opened")
    missing = sorted(b for s, b, _, _ in rows if s == "missing")
    assert opened == [hour(n) for n in range(100) if n % 7]
    # The last is still awaited.
    assert missing == [hour(n) for n in range(0, 96, 7)]
    assert not any(s == "late" for s, *_ in rows)


def test_a_redone_batch_says_the_same(spark, gate):
    gate.post([(hour(0), "a", hour(0, 5)), (hour(1), "a", hour(1)), (hour(1), "b", hour(1, 3))])
    gate.drain()
    gate.post([(hour(0), "b", hour(0, 7)), (hour(9), "a", hour(9)), (hour(9), "b", hour(9))])
    rows = gate.drain()
    # As if the second batch had died after its writes: Spark runs it again.
    for part in ("commits/1", "commits/.1.crc"):
        remove_folder(spark, f"{gate.folder}/checkpoint/{part}")
    assert gate.drain() == rows
    assert [r[:3] for r in rows] == [("opened", hour(n), "") for n in (0, 1, 9)]
