from __future__ import annotations

import datetime

import pytest

from tidelake.operators import arrivals as ops
from tidelake.operators.filters import route_prefix


def at(hour):
    return datetime.datetime(2024, 1, 1, hour)


@pytest.fixture
def routed(spark):
    keys = spark.createDataFrame(
        [(1, 0, "r/1"), (2, 0, "p/1"), (2, 1, "p/2"), (3, 0, "r/0"), (3, 1, "x/9"), (4, 0, None)],
        "seq int, record_no int, key string",
    )
    return route_prefix(keys, {"r/": "rental", "p/": "payment"})


def test_last_key_per_role_wins(routed, rows):
    order = ["seq", "record_no"]
    assert rows(ops.manifest_latest(routed, ["rental", "payment", "customer"], order)) == [
        ("payment", "p/2"), ("rental", "r/0")
    ]
    row = ops.manifest_row(routed, ["rental", "payment", "customer"], order).first()
    assert tuple(row) == ("r/0", "p/2", None)


def test_manifest_of_nothing_is_one_row_of_nulls(routed):
    row = ops.manifest_row(routed.limit(0), ["rental", "payment"], ["seq"]).collect()
    assert [tuple(r) for r in row] == [(None, None)]


@pytest.fixture
def arrived(spark):
    return spark.createDataFrame(
        [
            ("b1", "IDR", at(1)), ("b1", "MDS", at(2)), ("b1", "ECE", at(3)), ("b1", "FPVS", at(4)),
            ("b1", "IDR", at(9)),  # a second arrival does not move the gate
            ("b2", "IDR", at(1)), ("b2", "IDR", at(2)), ("b2", "other", at(3)), ("b2", None, at(3)),
            ("b3", "other", at(1)),
        ],
        "batch string, source string, ts timestamp_ntz",
    )


def test_gate_opens_when_all_are_in(arrived, rows):
    assert rows(ops.arrival_gate(arrived, "batch", "source", "ts")) == [("b1", at(4))]
    assert rows(ops.arrival_gate(arrived, "batch", "source", "ts", ["IDR"])) == [("b1", at(1)), ("b2", at(1))]


def test_missing_sources(arrived, rows):
    assert rows(ops.arrival_missing(arrived, "batch", "source", "ts")) == [
        ("b2", "ECE"), ("b2", "FPVS"), ("b2", "MDS"),
        ("b3", "ECE"), ("b3", "FPVS"), ("b3", "IDR"), ("b3", "MDS"),
    ]
