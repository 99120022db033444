from __future__ import annotations

import json

import pytest

from tidelake.functions.notifications import (
    first_record,
    malformed_notifications,
    parse_notifications,
)


def body(*keys, event="ObjectCreated:Put"):
    return json.dumps({"Records": [{"eventName": event, "s3": {"object": {"key": k}}} for k in keys]})


@pytest.fixture
def messages(spark):
    return spark.createDataFrame(
        [
            (1, body("a")),
            (2, body("b", "c", "c")),
            (3, '{"Records":[{"eventName":'),
            (4, "plain text"),
            (5, '{"other":1}'),
            (6, body()),
            (7, '{"Records":[{"eventName":"x"}]}'),
            (8, None),
        ],
        "seq int, body string",
    )


def test_every_record_of_every_message(messages, rows):
    assert rows(parse_notifications(messages).select("seq", "record_no", "key")) == [
        (1, 0, "a"), (2, 0, "b"), (2, 1, "c"), (2, 2, "c"), (7, 0, None)
    ]


def test_first_record_only(messages, rows):
    found = {r.seq: r.key for r in first_record(messages).collect()}
    assert found == {1: "a", 2: "b", 3: None, 4: None, 5: None, 6: None, 7: None, 8: None}


def test_malformed_bodies_are_kept_whole(messages, rows):
    assert [r[0] for r in rows(malformed_notifications(messages))] == [3, 4, 5, 8]
    assert dict(rows(malformed_notifications(messages)))[4] == "plain text"
