"""What queries leave behind: no catalog tables and no copies, but for results that are read from them."""

from __future__ import annotations

from pathlib import Path

import pytest

from tests.conftest import SMALL
from tidelake.queries import arrivals, storage
from tidelake.session import shared_folder

# Their partitions are looked up in the catalog when the result is read.
NEED_THEIR_TABLE = {"external_csv_table", "recover_partitions"}


@pytest.mark.parametrize("name", [*storage.QUERIES, "stream_gate", "wait_for_all"])
def test_no_tables_and_copies_stay(spark, name):
    copies = Path(shared_folder(spark).removeprefix("file:")) / "tidelake"
    before = {t.name for t in spark.catalog.listTables()}, set(copies.glob("numbered-*"))
    query = {**storage.QUERIES, **arrivals.QUERIES}[name]
    assert query(spark, SMALL).count() > 0
    if name not in NEED_THEIR_TABLE:
        assert {t.name for t in spark.catalog.listTables()} == before[0]
    assert set(copies.glob("numbered-*")) == before[1]


def test_a_drained_table_keeps_its_last_epoch_only(spark):
    copies = Path(shared_folder(spark).removeprefix("file:")) / "tidelake"
    before = set(copies.glob("stream-*"))
    assert arrivals.QUERIES["stream_manifest"](spark, SMALL).count() > 0
    [folder] = set(copies.glob("stream-*")) - before
    assert len([p for p in (folder / "table").glob("epoch=*") if p.name != "epoch=-1"]) == 1
