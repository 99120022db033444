from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidelake.operators import surrogate_keys
from tidelake.operators.surrogate_keys import insert_with_keys, next_keys, number_rows, reserve_keys
from tidelake.session import publish_file, shared_folder


def test_numbers_are_consecutive_and_in_order(spark):
    batch = spark.range(0, 5_000, numPartitions=6).select((F.col("id") * 7919 % 5_003).alias("v"))
    numbered = number_rows(batch, ["v"], "n", after=100)
    pairs = sorted((r.v, r.n) for r in numbered.collect())
    assert [n for _, n in pairs] == list(range(101, 5_101))


def test_text_order_and_other_columns_are_kept(spark, rows):
    batch = spark.createDataFrame([("b", 2), ("a", 1), ("c", None)], "name string, x int")
    assert rows(number_rows(batch, ["name"], "id").select("name", "x", "id")) == [("a", 1, 1), ("b", 2, 2), ("c", None, 3)]


def test_next_keys_follow_the_greatest(spark):
    existing = spark.createDataFrame([(5,), (9,), (None,)], "id long")
    batch = spark.createDataFrame([("x",), ("y",)], "name string")
    assert sorted(r.id for r in next_keys(existing, "id", batch, ["name"]).collect()) == [10, 11]
    assert sorted(r.id for r in next_keys(existing.limit(0), "id", batch, ["name"]).collect()) == [1, 2]
    assert next_keys(existing, "id", batch.limit(0), ["name"]).count() == 0


def test_the_mark_spares_the_scan_and_no_copy_stays(spark, tmp_path):
    existing = spark.createDataFrame([(5,), (9,)], "id long")
    mark, given = str(tmp_path / "mark"), []
    copies = Path(shared_folder(spark).removeprefix("file:")) / "tidelake"
    before = set(copies.glob("numbered-*"))
    for names in (["x", "y"], ["z"]):
        batch = spark.createDataFrame([(n,) for n in names], "name string")
        insert_with_keys(existing, "id", batch, ["name"], lambda rows: given.extend(r.id for r in rows.collect()), mark)
    assert sorted(given) == [10, 11, 12]
    assert set(copies.glob("numbered-*")) == before


def test_ranges_of_many_writers_never_meet(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(surrogate_keys, "_ENTRIES", 4)  # several folders
    ledger, sizes = str(tmp_path / "ledger"), [1, 2, 3, 5, 8] * 6
    with ThreadPoolExecutor(8) as writers:
        starts = list(writers.map(lambda n: reserve_keys(spark, ledger, n, lambda: 100), sizes))
    taken = sorted(key for start, n in zip(starts, sizes, strict=True) for key in range(start + 1, start + n + 1))
    assert taken == list(range(101, 101 + sum(sizes)))
    # No drafts are left, and no entry is lost.
    assert len([p for p in (tmp_path / "ledger").glob("*/*") if not p.name.endswith(".crc")]) == len(sizes)


def test_a_faster_writer_is_seen(spark, tmp_path, monkeypatch):
    ledger, seen = str(tmp_path / "ledger"), []
    assert reserve_keys(spark, ledger, 10, lambda: 0) == 0
    read = surrogate_keys._last_entry

    def slow(*args):
        found = read(*args)
        if not seen:  # another writer comes between the look and the try
            seen.append(found)
            assert publish_file(spark, surrogate_keys._entry(ledger, found + 1), "17")
        return found

    monkeypatch.setattr(surrogate_keys, "_last_entry", slow)
    assert reserve_keys(spark, ledger, 5, lambda: 0) == 17
    assert reserve_keys(spark, ledger, 0, lambda: 0) == 22
    with pytest.raises(ValueError):
        reserve_keys(spark, ledger, -1, lambda: 0)


def test_a_folder_without_an_entry_and_a_draft_do_no_harm(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(surrogate_keys, "_ENTRIES", 2)
    ledger = tmp_path / "ledger"
    (ledger / f"{0:012d}").mkdir(parents=True)
    (ledger / f"{0:012d}" / "_dead").write_text("3")  # a writer died before its entry was made
    assert [reserve_keys(spark, str(ledger), 3, lambda: 7) for _ in range(2)] == [7, 10]
    (ledger / f"{1:012d}").mkdir()
    assert reserve_keys(spark, str(ledger), 3, lambda: 7) == 13


def test_batches_at_once_share_no_key(spark, tmp_path):
    existing = spark.createDataFrame([(5,), (None,)], "id long")
    ledger, given = str(tmp_path / "ledger"), []

    def insert(first):
        batch = spark.range(first, first + 500, numPartitions=3).selectExpr("id as v")
        insert_with_keys(existing, "id", batch, ["v"], lambda rows: given.append(rows.collect()), ledger=ledger)

    with ThreadPoolExecutor(3) as writers:
        list(writers.map(insert, (0, 1000, 2000)))
    assert sorted(r.id for rows in given for r in rows) == list(range(6, 1506))
    for rows in given:  # in order, without gaps
        assert [r.id for r in sorted(rows, key=lambda r: r.v)] == list(range(min(r.id for r in rows), min(r.id for r in rows) + 500))
    assert next_keys(existing, "id", spark.range(0).selectExpr("id as v"), ["v"], ledger=ledger).count() == 0
    with pytest.raises(ValueError):
        next_keys(existing, "id", existing, ["id"], mark="a", ledger="b")
