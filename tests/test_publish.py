from __future__ import annotations

import datetime
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidelake.session import remove_file, remove_folder
from tidelake.sinks import publish
from tidelake.sinks.publish import compact_small, publish_batch, small_files, stored_files
from tidelake.streaming.ledger import drain_files, new_files

KEYS = ["store", "day"]


def batch(spark, start, rows=60):
    return spark.range(start, start + rows).select(
        "id", F.concat(F.lit("0"), F.col("id") % 3).alias("store"), F.concat(F.lit("d "), F.col("id") % 2).alias("day")
    )


def ids(spark, path):
    return sorted(r.id for r in spark.read.parquet(path).select("id").collect())


def files(path):
    return sorted(str(f.relative_to(path)) for f in Path(path).rglob("*.parquet") if publish.LEDGER not in f.parts)


def test_a_batch_counts_once(spark, tmp_path):
    path = str(tmp_path / "layout")
    assert publish_batch(batch(spark, 0), path, KEYS, "monday")
    assert not publish_batch(batch(spark, 500), path, KEYS, "monday")
    assert publish_batch(batch(spark, 60), path, KEYS, "tuesday")
    assert ids(spark, path) == list(range(120))
    assert {f.rpartition("/")[0] for f in files(path)} == {f"store=0{s}/day=d {d}" for s in range(3) for d in range(2)}
    with pytest.raises(ValueError):
        publish_batch(batch(spark, 0), path, KEYS, "../out")


@pytest.mark.parametrize("dies", ["move_file", "write", "mark_file", "_commit"])
def test_a_killed_append_is_finished_by_the_next_try(spark, tmp_path, monkeypatch, dies):
    path, calls = str(tmp_path / "layout"), []

    def dying(real, after):
        def call(*args):
            calls.append(args)
            if len(calls) > after:
                raise KeyboardInterrupt
            return real(*args)

        return call

    with monkeypatch.context() as patch:
        if dies == "write":
            patch.setattr(publish, "files_below", dying(publish.files_below, 0))
        else:
            patch.setattr(publish, dies, dying(getattr(publish, dies), 2 if dies == "move_file" else 0))
        with pytest.raises(KeyboardInterrupt):
            publish_batch(batch(spark, 0), path, KEYS, "one")
    for _ in range(2):
        publish_batch(batch(spark, 0), path, KEYS, "one")
    assert ids(spark, path) == list(range(60))
    assert not any("staged" in str(f) for f in Path(path).rglob("*.parquet"))


def test_only_directories_with_several_small_files_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "layout")
    for start in range(0, 240, 60):
        publish_batch(batch(spark, start).filter("store = '00' AND day = 'd 0'"), path, KEYS, f"b{start}")
    publish_batch(batch(spark, 0).filter("store <> '00'"), path, KEYS, "others")
    before, rows = files(path), ids(spark, path)
    compact_small(spark, path, KEYS)
    after = files(path)
    mine = "store=00/day=d 0/"
    assert [f for f in before if not f.startswith(mine)] == [f for f in after if not f.startswith(mine)]
    assert sum(f.startswith(mine) for f in before) == 4 and sum(f.startswith(mine) for f in after) == 1
    assert ids(spark, path) == rows
    compact_small(spark, path, KEYS)
    assert files(path) == after


def test_a_killed_compaction_loses_and_doubles_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "layout")
    for start in (0, 60, 120):
        publish_batch(batch(spark, start), path, KEYS, f"b{start}")
    rows = ids(spark, path)
    with monkeypatch.context() as patch:
        seen = []

        def dying(spark, file):
            seen.append(file)
            if len(seen) > 5:
                raise KeyboardInterrupt
            remove_file(spark, file)

        patch.setattr(publish, "remove_file", dying)
        with pytest.raises(KeyboardInterrupt):
            compact_small(spark, path, KEYS)
    compact_small(spark, path, KEYS)
    assert ids(spark, path) == rows and len(files(path)) == 6


def test_files_are_put_into_bins_by_size(spark):
    sizes = [("a", s) for s in (10, 20, 30, 40, 45, 60, 99)] + [("b", 10), ("c", 49), ("c", 49), ("c", 49)]
    df = spark.createDataFrame([(f"{d}/{i}", d, s) for i, (d, s) in enumerate(sizes)], "path string, directory string, bytes long")
    bins = {}
    for r in small_files(df, 100).collect():
        bins.setdefault((r["directory"], r["bin"]), []).append(r["bytes"])
    assert {k: sorted(v) for k, v in bins.items()} == {("a", 0): [10, 20, 30, 40], ("c", 0): [49, 49, 49]}


def test_many_files_take_several_rounds(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(publish, "FILES_PER_ROUND", 5)
    path = str(tmp_path / "layout")
    for start in range(0, 180, 60):
        publish_batch(batch(spark, start), path, KEYS, f"b{start}")
    compact_small(spark, path, KEYS)
    assert ids(spark, path) == list(range(180)) and len(files(path)) == 6


class Inbox:
    def __init__(self, spark, folder):
        self.spark = spark
        self.inbox, self.table, self.ledger, self.archive = (f"{folder}/{n}" for n in ("inbox", "table", "ledger", "archive"))
        Path(self.inbox).mkdir()

    def post(self, name, start, rows=3):
        self.spark.range(start, start + rows).coalesce(1).write.parquet(f"{self.inbox}/../made-{name}")
        [file] = Path(f"{self.inbox}/../made-{name}").glob("part-*")
        target = Path(self.inbox, name)
        target.parent.mkdir(parents=True, exist_ok=True)
        file.rename(target)
        return target

    def drain(self, **options):
        schema = self.spark.range(1).schema
        return drain_files(self.spark, self.inbox, schema, self.table, self.ledger, **options)

    def ids(self):
        return ids(self.spark, self.table)


@pytest.fixture
def box(spark, tmp_path):
    return Inbox(spark, tmp_path)


def test_each_file_is_read_once_also_an_old_one(box):
    box.post("a.parquet", 0)
    box.post("deep/b.parquet", 10)
    assert box.drain(files_per_batch=1) == 2
    assert box.drain() == 0
    late = box.post("0-late.parquet", 20)
    past = datetime.datetime(2001, 1, 1).timestamp()
    os.utime(late, (past, past))
    assert box.drain() == 1
    assert box.ids() == [0, 1, 2, 10, 11, 12, 20, 21, 22]


def test_the_archive_keeps_the_inbox_small_and_names_stay_known(box):
    box.post("a.parquet", 0)
    box.post("deep/b.parquet", 10)
    box.drain(archive=box.archive)
    assert not list(Path(box.inbox).rglob("*.parquet"))
    assert sorted(str(f.relative_to(box.archive)) for f in Path(box.archive).rglob("*.parquet")) == ["a.parquet", "deep/b.parquet"]
    assert new_files(box.spark, box.inbox, box.ledger).count() == 0
    assert box.drain(archive=box.archive) == 0 and len(box.ids()) == 6


def test_a_batch_that_died_is_redone_with_its_files(box, monkeypatch):
    from tidelake.streaming import ledger

    box.post("a.parquet", 0)
    with monkeypatch.context() as patch:
        patch.setattr(ledger, "publish_batch", lambda *args: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            box.drain()
    box.post("b.parquet", 10)
    assert box.drain() == 1  # the one after the one that died
    assert box.ids() == [0, 1, 2, 10, 11, 12]
    # Files named in a list that was not written whole are not taken for read.
    box.post("c.parquet", 20)
    new_files(box.spark, box.inbox, box.ledger).select("path", "name").write.parquet(f"{box.ledger}/batch=2")
    remove_folder(box.spark, f"{box.ledger}/batch=2/_SUCCESS")
    assert box.drain() == 1 and box.ids()[-1] == 22


def test_listing_reads_no_content(spark, tmp_path):
    path = str(tmp_path / "layout")
    publish_batch(batch(spark, 0), path, KEYS, "one")
    found = stored_files(spark, path).filter("path NOT LIKE '%/_published/%'").collect()
    assert len(found) == 6 and all(r["bytes"] > 0 and r["path"].startswith(r["directory"]) for r in found)
