"""Session helpers: a tuned builder and the shared folder for written state."""

from __future__ import annotations

import os
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", memory: str = "8g", app: str = "tidelake") -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    partitions = "8" if cores == "*" else str(max(int(cores), 1))
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Small data: join tables above 1 MB by shuffle, as a cluster would its large
        # ones, and keep one task per core. A cluster leaves these at their defaults.
        .config("spark.sql.autoBroadcastJoinThreshold", "1m")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every node can reach, as named by ``spark.checkpoint.dir``.

    Where that is unset, the folder given to ``setCheckpointDir`` counts.
    """
    named = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if not named:
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder shared by all nodes")
    return named.rstrip("/")


def find_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    A cluster gets the package by ``--py-files`` or an installation instead.
    """
    environment, root = spark.sparkContext.environment, str(Path(__file__).resolve().parent.parent)
    known = environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [known, root]))


def _located(spark: SparkSession, path: str):
    """A path and its file system, whatever file system Spark reaches it on."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()), place


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder."""
    system, folder = _located(spark, path)
    return sorted(status.getPath().getName() for status in system.listStatus(folder))


def path_exists(spark: SparkSession, path: str) -> bool:
    system, place = _located(spark, path)
    return system.exists(place)


def files_below(spark: SparkSession, path: str) -> list[str]:
    """Paths of the files below a folder of this library's own, relative to it."""
    system, folder = _located(spark, path)
    start = system.makeQualified(folder).toString().rstrip("/") + "/"
    found, names = system.listFiles(folder, True), []
    while found.hasNext():
        names.append(found.next().getPath().toString().removeprefix(start))
    return sorted(names)


def move_file(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file, with the folders above its new place; a file that was moved before is left."""
    system, place = _located(spark, source)
    _, goal = _located(spark, target)
    if system.exists(place):
        system.mkdirs(goal.getParent())
        if not system.rename(place, goal):
            raise OSError(f"{source} cannot be moved to {target}")


def remove_file(spark: SparkSession, path: str) -> None:
    system, place = _located(spark, path)
    system.delete(place, False)


def mark_file(spark: SparkSession, path: str) -> None:
    """An empty file."""
    system, place = _located(spark, path)
    system.create(place, True).close()


def publish_file(spark: SparkSession, path: str, text: str) -> bool:
    """Make a file with its text, whole or not at all; says no if there is one by that name.

    Of several that try at once, one makes it. This needs a file system whose rename spares
    an existing file, such as HDFS; on a local or mounted disk it is a hard link.
    """
    system, place = _located(spark, path)
    _, draft = _located(spark, f"{path.rpartition('/')[0]}/_{uuid.uuid4().hex}")
    stream = system.create(draft, True)
    stream.write(text.encode())
    stream.close()
    try:
        if system.getScheme() != "file":
            return not system.exists(place) and system.rename(draft, place)
        os.link(draft.toUri().getPath(), place.toUri().getPath())
        return True
    except FileExistsError:
        return False
    finally:
        system.delete(draft, False)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of this library's own."""
    system, folder = _located(spark, path)
    system.delete(folder, True)


def new_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no earlier run has used."""
    return f"{shared_folder(spark)}/tidelake/{label}-{uuid.uuid4().hex}"
