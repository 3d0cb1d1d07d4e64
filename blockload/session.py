"""Session helpers: the shared work folder and a local session for tests."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import SparkSession

_LOCAL_DIR: str | None = None


def _plain(path: str) -> str:
    return re.sub(r"^file:/+", "/", path).rstrip("/")


def work_dir(spark: SparkSession) -> str:
    """Shared folder for staged data.

    A checkpoint folder set on the context counts first, then the cluster's
    ``spark.checkpoint.dir`` (below which the context makes its own folder).
    With neither, a folder of our own serves a local session; on a cluster
    executors do not see each other's folders, so that raises.
    """
    global _LOCAL_DIR
    named = spark.conf.get("spark.checkpoint.dir", None)
    own = spark.sparkContext.getCheckpointDir()
    if named and (not own or _plain(own).startswith(_plain(named))):
        return named.rstrip("/")
    if own:
        return own.rstrip("/")
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise ValueError(f"spark.checkpoint.dir names no shared folder, and {master} is not a local master")
    if _LOCAL_DIR is None:
        _LOCAL_DIR = tempfile.mkdtemp(prefix="blockload-")
    return _LOCAL_DIR


def new_path(spark: SparkSession, kind: str, below: str | None = None) -> str:
    """A fresh, never used path under the work folder (or ``below``)."""
    return f"{below or f'{work_dir(spark)}/blockload'}/{kind}-{uuid.uuid4().hex[:12]}"


def _located(spark: SparkSession, path: str):
    """The path and its file system, as Spark sees them."""
    there = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return there, there.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is at ``path``."""
    there, system = _located(spark, path)
    return system.exists(there)


def existing(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """Those of ``paths``, of one file system, at which there is a file or folder."""
    if not paths:
        return []
    system, at = _located(spark, paths[0])[1], spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return [p for p in paths if system.exists(at(p))]


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a folder that this library wrote and no reader needs any more."""
    there, system = _located(spark, path)
    system.delete(there, True)


def create_exclusive(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if there is one already. One of several
    callers succeeds: by the operating system on local paths, elsewhere by the
    file system's create without overwriting."""
    there, system = _located(spark, path)
    system.mkdirs(there.getParent())
    if system.getScheme() == "file":
        try:
            os.close(os.open(there.toUri().getPath(), os.O_CREAT | os.O_EXCL))
        except FileExistsError:
            return False
        return True
    try:
        system.create(there, False).close()
    except Exception as e:  # noqa: BLE001 - the file system's own error for a file that exists
        if system.exists(there):
            return False
        raise e
    return True


def touch(spark: SparkSession, path: str, seconds: float) -> None:
    """Set a file's time."""
    there, system = _located(spark, path)
    system.setTimes(there, int(seconds * 1000), -1)


def listed(spark: SparkSession, path: str) -> dict[str, float]:
    """Names in a folder with their times in seconds; empty if there is none."""
    there, system = _located(spark, path)
    if not system.exists(there):
        return {}
    return {f.getPath().getName(): f.getModificationTime() / 1000 for f in system.listStatus(there)}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Local session used by tests and the bench (UI off, UTC, AQE on)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("blockload")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BLOCKLOAD_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
