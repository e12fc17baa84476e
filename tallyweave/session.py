"""Session settings and the shared folder used by streams and written tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(app: str = "tallyweave", master: str | None = None, **conf: str) -> SparkSession:
    """Build a session with the settings every job in this library relies on.

    Joins carry no broadcast hints: Spark compares the size of each side with
    ``spark.sql.autoBroadcastJoinThreshold`` (from statistics when planning, from
    shuffle sizes under AQE) and sort-merges beyond it.  AQE also splits hot keys
    of sort-merge joins and coalesces small partitions.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
        # inserts beyond the broadcast threshold meet a large target through a Bloom filter of their keys
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
        "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "256MB",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1GB",
        # stream state may outgrow executor memory: keep it on disk, checkpoint only its changes
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        # plans are built from many small expressions: do not record a stack for each
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder every executor can reach, below ``spark.checkpoint.dir``.

    A session that names none has its warehouse.  On a cluster a warehouse in a local folder is
    refused, as each machine would write to a disk of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", "")
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/steps"
        if root.startswith(("file:", "/")) and not spark.conf.get("spark.master", "local").startswith("local"):
            raise RuntimeError("name a folder that all machines share in spark.checkpoint.dir")
    path = f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    for scope in _SCOPES:
        scope.append(path)
    return path


_SCOPES: list[list[str]] = []


@contextmanager
def steps_removed(spark: SparkSession) -> Iterator[None]:
    """Remove the folders that ``shared_folder`` names inside, once all that reads them has been written.

    A step that fails leaves its folders, so that what went wrong can be looked at.
    """
    made: list[str] = []
    _SCOPES.append(made)
    try:
        yield
    finally:
        _SCOPES.remove(made)
    for path in made:
        remove_folder(spark, path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder of the shared store, if there is one."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def folder_exists(spark: SparkSession, path: str) -> bool:
    """Whether the shared store has this folder or file."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)
