"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

#: Independent Spark jobs that are started at the same time at most.
AT_ONCE = 8
A = TypeVar("A")
B = TypeVar("B")

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # jobs that are started at the same time share the executors instead of queueing up
    "spark.scheduler.mode": "FAIR",
    # no Python call sites on every column expression: building plans is otherwise the slow part
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(name: str = "tallyworks", **extra: str) -> SparkSession:
    """A session with the engine's settings; master and sizing come from spark-submit."""
    builder = SparkSession.builder.appName(name)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def local_session(cores: int = 8, name: str = "tallyworks-local") -> SparkSession:
    """A single-JVM session for tests and the bench."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    sizing = {
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": str(cores),
        "spark.driver.memory": "12g",
    }
    for key, value in {**SETTINGS, **sizing}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below the cluster's shared ``spark.checkpoint.dir``.

    Only a local master may fall back to a machine-local folder: on a cluster
    the executors could not see it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="tallyworks-")
    return f"{root.rstrip('/')}/tallyworks/{label}-{uuid.uuid4().hex}"


def at_once(spark: SparkSession, action: Callable[[A], B], items: Iterable[A], most: int = AT_ONCE) -> list[B]:
    """Results of ``action`` for independent items, in their order, run from several threads, so that planning and the ends of
    stages overlap. Threads take over the caller's job properties, each with a scheduler pool of its own; the first error is raised."""
    items = list(items)
    if len(items) < 2:
        return [action(item) for item in items]

    def pooled(item: A) -> B:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", threading.current_thread().name)
        return action(item)

    with ThreadPoolExecutor(min(most, len(items)), thread_name_prefix="at-once") as pool:
        futures = [pool.submit(inheritable_thread_target(spark)(pooled), item) for item in items]
        return [future.result() for future in futures]
