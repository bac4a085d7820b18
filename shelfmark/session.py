"""Session settings, scoped overrides and the shared scratch folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from .storage import delete_tree

# What a delivery cluster should start with. The two sizes steer how many files
# a rebalanced write produces: one file per advisory-sized slice of a partition.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256MB",
    "spark.sql.files.maxPartitionBytes": "256MB",
    "spark.scheduler.mode": "FAIR",
    "spark.sql.session.timeZone": "UTC",
}

# Needed while datasets run, so that large months are cut at run time and the
# shuffle files of a query go when it ends, not when the driver collects its
# garbage. Nothing here may change what a source query means.
RUN_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def build_session(app_name: str = "shelfmark", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_lock = threading.Lock()
#: (session, key, value) of settings in force: blocks that use it, value before.
_in_force: dict[tuple[int, str, str], tuple[int, str | None]] = {}


@contextmanager
def session_conf(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Set SQL settings for a block and put the old ones back afterwards.

    Of blocks that overlap in time with the same setting the last one to end puts
    the old value back.
    """
    with _lock:
        for key, value in settings.items():
            users, before = _in_force.get((id(spark), key, value), (0, spark.conf.get(key, None)))
            _in_force[id(spark), key, value] = users + 1, before
            spark.conf.set(key, value)
    try:
        yield
    finally:
        with _lock:
            for key, value in settings.items():
                users, before = _in_force.pop((id(spark), key, value))
                if users > 1:
                    _in_force[id(spark), key, value] = users - 1, before
                elif before is None:
                    spark.conf.unset(key)
                else:
                    spark.conf.set(key, before)


_local_scratch: str | None = None
_scratch_made: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path in the shared folder named by ``spark.checkpoint.dir``
    or, failing that, set as the checkpoint folder of the context.

    Executors on other hosts must see it, so a machine-local folder is used only
    when Spark itself runs in local mode and nothing is configured.
    """
    global _local_scratch
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        if _local_scratch is None:
            _local_scratch = tempfile.mkdtemp(prefix="shelfmark-")
        base = _local_scratch
    path = f"{base.rstrip('/')}/shelfmark/{label}-{uuid.uuid4().hex}"
    _scratch_made.append(path)
    return path


def keep_scratch(path: str) -> None:
    """Leave a scratch path to whoever needs it later; cleaning passes it over."""
    if path in _scratch_made:
        _scratch_made.remove(path)


def clean_scratch(spark: SparkSession) -> None:
    """Delete what this process put into the scratch folder; call it when no frame
    that reads from there is needed any more."""
    while _scratch_made:
        delete_tree(spark, _scratch_made.pop())
