"""Spark session settings and the shared folder that jobs may write to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import SparkSession

#: Settings that change results. They are applied to any session we are handed.
RESULT_CONF = {
    # Dates carry wall-clock digits whose zone token is dropped, so every
    # session has to read those digits in the same zone.
    "spark.sql.session.timeZone": "UTC",
}

#: Settings that only change speed; used when we build the session ourselves.
SPEED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

#: How a bounded run of a stage shares its input out. Short messages compress so
#: well that bytes say little about the work; a file counts for many of them, so
#: that a task gets few files, and files hold a bounded number of rows.
SCAN_CONF = {
    "spark.sql.files.maxPartitionBytes": str(32 << 20),
    "spark.sql.files.openCostInBytes": str(8 << 20),
}


def build_session(
    app_name: str = "tweetflow",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with this package's settings.

    ``shuffle_partitions`` is the number AQE starts from before it coalesces.
    Leave it unset on a cluster whose defaults are sized already; set it to the
    core count in local mode.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    conf = {**SPEED_CONF, **RESULT_CONF, **(extra or {})}
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings that results depend on to an existing session."""
    for key, value in RESULT_CONF.items():
        spark.conf.set(key, value)
    return spark


def with_scan_tasks(spark: SparkSession, max_bytes: int, min_tasks: int) -> SparkSession:
    """A sibling session that packs files into scan tasks its own way.

    Tasks read up to ``max_bytes``, less if there would be fewer than
    ``min_tasks``. The packing is a setting of the session that plans the scan,
    so the caller's session is left as it is.
    """
    sibling = configure(spark.newSession())
    sibling.conf.set("spark.sql.files.maxPartitionBytes", str(max_bytes))
    sibling.conf.set("spark.sql.files.openCostInBytes", "0")
    sibling.conf.set("spark.sql.files.minPartitionNum", str(min_tasks))
    return sibling


@contextmanager
def spread_scans(spark: SparkSession) -> Iterator[None]:
    """Within, scans of ``spark`` are cut into ``SCAN_CONF``'s small tasks.

    A stream plans its scans with the settings of the session that its source
    was made in, so it has to be started and run to its end within. What was
    set before holds again afterwards.
    """
    before = {key: spark.conf.get(key, None) for key in SCAN_CONF}
    for key, value in SCAN_CONF.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path under the folder that all executors can reach.

    The folder is the one the cluster names in ``spark.checkpoint.dir``. Only a
    local session may do without it, because there driver and executors share
    one disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: a cluster run needs a shared folder"
            )
        root = _local_root()
    return f"{root.rstrip('/')}/tweetflow/{label}-{uuid.uuid4().hex}"


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="tweetflow-")
