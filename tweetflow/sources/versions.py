"""Versions of layer tables: which files a batch left behind, compacted or not.

The file sink notes the files of every batch in its log, and now and then
sums the log up in one file. A version of a table is the id of a batch: the
files of all batches up to it. Old entries of the log may be deleted by Spark,
so a version that has to be read again later is pinned: its files are listed
beside the table. Listings are written first under another name and then
renamed, so a reader sees a whole one or none.

A snapshot holds the rows of a pinned version in larger files. It consists of
segments; compacting again adds one for the batches since, and leaves the
others as they are. Readers take the segments and the files of later batches.
The files of the table itself stay: streams that follow it still need them.
"""

from __future__ import annotations

import json
import re
import uuid
from contextlib import suppress
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tweetflow.schemas import LAYERS
from tweetflow.session import shared_dir, with_scan_tasks
from tweetflow.sources import files
from tweetflow.sources.tables import TABLE_CODEC, TARGET_FILE_BYTES, Layout, table_version

_LOG = re.compile(r"(\d+)(\.compact)?")
_WIDTH = 12


class VersionLost(LookupError):
    """The log no longer says which files a version had, and it was not pinned."""


@dataclass(frozen=True)
class Snapshot:
    """Segments that together hold the rows of all batches up to ``version``."""

    version: int
    segments: tuple[str, ...]


def _numbered(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(name) for name in files.child_names(spark, path) if name.isdigit())


def _log_files(spark: SparkSession, table: str, version: int) -> list[str]:
    """The parts of the sink log that together list the files up to ``version``."""
    summed, single = set(), set()
    for name in files.child_names(spark, f"{table}/_spark_metadata"):
        if match := _LOG.fullmatch(name):
            (summed if match[2] else single).add(int(match[1]))
    base = max((n for n in summed if n <= version), default=None)
    first = 0 if base is None else base + 1
    # A batch that is summed up may have lost its own entry, and the other way round.
    missing = [n for n in range(first, version + 1) if n not in single]
    if missing:
        raise VersionLost(f"batches {missing[0]} to {missing[-1]} of {table} are no longer in its log")
    names = [] if base is None else [f"{base}.compact"]
    return [f"{table}/_spark_metadata/{name}" for name in [*names, *range(first, version + 1)]]


def committed_files(spark: SparkSession, layout: Layout, layer: str, version: int) -> DataFrame:
    """``(path, size)`` of the files of all batches up to ``version``."""
    if version in _numbered(spark, layout.versions(layer)):
        return spark.read.schema("path string, size bigint").json(_pin_path(layout, layer, version))
    # Spark reads nothing from within a log directory, so the log is copied first:
    # a summary and the batches since.
    parts = _log_files(spark, layout.table(layer), version)
    copied = files.copy_into(spark, parts, files.make_scratch(spark, shared_dir(spark, "log")) + "/parts")
    lines = spark.read.text(copied)
    entries = lines.filter(F.col("value").startswith("{")).select(
        F.from_json("value", "path string, size bigint, action string").alias("e")
    )
    return entries.filter("e.action = 'add'").select("e.path", "e.size")


def _pin_path(layout: Layout, layer: str, version: int) -> str:
    return f"{layout.versions(layer)}/{version:0{_WIDTH}d}"


def pin_version(spark: SparkSession, layout: Layout, layer: str, version: int | None = None) -> int | None:
    """List the files of a version, by default the last, so that it can be read for good.

    Returns the version; None for a table without a batch.
    """
    if version is None:
        version = table_version(spark, layout.table(layer))
    if version is None:
        return None
    if version not in _numbered(spark, layout.versions(layer)):
        draft = f"{layout.versions(layer)}/_draft-{uuid.uuid4().hex}"
        committed_files(spark, layout, layer, version).write.json(draft)
        # Another pin of the same version lists the same files.
        with suppress(files.AlreadyPublished):
            files.publish(spark, draft, _pin_path(layout, layer, version))
    return version


def read_as_of(spark: SparkSession, layout: Layout, layer: str, version: int, merge_schema: bool = False) -> DataFrame:
    """A layer table as it was after the batch ``version``.

    The list of its files goes through the driver, as that of any scan does. A
    version beyond the last one is refused.
    """
    last = table_version(spark, layout.table(layer))
    if last is None or not 0 <= version <= last:
        raise VersionLost(f"{layout.table(layer)} has no version {version}; the last is {last}")
    paths = [row.path for row in committed_files(spark, layout, layer, version).collect()]
    return _read_paths(spark, layer, paths, merge_schema)


def _read_paths(spark: SparkSession, layer: str, paths: list[str], merge_schema: bool) -> DataFrame:
    if not paths:
        return spark.createDataFrame([], LAYERS[layer])
    reader = spark.read.option("mergeSchema", "true") if merge_schema else spark.read.schema(LAYERS[layer])
    return reader.parquet(*paths)


def snapshot(spark: SparkSession, layout: Layout, layer: str) -> Snapshot | None:
    """The newest snapshot of a table."""
    known = _numbered(spark, layout.snapshots(layer))
    if not known:
        return None
    row = spark.read.schema("segments array<string>").json(f"{layout.snapshots(layer)}/{known[-1]:0{_WIDTH}d}").first()
    return Snapshot(known[-1], tuple(row.segments))


def compact_layer(
    spark: SparkSession, layout: Layout, layer: str, target_bytes: int = TARGET_FILE_BYTES
) -> Snapshot | None:
    """Bring the snapshot of a table up to its last batch; None for a table without one.

    Only batches that the snapshot does not hold are read and written, to a
    segment of their own, without a shuffle: scan tasks are packed to the target
    size and write one file each. The new snapshot takes effect with the rename
    of its listing; of two that are made at once the later one to end fails.
    The stream that writes the table may go on all the while.
    """
    version = table_version(spark, layout.table(layer))
    if version is None:
        return None
    before = snapshot(spark, layout, layer)
    if before is not None and before.version >= version:
        return before
    pin_version(spark, layout, layer, version)
    paths = _later_files(spark, layout, layer, before, version)
    segments = before.segments if before else ()
    if paths:
        segment = f"{layout.snapshots(layer)}/_segments/{version:0{_WIDTH}d}-{uuid.uuid4().hex}"
        reader = with_scan_tasks(spark, target_bytes, 1).read.option("mergeSchema", "true")
        reader.parquet(*paths).write.parquet(segment, compression=TABLE_CODEC)
        segments = (*segments, segment)
    draft = f"{layout.snapshots(layer)}/_draft-{uuid.uuid4().hex}"
    listing = spark.createDataFrame([(json.dumps({"segments": segments}),)], "value string")
    listing.coalesce(1).write.text(draft)
    files.publish(spark, draft, f"{layout.snapshots(layer)}/{version:0{_WIDTH}d}")
    return Snapshot(version, segments)


def _later_files(
    spark: SparkSession, layout: Layout, layer: str, before: Snapshot | None, version: int
) -> list[str]:
    """Files of the batches up to ``version`` that a snapshot does not hold."""
    wanted = committed_files(spark, layout, layer, version)
    if before is not None:
        wanted = wanted.join(committed_files(spark, layout, layer, before.version), "path", "left_anti")
    return [row.path for row in wanted.select("path").collect()]


def read_current(spark: SparkSession, layout: Layout, layer: str, merge_schema: bool = False) -> DataFrame:
    """The rows of a table: from its snapshot, and from the files of later batches.

    Without a snapshot those of the table. What a stream commits after the call
    is not read.
    """
    version = table_version(spark, layout.table(layer))
    before = snapshot(spark, layout, layer)
    if version is None:
        return spark.createDataFrame([], LAYERS[layer])
    segments = before.segments if before else ()
    paths = [] if before and before.version >= version else _later_files(spark, layout, layer, before, version)
    return _read_paths(spark, layer, [*segments, *paths], merge_schema)
