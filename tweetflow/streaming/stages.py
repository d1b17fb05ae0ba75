"""The three streaming stages: landing files to bronze to silver to gold."""

from __future__ import annotations

import time
import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tweetflow.functions.scorers import Scorer
from tweetflow.operators.layers import to_bronze, to_gold, to_silver
from tweetflow.schemas import LAYERS, RAW
from tweetflow.session import configure, spread_scans
from tweetflow.sources import landing
from tweetflow.sources.tables import MAX_FILE_ROWS, TABLE_CODEC, Layout, admit, read_layer, table_version

#: Read what is there now, in bounded micro-batches, then end.
BOUNDED = {"availableNow": True}
#: Keep running and look for new data every so often.
EVERY_10_SECONDS = {"processingTime": "10 seconds"}


#: Bound of a micro-batch, about one wave of scan tasks of a large cluster: what
#: a failure costs is one batch, not the whole backlog.
MAX_BATCH_BYTES = 512 << 30


class UpstreamNotReady(RuntimeError):
    """A stage was started before the table it reads had its first batch."""


def start_bronze(
    spark: SparkSession,
    landing_dir: str,
    layout: Layout,
    trigger: dict = BOUNDED,
    schema: T.StructType = RAW,
    max_bytes: int = MAX_BATCH_BYTES,
    max_files: int | None = None,
    corrupt_column: str | None = None,
    rescue_column: str | None = None,
    archive: str | None = None,
) -> StreamingQuery:
    """Ingest new landing files. ``schema`` may have gained columns since the
    last run; starting never drops what is there (see ``tables.reset``). With
    ``corrupt_column`` the table gains a column that keeps malformed lines, with
    ``rescue_column`` one that keeps fields which ``schema`` lacks. ``archive`` is
    where files go that have been ingested (see ``landing.read_stream``).

    A micro-batch is bounded by ``max_files`` if given, else by ``max_bytes``.
    """
    bound = {"max_bytes": max_bytes} if max_files is None else {"max_files": max_files}
    raw = landing.read_stream(
        spark,
        landing_dir,
        schema,
        corrupt_column=corrupt_column,
        rescue_column=rescue_column,
        archive=archive,
        **bound,
    )
    return _append(to_bronze(raw), layout, "bronze", trigger)


def start_silver(
    spark: SparkSession,
    layout: Layout,
    trigger: dict = BOUNDED,
    max_bytes: int = MAX_BATCH_BYTES,
    upstream: Layout | None = None,
) -> StreamingQuery:
    """Follow the bronze table, by default the one of the same layout."""
    bronze = read_upstream(spark, upstream or layout, "bronze", max_bytes)
    return _append(to_silver(bronze), layout, "silver", trigger)


def start_gold(
    spark: SparkSession,
    layout: Layout,
    scorer: Scorer,
    trigger: dict = BOUNDED,
    max_bytes: int = MAX_BATCH_BYTES,
    upstream: Layout | None = None,
) -> StreamingQuery:
    """Follow the silver table, by default the one of the same layout. With
    another ``upstream`` a table is scored anew beside its first scores."""
    silver = read_upstream(spark, upstream or layout, "silver", max_bytes)
    return _append(to_gold(silver, scorer), layout, "gold", trigger)


def read_upstream(
    spark: SparkSession, layout: Layout, layer: str, max_bytes: int = MAX_BATCH_BYTES
) -> DataFrame:
    """A layer table as a stream; its sink log says which files are committed."""
    path = layout.table(layer)
    if table_version(spark, path) is None:
        raise UpstreamNotReady(f"no batch has been committed to {path} yet")
    return (
        spark.readStream.schema(LAYERS[layer])
        .option("maxFileAge", landing.MAX_FILE_AGE)
        .option("maxBytesPerTrigger", str(max_bytes))
        .parquet(path)
    )


def _append(df: DataFrame, layout: Layout, layer: str, trigger: dict) -> StreamingQuery:
    admit(df.sparkSession, layout, layer, df.schema)
    # Names are unique among active queries; a second run of a layer beside the
    # first is named after its table as well.
    name = f"{layer}_stream"
    if any(query.name == name for query in df.sparkSession.streams.active):
        name += f"_{zlib.crc32(layout.table(layer).encode()):08x}"
    return (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", layout.checkpoint(layer))
        .option("path", layout.table(layer))
        .option("compression", TABLE_CODEC)
        .option("maxRecordsPerFile", str(MAX_FILE_ROWS))
        .queryName(name)
        .trigger(**trigger)
        .start()
    )


def _extent(spark: SparkSession, layout: Layout, layer: str) -> tuple[int, int]:
    """Number of the last committed batch (-1 for none) and rows of a layer table."""
    version = table_version(spark, layout.table(layer))
    if version is None:
        return -1, 0
    return version, read_layer(spark, layout, layer).count()


def run_stages(
    spark: SparkSession,
    landing_dir: str,
    layout: Layout,
    scorer: Scorer,
    max_bytes: int = MAX_BATCH_BYTES,
) -> DataFrame:
    """Bring all three tables up to date with the landing directory, then end.

    Call it again when files have arrived: it goes on from the checkpoints.
    Returns ``(stage, written_rows, n_batches, seconds)`` of this run, from what
    the tables hold and from their sink logs, before and after: rows are counted
    in file footers. (Progress records would not do: a query remembers only
    the last of them.)
    """
    configure(spark)
    stages: dict[str, Callable[[], StreamingQuery]] = {
        "bronze": lambda: start_bronze(spark, landing_dir, layout, max_bytes=max_bytes),
        "silver": lambda: start_silver(spark, layout, max_bytes=max_bytes),
        "gold": lambda: start_gold(spark, layout, scorer, max_bytes=max_bytes),
    }
    report = []
    upstream_ready = True
    for layer, start in stages.items():
        version, n_rows = _extent(spark, layout, layer)
        started = time.perf_counter()
        if upstream_ready:
            with spread_scans(spark):
                start().awaitTermination()
        seconds = time.perf_counter() - started
        new_version, new_rows = _extent(spark, layout, layer)
        report.append((layer, new_rows - n_rows, new_version - version, seconds))
        upstream_ready = new_version >= 0
    return spark.createDataFrame(
        report, "stage string, written_rows long, n_batches long, seconds double"
    )
