"""The application table kept up to date batch by batch.

Every batch of the gold stream leaves one partial row per mention: first and
last time, and counts. Such rows can be merged in any grouping, so the table is
a merge of partials and never reads gold again. A batch is stored under its
number: a batch that is run again after a failure replaces what it left before.
Partials of many batches are folded into one from time to time; a fold takes
effect by the rename of its directory, and readers take the newest one and the
batches after it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tweetflow.operators.mentions import mention_app_table
from tweetflow.schemas import MENTIONS
from tweetflow.sources import files
from tweetflow.sources.tables import Layout
from tweetflow.streaming.stages import BOUNDED, MAX_BATCH_BYTES, read_upstream

_WIDTH = 12


def _batch_path(layout: Layout, batch: int) -> str:
    return f"{layout.partials}/{batch:0{_WIDTH}d}"


def _whole(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the directories that have been written to their end."""
    return sorted(
        int(name)
        for name in files.child_names(spark, path)
        if name.isdigit() and files.exists(spark, f"{path}/{name}/_SUCCESS")
    )


def start_mentions(
    spark: SparkSession,
    layout: Layout,
    trigger: dict = BOUNDED,
    max_bytes: int = MAX_BATCH_BYTES,
    upstream: Layout | None = None,
) -> StreamingQuery:
    """Follow the gold table, by default the one of the same layout.

    A batch is aggregated once, with partial counts per task before the shuffle,
    so its partial has a row per mention however often one is mentioned.
    """
    gold = read_upstream(spark, upstream or layout, "gold", max_bytes)

    def keep(batch: DataFrame, number: int) -> None:
        mention_app_table(batch).write.mode("overwrite").parquet(_batch_path(layout, number))

    return (
        gold.writeStream.foreachBatch(keep)
        .option("checkpointLocation", layout.partials_checkpoint)
        .queryName("mentions_stream")
        .trigger(**trigger)
        .start()
    )


def _parts(spark: SparkSession, layout: Layout) -> tuple[list[str], int]:
    """The newest fold and the batches after it; number of the last batch, -1 for none."""
    folds = _whole(spark, layout.folds)
    paths = [f"{layout.folds}/{folds[-1]:0{_WIDTH}d}"] if folds else []
    last = folds[-1] if folds else -1
    later = [n for n in _whole(spark, layout.partials) if n > last]
    return [*paths, *(_batch_path(layout, n) for n in later)], max([last, *later])


def merge(partials: DataFrame) -> DataFrame:
    """Partial rows of the same mention as one."""
    counts = [c for c in MENTIONS.fieldNames() if c not in ("mention", "min_timestamp", "max_timestamp")]
    merged = partials.groupBy("mention").agg(
        F.min("min_timestamp").alias("min_timestamp"),
        F.max("max_timestamp").alias("max_timestamp"),
        *(F.sum(c).alias(c) for c in counts),
    )
    return merged.select(*MENTIONS.fieldNames())


def read_mentions(spark: SparkSession, layout: Layout) -> DataFrame:
    """The application table from the partials of all batches that are whole."""
    paths, _ = _parts(spark, layout)
    if not paths:
        return spark.createDataFrame([], MENTIONS)
    return merge(spark.read.schema(MENTIONS).parquet(*paths))


def fold(spark: SparkSession, layout: Layout) -> int | None:
    """Merge all partials there are into one; the number of its last batch, None if there are none.

    Batches that are folded can be dropped with ``drop_folded``. The last batch
    is left out while it may be run again, that is until a later one is whole.
    """
    whole = _whole(spark, layout.partials)[:-1]
    folds = _whole(spark, layout.folds)
    last = folds[-1] if folds else -1
    later = [n for n in whole if n > last]
    if not later:
        return folds[-1] if folds else None
    paths = [f"{layout.folds}/{last:0{_WIDTH}d}"] if folds else []
    paths += [_batch_path(layout, n) for n in later]
    draft = f"{layout.folds}/_draft-{uuid.uuid4().hex}"
    merge(spark.read.schema(MENTIONS).parquet(*paths)).write.parquet(draft)
    files.publish(spark, draft, f"{layout.folds}/{later[-1]:0{_WIDTH}d}")
    return later[-1]


def drop_folded(spark: SparkSession, layout: Layout) -> int:
    """Delete partials and folds that the newest fold holds; how many.

    Not while a report is being computed from them.
    """
    folds = _whole(spark, layout.folds)
    if not folds:
        return 0
    old = [_batch_path(layout, n) for n in _whole(spark, layout.partials) if n <= folds[-1]]
    old += [f"{layout.folds}/{n:0{_WIDTH}d}" for n in folds[:-1]]
    return sum(files.delete(spark, path) for path in old)
