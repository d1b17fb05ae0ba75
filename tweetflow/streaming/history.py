"""The progress of streaming queries, kept for good.

A query remembers its last records only, and only while it lives. A
``ProgressLog`` appends them, as Spark reports them, to a table of JSON lines
that outlasts the query, the session and the driver. Records are told apart by
run and batch when the table is read, so one that is appended twice counts once.
In the driver nothing is kept but the number of the last batch of each run.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tweetflow.operators.progress import running_windows
from tweetflow.schemas import PROGRESS
from tweetflow.sources import files


#: Read what is there now, then end.
BOUNDED = {"availableNow": True}


class ProgressLog:
    """Appends progress records under ``path``."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path
        self._last: dict[str, int] = {}

    def flush(self, *queries: StreamingQuery) -> int:
        """Append what the queries have reported since the last flush; how many records.

        Reports of idle triggers are left out: they belong to no batch. A batch
        whose report Spark has forgotten is noted by its number alone, so a
        total over the table shows that it is incomplete.
        """
        lines = []
        for query in queries:
            for report in query.recentProgress:
                run, batch = str(report.runId), report.batchId
                last = self._last.get(run)
                if "addBatch" not in report.durationMs or (last is not None and batch <= last):
                    continue
                if last is not None:
                    name = {"name": report.name, "runId": run}
                    lines += [json.dumps({**name, "batchId": n}) for n in range(last + 1, batch)]
                lines.append(report.json)
                self._last[run] = batch
        if lines:
            frame = self.spark.createDataFrame([(line,) for line in lines], "value string")
            frame.coalesce(1).write.mode("append").text(self.path)
        return len(lines)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """All batches of all runs in the form of ``schemas.PROGRESS``, each once.

    A batch whose report was lost has neither time nor rows.
    """
    from tweetflow.streaming.control import parse_progress

    if not files.exists(spark, path):
        return spark.createDataFrame([], PROGRESS)
    batches = parse_progress(spark.read.text(path))
    return batches.withColumn("input_rows", F.when(F.col("ts").isNotNull(), F.col("input_rows")))


def start_windows(
    spark: SparkSession,
    path: str,
    target: str,
    checkpoint: str,
    trigger: dict = BOUNDED,
    width: str = "10 seconds",
    delay: str = "1 minute",
    max_files: int | None = None,
) -> StreamingQuery:
    """Keep the report per query and time window up to date while progress is appended under ``path``.

    Rows of windows that are complete are appended to ``target``; see
    ``progress.running_windows``. Reports that were lost have no time and no window.
    """
    from tweetflow.streaming.control import progress_rows

    reader = spark.readStream
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    records = progress_rows(reader.text(path)).filter(F.col("ts").isNotNull())
    return (
        running_windows(records, width, delay)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", target)
        .queryName("progress_windows")
        .trigger(**trigger)
        .start()
    )


def compact_progress(spark: SparkSession, path: str, target: str) -> str:
    """Copy the table to a new directory, a batch in one line; polls leave many small files."""
    lines = spark.read.text(path).dropDuplicates(["value"])
    lines.repartition(1 + files.file_sizes(spark, path, ".txt").first().n_bytes // (128 << 20)).write.text(target)
    return target
