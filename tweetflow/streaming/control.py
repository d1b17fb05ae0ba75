"""Watching, waiting for and stopping streaming queries."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tweetflow.schemas import PROGRESS, STREAM_STATUS
from tweetflow.sources.tables import table_version
from tweetflow.streaming.history import ProgressLog

UNNAMED = "<unnamed>"

#: The parts of a progress record that are kept; all of them may be absent.
STATE_OPERATORS = "array<struct<memoryUsedBytes: long>>"
PROGRESS_JSON = (
    "name string, runId string, batchId long, timestamp timestamp, numInputRows long,"
    f" durationMs struct<addBatch: long>, stateOperators {STATE_OPERATORS}"
)


def list_streams(spark: SparkSession) -> DataFrame:
    """One row per active query."""
    rows = [
        (
            query.name or UNNAMED,
            str(query.runId),
            query.isActive,
            query.status["message"],
            query.status["isDataAvailable"],
            query.status["isTriggerActive"],
        )
        for query in spark.streams.active
    ]
    return spark.createDataFrame(rows, STREAM_STATUS)


def stop_streams(spark: SparkSession, name: str | None = None) -> bool:
    """Stop all queries, or those of one name; True if there were any."""
    matching = [q for q in spark.streams.active if name is None or q.name == name]
    for query in matching:
        query.stop()
    return bool(matching)


def wait_stream_start(
    spark: SparkSession, name: str, timeout: float = 30.0, poll: float = 0.5
) -> bool:
    """Wait until a query of that name is active; False after ``timeout``."""
    return _wait_for(lambda: any(q.name == name for q in spark.streams.active), timeout, poll)


def wait_for_rows(
    spark: SparkSession,
    table: str,
    timeout: float | None = 30.0,
    poll: float = 2.0,
    writer: StreamingQuery | None = None,
) -> bool:
    """Wait until a table holds a row; False after ``timeout``.

    Without a ``timeout`` the wait lasts as long as ``writer`` is active.
    """

    def has_rows() -> bool:
        if writer is not None and not writer.isActive and writer.exception() is not None:
            raise writer.exception()
        if table_version(spark, table) is None:
            return False
        return not spark.read.parquet(table).isEmpty()

    def given_up() -> bool:
        return timeout is None and (writer is None or not writer.isActive)

    return _wait_for(has_rows, timeout, poll, given_up)


def _wait_for(
    condition: Callable[[], bool],
    timeout: float | None,
    poll: float,
    given_up: Callable[[], bool] = lambda: False,
) -> bool:
    deadline = None if timeout is None else time.monotonic() + timeout
    while not condition():
        if given_up():
            return condition()
        if deadline is not None and time.monotonic() >= deadline:
            return False
        time.sleep(poll)
    return True


def progress_table(spark: SparkSession, records: Iterable[str]) -> DataFrame:
    """Progress records, as JSON, in the form of ``schemas.PROGRESS``.

    A batch is one row, however often it was reported.
    """
    return parse_progress(spark.createDataFrame([(r,) for r in records], "value string"))


def progress_rows(records: DataFrame) -> DataFrame:
    """Records, as JSON in ``value``, in the form of ``schemas.PROGRESS``, one row per report."""
    parsed = records.select(F.from_json("value", PROGRESS_JSON).alias("p"))
    none = F.lit(0).cast("long")
    state = F.aggregate(
        F.coalesce("p.stateOperators", F.array().cast(STATE_OPERATORS)),
        none,
        lambda total, operator: total + F.coalesce(operator["memoryUsedBytes"], none),
    )
    return parsed.select(
        F.coalesce("p.name", F.lit(UNNAMED)).alias("query"),
        F.col("p.runId").alias("run_id"),
        F.col("p.batchId").alias("batch_id"),
        F.col("p.timestamp").alias("ts"),
        F.coalesce("p.numInputRows", none).alias("input_rows"),
        F.col("p.durationMs.addBatch").alias("processing_time"),
        state.alias("memory_used"),
    )


def parse_progress(records: DataFrame) -> DataFrame:
    """The same, one row per batch."""
    # An idle report has zero rows and the id of the batch to come, so of
    # several reports with one id that with the most rows is the batch itself.
    report = F.struct("input_rows", "ts", "processing_time", "memory_used")
    return (
        progress_rows(records)
        .groupBy("query", "run_id", "batch_id")
        .agg(F.max(report).alias("r"))
        .select("query", "run_id", "batch_id", "r.*")
        .select(*PROGRESS.fieldNames())
    )


def run_to_end(query: StreamingQuery, kept: ProgressLog, poll: float = 1.0) -> None:
    """Wait for a bounded run to end; its progress goes to ``kept`` while it runs.

    Spark remembers only the last ``numRecentProgressUpdates`` records of a query.
    """
    ended = False
    while not ended:
        ended = query.awaitTermination(poll)
        kept.flush(query)


def snapshot(spark: SparkSession) -> DataFrame:
    """The last progress of every active query."""
    return progress_table(
        spark, [q.lastProgress.json for q in spark.streams.active if q.lastProgress]
    )


class IdleRule:
    """Counts the polls in a row that found a query with nothing to do.

    Idle means: it has reported progress, no data is waiting or being worked
    on, and no batch has been finished since the last poll. A first batch that
    takes long is therefore not mistaken for idleness. Whether a trigger is
    running says nothing: where listing a directory takes longer than the
    trigger interval, one always is.
    """

    def __init__(self, query: StreamingQuery) -> None:
        self.query = query
        self.idle_polls = 0
        self._last_batch: tuple | None = None

    def poll(self) -> int:
        progress, status = self.query.lastProgress, self.query.status
        if progress is None or status["isDataAvailable"]:
            self.idle_polls = 0
            return 0
        batch = (progress.batchId, progress.numInputRows)
        fresh = batch != self._last_batch and progress.numInputRows > 0
        self._last_batch = batch
        self.idle_polls = 0 if fresh else self.idle_polls + 1
        return self.idle_polls


def wait_until_idle(
    queries: StreamingQuery | Iterable[StreamingQuery],
    idle_rounds: int = 3,
    poll: float = 10.0,
    kept: ProgressLog | None = None,
    deadline: float | None = None,
) -> None:
    """Poll until every query has been idle for ``idle_rounds`` polls or has
    ended, then stop them. At each poll their progress goes to ``kept``.

    ``idle_rounds`` polls should span more than one trigger interval and one
    listing of the source, or a query may be taken for idle between two batches.
    After ``deadline`` seconds, if given, a ``TimeoutError`` is raised and the
    queries are left as they are.
    """
    began = time.monotonic()
    queries = [queries] if isinstance(queries, StreamingQuery) else list(queries)
    rules = [IdleRule(query) for query in queries]

    def flush() -> None:
        if kept is not None:
            kept.flush(*queries)

    while True:
        # All queries are polled before deciding: an upstream that is idle now
        # may have fed its downstream just before.
        polls = [rule.poll() if rule.query.isActive else idle_rounds for rule in rules]
        flush()
        if all(n >= idle_rounds for n in polls):
            break
        if deadline is not None and time.monotonic() - began > deadline:
            raise TimeoutError(f"not idle after {deadline} s: {[q.name for q in queries]}")
        time.sleep(poll)
    for query in queries:
        query.stop()
        if query.exception() is not None:
            raise query.exception()
    flush()
