"""Aggregates over the progress table (``schemas.PROGRESS``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _series(grouped) -> DataFrame:
    return grouped.agg(
        F.sum("input_rows").alias("input_rows"),
        F.avg("processing_time").alias("avg_processing_time"),
        F.count("*").alias("n_batches"),
    )


def progress_by_query(progress: DataFrame) -> DataFrame:
    """Rows read and mean processing time of every query."""
    return _series(progress.groupBy("query"))


def progress_by_window(progress: DataFrame, width: str = "10 seconds") -> DataFrame:
    """The same per query and time window: the series behind a line chart."""
    return _series(progress.groupBy("query", F.window("ts", width).alias("w"))).select(
        "query",
        F.col("w.start").alias("window_start"),
        "input_rows",
        "avg_processing_time",
        "n_batches",
    )


def running_windows(progress: DataFrame, width: str = "10 seconds", delay: str = "1 minute") -> DataFrame:
    """``progress_by_window`` of a stream of records, each window once, when it is complete.

    A window is complete ``delay`` after its end, by the times of the records
    themselves; records that come later than that are left out. A batch that is
    reported twice within the delay counts once. The state holds the windows and
    the batches of the last ``delay``, not the history.
    """
    once = progress.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["query", "run_id", "batch_id"])
    return progress_by_window(once, width)


def with_elapsed(progress: DataFrame) -> DataFrame:
    """Seconds since the first batch of the same query.

    A join with the first times instead of a window function: a window would
    pull all batches of one query into one task. Spark sends the first times to
    the rows if they turn out to be few, and splits a query that has very many.
    """
    first = progress.groupBy("query").agg(F.min("ts").alias("__first_ts"))
    micros = F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(
        F.col("__first_ts").cast("timestamp")
    )
    return (
        progress.join(first, "query")
        .withColumn("elapsed_time", micros / F.lit(1e6))
        .drop("__first_ts")
    )
