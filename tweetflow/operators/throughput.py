"""Scoring throughput under several model batch sizes."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tweetflow.functions.scorers import Model, model_scorer

#: The batch sizes that are compared.
BATCH_SIZES = (1, 8, 16, 32, 64, 128)


def scoring_throughput(
    df: DataFrame,
    factory: Callable[[], Model],
    text: str = "cleaned_text",
    batch_sizes: Sequence[int] = BATCH_SIZES,
) -> DataFrame:
    """Score all of ``df`` once per batch size and report rows per second.

    Nothing is written or collected: results go to the ``noop`` sink, only the
    timings come back. An untimed run on an empty text starts the Python workers.
    """

    def run(texts: DataFrame, batch_size: int) -> float:
        scored = model_scorer(factory, batch_size)(texts, text, "prediction")
        started = time.perf_counter()
        scored.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    texts = df.select(text)
    n_rows = texts.count()
    run(df.sparkSession.range(1).select(F.lit("").alias(text)), 1)
    measured = []
    for batch_size in batch_sizes:
        seconds = run(texts, batch_size)
        measured.append((batch_size, n_rows, seconds, n_rows / seconds))
    return df.sparkSession.createDataFrame(
        measured, "batch_size int, n_rows long, time_sec double, rows_per_sec double"
    )
