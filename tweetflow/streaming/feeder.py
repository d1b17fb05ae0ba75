"""A replay feed in rounds: files that have been landed before are landed again.

A clock, a stream of one row per batch, starts the rounds; its checkpoint
numbers the batches and goes on where it stopped. A round writes its files apart
under the number of its batch and then moves them into the landing directory
under names that tell batch and part. A batch that is run again after a failure
finds what it has written and moves only what is left: every file lands once.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tweetflow.schemas import RAW
from tweetflow.sources import files, landing

_WIDTH = 9


def rounds_done(spark: SparkSession, state: str) -> int:
    """Rounds of which all files have been landed."""
    return len(files.child_names(spark, f"{state}/done"))


def _land_round(
    spark: SparkSession, source: str, target: str, state: str, number: int, num_files: int, schema: T.StructType
) -> None:
    drafts = f"{state}/drafts/{number:0{_WIDTH}d}"
    if not files.exists(spark, f"{drafts}/_SUCCESS"):
        # What an attempt that failed has left is no basis to go on from.
        files.delete(spark, drafts)
        landing.replay_newest(spark, source, drafts, num_files, schema)
    # Names are settled by the first attempt that wrote all its files.
    for name in sorted(files.child_names(spark, drafts)):
        if name.endswith(landing.SUFFIXES):
            files.move_into(spark, f"{drafts}/{name}", target, f"round-{number:0{_WIDTH}d}-{name}")
    files.make_dir(spark, f"{state}/done/{number:0{_WIDTH}d}")


def start_replay(
    spark: SparkSession,
    source: str,
    target: str,
    state: str,
    rounds: int,
    num_files: int = 50,
    interval: str = "10 seconds",
    schema: T.StructType = RAW,
) -> StreamingQuery:
    """Land the newest ``num_files`` files of ``source`` again in ``target``, once every ``interval``.

    ``state`` keeps the checkpoint and what rounds have written. Started again
    over the same ``state``, the feed goes on with the next round. After
    ``rounds`` rounds in all, nothing more is landed; see ``wait_for_rounds``. A
    round in which the source has no files is a round.
    """
    clock = (
        spark.readStream.format("rate-micro-batch")
        .option("rowsPerBatch", 1)
        .option("numPartitions", 1)
        .load()
    )

    def land(tick: DataFrame, number: int) -> None:
        done = files.exists(spark, f"{state}/done/{number:0{_WIDTH}d}")
        if not done and rounds_done(spark, state) < rounds:
            _land_round(spark, source, target, state, number, num_files, schema)

    return (
        clock.writeStream.foreachBatch(land)
        .option("checkpointLocation", f"{state}/checkpoint")
        .queryName("replay_feed")
        .trigger(processingTime=interval)
        .start()
    )


def wait_for_rounds(
    spark: SparkSession,
    query: StreamingQuery,
    state: str,
    rounds: int,
    poll: float = 0.2,
    deadline: float | None = None,
) -> bool:
    """Wait until ``rounds`` rounds have been landed in all, then stop the feed.

    False, and the feed goes on, after ``deadline`` seconds.
    """
    began = time.monotonic()
    while rounds_done(spark, state) < rounds:
        if not query.isActive:
            raise query.exception() or RuntimeError(f"{query.name} was stopped")
        if deadline is not None and time.monotonic() - began > deadline:
            return False
        time.sleep(poll)
    query.stop()
    return True
