"""Kept progress, the report that runs over it, and the replay feed."""

import json

import pytest
from compare import multiset
from pyspark.sql import functions as F

from tweetflow.operators.progress import progress_by_query, progress_by_window
from tweetflow.plans import feed
from tweetflow.schemas import PROGRESS
from tweetflow.sources import files, landing
from tweetflow.streaming import control, feeder, history, stages
from tweetflow.streaming.history import ProgressLog, read_progress


@pytest.fixture(scope="module")
def messages(spark, sf_dir):
    return feed.event_messages(spark, sf_dir)


def test_runs_before_and_after_a_restart_are_kept(spark, messages, new_dir, layout):
    source = new_dir("landing")
    assert read_progress(spark, layout.progress).schema == PROGRESS
    for _ in range(2):
        messages.repartition(3).write.mode("append").json(source)
        query = stages.start_bronze(spark, source, layout, max_files=1)
        control.run_to_end(query, ProgressLog(spark, layout.progress), poll=0.2)
        # Another watcher of the same query notes it all again.
        ProgressLog(spark, layout.progress).flush(query)
    kept = read_progress(spark, layout.progress)
    assert kept.count() == kept.select("run_id", "batch_id").distinct().count() == 6
    assert sorted(r.batch_id for r in kept.collect()) == list(range(6))
    assert progress_by_query(kept).first().input_rows == 2 * messages.count()
    compacted = history.compact_progress(spark, layout.progress, new_dir("compacted"))
    assert multiset(read_progress(spark, compacted)) == multiset(kept)


class Query:
    """A query that remembers its last records only."""

    def __init__(self):
        self.recentProgress = []

    def report(self, *batches, rows=5, idle=False):
        self.recentProgress = [
            type("Report", (), {
                "name": "q", "runId": "r", "batchId": n,
                "durationMs": {} if idle else {"addBatch": 7},
                "json": json.dumps({
                    "name": "q", "runId": "r", "batchId": n, "numInputRows": rows,
                    "timestamp": f"2024-01-01T00:00:{n:02d}.000Z", "durationMs": {"addBatch": 7},
                }),
            })()
            for n in batches
        ]


def test_forgotten_records_show(spark, new_dir):
    query, path = Query(), new_dir("progress")
    log = ProgressLog(spark, path)
    query.report(3, 4)
    assert log.flush(query) == 2 and log.flush(query) == 0
    query.report(5, idle=True)
    assert log.flush(query) == 0, "idle triggers have no batch"
    query.report(7, 8)
    assert log.flush(query) == 4
    rows = {r.batch_id: r for r in read_progress(spark, path).collect()}
    assert sorted(rows) == [3, 4, 5, 6, 7, 8]
    assert {n for n, r in rows.items() if r.input_rows is None and r.ts is None} == {5, 6}
    assert set(log._last) == {"r"}, "a number per run is all that the driver keeps"


def record(query, batch, second, rows=1, run="r"):
    return json.dumps(
        {
            "name": query, "runId": run, "batchId": batch, "numInputRows": rows,
            "timestamp": f"2024-01-01T00:{second // 60:02d}:{second % 60:02d}.000Z", "durationMs": {"addBatch": second},
        }
    )


def test_running_report_equals_the_batch_report(spark, new_dir):
    path, target, checkpoint = new_dir("records"), new_dir("windows"), new_dir("checkpoint")
    arrivals = [
        [record("a", n, n) for n in range(0, 60, 3)] + [record("b", 1, 5)],
        # Late by less than the delay, and reported twice.
        [record("a", n, n) for n in range(60, 120, 3)] + [record("a", 200, 55), record("a", 57, 57)],
        [record("a", n, n) for n in range(120, 300, 3)],
        [record("z", 1, 3000)],
    ]
    states = []
    for lines in arrivals:
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(path)
        query = history.start_windows(spark, path, target, checkpoint)
        query.awaitTermination()
        states.append(sum(o.numRowsTotal for o in query.lastProgress.stateOperators))
    wanted = progress_by_window(read_progress(spark, path)).filter("query <> 'z'")
    assert multiset(spark.read.parquet(target).select(*wanted.columns)) == multiset(wanted)
    assert states[-1] <= 3 and max(states) < 70, "state holds the delay, not the history"

    # Later than the delay: left out, and counted by Spark.
    spark.createDataFrame([(record("a", 999, 10),)], "value string").write.mode("append").text(path)
    query = history.start_windows(spark, path, target, checkpoint)
    query.awaitTermination()
    dropped = sum(o.numRowsDroppedByWatermark for p in query.recentProgress for o in p.stateOperators)
    assert dropped >= 1
    assert multiset(spark.read.parquet(target).select(*wanted.columns)) == multiset(wanted)


def test_rounds_go_on_after_a_restart(spark, messages, new_dir):
    source, target, state = new_dir("source"), new_dir("target"), new_dir("state")
    messages.repartition(4).write.json(source)
    for rounds in (1, 3):
        query = feeder.start_replay(spark, source, target, state, rounds, 10, "300 milliseconds")
        assert feeder.wait_for_rounds(spark, query, state, rounds, deadline=120)
        assert not query.isActive and feeder.rounds_done(spark, state) == rounds
        assert landing.read_batch(spark, target).count() == rounds * messages.count()
    counts = landing.read_batch(spark, target).groupBy(*messages.columns).count()
    once = messages.groupBy(*messages.columns).count().withColumn("count", F.col("count") * 3)
    assert multiset(counts.select(*once.columns)) == multiset(once)


def test_a_round_that_failed_lands_each_file_once(spark, messages, new_dir):
    source, target, state = new_dir("source"), new_dir("target"), new_dir("state")
    messages.repartition(4).write.json(source)
    drafts = f"{state}/drafts/{0:09d}"
    # Two attempts: one died while it wrote, one after it had moved a file.
    messages.limit(3).write.json(drafts)
    files.delete(spark, f"{drafts}/_SUCCESS")
    feeder._land_round(spark, source, target, state, 0, 10, messages.schema)
    landed = sorted(files.child_names(spark, target))
    assert len(landed) == 4 and landing.read_batch(spark, target).count() == messages.count()
    name = landed[0]
    files.move_into(spark, f"{target}/{name}", drafts, name.removeprefix("round-000000000-"))
    files.delete(spark, f"{state}/done/{0:09d}")
    messages.write.mode("append").json(source)  # the source goes on; the round does not
    feeder._land_round(spark, source, target, state, 0, 10, messages.schema)
    assert sorted(files.child_names(spark, target)) == landed
    assert landing.read_batch(spark, target).count() == messages.count()


def test_a_round_without_files_is_a_round(spark, new_dir):
    state, target = new_dir("state"), new_dir("target")
    query = feeder.start_replay(spark, new_dir("nothing"), target, state, 2, 5, "200 milliseconds")
    assert feeder.wait_for_rounds(spark, query, state, 2, deadline=60)
    assert files.child_names(spark, target) == []
