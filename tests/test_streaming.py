"""The streaming stages give what the batch functions give."""

import time

import pytest
from compare import multiset
from pyspark.sql import functions as F

from tweetflow.functions.scorers import lexicon_model, model_scorer
from tweetflow.operators.layers import to_gold, to_silver
from tweetflow.operators.progress import progress_by_query, progress_by_window, with_elapsed
from tweetflow.plans import feed
from tweetflow.schemas import GOLD, LAYERS, PROGRESS, RAW, SchemaMismatch, T
from tweetflow.sources import files, tables
from tweetflow.sources.tables import Layout, read_layer
from tweetflow.streaming import control, stages
from tweetflow.streaming.history import ProgressLog, read_progress


def land(df, path, n_files=6):
    df.repartition(n_files).write.mode("append").json(path)


@pytest.fixture(scope="module")
def messages(spark, sf_dir):
    return feed.messages(spark, sf_dir)


@pytest.fixture(scope="module")
def batch_gold(messages, scorer):
    return multiset(to_gold(to_silver(messages), scorer))


@pytest.mark.parametrize("bound", [{}, {"max_files": 1}, {"max_files": 4}, {"max_bytes": 100_000}])
def test_stream_equals_batch(spark, messages, batch_gold, scorer, new_dir, layout, bound):
    source = new_dir("landing")
    land(messages, source)
    stages.start_bronze(spark, source, layout, **bound).awaitTermination()
    stages.start_silver(spark, layout, max_bytes=50_000).awaitTermination()
    stages.start_gold(spark, layout, scorer).awaitTermination()
    assert multiset(read_layer(spark, layout, "bronze").select(*RAW.fieldNames())) == multiset(
        messages
    )
    assert multiset(read_layer(spark, layout, "gold")) == batch_gold
    n_batches = tables.table_version(spark, layout.table("bronze")) + 1
    if "max_files" in bound:
        assert n_batches == -(-6 // bound["max_files"])
    if "max_bytes" in bound:
        assert n_batches > 1


def test_restart_neither_loses_nor_repeats(spark, messages, batch_gold, scorer, new_dir, layout):
    source = new_dir("landing")
    halves = [messages.filter(F.crc32("text") % 2 == i) for i in (0, 1)]
    rest = messages.filter("text IS NULL")
    land(halves[0], source)
    first = stages.run_stages(spark, source, layout, scorer)
    assert [r.stage for r in first.collect()] == ["bronze", "silver", "gold"]
    n_first = first.collect()[0].written_rows

    idle = stages.run_stages(spark, source, layout, scorer)
    assert [(r.written_rows, r.n_batches) for r in idle.collect()] == [(0, 0)] * 3
    assert read_layer(spark, layout, "bronze").count() == n_first, "nothing new, nothing added"

    land(halves[1], source)
    land(rest, source)
    second = stages.run_stages(spark, source, layout, scorer)
    assert multiset(read_layer(spark, layout, "gold")) == batch_gold
    totals = first.union(second).groupBy("stage").agg(F.sum("written_rows").alias("n"))
    assert {r.stage: r.n for r in totals.collect()} == {
        "bronze": messages.count(), "silver": len(batch_gold), "gold": len(batch_gold),
    }


def test_model_scorer_in_a_stream(spark, messages, batch_gold, new_dir, layout):
    source = new_dir("landing")
    land(messages, source)
    stages.run_stages(spark, source, layout, model_scorer(lexicon_model(feed.LEXICON), 7))
    assert multiset(read_layer(spark, layout, "gold")) == batch_gold


def test_a_stage_that_died_is_taken_up_again(spark, messages, batch_gold, scorer, new_dir, layout):
    """The model fails on one text; after it is mended the run goes on."""
    source = new_dir("landing")
    land(messages, source)
    stages.start_bronze(spark, source, layout).awaitTermination()
    stages.start_silver(spark, layout).awaitTermination()

    def broken():
        def model(texts):
            raise RuntimeError("model failed")

        return model

    query = stages.start_gold(spark, layout, model_scorer(broken), max_bytes=50_000)
    with pytest.raises(Exception, match="model failed"):
        query.awaitTermination()
    stages.start_gold(spark, layout, scorer, max_bytes=50_000).awaitTermination()
    assert multiset(read_layer(spark, layout, "gold")) == batch_gold


def test_empty_landing_directory(spark, scorer, new_dir, layout):
    source = new_dir("empty")
    spark.createDataFrame([], RAW).write.json(source)
    report = stages.run_stages(spark, source, layout, scorer)
    assert [r.written_rows for r in report.collect()] == [0, 0, 0]
    for layer, schema in LAYERS.items():
        df = read_layer(spark, layout, layer)
        assert df.schema == schema and df.isEmpty()


def test_downstream_needs_an_upstream(spark, scorer, layout):
    with pytest.raises(stages.UpstreamNotReady, match="bronze.table"):
        stages.start_silver(spark, layout)
    with pytest.raises(stages.UpstreamNotReady, match="silver.table"):
        stages.start_gold(spark, layout, scorer)


def test_bronze_table_gains_a_column(spark, messages, scorer, new_dir, layout):
    source = new_dir("landing")
    land(messages, source)
    stages.start_bronze(spark, source, layout).awaitTermination()
    wide = T.StructType(RAW.fields + [T.StructField("lang", T.StringType())])
    land(messages.withColumn("lang", F.lit("en")), source)
    stages.run_stages(spark, source, layout, scorer)  # the narrow schema drops the field
    land(messages.withColumn("lang", F.lit("fr")), source)
    stages.start_bronze(spark, source, layout, schema=wide).awaitTermination()
    merged = read_layer(spark, layout, "bronze", merge_schema=True)
    n = messages.count()
    assert {r["lang"]: r["count"] for r in merged.groupBy("lang").count().collect()} == {
        None: 2 * n, "fr": n,
    }
    assert "lang" not in read_layer(spark, layout, "bronze").columns

    snapshot = tables.compact(spark, layout.table("bronze"), new_dir("compact"))
    compacted = spark.read.parquet(snapshot)
    assert multiset(compacted.select(*merged.columns)) == multiset(merged)


def test_a_changed_type_is_refused(spark, messages, new_dir, layout):
    source = new_dir("landing")

    def ingest(*gained):
        schema = T.StructType(RAW.fields + [T.StructField(*g) for g in gained])
        stages.start_bronze(spark, source, layout, schema=schema).awaitTermination()

    land(messages.withColumn("n", F.lit(1)), source)
    ingest(("n", T.IntegerType()))
    land(messages.withColumn("n", F.lit("one")), source)
    # Also where the noted columns are missing and the files have to tell.
    for _ in range(2):
        with pytest.raises(SchemaMismatch, match="column N is string, in the table int"):
            ingest(("N", T.StringType()))
        assert read_layer(spark, layout, "bronze", merge_schema=True).count() == messages.count()
        files.delete(spark, layout.schemas("bronze"))
    ingest(("m", T.DoubleType()))  # another column may come, and n may stay away
    with pytest.raises(SchemaMismatch, match="column m"):
        ingest(("m", T.StringType()))
    merged = read_layer(spark, layout, "bronze", merge_schema=True)
    assert merged.count() == 2 * messages.count()
    assert dict(merged.dtypes)["n"] == "int" and dict(merged.dtypes)["m"] == "double"


def test_types_noted_before_the_first_batch_do_not_bind(spark, layout):
    tables.admit(spark, layout, "gold", T.StructType([T.StructField("a", T.IntegerType())]))
    tables.admit(spark, layout, "gold", T.StructType([T.StructField("a", T.StringType())]))


def test_malformed_lines_reach_the_bronze_table(spark, messages, new_dir, layout):
    source = new_dir("landing")
    land(messages, source)
    spark.createDataFrame([("{bad",), ('{"text": 1, "user": ',)], "value string").write.mode(
        "append"
    ).text(source)
    stages.start_bronze(spark, source, layout, corrupt_column="line").awaitTermination()
    merged = read_layer(spark, layout, "bronze", merge_schema=True)
    assert {r.line for r in merged.filter("line IS NOT NULL").collect()} == {"{bad", '{"text": 1, "user": '}
    assert merged.filter("line IS NULL").count() == messages.count()


def test_provenance_names_the_landing_file(spark, messages, new_dir, layout):
    source = new_dir("landing")
    land(messages, source, 3)
    stages.start_bronze(spark, source, layout, max_files=1).awaitTermination()
    bronze = read_layer(spark, layout, "bronze")
    per_file = bronze.groupBy("source_file").agg(F.countDistinct("processing_time").alias("n"))
    rows = per_file.collect()
    assert len(rows) == 3 and all(r.n == 1 and source in r.source_file for r in rows)
    assert bronze.select("processing_time").distinct().count() == 3


def test_continuous_run_until_idle(spark, messages, batch_gold, scorer, new_dir, layout):
    source = new_dir("landing")
    land(messages, source)
    often = {"processingTime": "300 milliseconds"}
    running = [stages.start_bronze(spark, source, layout, often, max_files=2)]
    assert control.wait_for_rows(spark, layout.table("bronze"), 60, 0.2)
    running.append(stages.start_silver(spark, layout, often))
    assert control.wait_for_rows(spark, layout.table("silver"), 60, 0.2)
    running.append(stages.start_gold(spark, layout, scorer, often))
    assert {r.name for r in control.list_streams(spark).collect()} == {
        "bronze_stream", "silver_stream", "gold_stream",
    }
    assert control.snapshot(spark).columns == PROGRESS.fieldNames()
    control.wait_until_idle(running, idle_rounds=3, poll=0.6, kept=ProgressLog(spark, layout.progress))
    assert not any(q.isActive for q in running)
    assert multiset(read_layer(spark, layout, "gold")) == batch_gold

    progress = read_progress(spark, layout.progress)
    totals = {r["query"]: r.input_rows for r in progress_by_query(progress).collect()}
    assert set(totals) == {"bronze_stream", "silver_stream", "gold_stream"}
    assert totals["bronze_stream"] == messages.count()
    assert progress.groupBy("run_id", "batch_id").count().filter("count > 1").isEmpty()


def test_waiting_and_stopping(spark, messages, new_dir):
    source = new_dir("landing")
    land(messages, source)
    assert not control.wait_stream_start(spark, "bronze_stream", timeout=0.3, poll=0.1)
    assert not control.stop_streams(spark)
    assert control.list_streams(spark).isEmpty()

    first = stages.start_bronze(spark, source, Layout(new_dir("a")), stages.EVERY_10_SECONDS)
    assert control.wait_stream_start(spark, "bronze_stream", timeout=10, poll=0.1)
    assert not control.stop_streams(spark, "silver_stream")
    assert first.isActive
    assert control.stop_streams(spark, "bronze_stream")
    assert not first.isActive

    second = stages.start_bronze(spark, source, Layout(new_dir("b")), stages.EVERY_10_SECONDS)
    assert control.stop_streams(spark)
    assert not second.isActive and not spark.streams.active


def test_no_rows_to_wait_for(spark, new_dir):
    started = time.monotonic()
    assert not control.wait_for_rows(spark, new_dir("nothing"), timeout=0.5, poll=0.1)
    assert time.monotonic() - started < 5


class FakeProgress:
    def __init__(self, batch_id, rows):
        self.batchId, self.numInputRows = batch_id, rows


class FakeQuery:
    """A query whose state the test sets."""

    def __init__(self):
        self.lastProgress, self.isActive = None, True
        self.status = {"isDataAvailable": False, "isTriggerActive": False}


def test_idle_rule():
    query = FakeQuery()
    rule = control.IdleRule(query)
    assert [rule.poll(), rule.poll()] == [0, 0], "no progress yet: the first batch may be long"
    query.lastProgress = FakeProgress(0, 10)
    assert [rule.poll(), rule.poll(), rule.poll()] == [0, 1, 2], "one batch counts as work once"
    query.status = {"isDataAvailable": False, "isTriggerActive": True}
    assert rule.poll() == 3, "a trigger may always be running where listing is slow"
    query.status = {"isDataAvailable": True, "isTriggerActive": True}
    assert rule.poll() == 0, "data is being worked on"
    query.status = {"isDataAvailable": False, "isTriggerActive": False}
    query.lastProgress = FakeProgress(1, 5)
    assert [rule.poll(), rule.poll()] == [0, 1]
    query.lastProgress = FakeProgress(2, 0)
    assert rule.poll() == 2, "a batch without rows is idleness"


def test_waiting_for_idleness_has_a_deadline():
    busy = FakeQuery()
    busy.name, busy.recentProgress = "busy", []
    with pytest.raises(TimeoutError):
        control.wait_until_idle([busy], poll=0.05, deadline=0.2)


def test_progress_records(spark):
    def record(batch, rows, second, extra=""):
        return (
            f'{{"name": "q", "runId": "r", "batchId": {batch}, "numInputRows": {rows},'
            f' "timestamp": "2024-01-01T00:00:{second:02d}.500Z"{extra}}}'
        )

    table = control.progress_table(
        spark,
        [
            record(0, 7, 1, ', "durationMs": {"addBatch": 40}'),
            record(0, 7, 1, ', "durationMs": {"addBatch": 40}'),
            record(1, 0, 11, ', "durationMs": {"latestOffset": 1}'),
            record(1, 5, 21, ', "durationMs": {"addBatch": 60}, "stateOperators":'
                             ' [{"memoryUsedBytes": 8}, {"memoryUsedBytes": 4}]'),
            '{"runId": "s", "batchId": 0, "timestamp": "2024-01-01T00:00:05.000Z"}',
        ],
    )
    assert [f.name for f in table.schema] == PROGRESS.fieldNames()
    rows = {(r["query"], r.batch_id): r for r in table.collect()}
    assert len(rows) == 3
    assert rows["q", 0].processing_time == 40 and rows["q", 0].memory_used == 0
    assert rows["q", 1].input_rows == 5 and rows["q", 1].memory_used == 12
    assert rows["<unnamed>", 0].input_rows == 0
    assert rows["<unnamed>", 0].processing_time is None

    summary = {r["query"]: tuple(r)[1:] for r in progress_by_query(table).collect()}
    assert summary == {"q": (12, 50.0, 2), "<unnamed>": (0, None, 1)}
    elapsed = {(r["query"], r.batch_id): r.elapsed_time for r in with_elapsed(table).collect()}
    assert elapsed == {("q", 0): 0.0, ("q", 1): 20.0, ("<unnamed>", 0): 0.0}
    assert progress_by_window(table).count() == 3


def test_gold_table_has_the_declared_schema(spark, messages, scorer, new_dir, layout):
    source = new_dir("landing")
    land(messages, source)
    stages.run_stages(spark, source, layout, scorer)
    found = spark.read.parquet(layout.table("gold")).schema
    assert [(f.name, f.dataType) for f in found] == [(f.name, f.dataType) for f in GOLD]


def test_many_short_messages_are_shared_out(spark, scorer, layout, new_dir):
    """Rows that take next to no bytes: no task gets all of them, and copies of long texts none either."""
    date = F.lit("Mon Apr 06 22:19:45 PDT 2009")
    n = 4 * tables.MAX_FILE_ROWS + 1
    messages = spark.range(0, n, 1, 1).select(
        date.alias("date"), F.lit("positive").alias("sentiment"), F.lit("@a the").alias("text"), F.lit("u").alias("user")
    )
    source = new_dir("landing")
    messages.write.json(source)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    stages.run_stages(spark, source, layout, scorer)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    for layer in ("silver", "gold"):
        table = read_layer(spark, layout, layer)
        per_file = table.groupBy(F.col("_metadata.file_path")).count().collect()
        assert len(per_file) > 1 and max(r["count"] for r in per_file) <= tables.MAX_FILE_ROWS
        assert sum(r["count"] for r in per_file) == n
    assert all(name.endswith(".zstd.parquet") for name in map(str, [r[0] for r in per_file]))
