"""JSON landing files and layer tables."""

import os
import shutil

import pytest
from compare import multiset
from pyspark.sql import functions as F

from tweetflow.operators.evaluation import confusion_matrix, eval_summary, metrics_table
from tweetflow.plans import feed, reports
from tweetflow.schemas import LAYERS, RAW, SILVER, T
from tweetflow.session import shared_dir
from tweetflow.sources import files, landing, tables
from tweetflow.sources.tables import Layout
from tweetflow.streaming import stages


def write_lines(spark, path, *lines):
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.mode(
        "append"
    ).text(path)


def raw_rows(spark, *texts):
    return spark.createDataFrame([("d", "s", t, "u") for t in texts], RAW)


def test_malformed_line(spark, new_dir):
    path = new_dir("bad")
    write_lines(spark, path, '{"text":"t","date":"d"}', "{bad")
    nulls = (None, None, None, None)
    assert multiset(landing.read_batch(spark, path)) == sorted(
        [("d", None, "t", None), nulls], key=repr
    )
    kept = landing.read_batch(spark, path, corrupt_column="_corrupt_record")
    assert {tuple(r) for r in kept.collect()} == {
        ("d", None, "t", None, None), (*nulls, "{bad"),
    }


def test_extra_field_is_ignored_until_declared(spark, new_dir):
    path = new_dir("extra")
    write_lines(spark, path, '{"text":"t","lang":"en"}')
    assert landing.read_batch(spark, path).columns == RAW.fieldNames()
    wide = T.StructType(RAW.fields + [T.StructField("lang", T.StringType())])
    assert landing.read_batch(spark, path, wide).first()["lang"] == "en"
    assert landing.read_inferred(spark, path).columns == ["lang", "text"]


def test_json_round_trip_keeps_every_character(spark, new_dir, sf_dir):
    path = new_dir("roundtrip")
    messages = feed.messages(spark, sf_dir)
    messages.write.json(path)
    assert multiset(landing.read_batch(spark, path)) == multiset(messages)


def test_listing(spark, new_dir):
    path = new_dir("listing")
    for i in range(3):
        raw_rows(spark, f"t{i}").coalesce(1).write.mode("append").json(path)
    write_lines(spark, path, "not a json file")
    listed = landing.list_files(spark, path).collect()
    assert len(listed) == 3 and all(r.length > 0 for r in listed)
    assert landing.count_files(spark, path).first()[0] == 3
    assert tuple(files.file_sizes(spark, path, ".json").first()) == (
        3, sum(r.length for r in listed),
    )
    names = sorted(r.path.removeprefix("file:") for r in listed)
    for age, name in enumerate(names):
        os.utime(name, (1_700_000_000 - age, 1_700_000_000 - age))
    newest = [r.path.removeprefix("file:") for r in landing.newest_files(spark, path, 2).collect()]
    assert newest == names[:2]


def test_newest_files_breaks_ties_by_path(spark, new_dir):
    path = new_dir("ties")
    raw_rows(spark, *"abcd").repartition(4).write.json(path)
    names = [r.path for r in landing.list_files(spark, path).orderBy("path").collect()]
    for name in names:
        os.utime(name.removeprefix("file:"), (1_700_000_000, 1_700_000_000))
    assert [r.path for r in landing.newest_files(spark, path, 2).collect()] == names[:2]


def test_replay(spark, new_dir):
    source, target = new_dir("source"), new_dir("target")
    assert landing.replay_newest(spark, source, target) == 0
    write_lines(spark, source, "no json here")
    assert landing.replay_newest(spark, source, target) == 0
    assert not files.exists(spark, target)
    for i in range(4):
        raw_rows(spark, f"t{i}").coalesce(1).write.mode("append").json(source)
    assert landing.replay_newest(spark, source, target, 50) == 4
    assert landing.replay_newest(spark, source, target, 2) == 2
    texts = sorted(r.text for r in landing.read_batch(spark, target).collect())
    assert len(texts) == 6 and set(texts) == {"t0", "t1", "t2", "t3"}


def test_one_bound_per_stream(spark, new_dir):
    with pytest.raises(ValueError):
        landing.read_stream(spark, new_dir("x"), max_bytes=1, max_files=1)


class FakeSession:
    def __init__(self, **conf):
        self.conf = {key.replace("_", "."): value for key, value in conf.items()}


def test_shared_dir_is_the_one_the_session_names():
    session = FakeSession(spark_checkpoint_dir="hdfs://n/ck/", spark_master="yarn")
    first, second = shared_dir(session, "a"), shared_dir(session, "a")
    assert first.startswith("hdfs://n/ck/tweetflow/a-") and first != second


def test_only_a_local_session_may_lack_a_shared_dir():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(FakeSession(spark_master="yarn"), "a")
    assert "/tweetflow/a-" in shared_dir(FakeSession(spark_master="local[2]"), "a")


def test_layout_refuses_unknown_layers():
    with pytest.raises(ValueError):
        Layout("/tmp/x").table("bronz")


@pytest.fixture
def filled(spark, new_dir, layout, scorer):
    """All three tables in many small files, and how many batches it took."""
    source = new_dir("landing")
    for i in range(3):
        raw_rows(spark, *[f"@m{j} text {i}" for j in range(8)]).repartition(4).write.mode(
            "append"
        ).json(source)
    stages.start_bronze(spark, source, layout, max_files=4).awaitTermination()
    stages.start_silver(spark, layout).awaitTermination()
    stages.start_gold(spark, layout, scorer).awaitTermination()
    return layout


def test_version_is_the_last_batch(spark, filled):
    assert tables.table_version(spark, filled.table("bronze")) == 2
    assert tables.table_version(spark, filled.table("silver")) == 0
    assert tables.table_version(spark, "/tmp/no/such/table") is None


def test_missing_table_reads_as_empty(spark, layout):
    empty = tables.read_layer(spark, layout, "silver")
    assert empty.schema == SILVER and empty.isEmpty()


def sizes(spark, path):
    return files.file_sizes(spark, path, ".parquet").first()


def test_compaction_keeps_rows_and_reduces_files(spark, filled, new_dir):
    table, snapshot = filled.table("bronze"), f"{new_dir('compact')}/bronze"
    before = tables.read_layer(spark, filled, "bronze")
    assert tables.compact(spark, table, snapshot) == snapshot
    assert multiset(spark.read.parquet(snapshot)) == multiset(before)
    assert sizes(spark, table).n_files == 12
    assert sizes(spark, snapshot).n_files == 1
    assert tables.table_version(spark, table) == 2, "the live table is not touched"


def test_compaction_splits_at_the_target(spark, filled, new_dir):
    table, snapshot = filled.table("silver"), f"{new_dir('compact')}/silver"
    target = sizes(spark, table).n_bytes // 3 + 1
    tables.compact(spark, table, snapshot, target)
    assert 3 <= sizes(spark, snapshot).n_files <= 5
    assert spark.conf.get("spark.sql.files.openCostInBytes") != "0"


def test_only_committed_files_are_listed(spark, filled):
    table = filled.table("silver")
    before = sizes(spark, table)
    spark.range(5).selectExpr("string(id) mention").write.mode("append").parquet(
        f"{filled.base}/stray"
    )
    stray = spark.read.format("binaryFile").load(f"{filled.base}/stray").first().path
    shutil.copy(stray.removeprefix("file:"), f"{table.removeprefix('file:')}/part-stray.parquet")
    assert sizes(spark, table) == before
    assert tables.read_layer(spark, filled, "silver").count() == 24


def test_listing_tasks_do_not_grow_with_the_bytes(spark, new_dir):
    path, cores = new_dir("many"), spark.sparkContext.defaultParallelism
    raw_rows(spark, *[f"text {i}" for i in range(100)]).repartition(100).write.json(path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50")  # a task per file and more
    try:
        assert landing.read_batch(spark, path).rdd.getNumPartitions() >= 100
        assert landing.list_files(spark, path).rdd.getNumPartitions() <= 2 * cores + 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_compaction_without_a_table(spark, layout, new_dir):
    assert tables.compact(spark, layout.table("gold"), new_dir("none")) is None


def test_arrivals_are_archived_and_none_is_lost(spark, new_dir, layout):
    """Ten arrivals, some with old times or names used before; the directory stays as it is."""
    inbox, source, archive = new_dir("inbox"), new_dir("landing"), new_dir("archive")
    fs = spark._jvm.org.apache.hadoop.fs.FileSystem.get(spark._jsc.hadoopConfiguration())
    path = spark._jvm.org.apache.hadoop.fs.Path
    spark.conf.set("spark.sql.streaming.fileSource.cleaner.numThreads", "0")
    try:
        for number in range(10):
            spark.createDataFrame([(None, None, f"text {number}", "u")], RAW).coalesce(1).write.json(f"{inbox}/{number}")
            (name,) = [n for n in files.child_names(spark, f"{inbox}/{number}") if n.endswith(".json")]
            fs.rename(path(f"{inbox}/{number}/{name}"), path(f"{inbox}/same.json"))
            if number % 3 == 2:
                fs.setTimes(path(f"{inbox}/same.json"), 10**12, -1)  # 2001
            assert landing.hand_on(spark, inbox, source) == 1 and landing.hand_on(spark, inbox, source) == 0
            stages.start_bronze(spark, source, layout, archive=archive).awaitTermination()
            assert len(files.child_names(spark, source)) == 1
            assert tables.read_layer(spark, layout, "bronze").count() == number + 1
    finally:
        spark.conf.unset("spark.sql.streaming.fileSource.cleaner.numThreads")
    assert {r.text for r in tables.read_layer(spark, layout, "bronze").collect()} == {f"text {i}" for i in range(10)}
    archived = spark.read.option("recursiveFileLookup", "true").schema(RAW).json(archive)
    assert archived.count() == 9


def test_reset_drops_tables_and_checkpoints(spark, filled):
    other = f"{filled.base}/notes"
    spark.range(1).write.parquet(other)
    assert tables.reset(spark, filled)
    for layer in ("bronze", "silver", "gold"):
        assert not files.exists(spark, filled.table(layer))
        assert not files.exists(spark, filled.checkpoint(layer))
        assert not files.exists(spark, filled.schemas(layer))
    assert files.exists(spark, other)
    assert not tables.reset(spark, filled)


def test_run_log(spark, filled):
    gold = tables.read_layer(spark, filled, "gold")
    for name, batch_size in (("first", 32), ("second", 64)):
        reports.log_evaluation(spark, filled, name, "lexicon", {"batch_size": batch_size, "m": None})
    runs = tables.read_runs(spark, filled.runs).orderBy("ts").collect()
    assert [r.run_name for r in runs] == ["first", "second"]
    assert runs[1].params == {
        "model_name": "lexicon",
        "spark_version": spark.version,
        "silver_table_version": "0",
        "gold_table_version": "0",
        "batch_size": "64",
        "m": "None",
    }
    confusion = confusion_matrix(gold)
    expected = eval_summary(confusion).first().asDict()
    expected |= {f"n_{a}_{p}": n for a, p, n in confusion.collect()}
    assert runs[0].metrics == pytest.approx(expected) and len(expected) == 9
    assert runs[0].ts is not None


def test_reports_over_the_tables(spark, filled):
    bronze, gold = (tables.read_layer(spark, filled, layer) for layer in ("bronze", "gold"))
    report = reports.layer_report(spark, filled)
    assert multiset(report.select("layer", "n_rows").distinct()) == [
        ("bronze", 24), ("gold", 24), ("silver", 24),
    ]
    for layer, schema in LAYERS.items():
        rows = report.filter(F.col("layer") == layer).orderBy("position").collect()
        assert [(r.column_name, r.type) for r in rows] == [(f.name, f.dataType.simpleString()) for f in schema]
    quality = reports.quality_report(bronze, 5)
    assert quality["summary"].first().n_tweets == 24
    assert [tuple(r) for r in quality["top_users"].collect()] == [("u", 24)]
    mentioned = reports.mention_report(gold, 3)
    assert mentioned["mentions"].count() == 8
    assert mentioned["total_mentions"].first()[0] == 24
    assert [tuple(r) for r in mentioned["top_total"].collect()] == [
        ("@m0", 3), ("@m1", 3), ("@m2", 3),
    ]
    evaluated = reports.evaluation_report(gold)
    assert evaluated["confusion"].count() == 4 and evaluated["classes"].count() == 2
    assert all(not df.isEmpty() for report in (quality, mentioned, evaluated) for df in report.values())


def test_evaluation_scans_the_predictions_once(spark, filled):
    metrics = metrics_table(confusion_matrix(tables.read_layer(spark, filled, "gold")))
    metrics.collect()
    plan = metrics._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.index("Initial Plan")]
    assert final.count("FileScan") == 1 and "Reused" in final


def test_landing_files_are_compressed_and_bounded(spark, new_dir, monkeypatch):
    monkeypatch.setitem(landing.LANDED, "maxRecordsPerFile", "100")
    source, target = new_dir("landing"), new_dir("replay")
    rows = [("d", "positive", f"@a text {i} " + "word " * 200, "u") for i in range(300)]
    spark.createDataFrame(rows, RAW).coalesce(1).write.options(**landing.LANDED).json(source)
    assert landing.count_files(spark, source).first().n_files == 3
    assert landing.replay_newest(spark, source, target, 3) == 3
    assert multiset(landing.read_batch(spark, target)) == multiset(landing.read_batch(spark, source))
    sizes = [r.length for r in landing.list_files(spark, target).collect()]
    assert len(sizes) == 3 and sum(sizes) < 100_000
