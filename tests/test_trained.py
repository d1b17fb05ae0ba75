"""The trained scorer learns, is saved with its version, and runs in the JVM."""

import random

import pytest
from compare import multiset
from pyspark.sql import functions as F

from tweetflow.functions import trained
from tweetflow.functions.labels import LABELS
from tweetflow.operators.layers import to_gold
from tweetflow.plans import feed, reports
from tweetflow.sources import tables
from tweetflow.sources.tables import read_layer
from tweetflow.streaming import stages

SAMPLE = "cleaned_text string, sentiment string"
WORDS = {"positive": "good fine nice", "Negative": "bad awful sad", "neutral": "table chair door"}


def rows(n, seed):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        given = rng.choice(list(WORDS))
        words = [rng.choice(WORDS[given].split()) for _ in range(3)] + [rng.choice("the a of and".split()) for _ in range(3)]
        rng.shuffle(words)
        out.append((" ".join(words), given))
    return out


@pytest.fixture(scope="module")
def scorer(spark):
    sample = [*rows(300, 1), (None, "positive"), ("no label", None), ("other label", "mixed")]
    return trained.train(spark.createDataFrame(sample, SAMPLE), n_features=1 << 10, version="v7")


def predictions(spark, scorer, sample):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(sample)], f"i int, {SAMPLE}")
    return {r.i: r.p for r in scorer(df, "cleaned_text", "p").collect()}


def test_held_out_accuracy(spark, scorer):
    sample = rows(200, 2)
    got = predictions(spark, scorer, sample)
    wanted = {"positive": "POS", "Negative": "NEG", "neutral": "NEU"}
    assert sum(got[i].label == wanted[given] for i, (_, given) in enumerate(sample)) >= 190
    assert all(got[i].binary == (got[i].label == "POS") for i, (_, given) in enumerate(sample) if given != "neutral")
    assert all(1 / 3 <= p.score <= 1 for p in got.values())


def test_odd_texts_have_a_score(spark, scorer):
    got = predictions(spark, scorer, [(t, None) for t in (None, "", "123 !!", "good " * 50_000, "日本語")])
    assert all(p.label in LABELS and p.binary in (0, 1) for p in got.values())
    assert got[0] == got[1] == got[2] and got[3].label == "POS"


def test_saved_and_loaded(spark, scorer, new_dir):
    path = new_dir("models") + "/v7"
    scorer.save(path)
    loaded = trained.load_scorer(path)
    sample = rows(50, 3)
    assert loaded.version == "v7"
    assert predictions(spark, loaded, sample) == predictions(spark, scorer, sample)
    with pytest.raises(Exception, match="exist"):
        scorer.save(path)


def test_every_label_has_to_occur(spark):
    sample = [r for r in rows(50, 4) if r[1] != "neutral"]
    with pytest.raises(ValueError, match="NEU"):
        trained.train(spark.createDataFrame(sample, SAMPLE))


def test_no_python_worker_and_no_column_left(spark, scorer):
    df = spark.createDataFrame(rows(5, 5), SAMPLE)
    out = scorer(df, "cleaned_text", "p")
    assert out.columns == ["cleaned_text", "sentiment", "p"]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_gold_stream_with_a_trained_scorer(spark, sf_dir, scorer, new_dir, layout):
    source = new_dir("landing")
    feed.event_messages(spark, sf_dir).write.json(source)
    stages.run_stages(spark, source, layout, scorer)
    streamed = read_layer(spark, layout, "gold")
    batch = to_gold(read_layer(spark, layout, "silver"), scorer)
    assert multiset(streamed.drop("predicted_score")) == multiset(batch.drop("predicted_score"))
    reports.log_evaluation(spark, layout, "trained", "words and pairs", {"model_version": scorer.version})
    assert tables.read_runs(spark, layout.runs).first().params["model_version"] == "v7"


def test_training_reads_its_rows_once(spark):
    sample = [(i, *r) for i, r in enumerate(rows(120, 6))]
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(text):
        read.add(1)
        return text

    df = spark.createDataFrame(sample, f"i int, {SAMPLE}").withColumn("cleaned_text", seen("cleaned_text"))
    trained.train(df, n_features=1 << 8, iterations=3)
    assert read.value == len(sample)


def test_a_repeated_row_weighs_as_often_as_it_occurs(spark):
    sample = rows(150, 7)
    repeated = [*sample, *sample, *sample]
    one = trained.train(spark.createDataFrame(sample, SAMPLE), n_features=1 << 8)
    three = trained.train(spark.createDataFrame(repeated, SAMPLE), n_features=1 << 8)
    others = rows(60, 8)
    got, wanted = (predictions(spark, scorer, others) for scorer in (three, one))
    assert [p.label for p in got.values()] == [p.label for p in wanted.values()]
    assert all(abs(got[i].score - wanted[i].score) < 0.05 for i in got)
