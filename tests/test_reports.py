"""Mention, quality and evaluation reports on small frames."""

import random
from collections import Counter

import pytest
from compare import multiset
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tweetflow.operators import evaluation, mentions, quality
from tweetflow.schemas import BRONZE, GOLD, RAW

RELAXED = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def gold(spark, rows):
    """``(mention, label)`` pairs as a gold table."""
    return spark.createDataFrame(
        [(None, m, "x", None, label, 0.5, 0, 0) for m, label in rows], GOLD
    )


def test_app_table_counts_every_row_once(spark):
    rows = [("@a", "POS")] * 3 + [("@a", "NEG")] + [("@b", "NEU")] * 2 + [(None, "POS")]
    table = mentions.mention_app_table(gold(spark, rows)).drop("min_timestamp", "max_timestamp")
    assert multiset(table) == [("@a", 1, 0, 3, 4), ("@b", 0, 2, 0, 2)]


def test_absent_label_is_a_column_of_zeros(spark):
    pivot = mentions.mention_pivot(gold(spark, [("@a", "POS")]))
    assert pivot.columns == ["mention", "NEG", "NEU", "POS", "other", "total"]
    assert multiset(pivot) == [("@a", 0, 0, 1, 0, 1)]


def test_top_mentions_breaks_ties_by_name(spark):
    rows = [(f"@m{i:02d}", "POS") for i in range(30)] + [("@z", "POS")] * 2
    top = mentions.top_mentions(mentions.mention_pivot(gold(spark, rows)), "POS", 3)
    assert [r.mention for r in top.collect()] == ["@z", "@m00", "@m01"]
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_a_mention_holding_most_rows(spark, scorer):
    """Skew: the map side reduces the hot mention to one row per task."""
    rows = [("@hot", random.Random(i).choice(["NEG", "NEU", "POS"])) for i in range(20000)]
    rows += [(f"@m{i}", "POS") for i in range(500)]
    got = {r.mention: r.total for r in mentions.mention_app_table(gold(spark, rows)).collect()}
    assert got == dict(Counter(m for m, _ in rows))
    assert mentions.mention_total(gold(spark, rows)).first()[0] == 20500


def bronze(spark):
    rows = [
        ("d", "positive", "@a hello", "u1"),
        ("", None, "@a @b", "u1"),
        (None, "", None, ""),
        ("d", "x", "", "u2"),
        ("d", "x", "a @ b", "u2"),
        ("d", "x", "plain", "u2"),
    ]
    return spark.createDataFrame(rows, RAW)


def test_quality_reports(spark):
    df = bronze(spark)
    assert multiset(quality.null_profile(df)) == [
        ("date", 2), ("sentiment", 2), ("text", 2), ("user", 1),
    ]
    assert [tuple(r) for r in quality.tweets_per_user(df).collect()] == [
        ("u2", 3), ("u1", 2), ("", 1),
    ]
    assert [tuple(r) for r in quality.top_users(df, 1).collect()] == [("u2", 3)]
    assert [tuple(r) for r in quality.mention_presence(df).collect()] == [(0, 3), (1, 3)]
    assert quality.only_mention_count(df).first()[0] == 2
    assert [tuple(r) for r in quality.length_distribution(df).collect()] == [
        (None, 1), (0, 2), (5, 3),
    ]
    assert tuple(quality.quality_summary(df).first()) == (6, 2, 2, 2, 1, 3, 2)
    counts = quality.layer_counts({"one": df, "none": df.limit(0)})
    assert multiset(counts) == [("none", 0), ("one", 6)]


def test_null_profile_handles_other_types(spark):
    df = spark.createDataFrame([("d", None, None, None, None, None)], BRONZE)
    profile = dict(tuple(r) for r in quality.null_profile(df).collect())
    assert profile["processing_time"] == 1 and profile["date"] == 0


def pairs_frame(spark, pairs):
    return spark.createDataFrame(pairs, "sentiment_id int, predicted_sentiment_id int")


def plain_metrics(pairs):
    n = len(pairs)
    report = {}
    for c in (0, 1):
        hits = sum(a == p == c for a, p in pairs)
        support = sum(a == c for a, _ in pairs)
        predicted = sum(p == c for _, p in pairs)
        prec = hits / predicted if predicted else 0.0
        rec = hits / support if support else 0.0
        f1 = 2 * prec * rec / (prec + rec) if prec + rec else 0.0
        report[c] = (prec, rec, f1, support)
    weighted = [sum(r[i] * r[3] for r in report.values()) / n for i in range(3)]
    return report, [sum(a == p for a, p in pairs) / n, *weighted]


@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 1)), min_size=1, max_size=80))
@RELAXED
def test_metrics_agree_with_plain_python(spark, pairs):
    confusion = evaluation.confusion_matrix(pairs_frame(spark, pairs))
    cells = {(a, p): n for a, p, n in confusion.collect()}
    assert cells == {(a, p): Counter(pairs)[(a, p)] for a in (0, 1) for p in (0, 1)}
    report, summary = plain_metrics(pairs)
    for r in evaluation.class_report(confusion).collect():
        assert (r.prec, r.rec, r.f1, r.support) == pytest.approx(report[r.label])
    got = evaluation.eval_summary(confusion).first()
    assert list(got)[:4] == pytest.approx(summary)
    assert got.n_rows == len(pairs)


def test_class_nobody_predicted(spark):
    confusion = evaluation.confusion_matrix(pairs_frame(spark, [(0, 0), (1, 0)]))
    by_label = {r.label: r for r in evaluation.class_report(confusion).collect()}
    assert (by_label[1].prec, by_label[1].rec, by_label[1].f1) == (0.0, 0.0, 0.0)
    assert by_label[1].support == 1


def test_empty_evaluation(spark):
    confusion = evaluation.confusion_matrix(pairs_frame(spark, []))
    assert [r.n for r in confusion.collect()] == [0, 0, 0, 0]
    assert tuple(evaluation.eval_summary(confusion).first()) == (0.0, 0.0, 0.0, 0.0, 0)


def test_weighted_metrics_agree_with_spark_ml(spark):
    ml = pytest.importorskip("pyspark.ml.evaluation")
    rng = random.Random(7)
    pairs = [(rng.randint(0, 1), rng.randint(0, 1)) for _ in range(500)]
    df = pairs_frame(spark, pairs)
    ours = evaluation.eval_summary(evaluation.confusion_matrix(df)).first()
    doubles = df.selectExpr(
        "double(sentiment_id) label", "double(predicted_sentiment_id) prediction"
    )
    names = {
        "accuracy": "accuracy",
        "weighted_precision": "weightedPrecision",
        "weighted_recall": "weightedRecall",
        "weighted_f1": "f1",
    }
    for column, metric in names.items():
        evaluator = ml.MulticlassClassificationEvaluator(metricName=metric)
        assert ours[column] == pytest.approx(evaluator.evaluate(doubles), abs=1e-12)


def test_undeclared_labels_are_in_the_totals(spark):
    rows = gold(spark, [("@a", "POS"), ("@a", "X"), ("@a", None), ("@b", "X")])
    pivot = {r.mention: (r.POS, r.other, r.total) for r in mentions.mention_pivot(rows).collect()}
    assert pivot == {"@a": (1, 2, 3), "@b": (0, 1, 1)}


def test_other_and_null_ids_are_in_the_evaluation(spark):
    pairs = [(0, 0), (1, None), (2, 1), (1, 1)]
    df = spark.createDataFrame(pairs, "sentiment_id int, predicted_sentiment_id int")
    confusion = evaluation.confusion_matrix(df)
    cells = {(r[0], r[1]): r[2] for r in confusion.collect()}
    assert cells == {(0, 0): 1, (0, 1): 0, (1, 0): 0, (1, 1): 1, (1, None): 1, (2, 1): 1}
    summary = evaluation.eval_summary(confusion).first()
    assert (summary.accuracy, summary.n_rows) == (0.5, 4)
