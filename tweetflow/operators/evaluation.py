"""Classifier evaluation without collecting predictions.

The gold table is reduced to one row of k x k counts by a map-side aggregate;
every metric is then computed from those counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CLASSES = (0, 1)


def confusion_matrix(
    df: DataFrame,
    actual: str = "sentiment_id",
    predicted: str = "predicted_sentiment_id",
    classes: Sequence[int] = CLASSES,
) -> DataFrame:
    """``(sentiment_id, predicted_sentiment_id, n)``: every row of ``df`` counts once.

    All pairs of ``classes`` are there, those that never occur with 0; pairs
    with another id, or with none, are there if they occur. Reduced within each
    task to a row per pair before anything is shuffled.
    """
    counted = df.groupBy(
        F.col(actual).cast("int").alias("sentiment_id"),
        F.col(predicted).cast("int").alias("predicted_sentiment_id"),
    ).agg(F.count("*").alias("n"))
    cells = df.sparkSession.createDataFrame([(a, p, 0) for a in classes for p in classes], counted.schema)
    return (
        counted.unionAll(cells)
        .groupBy("sentiment_id", "predicted_sentiment_id")
        .agg(F.sum("n").alias("n"))
    )


def _class_counts(confusion: DataFrame) -> DataFrame:
    """Per class: hits, rows that are of it and rows predicted to be of it.

    Ids outside the declared classes, null included, are classes of their own;
    a null id never hits.
    """
    hit = F.when(F.col("sentiment_id") == F.col("predicted_sentiment_id"), F.col("n")).otherwise(0)
    # Each cell counts once for its actual and once for its predicted class.
    as_actual = F.struct(
        F.col("sentiment_id").alias("label"),
        hit.alias("hits"),
        F.col("n").alias("support"),
        F.lit(0).cast("long").alias("predicted"),
    )
    as_predicted = F.struct(
        F.col("predicted_sentiment_id").alias("label"),
        F.lit(0).cast("long").alias("hits"),
        F.lit(0).cast("long").alias("support"),
        F.col("n").alias("predicted"),
    )
    return (
        confusion.select(F.inline(F.array(as_actual, as_predicted)))
        .groupBy("label")
        .agg(
            F.sum("hits").alias("hits"),
            F.sum("support").alias("support"),
            F.sum("predicted").alias("predicted"),
        )
    )


def _ratio(numerator: Column, denominator: Column) -> Column:
    """0 where nothing can be divided."""
    return F.when(denominator > 0, numerator.cast("double") / denominator).otherwise(F.lit(0.0))


def _class_metrics(confusion: DataFrame) -> DataFrame:
    hits = F.col("hits")
    return (
        _class_counts(confusion)
        .withColumns(
            {
                "prec": _ratio(hits, F.col("predicted")),
                "rec": _ratio(hits, F.col("support")),
                "f1": _ratio(2 * hits, F.col("predicted") + F.col("support")),
            }
        )
    )


def class_report(confusion: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support of every class."""
    return _class_metrics(confusion).select("label", "prec", "rec", "f1", "support")


def eval_summary(confusion: DataFrame) -> DataFrame:
    """Accuracy and the averages of the class metrics weighted by support."""
    total = F.sum("support")

    def weighted(metric: str) -> Column:
        return _ratio(F.sum(F.col(metric) * F.col("support")), total)

    return _class_metrics(confusion).agg(
        _ratio(F.sum("hits"), total).alias("accuracy"),
        weighted("prec").alias("weighted_precision"),
        weighted("rec").alias("weighted_recall"),
        weighted("f1").alias("weighted_f1"),
        total.alias("n_rows"),
    )


def metrics_table(confusion: DataFrame) -> DataFrame:
    """``(metric, value)``: the summary and the cells ``n_<actual>_<predicted>``.

    Both halves start from the same counts, whose exchange Spark reuses: the
    predictions are scanned once.
    """
    summary = eval_summary(confusion)
    # unpivot wants one type.
    summary = summary.select(*[F.col(c).cast("double").alias(c) for c in summary.columns])
    cells = confusion.select(
        F.concat_ws(
            "_",
            F.lit("n"),
            *(F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in confusion.columns[:2]),
        ).alias("metric"),
        F.col("n").cast("double").alias("value"),
    )
    return summary.unpivot([], summary.columns, "metric", "value").union(cells)
