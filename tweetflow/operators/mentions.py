"""Reports per mention over the gold table.

Counts per label are conditional counts in a single aggregate: one shuffle, of
at most one row per mention and map task, so a mention that fills a third of
the table costs no more than any other. (``pivot`` would shuffle twice.)
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tweetflow.functions.labels import LABELS, NEG, NEU, POS


def _count_of(label: str) -> Column:
    return F.count(F.when(F.col("predicted_sentiment") == label, 1))


def mention_app_table(gold: DataFrame) -> DataFrame:
    """First and last time seen and the number of rows per label and in all."""
    return (
        gold.filter(F.col("mention").isNotNull())
        .groupBy("mention")
        .agg(
            F.min("timestamp").alias("min_timestamp"),
            F.max("timestamp").alias("max_timestamp"),
            _count_of(NEG).alias("negative"),
            _count_of(NEU).alias("neutral"),
            _count_of(POS).alias("positive"),
            F.count("*").alias("total"),
        )
        .select(
            "min_timestamp", "max_timestamp", "mention", "negative", "neutral", "positive", "total"
        )
    )


def mention_pivot(gold: DataFrame, labels: Sequence[str] = LABELS) -> DataFrame:
    """Mention by label counts, one column per label, and the number of all rows.

    The labels are declared, so a label nobody received is a column of zeros;
    rows of any other label, or of none, are counted as ``other``.
    """
    declared = F.coalesce(F.col("predicted_sentiment").isin(*labels), F.lit(False))
    return (
        gold.filter(F.col("mention").isNotNull())
        .groupBy("mention")
        .agg(
            *[_count_of(label).alias(label) for label in labels],
            F.count(F.when(~declared, 1)).alias("other"),
            F.count("*").alias("total"),
        )
    )


def mention_total(gold: DataFrame) -> DataFrame:
    """How many mentions the table holds, repeated ones included."""
    return gold.filter(F.col("mention").isNotNull()).agg(F.count("*").alias("total_mentions"))


def rank_mentions(summary: DataFrame, by: str = "total") -> DataFrame:
    """The whole summary, most mentioned first; ties in order of the mention."""
    return summary.orderBy(F.desc(by), "mention")


def top_mentions(summary: DataFrame, by: str = "total", k: int = 20) -> DataFrame:
    """The first ``k`` of the ranking, without sorting the rest."""
    return rank_mentions(summary, by).limit(k)
