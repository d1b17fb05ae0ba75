"""From class scores to a label, a score and a binary flag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tweetflow.functions.text import as_column

# The label names of the three classes.
NEG, NEU, POS = "NEG", "NEU", "POS"
LABELS = (NEG, NEU, POS)

#: The scores of all labels for one text.
SCORES_TYPE = T.ArrayType(
    T.StructType([T.StructField("label", T.StringType()), T.StructField("score", T.DoubleType())])
)


def apply_label_rule(df: DataFrame, scores: str, out: str) -> DataFrame:
    """Replace the array column ``scores`` by ``out``, a struct of the label and
    score that rank first and the binary flag that follows from them.

    Ranking is by score, highest first; equal scores keep their array order.
    The flag is 1 for a positive label, 0 for a negative or unknown one; a
    neutral label takes it from the runner-up.
    """
    ranked = f"__ranked_{out}"
    # Ranked once in a projection of its own; inlined it would be sorted again
    # for each of the fields read from it.
    by_score = F.sort_array(
        F.transform(
            scores,
            lambda s, i: F.struct(
                (-s["score"]).alias("descending"), i.alias("position"), s["label"].alias("label")
            ),
        )
    )
    first, second = F.get(ranked, 0), F.get(ranked, 1)
    neutral_but_positive = (first["label"] == NEU) & (second["label"] == POS)
    flag = F.when((first["label"] == POS) | neutral_but_positive, 1).otherwise(0)
    return (
        df.withColumn(ranked, by_score)
        .withColumn(
            out,
            F.struct(
                first["label"].alias("label"),
                (-first["descending"]).alias("score"),
                flag.alias("binary"),
            ),
        )
        .drop(scores, ranked)
    )


def label_from_votes(negative: Column, neutral: Column, positive: Column) -> Column:
    """The same rule for votes listed in the order NEG, NEU, POS, written out:
    no array is built or sorted. The score is the share of the votes."""
    is_negative = (negative >= neutral) & (negative >= positive)
    is_neutral = neutral >= positive
    votes = negative + neutral + positive
    return F.struct(
        F.when(is_negative, NEG).when(is_neutral, NEU).otherwise(POS).alias("label"),
        (F.greatest(negative, neutral, positive).cast("double") / votes).alias("score"),
        F.when(is_negative, 0)
        .when(is_neutral, (positive > negative).cast("int"))
        .otherwise(1)
        .alias("binary"),
    )


def sentiment_id(sentiment: Column | str) -> Column:
    """1 for a positive given sentiment, 0 for anything else, null included."""
    return F.when(F.lower(as_column(sentiment)) == "positive", 1).otherwise(0)
