import itertools

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tweetflow.functions.labels import (
    SCORES_TYPE,
    apply_label_rule,
    label_from_votes,
    sentiment_id,
)


def label(spark, *scores):
    schema = T.StructType([T.StructField("s", SCORES_TYPE)])
    df = spark.createDataFrame([(list(scores),)], schema)
    return tuple(apply_label_rule(df, "s", "out").first()["out"])


@pytest.mark.parametrize(
    "scores, expected",
    [
        ([("POS", 0.5), ("NEU", 0.3), ("NEG", 0.2)], ("POS", 0.5, 1)),
        ([("POS", 0.2), ("NEU", 0.3), ("NEG", 0.5)], ("NEG", 0.5, 0)),
        ([("NEU", 0.5), ("POS", 0.3), ("NEG", 0.2)], ("NEU", 0.5, 1)),
        ([("NEU", 0.5), ("NEG", 0.3), ("POS", 0.2)], ("NEU", 0.5, 0)),
        ([("X", 0.6), ("POS", 0.3), ("NEG", 0.1)], ("X", 0.6, 0)),
        ([("NEU", 1.0)], ("NEU", 1.0, 0)),
        # Equal scores keep the order the model gave them.
        ([("NEG", 0.4), ("POS", 0.4), ("NEU", 0.2)], ("NEG", 0.4, 0)),
        ([("POS", 0.4), ("NEG", 0.4), ("NEU", 0.2)], ("POS", 0.4, 1)),
        ([("NEU", 0.4), ("NEG", 0.3), ("POS", 0.3)], ("NEU", 0.4, 0)),
        ([("NEU", 0.4), ("POS", 0.3), ("NEG", 0.3)], ("NEU", 0.4, 1)),
    ],
)
def test_label_rule(spark, scores, expected):
    assert label(spark, *scores) == expected


def test_vote_form_equals_the_rule(spark):
    votes = spark.createDataFrame(
        list(itertools.product(range(5), range(1, 4), range(5))), "neg int, neu int, pos int"
    )
    total = F.col("neg") + F.col("neu") + F.col("pos")
    scores = F.array(
        *[
            F.struct(F.lit(c.upper()).alias("label"), (F.col(c).cast("double") / total).alias("score"))
            for c in ("neg", "neu", "pos")
        ]
    )
    written_out = label_from_votes(F.col("neg"), F.col("neu"), F.col("pos"))
    both = apply_label_rule(votes.withColumns({"s": scores, "w": written_out}), "s", "r")
    assert both.filter("w != r").count() == 0
    assert both.count() == 75


def test_sentiment_id(spark):
    given = ["positive", "Positive", "POSITIVE", " positive", "neutral", "negative", "", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(given)], "i int, v string")
    ids = [r[0] for r in df.orderBy("i").select(sentiment_id("v")).collect()]
    assert ids == [1, 1, 1, 0, 0, 0, 0, 0]
