"""Raw to bronze, bronze to silver, silver to gold.

The same functions serve batch frames and streams.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tweetflow.functions.labels import sentiment_id
from tweetflow.functions.scorers import Scorer
from tweetflow.functions.text import (
    has_mention,
    has_text_beyond_mentions,
    mentions,
    not_blank,
    tweet_timestamp,
    without_mentions,
)
from tweetflow.schemas import BRONZE, GOLD, RAW, SILVER, enforce


def to_bronze(raw: DataFrame) -> DataFrame:
    """Add provenance to rows of a file source; extra columns are kept."""
    stamped = raw.withColumns(
        {
            "source_file": F.col("_metadata.file_path"),
            "processing_time": F.current_timestamp(),
        }
    )
    return enforce(stamped, BRONZE)


def _addressed(bronze: DataFrame) -> DataFrame:
    """Messages with a mention and other text, cleaned once each.

    Both tests stop at the first match, so a message that is dropped costs
    neither a date nor a cleaned copy.
    """
    return (
        enforce(bronze, RAW)
        .filter(has_text_beyond_mentions("text") & has_mention("text"))
        .select(
            tweet_timestamp("date").alias("timestamp"),
            "text",
            without_mentions("text").alias("cleaned_text"),
            "sentiment",
        )
    )


def _per_mention(messages: DataFrame, *columns: str) -> DataFrame:
    """Repeat every message for its mentions, in order, duplicates kept."""
    # The array stays inside the explode: from a column of its own Spark would
    # derive a filter and extract the mentions twice.
    mention = F.explode(mentions("text")).alias("mention")
    return messages.select("timestamp", mention, "cleaned_text", "sentiment", *columns)


def to_silver(bronze: DataFrame) -> DataFrame:
    """One row per mention; messages without mention or other text vanish."""
    return _per_mention(_addressed(bronze))


def to_gold(silver: DataFrame, scorer: Scorer) -> DataFrame:
    """Score every silver row and flag its given sentiment."""
    return _with_prediction(silver.filter(not_blank("cleaned_text")), scorer).select(
        *GOLD.fieldNames()
    )


def bronze_to_gold(bronze: DataFrame, scorer: Scorer) -> DataFrame:
    """Same rows as ``to_gold(to_silver(bronze))`` for runs that need no silver
    table. A message is scored once, before it is repeated for its mentions."""
    predictions = [c for c in GOLD.fieldNames() if c not in SILVER.fieldNames()]
    return _per_mention(_with_prediction(_addressed(bronze), scorer), *predictions)


def _with_prediction(df: DataFrame, scorer: Scorer) -> DataFrame:
    return scorer(df, "cleaned_text", "prediction").withColumns(
        {
            "predicted_sentiment": F.col("prediction.label"),
            "predicted_score": F.col("prediction.score"),
            "predicted_sentiment_id": F.col("prediction.binary"),
            "sentiment_id": sentiment_id("sentiment"),
        }
    )
