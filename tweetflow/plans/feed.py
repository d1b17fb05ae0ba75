"""Messages derived from the driver's tables.

The given tables hold no messages, so each row of ``events``, ``documents`` and
``conversations`` becomes one: all rows, whole texts, no join. The edge cases a
real feed has (bad dates, missing fields, nothing but mentions, non-ASCII
names) are placed by id, and every third event mentions ``@support``, so that
one mention holds a large share of all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tweetflow.functions.scorers import Lexicon

# The lexicon of the driver queries. The texts are invented
# words, so what recurs in them are function words and the event types.
LEXICON = Lexicon(
    positive=("the", "is", "le", "der", "purchase", "signup"),
    negative=("and", "of", "la", "die", "error"),
)

# First second of the documents and of the conversations.
DOCUMENTS_EPOCH = 1239056385
CONVERSATIONS_EPOCH = 1254000000


def _scan(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _feed_date(ts: str) -> str:
    return f"concat(date_format({ts}, 'EEE MMM dd HH:mm:ss'), ' PDT ', date_format({ts}, 'yyyy'))"


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short messages: who, what, and now and then a second and third mention."""
    body = (
        "concat(event_type, repeat(concat(' ', event_type), int(floor(value) % 4)), ' ', props)"
    )
    events = _scan(spark, sf_dir, "events")
    return events.selectExpr(
        f"CASE WHEN event_id % 79 = 0 THEN 'not a date' ELSE {_feed_date('ts')} END AS date",
        """CASE WHEN event_id % 89 = 0 THEN NULL
                WHEN event_type = 'purchase' THEN 'positive'
                WHEN event_type = 'signup' THEN 'Positive'
                WHEN event_type = 'error' THEN 'negative'
                ELSE 'neutral' END AS sentiment""",
        f"""CASE WHEN event_id % 97 = 0 THEN NULL
                 WHEN event_id % 101 = 0 THEN ''
                 WHEN event_id % 11 = 0 THEN concat('@user', user_id)
                 WHEN event_id % 5 = 0 THEN {body}
                 ELSE concat('@user', user_id, ' ', {body},
                             if(event_id % 3 = 0, ' @support', ''),
                             if(event_id % 13 = 0, ' @josé', '')) END AS text""",
        "if(event_id % 83 = 0, '', concat('user', user_id)) AS user",
    )


def document_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents, most of them addressed to their source."""
    documents = _scan(spark, sf_dir, "documents")
    return documents.selectExpr(
        f"{_feed_date(f'timestamp_seconds({DOCUMENTS_EPOCH} + doc_id * 61)')} AS date",
        """CASE lang WHEN 'en' THEN 'positive' WHEN 'de' THEN 'negative' WHEN 'fr' THEN 'neutral' END
           AS sentiment""",
        """CASE WHEN doc_id % 7 = 0 THEN text
                ELSE concat('@', source, ' ', text,
                            if(doc_id % 4 = 0, concat(' @', lang, ' @', source), '')) END
           AS text""",
        "source AS user",
    )


def conversation_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn, addressed to the other party."""
    turns = _scan(spark, sf_dir, "conversations")
    seconds = f"{CONVERSATIONS_EPOCH} + conv_id * 3600 + turn * 30"
    return turns.selectExpr(
        f"{_feed_date(f'timestamp_seconds({seconds})')} AS date",
        """CASE role WHEN 'user' THEN 'positive' WHEN 'assistant' THEN 'negative' ELSE 'neutral' END
           AS sentiment""",
        """CASE role WHEN 'user' THEN concat('@assistant ', text)
                     WHEN 'assistant' THEN concat('@user', conv_id, ' ', text)
                     ELSE text END AS text""",
        "concat(role, '_', conv_id) AS user",
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All messages, with the columns of ``schemas.RAW``."""
    return (
        event_messages(spark, sf_dir)
        .unionByName(document_messages(spark, sf_dir))
        .unionByName(conversation_messages(spark, sf_dir))
    )


def label_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class scores as a model may return them, one array per event: labels in
    changing order, equal scores, an unknown label, a single class."""

    def entries(*labels: str) -> str:
        # Quarters are exact in binary, so equal scores are really equal.
        score = {
            "POS": "double(floor(value) % 5) / 4",
            "NEG": "double(user_id % 5) / 4",
            "NEU": "double(event_id % 5) / 4",
        }
        score["X"] = score["NEU"]
        structs = (f"named_struct('label', '{l}', 'score', {score[l]})" for l in labels)
        return f"array({', '.join(structs)})"

    events = _scan(spark, sf_dir, "events")
    return events.selectExpr(
        "event_id",
        f"""CASE event_id % 6 WHEN 0 THEN {entries("NEG", "NEU", "POS")}
                              WHEN 1 THEN {entries("POS", "NEU", "NEG")}
                              WHEN 2 THEN {entries("NEU", "NEG", "POS")}
                              WHEN 3 THEN {entries("NEU", "POS", "NEG")}
                              WHEN 4 THEN {entries("X", "POS", "NEG")}
                              ELSE {entries("NEU")} END AS scores""",
    )


def progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A progress table with one micro-batch per event; idle ones report no time."""
    return _scan(spark, sf_dir, "events").selectExpr(
        "event_type AS query",
        "'r1' AS run_id",
        "event_id AS batch_id",
        "ts",
        "event_id % 50 AS input_rows",
        "CASE WHEN event_id % 50 <> 0 THEN bigint(floor(value * 10)) END AS processing_time",
        "0L AS memory_used",
    )


def progress_record() -> Column:
    """A row of ``progress`` as the record that a query would report."""
    return F.struct(
        F.col("query").alias("name"),
        F.col("run_id").alias("runId"),
        F.col("batch_id").alias("batchId"),
        F.col("ts").alias("timestamp"),
        F.col("input_rows").alias("numInputRows"),
        F.struct(F.col("processing_time").alias("addBatch")).alias("durationMs"),
    )
