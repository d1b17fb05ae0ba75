from datetime import datetime

import pytest
from compare import multiset
from pyspark.sql import functions as F

from tweetflow.operators.layers import bronze_to_gold, to_bronze, to_gold, to_silver
from tweetflow.plans import feed
from tweetflow.schemas import BRONZE, GOLD, RAW, SILVER, SchemaMismatch, enforce

DATE = "Mon Apr 06 22:19:45 PDT 2009"


def raw(spark, *texts, sentiment="positive"):
    return spark.createDataFrame([(DATE, sentiment, t, "u1") for t in texts], RAW)


def test_silver_has_a_row_per_mention(spark):
    silver = to_silver(raw(spark, "@a hello @b", "@a @a hi"))
    assert silver.schema.fieldNames() == SILVER.fieldNames()
    rows = [(r.mention, r.cleaned_text) for r in silver.collect()]
    assert rows == [("@a", " hello "), ("@b", " hello "), ("@a", "  hi"), ("@a", "  hi")]


def test_silver_drops_messages_without_mention_or_text(spark):
    assert to_silver(raw(spark, "nope", "a @ b", "@a @a", "", None)).isEmpty()


def test_silver_keeps_rows_whose_date_cannot_be_read(spark):
    df = spark.createDataFrame([("not a date", None, "@a hi", None)], RAW)
    assert [tuple(r) for r in to_silver(df).collect()] == [(None, "@a", " hi", None)]


def test_newline_is_text(spark):
    assert to_silver(raw(spark, "@x\n")).count() == 1


def test_gold_columns_and_values(spark, scorer):
    gold = to_gold(to_silver(raw(spark, "@a the the", sentiment="Positive")), scorer)
    assert [(f.name, f.dataType) for f in gold.schema] == [(f.name, f.dataType) for f in GOLD]
    row = gold.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz")).first()
    assert tuple(row) == (
        datetime(2009, 4, 6, 22, 19, 45), "@a", " the the", "Positive", "POS", 2 / 3, 1, 1,
    )


def test_gold_skips_blank_text(spark, scorer):
    silver = spark.createDataFrame(
        [(None, "@a", t, None) for t in ("  ", "", None, "x")], SILVER
    )
    assert [r.cleaned_text for r in to_gold(silver, scorer).collect()] == ["x"]


def test_scoring_before_exploding_gives_the_same_rows(spark, scorer, sf_dir):
    messages = feed.messages(spark, sf_dir)
    layered = to_gold(to_silver(messages), scorer)
    assert multiset(bronze_to_gold(messages, scorer)) == multiset(layered)


def test_one_message_is_scored_once(spark, scorer):
    plan = bronze_to_gold(raw(spark, "@a x"), scorer)._jdf.queryExecution().optimizedPlan().toString()
    generate, lower = plan.index("Generate"), plan.index("lower(")
    assert plan.count("(?<!\\p{L})(?:(the") == 1
    assert generate < plan.index("(?<!\\p{L})(?:(the"), "the lexicon is searched below the explode"
    assert lower > 0


def test_bronze_provenance(spark, new_dir):
    path = new_dir("json")
    raw(spark, "@a hi", "b").write.json(path)
    bronze = to_bronze(spark.read.schema(RAW).json(path))
    assert bronze.schema.fieldNames() == BRONZE.fieldNames()
    rows = bronze.collect()
    assert all(r.source_file.endswith(".json") and path in r.source_file for r in rows)
    assert len({r.processing_time for r in rows}) == 1


def test_enforce(spark):
    df = spark.createDataFrame([("t", "u", 1)], "text string, user string, extra int")
    with pytest.raises(SchemaMismatch, match="missing column date"):
        enforce(df, RAW)
    wide = df.select("extra", "user", F.lit("d").alias("date"), F.lit("s").alias("sentiment"), "text")
    assert enforce(wide, RAW).columns == ["date", "sentiment", "text", "user", "extra"]
    with pytest.raises(SchemaMismatch, match="date is int, declared string"):
        enforce(wide.withColumn("date", F.lit(1)), RAW)
