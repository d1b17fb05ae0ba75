"""Fields that nobody has declared are kept, and become columns when somebody does."""

import json

import pytest
from compare import multiset
from pyspark.sql import functions as F

from tweetflow.plans import feed
from tweetflow.schemas import RAW, T
from tweetflow.sources import landing
from tweetflow.sources.tables import read_layer
from tweetflow.streaming import stages

LINES = [
    json.dumps({"date": "d", "text": "a", "user": "u"}),
    json.dumps({"text": "b", "lang": "en", "n": 3, "place": {"city": "x", "at": [1, 2]}, "none": None}),
    json.dumps({"text": "c", "n": "many", "sentiment": 7}),
    '{"text": "broken',
    "   ",
    json.dumps({"Text": "other case", "user": None}),
    '{"text": "twice", "n": 1, "n": 2}',
]


@pytest.fixture
def source(spark, new_dir):
    path = new_dir("lines")
    spark.createDataFrame([(x,) for x in LINES], "value string").coalesce(1).write.text(path)
    return path


def test_undeclared_fields_are_kept(spark, source):
    plain = landing.read_batch(spark, source, corrupt_column="line")
    rows = landing.read_batch(spark, source, corrupt_column="line", rescue_column="rest")
    assert rows.columns == [*RAW.fieldNames(), "line", "rest"]
    # The declared columns are what they are without the rescue.
    assert multiset(rows.drop("rest")) == multiset(plain)
    rest = {r.text or r.line or "": r.rest for r in rows.collect()}
    assert rest["a"] is None and rest['{"text": "broken'] is None
    assert rest["b"]["lang"] == "en" and rest["b"]["n"] == "3" and rest["b"]["none"] is None
    assert json.loads(rest["b"]["place"]) == {"city": "x", "at": [1, 2]}
    assert rest["c"] == {"n": "many"}
    assert rest[""] == {"Text": "other case"}
    assert set(rest["twice"]) == {"n"}


def test_promotion_keeps_what_has_another_type(spark, source):
    rows = landing.read_batch(spark, source, rescue_column="rest").filter("text IN ('a', 'b', 'c')")
    fields = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("none", T.StringType())])
    out = {r.text: r for r in landing.promote(rows, fields, "rest").collect()}
    assert (out["a"].n, out["b"].n, out["c"].n) == (None, 3, None)
    assert out["c"].rest == {"n": "many"} and set(out["b"].rest) == {"lang", "place"}
    assert out["a"].rest is None


def test_a_field_declared_later_is_whole(spark, sf_dir, new_dir, layout):
    """Half of the rows come before it is declared; provenance is noted for all."""
    messages = feed.event_messages(spark, sf_dir).withColumn("lang", F.lit("en"))
    source, field = new_dir("landing"), T.StructField("lang", T.StringType())
    for schema in (RAW, T.StructType([*RAW.fields, field])):
        messages.write.mode("append").json(source)
        stages.start_bronze(spark, source, layout, schema=schema, rescue_column="rest").awaitTermination()
    bronze = read_layer(spark, layout, "bronze", merge_schema=True)
    assert bronze.filter("lang IS NULL").count() == bronze.filter("rest IS NOT NULL").count() == messages.count()
    assert bronze.filter("source_file IS NULL OR processing_time IS NULL").isEmpty()
    whole = landing.promote(bronze, T.StructType([field]), "rest")
    assert multiset(whole.select(*messages.columns)) == multiset(messages.unionAll(messages))
    assert whole.filter("rest IS NOT NULL").isEmpty()
