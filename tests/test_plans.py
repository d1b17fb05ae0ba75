"""Physical plans have the shape that holds at scale."""

import re

import pytest

from tweetflow.operators import evaluation, mentions, quality
from tweetflow.operators.layers import bronze_to_gold, to_gold, to_silver
from tweetflow.schemas import BRONZE, GOLD, SILVER


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Empty parquet tables: enough to plan on."""
    base = tmp_path_factory.mktemp("plans")
    frames = {}
    for name, schema in (("bronze", BRONZE), ("silver", SILVER), ("gold", GOLD)):
        path = str(base / name)
        spark.createDataFrame([], schema).write.parquet(path)
        frames[name] = spark.read.schema(schema).parquet(path)
    return frames


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def read_columns(text):
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    return {field.split(":")[0] for field in schema.split(",") if field}


def test_silver_is_one_codegen_stage_without_shuffle_or_python(tables):
    text = plan(to_silver(tables["bronze"]))
    assert "Exchange" not in text and "Python" not in text
    assert set(re.findall(r"\*\((\d+)\)", text)) == {"1"}
    assert read_columns(text) == {"date", "text", "sentiment"}
    assert "PushedFilters: [IsNotNull(text)]" in text
    # Mentions are extracted once and texts cleaned once, below the explode.
    assert text.count("regexp_extract_all") == 1
    assert text.count("regexp_replace(text") == 1
    assert text.index("Generate") < text.index("regexp_replace(text")


def test_gold_is_one_codegen_stage_without_shuffle_or_python(tables, scorer):
    text = plan(to_gold(tables["silver"], scorer))
    assert "Exchange" not in text and "Python" not in text
    assert set(re.findall(r"\*\((\d+)\)", text)) == {"1"}
    assert text.count("regexp_extract_all") == 1


def test_app_table_shuffles_once_after_partial_aggregation(tables):
    text = plan(mentions.mention_app_table(tables["gold"]))
    assert text.count("Exchange") == 1
    assert text.index("Exchange") < text.index("partial_count")
    assert read_columns(text) == {"timestamp", "mention", "predicted_sentiment"}


def test_reports_drop_the_text_before_they_explode(tables, scorer):
    text = plan(mentions.mention_pivot(bronze_to_gold(tables["bronze"], scorer)))
    generate = re.search(r"Generate explode\(.*\), \[([^\]]*)\], false", text).group(1)
    assert "text" not in generate and "predicted_sentiment" in generate
    assert read_columns(text) == {"text"}, "no column is read that the report does not show"


def test_top_k_does_not_sort_everything(tables):
    summary = mentions.mention_app_table(tables["gold"])
    for df in (mentions.top_mentions(summary, "positive"), quality.top_users(tables["bronze"])):
        text = plan(df)
        assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_quality_reports_scan_once(tables):
    for df in (quality.null_profile(tables["bronze"]), quality.quality_summary(tables["bronze"])):
        text = plan(df)
        assert text.count("FileScan") == 1 and text.count("Exchange") == 1


def test_counts_read_no_columns(tables):
    text = plan(quality.layer_counts(tables))
    assert re.findall(r"ReadSchema: struct<([^>]*)>", text) == ["", "", ""]


def test_evaluation_reads_two_columns_and_moves_one_row_per_task(tables):
    text = plan(evaluation.eval_summary(evaluation.confusion_matrix(tables["gold"])))
    assert read_columns(text) == {"sentiment_id", "predicted_sentiment_id"}
    innermost = text.rindex("Exchange")
    assert "partial_count" in text[innermost:]
