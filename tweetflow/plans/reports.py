"""The reports a user asks for, as named frames over the tables of a run.

All frames are lazy: only those that are looked at are computed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tweetflow.operators import evaluation, mentions, progress, quality
from tweetflow.schemas import LAYERS
from tweetflow.sources.tables import Layout, log_run, read_layer, read_runs, table_version
from tweetflow.sources.versions import pin_version, read_as_of


def layer_report(spark: SparkSession, layout: Layout) -> DataFrame:
    """``(layer, position, column_name, type, n_values, n_rows)``: the columns of each
    table, the ones it has gained included, and how many rows have a value there."""
    report = None
    for layer in LAYERS:
        table = read_layer(spark, layout, layer, merge_schema=True)
        # One pass over a table counts all its columns.
        counts = table.agg(
            F.count("*").alias("n_rows"), *(F.count(c).alias(f"n{i}") for i, c in enumerate(table.columns))
        )
        columns = [
            F.struct(
                F.lit(i).alias("position"),
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("type"),
                F.col(f"n{i}").alias("n_values"),
            )
            for i, f in enumerate(table.schema)
        ]
        rows = counts.select(F.lit(layer).alias("layer"), F.inline(F.array(*columns)), "n_rows")
        report = rows if report is None else report.unionByName(rows)
    return report


def quality_report(bronze: DataFrame, k: int = 20) -> dict[str, DataFrame]:
    return {
        "summary": quality.quality_summary(bronze),
        "null_profile": quality.null_profile(bronze),
        "top_users": quality.top_users(bronze, k),
        "mention_presence": quality.mention_presence(bronze),
        "only_mention_count": quality.only_mention_count(bronze),
        "length_distribution": quality.length_distribution(bronze),
    }


def mention_report(gold: DataFrame, k: int = 20) -> dict[str, DataFrame]:
    """The application table and its leaders in total, in favour and against."""
    table = mentions.mention_app_table(gold)
    return {
        "mentions": table,
        "total_mentions": mentions.mention_total(gold),
        **{
            f"top_{by}": mentions.top_mentions(table.select("mention", by), by, k)
            for by in ("total", "positive", "negative")
        },
    }


def evaluation_report(gold: DataFrame) -> dict[str, DataFrame]:
    confusion = evaluation.confusion_matrix(gold)
    return {
        "confusion": confusion,
        "classes": evaluation.class_report(confusion),
        "summary": evaluation.eval_summary(confusion),
    }


def log_evaluation(
    spark: SparkSession,
    layout: Layout,
    run_name: str,
    model_name: str,
    params: dict[str, object] | None = None,
    upstream: Layout | None = None,
    runs: str | None = None,
) -> None:
    """Evaluate the gold table of a layout and log the result as one run, with
    the version of the silver table it was made from: that of ``upstream`` where
    gold was scored from another layout. The log is the layout's unless ``runs``
    names another. The version of the gold table is pinned, so that the run can
    be evaluated again however the table goes on."""
    version = pin_version(spark, layout, "gold")
    confusion = evaluation.confusion_matrix(_gold_as_of(spark, layout, version))
    recorded = {
        "model_name": model_name,
        "spark_version": spark.version,
        "silver_table_version": table_version(spark, (upstream or layout).table("silver")),
        "gold_table_version": version,
        **(params or {}),
    }
    log_run(spark, runs or layout.runs, run_name, evaluation.metrics_table(confusion), recorded)


def _gold_as_of(spark: SparkSession, layout: Layout, version: int | None) -> DataFrame:
    if version is None:
        return read_layer(spark, layout, "gold")
    return read_as_of(spark, layout, "gold", version)


def evaluate_run(spark: SparkSession, layout: Layout, run_name: str, runs: str | None = None) -> DataFrame:
    """``(metric, value)`` of the gold table as it was when a run was logged, computed anew.

    Of several runs of that name the last one counts.
    """
    logged = read_runs(spark, runs or layout.runs).filter(F.col("run_name") == run_name)
    last = logged.orderBy(F.desc("ts")).select(F.col("params")["gold_table_version"].alias("v")).first()
    if last is None:
        raise LookupError(f"no run {run_name} has been logged")
    version = int(last.v) if last.v is not None and last.v.isdigit() else None
    return evaluation.metrics_table(evaluation.confusion_matrix(_gold_as_of(spark, layout, version)))


def progress_report(records: DataFrame) -> dict[str, DataFrame]:
    """Per query and, for charts, per query and ten seconds."""
    return {
        "by_query": progress.progress_by_query(records),
        "by_window": progress.progress_by_window(records),
        "elapsed": progress.with_elapsed(records),
    }
