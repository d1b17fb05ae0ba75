"""Layer tables on parquet: layout, reading, version, compaction, run log.

A layer table is written by the streaming file sink. Its ``_spark_metadata``
log names the committed files, so readers never see those of a failed batch.
Nothing else may write into such a directory.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tweetflow.schemas import LAYERS, RUNS, SchemaMismatch
from tweetflow.session import with_scan_tasks
from tweetflow.sources import files

TARGET_FILE_BYTES = 128 << 20

#: A message is repeated for each of its mentions. Snappy sees 64 KB at once and
#: misses the copies of long texts.
TABLE_CODEC = "zstd"

#: Bound of a file of a stage, so that readers can share out short messages too.
MAX_FILE_ROWS = 200_000


@dataclass(frozen=True)
class Layout:
    """Where one run keeps its tables and checkpoints."""

    base: str

    def table(self, layer: str) -> str:
        return f"{self.base}/{self._known(layer)}.table"

    def checkpoint(self, layer: str) -> str:
        return f"{self.base}/{self._known(layer)}.checkpoint"

    def schemas(self, layer: str) -> str:
        return f"{self.base}/{self._known(layer)}.schemas"

    def versions(self, layer: str) -> str:
        return f"{self.base}/{self._known(layer)}.versions"

    def snapshots(self, layer: str) -> str:
        return f"{self.base}/{self._known(layer)}.snapshots"

    @property
    def partials(self) -> str:
        return f"{self.base}/mentions.partials"

    @property
    def folds(self) -> str:
        return f"{self.base}/mentions.folds"

    @property
    def partials_checkpoint(self) -> str:
        return f"{self.base}/mentions.checkpoint"

    @property
    def progress(self) -> str:
        return f"{self.base}/progress"

    @property
    def runs(self) -> str:
        return f"{self.base}/runs"

    @staticmethod
    def _known(layer: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer}; known are {', '.join(LAYERS)}")
        return layer


def read_layer(
    spark: SparkSession, layout: Layout, layer: str, merge_schema: bool = False
) -> DataFrame:
    """A layer table as a batch.

    By default with the declared schema, which opens no file to learn it.
    ``merge_schema`` reads the footers of all files instead and so finds the
    columns a table has gained; rows written before hold null there.
    """
    path = layout.table(layer)
    if table_version(spark, path) is None:
        return spark.createDataFrame([], LAYERS[layer])
    if merge_schema:
        return spark.read.option("mergeSchema", "true").parquet(path)
    return spark.read.schema(LAYERS[layer]).parquet(path)


def table_version(spark: SparkSession, path: str) -> int | None:
    """Id of the last batch committed to a table, None before the first."""
    batches = [
        int(match.group(1))
        for name in files.child_names(spark, f"{path}/_spark_metadata")
        if (match := re.fullmatch(r"(\d+)(?:\.compact)?", name))
    ]
    return max(batches, default=None)


def admit(spark: SparkSession, layout: Layout, layer: str, schema: T.StructType) -> None:
    """Refuse rows that hold a column of a table with another type.

    Files of both types could be written, but no longer read together. The
    columns a table has had are kept beside it, a line for each time it gained
    some, so a check opens no data file; for a table without such lines the
    footers are read, once.
    """
    path, held = layout.schemas(layer), {}
    written = table_version(spark, layout.table(layer)) is not None
    noted = written and files.exists(spark, path)
    if noted:
        for line in spark.read.text(path).collect():
            held |= {f.name.lower(): f for f in T.StructType.fromJson(json.loads(line.value))}
    elif written:
        merged = read_layer(spark, layout, layer, merge_schema=True).schema
        held = {f.name.lower(): f for f in merged}
    problems = [
        f"column {f.name} is {f.dataType.simpleString()}, in the table {old.dataType.simpleString()}"
        for f in schema
        if (old := held.get(f.name.lower())) and old.dataType.simpleString() != f.dataType.simpleString()
    ]
    if problems:
        raise SchemaMismatch("; ".join(problems))
    gained = [f for f in schema if f.name.lower() not in held]
    if gained or not noted:
        fields = gained if noted else [*held.values(), *gained]
        line = spark.createDataFrame([(T.StructType(fields).json(),)], "value string")
        # Nothing counts that was noted for a table without a committed batch.
        line.coalesce(1).write.mode("append" if written else "overwrite").text(path)


def compact(
    spark: SparkSession, path: str, snapshot: str, target_bytes: int = TARGET_FILE_BYTES
) -> str | None:
    """Write the rows of a table to a new directory in files of about
    ``target_bytes``; None, and nothing done, where the table does not exist.

    Without a shuffle: scan tasks are packed to the target size and each writes
    one file. Schemas are merged, so columns gained on the way are kept.
    """
    if not files.exists(spark, path):
        return None
    table = with_scan_tasks(spark, target_bytes, 1).read.option("mergeSchema", "true").parquet(path)
    table.write.mode("errorifexists").parquet(snapshot, compression=TABLE_CODEC)
    return snapshot


def reset(spark: SparkSession, layout: Layout) -> bool:
    """Drop the tables of a run, what is noted and kept of them, and checkpoints; True if there were any.

    Always both: a table whose log outlives its checkpoint would take the first
    batches of the next run for batches it has already seen, and skip them.
    """
    paths = [
        place(layer)
        for layer in LAYERS
        for place in (layout.checkpoint, layout.table, layout.schemas, layout.versions, layout.snapshots)
    ]
    paths += [layout.partials_checkpoint, layout.partials, layout.folds]
    return any([files.delete(spark, path) for path in paths])


def log_run(
    spark: SparkSession,
    runs: str,
    run_name: str,
    metrics: DataFrame,
    params: dict[str, object],
) -> None:
    """Append one run. ``metrics`` is a ``(metric, value)`` frame of a few rows,
    which go to the table without passing the driver."""
    param_map = F.create_map(
        *[part for key, value in params.items() for part in (F.lit(key), F.lit(str(value)))]
    )
    metrics.agg(
        F.map_from_entries(F.collect_list(F.struct("metric", F.col("value").cast("double")))).alias(
            "metrics"
        )
    ).select(
        F.lit(run_name).alias("run_name"),
        F.current_timestamp().alias("ts"),
        "metrics",
        param_map.cast("map<string,string>").alias("params"),
    ).write.mode("append").parquet(runs)


def read_runs(spark: SparkSession, runs: str) -> DataFrame:
    return spark.read.schema(RUNS).parquet(runs)
