"""Tables and shared folders for the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tweetflow.llm.words import slices
from tweetflow.session import shared_dir
from tweetflow.sources.files import make_scratch


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns under the operator's own names.

    An operator works on these, so whatever else the input holds, and whatever
    it is called, cannot clash with columns that the operator adds.
    """
    return df.select(*(df[source].alias(name) for name, source in columns.items()))


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder that driver and executors share, under ``spark.checkpoint.dir``."""
    return make_scratch(spark, shared_dir(spark, label))


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage in a way that outlives an executor: a lost task rereads
    files instead of running the plan behind them again.
    """
    spark = df.sparkSession
    path = f"{scratch(spark, label)}/{label}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_key(*columns: Column) -> tuple[Column, Column]:
    """Two 64-bit hashes that stand for the values together; nulls count as such."""
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in columns]
    nulls = [c.isNull() for c in columns]
    return tuple(F.xxhash64(F.lit(seed), *nulls, *parts) for seed in (1, 2))


def shard_number() -> Iterator[int]:
    """Numbers that no other task of the stage gives out."""
    return count(TaskContext.get().partitionId() << 32)


_COMPRESSOR, _DECOMPRESSOR = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def packed(data: bytes | np.ndarray) -> bytes:
    """Bytes or numbers, compressed."""
    return _COMPRESSOR.compress(data if isinstance(data, bytes) else data.tobytes())


def unpacked(data: bytes) -> bytes:
    return _DECOMPRESSOR.decompress(data) if data else b""


def fold(column: str | Column) -> Column:
    """crc32 of the id as text, modulo 3; a null id has fold 1, the held-out one."""
    text = (F.col(column) if isinstance(column, str) else column).cast("string")
    return F.coalesce(F.crc32(text.cast("binary")) % 3, F.lit(1)).cast("int")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


#: Rows and bytes that go to a Python worker at a time; texts may be long.
_BATCH = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": 2000,
    "spark.sql.execution.arrow.maxBytesPerBatch": 8 << 20,
}


def bound_batches(spark: SparkSession) -> None:
    """Lower the session's bounds of Arrow batches where they are higher; no result depends on them."""
    for key, most in _BATCH.items():
        now = spark.conf.get(key, None)
        if now is None or not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))


def annotate(
    df: DataFrame,
    column: str,
    prepare: Callable[[], Callable[..., list[pa.Array]]],
    fields: str,
    into: str,
    drop: tuple[str, ...] = (),
    beside: tuple[str, ...] = (),
) -> DataFrame:
    """``df`` with a struct column ``into`` computed from the texts of ``column``.

    ``prepare`` runs once per task and returns a function from a slice of the
    column to the arrays of ``fields`` (a DDL string). Rows stay where they
    are: no shuffle, one result per row, repeated rows included. ``drop`` names
    columns that are not sent back, ``beside`` further columns that the function
    is given.
    """
    bound_batches(df.sparkSession)
    struct = T.StructType.fromDDL(fields)
    kept = [f for f in df.schema.fields if f.name not in drop]
    schema = T.StructType([*kept, T.StructField(into, struct)])
    arrow = to_arrow_schema(struct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = prepare()
        for batch in slices(batches, column):
            arrays = [
                a if isinstance(a, pa.Array) and a.type == f.type else pa.array(a, f.type)
                for a, f in zip(function(*map(batch.column, (column, *beside))), arrow, strict=True)
            ]
            result = pa.StructArray.from_arrays(arrays, fields=list(arrow))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in kept), result], names=[*(f.name for f in kept), into]
            )
        # Workers are used again; what one stage needed is not kept for the next.
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)
