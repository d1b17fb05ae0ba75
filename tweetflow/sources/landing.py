"""The landing directory of JSON files: scans, listings and a replay feed."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from tweetflow.schemas import RAW
from tweetflow.sources import files

#: Files never grow too old to be read. Spark's own default skips files more
#: than seven days older than the newest one. The price is an entry per file in
#: the driver's list of files seen.
MAX_FILE_AGE = "36500d"

#: The same where files are archived: they are remembered for a day.
ARCHIVE_AGE = "1d"

SUFFIX = ".json"
#: Names of landing files, as they are and compressed.
SUFFIXES = (SUFFIX, SUFFIX + ".gz", SUFFIX + ".snappy")

#: How files are landed: compressed, with the codec that costs no time, and
#: bounded in rows, for a compressed file is read by one task.
LANDED = {"compression": "snappy", "maxRecordsPerFile": "50000"}


def read_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType = RAW,
    max_bytes: int | None = None,
    max_files: int | None = None,
    corrupt_column: str | None = None,
    rescue_column: str | None = None,
    archive: str | None = None,
) -> DataFrame:
    """New files as a stream, with a declared schema; for ``corrupt_column`` and
    ``rescue_column`` see ``read_batch``.

    With ``archive`` files are moved to that directory, which must not lie in
    ``path``, once a later batch is committed. Then neither the listing nor the
    driver's list of files seen grows with the files that have ever come; what
    still does is the source's log in the checkpoint, by a line a file. Files
    have to come through ``hand_on``: one that is ``ARCHIVE_AGE`` older than
    another is taken for seen.

    ``max_bytes`` or ``max_files`` bounds a micro-batch. Prefer bytes: files
    differ in size, so a number of files says little about the work.
    """
    if max_bytes is not None and max_files is not None:
        raise ValueError("give max_bytes or max_files, not both")
    reader = spark.readStream.option("maxFileAge", MAX_FILE_AGE if archive is None else ARCHIVE_AGE)
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes))
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return _read(reader, path, schema, corrupt_column, rescue_column)


def read_batch(
    spark: SparkSession,
    path: str,
    schema: T.StructType = RAW,
    corrupt_column: str | None = None,
    rescue_column: str | None = None,
) -> DataFrame:
    """The same files as a batch. A malformed line is a row of nulls; with
    ``corrupt_column`` that extra column holds the line.

    With ``rescue_column`` that extra column, a map of strings, holds the fields
    that ``schema`` lacks, nested ones as JSON; null where there are none. See
    ``promote``."""
    return _read(spark.read, path, schema, corrupt_column, rescue_column)


def _read(
    reader, path: str, schema: T.StructType, corrupt_column: str | None, rescue_column: str | None
) -> DataFrame:
    options = {}
    declared = schema.fieldNames()
    if corrupt_column is not None:
        schema = T.StructType(schema.fields + [T.StructField(corrupt_column, T.StringType())])
        options["columnNameOfCorruptRecord"] = corrupt_column
    if rescue_column is None:
        return reader.schema(schema).options(**options).json(path)
    # A line is parsed for the declared fields and once more for all that it has.
    lines = reader.text(path).filter(F.trim("value") != "")
    every = F.map_filter(
        F.from_json("value", "map<string,string>"), lambda name, _: ~F.coalesce(name.isin(*declared), F.lit(False))
    )
    parsed = lines.withColumns({"__row": F.from_json("value", schema, options), "__every": every})
    return parsed.select(
        *(F.col("__row")[name].alias(name) for name in schema.fieldNames()),
        F.when(F.size("__every") > 0, F.col("__every")).alias(rescue_column),
    )


def promote(table: DataFrame, fields: T.StructType, rescue_column: str) -> DataFrame:
    """``table`` with rescued fields as columns of their own.

    A column that the table has gained meanwhile is filled up from what was
    rescued before. A value that does not have the declared type stays rescued,
    and is null in the column.
    """
    rescued = F.col(rescue_column)
    columns = {}
    for field in fields:
        value = F.try_element_at(rescued, F.lit(field.name)).try_cast(field.dataType)
        own = F.col(field.name) if field.name in table.columns else F.lit(None)
        columns[field.name] = F.coalesce(own, value)
    kinds = {field.name: field.dataType for field in fields}

    def stays(name, value):
        moved = F.lit(False)
        for field, kind in kinds.items():
            moved = moved | ((name == field) & (value.isNull() | value.try_cast(kind).isNotNull()))
        return ~moved

    left = F.map_filter(rescued, stays)
    return table.withColumns({**columns, rescue_column: F.when(F.size(left) > 0, left)})


def read_inferred(spark: SparkSession, path: str) -> DataFrame:
    """A file or directory whose schema Spark works out (an extra pass)."""
    return spark.read.json(path)


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """``(path, modificationTime, length)`` of the JSON files."""
    return files.list_files(spark, path, *SUFFIXES)


def count_files(spark: SparkSession, path: str) -> DataFrame:
    return files.file_sizes(spark, path, *SUFFIXES).select("n_files")


def newest_files(spark: SparkSession, path: str, n: int) -> DataFrame:
    """The ``n`` files modified last; ties in order of the path."""
    return list_files(spark, path).orderBy(F.desc("modificationTime"), "path").limit(n)


def hand_on(spark: SparkSession, inbox: str, path: str) -> int:
    """Move the files of an inbox to the landing directory; how many there were.

    Whatever their times say, they are new there, so none is taken for one that
    has been seen; a name that has been used before is no hindrance either. A
    file is moved whole or stays: after a failure the rest is moved by the next
    call.
    """
    names = [n for n in sorted(files.child_names(spark, inbox)) if n.endswith(SUFFIXES) and n[0] not in "._"]
    for name in names:
        files.hand_into(spark, f"{inbox}/{name}", path, f"{uuid.uuid4().hex}-{name}")
    return len(names)


def replay_newest(
    spark: SparkSession,
    source: str,
    target: str,
    num_files: int = 50,
    schema: T.StructType = RAW,
) -> int:
    """Land the records of the newest files again, in new, compressed files under ``target``.

    Returns the number of files replayed: 0, and nothing done, where the source
    does not exist or holds none. Only the place of the last file in the order
    of ``newest_files`` comes to the driver; Spark skips the files beyond it
    when it plans the copying scan.
    """
    try:
        newest = newest_files(spark, source, num_files)
    except AnalysisException:
        return 0
    age = -F.unix_micros("modificationTime")
    last = newest.agg(
        F.count("*").alias("n_files"),
        F.max(age).alias("age"),
        F.max_by("path", F.struct(age, "path")).alias("path"),
    ).first()
    if last.n_files == 0:
        return 0
    path = F.col("_metadata.file_path")
    age = -F.unix_micros("_metadata.file_modification_time")
    among_newest = (age < last.age) | ((age == last.age) & (path <= last.path))
    (
        read_batch(spark, source, schema)
        .filter(files.ends_with(path, *SUFFIXES) & among_newest)
        .write.mode("append")
        .options(**LANDED)
        .json(target)
    )
    return last.n_files
