"""What five filters remove, and how much of it another one would have removed anyway.

Documents are held as a sparse matrix of documents by words: shards in CSR form
over one dictionary for the whole corpus. A shard first numbers its own distinct
words, and only these go on, packed by buckets of their hash: to a bucket come
its words from all shards, it numbers them, and the numbers go back to the
shards. Sums and counts of the rows of the matrix decide the filters on words,
other filters are judged beside them, and copies by the least id that has the
same text.

A failing pattern is the set of filters that a document fails. Only the number
of documents per part and pattern is needed to follow every order of filters.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tweetflow.llm.frames import bound_batches, packed, pick, shard_number, stored, text_key, unpacked
from tweetflow.llm.words import slices, utf8

#: The filters; the bit of a filter in a pattern is its place here.
FILTERS = "ABCDE"
#: A: a text with fewer words fails.
LEAST_WORDS = 50
#: B: fails where distinct words are less than so many in a hundred.
LEAST_DISTINCT = 65
#: C: fails where capitals are more than so many in a hundred code points.
MOST_CAPITALS = 5
#: D: characters that fail a text.
SIGNS = b"#$%&*|"
#: Bytes of texts in a shard.
SHARD = 4 << 20
#: Buckets of words at least; as many as there are shuffle partitions if those are more.
BUCKETS = 64

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_CAPITAL = np.zeros(256, bool)
_CAPITAL[ord("A") : ord("Z") + 1] = True
_SIGN = np.zeros(256, bool)
_SIGN[np.frombuffer(SIGNS, np.uint8)] = True
_CONTINUES = (np.arange(256) & 0xC0) == 0x80


def _count(mask: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Marked bytes of each text."""
    return np.diff(np.searchsorted(np.flatnonzero(mask), ends))


def document_terms(data: np.ndarray, ends: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words of the texts, and the CSR matrix of texts by words: indptr, indices, counts."""
    inside = ~_SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    at = ends[:-1][ends[:-1] < ends[1:]]
    begins[at] = inside[at]
    starts = np.flatnonzero(begins)
    n = len(ends) - 1
    if not len(starts):
        none = np.zeros(0, np.int64)
        return [], np.zeros(n + 1, np.int64), none, none
    # Between two starts, what is inside belongs to the first.
    lengths = np.add.reduceat(inside, starts, dtype=np.int64)
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    words = pa.BinaryArray.from_buffers(
        pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])]
    ).dictionary_encode()
    n_words = len(words.dictionary)
    text = np.searchsorted(ends, starts, side="right") - 1
    cells, counts = np.unique(text * n_words + words.indices.to_numpy(), return_counts=True)
    rows, indices = np.divmod(cells, n_words)
    return words.dictionary.to_pylist(), np.searchsorted(rows, np.arange(n + 1)), indices, counts


def _lists(values: pa.Array) -> pa.ListArray:
    """One list that holds all values."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _by_bucket(words: list[bytes], buckets: int) -> tuple[np.ndarray, list[bytes]]:
    """New numbers of the words, bucket by bucket, and the words of each bucket, packed."""
    bucket = np.fromiter((xxhash.xxh32_intdigest(w) % buckets for w in words), np.int64, len(words))
    order = np.argsort(bucket, kind="stable")
    number = np.empty(len(words), np.int64)
    number[order] = np.arange(len(words))
    ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
    return number, [
        packed(b" ".join([words[i] for i in order[a:b].tolist()])) if b > a else b""
        for a, b in zip(ends[:-1], ends[1:], strict=True)
    ]


def _local_shards(docs: DataFrame, buckets: int) -> DataFrame:
    """Shards over their own words; ``other`` has the bits of the filters C and D."""
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = shard_number()
        for batch in slices(batches, "text", SHARD):
            data, ends = utf8(batch.column("text"))
            words, indptr, indices, counts = document_terms(data, ends)
            number, packs = _by_bucket(words, buckets)
            points = np.diff(ends) - _count(_CONTINUES[data], ends)
            capitals, signs = _count(_CAPITAL[data], ends), _count(_SIGN[data], ends)
            other = 4 * (100 * capitals > MOST_CAPITALS * points) + 8 * (signs > 0)
            blobs = (packed(x.astype(np.int32)) for x in (indptr, number[indices], counts))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([next(numbers)], pa.int64()),
                    *(_lists(batch.column(c)) for c in ("doc_id", "part", "t1", "t2")),
                    _lists(pa.array(other, pa.int32())),
                    *(pa.array([blob], pa.binary()) for blob in blobs),
                    _lists(pa.array(packs, pa.binary())),
                ],
                names=["shard", "doc_ids", "parts", "t1s", "t2s", "other", "indptr", "indices", "counts", "packs"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(
        run,
        f"shard bigint, doc_ids array<{kind}>, parts array<string>, t1s array<bigint>, t2s array<bigint>,"
        " other array<int>, indptr binary, indices binary, counts binary, packs array<binary>",
    )


def _numbered(shards: DataFrame, buckets: int) -> DataFrame:
    """``(shard, bucket, ranks, fresh)``: words of a bucket are numbered as they come.

    ``ranks`` are those of a shard's words, ``fresh`` the words that came for the
    first time. A task holds the distinct words of one bucket at a time.
    """
    packs = shards.select("shard", F.posexplode("packs").alias("bucket", "pack")).filter(F.length("pack") > 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, known = None, {}
        for batch in batches:
            ranks, fresh = [], []
            for bucket, pack in zip(batch.column("bucket").to_pylist(), batch.column("pack"), strict=True):
                if bucket != current:
                    current, known = bucket, {}
                words, before = unpacked(pack.as_py()).split(b" "), len(known)
                own = [known.setdefault(w, len(known)) for w in words]
                ranks.append(packed(np.array(own, np.int32)))
                fresh.append(packed(b" ".join([w for w, i in zip(words, own, strict=True) if i >= before])))
            columns = [batch.column("shard"), batch.column("bucket"), pa.array(ranks, pa.binary()), pa.array(fresh, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["shard", "bucket", "ranks", "fresh"])

    dealt = packs.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(run, "shard bigint, bucket int, ranks binary, fresh binary")


def dictionary(numbered: DataFrame, buckets: int) -> DataFrame:
    """``(word, word_id)`` for each distinct word of the corpus.

    In a bucket words come in the order of their numbers, but from shard to
    shard: a shard's fresh words go on from the highest rank before it, which is
    the least rank among them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bucket, ranks, fresh in zip(*(batch.column(c).to_pylist() for c in ("bucket", "ranks", "fresh")), strict=True):
                words = unpacked(fresh).split(b" ") if unpacked(fresh) else []
                last = np.sort(np.frombuffer(unpacked(ranks), np.int32))[len(unpacked(ranks)) // 4 - len(words) :]
                ids = last.astype(np.int64) * buckets + bucket
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words, pa.binary()).cast(pa.string()), pa.array(ids)], names=["word", "word_id"]
                )

    return numbered.mapInArrow(run, "word string, word_id bigint")


def csr_shards(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source", buckets: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """The document-term matrix of ``docs`` in shards, and the dictionary of its columns.

    A shard has ``doc_ids`` and ``parts`` (sources, null: empty) of its rows, and
    ``indptr``, ``indices`` (word ids, in no order within a row) and ``counts``,
    packed integers that ``matrix`` reads. ``t1s``, ``t2s`` stand for the whole
    text. A null text is empty and has a row without entries; repeated rows are
    rows of their own. More ``buckets`` make smaller dictionaries in the tasks.
    """
    buckets = buckets or max(BUCKETS, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    own = pick(docs, doc_id=doc_id, text=text, part=source)
    own = own.withColumns({"part": F.coalesce("part", F.lit("")), "text": F.coalesce("text", F.lit(""))})
    t1, t2 = text_key(F.col("text"))
    local = stored(_local_shards(own.withColumns({"t1": t1, "t2": t2}), buckets), "shards")
    numbered = stored(_numbered(local, buckets), "numbered")
    # A row per bucket to a shard.
    back = numbered.groupBy("shard").agg(F.sort_array(F.collect_list(F.struct("bucket", "ranks"))).alias("found"))
    joined = local.drop("packs").join(back, "shard", "left")
    names = [c for c in local.columns if c != "packs"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(i, 1) for whole in batches for i in range(whole.num_rows)):
            found = batch.column("found")[0].as_py() or []
            ids = [np.frombuffer(unpacked(x["ranks"]), np.int32).astype(np.int64) * buckets + x["bucket"] for x in found]
            number = np.concatenate(ids) if ids else np.zeros(0, np.int64)
            indices = number[np.frombuffer(unpacked(batch.column("indices")[0].as_py()), np.int32)]
            columns = {c: batch.column(c) for c in names} | {"indices": pa.array([packed(indices)], pa.binary())}
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=names)

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in local.schema if f.name != "packs")
    return joined.mapInArrow(run, schema), dictionary(numbered, buckets)


def matrix(indptr: bytes, indices: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The arrays of a shard's CSR matrix."""
    return (
        np.frombuffer(unpacked(indptr), np.int32),
        np.frombuffer(unpacked(indices), np.int64),
        np.frombuffer(unpacked(counts), np.int32),
    )


def row_statistics(shards: DataFrame) -> DataFrame:
    """A row per document: sum and number of its matrix entries, and what else the shard knows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                indptr, _, counts = matrix(*(batch.column(c)[i].as_py() for c in ("indptr", "indices", "counts")))
                total = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c)[i].values for c in ("doc_ids", "parts", "t1s", "t2s", "other")),
                        pa.array(np.diff(total[indptr]), pa.int64()),
                        pa.array(np.diff(indptr), pa.int64()),
                    ],
                    names=["doc_id", "part", "t1", "t2", "other", "n_words", "n_distinct"],
                )

    kind = shards.schema["doc_ids"].dataType.elementType.simpleString()
    return shards.mapInArrow(
        run,
        f"doc_id {kind}, part string, t1 bigint, t2 bigint, other int, n_words bigint, n_distinct bigint",
    )


def failures(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``(doc_id, part, n_words, n_distinct, fails)`` for each row of ``docs``.

    ``fails`` has the bit of each filter that the document fails. Without words
    B holds. Of equal texts all fail E but those with the least id; a row without
    an id has no smaller ones and is none, so it never fails E.
    """
    shards, _ = csr_shards(docs, doc_id=doc_id, text=text, source=source)
    rows = stored(row_statistics(shards), "rows")
    # The id is part of the join key, so that a text which many share is no hot key.
    least = rows.groupBy("t1", "t2").agg(F.min("doc_id").alias("doc_id"))
    least = least.filter(F.col("doc_id").isNotNull()).withColumn("is_least", F.lit(True))
    with_id = rows.filter(F.col("doc_id").isNotNull()).join(least, ["t1", "t2", "doc_id"], "left")
    without = rows.filter(F.col("doc_id").isNull()).withColumn("is_least", F.lit(True))
    judged = with_id.unionByName(without)
    bits = (
        F.when(F.col("n_words") < LEAST_WORDS, 1).otherwise(0)
        + F.when(100 * F.col("n_distinct") < LEAST_DISTINCT * F.col("n_words"), 2).otherwise(0)
        + F.col("other")
        + F.when(F.col("is_least").isNull(), 16).otherwise(0)
    )
    return judged.select("doc_id", "part", "n_words", "n_distinct", bits.cast("int").alias("fails"))


def patterns(failed: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id") -> DataFrame:
    """Documents per part and failing pattern, and how many are labelled good or toxic.

    A document is good or toxic if any of its labels says so; rows without an id
    have no labels.
    """
    marked = pick(labels, doc_id=doc_id, quality="quality", toxic="toxic").filter("doc_id IS NOT NULL")
    marked = marked.groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"),
        F.max((F.col("toxic") == 1).cast("int")).alias("toxic"),
    )
    with_id = failed.filter(F.col("doc_id").isNotNull()).join(marked, "doc_id", "left")
    own = with_id.select("part", "fails", "good", "toxic").unionByName(
        failed.filter(F.col("doc_id").isNull()).select("part", "fails"), allowMissingColumns=True
    )
    count = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c)
    return own.groupBy("part", "fails").agg(F.count("*").alias("n"), count("good"), count("toxic"))


def audit(counted: DataFrame) -> DataFrame:
    """What each step of each order of the filters does, per part.

    ``counted`` is what ``patterns`` gives. One row per part, order and step;
    a table without documents has none.
    """
    orders = ["".join(order) for order in permutations(FILTERS)]
    step = F.col("step")
    letter = F.substring("filter_order", step, F.lit(1))
    bit = lambda c: F.call_function("shiftleft", F.lit(1), F.ascii(c) - ord(FILTERS[0]))
    before = F.aggregate(
        F.split(F.substring("filter_order", F.lit(1), step - 1), ""),
        F.lit(0),
        lambda mask, c: mask + F.when(c == "", 0).otherwise(bit(c)),
    )
    steps = (
        counted.withColumn("filter_order", F.explode(F.array(*map(F.lit, orders))))
        .withColumn("step", F.explode(F.array(*(F.lit(i + 1) for i in range(len(FILTERS))))))
        .withColumns({"letter": letter, "own": bit(letter), "before": before})
    )
    fails, own = F.col("fails"), F.col("own")
    hit = fails.bitwiseAND(own) != 0
    gone = fails.bitwiseAND(F.col("before")) != 0
    total = lambda condition, c="n": F.sum(F.when(condition, F.col(c)).otherwise(0))
    counts = steps.groupBy("part", "filter_order", "step", "letter").agg(
        total(~hit & ~gone).alias("kept"),
        total(hit & ~gone).alias("removed"),
        total(hit & gone).alias("redundant"),
        total(fails == own).alias("unique_fails"),
        total(hit & ~gone, "good").alias("good_lost"),
        total(hit & ~gone, "toxic").alias("toxic_lost"),
    )
    # 120 rows to a part and filter.
    shapley = F.sum("removed").over(Window.partitionBy("part", "letter"))
    return counts.withColumn("shapley", shapley).drop("letter")
