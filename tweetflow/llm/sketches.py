"""Document fingerprints: sketches scaled by a threshold on the hash.

A sketch keeps every distinct shingle hash below a fixed fraction of the hash
range, whatever the length of the text. What is kept depends on the hash alone,
so the sketch of a union is the union of the sketches, and the share of one
document's hashes that another one has estimates containment however unequal
the two are. Of a text with few shingles few hashes are kept, so estimates about
it are coarse; a text that keeps none has a digest in place of hashes, which
equals that of the same text only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tweetflow.llm.frames import annotate, bound_batches, pick
from tweetflow.llm.words import shingles, slices, utf8, words

#: Words of a shingle.
SHINGLE = 5
#: One hash in so many is kept; a power of two.
SCALE = 2
#: Hashes are written with so many hex digits.
DIGITS = 10

_BITS = np.uint64(64 - 4 * DIGITS)
_LIMIT = np.uint64((1 << 64) // SCALE)
#: Before the digest of a text that keeps no hash.
_NONE = "~"


def kept_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes that each text keeps, and where each text's begin.

    The upper bits of a hash number the text, so that a slice is sorted at once.
    """
    if len(column) >= 1 << (64 - 4 * DIGITS):
        raise ValueError("too many texts in a slice")
    hashes, text = shingles(words(*utf8(column)), SHINGLE)
    low = hashes < _LIMIT
    shift = np.uint64(4 * DIGITS)
    values = np.unique((hashes[low] >> _BITS) + (text[low].astype(np.uint64) << shift))
    ends = np.searchsorted(values, np.arange(len(column) + 1, dtype=np.uint64) << shift)
    return values & ((np.uint64(1) << shift) - np.uint64(1)), ends


def _written(column: pa.Array, values: np.ndarray, ends: np.ndarray) -> list[str]:
    raw = (values << _BITS).byteswap().tobytes().hex()
    cells = [raw[i * 16 : i * 16 + DIGITS] for i in range(len(values))]
    out = [",".join(cells[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
    for i in np.flatnonzero(ends[:-1] == ends[1:]):
        if said := column[int(i)].as_py():
            out[i] = _NONE + hashlib.blake2b(said.encode(), digest_size=16).hexdigest()
    return out


def sketch_column(column: pa.Array) -> list[str]:
    """Sorted hex hashes of each text, joined by commas.

    Equal texts have equal sketches. Only the empty text has an empty one, and a
    null text has that of the empty one; another text that keeps no hash has a
    digest of its characters after ``~``.
    """
    return _written(column, *kept_hashes(column))


def sketch(
    docs: DataFrame, text: str = "text", into: str = "fingerprint", drop: tuple[str, ...] = ()
) -> DataFrame:
    """``docs`` with the sketch of ``text`` as a string column ``into``; no row moves."""
    out = annotate(docs, text, lambda: lambda column: [sketch_column(column)], "s string", into, drop)
    return out.withColumn(into, F.col(into).s)


def _hashes(fingerprint: Column) -> Column:
    cells = F.split(F.regexp_replace(fingerprint, f"^{_NONE}.*", ""), ",")
    return F.filter(cells, lambda x: x != "")


def merge(a: Column, b: Column) -> Column:
    """The sketch of the two documents taken together.

    A document that keeps no hash adds nothing to one that does; of two such
    documents the greater sketch is taken.
    """
    hashes = F.array_sort(F.array_union(_hashes(a), _hashes(b)))
    return F.when(F.size(hashes) == 0, F.greatest(a, b)).otherwise(F.array_join(hashes, ","))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of a's hashes that b has.

    1 for equal sketches, 0 where a is the empty text, and null where a keeps no
    hash that could be compared with b's.
    """
    own = _hashes(a)
    share = F.size(F.array_intersect(own, _hashes(b))) / F.greatest(F.size(own), F.lit(1))
    return F.when(a == b, 1.0).when(~a.startswith(_NONE), share).cast("double")


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity: 1 for equal sketches, else shared over all hashes.

    A text that keeps no hash is like no other than its equals.
    """
    own, other = _hashes(a), _hashes(b)
    both = F.size(F.array_intersect(own, other))
    share = both / F.greatest(F.size(own) + F.size(other) - both, F.lit(1))
    return F.when(a == b, 1.0).otherwise(share).cast("double")


def _like(a: np.ndarray, b: np.ndarray) -> float:
    """``likeness`` of sorted distinct hashes of texts that are not equal."""
    either = len(a) + len(b)
    both = len(np.intersect1d(a, b, assume_unique=True)) if len(a) and len(b) else 0
    return both / (either - both) if either else 0.0


_RANGES_PER_TASK = 3
#: Characters of texts that are sketched at a time.
_EMIT = 512 << 10


# Neighbours ----------------------------------------------------------------


def _cuts_above(cuts: list[int]):
    """How many of the sorted ``cuts`` lie above a value; only the values go to the workers."""
    sorted_cuts = np.array(cuts, np.int64)

    @F.pandas_udf("int")
    def above(values: pd.Series) -> pd.Series:
        at = np.searchsorted(sorted_cuts, values.fillna(0).to_numpy(np.int64), side="right")
        return pd.Series((len(sorted_cuts) - at).astype(np.int32))

    return above


def in_descending_order(docs: DataFrame, order: str, tasks: int) -> DataFrame:
    """``docs`` in ranges of ``order``, each followed by the next range's head.

    Adds ``range`` and ``extra``. Within a task the rows stand by ``range``,
    descending ``order`` and then text; a row with ``extra`` is a copy of the
    first row of the next range (for the last range: of the first), so that
    every row finds its successor in its own task. Null orders come last.
    The cut points come from quantiles: they decide the balance only. There are
    several ranges to each of ``tasks`` tasks, which evens out their sizes.
    """
    ranges = _RANGES_PER_TASK * tasks
    cuts = docs.select(F.col(order).cast("double").alias("x")).approxQuantile(
        "x", [i / ranges for i in range(1, ranges)], 0.2 / ranges
    )
    cuts = sorted({int(c) for c in cuts})
    number = F.lit(len(cuts))
    # How many cuts lie above the row: 0 for the largest ids.
    place = _cuts_above(cuts)(F.col(order))
    place = F.when(F.col(order).isNull(), number + 1).otherwise(place)
    placed = docs.withColumn("range", place.cast("int"))
    heads = {
        row.range: row.top
        for row in placed.groupBy("range").agg(F.max(order).alias("top")).collect()
    }
    present = sorted(heads)
    if not present:
        return placed.withColumn("extra", F.lit(False))
    # The head of each range also ends the range before it.
    before = {r: present[i - 1] for i, r in enumerate(present)}
    wanted = [heads[r] for r in present if heads[r] is not None]
    is_head = F.col(order).isin(wanted) if wanted else F.lit(False)
    if any(heads[r] is None for r in present):
        is_head = F.coalesce(is_head, F.lit(True)) | F.col(order).isNull()
    target = F.create_map(*(F.lit(x) for pair in before.items() for x in pair))
    extra = placed.filter(is_head).withColumn("range", target[F.col("range")])
    if any(heads[r] is None for r in present):
        # Of rows without an order only the first is wanted, not all of them.
        nulls = extra.filter(F.col(order).isNull()).orderBy("text").limit(1)
        extra = extra.filter(F.col(order).isNotNull()).unionByName(nulls)
    return (
        placed.withColumn("extra", F.lit(False))
        .unionByName(extra.withColumn("extra", F.lit(True)))
        .repartition(tasks, "range")
        .sortWithinPartitions("range", "extra", F.col(order).desc_nulls_last(), "text")
    )


def _edit(text: str, following: str) -> str:
    """The second half replaced by as many characters from the start of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def edited_fingerprints(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", tasks: int | None = None
) -> DataFrame:
    """Sketches of each document and of its edited text, and what they have in common.

    The next document is the one with the next smaller id; after the last comes
    the first. Returns ``doc_id, n_chars, edited, fingerprint,
    edited_fingerprint, near_edited, near_next``; the last two are the
    ``likeness`` to the edited text and to the next document. Rows that share an
    id follow one another by text; null ids come last; a null text is empty; a
    lone document follows itself.
    """
    own = pick(docs, doc_id=doc_id, text=text).withColumn("text", F.coalesce("text", F.lit("")))
    bound_batches(own.sparkSession)
    tasks = tasks or int(own.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = in_descending_order(own, "doc_id", tasks)

    def emit(ids, texts, following):
        edited = [_edit(a, b) for a, b in zip(texts, [*texts[1:], following], strict=True)]
        own_column, edited_column = pa.array([*texts, following]), pa.array(edited, pa.string())
        own, edited_own = kept_hashes(own_column), kept_hashes(edited_column)
        prints, edited_prints = _written(own_column, *own), _written(edited_column, *edited_own)
        sets = [own[0][a:b] for a, b in zip(own[1][:-1], own[1][1:], strict=True)]
        edited_sets = [edited_own[0][a:b] for a, b in zip(edited_own[1][:-1], edited_own[1][1:], strict=True)]
        near_edited = [
            1.0 if p == q else _like(a, b)
            for a, b, p, q in zip(sets[:-1], edited_sets, prints[:-1], edited_prints, strict=True)
        ]
        near_next = [
            1.0 if p == q else _like(a, b)
            for a, b, p, q in zip(sets[:-1], sets[1:], prints[:-1], prints[1:], strict=True)
        ]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.int64()),
                pa.array([len(t) for t in texts], pa.int64()),
                edited_column,
                pa.array(prints[:-1], pa.string()),
                pa.array(edited_prints, pa.string()),
                pa.array(near_edited, pa.float64()),
                pa.array(near_next, pa.float64()),
            ],
            names=[
                "doc_id", "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
            ],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size = [], [], 0
        done = None
        for batch in slices(batches, "text", _EMIT):
            columns = (batch.column(c).to_pylist() for c in ("doc_id", "text", "range", "extra"))
            for i, t, r, extra in zip(*columns, strict=True):
                if r == done:
                    continue  # further rows that share the id of the next range's head
                if ids and (extra or size > _EMIT):
                    yield emit(ids, texts, t)
                    ids, texts, size = [], [], 0
                if extra:
                    done = r
                else:
                    ids.append(i)
                    texts.append(t)
                    size += len(t)

    return placed.mapInArrow(
        run,
        "doc_id bigint, n_chars bigint, edited string, fingerprint string,"
        " edited_fingerprint string, near_edited double, near_next double",
    )
