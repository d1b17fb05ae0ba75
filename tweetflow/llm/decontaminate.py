"""Benchmark decontamination by a prefix-filtered set join.

A window is a run of ``WINDOW`` words of a benchmark item (all its words if it
has fewer). As a set of word shingles it is contained in a document only if its
rarest shingle is, so that one shingle is the whole prefix the join needs.
Rarity is counted over all documents. Neighbouring windows mostly share their
rarest shingle, so items come down to few *anchors*: places of such shingles,
each with the words that any of its windows may reach.

Documents send out the places whose shingle may be an anchor's, with as many
words around them; a bit table of fixed size sorts out the others where they are
read. Both sides are joined by shingle. A match fixes where a window would lie,
in the item and in the document (length and positional bounds: the words around
end with the text), and the words are compared outwards from it. What agrees in
a run of a window's length is an occurrence of every window in that run.

Nothing of items or documents goes through the driver but the bit table. Rows
are joined by the digest of their text, so copies are searched once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tweetflow.llm.frames import annotate, bound_batches, free_name, pick, stored
from tweetflow.llm.words import WORD_BYTE, Words, grams, slices, utf8, words

#: Words of a window, and words of the shingles that are ordered by rarity.
WINDOW = 13
SHINGLE = 4
#: A document is contaminated if at least one word in so many is hit.
WORDS_PER_HIT = 20

#: Bytes of a word that are compared as they are; of longer ones a digest is.
SPELLED = 64
#: Rows that a task hands on at a time.
_ROWS = 4096
#: Bits of the table that sorts out shingles: 8 MB, however many are looked for.
_SIEVE_BITS = 26
_FILTER_BITS = 20
SPANS = "array<struct<start:bigint,end:bigint,item:string>>"
#: A shingle in its place, and the words around it, joined by spaces.
PLACES = "id binary, n_words bigint, pos bigint, size int, key bigint, before int, around string"


class Keys:
    """A sorted set of 64-bit keys that is quick to say no."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.unique(keys)
        self._seen = np.zeros(1 << _FILTER_BITS, bool)
        self._seen[self._slot(self.keys)] = True

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return (keys >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)

    def find(self, probes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``probes`` that hold a key, and the number of that key."""
        if not len(self.keys) or not len(probes):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.flatnonzero(self._seen[self._slot(probes)])
        number = np.searchsorted(self.keys, probes[at])
        number[number == len(self.keys)] = 0
        same = self.keys[number] == probes[at]
        return at[same], number[same]


def sieve(keys: DataFrame, bits: int = _SIEVE_BITS) -> np.ndarray:
    """A table of ``2**bits`` bits, two of them set for each ``key``; set up by the executors."""
    high = F.shiftrightunsigned("key", 64 - bits)
    low = F.col("key").bitwiseAND(F.lit((1 << bits) - 1))
    slots = keys.select(F.explode(F.array(high, low)).alias("slot"))
    found = (
        slots.select(
            F.expr("slot div 64").cast("int").alias("word"),
            F.expr("shiftleft(1L, cast(slot % 64 as int))").alias("bit"),
        )
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
        .toArrow()
    )
    table = np.zeros(1 << (bits - 6), np.int64)
    table[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return table


def passing(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Positions of the keys that the table lets through: all that it was made of, few others."""
    bits = len(table).bit_length() + 5
    at = np.arange(len(keys))
    for slot in (keys >> np.uint64(64 - bits), keys & np.uint64((1 << bits) - 1)):
        slot = slot[at].astype(np.int64)
        at = at[(table[slot >> 6] >> (slot & 63)) & 1 == 1]
    return at


def _within(found: Words, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the shingles from words ``at`` on those within one text, and the numbers of the texts."""
    text = np.searchsorted(found.first, at, side="right") - 1
    whole = at + size <= found.first[text + 1]
    return at[whole], text[whole]


def _spell(word: np.ndarray) -> str:
    """A lowered word, or a digest that no word can be taken for."""
    raw = word.tobytes()
    return raw.decode() if len(raw) <= SPELLED else "#" + hashlib.sha256(raw).hexdigest()


def _places(
    data: np.ndarray, found: Words, ids: list[bytes], at: np.ndarray, text: np.ndarray, size: int, reach: int
) -> Iterator[pa.RecordBatch]:
    """Rows of ``PLACES`` for the shingles of ``size`` words at ``at``, with ``reach`` words on both sides."""
    keys = grams(found.hashes, size)[at].view(np.int64)
    first, end = found.first[text], found.first[text + 1]
    low, high = np.maximum(first, at - reach), np.minimum(end, at + size + reach)
    for i in range(0, len(at), _ROWS):
        part = slice(i, i + _ROWS)
        spelled: dict[int, str] = {}  # words stand around several places
        around = []
        for lo, hi in zip(low[part].tolist(), high[part].tolist(), strict=True):
            for w in range(lo, hi):
                if w not in spelled:
                    spelled[w] = _spell(WORD_BYTE[data[found.starts[w] : found.ends[w]]])
            around.append(" ".join([spelled[w] for w in range(lo, hi)]))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([ids[t] for t in text[part].tolist()], pa.binary()),
                pa.array((end - first)[part]),
                pa.array((at - first)[part]),
                pa.array(np.full(len(around), size, np.int32)),
                pa.array(keys[part]),
                pa.array((at - low)[part].astype(np.int32)),
                pa.array(around, pa.string()),
            ],
            names=[c.split()[0] for c in PLACES.split(", ")],
        )


def item_places(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """``PLACES`` of every shingle of ``(id, text)`` rows; texts of fewer words are one shingle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            data, offsets = utf8(batch.column("text"))
            found = words(data, offsets)
            ids = batch.column("id").to_pylist()
            of_word = np.repeat(found.counts, found.counts)
            for size in range(1, SHINGLE + 1):
                own = (of_word == size) if size < SHINGLE else (of_word >= size)
                at, text = _within(found, np.flatnonzero(own), size)
                yield from _places(data, found, ids, at, text, size, window - size if size == SHINGLE else 0)

    return pieces.mapInArrow(run, PLACES)


def shingle_counts(docs: DataFrame, table, sizes: list[int]) -> DataFrame:
    """``(key, n)``: how often the shingles that pass the table occur in all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = words(*utf8(batch.column("text")))
            for size in sizes:
                keys = grams(found.hashes, size)
                at, _ = _within(found, passing(table.value, keys), size)
                some, n = np.unique(keys[at], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(some.view(np.int64)), pa.array(n)], names=["key", "n"])

    counted = docs.select("text").mapInArrow(run, "key bigint, n bigint")
    return counted.groupBy("key").agg(F.sum("n").alias("n"))


def anchors(places: DataFrame, counts: DataFrame, window: int = WINDOW) -> DataFrame:
    """The ``places`` whose shingle is the rarest of a window, with ``need``, the window's words, and ``n``.

    Of equally rare shingles the one with the smaller key is taken, then the first.
    """
    need = F.least(F.col("n_words"), F.lit(window))
    counted = places.join(counts, "key", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    ahead = Window.partitionBy("id").orderBy("pos").rowsBetween(0, window - SHINGLE)
    rarest = counted.select(
        "id", "pos", "n_words", F.min(F.struct("n", "key", "pos")).over(ahead).alias("rarest")
    ).filter(F.col("pos") + need <= F.col("n_words"))
    chosen = rarest.select("id", F.col("rarest.pos").alias("pos"), F.col("rarest.n").alias("n")).distinct()
    return places.join(chosen, ["id", "pos"]).withColumn("need", need)


def document_places(docs: DataFrame, table, sizes: list[int], window: int = WINDOW) -> DataFrame:
    """``PLACES`` of ``(id, text)`` rows whose shingle passes the table; equal texts give one row a place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            data, offsets = utf8(batch.column("text"))
            found = words(data, offsets)
            ids = batch.column("id").to_pylist()
            for size in sizes:
                at, text = _within(found, passing(table.value, grams(found.hashes, size)), size)
                yield from _places(data, found, ids, at, text, size, window - size if size == SHINGLE else 0)

    every = docs.select("id", "text").mapInArrow(run, PLACES)
    return every.groupBy("id", "pos", "size", "key").agg(F.first("before").alias("before"), F.first("around").alias("around"))


def _agreeing(here: Column, there: Column, start: Column, other: Column, step: int, most: int) -> Column:
    """How many words agree one after the other, from two places on in the same direction."""
    same = F.transform(
        F.sequence(F.lit(0), F.lit(most - 1)),
        lambda i: F.coalesce(F.get(here, start + step * i) == F.get(there, other + step * i), F.lit(False)),
    )
    return F.array_position(F.concat(same, F.array(F.lit(False))), F.lit(False)) - 1


def occurrences(probes: DataFrame, wanted: DataFrame, parts: int, window: int = WINDOW) -> DataFrame:
    """``(id, item, start, end)``: runs of words that documents share with items, a window long at least.

    A shingle that holds more than the fourth part of a partition's share of all
    occurrences is dealt over several keys. No more than ``4 * parts`` shingles
    can, which is what is sent round.
    """
    keys = wanted.groupBy("key").agg(F.max("n").alias("n"))
    total = keys.agg(F.sum("n")).first()[0] or 0
    heavy = keys.filter(F.col("n") * (4 * parts) > total).select(
        "key", F.least(F.ceil(F.col("n") * (4 * parts) / F.lit(max(total, 1))), F.lit(4 * parts)).alias("salts")
    )
    heavy = F.broadcast(heavy)
    salts = F.coalesce("salts", F.lit(1))
    here = probes.join(heavy, "key", "left").select(
        "key", F.pmod(F.xxhash64("id", "pos"), salts).alias("salt"), "id", "pos", "before", "around"
    )
    there = wanted.join(heavy, "key", "left").select(
        "key",
        F.explode(F.sequence(F.lit(0).cast("bigint"), salts - 1)).alias("salt"),
        F.col("need"), F.col("item"), F.col("before").alias("item_before"), F.col("around").alias("item_around"),
    )
    met = here.join(there, ["key", "salt"]).select(
        "id", "item", "pos", "need", "before", "item_before",
        F.split("around", " ").alias("d"), F.split("item_around", " ").alias("w"),
    )
    d, w, before, item_before = (F.col(c) for c in ("d", "w", "before", "item_before"))
    met = met.select(
        "id", "item", "pos", "need",
        _agreeing(d, w, before - 1, item_before - 1, -1, window).alias("left"),
        _agreeing(d, w, before, item_before, 1, window).alias("right"),
    ).filter(F.col("left") + F.col("right") >= F.col("need"))
    return met.select("id", "item", (F.col("pos") - F.col("left")).alias("start"), (F.col("pos") + F.col("right")).alias("end"))


def joined_runs(runs: DataFrame) -> DataFrame:
    """``(id, item, start, end)`` with runs of an item that meet or overlap made one."""
    order = Window.partitionBy("id", "item").orderBy("start", "end")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    begins = runs.distinct().withColumn("new", F.when(F.col("start") <= reached, 0).otherwise(1))
    numbered = begins.withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return (
        numbered.groupBy("id", "item", "run")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .select("id", "item", "start", "end")
    )


def _word_counts(column: pa.Array) -> list:
    """Words of each text, without their hashes."""
    data, offsets = utf8(column)
    inside = WORD_BYTE[data] != 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    begins[edges] = inside[edges]
    return [np.diff(np.searchsorted(np.flatnonzero(begins), offsets))]


def _covered(spans: Column) -> Column:
    """Words in the union of the spans."""
    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("reach"))
    return F.aggregate(
        F.array_sort(spans),
        zero,
        lambda acc, s: F.struct(
            (acc.n + F.greatest(F.lit(0), s.end - F.greatest(s.start, acc.reach))).alias("n"),
            F.greatest(acc.reach, s.end).alias("reach"),
        ),
        lambda acc: acc.n,
    )


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def find_items(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``(id, spans)`` of the ``(id, text)`` rows of ``docs`` in which windows of ``(item, text)`` rows occur."""
    spark = docs.sparkSession
    bound_batches(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    benchmark = items.select(_digest(items["text"]).alias("id"), "item", "text")
    pieces = benchmark.groupBy("id").agg(F.first("text").alias("text"))
    places = stored(item_places(pieces), "item_places")
    sizes = sorted(row["size"] for row in places.select("size").distinct().collect())
    every = spark.sparkContext.broadcast(sieve(places))
    counts = stored(shingle_counts(docs, every, sizes), "shingle_counts")
    every.unpersist()
    owners = benchmark.select("id", "item").distinct()
    wanted = anchors(places, counts).join(owners, "id").select("key", "n", "need", "before", "around", "item")
    wanted = stored(wanted.distinct(), "anchors")
    some = spark.sparkContext.broadcast(sieve(wanted))
    probes = document_places(docs, some, sizes)
    runs = joined_runs(occurrences(probes, wanted, parts))
    # By item and start; a document's spans are no more than its own occurrences.
    ordered = F.array_sort(F.collect_list(F.struct("item", "start", "end")))
    spans = F.transform(ordered, lambda s: F.struct(s.start, s.end, s["item"]))
    return stored(runs.groupBy("id").agg(spans.alias("spans")), "hits")


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    *,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    into: str = "contamination",
    drop: tuple[str, ...] = (),
) -> DataFrame:
    """``docs`` with a struct ``into`` of n_words, n_hit, items, spans, contaminated.

    ``spans`` are runs of words (from 0, end exclusive) covered by windows of
    an item; ``items`` are the ids, as sorted strings, of the items that occur.
    A null or empty text has no words and no hits; an item with neither words
    nor text has no window; an item whose id is null goes by the empty string;
    items that share an id are one item. Rows, repeated ones included, and
    other columns of ``docs`` stay as they are.
    """
    benchmark = pick(items, item=item_id, text=item_text).select(
        F.coalesce(F.col("item").cast("string"), F.lit("")).alias("item"), "text"
    )
    own = pick(docs, text=text).select(_digest(F.col("text")).alias("id"), "text")
    hits = find_items(own, benchmark)
    key, part, found = (free_name(docs, f"{into}_{name}") for name in ("key", "part", "spans"))
    keyed = docs.withColumn(key, _digest(docs[text]))
    counted = annotate(keyed, text, lambda: _word_counts, "n_words bigint", part, drop)
    # The hits are stored: Spark knows their size and sends them round if they
    # are few; of many, it splits the copies of a text that has very many.
    out = counted.join(hits.select(F.col("id").alias(key), F.col("spans").alias(found)), key, "left")
    spans = F.coalesce(F.col(found), F.array().cast(SPANS))
    n_words, n_hit = F.col(part).n_words, _covered(spans)
    result = F.struct(
        n_words.alias("n_words"),
        n_hit.alias("n_hit"),
        F.array_sort(F.array_distinct(F.transform(spans, lambda s: s.item))).alias("items"),
        spans.alias("spans"),
        ((n_hit > 0) & (n_hit * WORDS_PER_HIT >= n_words)).alias("contaminated"),
    )
    kept = [c for c in docs.columns if c not in drop]
    return out.select(*kept, result.alias(free_name(docs, into)))
