"""Near-duplicate classes by ProbMinHash.

A document is the weighted set of its word shingles, weighted by how often they
occur. Each shingle sends out a Poisson process whose rate is its weight; an
arrival falls on a register drawn at random, and a register keeps the shingle
that arrived there first. Two documents agree in a register with the
probability Jaccard similarity

    J_P = sum over d of 1 / (sum over d' of max(a(d') / a(d), b(d') / b(d))),

which is the ordinary one where all weights are equal. A process is cut off as
soon as its next arrival comes after the latest first arrival of the document,
so nearly all shingles are drawn once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tweetflow.llm.frames import annotate, pick, stored
from tweetflow.llm.words import mix, shingles, slices, utf8, words

#: Words of a shingle, and the similarity from which documents are linked.
SHINGLE = 5
SIMILARITY = 0.8
#: A pair at 0.8 misses all bands with a probability of (1 - 0.8**5)**30, 7e-6.
BANDS = 30
ROWS = 5

_GOLD = np.uint64(0x9E3779B97F4A7C15)
_UNIT = 1.0 / (1 << 53)


def profile(found, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(text, shingle, weight)``: the distinct shingles of each text, text by text."""
    hashes, text = shingles(found, size)
    # One sort brings equal shingles of a text together; their order is of no concern.
    order = np.argsort(mix(hashes + text.astype(np.uint64) * _GOLD))
    hashes, text = hashes[order], text[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    weight = np.diff(np.append(at, len(hashes)))
    by_text = np.argsort(text[at], kind="stable")
    return text[at][by_text], hashes[at][by_text], weight[by_text]


def signatures(
    n_texts: int, text: np.ndarray, shingle: np.ndarray, weight: np.ndarray, registers: int
) -> np.ndarray:
    """The shingle that won each register, one row per text; 0 if it has no shingles.

    Arrival ``i`` of a shingle depends on the shingle and ``i`` alone, so equal
    shingles race alike in every document.
    """
    first = np.full(n_texts * registers, np.inf)
    owner = np.zeros(n_texts * registers, np.uint64)
    latest = np.full(n_texts, np.inf)
    clock = np.zeros(len(text))
    state = mix(shingle + _GOLD)
    rate = weight.astype(np.float64)
    while len(text):
        state = mix(state + _GOLD)
        clock = clock - np.log1p(-(state >> np.uint64(11)).astype(np.float64) * _UNIT) / rate
        on = clock < latest[text]
        text, shingle, rate, clock, state = (x[on] for x in (text, shingle, rate, clock, state))
        slot = (mix(state ^ _GOLD) % np.uint64(registers)).astype(np.int64) + text * registers
        np.minimum.at(first, slot, clock)
        won = first[slot] == clock
        owner[slot[won]] = shingle[won]
        racing = text[np.flatnonzero(np.diff(text, prepend=-1))]
        latest[racing] = first.reshape(n_texts, registers)[racing].max(axis=1)
    return owner.reshape(n_texts, registers)


def band_values(owner: np.ndarray, rows: int) -> np.ndarray:
    """One value per band of ``rows`` registers; bands do not share values."""
    n_texts, registers = owner.shape
    bands = registers // rows
    value = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * _GOLD, (n_texts, bands))
    grid = owner[:, : bands * rows].reshape(n_texts, bands, rows)
    for j in range(rows):
        value = mix(value + grid[:, :, j])
    return value


def probability_jaccard(
    a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]
) -> float:
    """Exact J_P of two ``(sorted shingles, weights)``; 0 if either is empty."""
    if not len(a[0]) or not len(b[0]):
        return 0.0
    every = np.union1d(a[0], b[0])
    wa, wb = np.zeros(len(every)), np.zeros(len(every))
    wa[np.searchsorted(every, a[0])] = a[1]
    wb[np.searchsorted(every, b[0])] = b[1]
    both = (wa > 0) & (wb > 0)
    if not both.any():
        return 0.0
    # Of the shingles d', those with a(d') / b(d') >= a(d) / b(d) count by a.
    with np.errstate(divide="ignore"):
        ratio = np.where(wb > 0, wa / np.where(wb > 0, wb, 1), np.inf)
    order = np.argsort(ratio, kind="stable")
    sorted_ratio = ratio[order]
    sum_b = np.append(0.0, np.cumsum(wb[order]))
    sum_a = np.append(0.0, np.cumsum(wa[order]))
    cut = np.searchsorted(sorted_ratio, ratio[both], side="left")
    rest_a, low_b = sum_a[-1] - sum_a[cut], sum_b[cut]
    return float(np.sum(1.0 / (rest_a / wa[both] + low_b / wb[both])))


# Distribution -------------------------------------------------------------

#: A verification cell holds at most about so many queries and members.
CELL_QUERIES = 256
CELL_MEMBERS = 1024


def text_key(text: Column) -> Column:
    """A key of 128 bits that only equal texts share; null and empty are equal."""
    return F.unhex(F.substring(F.sha2(F.coalesce(text, F.lit("")), 256), 1, 32))


def _signed(docs: DataFrame) -> DataFrame:
    """``(doc_id, key, bands)`` per row; equal texts have equal keys."""

    def prepare():
        def bands(column: pa.Array) -> list:
            found = words(*utf8(column))
            owner = signatures(len(column), *profile(found), BANDS * ROWS)
            values = band_values(owner, ROWS).view(np.int64)
            flat = pa.array(values[found.counts > 0].ravel())
            ends = np.append(0, np.cumsum(np.where(found.counts > 0, BANDS, 0)))
            return [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)]

        return bands

    return annotate(
        docs.withColumn("key", text_key(F.col("text"))), "text", prepare, "bands array<bigint>", "signature", drop=("text",)
    ).select("doc_id", "key", F.col("signature.bands").alias("bands"))


def _buckets(distinct: DataFrame) -> DataFrame:
    """``(bucket, key, n)``: members of every band value that several texts share."""
    every = distinct.select("key", F.explode("bands").alias("bucket"))
    shared = every.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    return every.join(shared, "bucket")


def _hub_pairs(buckets: DataFrame) -> DataFrame:
    """``(query, key)``: every member beside the most central member of its bucket.

    The original of a group of copies shares more bands with them than they do
    with each other, so it becomes the hub and most links run through it.
    """
    central = buckets.groupBy("key").agg(F.sum("n").alias("weight"))
    ranked = buckets.join(central, "key").select(
        "bucket", "key", F.struct((-F.col("weight")).alias("weight"), "key").alias("rank")
    )
    hubs = ranked.groupBy("bucket").agg(F.min("rank").key.alias("query"))
    pairs = ranked.join(hubs, "bucket").filter("key != query")
    return pairs.groupBy("query", "key").agg(F.count("*").alias("n_bands")).select("query", "key")


def _hub_cells(pairs: DataFrame) -> DataFrame:
    """``(cell, query, key)``: one query to a cell, its partners dealt over cells."""
    sizes = pairs.groupBy("query").agg(F.count("*").alias("n"))
    parts = F.ceil(F.col("n") / CELL_MEMBERS)
    dealt = pairs.join(sizes, "query").select(
        "query", "key", F.pmod(F.xxhash64("key"), parts).alias("part")
    )
    cell = F.xxhash64("query", "part").alias("cell")
    members = dealt.select(cell, F.lit(False).alias("query"), "key")
    queries = sizes.select("query", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    return members.unionByName(
        queries.select(cell, F.lit(True).alias("query"), F.col("query").alias("key"))
    )


def _rest_cells(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """``(cell, query, key, label)``: what the hubs left open, in blocks.

    Where a bucket still holds several classes, the members outside its largest
    class are compared with all members: so many at a time with so many, as
    blocks of queries that the members stream past. Buckets of the same members
    are one.
    """
    known = buckets.join(labels, "key", "left").select(
        "bucket", "key", F.coalesce("label", "key").alias("label")
    )
    sizes = known.groupBy("bucket", "label").agg(
        F.count("*").alias("n"),
        F.bit_xor(F.xxhash64("key")).alias("x"),
        F.sum(F.xxhash64("key", F.lit(1)) % (1 << 40)).alias("y"),
    )
    opened = (
        sizes.groupBy("bucket")
        .agg(
            F.max(F.struct("n", "label")).alias("main"),
            F.sum("n").alias("n"),
            F.count("*").alias("n_labels"),
            F.bit_xor("x").alias("x"),
            F.sum("y").alias("y"),
        )
        .filter("n_labels > 1 AND n > 2")
        .groupBy("x", "y", "n")
        .agg(F.min(F.struct("bucket", "main")).alias("one"))
        .select(
            F.col("one.bucket").alias("bucket"),
            F.col("one.main.label").alias("main"),
            F.ceil((F.col("n") - F.col("one.main.n")) / CELL_QUERIES).alias("blocks"),
            F.ceil(F.col("n") / CELL_MEMBERS).alias("parts"),
        )
    )
    rows = known.join(opened, "bucket")
    own_block = F.pmod(F.xxhash64("key", F.lit(2)), F.col("blocks"))
    own_part = F.pmod(F.xxhash64("key", F.lit(3)), F.col("parts"))
    last = F.when(F.col("label") != F.col("main"), F.col("parts")).otherwise(0)
    as_query = F.filter(F.sequence(F.lit(0), F.col("parts")), lambda p: p < last)
    places = F.concat(
        F.transform(
            F.sequence(F.lit(0), F.col("blocks") - 1),
            lambda b: F.struct(b.alias("block"), own_part.alias("part"), F.lit(False).alias("query")),
        ),
        F.transform(
            as_query,
            lambda p: F.struct(own_block.alias("block"), p.alias("part"), F.lit(True).alias("query")),
        ),
    )
    return rows.select("bucket", "key", "label", F.explode(places).alias("at")).select(
        F.xxhash64("bucket", "at.block", "at.part").alias("cell"),
        F.col("at.query").alias("query"),
        "key",
        "label",
    )


class _Queries:
    """Profiles of the queries of a cell, indexed by shingle."""

    def __init__(self):
        self.rows: list[tuple[bytes, bytes | None, tuple[np.ndarray, np.ndarray]]] = []
        self.index: tuple | None = None

    def add(self, key, label, shape) -> None:
        self.rows.append((key, label, shape))

    def _build(self) -> tuple:
        every = np.concatenate([s[0] for _, _, s in self.rows])
        weight = np.concatenate([s[1] for _, _, s in self.rows]).astype(float)
        owner = np.repeat(np.arange(len(self.rows)), [len(s[0]) for _, _, s in self.rows])
        order = np.argsort(every, kind="stable")
        keys, first, many = np.unique(every[order], return_index=True, return_counts=True)
        total = np.bincount(owner, weight, len(self.rows))
        return keys, first, many, owner[order], weight[order], total

    def links(self, key, label, shape, similarity: float):
        """Keys of the queries that are similar enough to a member."""
        if self.index is None:
            self.index = self._build()
        keys, first, many, owner, weight, total = self.index
        if not len(keys):
            return
        at = np.searchsorted(keys, shape[0])
        at[at == len(keys)] = 0
        hit = keys[at] == shape[0]
        at, own = at[hit], shape[1][hit].astype(float)
        times = many[at]
        step = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
        place = np.repeat(first[at], times) + step
        who, a, b = owner[place], weight[place], np.repeat(own, times)
        # With A the query's weight and B' what the member does not share, a
        # shared shingle adds at most 1 / (A / a + B' / b) to J_P, and just that
        # where all weights are equal.
        rest = shape[1].sum() - np.bincount(who, b, len(self.rows))
        bound = np.bincount(who, 1 / (total[who] / a + rest[who] / b), len(self.rows))
        for i in np.flatnonzero(bound >= similarity - 1e-9):
            other, other_label, other_shape = self.rows[i]
            if other == key or (label is not None and label == other_label):
                continue
            if probability_jaccard(other_shape, shape) >= similarity - 1e-12:
                yield other


def _links(cells: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """``(a, b)``: the verified links between queries and members of each cell.

    The rows of a cell follow one another, queries first; only the queries are
    held, the members stream past.
    """
    # Cells are independent of each other, so any number may share a task.
    rows = cells.join(texts, "key").withColumn("member", ~F.col("query"))
    placed = rows.repartition("cell").sortWithinPartitions("cell", "member")
    columns = ["cell", "query", "key", "label", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, queries = None, _Queries()
        for batch in slices(batches, "text"):
            found = words(*utf8(batch.column("text")))
            of_text, shingle, weight = profile(found)
            cut = np.searchsorted(of_text, np.arange(batch.num_rows + 1))
            cell, query, key, label = (batch.column(c).to_pylist() for c in columns[:4])
            a, b = [], []
            for i in range(batch.num_rows):
                order = np.argsort(shingle[cut[i] : cut[i + 1]])
                shape = (shingle[cut[i] : cut[i + 1]][order], weight[cut[i] : cut[i + 1]][order])
                if cell[i] != at:
                    at, queries = cell[i], _Queries()
                if query[i]:
                    queries.add(key[i], label[i], shape)
                elif queries.rows:
                    for other in queries.links(key[i], label[i], shape, similarity):
                        a.append(key[i])
                        b.append(other)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"]
            )

    return placed.select(*columns).mapInArrow(run, "a binary, b binary").distinct()


def _texts_of(docs: DataFrame, cells: DataFrame) -> DataFrame:
    """``(key, text)`` of the texts that stand in cells, each once.

    Documents in no cell are sorted out where they are read, by a bit table of
    bounded size, before the rest meet the cells' keys.
    """
    keys = cells.select("key").distinct()
    slot = F.pmod(F.xxhash64("key"), F.lit(_BLOOM_BITS))
    bits = (
        keys.select(slot.alias("slot"))
        .select(
            F.expr("slot div 64").cast("int").alias("word"),
            F.expr("shiftleft(1L, cast(slot % 64 as int))").alias("bit"),
        )
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
        .toArrow()
    )
    table = np.zeros(_BLOOM_BITS // 64, np.int64)
    table[bits.column("word").to_numpy()] = bits.column("bits").to_numpy()
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column("slot").to_numpy()
            keep = (shared.value[at >> 6] >> (at & 63)) & 1
            yield batch.filter(pa.array(keep.astype(bool)))

    keyed = docs.select(text_key(F.col("text")).alias("key"), "text")
    keyed = keyed.select("key", "text", slot.alias("slot"))
    kept = keyed.mapInArrow(run, keyed.schema).select("key", "text")
    return kept.groupBy("key").agg(F.first("text").alias("text"))


#: Bits of the table that sorts out documents without candidates: 2 MB, however
#: many there are; as it fills up it sorts out fewer.
_BLOOM_BITS = 1 << 24


def components(links: DataFrame) -> DataFrame:
    """``(key, label)`` of every key in ``(a, b)`` links; a label is the least key it reaches.

    Alternates the large-star and small-star steps: each hangs a node's
    neighbours under the least of them, until every tree is a star. The rounds
    grow with the logarithm of the longest chain.
    """
    edges = stored(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .filter("u != v")
        .distinct(),
        "edges",
    )
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            both.filter("v > u")
            .join(least, "u")
            .select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
            .distinct()
        )
        large = stored(large, "large_star")
        root = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(root, "u")
        small = small.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(
            small.unionByName(root.select("u", F.col("m").alias("v"))).distinct(), "small_star"
        )
        mark = edges.agg(
            F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u") % (1 << 32))
        ).first()
        if mark == before:
            break
        before = mark
    labels = edges.select(F.col("u").alias("key"), F.col("v").alias("label"))
    roots = edges.select(F.col("v").alias("key"), F.col("v").alias("label")).distinct()
    return stored(labels.unionByName(roots), "labels")


def near_duplicates(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY
) -> DataFrame:
    """``(doc_id, class_id, row_key, class_key)``: one row per row of ``docs``.

    Documents are linked where their texts are equal or their J_P is at least
    ``similarity``; a class is what links connect, and is named by its least
    ``doc_id`` (null only if all its ids are). A null text counts as an empty
    one. Texts without words have no shingles and equal only texts that are the
    same. Repeated rows and repeated ids come back as often as they stand in
    ``docs``. ``row_key`` is the key of the row's text, ``class_key`` that of one of the
    class's texts.
    """
    own = pick(docs, doc_id=doc_id, text=text).withColumn("text", F.coalesce("text", F.lit("")))
    rows = stored(_signed(own), "signed")
    distinct = rows.groupBy("key").agg(
        F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands")
    )
    distinct = stored(distinct, "distinct")
    buckets = stored(_buckets(distinct), "buckets")
    cells = stored(_hub_cells(stored(_hub_pairs(buckets), "pairs")), "hub_cells")
    cells = cells.withColumn("label", F.lit(None).cast("binary"))
    links = stored(_links(cells, _texts_of(own, cells), similarity), "hub_links")
    labels = components(links)
    rest = stored(_rest_cells(buckets, labels), "rest_cells")
    more = stored(_links(rest, _texts_of(own, rest), similarity), "rest_links")
    if not more.isEmpty():
        links = more.unionByName(labels.select(F.col("key").alias("a"), F.col("label").alias("b")))
        labels = components(links)
    classes = distinct.join(labels, "key", "left").select(
        "key", "doc_id", F.coalesce("label", "key").alias("label")
    )
    names = classes.groupBy("label").agg(F.min("doc_id").alias("class_id"))
    named = classes.join(names, "label").select("key", "class_id", "label")
    return (
        rows.select("doc_id", "key")
        .join(named, "key")
        .select("doc_id", "class_id", F.col("key").alias("row_key"), F.col("label").alias("class_key"))
    )
