"""Alignment of two tokenizers over a corpus: which tokens of one meet which of the other.

Texts that are equal are tokenised once: the corpus is shuffled by its full
texts, each distinct text is aligned, and what its pairs of ids count is
weighted with the number of documents that have it.

Both tokenizers begin a token at a blank between two characters that are not
white space. So a text falls into segments that are aligned for themselves. The
texts of a shard share segments, and each is tokenised once for the shard.

Counts of pairs are summed by buckets of A's id: to a bucket come its pairs
from all shards, packed, and the sums go back to the shards in the same way.
What follows for a text comes back to the ids of its documents.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tweetflow.llm.bpe_stream import CUT, byte_alphabet
from tweetflow.llm.frames import bound_batches, packed, pick, shard_number, stored, text_key, unpacked
from tweetflow.llm.words import slices

#: A segment: from a blank up to a blank that stands between two other characters.
SEGMENT = re.compile(r" \S+(?= \S|\Z)|(?s: .*?\S(?= \S))|(?s: .*)")
#: Segments that may be joined to one text without changing their tokens.
_JOINS = re.compile(r" \S(?s:.*\S)?")
#: Such as may be joined, are short and of old scripts only.
_PLAIN = re.compile(r" [!-~\u00a1-\u024f](?:[ -~\u00a1-\u024f]{0,254}[!-~\u00a1-\u024f])?")
#: Bytes of distinct texts in a shard.
SHARD = 4 << 20
#: Characters of joined segments that are tokenised at a time.
_CHUNK = 1 << 16
#: Buckets of pairs at least; as many as there are shuffle partitions if those are more.
BUCKETS = 64
#: Entries of a bucket that are gathered before they are summed.
_GATHER = 1 << 21
#: A text is common if more than one in so many documents has it.
COMMON = 1000


def _byte_level(path: str):
    """Ids of a byte-level vocabulary as functions of text, and the bytes of each id.

    The first function takes any text. The second is faster and gives the same
    for text whose characters are of the same class in every Unicode version; it
    is there where tokens are numbered in the order in which they are merged.
    """
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True  # their strings in a text are plain text
    tokenizer.no_truncation()
    tokenizer.no_padding()
    alphabet = byte_alphabet()
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    table = {
        i: bytes(alphabet[c] for c in token) for token, i in model["vocab"].items() if set(token) <= set(alphabet)
    }
    any_text = lambda text: tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
    singles = [i for i, token in table.items() if len(token) == 1]
    made = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" ", 1))] for m in model["merges"]]
    if made != sorted(set(made)) or max(singles) >= made[0]:
        return any_text, any_text, table
    import tiktoken

    ranks = {token: i for i, token in table.items()}
    known = tiktoken.Encoding("ranks", pat_str=CUT.pattern, mergeable_ranks=ranks, special_tokens={})
    return any_text, known.encode_ordinary, table


def _pieces(path: str):
    """Ids of a piece vocabulary as a function of text, and the bytes of each id.

    Cutting at blanks is only right if no piece has a blank behind another
    character.
    """
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    table = {}
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if "▁" in piece.lstrip("▁"):
            raise ValueError(f"piece {piece!r} goes on behind a blank")
        table[i] = bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()
    encode = lambda text: model.encode(text, num_threads=1)
    return encode, encode, table


def _ends(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])


def _kind(segment: str) -> int:
    if _PLAIN.fullmatch(segment):
        return 0
    return 1 if "▁" not in segment and _JOINS.fullmatch(segment) else 2


def _chunks(kinds: list[int], lengths: list[int]) -> Iterator[tuple[int, int]]:
    """Ranges of segments of one kind that are tokenised at once; the last kind stands alone."""
    begin = size = 0
    for i, (kind, length) in enumerate(zip(kinds, lengths, strict=True)):
        if i > begin and (kind == 2 or size >= _CHUNK or kind != kinds[begin]):
            yield begin, i
            begin, size = i, 0
        size += length
    if begin < len(kinds):
        yield begin, len(kinds)


@dataclass
class Tokens:
    """Tokens of a run of segments: ids, and where each segment's begin."""

    ids: np.ndarray
    sizes: np.ndarray  # bytes of each token
    first: np.ndarray


class Aligner:
    """Aligns runs of texts."""

    def __init__(self, a_path: str, b_path: str):
        self.sides = []
        for encode, encode_plain, table in (_byte_level(a_path), _pieces(b_path)):
            tokens = [table.get(i, b"") for i in range(max(table) + 1)]
            sizes = np.array([*map(len, tokens)], np.int64)
            self.sides.append(((encode_plain, encode, encode), tokens, sizes, list(map(str, range(len(sizes))))))

    def _ids(self, side: int, kind: int, text: str, raw: bytes) -> np.ndarray | None:
        """Ids of segments in a row, None if they do not give back the bytes."""
        encode, tokens, _, _ = self.sides[side]
        # The leading blank is what tokenizer B adds itself.
        ids = encode[kind](text[side:])
        return np.array(ids, np.int64) if b"".join([tokens[i] for i in ids]) == raw else None

    def _run(self, kind: int, segments: list[str]) -> list[tuple[np.ndarray, np.ndarray]] | None:
        """Ids of joinable segments by side, and how many each has; None where bytes differ."""
        text = "".join(segments)
        raw = text.encode()
        lengths = [len(s.encode()) for s in segments] if len(raw) > len(text) else [*map(len, segments)]
        ends, out = np.cumsum(lengths), []
        for side in (0, 1):
            ids = self._ids(side, kind, text, raw)
            if ids is None:
                return None
            out.append((ids, np.diff(_after(np.cumsum(self.sides[side][2][ids]), ends))))
        return out

    def tokens(self, segments: list[str], kinds: list[int]) -> tuple[Tokens, Tokens, np.ndarray]:
        """Tokens of both sides, and which segments both give back; the others have none."""
        whole = np.ones(len(segments), bool)
        found: tuple[list, list] = ([], [])
        none = np.zeros(0, np.int64)
        for a, b in _chunks(kinds, [*map(len, segments)]):
            own = self._run(kinds[a], segments[a:b])
            if own is None:
                for i in range(a, b):
                    own = self._run(2, segments[i : i + 1])
                    whole[i] = own is not None
                    for into, (ids, counts) in zip(found, own or [(none, none[:0])] * 2, strict=True):
                        into.append((ids, counts if own else np.zeros(1, np.int64)))
            else:
                for into, part in zip(found, own, strict=True):
                    into.append(part)
        out = []
        for side, parts in enumerate(found):
            ids = np.concatenate([none, *(ids for ids, _ in parts)])
            counts = np.concatenate([none, *(counts for _, counts in parts)])
            out.append(Tokens(ids, self.sides[side][2][ids], _ends(counts)))
        return out[0], out[1], whole

    def align(self, texts: list[str]) -> Aligned:
        """Measures of the texts, and how often each links which pairs of ids."""
        numbers: dict[str, int] = {}
        number = numbers.setdefault
        rows = [
            np.array([number(s, len(numbers)) for s in SEGMENT.findall(" " + text)] if text else [], np.int64)
            for text in texts
        ]
        # Segments of one kind follow one another.
        kinds = np.fromiter(map(_kind, numbers), np.int64, len(numbers))
        order = np.argsort(kinds, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        rows = [place[row] for row in rows]
        known = list(numbers)
        segments = [known[i] for i in order.tolist()]
        a, b, whole = self.tokens(segments, kinds[order].tolist())
        if not whole.all():
            rows = [row if whole[row].all() else row[:0] for row in rows]

        # Groups: both sides of a segment have the same bytes, so the ends of all
        # segments' tokens can be compared at once.
        a_ends, b_ends = np.cumsum(a.sizes), np.cumsum(b.sizes)
        cuts = np.intersect1d(a_ends, b_ends, assume_unique=True)
        a_to, b_to = _after(a_ends, cuts), _after(b_ends, cuts)
        group_first = np.searchsorted(a_to, a.first)
        n_groups = np.diff(group_first)
        wide, high = np.diff(a_to), np.diff(b_to)
        links = wide * high
        link_first = _ends(links)
        place = np.arange(int(link_first[-1])) - np.repeat(link_first[:-1], links)
        height = np.repeat(high, links)
        pair = a.ids[np.repeat(a_to[:-1], links) + place // np.maximum(height, 1)] << 32
        pair |= b.ids[np.repeat(b_to[:-1], links) + place % np.maximum(height, 1)]

        said = self._written(a, b, a_to.tolist(), b_to.tolist(), group_first.tolist())
        measures = np.stack([np.diff(a.first), np.diff(b.first), n_groups, np.diff(link_first[group_first])])
        flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
        sizes = np.array([len(row) for row in rows], np.int64)
        sums = np.diff(np.concatenate([np.zeros((4, 1), np.int64), np.cumsum(measures[:, flat], axis=1)], axis=1)[:, _ends(sizes)])
        digests = [
            hashlib.sha256(";".join([said[i] for i in row.tolist()]).encode()).hexdigest() if len(row) else ""
            for row in rows
        ]
        return Aligned(sums, digests, *self._links(flat, sizes, pair, link_first[group_first], len(segments)))

    def _written(self, a: Tokens, b: Tokens, a_to: list, b_to: list, group_first: list) -> list[str]:
        """The groups of each segment as text."""
        a_said = [self.sides[0][3][i] for i in a.ids.tolist()]
        b_said = [self.sides[1][3][i] for i in b.ids.tolist()]
        groups = [
            f"{a_said[i]}|{b_said[j]}" if p - i == q - j == 1 else f"{','.join(a_said[i:p])}|{','.join(b_said[j:q])}"
            for i, p, j, q in zip(a_to[:-1], a_to[1:], b_to[:-1], b_to[1:], strict=True)
        ]
        return [";".join(groups[i:j]) for i, j in zip(group_first[:-1], group_first[1:], strict=True)]

    @staticmethod
    def _links(flat: np.ndarray, sizes: np.ndarray, pair: np.ndarray, first: np.ndarray, n_segments: int):
        """The sparse matrix of texts by pairs: indptr, local, links, pairs."""
        text = np.repeat(np.arange(len(sizes)), sizes)
        # Segments that occur, once per text; then the pairs they link.
        cells, often = np.unique(text * max(n_segments, 1) + flat, return_counts=True)
        cell_text, cell_segment = np.divmod(cells, max(n_segments, 1))
        used = np.diff(first)[cell_segment]
        at = np.arange(int(used.sum())) - np.repeat(_ends(used)[:-1], used) + np.repeat(first[:-1][cell_segment], used)
        pairs, local = np.unique(pair[at], return_inverse=True)
        keys = np.repeat(cell_text, used) * max(len(pairs), 1) + local
        entries, inverse = np.unique(keys, return_inverse=True)
        links = np.bincount(inverse, np.repeat(often, used), len(entries)).astype(np.int64)
        row, local = np.divmod(entries, max(len(pairs), 1))
        return np.searchsorted(row, np.arange(len(sizes) + 1)), local, links, pairs


def _after(ends: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """How many tokens have ended at each cut, from 0 on."""
    return np.concatenate([[0], np.searchsorted(ends, cuts) + 1])


@dataclass
class Aligned:
    """What a run of texts links: measures per text, and a sparse matrix of texts by pairs."""

    measures: np.ndarray  # n_a, n_b, n_groups, n_links by text
    digests: list[str]
    indptr: np.ndarray
    local: np.ndarray
    links: np.ndarray
    pairs: np.ndarray  # a << 32 | b


@cache
def _aligner(a_path: str, b_path: str) -> Aligner:
    """One per process; a worker is used for many tasks."""
    return Aligner(a_path, b_path)


def _lists(values, kind: pa.DataType) -> pa.ListArray:
    """One list that holds all values."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, kind))


def _deltas(values: np.ndarray) -> bytes:
    return packed(np.diff(values, prepend=0))


def _values(blob: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(unpacked(blob), np.int64))


def _numbers(blob: bytes) -> np.ndarray:
    return np.frombuffer(unpacked(blob), np.int64)


_LONGS = ("t1s", "t2s", "copies", "n_as", "n_bs", "n_groups", "n_links")
_BLOBS = ("indptr", "local", "links")
_SHARD = (
    "shard bigint, "
    + ", ".join(f"{c} array<bigint>" for c in _LONGS)
    + ", digests array<string>, "
    + ", ".join(f"{c} binary" for c in _BLOBS)
)
_PACK = "struct<pairs:binary,held:binary>"


def aligned_shards(texts: DataFrame, a_path: str, b_path: str, buckets: int) -> DataFrame:
    """Alignments of ``(text, copies, t1, t2)``, a row per run of texts.

    ``indptr``, ``local`` and ``links`` say how often each text links each pair of
    the shard; ``packs`` has those pairs (``a << 32 | b``) by bucket, and in how
    many documents each is held.
    """
    bound_batches(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, numbers = _aligner(a_path, b_path), shard_number()
        for batch in slices(batches, "text", SHARD):
            shard = aligner.align(batch.column("text").to_pylist())
            copies = batch.column("copies").to_numpy()
            held = np.bincount(shard.local, np.repeat(copies, np.diff(shard.indptr)), len(shard.pairs)).astype(np.int64)
            bucket = (shard.pairs >> 32) % buckets
            order = np.argsort(bucket, kind="stable")
            number = np.empty(len(order), np.int64)
            number[order] = np.arange(len(order))
            pairs, held = shard.pairs[order], held[order]
            ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
            packs = [
                {"pairs": _deltas(pairs[a:b]), "held": packed(held[a:b])} if b > a else None
                for a, b in zip(ends[:-1], ends[1:], strict=True)
            ]
            long = pa.int64()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([next(numbers)], long),
                    *(_lists(batch.column(c), long) for c in ("t1", "t2", "copies")),
                    *(_lists(column, long) for column in shard.measures),
                    _lists(shard.digests, pa.string()),
                    *(pa.array([packed(x)], pa.binary()) for x in (shard.indptr, number[shard.local], shard.links)),
                    _lists(packs, pa.struct([("pairs", pa.binary()), ("held", pa.binary())])),
                ],
                names=["shard", *_LONGS, "digests", *_BLOBS, "packs"],
            )

    return texts.mapInArrow(run, f"{_SHARD}, packs array<{_PACK}>")


def _packs(shards: DataFrame) -> DataFrame:
    return shards.select("shard", F.posexplode("packs").alias("bucket", "pack")).filter("pack IS NOT NULL")


def _summed(shards: DataFrame, buckets: int) -> DataFrame:
    """``(bucket, pairs, n, best)``: the documents that hold each pair, in a row per bucket.

    A task holds the distinct pairs of one bucket at a time. All pairs of an id
    of A are in one bucket, so which of them has most is known there.
    """

    def total(pairs: list[np.ndarray], held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        distinct, inverse = np.unique(np.concatenate(pairs), return_inverse=True)
        # bincount sums in floats, exact up to 2**53 documents.
        return distinct, np.bincount(inverse, np.concatenate(held), len(distinct)).astype(np.int64)

    def written(bucket: int, pairs: list[np.ndarray], held: list[np.ndarray]) -> pa.RecordBatch:
        distinct, n = total(pairs, held)
        _, first = np.unique(distinct >> 32, return_index=True)
        most = np.repeat(np.maximum.reduceat(n, first), np.diff(np.append(first, len(n))))
        columns = [pa.array([bucket], pa.int32())]
        columns += [pa.array([x], pa.binary()) for x in (_deltas(distinct), packed(n), packed((n == most).astype(np.int64)))]
        return pa.RecordBatch.from_arrays(columns, names=["bucket", "pairs", "n", "best"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, pairs, held, size = None, [], [], 0
        for batch in batches:
            for bucket, pack in zip(batch.column("bucket").to_pylist(), batch.column("pack"), strict=True):
                if bucket != current:
                    if pairs:
                        yield written(current, pairs, held)
                    current, pairs, held, size = bucket, [], [], 0
                pack = pack.as_py()
                pairs.append(_values(pack["pairs"]))
                held.append(_numbers(pack["held"]))
                size += len(pairs[-1])
                if size > _GATHER + 2 * len(pairs[0]):
                    pairs, held = ([x] for x in total(pairs, held))
                    size = len(pairs[0])
        if pairs:
            yield written(current, pairs, held)

    dealt = _packs(shards).repartition(buckets, "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(run, "bucket int, pairs binary, n binary, best binary")


def _answered(shards: DataFrame, summed: DataFrame, buckets: int) -> DataFrame:
    """``(shard, bucket, n, best)``: the sums for the pairs of each shard, in their order."""
    asked = _packs(shards).select("shard", "bucket", F.col("pack.pairs").alias("pairs"))
    both = asked.unionByName(summed, allowMissingColumns=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: tuple[np.ndarray, ...] = ()
        for batch in batches:
            out = []
            for row in (row for i in range(batch.num_rows) for row in batch.slice(i, 1).to_pylist()):
                if row["shard"] is None:
                    known = (_values(row["pairs"]), _numbers(row["n"]), _numbers(row["best"]))
                    continue
                at = np.searchsorted(known[0], _values(row["pairs"]))
                out.append((row["shard"], row["bucket"], packed(known[1][at]), packed(known[2][at])))
            columns = zip(*out, strict=True) if out else [[]] * 4
            kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["shard", "bucket", "n", "best"]
            )

    # The sums of a bucket come before what is asked of them.
    dealt = both.repartition(buckets, "bucket").sortWithinPartitions("bucket", F.col("shard").asc_nulls_first())
    return dealt.mapInArrow(run, "shard bigint, bucket int, n binary, best binary")


def pair_counts(summed: DataFrame) -> DataFrame:
    """``(a, b, n, is_best)``: the documents that hold a pair, and whether no pair of A's id has more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                pairs = _values(row["pairs"])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(pairs >> 32, pa.int64()),
                        pa.array(pairs & ((1 << 32) - 1), pa.int64()),
                        pa.array(_numbers(row["n"])),
                        pa.array(_numbers(row["best"]) == 1),
                    ],
                    names=["a", "b", "n", "is_best"],
                )

    return summed.mapInArrow(run, "a bigint, b bigint, n bigint, is_best boolean")


MEASURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def _measures(shards: DataFrame) -> DataFrame:
    """A row per distinct text from shards that know the sums of their pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(i, 1) for whole in batches for i in range(whole.num_rows)):
            found = batch.column("found")[0].as_py() or []
            n, best = (
                np.concatenate([np.zeros(0, np.int64), *(_numbers(x[c]) for x in found)]) for c in ("n", "best")
            )
            indptr, local, links = (_numbers(batch.column(c)[0].as_py()) for c in _BLOBS)
            own = {c: batch.column(c)[0].values for c in (*_LONGS, "digests")}
            best_sum, count_sum = (pa.array(np.diff(_ends(links * x[local])[indptr])) for x in (best, n))
            yield pa.RecordBatch.from_arrays(
                [*(own[c] for c in _LONGS), best_sum, count_sum, own["digests"]], names=["t1", "t2", "copies", *MEASURES]
            )

    kinds = ", ".join(f"{m} {'string' if m == 'groups_sha256' else 'bigint'}" for m in MEASURES)
    return shards.mapInArrow(run, f"t1 bigint, t2 bigint, copies bigint, {kinds}")


def align(
    docs: DataFrame,
    a_path: str,
    b_path: str,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    buckets: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``(doc_id, *MEASURES)`` for each row of ``docs``, and the counts of all pairs of ids.

    Paths name a byte-level vocabulary (A) and a piece vocabulary (B) on every
    executor; A reads a blank and the text. A null or empty text, or one that
    either tokenizer does not give back byte by byte, has no tokens: zeros, and
    an empty digest. Each row is a document, repeated rows and null ids
    included. ``n_best`` and ``count_sum`` follow the counts over all documents.
    More ``buckets`` make fewer pairs to sum in a task.
    """
    buckets = buckets or max(BUCKETS, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    own = pick(docs, doc_id=doc_id, text=text).withColumn("text", F.coalesce("text", F.lit("")))
    t1, t2 = text_key(F.col("text"))
    texts = own.groupBy("text").agg(F.count("*").alias("copies")).withColumns({"t1": t1, "t2": t2})
    shards = stored(aligned_shards(texts, a_path, b_path, buckets), "aligned")
    summed = stored(_summed(shards, buckets), "summed")
    # A row per bucket to a shard.
    found = F.sort_array(F.collect_list(F.struct("bucket", "n", "best"))).alias("found")
    back = _answered(shards, summed, buckets).groupBy("shard").agg(found)
    measured = stored(_measures(shards.drop("packs").join(back, "shard", "left")), "measures")

    # A text that many documents have is no key of a shuffle. There are fewer
    # than COMMON such texts, whatever the size of the corpus.
    n_rows = measured.agg(F.sum("copies")).first()[0] or 0
    is_common = F.col("copies") * COMMON > n_rows
    common = measured.filter(is_common).drop("copies").withColumn("known", F.lit(True))
    keyed = own.withColumns({"t1": t1, "t2": t2}).drop("text").join(F.broadcast(common), ["t1", "t2"], "left")
    rare = keyed.filter(F.col("known").isNull()).select("doc_id", "t1", "t2")
    rare = rare.join(measured.filter(~is_common), ["t1", "t2"])
    every = keyed.filter(F.col("known")).select("doc_id", *MEASURES).unionByName(rare.select("doc_id", *MEASURES))
    return every, pair_counts(summed)
