"""Lines that many documents hold, found by their hashes, dropped by bitmaps.

Each document gives one row per distinct line: the hash of the line, the id of
the document and the positions. The rows are dealt by range over hash and
document and sorted, so a line that every document holds spreads over as many
ranges as its rows need. A task reads its range once and holds back no more rows
than documents are needed to drop a line. Only of the first and last line of a
range other ranges may hold more; what those two count is summed afterwards.

What goes back to the documents is a compressed bitmap per document, not text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tweetflow.llm.frames import annotate, bound_batches, pick, stored, text_key
from tweetflow.llm.words import slices

#: Characters that are stripped from a line before lines are compared.
BLANKS = " \t\n\v\f\r"
#: Code points that a line must have left to be compared.
LEAST_CHARS = 1
#: Documents that must hold a line for it to be dropped.
LEAST_DOCUMENTS = 10

#: Documents that a task remembers, so that repeated rows are read once.
_SEEN = 1 << 16


def _line_rows(docs: DataFrame, least_chars: int) -> DataFrame:
    """``(h1, h2, doc_id, k1, k2, positions)``: a row per document and distinct line."""
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in slices(batches, "text"):
            keys = list(zip(batch.column("k1").to_pylist(), batch.column("k2").to_pylist(), strict=True))
            new = []
            for key in keys:
                new.append(key not in seen)
                if len(seen) >= _SEEN:
                    seen.clear()
                seen.add(key)
            batch = batch.filter(pa.array(new, pa.bool_()))
            lines = pc.split_pattern(batch.column("text"), "\n")
            text = pc.list_parent_indices(lines).to_numpy()
            place = np.arange(len(text)) - np.asarray(lines.offsets)[:-1][text] + lines.offsets[0].as_py()
            cut = pc.ascii_lower(pc.ascii_trim(lines.flatten(), characters=BLANKS))
            some = np.flatnonzero(pc.greater_equal(pc.utf8_length(cut), least_chars).to_numpy(zero_copy_only=False))
            cut = cut.take(pa.array(some))
            digests = b"".join(map(xxhash.xxh3_128_digest, cut.to_pylist()))
            h1, h2 = np.frombuffer(digests, np.int64).reshape(-1, 2).T
            text, place = text[some], place[some]
            order = np.lexsort((h2, h1, text))
            h1, h2, text, place = h1[order], h2[order], text[order], place[order]
            first = np.ones(len(order), bool)
            first[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1]) | (text[1:] != text[:-1])
            at = np.flatnonzero(first)
            rows = pa.array(text[at])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(h1[at]),
                    pa.array(h2[at]),
                    *(batch.column(c).take(rows) for c in ("doc_id", "k1", "k2")),
                    pa.ListArray.from_arrays(
                        pa.array(np.append(at, len(order)), pa.int32()), pa.array(place, pa.int32())
                    ),
                ],
                names=["h1", "h2", "doc_id", "k1", "k2", "positions"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", "k1", "k2").mapInArrow(
        run, f"h1 bigint, h2 bigint, doc_id {kind}, k1 bigint, k2 bigint, positions array<int>"
    )


_DROPPED, _OPEN, _COUNT = 0, 1, 2


class _Runs:
    """Reads sorted rows, gives back those of lines that enough documents hold.

    Rows of a line that has not enough documents yet are held back. Of the first
    and the last line of the range the number of documents is given as well, and
    the rows held back as open: other ranges decide on them.
    """

    def __init__(self, least: int):
        self.least = least
        self.line: tuple[int, int] | None = None
        self.document: tuple[int, int] | None = None
        self.documents = 0
        self.held: list[pa.RecordBatch] = []
        self.is_first = True

    @staticmethod
    def _out(rows: pa.RecordBatch, kind: int) -> pa.RecordBatch:
        n = rows.num_rows
        columns = [pa.array(np.full(n, kind, np.int32)), *rows.columns, pa.array(np.zeros(n, np.int64))]
        return pa.RecordBatch.from_arrays(columns, names=["kind", *rows.schema.names, "n"])

    def _close(self, is_last: bool, empty: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """The line that has been read to its end, or to the end of the range."""
        if self.line is None:
            return
        if self.is_first or is_last:
            for rows in self.held:
                yield self._out(rows, _OPEN)
            h1, h2 = self.line
            nulls = [pa.nulls(1, f.type) for f in empty.schema][2:]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([_COUNT], pa.int32()), pa.array([h1]), pa.array([h2]), *nulls,
                    pa.array([self.documents], pa.int64()),
                ],
                names=["kind", *empty.schema.names, "n"],
            )
        self.is_first = False
        self.held, self.documents = [], 0

    def _add(self, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """More rows, of distinct documents, of the line that is open."""
        self.documents += rows.num_rows
        self.held.append(rows)
        if self.documents >= self.least:
            yield from (self._out(held, _DROPPED) for held in self.held)
            self.held = []

    def read(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch = None
        for batch in batches:
            if not batch.num_rows:
                continue
            h1, h2, k1, k2 = (batch.column(c).to_numpy() for c in ("h1", "h2", "k1", "k2"))
            line = np.ones(len(h1), bool)
            line[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
            line[0] = (int(h1[0]), int(h2[0])) != self.line
            fresh = line.copy()
            fresh[1:] |= (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])
            fresh[0] |= (int(k1[0]), int(k2[0])) != self.document
            rows = np.flatnonzero(fresh)
            kept = batch.take(pa.array(rows))
            starts = np.flatnonzero(line[rows])
            head = int(starts[0]) if len(starts) else len(rows)
            if head:
                yield from self._add(kept.slice(0, head))
            if len(starts):
                yield from self._close(False, batch)
                last = int(starts[-1])
                # A range's first line may end with this batch's first rows.
                begin = 0
                if self.line is None and len(starts) > 1:
                    self._open(kept, int(starts[0]))
                    yield from self._add(kept.slice(starts[0], starts[1] - starts[0]))
                    yield from self._close(False, batch)
                    begin = 1
                if len(starts) - 1 > begin:
                    sizes = np.diff(starts[begin:])
                    enough = np.repeat(sizes >= self.least, sizes)
                    middle = kept.slice(int(starts[begin]), last - int(starts[begin])).filter(pa.array(enough))
                    if middle.num_rows:
                        yield self._out(middle, _DROPPED)
                self._open(kept, last)
                yield from self._add(kept.slice(last))
            self.document = (int(k1[-1]), int(k2[-1]))
        if batch is not None:
            yield from self._close(True, batch)

    def _open(self, rows: pa.RecordBatch, at: int) -> None:
        self.line = (rows.column("h1")[at].as_py(), rows.column("h2")[at].as_py())


def packed(positions: list[int]) -> bytes:
    """A keep bitmap, deflated: a bit per line up to the last that is dropped, 0 for those dropped."""
    dropped = np.zeros(max(positions, default=-1) + 1, bool)
    dropped[positions] = True
    return zlib.compress((~np.packbits(dropped)).tobytes(), 1)


def keeps(bitmap: bytes | None, n_lines: int) -> np.ndarray:
    """Which lines a bitmap keeps; lines beyond it are kept, and all without one."""
    keep = np.ones(n_lines, bool)
    if bitmap is not None:
        bits = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8))[:n_lines]
        keep[: len(bits)] = bits.astype(bool)
    return keep


def keep_bitmaps(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    least_documents: int = LEAST_DOCUMENTS,
    least_chars: int = LEAST_CHARS,
) -> DataFrame:
    """``(k1, k2, n_dropped, keep)`` for each document that loses lines.

    ``k1, k2`` stand for id and text together: rows that agree in both are one
    document. A line is dropped, wherever it stands, if its key is found in
    ``least_documents`` documents; the key is the line without ``BLANKS`` at both
    ends, A-Z lowered, and has ``least_chars`` code points or more. A null text
    is empty. A task holds back at most ``least_documents`` rows.
    """
    own = pick(docs, doc_id=doc_id, text=text)
    k1, k2 = text_key(F.col("doc_id"), F.coalesce("text", F.lit("")))
    own = own.withColumns({"text": F.coalesce("text", F.lit("")), "k1": k1, "k2": k2})
    by = ["h1", "h2", "doc_id", "k1", "k2"]
    rows = stored(_line_rows(own, least_chars), "lines")
    ranged = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    kind = own.schema["doc_id"].dataType.simpleString()
    found = ranged.mapInArrow(
        lambda batches: _Runs(least_documents).read(batches),
        f"kind int, h1 bigint, h2 bigint, doc_id {kind}, k1 bigint, k2 bigint, positions array<int>, n bigint",
    )
    found = stored(found, "found")
    # Two rows per range at most.
    counts = found.filter(F.col("kind") == _COUNT).groupBy("h1", "h2").agg(F.sum("n").alias("n"))
    counts = counts.filter(F.col("n") >= least_documents).select("h1", "h2")
    open_rows = found.filter(F.col("kind") == _OPEN).join(counts, ["h1", "h2"], "left_semi")
    dropped = found.filter(F.col("kind") == _DROPPED).select("k1", "k2", "positions")
    dropped = dropped.unionByName(open_rows.select("k1", "k2", "positions"))
    # A document's distinct lines; each comes once.
    lines = dropped.groupBy("k1", "k2").agg(F.flatten(F.collect_list("positions")).alias("positions"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            positions = batch.column("positions").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("k1"),
                    batch.column("k2"),
                    pa.array([len(p) for p in positions], pa.int64()),
                    pa.array(map(packed, positions), pa.binary()),
                ],
                names=["k1", "k2", "n_dropped", "keep"],
            )

    return lines.mapInArrow(pack, "k1 bigint, k2 bigint, n_dropped bigint, keep binary")


def without_lines(
    docs: DataFrame,
    bitmaps: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    into: str = "deduplicated",
    drop: tuple[str, ...] = (),
) -> DataFrame:
    """``docs`` with a struct ``into``: n_lines, n_dropped, text.

    A document's lines are what newlines part it into, so a null or empty text
    has one empty line; ``text`` joins those that its bitmap keeps. ``bitmaps``
    come from ``keep_bitmaps`` over the same documents.
    """
    names = [f"_{into}_{c}" for c in ("k1", "k2", "keep")]
    k1, k2 = text_key(F.col(doc_id), F.coalesce(text, F.lit("")))
    own = docs.withColumns({names[0]: k1, names[1]: k2})
    maps = bitmaps.select(*(F.col(c).alias(n) for c, n in zip(("k1", "k2", "keep"), names, strict=True)))
    joined = own.join(maps, names[:2], "left").select(*docs.columns, names[2])

    def cut(texts: pa.Array, maps: pa.Array) -> list:
        n_lines, n_dropped, kept = [], [], []
        for value, bitmap in zip(texts.to_pylist(), maps.to_pylist(), strict=True):
            lines = (value or "").split("\n")
            n_lines.append(len(lines))
            if bitmap is not None:
                keep = keeps(bitmap, len(lines))
                lines = [lines[i] for i in np.flatnonzero(keep)]
                value = "\n".join(lines)
            n_dropped.append(n_lines[-1] - len(lines))
            kept.append(value or "")
        return [n_lines, n_dropped, kept]

    return annotate(
        joined, text, lambda: cut, "n_lines bigint, n_dropped bigint, text string", into, (*drop, names[2]),
        beside=(names[2],),
    )
