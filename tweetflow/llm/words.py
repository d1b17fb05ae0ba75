"""Words and shingles of many texts at once, as NumPy arrays over UTF-8 bytes.

A word is a longest run of ASCII letters, digits and non-ASCII characters; A-Z
are lowered first. In UTF-8 every byte of a non-ASCII character is 0x80 or
more, so the runs can be cut byte by byte.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: The characters that do not belong to words, as a pattern for whole texts.
WORD_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_PIECE = 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)
_GOLD = 0x9E3779B97F4A7C15


def _word_bytes() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[ord("A") : ord("Z") + 1] += 32
    keep = np.zeros(256, bool)
    keep[ord("0") : ord("9") + 1] = True
    keep[ord("a") : ord("z") + 1] = True
    keep[ord("A") : ord("Z") + 1] = True
    keep[128:] = True
    table[~keep] = 0
    return table


#: Lowered byte, or 0 for a byte outside words.
WORD_BYTE = _word_bytes()


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values: a bijection whose every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the offsets of its texts; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64 if wide else np.int32)
    ends = ends[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    if len(column) == 0:
        return raw[:0], np.zeros(1, np.int64)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def slices(
    batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = 2 << 20
) -> Iterator[pa.RecordBatch]:
    """The batches again, cut so that one holds about ``max_bytes`` of ``column``.

    A single longer text is a slice of its own.
    """
    for batch in batches:
        _, ends = utf8(batch.column(column))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(ends, ends[at] + max_bytes, side="right")) - 1
            to = min(max(to, at + 1), batch.num_rows)
            yield batch.slice(at, to - at)
            at = to


@dataclass
class Words:
    """Words of a run of texts.

    ``hashes``, ``starts`` and ``ends`` have one entry per word; the words of
    text ``i`` are those from ``first[i]`` to ``first[i + 1]``. Starts and ends
    are byte positions in the run.
    """

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def _piece_words(low: np.ndarray, breaks: np.ndarray):
    """Starts, ends and hashes of the words in one piece of lowered bytes.

    ``breaks`` are positions where a text begins; no word runs across one.
    """
    inside = low != 0
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    before[breaks] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1:] = False
    after[:-1] = inside[1:]
    cut = breaks[breaks > 0] - 1
    after[cut] = False
    ends = np.flatnonzero(inside & ~after) + 1
    if not len(starts):
        return starts, ends, np.zeros(0, np.uint64)
    lengths = ends - starts
    letters = low[inside].astype(np.uint64)
    heads = np.cumsum(lengths) - lengths
    place = np.arange(len(letters)) - np.repeat(heads, lengths)
    powers = np.full(int(lengths.max()), _ODD)
    powers[0] = 1
    np.multiply.accumulate(powers, out=powers)
    sums = np.add.reduceat(letters * powers[place], heads)
    return starts, ends, mix(sums + lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """All words of the texts that ``offsets`` cut out of ``data``.

    Long runs are worked off in pieces that end between words, so the working
    memory beside the result does not grow with the length of a text.
    """
    found = []
    at, end = 0, len(data)
    while at < end:
        to = min(at + _PIECE, end)
        low = WORD_BYTE[data[at:to]]
        while to < end:
            # Back to the last byte outside words, or on if there is none.
            gaps = np.flatnonzero(low[-4096:] == 0)
            if len(gaps):
                keep = len(low) - len(low[-4096:]) + int(gaps[-1]) + 1
                low, to = low[:keep], at + keep
                break
            more = WORD_BYTE[data[to : to + _PIECE]]
            to += len(more)
            low = np.concatenate([low, more])
        lo, hi = np.searchsorted(offsets, [at, to])
        starts, ends, hashes = _piece_words(low, offsets[lo:hi] - at)
        found.append((starts + at, ends + at, hashes))
        at = to
    if not found:
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), none, none, np.zeros(len(offsets), np.int64))
    starts, ends, hashes = (np.concatenate(x) for x in zip(*found, strict=True))
    return Words(hashes, starts, ends, np.searchsorted(starts, offsets).astype(np.int64))


def grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each word on; they may run past a text's end."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j in range(size):
        factor = np.uint64((_GOLD * (2 * j + 1)) % (1 << 64))
        total += hashes[j : j + n] * factor
    return mix(total)


def shingles(found: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all word shingles, and the number of the text each is from.

    A text of fewer words than ``size``, but not none, has one shingle of all
    its words. Texts follow one another in order.
    """
    counts = found.counts
    per_text = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    out = np.zeros(int(per_text.sum()), np.uint64)
    text = np.repeat(np.arange(len(counts)), per_text)
    begin = np.cumsum(per_text) - per_text
    place = np.arange(len(out)) - np.repeat(begin, per_text) + np.repeat(found.first[:-1], per_text)
    full = counts[text] >= size
    every = grams(found.hashes, size)
    out[full] = every[place[full]]
    for i in np.flatnonzero(~full):
        lo, hi = found.first[text[i]], found.first[text[i] + 1]
        out[i] = grams(found.hashes[lo:hi], int(hi - lo))[0]
    return out, text


def lower_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> bytes:
    """The given words, lowered and joined by spaces, as they are compared."""
    return b" ".join(WORD_BYTE[data[s:e]].tobytes() for s, e in zip(starts, ends, strict=True))
