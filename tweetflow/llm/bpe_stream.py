"""Byte-level BPE as a streaming transducer with bounded lookahead.

Whether a token that has been read can still change depends only on so many
bytes behind it, however the text goes on; that number follows from the merge
list. ``Transducer`` reads bytes into a window, encodes the window and emits
the tokens that lie at least that far behind its end; the rest is encoded again
when more has been read. Its memory does not grow with the text.

A window is encoded without running the merge list over it. Two tokens may
stand side by side if merging their joined bytes gives just these two, and
there is one way to cut the bytes into tokens that may all do so. It is looked
for from the left, longest token first; places that turn out to lead nowhere
are remembered.

Decoding is a state machine from bytes to text that holds at most the beginning
of one character.
"""

from __future__ import annotations

import codecs
import json
import re
from collections.abc import Iterable, Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tweetflow.llm.frames import annotate, bound_batches, pick

#: Fixed value: the pattern that cuts a text before byte-level BPE.
CUT = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


#: Runs up to this many characters are kept with their tokens.
_KEPT = 64
#: Characters of a text that are read at a time.
PIECE = 1 << 16
#: A run is final once so many characters behind it are known: contractions have three.
_MARGIN = 3
#: What a run of the pattern consists of, but for a blank before it.
_LETTERS, _NUMBERS, _OTHERS, _SPACES = map(regex.compile, (r"\p{L}+", r"\p{N}+", r"[^\s\p{L}\p{N}]+", r"\s+"))
#: Letters up to U+024F with signs behind them: two runs of the pattern at most.
_WORD = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([.,;:!?#$%&*|)]*)")
_TOKEN = -1
_SPACE = frozenset(regex.findall(r"\s", "".join(map(chr, range(0x3001)))))
#: Entries of the caches before they are begun anew.
_CACHE = 1 << 18


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins that the vocabulary file writes for the 256 bytes."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Merges:
    """Vocabulary, merge ranks and what follows from them."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        alphabet = byte_alphabet()
        to_bytes = lambda text: bytes(alphabet[c] for c in text)
        model = content["model"]
        added = {t["content"]: t["id"] for t in content.get("added_tokens", [])}
        self.special = added
        self.bytes_of = {
            number: to_bytes(text) for text, number in model["vocab"].items() if text not in added
        }
        self.bytes_of |= {number: text.encode() for text, number in added.items()}
        self.vocab = {
            to_bytes(text): number for text, number in model["vocab"].items() if text not in added
        }
        pairs = (m if isinstance(m, list) else m.split(" ", 1) for m in model["merges"])
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        self.made_at: dict[int, int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        for rank, (a, b) in enumerate(pairs):
            left, right = self.vocab[to_bytes(a)], self.vocab[to_bytes(b)]
            whole = self.vocab[to_bytes(a + b)]
            self.rank[left, right] = (rank, whole)
            if whole in self.made_at:
                raise ValueError(f"two merges make {a + b!r}")
            self.made_at[whole] = rank
            self.parts[whole] = (left, right)
        self.single = [self.vocab[bytes([b])] for b in range(256)]
        self.longest = max(map(len, self.vocab))
        self.lookahead = self._sufficient_lookahead()
        #: Tokens by their bytes; a node holds its children by byte, and the
        #: token that has been read there at _TOKEN.
        self.forward: dict = {}
        for text, token in self.vocab.items():
            node = self.forward
            for byte in text:
                node = node.setdefault(byte, {})
            node[_TOKEN] = token
        #: Nodes two bytes deep, each with the longest token up to there.
        self.pairs = {
            bytes([a, b]): (node, node.get(_TOKEN, self.single[a]))
            for a, first in self.forward.items()
            for b, node in first.items()
            if b != _TOKEN
        }
        self.size = {token: len(text) for text, token in self.vocab.items()}
        #: The longest token that is a proper beginning of a token.
        self.shorter: dict[int, int | None] = {}
        for text, token in self.vocab.items():
            starts = (self.vocab.get(text[:n]) for n in range(len(text) - 1, 0, -1))
            self.shorter[token] = next((t for t in starts if t is not None), None)
        self._beside: dict[tuple[int, int], bool] = {}

    def _sufficient_lookahead(self) -> int:
        """Bytes behind a token that can still change it, at most.

        What takes bytes away from a token, or adds some to it, is another token
        that reaches over its end. That one forms or not depending on what
        follows, but only an earlier merge can take bytes from it in turn. So the
        reach of a token is that of the earlier merges that begin inside it:
        ``reach(t) = max over t' made earlier, whose proper beginning is a proper
        end of t, of len(t') - overlap + reach(t')``. Merges are taken in order,
        so every reach is known when it is asked for.
        """
        begun: dict[bytes, int] = {}
        most = 0
        for token in sorted(self.made_at, key=self.made_at.__getitem__):
            text = self.bytes_of[token]
            reach = max((begun.get(text[i:], 0) for i in range(1, len(text))), default=0)
            for i in range(1, len(text)):
                beyond = len(text) - i + reach
                if begun.get(text[:i], 0) < beyond:
                    begun[text[:i]] = beyond
            most = max(most, len(text) - 1 + reach)
        return most

    def merge(self, text: bytes) -> list[int]:
        """The encoding of a short run by the merge list itself."""
        tokens = [self.single[b] for b in text]
        rank = self.rank
        while len(tokens) > 1:
            best, at = None, -1
            for i in range(len(tokens) - 1):
                found = rank.get((tokens[i], tokens[i + 1]))
                if found is not None and (best is None or found < best):
                    best, at = found, i
            if best is None:
                break
            left, right, whole = tokens[at], tokens[at + 1], best[1]
            out, i = [], 0
            while i < len(tokens):
                if i + 1 < len(tokens) and tokens[i] == left and tokens[i + 1] == right:
                    out.append(whole)
                    i += 2
                else:
                    out.append(tokens[i])
                    i += 1
            tokens = out
        return tokens

    def beside(self, left: int, right: int) -> bool:
        """Whether the two tokens stay apart when their bytes are merged."""
        known = self._beside.get((left, right))
        if known is None:
            if len(self._beside) >= _CACHE:
                self._beside.clear()
            known = self._beside[left, right] = self._stay_apart(left, right)
        return known

    def _stay_apart(self, left: int, right: int) -> bool:
        """Undo the merges of both tokens, latest first, and watch their border.

        While two parts face each other at the border they must not be merged:
        their merge, if there is one, has to come after the one by which either
        of them goes on. Of equal merges the left one comes first.
        """
        made, parts, rank = self.made_at, self.parts, self.rank
        left_until = right_until = len(self.rank)
        while True:
            across = rank.get((left, right))
            if across is not None and across[0] < left_until and across[0] <= right_until:
                return False
            made_left, made_right = made.get(left, -1), made.get(right, -1)
            if made_left > made_right:
                left_until, left = made_left, parts[left][1]
            elif made_right >= 0:
                right_until, right = made_right, parts[right][0]
            else:
                return True

    def cut(self, data: bytes, before: int | None) -> list[int]:
        """The tokens of ``data`` that may stand side by side, and behind ``before``."""
        size, shorter, beside = self.size, self.shorter, self.beside
        known, pairs, single = self._beside, self.pairs, self.single
        tokens: list[int] = []
        dead: set[int] = set()
        at, end, last = 0, len(data), before
        while at < end:
            # The longest token that begins here; single bytes are tokens, and two
            # bytes lead to where they and the token among them are known.
            found = pairs.get(data[at : at + 2])
            if found is None:
                token = single[data[at]]
            else:
                node, token = found
                place = at + 2
                while place < end and (node := node.get(data[place])) is not None:
                    place += 1
                    if _TOKEN in node:
                        token = node[_TOKEN]
            while True:
                while token is not None:
                    if not dead or at + size[token] not in dead:
                        fits = last is None or known.get((last, token))
                        if fits or fits is None and beside(last, token):
                            break
                    token = shorter[token]
                if token is not None:
                    break
                # Nothing fits here: go on with less of the token before.
                dead.add(at)
                token = tokens.pop()
                at -= size[token]
                last = tokens[-1] if tokens else before
                token = shorter[token]
            tokens.append(token)
            at += size[token]
            last = token
        return tokens


class Transducer:
    """Reads the bytes of one run, gives back token ids as soon as they are final."""

    def __init__(self, merges: Merges):
        self.merges = merges
        #: Bytes that are read before a window is encoded.
        self.window = 4 * (merges.lookahead + merges.longest)
        self._held = bytearray()
        self._before: int | None = None

    def push(self, data: bytes) -> list[int]:
        """Read on; the tokens that have become final."""
        self._held += data
        if len(self._held) < self.window:
            return []
        stable = len(self._held) - self.merges.lookahead
        final, reached = [], 0
        for token in self.merges.cut(bytes(self._held), self._before):
            reached += self.merges.size[token]
            if reached > stable:
                break
            final.append(token)
        if final:
            del self._held[: sum(self.merges.size[t] for t in final)]
            self._before = final[-1]
        return final

    def finish(self) -> list[int]:
        """The tokens still held back; ready for the next run."""
        rest = self.merges.cut(bytes(self._held), self._before)
        self._held.clear()
        self._before = None
        return rest


class Encoder:
    """Texts to token ids, run by run; a text may come in pieces.

    Every run goes through the transducer. What is held of a text is a piece and
    what is not final yet of the one before, and of a run that is longer than a
    piece what the transducer holds.
    """

    def __init__(self, merges: Merges, piece: int = PIECE):
        self.merges = merges
        #: Longer than any contraction and special token.
        self.piece = max(piece, 64)
        self.transducer = Transducer(merges)
        #: Tokens of runs of the pattern, and of words that follow a blank.
        self.known: dict[str, tuple[int, ...]] = {}
        self.words: dict[str, tuple[int, ...]] = {}
        names = sorted(merges.special, key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, names))) if names else None
        #: Characters that may be the beginning of a special token.
        self.ahead = max(map(len, names), default=1) - 1
        #: The class of the run that the transducer is in the middle of.
        self.open: regex.Pattern | None = None

    def _run(self, run: str) -> list[int]:
        ids: list[int] = []
        for at in range(0, len(run), 4096):
            ids += self.transducer.push(run[at : at + 4096].encode())
        return ids + self.transducer.finish()

    def _cut(self, text: str) -> list[int]:
        """Tokens of a text that begins and ends where the pattern cuts."""
        ids: list[int] = []
        known = self.known
        for run in CUT.findall(text):
            tokens = known.get(run)
            if tokens is None:
                tokens = self._run(run)
                self._keep(known, run, tokens)
            ids += tokens
        return ids

    @staticmethod
    def _keep(known: dict, key: str, tokens: list[int]) -> None:
        if len(key) <= _KEPT:
            if len(known) >= _CACHE:
                known.clear()
            known[key] = tuple(tokens)

    def _plain(self, text: str, ids: list[int]) -> None:
        """The pattern always cuts before a blank that something other than white space follows.

        So the text falls into words with the blank before them, and a word
        that has been met needs no look at the pattern.
        """
        words, known = self.words, self.known
        pieces = iter(text.split(" "))
        pending = next(pieces)
        for word in pieces:
            tokens = words.get(word)
            if tokens is None:
                if not word or word[0].isspace() or word[0] in _SPACE:
                    pending += " " + word
                    continue
                plain = _WORD.fullmatch(word)
                if plain is None or len(word) >= _KEPT:
                    tokens = self._cut(" " + word)
                else:
                    # A run of letters, and one of signs that no letter follows.
                    stem, signs = plain.groups()
                    tokens = words.get(stem)
                    if tokens is None:
                        tokens = tuple(self.merges.cut(b" " + stem.encode(), None))
                        if signs:
                            self._keep(words, stem, tokens)
                    if signs:
                        tail = known.get(signs)
                        tokens += tuple(self._cut(signs)) if tail is None else tail
                self._keep(words, word, tokens)
            if pending:
                ids += self._cut(pending)
                pending = ""
            ids += tokens
        if pending:
            ids += self._cut(pending)

    def _go_on(self, text: str, end: int, last: bool, ids: list[int]) -> int:
        """Read on in the run that is open; how many characters of it there were."""
        match = self.open.match(text)
        to = match.end() if match else 0
        if self.open is _SPACES and to < len(text):
            to -= 1  # the last blank belongs to what follows
        ends = last or to + _MARGIN <= end
        if not ends:
            to = min(to, max(end - _MARGIN, 0))
        ids += self.transducer.push(text[:to].encode())
        if ends:
            ids += self.transducer.finish()
            self.open = None
        return to

    def _advance(self, text: str, ids: list[int]) -> int:
        """Read what is final at the beginning of a text that goes on; how many characters.

        The characters that may begin a special token are not final.
        """
        end, at = len(text) - self.ahead, 0
        if self.open is not None:
            at = self._go_on(text, end, False, ids)
            if self.open is not None:
                return at
        # Up to the last blank between two other characters all runs are closed.
        cut = text.rfind(" ", at + 1, max(end - _MARGIN, 0))
        while cut > at and (_blank(text[cut - 1]) or _blank(text[cut + 1])):
            cut = text.rfind(" ", at + 1, cut)
        if cut > at:
            self._plain(text[at:cut], ids)
            at = cut
        if len(text) - at <= self.piece:
            return at
        # No such blank for long: run by run, and the last one as far as it is there.
        for match in CUT.finditer(text, at):
            if match.end() + _MARGIN > end:
                break
            ids += self._run(match.group())
            at = match.end()
        if len(text) - at > self.piece:
            run = text[at : at + 2]
            inner = run[1] if run[0] == " " and not _blank(run[1]) else run[0]
            self.open = next(c for c in (_LETTERS, _NUMBERS, _SPACES, _OTHERS) if c.match(inner))
            ids += self.transducer.push(text[at : end - _MARGIN].encode())
            at = end - _MARGIN
        return at

    def _closed(self, text: str, ids: list[int]) -> None:
        """Read a text to its end."""
        at = self._go_on(text, len(text), True, ids) if self.open is not None else 0
        if at < len(text):
            self._plain(text[at:] if at else text, ids)

    def _specials(self, text: str, ids: list[int]) -> int:
        """Read up to the last special token in ``text``; how many characters."""
        at = 0
        if self.special is not None:
            for match in self.special.finditer(text):
                self._closed(text[at : match.start()], ids)
                ids.append(self.merges.special[match.group()])
                at = match.end()
        return at

    def stream(self, pieces: Iterable[str]) -> Iterator[list[int]]:
        """Ids of a text that comes in pieces, as soon as they are final."""
        held = ""
        for piece in pieces:
            held += piece
            ids: list[int] = []
            held = held[self._specials(held, ids) :]
            held = held[self._advance(held, ids) :]
            yield ids
        ids = []
        at = self._specials(held, ids)
        self._closed(held[at:], ids)
        yield ids

    def encode(self, text: str) -> list[int]:
        if len(text) > self.piece:
            pieces = (text[at : at + self.piece] for at in range(0, len(text), self.piece))
            return [*chain.from_iterable(self.stream(pieces))]
        ids: list[int] = []
        at = self._specials(text, ids)
        self._plain(text[at:] if at else text, ids)
        return ids


def _blank(character: str) -> bool:
    return character.isspace() or character in _SPACE


class Decoder:
    """Token ids to text: the bytes of a character may come from several tokens.

    Bytes that cannot go on a character are replaced by U+FFFD.
    """

    def __init__(self, merges: Merges):
        self.bytes_of = merges.bytes_of
        self._machine = codecs.getincrementaldecoder("utf-8")("replace")

    def push(self, ids: Iterable[int]) -> str:
        return self._machine.decode(b"".join(map(self.bytes_of.__getitem__, ids)))

    def finish(self) -> str:
        rest = self._machine.decode(b"", True)
        self._machine.reset()
        return rest

    def decode(self, ids: Sequence[int]) -> str:
        parts = [self.push(ids[at : at + PIECE]) for at in range(0, len(ids), PIECE)]
        return "".join([*parts, self.finish()])


_MERGES: dict[str, Merges] = {}


def merges_at(path: str) -> Merges:
    """The merge list of a vocabulary file, read once per process."""
    if path not in _MERGES:
        _MERGES[path] = Merges(path)
    return _MERGES[path]


def encode(
    docs: DataFrame,
    path: str,
    *,
    text: str = "text",
    into: str = "tokens",
    drop: tuple[str, ...] = (),
    and_decode: bool = False,
) -> DataFrame:
    """``docs`` with a struct ``into``: ids, the tokens of the whole text.

    ``path`` names the vocabulary file on every executor. Special tokens in a
    text become their ids. A null or empty text has no ids. No row moves. With
    ``and_decode`` the struct also has ``decoded``, the text that the ids give,
    without a second round of workers for it.
    """

    def prepare():
        encoder, decoder = Encoder(merges_at(path)), Decoder(merges_at(path))

        def run(column: pa.Array) -> list:
            ids = [encoder.encode(t) if t else [] for t in column.to_pylist()]
            ends = np.cumsum([0, *map(len, ids)])
            flat = np.fromiter(chain.from_iterable(ids), np.int32, int(ends[-1]))
            tokens = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
            return [tokens, pa.array(map(decoder.decode, ids), pa.string())] if and_decode else [tokens]

        return run

    fields = "ids array<int>, decoded string" if and_decode else "ids array<int>"
    return annotate(docs, text, prepare, fields, into, drop)


def decode(tokens: DataFrame, path: str, *, row_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``(row_id, ids, text)`` of rows of token ids; null ids give an empty text."""
    bound_batches(tokens.sparkSession)
    own = pick(tokens, row_id=row_id, ids=ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(merges_at(path))
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = [decoder.decode(x or []) for x in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(texts, pa.string())], names=["row_id", "ids", "text"]
                )

    kind = own.schema["row_id"].dataType.simpleString()
    out = own.mapInArrow(run, f"row_id {kind}, ids array<int>, text string")
    return out.withColumnsRenamed({"row_id": row_id, "ids": ids} if row_id != "row_id" else {"ids": ids})
