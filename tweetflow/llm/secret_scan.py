"""Secrets: spans of known form, and strings that look random.

Two character Markov models of order one are trained from labelled samples:
one of random strings, one of ordinary identifiers. A string is a secret if the
log-likelihood ratio of the two, per string and per character, is high enough.
In the corpus the labels come from form: values of known secrets are random,
all other runs of the same characters are ordinary. A corpus shows few
alphabets of secrets and few styles of names, so each class has further samples:
strings drawn from usual alphabets, and the words of the ordinary runs joined
the way names are written. Pairs that a class lacks are backed off to what
follows the kind of character, and that to single characters.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tweetflow.llm.frames import annotate, pick
from tweetflow.llm.words import slices

#: The forms of the contract, in its order, with the group and
#: the characters that a match must have.
KINDS = ("assign", "access", "hex")
_FORMS = (
    (
        re.compile(
            r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
            re.IGNORECASE | re.ASCII,
        ),
        2,
        8,
    ),
    (re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    (re.compile(r"[0-9a-f]+"), 0, 32),
)
#: The third form again, without a match for each letter a-f of a text.
_LONG_HEX = re.compile(r"[0-9a-f]{32,}")

#: Runs that can be secrets, and the least length at which they are judged.
RUN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
LEAST_RUN = 20
#: Ordinary samples may be shorter, so that names are learnt as well.
_ORDINARY = re.compile(r"[A-Za-z0-9+/_=-]{8,}")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_SIGNS = "/_=-"
#: Weight of what a model backs off to beside its counts: a share, however many
#: there are, since names of other words than the corpus has are ordinary too.
BACK_OFF = 0.3
#: And characters per context, which tell where there are few counts.
PRIOR = 20.0
#: Nats by which the random model must win: in all, and per character. Chosen on
#: strings that were not trained on; the tests hold both error rates.
LEAST_RATIO = 12.0
LEAST_RATE = 0.75
#: Alphabets of random strings.
_LOWER, _UPPER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
ALPHABETS = (
    _DIGITS + "abcdef",
    _DIGITS + "ABCDEF",
    _DIGITS + _UPPER,
    _DIGITS + _LOWER,
    _DIGITS + _UPPER + _LOWER,
    _DIGITS + _UPPER + _LOWER + "+/",
)

_N = len(ALPHABET) + 1  # the last one stands for both ends
_CODE = np.full(256, _N - 1, np.int64)
_CODE[np.frombuffer(ALPHABET.encode(), np.uint8)] = np.arange(_N - 1)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the known forms, by start and then kind.

    Matches of a kind do not overlap; those whose value is too short are
    dropped after they have taken their place.
    """
    found = []
    for kind, (pattern, group, least) in enumerate(_FORMS):
        for match in (_LONG_HEX if kind == 2 else pattern).finditer(text):
            if match.end(group) - match.start(group) >= least:
                found.append((match.start(), kind, match.end()))
    return sorted(found)


def pair_counts(strings: list[str]) -> np.ndarray:
    """How often each character follows each other one; strings begin and end apart."""
    codes = _CODE[np.frombuffer(("\n" + "\n".join(strings) + "\n").encode("ascii", "replace"), np.uint8)]
    pairs = codes[:-1] * _N + codes[1:]
    return np.bincount(pairs, minlength=_N * _N).reshape(_N, _N) if strings else np.zeros((_N, _N), int)


def _drawn() -> np.ndarray:
    """What pairs to expect in strings drawn from each alphabet: one character in all for each."""
    counts = np.zeros((_N, _N))
    for alphabet in ALPHABETS:
        codes = _CODE[np.frombuffer(alphabet.encode(), np.uint8)]
        counts[np.ix_(codes, codes)] += 1 / len(codes) ** 2
        counts[_N - 1, codes] += 1 / len(codes) / 40
    return counts / len(ALPHABETS)


def _named(ordinary: np.ndarray) -> np.ndarray:
    """What pairs to expect in names made of the words of ordinary runs: one character in all.

    Words are their letters without case. Names are snake_case, kebab-case,
    paths, UPPER_CASE, camelCase and PascalCase, equally often.
    """
    upper, lower = slice(0, 26), slice(26, 52)
    signs = [ALPHABET.index(sign) for sign in _SIGNS]
    outside = [*signs, *range(52, _N)]
    pairs = sum(ordinary[a, b] for a in (upper, lower) for b in (upper, lower)) + 1e-3
    # Words begin behind what is no letter, and where a capital follows a small letter.
    begins = ordinary[outside, upper].sum(axis=0) + ordinary[outside, lower].sum(axis=0)
    begins = begins + ordinary[lower, upper].sum(axis=0) + 1e-3
    ends = ordinary[upper, outside].sum(axis=1) + ordinary[lower, outside].sum(axis=1)
    ends = ends + ordinary[lower, upper].sum(axis=1) + 1e-3
    pairs, begins, ends = pairs / pairs.sum(), begins / begins.sum(), ends / ends.sum()
    # Of six characters one begins a word.
    out = np.zeros((_N, _N))
    for case, n_styles in ((lower, 3), (upper, 1)):
        out[case, case] += n_styles * 4 / 6 * pairs
        for sign in signs[:3]:
            out[sign, case] += n_styles / 6 / 3 * begins
            out[case, sign] += n_styles / 6 / 3 * ends
        out[_N - 1, case] += n_styles / 6 / 5 * begins
    joined = ends[:, None] * begins[None, :]
    first = pairs * (begins / np.maximum(pairs.sum(axis=1), 1e-12))[:, None]
    for capital in (False, True):
        out[lower, lower] += 3 / 6 * pairs
        out[lower, upper] += 1 / 6 * joined
        out[upper, lower] += 1 / 6 * first
        out[_N - 1, upper if capital else lower] += 1 / 6 / 5 * begins
    return out / out.sum()


def _kinds() -> np.ndarray:
    """Small letter, capital, digit, sign or end: what a context is backed off to."""
    kinds = np.full(_N, 4)
    for i, c in enumerate(ALPHABET):
        kinds[i] = 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3
    return kinds


def _log_rows(counts: np.ndarray) -> np.ndarray:
    """Log-probability of each character behind each other one."""
    seen = counts[:, :-1].astype(float)
    single = seen.sum(axis=0) + 1 / (_N - 1)
    single = single / single.sum()
    kinds = _kinds()
    by_kind = np.zeros_like(seen)
    for kind in range(5):
        rows = seen[kinds == kind].sum(axis=0)
        by_kind[kinds == kind] = (1 - BACK_OFF) * (rows + PRIOR * single) / (rows.sum() + PRIOR) + BACK_OFF * single
    pairs = (seen + PRIOR * by_kind) / (seen.sum(axis=1, keepdims=True) + PRIOR)
    return np.log((1 - BACK_OFF) * pairs + BACK_OFF * by_kind)


@dataclass(frozen=True)
class RandomnessModel:
    """Log-likelihood ratio of random over ordinary, per pair of characters."""

    ratio: np.ndarray

    @classmethod
    def fit(cls, random: np.ndarray, ordinary: np.ndarray) -> RandomnessModel:
        """From the pair counts of the two kinds of sample.

        The further samples of a class weigh as much as those that are given,
        and 100,000 characters at least.
        """
        weight = lambda counts: max(float(counts.sum()), 1e5)
        random = random + weight(random) * _drawn()
        ordinary = ordinary + weight(ordinary) * _named(ordinary)
        ratio = np.zeros((_N, _N))
        ratio[:, :-1] = _log_rows(random) - _log_rows(ordinary)
        # Paths, dashes and rules are joined by signs; those say nothing either way.
        ratio[:, [ALPHABET.index(sign) for sign in _SIGNS]] = 0
        return cls(ratio)

    def score(self, string: str) -> float:
        codes = _CODE[np.frombuffer(("\n" + string).encode("ascii", "replace"), np.uint8)]
        return float(self.ratio[codes[:-1], codes[1:]].sum())

    def is_random(self, string: str) -> bool:
        score = self.score(string)
        return score >= LEAST_RATIO and score >= LEAST_RATE * len(string)


def _samples(text: str) -> tuple[list[str], list[str]]:
    """Values of known secrets, and the other runs of the text."""
    taken, values = [], []
    for start, kind, end in base_spans(text):
        taken.append((start, end))
        value = text[start:end]
        if kind == 0:
            value = _FORMS[0][0].match(value).group(2)
        values.append(value)
    if not taken:
        return [], _ORDINARY.findall(text)
    ordinary, at, reach = [], 0, 0
    for start, end in taken:
        if start > at:
            ordinary += _ORDINARY.findall(text, at, start)
        reach = max(reach, end)
        at = reach
    return values, ordinary + _ORDINARY.findall(text, at)


def fit_on_corpus(docs: DataFrame, text: str = "text") -> RandomnessModel:
    """The model of the whole corpus: pair counts summed over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, _N, _N), np.int64)
        for batch in slices(batches, "text"):
            random, ordinary = [], []
            for value in batch.column("text").to_pylist():
                if value:
                    for out, new in zip((random, ordinary), _samples(value), strict=True):
                        out += new
            counts[0] += pair_counts(random)
            counts[1] += pair_counts(ordinary)
        flat = counts.ravel()
        some = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(flat[some])], names=["at", "n"])

    counted = pick(docs, text=text).mapInArrow(run, "at bigint, n bigint")
    total = np.zeros(2 * _N * _N, np.int64)
    for row in counted.groupBy("at").agg(F.sum("n").alias("n")).collect():  # 9,248 rows at most
        total[row["at"]] = row.n
    random, ordinary = total.reshape(2, _N, _N)
    return RandomnessModel.fit(random, ordinary)


def _pieces(text: str, base: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """The runs, cut at the spans of known forms; pieces that are long enough to be judged."""
    first = 0
    for match in RUN.finditer(text):
        at, end = match.span()
        while first < len(base) and base[first][2] <= at:
            first += 1
        for start, _, stop in base[first:]:
            if start >= end:
                break
            if start - at >= LEAST_RUN:
                yield at, start
            at = max(at, stop)
        if end - at >= LEAST_RUN:
            yield at, end


def find_secrets(text: str, model: RandomnessModel) -> list[tuple[int, str, int]]:
    """``(start, kind, end)``: the known forms, and random runs or what the forms leave of them."""
    base = base_spans(text)
    found = [(start, KINDS[kind], end) for start, kind, end in base]
    for start, end in _pieces(text, base):
        if model.is_random(text[start:end]):
            found.append((start, "random", end))
    order = {kind: i for i, kind in enumerate((*KINDS, "random"))}
    return sorted(found, key=lambda x: (x[0], order[x[1]], x[2]))


def redact(text: str, spans: list[tuple[int, str, int]]) -> str:
    """The text with every span, or union of overlapping spans, replaced by its kind."""
    out, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            out.append(text[at:start])
            out.append(f"[{kind}]")
        at = max(at, end)
    return "".join([*out, text[at:]])


def scan_secrets(
    docs: DataFrame,
    *,
    text: str = "text",
    model: RandomnessModel | None = None,
    into: str = "secrets",
    drop: tuple[str, ...] = (),
) -> DataFrame:
    """``docs`` with a struct ``into``: spans, redacted.

    ``spans`` are ``(kind, start, end)`` in code points, end exclusive, by start
    and kind; ``redacted`` is the text without them, null where there are none.
    Without a ``model`` one is trained on ``docs``. A null or empty text has no
    spans. No row moves.
    """
    if model is None:
        model = fit_on_corpus(docs, text)

    def prepare():
        def scan(column: pa.Array) -> list:
            spans, redacted = [], []
            for value in column.to_pylist():
                found = find_secrets(value, model) if value else []
                spans.append([{"kind": k, "start": s, "end": e} for s, k, e in found])
                redacted.append(redact(value, found) if found else None)
            return [spans, redacted]

        return scan

    return annotate(
        docs, text, prepare,
        "spans array<struct<kind:string,start:bigint,end:bigint>>, redacted string", into, drop,
    )
