"""Language identification by prediction by partial matching.

For each language a context tree over bytes is trained, with contexts of 3, 2,
1 and 0 bytes. A byte is coded in the longest context that has been seen; if it
is new there, an escape is coded (method C: as likely as the number of distinct
bytes seen in the context is to that number plus the count) and the next
shorter context is tried, down to a uniform code. The statistics are frozen
after training, so the code length of a text is a sum over its 4-grams, and a
text is in the language that codes it shortest.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tweetflow.llm.frames import annotate, pick
from tweetflow.llm.words import slices, utf8

#: Bytes of the longest context.
ORDER = 3
#: About so many labelled documents of a language are learned from; the bound
#: keeps the trees, which go to every executor, from growing with the corpus.
TRAIN_DOCS = 2000
#: Stands before the first byte of a text.
_EDGE = 10
_ASCII_LETTER = re.compile("[A-Za-z]")


def gram_codes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Each byte and the three before it in its text, as one number."""
    codes = data.astype(np.uint32)
    lengths = np.diff(offsets)
    begin = np.repeat(offsets[:-1], lengths) if len(data) else np.zeros(0, np.int64)
    place = np.arange(len(data)) - begin
    for back in range(1, ORDER + 1):
        before = np.empty(len(data), np.uint8)
        before[back:] = data[:-back]
        before[:back] = _EDGE
        before[place < back] = _EDGE
        codes |= before.astype(np.uint32) << np.uint32(8 * back)
    return codes


def gram_counts(data: np.ndarray, offsets: np.ndarray):
    """``(text, gram, count)`` of each text's distinct grams."""
    text = np.repeat(np.arange(len(offsets) - 1, dtype=np.uint64), np.diff(offsets))
    keys = np.sort((text << np.uint64(32)) | gram_codes(data, offsets))
    new = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, int)
    keys = keys[new]
    counts = np.diff(np.append(new, len(data)))
    return (keys >> np.uint64(32)).astype(np.int64), keys.astype(np.uint32), counts


class ContextTree:
    """Counts of a language's contexts of every order, sorted for look-up."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        self.levels = []
        for order in range(ORDER, -1, -1):
            bits = 8 * (order + 1)
            strings = grams.astype(np.uint64) & np.uint64((1 << bits) - 1)
            key, at = np.unique(strings, return_inverse=True)
            n = np.bincount(at, counts, len(key))
            context, first, distinct = np.unique(key >> np.uint64(8), return_index=True, return_counts=True)
            total = np.add.reduceat(n, first) if len(first) else np.zeros(0)
            self.levels.append((bits, key, n, context, total, distinct))

    def bits(self, grams: np.ndarray) -> np.ndarray:
        """Code length, in bits, of the last byte of each gram after the others."""
        length = np.zeros(len(grams))
        todo = np.arange(len(grams))
        for bits, key, n, context, total, distinct in self.levels:
            if not len(todo) or not len(key):
                break
            string = grams[todo].astype(np.uint64) & np.uint64((1 << bits) - 1)
            c = np.minimum(np.searchsorted(context, string >> np.uint64(8)), len(context) - 1)
            known = context[c] == string >> np.uint64(8)
            k = np.minimum(np.searchsorted(key, string), len(key) - 1)
            seen = key[k] == string
            all_ = total[c] + distinct[c]
            length[todo[seen]] += np.log2(all_[seen] / n[k[seen]])
            escape = known & ~seen
            length[todo[escape]] += np.log2(all_[escape] / distinct[c[escape]])
            todo = todo[~seen]
        length[todo] += 8.0
        return length


class LanguageModel:
    """One context tree per language; the code lengths of known grams are laid out."""

    def __init__(self, languages: list[str], trees: list[ContextTree]):
        self.languages, self.trees = languages, trees
        keys = [tree.levels[0][1].astype(np.uint32) for tree in trees]
        self.grams = np.unique(np.concatenate(keys)) if keys else np.zeros(0, np.uint32)
        self.table = self._bits(self.grams)

    def _bits(self, grams: np.ndarray) -> np.ndarray:
        columns = [tree.bits(grams).astype(np.float32) for tree in self.trees]
        return np.stack(columns, axis=1) if columns else np.zeros((len(grams), 0), np.float32)

    def code_lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits that each language needs for each text."""
        text, gram, count = gram_counts(data, offsets)
        if not len(gram):
            return np.zeros((len(offsets) - 1, len(self.languages)))
        at = np.searchsorted(self.grams, gram)
        at[at == len(self.grams)] = 0
        bits = self.table[at] if len(self.grams) else np.zeros((len(gram), len(self.trees)), np.float32)
        new = self.grams[at] != gram if len(self.grams) else np.ones(len(gram), bool)
        bits[new] = self._bits(gram[new])
        weighted = bits.astype(np.float64) * count[:, None]
        out = np.zeros((len(offsets) - 1, len(self.languages)))
        first = np.flatnonzero(np.diff(text, prepend=-1))
        out[text[first]] = np.add.reduceat(weighted, first, axis=0)
        return out


def has_letter(text: str | None) -> bool:
    return bool(text) and (_ASCII_LETTER.search(text) is not None or any(map(str.isalpha, text)))


def train(
    labelled: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    n_docs: int = TRAIN_DOCS,
) -> LanguageModel:
    """A model of the languages of ``labelled``, from about ``n_docs`` texts of each.

    Which texts are taken depends on a hash of the id. Rows whose language or
    text is null are left out. Tasks sum up grams per language before anything
    is shuffled.
    """
    own = pick(labelled, doc_id=doc_id, text=text, lang=lang)
    own = own.filter("text IS NOT NULL AND lang IS NOT NULL")
    many = {r.lang: r.n for r in own.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not many:
        return LanguageModel([], [])
    share = F.create_map(*(F.lit(x) for k, n in many.items() for x in (k, min(1.0, n_docs / n))))
    unit = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    sample = own.filter(unit < share[F.col("lang")]).drop("doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            names = batch.column("lang").to_pylist()
            distinct = sorted(set(names))
            number = {name: i for i, name in enumerate(distinct)}
            of_text = np.array([number[name] for name in names], np.uint64)
            text, gram, count = gram_counts(*utf8(batch.column("text")))
            key = (of_text[text] << np.uint64(32)) | gram
            key, at = np.unique(key, return_inverse=True)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(distinct).take(pa.array((key >> np.uint64(32)).astype(np.int64))),
                    pa.array((key & np.uint64(0xFFFFFFFF)).astype(np.int64)),
                    pa.array(np.bincount(at, count, len(key)).astype(np.int64)),
                ],
                names=["lang", "gram", "n"],
            )

    counted = sample.mapInArrow(run, "lang string, gram bigint, n bigint")
    rows = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow().to_pandas()
    parts = {k: g.sort_values("gram") for k, g in rows.groupby("lang")}
    languages = sorted(parts)
    return LanguageModel(
        languages,
        [
            ContextTree(parts[k]["gram"].to_numpy().astype(np.uint32), parts[k]["n"].to_numpy())
            for k in languages
        ],
    )


def identify(
    docs: DataFrame,
    model: LanguageModel,
    *,
    text: str = "text",
    into: str = "language",
    drop: tuple[str, ...] = (),
) -> DataFrame:
    """``docs`` with a struct ``into``: lang, score.

    ``lang`` is the language that codes the text shortest (the first by name of
    equals), and ``und`` for a null text, one without a letter, or a model
    without languages. ``score`` is the posterior of that language under equal
    priors, 0 for ``und``. No row moves.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def prepare():
        model = shared.value

        def predict(column: pa.Array) -> list:
            lengths = model.code_lengths(*utf8(column))
            lettered = np.array([has_letter(t) for t in column.to_pylist()], bool)
            if not model.languages:
                return [["und"] * len(column), np.zeros(len(column))]
            best = lengths.argmin(axis=1)
            odds = np.exp2(np.maximum(lengths.min(axis=1, keepdims=True) - lengths, -1000))
            score = np.where(lettered, 1 / odds.sum(axis=1), 0.0)
            names = [model.languages[b] if ok else "und" for b, ok in zip(best, lettered, strict=True)]
            return [names, score]

        return predict

    return annotate(docs, text, prepare, "lang string, score double", into, drop)
