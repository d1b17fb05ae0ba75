"""Scorers: they add class scores to a frame and label them.

A scorer is a function ``(df, text_column, out_column) -> df`` whose result has
the extra column ``out_column: struct<label string, score double, binary int>``.
Batch and streaming frames are treated alike.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tweetflow.functions.labels import SCORES_TYPE, apply_label_rule, label_from_votes
from tweetflow.functions.text import as_column

Scorer = Callable[[DataFrame, str, str], DataFrame]
#: Texts in, for each text the scores of all labels out.
Model = Callable[[list[str]], list[list[dict]]]

_LISTS_TYPE = T.StructType(
    [T.StructField("label", T.ArrayType(T.StringType())), T.StructField("score", T.ArrayType(T.DoubleType()))]
)


@dataclass(frozen=True)
class Lexicon:
    """Lower-case words that count for or against; letters only."""

    positive: tuple[str, ...]
    negative: tuple[str, ...]

    def __post_init__(self) -> None:
        words = self.positive + self.negative
        if len(set(words)) != len(words):
            raise ValueError("a word may stand in a lexicon only once")
        if not self.positive or not self.negative:
            raise ValueError("a lexicon needs positive and negative words")
        if not all(w.isalpha() and w == w.lower() for w in words):
            raise ValueError("lexicon words are lower case and letters only")

    @property
    def pattern(self) -> str:
        """Any word, as a whole run of letters; group 1 holds it if positive."""
        positive, negative = "|".join(self.positive), "|".join(self.negative)
        return rf"(?<!\p{{L}})(?:({positive})|{negative})(?!\p{{L}})"


def lexicon_scorer(lexicon: Lexicon) -> Scorer:
    """Count lexicon words with JVM expressions only; no Python worker.

    The words of a text are votes, and one more vote is neutral.
    """

    def score(df: DataFrame, text: str, out: str) -> DataFrame:
        hits, n_positive = f"__hits_{out}", f"__positive_{out}"
        # One pass over the text; only hits are materialised, not every token.
        # A hit on a negative word is an empty string.
        found = F.regexp_extract_all(
            F.lower(F.coalesce(as_column(text), F.lit(""))), F.lit(lexicon.pattern), F.lit(1)
        )
        # Steps of their own, so that neither the search nor the count is
        # repeated for each use of its result.
        counted = df.withColumn(hits, found).withColumn(
            n_positive, F.size(F.array_remove(hits, ""))
        )
        votes = label_from_votes(
            F.size(hits) - F.col(n_positive), F.lit(1), F.col(n_positive)
        )
        return counted.withColumn(out, votes).drop(hits, n_positive)

    return score


def model_scorer(factory: Callable[[], Model], batch_size: int = 32) -> Scorer:
    """Score with a user's model in an iterator pandas UDF.

    ``factory`` runs on the executors, once per task, and returns the model;
    a factory that caches its result loads it once per worker process. Texts go
    to the model ``batch_size`` at a time whatever the size of the Arrow batch.
    """
    if batch_size < 1:
        raise ValueError("batch_size must be positive")

    # Labels and scores as two lists: a list of records would be converted field
    # by field in Python, which takes longer than a short text takes to score.
    @F.pandas_udf(_LISTS_TYPE)
    def infer(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = factory()
        for texts in batches:
            texts = texts.tolist()
            labels, shares = [], []
            for start in range(0, len(texts), batch_size):
                for scores in model(texts[start : start + batch_size]):
                    known = scores is not None
                    labels.append([s.get("label") for s in scores] if known else None)
                    shares.append([s.get("score") for s in scores] if known else None)
            yield pd.DataFrame({"label": pd.Series(labels, dtype=object), "score": pd.Series(shares, dtype=object)})

    def score(df: DataFrame, text: str, out: str) -> DataFrame:
        scores = f"__scores_{out}"
        lists = infer(F.coalesce(as_column(text), F.lit("")))
        # A step of its own, so that the model is asked once for both lists.
        scored = df.withColumn(scores, lists).withColumn(
            scores, F.arrays_zip(F.col(scores)["label"], F.col(scores)["score"]).cast(SCORES_TYPE)
        )
        return apply_label_rule(scored, scores, out)

    return score


def lexicon_model(lexicon: Lexicon) -> Callable[[], Model]:
    """A factory for ``model_scorer`` that scores as ``lexicon_scorer`` does.

    It stands in for a trained model, so that the Python path can be checked
    against the native one.
    """
    positive, negative = frozenset(lexicon.positive), frozenset(lexicon.negative)

    def factory() -> Model:
        import re

        runs = re.compile(r"[^\W\d_]+")
        known = positive | negative
        # Western texts have a byte a character, and any byte but a letter parts words.
        blanked = bytes(b if chr(b).isalpha() else ord(" ") for b in range(256))
        named = {w.encode("latin-1"): w for w in known if all(ord(c) < 256 for c in w)}

        def letters(run: str) -> list[str]:
            """Letters only: the class of the pattern has signs like ½ and Ⅷ as well."""
            if run.isalpha():
                return [run]
            return "".join(c if c.isalpha() else " " for c in run).split()

        def hits(text: str) -> list[str]:
            text = text.lower()
            try:
                words = text.encode("latin-1").translate(blanked).split()
            except UnicodeEncodeError:
                return [w for run in runs.findall(text) for w in letters(run) if w in known]
            return [named[w] for w in filter(named.__contains__, words)]

        def rate(text: str) -> list[dict]:
            found = hits(text)
            n_pos = sum(map(positive.__contains__, found))
            n_neg = len(found) - n_pos
            votes = n_pos + n_neg + 1
            return [
                {"label": "NEG", "score": n_neg / votes},
                {"label": "NEU", "score": 1 / votes},
                {"label": "POS", "score": n_pos / votes},
            ]

        return lambda texts: [rate(text) for text in texts]

    return factory


_LOADED: dict[tuple[str, int], Model] = {}


def in_windows(text: str, n_tokens: Callable[[str], int], most: int) -> list[tuple[str, int]]:
    """A text in parts of up to ``most`` tokens, each with its number of tokens.

    A text that is too long is cut in half at a blank, or between characters
    where there is none, until its parts fit. A single character always does.
    """
    n = n_tokens(text)
    if n <= most or len(text) < 2:
        return [(text, n)]
    middle = len(text) // 2
    cut = text.rfind(" ", 1, middle + 1)
    after = text.find(" ", middle)
    if cut < 0 or 0 <= after - middle < middle - cut:
        cut = after
    if not 0 < cut < len(text):
        cut = middle
    return in_windows(text[:cut], n_tokens, most) + in_windows(text[cut:], n_tokens, most)


def windowed(model: Model, n_tokens: Callable[[str], int], most: int) -> Model:
    """A model that reads texts of any length.

    The windows of a long text are scored one by one, and the score of a label is
    their mean, weighted by tokens.
    """

    def rate(texts: list[str]) -> list[list[dict]]:
        windows = [in_windows(text, n_tokens, most) for text in texts]
        scored = iter(model([part for parts in windows for part, _ in parts]))
        out = []
        for parts in windows:
            own = [next(scored) for _ in parts]
            if len(own) == 1:
                out.append(own[0])
                continue
            total = sum(max(n, 1) for _, n in parts)
            sums: dict[str, float] = {}
            for scores, (_, n) in zip(own, parts, strict=True):
                for one in scores:
                    sums[one["label"]] = sums.get(one["label"], 0.0) + one["score"] * max(n, 1) / total
            out.append([{"label": label, "score": score} for label, score in sums.items()])
        return out

    return rate


def transformers_model(name: str, batch_size: int = 32) -> Callable[[], Model]:
    """A factory for ``model_scorer`` that loads a text-classification model of
    the Hugging Face hub. The library has to be installed on the executors.

    A worker process loads a model once, however many tasks it runs. Texts
    longer than the model reads are scored in windows (see ``windowed``).
    """

    def factory() -> Model:
        if (name, batch_size) not in _LOADED:
            _LOADED[name, batch_size] = load()
        return _LOADED[name, batch_size]

    def load() -> Model:
        try:
            from transformers import pipeline
        except ImportError as missing:
            raise ImportError("transformers is not installed on this executor") from missing
        # top_k=None: the scores of all labels, not of the best one only.
        model = pipeline("text-classification", model=name, top_k=None, batch_size=batch_size)
        tokenizer = model.tokenizer
        # Some tokenizers do not say what their model reads.
        places = getattr(model.model.config, "max_position_embeddings", None) or tokenizer.model_max_length
        most = min(tokenizer.model_max_length, places)
        return windowed(model, lambda text: len(tokenizer(text)["input_ids"]), most)

    return factory
