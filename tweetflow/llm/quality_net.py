"""A byte-level convolutional network that judges the quality of texts.

A text is cut into chunks that overlap by the width of a filter less one, so
every window of the text lies in one chunk. Learned filters run over all
windows of a chunk; the highest response of each filter, rectified, is weighed
into the chunk's logit, and the mean over all chunks gives one probability.
Responses are sums over bytes, so two neighbouring bytes are looked up at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tweetflow.llm.frames import annotate, pick
from tweetflow.llm.words import utf8

WIDTH = 8
FILTERS = 16
#: Windows of a chunk; a chunk has WIDTH - 1 bytes more.
WINDOWS = 505
CHUNK = WINDOWS + WIDTH - 1
#: About so many labelled documents are learned from.
TRAIN_DOCS = 2400
EPOCHS = 6
RATE = 0.02
#: Chunks of a document that one epoch draws, besides one short excerpt.
DRAWN = 5
_AT_ONCE = 64


def chunks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chunks of all texts as rows of bytes, and how many each text has.

    The last chunk of a text, or the only one, is filled up with zeros; an
    empty text has one chunk of zeros.
    """
    lengths = np.diff(offsets)
    many = np.maximum(1, -(-(lengths - (WIDTH - 1)) // WINDOWS))
    rows = np.zeros((int(many.sum()), CHUNK), np.uint8)
    first = np.cumsum(many) - many
    for text in range(len(lengths)):
        own = data[offsets[text] : offsets[text + 1]]
        for k in range(int(many[text])):
            part = own[k * WINDOWS : k * WINDOWS + CHUNK]
            rows[first[text] + k, : len(part)] = part
    return rows, many


@dataclass
class QualityNet:
    filters: np.ndarray  # (WIDTH, 256, FILTERS)
    bias: np.ndarray
    weight: np.ndarray
    offset: np.ndarray  # one value

    @classmethod
    def initial(cls, seed: int = 7) -> QualityNet:
        rng = np.random.default_rng(seed)
        return cls(
            rng.normal(0, 0.1, (WIDTH, 256, FILTERS)).astype(np.float32),
            np.zeros(FILTERS, np.float32),
            rng.normal(0, 0.3, FILTERS).astype(np.float32),
            np.zeros(1, np.float32),
        )

    def pair_tables(self) -> list[np.ndarray]:
        """Responses to two neighbouring bytes, for each second place of a window."""
        f = self.filters
        return [
            (f[j][:, None, :] + f[j + 1][None, :, :]).reshape(1 << 16, FILTERS)
            for j in range(0, WIDTH, 2)
        ]

    def responses(self, rows: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
        """Each filter's response at each window of each chunk."""
        pairs = (rows[:, :-1].astype(np.uint16) << np.uint16(8)) | rows[:, 1:]
        total = tables[0][pairs[:, :WINDOWS]]
        for j, table in enumerate(tables[1:], 1):
            total += table[pairs[:, 2 * j : 2 * j + WINDOWS]]
        return total

    def scores(self, data: np.ndarray, offsets: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
        rows, many = chunks(data, offsets)
        logits = np.empty(len(rows))
        for at in range(0, len(rows), _AT_ONCE):
            top = self.responses(rows[at : at + _AT_ONCE], tables).max(axis=1)
            logits[at : at + _AT_ONCE] = np.maximum(top + self.bias, 0) @ self.weight + self.offset
        mean = np.add.reduceat(logits, np.cumsum(many) - many) / many if len(many) else logits
        return 1 / (1 + np.exp(-np.clip(mean, -30, 30)))


def _excerpt(raw: bytes, rng: np.random.Generator) -> np.ndarray:
    size = int(np.exp(rng.uniform(np.log(24), np.log(400))))
    at = int(rng.integers(0, max(1, len(raw) - size + 1)))
    part = np.frombuffer(raw[at : at + size], np.uint8)
    return chunks(part, np.array([0, len(part)]))[0]


def fit(texts: list[str], labels: list[int], seed: int = 7) -> QualityNet:
    """Train by Adam on the logistic loss of the documents, classes weighed alike.

    An epoch draws up to ``DRAWN`` chunks from anywhere in a document, and an
    excerpt of 24 to 400 bytes as a document of its own: short texts are rare,
    and a net that saw long ones only would take the filling zeros for a defect.
    """
    net = QualityNet.initial(seed)
    if not texts:
        return net
    raw = [t.encode() for t in texts]
    shapes = [chunks(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0] for t in raw]
    y = np.array(labels, np.float64)
    share = np.array([max(1, (y == 0).sum()), max(1, (y == 1).sum())]) / len(y)
    importance = 0.5 / share[y.astype(int)]
    rng = np.random.default_rng(seed)
    parameters = [net.filters, net.bias, net.weight, net.offset]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in parameters]
    step = 0
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for batch in np.array_split(rng.permutation(len(texts)), -(-len(texts) // 32)):
            tables = net.pair_tables()
            drawn = [shapes[i][rng.permutation(len(shapes[i]))[:DRAWN]] for i in batch]
            drawn += [_excerpt(raw[i], rng) for i in batch]
            batch = np.concatenate([batch, batch])
            rows = np.concatenate(drawn)
            many = np.array([len(x) for x in drawn])
            top = np.empty((len(rows), FILTERS), np.float32)
            place = np.empty((len(rows), FILTERS), np.int64)
            for at in range(0, len(rows), _AT_ONCE):
                part = net.responses(rows[at : at + _AT_ONCE], tables)
                place[at : at + _AT_ONCE] = part.argmax(axis=1)
                top[at : at + _AT_ONCE] = part.max(axis=1)
            active = np.maximum(top + net.bias, 0)
            first = np.cumsum(many) - many
            mean = np.add.reduceat(active @ net.weight + net.offset, first) / many
            error = (1 / (1 + np.exp(-np.clip(mean, -30, 30))) - y[batch]) * importance[batch]
            per_row = np.repeat(error / many, many) / len(batch)
            back = per_row[:, None] * net.weight * (active > 0)
            gradient = np.zeros_like(net.filters)
            which = np.arange(FILTERS)
            for j in range(WIDTH):
                byte = np.take_along_axis(rows, place + j, axis=1)
                np.add.at(gradient[j], (byte, which), back)
            step += 1
            for p, (m, v), g in zip(
                parameters,
                moments,
                (gradient, back.sum(axis=0), per_row @ active, np.array([per_row.sum()])),
                strict=True,
            ):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def train(
    docs: DataFrame,
    labels: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    label_id: str = "doc_id",
    label: str = "quality",
    n_docs: int = TRAIN_DOCS,
) -> QualityNet:
    """A network fitted on about ``n_docs`` labelled documents, half of each label if there are enough.

    Which ones are taken depends on a hash of the id. Rows without a text, an
    id or a label of 0 or 1 teach nothing. The sampled labels, not the texts,
    decide what is read on: the join brings in their texts only.
    """
    marks = pick(labels, doc_id=label_id, label=label)
    marks = marks.filter("doc_id IS NOT NULL AND label IN (0, 1)").distinct()
    many = {r.label: r.n for r in marks.groupBy("label").agg(F.count("*").alias("n")).collect()}
    unit = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    share = F.create_map(*(F.lit(x) for y in (0, 1) for x in (y, min(1.0, n_docs / 2 / max(1, many.get(y, 0))))))
    chosen = marks.filter(unit < share[F.col("label").cast("int")])
    sample = pick(docs, doc_id=doc_id, text=text).filter("text IS NOT NULL").join(F.broadcast(chosen), "doc_id")
    rows = sorted(sample.select("doc_id", "text", "label").collect())
    return fit([r.text for r in rows], [int(r.label) for r in rows])


def judge(
    docs: DataFrame,
    net: QualityNet,
    *,
    text: str = "text",
    into: str = "quality",
    drop: tuple[str, ...] = (),
) -> DataFrame:
    """``docs`` with a struct ``into``: score (0 to 1), predicted (1 from 0.5 on).

    Every byte of a text is looked at, whatever its length; a null text is
    judged like an empty one, which is a chunk of zeros. No row moves.
    """
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def prepare():
        net = shared.value
        tables = net.pair_tables()

        def score(column: pa.Array) -> list:
            scores = net.scores(*utf8(column), tables)
            return [scores, (scores >= 0.5).astype(np.int32)]

        return score

    return annotate(docs, text, prepare, "score double, predicted int", into, drop)
