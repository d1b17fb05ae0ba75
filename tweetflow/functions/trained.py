"""A scorer that is learned from labelled messages.

Words and pairs of words are hashed into a vector of fixed size, and a
multinomial logistic regression gives the probability of each label. Training
works out the vectors once and sums gradients over the partitions, scoring runs
in the JVM: no Python worker.
A trained scorer is saved under a path that ends with its version.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, NGram, RegexTokenizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tweetflow.functions.labels import LABELS, apply_label_rule
from tweetflow.functions.scorers import Scorer
from tweetflow.functions.text import as_column
from tweetflow.session import shared_dir
from tweetflow.sources import files

#: Given sentiments, in the order of ``LABELS``.
GIVEN = ("negative", "neutral", "positive")

_TEXT, _LABEL, _WEIGHT, _PROBABILITY = "__text", "__label", "__weight", "__probability"
#: What the steps add to a frame on the way.
_STEPS = ("__words", "__pairs", "__word_counts", "__pair_counts", "__features", "__raw", "__prediction")


def label_of(sentiment: Column | str) -> Column:
    """The label that a given sentiment stands for, case ignored; null for any other."""
    column = F.lower(as_column(sentiment))
    label = F.lit(None).cast("string")
    for given, name in zip(GIVEN, LABELS, strict=True):
        label = F.when(column == given, name).otherwise(label)
    return label


@dataclass(frozen=True)
class TrainedScorer:
    """Fitted steps, and the version they are known by."""

    model: PipelineModel
    version: str

    def save(self, path: str) -> None:
        """Nothing may be there yet: a version is never overwritten."""
        self.model.save(path)

    def __call__(self, df: DataFrame, text: str, out: str) -> DataFrame:
        """Add ``out`` to ``df``, as every scorer does; a null text counts as empty."""
        said = self.model.transform(df.withColumn(_TEXT, F.coalesce(as_column(text), F.lit(""))))
        share = vector_to_array(_PROBABILITY)
        scores = F.array(
            *(F.struct(F.lit(name).alias("label"), share[i].alias("score")) for i, name in enumerate(LABELS))
        )
        name = f"__scores_{out}"
        scored = said.withColumn(name, scores).drop(_TEXT, _PROBABILITY, *_STEPS)
        return apply_label_rule(scored, name, out)


def train(
    labelled: DataFrame,
    *,
    text: str = "cleaned_text",
    sentiment: str = "sentiment",
    n_features: int = 1 << 16,
    iterations: int = 15,
    penalty: float = 1e-4,
    version: str = "untitled",
) -> TrainedScorer:
    """Learn from the rows of ``labelled`` whose sentiment is a label.

    Equal texts of one label, as a message has for each of its mentions, are one
    row of that weight. The vectors are written to the shared folder and removed
    afterwards; the regression goes through them for each of the ``iterations``.
    Its coefficients, ``n_features`` for each label, are held by the driver and
    sent to the tasks for each iteration. Every label has to occur.
    """
    label = label_of(sentiment)
    rows = labelled.select(F.coalesce(as_column(text), F.lit("")).alias(_TEXT), label.alias("label"))
    rows = rows.filter(F.col("label").isNotNull())
    rows = rows.groupBy(_TEXT, "label").agg(F.count("*").cast("double").alias(_WEIGHT))
    words, pairs, word_counts, pair_counts, features, raw, prediction = _STEPS
    vectorize = Pipeline(
        stages=[
            RegexTokenizer(inputCol=_TEXT, outputCol=words, pattern=r"[^\p{L}]+"),
            NGram(n=2, inputCol=words, outputCol=pairs),
            HashingTF(numFeatures=n_features // 2, binary=True, inputCol=words, outputCol=word_counts),
            HashingTF(numFeatures=n_features // 2, binary=True, inputCol=pairs, outputCol=pair_counts),
            VectorAssembler(inputCols=[word_counts, pair_counts], outputCol=features),
        ]
    ).fit(rows)
    regression = LogisticRegression(
        family="multinomial",
        maxIter=iterations,
        regParam=penalty,
        featuresCol=features,
        labelCol=_LABEL,
        weightCol=_WEIGHT,
        rawPredictionCol=raw,
        probabilityCol=_PROBABILITY,
        predictionCol=prediction,
    )
    number = F.array_position(F.array(*map(F.lit, LABELS)), F.col("label")) - 1
    spark = labelled.sparkSession
    path = files.make_scratch(spark, shared_dir(spark, "vectors")) + "/vectors"
    vectors = vectorize.transform(rows).select("label", number.cast("double").alias(_LABEL), _WEIGHT, features)
    vectors.write.parquet(path, compression="zstd")
    kept = spark.read.schema(vectors.schema).parquet(path)
    try:
        known = {row.label for row in kept.select("label").distinct().collect()}  # three at most
        if missing := [name for name in LABELS if name not in known]:
            raise ValueError(f"no row is labelled {', '.join(missing)}")
        fitted = regression.fit(kept)
    finally:
        files.delete(spark, path)
    return TrainedScorer(PipelineModel([*vectorize.stages, fitted]), version)


def load_scorer(path: str) -> Scorer:
    """A scorer that was saved; its version is the last part of the path."""
    return TrainedScorer(PipelineModel.load(path), path.rstrip("/").rsplit("/", 1)[-1])
