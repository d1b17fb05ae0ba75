"""A training corpus from raw documents, in five stages.

Each stage takes the documents that the one before it kept, with their columns,
and is written as Parquet and read again before the next one begins.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tweetflow.llm import bpe_stream, decontaminate, prob_minhash, quality_net, secret_scan
from tweetflow.llm.frames import fold, free_name, stored, table
from tweetflow.llm.queries import tokenizer_path
from tweetflow.session import configure

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: The stages draw hashes and learn models; a brute-force version tests them.
ORACLE_SQL = None


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality network accepts; it learns from labels outside fold 1."""
    labels = table(spark, sf_dir, "labels")
    net = quality_net.train(docs, labels.filter(fold(labels["doc_id"]) != 1))
    into = free_name(docs, "quality")
    judged = quality_net.judge(docs, net, into=into)
    return judged.filter(F.col(into).predicted == 1).select(docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each near-duplicate class; of repeated rows one."""
    classes = prob_minhash.near_duplicates(docs)
    least = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key"))
    kept = classes.groupBy("class_key").agg(least.alias("one"))
    kept = kept.select(F.col("one.doc_id").alias("kept_id"), F.col("one.row_key").alias("kept_key"))
    key = free_name(docs, "row_key")
    keyed = docs.withColumn(key, prob_minhash.text_key(docs["text"]))
    same = keyed["doc_id"].eqNullSafe(kept["kept_id"]) & (keyed[key] == kept["kept_key"])
    return keyed.join(kept, same, "left_semi").dropDuplicates(["doc_id", key]).select(docs.columns)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth is benchmark text."""
    into = free_name(docs, "contamination")
    found = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), into=into)
    return found.filter(~F.col(into).contaminated).select(docs.columns)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret replaced by its kind and ``n_chars`` counted anew."""
    into = free_name(docs, "secrets")
    found = secret_scan.scan_secrets(docs, into=into)
    text = F.coalesce(F.col(into).redacted, F.col("text"))
    changed = found.withColumns(
        {
            "n_chars": F.when(
                F.col(into).redacted.isNotNull(), F.length(F.col(into).redacted).cast("bigint")
            ).otherwise(F.col("n_chars")),
            "text": text,
        }
    )
    return changed.select(docs.columns)


def as_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and the digest of the text they decode to."""
    own = docs.select("doc_id", "lang", "source", "text")
    encoded = bpe_stream.encode(own, tokenizer_path(), drop=("text",), and_decode=True)
    return encoded.select(
        "doc_id",
        "lang",
        "source",
        F.size("tokens.ids").cast("bigint").alias("n_tokens"),
        F.col("tokens.ids").alias("ids"),
        F.sha2("tokens.decoded", 256).alias("decoded_sha256"),
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_quality),
    ("near_duplicates", one_of_each),
    ("decontamination", without_benchmarks),
    ("secrets", without_secrets),
    ("tokens", as_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(configure(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
