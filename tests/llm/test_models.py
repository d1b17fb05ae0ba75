import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tweetflow.llm import language_id as P
from tweetflow.llm import quality_net as Q
from tweetflow.llm.frames import fold, pick, table
from tweetflow.llm.words import utf8

SAMPLES = {
    "en": ["the house and the tree stand there", "that is the other thing"],
    "de": ["das Haus und der Baum stehen dort", "über die Straße gehen", "das ist es"],
}


def brute_bits(texts, text):
    """PPM, method C without exclusion, byte by byte from counts of every context."""
    counts = defaultdict(Counter)
    for t in texts:
        data = b"\n" * P.ORDER + t.encode()
        for i in range(P.ORDER, len(data)):
            for order in range(P.ORDER + 1):
                counts[data[i - order : i]][data[i]] += 1
    data, total = b"\n" * P.ORDER + text.encode(), 0.0
    for i in range(P.ORDER, len(data)):
        for order in range(P.ORDER, -1, -1):
            seen = counts.get(data[i - order : i])
            if seen is None:
                continue
            everything = sum(seen.values()) + len(seen)
            if data[i] in seen:
                total += math.log2(everything / seen[data[i]])
                break
            total += math.log2(everything / len(seen))
        else:
            total += 8
    return total


def tree(texts):
    _, gram, count = P.gram_counts(*utf8(pa.array(texts)))
    merged = Counter()
    for g, n in zip(gram.tolist(), count.tolist(), strict=True):
        merged[g] += n
    grams = np.array(sorted(merged), np.uint32)
    return P.ContextTree(grams, np.array([merged[g] for g in grams.tolist()]))


def test_code_lengths_equal_brute_force():
    model = P.LanguageModel(list(SAMPLES), [tree(t) for t in SAMPLES.values()])
    texts = ["the tree", "", "der Baum 日本", "zzzz", "a", "über die Straße"]
    lengths = model.code_lengths(*utf8(pa.array(texts)))
    for i, text in enumerate(texts):
        for j, samples in enumerate(SAMPLES.values()):
            assert lengths[i, j] == pytest.approx(brute_bits(samples, text), rel=1e-5, abs=1e-4)


def test_identify(spark, documents, odd_texts):
    rows = [(i, t, k) for i, (k, t) in enumerate((k, t) for k, ts in SAMPLES.items() for t in ts)]
    rows += [(100, None, "en"), (101, "quoi", None)]
    model = P.train(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    assert model.languages == ["de", "en"]
    texts = [*odd_texts, "the other house", "das ist der Baum"]
    out = sorted(P.identify(documents(texts, extra=True), model).collect(), key=lambda r: r.doc_id)
    assert [r.text for r in out] == texts
    for row in out:
        und = not any(map(str.isalpha, row.text or ""))
        assert (row.language.lang == "und") == und and (row.language.score == 0) == und
        assert 0 <= row.language.score <= 1
    assert [r.language.lang for r in out[-2:]] == ["en", "de"]
    empty = P.train(spark.createDataFrame([], "doc_id bigint, text string, lang string"))
    assert {r.language.lang for r in P.identify(documents(["a"]), empty).collect()} == {"und"}
    assert P.identify(documents([]), model).count() == 0


def test_language_held_out(spark):
    docs = pick(table(spark, "/root/testdata/sf0.01", "documents"), doc_id="doc_id", text="text", lang="lang")
    model = P.train(docs.filter(fold("doc_id") != 1))
    held = P.identify(docs.filter(fold("doc_id") == 1), model)
    assert held.agg(F.avg((F.col("language.lang") == F.col("lang")).cast("int"))).first()[0] > 0.98


def test_chunks_cover_every_window():
    sizes = [0, 1, 7, 8, Q.WINDOWS, Q.CHUNK - 1, Q.CHUNK, Q.CHUNK + 1, 3 * Q.CHUNK]
    rng = np.random.default_rng(1)
    texts = [bytes(rng.integers(97, 123, n, dtype=np.uint8)) for n in sizes]
    data = np.frombuffer(b"".join(texts), np.uint8)
    rows, many = Q.chunks(data, np.cumsum([0, *sizes]))
    at = 0
    for text, n in zip(texts, many.tolist(), strict=True):
        own = [r.tobytes() for r in rows[at : at + n]]
        at += n
        for i in range(len(text) - Q.WIDTH + 1):
            assert own[i // Q.WINDOWS][i % Q.WINDOWS :][: Q.WIDTH] == text[i : i + Q.WIDTH]
        assert b"".join(c[: Q.WINDOWS] for c in own[:-1]) + own[-1] == (
            text + bytes(sum(len(c) for c in own[-1:]) + (n - 1) * Q.WINDOWS - len(text))
        )


def test_scores_equal_brute_force():
    net = Q.QualityNet.initial(3)
    texts = ["", "abc", "x" * 2000, "Ein Satz. " * 90]
    data, offsets = utf8(pa.array(texts))
    got = net.scores(data, offsets, net.pair_tables())
    for text, score in zip(texts, got, strict=True):
        raw, logits = text.encode(), []
        for at in range(0, max(1, len(raw) - Q.WIDTH + 1), Q.WINDOWS):
            chunk = raw[at : at + Q.CHUNK].ljust(Q.CHUNK, b"\0")
            best = np.full(Q.FILTERS, -np.inf)
            for i in range(Q.WINDOWS):
                best = np.maximum(best, sum(net.filters[j, chunk[i + j]] for j in range(Q.WIDTH)))
            logits.append(np.maximum(best + net.bias, 0) @ net.weight + net.offset[0])
        assert score == pytest.approx(1 / (1 + math.exp(-np.mean(logits))), abs=1e-4)


def test_quality_held_out_and_odd_texts(spark, documents, odd_texts):
    docs = table(spark, "/root/testdata/sf0.1", "documents")
    labels = table(spark, "/root/testdata/sf0.1", "labels")
    net = Q.train(docs, labels.filter(fold(labels["doc_id"]) != 1), n_docs=1200)
    held = docs.join(labels.filter(fold(labels["doc_id"]) == 1), "doc_id")
    judged = Q.judge(held.drop("quality"), net).join(labels.select("doc_id", F.col("quality").alias("y")), "doc_id")
    right = judged.agg(F.avg((F.col("quality.predicted") == F.col("y")).cast("int"))).first()[0]
    assert right > 0.95
    out = Q.judge(documents(odd_texts, extra=True).drop("quality"), net).collect()
    assert len(out) == len(odd_texts)
    assert all(0 <= r.quality.score <= 1 and r.quality.predicted == (r.quality.score >= 0.5) for r in out)
    assert Q.judge(documents([]), net).count() == 0
    nothing = spark.createDataFrame([(None, 1), (1, None), (2, 7)], "doc_id bigint, quality int")
    assert Q.train(documents(["a", None]), nothing).filters.shape == (Q.WIDTH, 256, Q.FILTERS)
