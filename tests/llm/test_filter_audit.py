import random
import re
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from compare import duck, duck_rows, spark_rows
from pyspark.sql import functions as F

from tweetflow.llm import filter_audit as A
from tweetflow.llm import queries
from tweetflow.llm.words import utf8

LABEL = "doc_id bigint, quality int, toxic int, part string, good string"


def fails_by_hand(rows):
    """The letters that each ``(doc_id, text)`` fails."""
    least = {}
    for i, t in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    out = []
    for i, t in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        out.append(
            ("A" if len(words) < 50 else "")
            + ("B" if 100 * len(set(words)) < 65 * len(words) else "")
            + ("C" if 100 * len(re.findall("[A-Z]", t)) > 5 * len(t) else "")
            + ("D" if re.search("[#$%&*|]", t) else "")
            + ("E" if i is not None and i > least[t] else "")
        )
    return out


@pytest.fixture(scope="module")
def texts(odd_texts):
    rng = random.Random(6)
    made = [
        " ".join(rng.choice(["Ab", "cd", "e", "#", "\x1c", " x", *map(str, range(90))]) for _ in range(n))
        for n in (*range(45, 56), 200, 3000)
    ]
    return [*odd_texts, *made, *made[:4], "A" * 4 + "b" * 76, "A" * 5 + "b" * 76, "\v\f\rx\x1d y\t", None, ""]


@pytest.mark.parametrize("shard", [1, 200, 4 << 20])
def test_failures_equal_brute_force(documents, texts, shard, monkeypatch):
    monkeypatch.setattr(A, "SHARD", shard)
    docs = documents(texts, extra=True).selectExpr("*", "1 AS shard", "2 AS t1", "3 AS fails", "'p' AS part")
    out = {r.doc_id: r for r in A.failures(docs).collect()}
    assert len(out) == len(texts)
    for i, want in enumerate(fails_by_hand(list(enumerate(texts)))):
        assert "".join(c for k, c in enumerate(A.FILTERS) if out[i].fails >> k & 1) == want, texts[i]
        words = re.findall(r"[^\x20\x09-\x0D]+", texts[i] or "")
        assert (out[i].n_words, out[i].n_distinct) == (len(words), len(set(words)))


@pytest.mark.parametrize("shard, buckets", [(300, 3), (4 << 20, 64)])
def test_matrix_and_dictionary(documents, texts, shard, buckets, monkeypatch):
    """Entries name words of one dictionary, in which each distinct word has one number."""
    monkeypatch.setattr(A, "SHARD", shard)
    shards, terms = A.csr_shards(documents(texts), buckets=buckets)
    terms = terms.collect()
    word = {r.word_id: r.word for r in terms}
    assert len(word) == len(terms) == len(set(word.values()))
    seen = 0
    for shard in shards.collect():
        indptr, indices, counts = A.matrix(shard.indptr, shard.indices, shard.counts)
        for row, doc_id in enumerate(shard.doc_ids):
            a, b = indptr[row : row + 2]
            found = {word[i]: n for i, n in zip(indices[a:b].tolist(), counts[a:b].tolist(), strict=True)}
            words = re.findall(r"[^\x20\x09-\x0D]+", texts[doc_id] or "")
            assert found == {w: words.count(w) for w in set(words)}
            seen += 1
    assert seen == len(texts)
    assert set(word.values()) == {w for t in texts for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")}


def test_terms_of_texts_that_touch():
    words, indptr, indices, counts = A.document_terms(*utf8(pa.array(["b a", "a", "", None, "b b", " "])))
    assert words == [b"b", b"a"] and indptr.tolist() == [0, 2, 3, 3, 3, 4, 4]
    assert indices.tolist() == [0, 1, 1, 0] and counts.tolist() == [1, 1, 1, 2]
    assert len(A.document_terms(np.zeros(0, np.uint8), np.zeros(1, np.int64))[0]) == 0


def audit_by_hand(rows, labels):
    """Rows are ``(doc_id, part, text)``; every order is walked for every document."""
    fails = fails_by_hand([(i, t) for i, _, t in rows])
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    out = {}
    for (i, part, _), own in zip(rows, fails, strict=True):
        for order in map("".join, permutations("ABCDE")):
            here = True
            for step, c in enumerate(order, 1):
                row = out.setdefault((part or "", order, step), [0] * 6)
                hit = c in own
                row[0] += here and not hit
                row[1] += here and hit
                row[2] += not here and hit
                row[3] += own == c
                row[4] += here and hit and i in good
                row[5] += here and hit and i in toxic
                here = here and not hit
    shapley = {}
    for (part, order, step), row in out.items():
        key = (part, order[step - 1])
        shapley[key] = shapley.get(key, 0) + row[1]
    return {k: (*row, shapley[k[0], k[1][k[2] - 1]]) for k, row in out.items()}


def test_audit_equals_brute_force(spark, documents, texts):
    parts = [None, "", "a", "b"]
    rows = [(i, parts[i % 4], t) for i, t in enumerate(texts)] + [(None, "a", t) for t in texts[:6]] + [(3, "b", "one")] * 2
    docs = spark.createDataFrame([(i, t, "en", p, 0) for i, p, t in rows], documents([]).schema)
    labels = [(i, i % 2, i % 3) for i in range(0, len(texts), 2)] + [(None, 1, 1), (4, None, 1), (4, 1, None), (9999, 1, 1)]
    marked = spark.createDataFrame([(*x, "p", "g") for x in labels], LABEL)
    out = A.audit(A.patterns(A.failures(docs), marked)).collect()
    want = audit_by_hand(rows, labels)
    columns = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    got = {(r.part, r.filter_order, r.step): tuple(r[c] for c in columns) for r in out}
    assert len(out) == len(got) == 3 * 600 and got == want


def test_empty_tables(spark, documents):
    labels = spark.createDataFrame([], LABEL)
    assert A.audit(A.patterns(A.failures(documents([])), labels)).count() == 0
    (row,) = A.patterns(A.failures(documents([None]).withColumn("source", F.lit(None).cast("string"))), labels).collect()
    assert (row.part, row.fails, row.n, row.good) == ("", 1, 1, 0)


def test_query_equals_its_sql(spark, sf_dir):
    name = "op11_filter_audit"
    assert spark_rows(queries.queries()[name](spark, sf_dir)) == duck_rows(duck(sf_dir), queries.oracle_sql()[name])
