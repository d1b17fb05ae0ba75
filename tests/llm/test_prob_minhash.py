import random
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from plain import plain_words

from tweetflow.llm import prob_minhash as P
from tweetflow.llm.words import utf8, words


def weights(text, size=5):
    w = plain_words(text)
    if 0 < len(w) < size:
        return Counter([tuple(w)])
    return Counter(tuple(w[i : i + size]) for i in range(len(w) - size + 1))


def exact(a, b):
    """J_P by its definition."""
    total = 0.0
    for d in a.keys() & b.keys():
        total += 1 / sum(max(a[e] / a[d], b[e] / b[d]) for e in a.keys() | b.keys())
    return total


def profiles(texts):
    of_text, shingle, weight = P.profile(words(*utf8(pa.array(texts, pa.string()))))
    cut = np.searchsorted(of_text, np.arange(len(texts) + 1))
    out = []
    for lo, hi in zip(cut[:-1], cut[1:], strict=True):
        order = np.argsort(shingle[lo:hi])
        out.append((shingle[lo:hi][order], weight[lo:hi][order]))
    return out


def changed(rng, text, n):
    w = text.split()
    for i in rng.sample(range(len(w)), n):
        w[i] = f"new{rng.random()}".replace(".", "")
    return " ".join(w)


@pytest.fixture(scope="module")
def corpus():
    """Chains, a large group of near copies, exact copies and unrelated texts."""
    rng = random.Random(3)
    fresh = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    base, chain = fresh(150), [fresh(120)]
    for _ in range(5):
        chain.append(changed(rng, chain[-1], 2))
    group = [changed(rng, base, rng.randrange(1, 6)) for _ in range(60)]
    repeats = "line of words that comes again and again " * 20
    return [
        *group, base, base, *chain, *[fresh(80) for _ in range(20)],
        repeats, repeats + "line of words", "a b c", "A, b; c!", "a b d", "", None, "...", "!!!",
    ]


def test_probability_jaccard(corpus):
    texts = corpus[:12] + corpus[-9:]
    shapes, sets = profiles(texts), [weights(t) for t in texts]
    for i, j in combinations(range(len(texts)), 2):
        assert P.probability_jaccard(shapes[i], shapes[j]) == pytest.approx(exact(sets[i], sets[j]))


def test_registers_agree_as_often_as_the_similarity():
    rng = random.Random(1)
    a = [f"x{i}" for i in range(200)]
    texts = [" ".join(a), " ".join(a[:150] + a[:40] + [f"y{rng.random()}" for _ in range(30)])]
    found = words(*utf8(pa.array(texts)))
    owner = P.signatures(2, *P.profile(found), 4000)
    want = exact(weights(texts[0]), weights(texts[1]))
    assert (owner[0] == owner[1]).mean() == pytest.approx(want, abs=0.03)


def classes_by_brute_force(texts):
    sets = [weights(t) for t in texts]
    label = list(range(len(texts)))
    for i, j in combinations(range(len(texts)), 2):
        same = (texts[i] or "") == (texts[j] or "")
        if same or exact(sets[i], sets[j]) >= P.SIMILARITY:
            a, b = label[i], label[j]
            label = [min(a, b) if x in (a, b) else x for x in label]
    return label


@pytest.mark.parametrize("cells", [(256, 1024), (2, 5)])
def test_classes_equal_brute_force(documents, corpus, monkeypatch, cells):
    monkeypatch.setattr(P, "CELL_QUERIES", cells[0])
    monkeypatch.setattr(P, "CELL_MEMBERS", cells[1])
    out = P.near_duplicates(documents(corpus, extra=True)).collect()
    assert len(out) == len(corpus)
    got = {r.doc_id: r.class_id for r in out}
    assert [got[i] for i in range(len(corpus))] == classes_by_brute_force(corpus)


def test_repeated_rows_null_ids_and_empty_tables(spark, documents):
    assert P.near_duplicates(documents([])).count() == 0
    docs = documents(["a b c d e f", "x"]).unionAll(documents(["a b c d e f"]))
    docs = docs.unionAll(docs.selectExpr("cast(null as bigint)", "text", "lang", "source", "n_chars"))
    rows = P.near_duplicates(docs).collect()
    assert Counter((r.doc_id, r.class_id) for r in rows) == {(0, 0): 2, (None, 0): 2, (1, 1): 1, (None, 1): 1}


def test_components(spark):
    links = [(1, 2), (2, 3), (5, 4), (6, 5), (7, 1), (9, 9)]
    df = spark.createDataFrame([(bytes([a]), bytes([b])) for a, b in links], "a binary, b binary")
    got = {r.key[0]: r.label[0] for r in P.components(df).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 7: 1, 4: 4, 5: 4, 6: 4}
