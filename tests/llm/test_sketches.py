import random
import re

import pyarrow as pa
import pytest
from plain import plain_words
from pyspark.sql import functions as F

from tweetflow.llm import sketches as S
from tweetflow.llm.words import shingles, utf8
from tweetflow.llm.words import words as split


def successors(rows):
    """Rows in order, each with the text of the next: ids descending, then text, null ids last."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    texts = [r[1] or "" for r in order]
    return [(r[0], t, n) for r, t, n in zip(order, texts, [*texts[1:], *texts[:1]], strict=True)]


@pytest.mark.parametrize("tasks", [1, 3, 40])
def test_edited_texts_equal_brute_force(spark, documents, odd_texts, tasks):
    extra = documents(["again", None, "zz"], first_id=3)
    nobody = documents(["b", "a"]).selectExpr("cast(null as bigint) doc_id", "text", "lang", "source", "n_chars")
    docs = documents(odd_texts, extra=True)
    docs = docs.unionByName(extra.unionAll(nobody), allowMissingColumns=True)
    docs = docs.selectExpr("*", "1 AS range", "2 AS edited", "'f' AS fingerprint")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = []
    for doc_id, text, following in successors(rows):
        half = len(text) // 2
        want.append((doc_id, len(text), text[: len(text) - half] + following[:half]))
    out = S.edited_fingerprints(docs, tasks=tasks).collect()
    key = lambda x: (x[0] is None, x[0] or 0, x[1], x[2])
    assert sorted(((r.doc_id, r.n_chars, r.edited) for r in out), key=key) == sorted(want, key=key)
    by_text = {}
    for r in out:
        by_text.setdefault(r.edited, set()).add(r.edited_fingerprint)
    assert all(len(prints) == 1 for prints in by_text.values())


def test_lone_and_empty(documents):
    assert S.edited_fingerprints(documents([])).count() == 0
    (row,) = S.edited_fingerprints(documents(["abcd"])).collect()
    assert row.edited == "abab" and row.near_next == 1 and row.fingerprint.startswith("~")


def test_merge_and_containment(spark, documents):
    part = " ".join(f"w{i}" for i in range(400))
    whole = part + " " + " ".join(f"v{i}" for i in range(4000))
    rows = S.sketch(documents([part, whole, part, "", None, "x"]), drop=("text",))
    prints = {r.doc_id: r.fingerprint for r in rows.collect()}
    assert prints[0] == prints[2] and prints[3] == prints[4]
    df = spark.createDataFrame([(prints[0], prints[1], prints[3])], "a string, b string, c string")
    a, b, c = F.col("a"), F.col("b"), F.col("c")
    row = df.select(
        S.containment(a, b).alias("ab"),
        S.containment(b, a).alias("ba"),
        S.containment(c, a).alias("ca"),
        S.likeness(c, c).alias("cc"),
        (S.merge(a, b) == S.merge(b, a)).alias("same"),
        S.containment(b, S.merge(a, b)).alias("bm"),
    ).first()
    assert row.ab == 1 and row.ba == pytest.approx(0.09, abs=0.03)
    assert row.ca == 0 and row.cc == 1 and row.same and row.bm == 1


def exact(a, b):
    """Jaccard similarity of the 5-word shingles of two texts, 1 for equal texts."""

    def shingles(text):
        found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
        found = [w.translate({c: c + 32 for c in range(65, 91)}) for w in found]
        return {tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4))} if found else set()

    a_, b_ = shingles(a), shingles(b)
    return 1.0 if a == b else len(a_ & b_) / max(len(a_ | b_), 1)


def by_hand(text):
    """Kept hashes of a text from its shingles, one at a time."""
    words = plain_words(text)
    spans = [" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))] if words else []
    hashes = {int(h) for w in spans for h in shingles(split(*utf8(pa.array([w]))), 5)[0]}
    return {h >> 24 for h in hashes if h < 1 << 63}


def like(a, b, equal):
    return 1.0 if equal else len(a & b) / max(len(a | b), 1)


def test_likeness_equals_brute_force(spark, documents):
    """One rule for short and long texts, in the workers and as column functions."""
    rng = random.Random(7)
    texts = []
    for n in [*range(1, 30), 45, 60, 68, 500] * 4:
        base = [rng.choice("abcdefgh") * rng.randint(1, 3) + str(rng.randint(0, 40)) for _ in range(n)]
        near = base[:-1] + ["other"]
        texts += [" ".join(base), " ".join(base), " ".join(near), "!!!", "???", ""]
    made = S.edited_fingerprints(documents(texts), tasks=3)
    made = made.withColumn("near", S.likeness(F.col("fingerprint"), F.col("edited_fingerprint")))
    error = []
    for r in made.collect():
        text, following = texts[r.doc_id], texts[r.doc_id - 1]
        own, edited, after = by_hand(text), by_hand(r.edited), by_hand(following)
        # Texts that keep nothing are told apart by their characters, others by what they keep.
        assert r.near == r.near_edited == like(own, edited, own == edited if own else text == r.edited)
        assert r.near_next == like(own, after, own == after if own else text == following)
        if len(text) > 1000:
            error.append(abs(r.near_edited - exact(text, r.edited)))
    assert error and max(error) < 0.1


def test_sketches_of_parts_merge_into_that_of_the_whole(spark, documents):
    """However long the parts, what is kept of them together is the sketch of both."""
    texts = [" ".join(f"a{i}_{n}" for i in range(n)) for n in (5, 30, 64, 65, 70, 3000)]
    joined = [a + " ! " + b for a, b in zip(texts, texts[1:], strict=False)]
    prints = {r.doc_id: r.fingerprint for r in S.sketch(documents([*texts, *joined]), drop=("text",)).collect()}
    pairs = [(prints[i], prints[i + 1], prints[len(texts) + i]) for i in range(len(joined))]
    df = spark.createDataFrame(pairs, "a string, b string, both string")
    for r in df.select(S.merge(F.col("a"), F.col("b")).alias("m"), "both").collect():
        # The joined text has the four shingles across the border besides.
        extra = set(r.both.split(",")) - set(r.m.split(","))
        assert set(r.m.split(",")) <= set(r.both.split(",")) and len(extra) <= 9
