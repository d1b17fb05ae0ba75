import random

import numpy as np
from plain import plain_words

from tweetflow.llm import decontaminate as D

ITEMS = [
    (1, " ".join(f"alpha{i}" for i in range(30))),
    (2, "short item of five words"),
    (3, None),
    (4, "..."),
    (5, " ".join(f"alpha{i}" for i in range(10, 24))),  # within item 1
    (None, "the item without any id stands here too"),
    (2, "a second text under the same id"),
    (6, "one"),
]


def brute(texts, items, window=13):
    windows = {}
    for item, text in items:
        w = plain_words(text)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            name = "" if item is None else str(item)
            windows.setdefault(tuple(w[i : i + window]), set()).add(name)
    out = []
    for text in texts:
        w, hit, found = plain_words(text), set(), set()
        for size in {len(k) for k in windows}:
            for i in range(len(w) - size + 1):
                if tuple(w[i : i + size]) in windows:
                    hit |= set(range(i, i + size))
                    found |= windows[tuple(w[i : i + size])]
        out.append((len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def planted(odd_texts):
    item = ITEMS[0][1]
    pad = " ".join(f"pad{i}" for i in range(300))
    return [
        *odd_texts,
        item.upper(),
        f"{pad} {item} {pad}",
        " ".join(item.split()[:13]) + " x " + " ".join(item.split()[:12]),
        " ".join(item.split()[3:17] * 3),
        "SHORT item, of five words short item of five words",
        "a second text under the same id",
        "the item without any id stands here too",
        f"{pad} {' '.join(item.split()[:15])} {pad}",
    ]


def test_equals_brute_force(spark, documents, odd_texts):
    texts = planted(odd_texts)
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    docs = documents(texts, extra=True)
    out = D.decontaminate(docs, items)
    assert out.columns == [*docs.columns, "contamination"]
    rows = sorted(out.collect(), key=lambda r: r.doc_id)
    got = [
        (c.n_words, c.n_hit, list(c["items"]), c.contaminated) for c in (r.contamination for r in rows)
    ]
    assert got == brute(texts, ITEMS)
    assert [r.text for r in rows] == texts


def drawn(seed, n):
    """Texts of few words, so that shingles repeat and windows share anchors, with long words among them."""
    rng = random.Random(seed)
    pool = ["a", "b", "C", "É", "long" * 40, "LONG" * 40, "long" * 41]
    return [" ".join(rng.choices(pool[: rng.randrange(1, 8)], k=rng.randrange(60))) for _ in range(n)]


def test_texts_of_few_words_equal_brute_force(spark, documents):
    items = [(i % 9, t) for i, t in enumerate(drawn(1, 25))]
    texts = [*drawn(2, 120), *(f"x {t} y" for _, t in items)]
    table = spark.createDataFrame(items, "item_id bigint, text string")
    rows = sorted(D.decontaminate(documents(texts), table).collect(), key=lambda r: r.doc_id)
    got = [(c.n_words, c.n_hit, list(c["items"]), c.contaminated) for c in (r.contamination for r in rows)]
    assert got == brute(texts, items)


def test_spans_are_joined_per_item_and_repeated_rows_stay(spark, documents):
    item = ITEMS[0][1]
    text = f"x {item} y {' '.join(item.split()[:14])}"
    docs = documents([text]).unionAll(documents([text]))
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    for row in D.decontaminate(docs, items).collect():
        spans = [(s.start, s.end, s["item"]) for s in row.contamination.spans]
        assert spans == [(1, 31, "1"), (32, 46, "1"), (11, 25, "5")]


def test_empty_tables(spark, documents):
    items = spark.createDataFrame([], "item_id bigint, text string")
    assert D.decontaminate(documents([]), items).count() == 0
    (row,) = D.decontaminate(documents(["a b c"]), items).collect()
    assert row.contamination.n_hit == 0 and not row.contamination.contaminated


def test_window_is_found_by_its_rarest_shingle(spark):
    pieces = spark.createDataFrame([(b"p", " ".join("abcdefghijklm"))], "id binary, text string")
    places = D.item_places(pieces)
    keys = {r.pos: r.key for r in places.collect()}
    assert sorted(keys) == list(range(10))
    counts = spark.createDataFrame([(k, 2 if p == 4 else 9) for p, k in keys.items()], "key bigint, n bigint")
    (anchor,) = D.anchors(places, counts).collect()
    assert (anchor.pos, anchor.key, anchor.n, anchor.need) == (4, keys[4], 2, 13)
    assert (anchor.before, anchor.around) == (4, " ".join("abcdefghijklm"))


def test_neighbouring_windows_share_anchors(spark):
    pieces = spark.createDataFrame([(b"p", ITEMS[0][1])], "id binary, text string")
    places = D.item_places(pieces)
    counts = spark.createDataFrame([], "key bigint, n bigint")
    assert D.anchors(places, counts).count() < 30 - 13 + 1


def test_a_full_table_loses_nothing(spark):
    """A table too small for its keys lets more through, never less."""
    keys = np.random.default_rng(1).integers(0, 1 << 63, 3000)
    table = D.sieve(spark.createDataFrame([(int(k),) for k in keys], "key bigint"), bits=10)
    assert len(D.passing(table, keys.astype(np.uint64))) == len(keys)
    roomy = D.sieve(spark.createDataFrame([(int(k),) for k in keys], "key bigint"))
    others = np.random.default_rng(2).integers(0, 1 << 63, 100000).astype(np.uint64)
    assert len(D.passing(roomy, keys.astype(np.uint64))) == len(keys)
    assert len(D.passing(roomy, others)) < 10


def test_a_shingle_that_very_many_documents_share_is_dealt(spark):
    around = " ".join("abcdefghijklm")
    probes = spark.createDataFrame(
        [(bytes([i]), 4, 7, 4, around) for i in range(100)], "id binary, pos bigint, key bigint, before int, around string"
    )
    wanted = spark.createDataFrame(
        [(7, 100, 13, 4, around, "1"), (8, 0, 13, 4, around, "2")],
        "key bigint, n bigint, need bigint, before int, around string, item string",
    )
    rows = D.occurrences(probes, wanted, parts=4).collect()
    assert sorted((r.id[0], r["item"], r.start, r.end) for r in rows) == [(i, "1", 0, 13) for i in range(100)]


def test_nothing_of_the_documents_comes_to_the_driver(spark, documents, odd_texts, monkeypatch):
    """Only the sizes of shingles and one sum are collected, beside the bit tables."""
    kind = type(spark.range(1))
    collected, collect = [], kind.collect
    monkeypatch.setattr(kind, "collect", lambda df: collected.append(df.columns) or collect(df))
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    D.decontaminate(documents(planted(odd_texts)), items)
    assert collected == [["size"], ["sum(n)"]]
