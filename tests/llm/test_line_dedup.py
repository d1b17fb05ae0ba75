import random

import numpy as np
import pyarrow as pa
import pytest
from compare import duck, duck_rows, spark_rows

from tweetflow.llm import line_dedup as L
from tweetflow.llm import queries


def by_hand(rows, least_documents=10, least_chars=1):
    """Lines that stay, by plain sets; a document is a distinct pair of id and text."""

    def key(line):
        line = line.strip(" \t\n\v\f\r")
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line)

    holders = {}
    for doc in {(i, t or "") for i, t in rows}:
        for line in doc[1].split("\n"):
            if len(key(line)) >= least_chars:
                holders.setdefault(key(line), set()).add(doc)
    gone = {k for k, docs in holders.items() if len(docs) >= least_documents}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key(x) not in gone]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def run(docs, **bounds):
    out = L.without_lines(docs, L.keep_bitmaps(docs, **bounds))
    return [(r.doc_id, r.deduplicated.n_lines, r.deduplicated.n_dropped, r.deduplicated.text) for r in out.collect()]


def ordered(rows):
    return sorted(rows, key=repr)


@pytest.fixture(scope="module")
def texts(odd_texts):
    rng = random.Random(2)
    lines = [f"line {i}" for i in range(12)] + ["", " ", " ", "É", "é", " LINE 1\r", "\tline 2 ", "x" * 5000]
    made = ["\n".join(rng.choice(lines) for _ in range(rng.randint(1, 30))) for _ in range(60)]
    return [*odd_texts, *made, *made[:5], "held by all\n" * 500, "\n" * 40]


@pytest.mark.parametrize("bounds", [{}, {"least_documents": 1}, {"least_documents": 45, "least_chars": 2}])
def test_kept_lines_equal_brute_force(documents, texts, bounds):
    docs = documents(texts, extra=True).selectExpr("*", "1 AS h1", "2 AS k1", "3 AS keep", "4 AS n")
    assert ordered(run(docs, **bounds)) == ordered(by_hand(list(enumerate(texts)), **bounds))


def test_repeated_rows_are_one_document(documents):
    docs = documents(["a\nb"]).union(documents(["a\nc"] * 9, first_id=1))
    nine = docs.union(documents(["a\nb"])).unionAll(documents(["a\nb"]))
    assert {r[2] for r in run(nine)} == {1}  # ten documents hold "a"
    rows = [(0, "a\nb")] * 5 + [(i, "a") for i in range(1, 9)]
    docs = documents(["a\nb"])
    for _ in range(4):
        docs = docs.union(documents(["a\nb"]))
    docs = docs.union(documents(["a"] * 8, first_id=1))
    assert ordered(run(docs)) == ordered(by_hand(rows))


def test_null_ids_and_empty_tables(documents):
    assert run(documents([])) == []
    assert run(documents([None, ""]))[0][1:] == (1, 0, "")
    docs = documents([f"same\n{i}" for i in range(12)]).selectExpr("cast(null as bigint) doc_id", "text")
    assert {r[2] for r in run(docs)} == {1}


def batches_of(rows, size):
    columns = list(zip(*rows, strict=True))
    names = ["h1", "h2", "doc_id", "k1", "k2"]
    batch = pa.RecordBatch.from_arrays(
        [*(pa.array(c, pa.int64()) for c in columns), pa.array([[0]] * len(rows), pa.list_(pa.int32()))],
        names=[*names, "positions"],
    )
    return [batch.slice(at, size) for at in range(0, len(rows), size)]


@pytest.mark.parametrize("size", [1, 2, 3, 7, 1000])
@pytest.mark.parametrize("least", [1, 2, 4])
def test_ranges_agree_however_the_rows_are_cut(size, least):
    """Sorted rows cut into ranges and batches anywhere: together they decide as the whole does."""
    rng = random.Random(size * 10 + least)
    for _ in range(30):
        documents = {(h, 0, d, d, 7) for h in range(6) for d in range(rng.choice([0, 1, 2, 4, 9]))}
        rows = sorted([*documents, *rng.sample(sorted(documents), len(documents) // 3)])
        if not rows:
            continue
        held = {}
        for h, _, d, _, _ in documents:
            held.setdefault(h, set()).add(d)
        # Equal rows stand in one range.
        cuts = sorted({rng.randrange(len(rows)) for _ in range(rng.randint(0, 4))})
        cuts = [c for c in cuts if c and rows[c] != rows[c - 1]]
        dropped, opened, counts = [], [], {}
        for a, b in zip([0, *cuts], [*cuts, len(rows)], strict=True):
            for out in L._Runs(least).read(iter(batches_of(rows[a:b], size))):
                for row in out.to_pylist():
                    if row["kind"] == L._COUNT:
                        counts[row["h1"]] = counts.get(row["h1"], 0) + row["n"]
                    else:
                        (dropped if row["kind"] == L._DROPPED else opened).append((row["h1"], row["k1"]))
        dropped += [x for x in opened if counts[x[0]] >= least]
        assert sorted(dropped) == sorted((h, d) for h, docs in held.items() if len(docs) >= least for d in docs)


def test_bitmaps():
    for n in (1, 7, 8, 9, 100):
        positions = sorted(random.Random(n).sample(range(n), max(1, n // 3)))
        keep = L.keeps(L.packed(positions), n + 20)
        assert np.flatnonzero(~keep).tolist() == positions
    assert L.keeps(None, 3).all() and len(L.packed(list(range(100000)))) < 1000


def test_query_equals_its_sql(spark, sf_dir):
    name = "op12_line_dedup"
    assert spark_rows(queries.queries()[name](spark, sf_dir)) == duck_rows(duck(sf_dir), queries.oracle_sql()[name])
