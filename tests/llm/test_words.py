import numpy as np
import pyarrow as pa
from plain import plain_words
from hypothesis import given, settings
from hypothesis import strategies as st

from tweetflow.llm import words as W

TEXTS = st.lists(st.one_of(st.none(), st.text(max_size=60)), max_size=12)


def spelled(texts):
    data, offsets = W.utf8(pa.array(texts, pa.string()))
    found = W.words(data, offsets)
    out = []
    for lo, hi in zip(found.first[:-1], found.first[1:], strict=True):
        joined = W.lower_words(data, found.starts[lo:hi], found.ends[lo:hi]).decode()
        out.append(joined.split(" ") if joined else [])
    return out, found


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_pattern(texts):
    out, found = spelled(texts)
    assert out == [plain_words(t) for t in texts]
    by_hash = {}
    for word, h in zip([w for t in out for w in t], found.hashes.tolist(), strict=True):
        assert by_hash.setdefault(word, h) == h
    assert len(set(by_hash.values())) == len(by_hash)


def test_pieces_do_not_cut_words(monkeypatch):
    texts = ["ab " * 900 + "x" * 5000, "y" * 3000, "", "é" * 2000 + " z"]
    whole, _ = spelled(texts)
    monkeypatch.setattr(W, "_PIECE", 64)
    assert spelled(texts)[0] == whole


def test_shingles():
    data, offsets = W.utf8(pa.array(["a b c d", "a b", None, "x a b c"]))
    found = W.words(data, offsets)
    hashes, text = W.shingles(found, 3)
    assert text.tolist() == [0, 0, 1, 3, 3]
    assert hashes[0] == hashes[4]  # a b c
    assert len(np.unique(hashes)) == 4


def test_slices_keep_every_row():
    batch = pa.RecordBatch.from_arrays([pa.array(["aa", None, "b" * 50, "", "c"])], names=["t"])
    parts = list(W.slices([batch], "t", 3))
    assert [x for p in parts for x in p.column("t").to_pylist()] == batch.column("t").to_pylist()
    assert len(parts) > 1
