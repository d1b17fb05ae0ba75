import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tweetflow.llm import bpe_stream as B
from tweetflow.llm.queries import tokenizer_path

LIBRARY = Tokenizer.from_file(tokenizer_path())
MERGES = B.merges_at(tokenizer_path())


def library_ids(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


PARTS = st.sampled_from(
    ["a", "the", " ", "  ", "\n", "\t", "é", "日本", "‍", "🎉", "12", "½", "'s", "'LL", "---", "\xa0",
     "　", "<|endoftext|>", "ing", "\x1c", "\x85", "_", "    ", "\\", "ſ", "İ", "ÃÂ"]
)


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=80), st.lists(PARTS, max_size=40).map("".join)))
def test_ids_and_text_equal_the_library(text):
    ids = B.Encoder(MERGES).encode(text)
    assert ids == library_ids(text)
    assert B.Decoder(MERGES).decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(
    st.one_of(
        st.text(max_size=80),
        st.lists(PARTS, max_size=90).map("".join),
        st.lists(st.tuples(PARTS, st.integers(1, 150)), max_size=6).map(lambda x: "".join(p * n for p, n in x)),
    ),
    st.integers(1, 90),
    st.sampled_from([64, 80, 1 << 16]),
)
def test_pieces_give_the_ids_of_the_whole(text, size, piece):
    """Wherever a text is cut, special tokens and long runs included."""
    encoder = B.Encoder(MERGES, piece=piece)
    for _ in range(2):  # nothing of a text is left for the next
        parts = encoder.stream(text[at : at + size] for at in range(0, len(text), size))
        assert [i for ids in parts for i in ids] == library_ids(text)
    assert encoder.encode(text) == library_ids(text)


@pytest.mark.parametrize("unit", ["the wheel of time ", "etaoin" * 50, "日本語", " ", "\n", "-=", "12 ", "x\n"])
def test_long_texts_are_read_in_constant_memory(unit):
    """Tokens come long before the end, through the transducer; what is held does not grow."""
    rng = random.Random(4)
    piece = 1 << 12
    text = (unit * (400_000 // len(unit)))[: 400_000 - rng.randint(0, 5)] + "ending"
    encoder, read, held, early, seen = B.Encoder(MERGES, piece=piece), 0, [], [], []

    def pieces():
        nonlocal read
        for at in range(0, len(text), piece):
            read += piece
            yield text[at : at + piece]

    for ids in encoder.stream(pieces()):
        seen += ids
        early.append(len(seen))
        held.append(len(encoder.transducer._held))
    assert seen == library_ids(text)
    half = early[len(early) // 2]
    assert half >= 0.4 * len(seen), "half of the text gives its tokens before the rest is read"
    assert max(held) <= encoder.transducer.window + 4 * 2 * piece


def test_every_run_goes_through_the_transducer(monkeypatch):
    pushed = []
    push = B.Transducer.push
    monkeypatch.setattr(B.Transducer, "push", lambda self, data: pushed.append(data) or push(self, data))
    assert B.Encoder(MERGES).encode("one two  two\nthree") == library_ids("one two  two\nthree")
    runs = [b"one", b" two", b" ", b"\n", b"three"]
    assert sorted(pushed) == sorted(runs), "a run that has been met is not read again"


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 50256), max_size=30))
def test_any_ids_decode_as_in_the_library(ids):
    assert B.Decoder(MERGES).decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("letters", ["a", "ab", "ethanosr", "ÃÂ", "-=", " "])
def test_long_runs_are_streamed(letters):
    rng = random.Random(len(letters))
    run = "".join(rng.choice(letters) for _ in range(30000))
    machine = B.Transducer(MERGES)
    data, ids, held = run.encode(), [], 0
    for at in range(0, len(data), 1000):
        ids += machine.push(data[at : at + 1000])
        held = max(held, len(machine._held))
    early = len(ids)
    ids += machine.finish()
    assert ids == library_ids(run)
    assert early and held <= machine.window + 1000


def test_lookahead_is_sufficient():
    """Tokens that far behind the end do not change, however the run goes on."""
    rng = random.Random(9)
    for _ in range(20):
        run = bytes(rng.choice(b"etaoinshrdlu") for _ in range(400))
        for end in (150, 250, 399):
            part, whole = MERGES.cut(run[:end], None), MERGES.cut(run, None)
            reached = 0
            for a, b in zip(part, whole, strict=False):
                if a != b:
                    break
                reached += MERGES.size[a]
            assert end - reached <= MERGES.lookahead


def test_pairs_beside_each_other():
    rng = random.Random(2)
    tokens = list(MERGES.parts)
    for _ in range(2000):
        a, b = rng.choice(tokens), rng.choice(tokens)
        joined = MERGES.bytes_of[a] + MERGES.bytes_of[b]
        assert MERGES.beside(a, b) == (MERGES.merge(joined) == [a, b])


def test_operators(documents, odd_texts):
    texts = [*odd_texts, "<|endoftext|>x", "a" * 20000]
    path = tokenizer_path()
    encoded = B.encode(documents(texts, extra=True), path)
    rows = sorted(encoded.collect(), key=lambda r: r.doc_id)
    assert [list(r.tokens.ids) for r in rows] == [library_ids(t or "") for t in texts]
    back = B.decode(encoded.select("doc_id", "tokens.ids"), path).collect()
    assert {r.doc_id: r.text for r in back} == {i: t or "" for i, t in enumerate(texts)}
    assert B.encode(documents([]), path).count() == 0
    nothing = encoded.selectExpr("doc_id", "cast(null as array<int>) AS ids").limit(1)
    assert B.decode(nothing, path).first().text == ""
