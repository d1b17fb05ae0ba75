import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tweetflow.llm import token_alignment as A
from tweetflow.llm.bpe_stream import byte_alphabet
from tweetflow.llm.queries import piece_path, tokenizer_path

ODD = [
    "<|endoftext|> stays text <|endoftext|>",
    "a▁b",
    "<0x41> <s> </s> <unk>",
    "  two  blanks   three \n\n line\t tab ",
    " leading",
    "trailing ",
    " ",
    "x\x1c y\x1f z \x85 w\xa0 v　 u",
    "don't we'll I'm 's",
    "é é ½ ﬁ 日本語テキスト 🎉 🎉",
    "\x00 null",
    "12345 -- 67 %% $$",
    "supercalifragilistic" * 20,
]


@pytest.fixture(scope="module")
def tokenizers():
    from sentencepiece import SentencePieceProcessor

    a = Tokenizer.from_file(tokenizer_path())
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=piece_path())


def groups_by_hand(tokenizers, text):
    """Groups of the whole text at once, or None where the bytes differ."""
    a, b = tokenizers
    letters = byte_alphabet()
    said = " " + (text or "")
    a_tokens = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in a.encode(said, add_special_tokens=False).ids]
    b_tokens = []
    for i in b.encode(text or ""):
        piece = b.id_to_piece(i)
        b_tokens.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
    raw = said.encode()
    if not text or b"".join(t for _, t in a_tokens) != raw or b"".join(t for _, t in b_tokens) != raw:
        return None

    def ends(tokens):
        at, out = 0, []
        for _, token in tokens:
            at += len(token)
            out.append(at)
        return out

    cuts = set(ends(a_tokens)) & set(ends(b_tokens))
    sides = []
    for tokens in (a_tokens, b_tokens):
        groups, own = [], []
        for (i, _), end in zip(tokens, ends(tokens), strict=True):
            own.append(i)
            if end in cuts:
                groups.append(own)
                own = []
        sides.append(groups)
    return list(zip(*sides, strict=True))


def by_hand(tokenizers, texts):
    grouped = [groups_by_hand(tokenizers, t) for t in texts]
    counts = {}
    for groups in grouped:
        for pair in {(a, b) for left, right in groups or [] for a in left for b in right}:
            counts[pair] = counts.get(pair, 0) + 1
    best = {}
    for (a, _), n in counts.items():
        best[a] = max(best.get(a, 0), n)
    rows = []
    for groups in grouped:
        if groups is None:
            rows.append((0, 0, 0, 0, 0, 0, ""))
            continue
        links = [(a, b) for left, right in groups for a in left for b in right]
        said = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        rows.append(
            (
                sum(len(a) for a, _ in groups),
                sum(len(b) for _, b in groups),
                len(groups),
                len(links),
                sum(counts[p] == best[p[0]] for p in links),
                sum(counts[p] for p in links),
                hashlib.sha256(said.encode()).hexdigest(),
            )
        )
    return rows, counts


@pytest.fixture(scope="module")
def texts(odd_texts, sf_dir, spark):
    found = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    return [*odd_texts, *ODD, *ODD[:3], *["the same text again"] * 40, *found]


def test_measures_equal_brute_force(documents, tokenizers, texts):
    measures, counts = A.align(documents(texts, extra=True), tokenizer_path(), piece_path())
    want, want_counts = by_hand(tokenizers, texts)
    got = {r.doc_id: tuple(r[m] for m in A.MEASURES) for r in measures.collect()}
    assert len(got) == len(texts)
    for i, row in enumerate(want):
        assert got[i] == row, texts[i]
    assert {(r.a, r.b): r.n for r in counts.collect()} == want_counts


def test_segments_join_up_and_tokenise_alike(tokenizers):
    """Random texts of awkward characters: by segments as whole."""
    rng = random.Random(3)
    aligner = A.Aligner(tokenizer_path(), piece_path())
    letters = "ab c  \n\t\x1c\x85\xa0 'sé日▁🎉1-<|endoftext|>"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 40))) for _ in range(300)]
    # Without the sign that is never given back as well.
    texts += [t.replace("▁", "") or "x" for t in texts]
    found = aligner.align(texts)
    assert any(found.digests[:300]) and all(found.digests[300:])
    for i, text in enumerate(texts):
        assert "".join(A.SEGMENT.findall(" " + text)) == " " + text
        groups = groups_by_hand(tokenizers, text)
        if groups is None:
            assert found.digests[i] == "" and not found.measures[:, i].any(), repr(text)
        else:
            said = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
            assert found.digests[i] == hashlib.sha256(said.encode()).hexdigest(), repr(text)
            sizes = (sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups))
            assert tuple(found.measures[:3, i].tolist()) == sizes


def test_however_segments_are_joined(texts, monkeypatch):
    some = [t or "" for t in texts[:60]]
    whole = A.Aligner(tokenizer_path(), piece_path()).align(some)
    monkeypatch.setattr(A, "_CHUNK", 7)
    parts = [A.Aligner(tokenizer_path(), piece_path()).align(some[i : i + 7]) for i in range(0, len(some), 7)]
    assert [d for p in parts for d in p.digests] == whole.digests
    monkeypatch.setattr(A, "_chunks", lambda kinds, _: [(i, i + 1) for i in range(len(kinds))])
    again = A.Aligner(tokenizer_path(), piece_path()).align(some)
    assert again.digests == whole.digests and (again.measures == whole.measures).all()
    assert (again.pairs == whole.pairs).all() and (again.links == whole.links).all()


@pytest.mark.parametrize("shard, gather, buckets", [(500, 5, 3), (2 << 20, 1 << 21, 200)])
def test_sums_over_shards_and_buckets(documents, tokenizers, texts, shard, gather, buckets, monkeypatch):
    monkeypatch.setattr(A, "SHARD", shard)
    monkeypatch.setattr(A, "_GATHER", gather)
    some = texts[:90]
    measures, counts = A.align(documents(some), tokenizer_path(), piece_path(), buckets=buckets)
    want, want_counts = by_hand(tokenizers, some)
    assert {r.doc_id: tuple(r[m] for m in A.MEASURES) for r in measures.collect()} == dict(enumerate(want))
    assert {(r.a, r.b): r.n for r in counts.collect()} == want_counts


def test_empty_tables_and_rows_without_ids(documents):
    measures, counts = A.align(documents([]), tokenizer_path(), piece_path())
    assert measures.count() == 0 and counts.count() == 0
    measures, counts = A.align(documents([None, ""]), tokenizer_path(), piece_path())
    assert [tuple(r)[1:] for r in measures.collect()] == [(0, 0, 0, 0, 0, 0, "")] * 2 and counts.count() == 0
    docs = documents(["one text"] * 3).withColumn("doc_id", F.lit(None).cast("bigint"))
    measures, counts = A.align(docs, tokenizer_path(), piece_path())
    assert measures.count() == 3 and {r.n for r in counts.collect()} == {3}


def test_a_vocabulary_that_goes_on_behind_blanks_is_refused(monkeypatch):
    class Odd:
        def __init__(self, model_file):
            pass

        def get_piece_size(self):
            return 1

        def id_to_piece(self, i):
            return "of▁the"

    monkeypatch.setattr("sentencepiece.SentencePieceProcessor", Odd)
    with pytest.raises(ValueError, match="behind a blank"):
        A._pieces("any")


def test_the_vocabulary_file_has_the_bytes_of_every_id():
    with open(tokenizer_path(), encoding="utf-8") as file:
        vocab = json.load(file)["model"]["vocab"]
    assert len(A._byte_level(tokenizer_path())[2]) == len(vocab)


def test_both_functions_of_the_byte_level_vocabulary_agree(texts):
    any_text, plain_text, _ = A._byte_level(tokenizer_path())
    assert any_text is not plain_text
    rng = random.Random(9)
    letters = "".join(map(chr, [*range(0x21, 0x7F), *range(0xA1, 0x250)])) + "'" * 9 + "  stdreve"
    segments = {s for t in texts for s in A.SEGMENT.findall(" " + (t or "")) if A._kind(s) == 0}
    segments |= {" x" + "".join(rng.choice(letters) for _ in range(rng.randint(1, 30))) + "x" for _ in range(3000)}
    segments = sorted(s for s in segments if A._kind(s) == 0)
    assert len(segments) > 3000
    assert [plain_text(s) for s in segments] == [any_text(s) for s in segments]


def test_a_vocabulary_in_another_order_has_one_function(tmp_path):
    with open(tokenizer_path(), encoding="utf-8") as file:
        content = json.load(file)
    content["model"]["merges"][:2] = content["model"]["merges"][1::-1]
    path = tmp_path / "other.json"
    path.write_text(json.dumps(content))
    any_text, plain_text, _ = A._byte_level(str(path))
    assert any_text is plain_text
