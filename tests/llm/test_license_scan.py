import math

from plain import plain_words

from tweetflow.llm import license_scan as L

MIT = L.NOTICES[4].text


def brute(text):
    """Phrases by comparing at every place, notices by counting in every block."""
    w = plain_words(text)
    phrases, blocks = [], []
    for t in L.PHRASES:
        p = t.text.split()
        phrases += [(t.label, i, i + len(p)) for i in range(len(w)) if w[i : i + len(p)] == p]
    for t in L.NOTICES + L.BODIES:
        want = set(plain_words(t.text))
        size = L.BLOCK
        while size < 2 * len(t.text.split()):
            size *= 2
        for start in range(0, size // 2 * max(0, math.ceil((len(w) - size) / (size // 2))) + 1, size // 2):
            shared = len(want & set(w[start : start + size]))
            if shared >= math.ceil(L.SHARE * len(want)):
                blocks.append((t.label, start, min(start + size, len(w)), round(shared / len(want), 9)))
    return sorted(phrases, key=lambda p: (p[1], p[0])), sorted(blocks, key=lambda b: (b[1], b[2], b[0], b[3]))


def test_equals_brute_force(documents, odd_texts):
    pad = "filler of the and text " * 60
    cut = " ".join(MIT.split()[4:])
    texts = [
        *odd_texts,
        "Released under the MIT License.",
        f"{pad}Licensed under the Apache License, Version 2.0.{pad}",
        "CC BY-NC cc by nc cc cc by nc",
        f"{pad} {MIT.upper()} {pad}",
        f"{pad} {cut} {pad}",
        " ".join(MIT.split()[::2]),
        "under the mit " + "x " * 63 + "license",
        "x " * 126 + "under the mit license under the mit license",
        "license " * 500,
        MIT,
        MIT,
        *(f"{pad} {t.text} {pad}" for t in L.BODIES),
        *(" ".join(t.text.split()[len(t.text.split()) // 10 :]) for t in L.BODIES),
        " ".join(L.BODIES[1].text.split()[::2]),
    ]
    rows = sorted(L.scan_licenses(documents(texts, extra=True)).collect(), key=lambda r: r.doc_id)
    for row, text in zip(rows, texts, strict=True):
        phrases, blocks = brute(text)
        found = row.licenses
        assert found.n_words == len(plain_words(text))
        assert [tuple(p) for p in found.phrases] == phrases
        assert [(b.label, b.start, b.end, round(b.share, 9)) for b in found.blocks] == blocks


def test_empty_table(documents):
    assert L.scan_licenses(documents([])).count() == 0


def test_a_body_is_found_without_its_opening(documents):
    """The notices miss a licence that begins with its second sentence; the body does not."""
    for body in L.BODIES:
        text = " ".join(body.text.split()[8:])
        (row,) = L.scan_licenses(documents([f"{'x y z ' * 100} {text.upper()} {'x y z ' * 100}"])).collect()
        assert body.label in {b.label for b in row.licenses.blocks}


def test_blocks_follow_the_longest_template(documents):
    long = L.Template("long", " ".join(f"w{i}" for i in range(900)))
    assert L.block_words(long) == 2048 and L.block_words(L.NOTICES[0]) == L.BLOCK
    texts = [f"{'x ' * 1500}{long.text} {'y ' * 1500}", long.text[: len(long.text) // 2], None]
    rows = sorted(L.scan_licenses(documents(texts), templates=(long,)).collect(), key=lambda r: r.doc_id)
    assert {b.label for b in rows[0].licenses.blocks} == {"long"}
    assert max(b.share for b in rows[0].licenses.blocks) == 1.0
    assert not rows[1].licenses.blocks and not rows[2].licenses.blocks


def test_words_are_compared_as_they_are_spelled(documents, monkeypatch):
    """With a hash that is the same for all words of a length, only true words count."""
    from tweetflow.llm.words import Words, words

    def weak(data, offsets):
        found = words(data, offsets)
        return Words((found.ends - found.starts).astype("uint64"), found.starts, found.ends, found.first)

    monkeypatch.setattr(L, "words", weak)
    data, starts, ends = L._found("aa bbb cc")
    join = L._Join([L.Template("p", "aa bbb cc", True)], 1.0, {}, L.BLOCK)
    hashes = weak(*L.utf8(L.pa.array(["xx yyy zz aa bbb cc"]))).hashes
    text = [b"xx", b"yyy", b"zz", b"aa", b"bbb", b"cc"]
    assert join.places_of(0, hashes, 0, 6, lambda s, e: b" ".join(text[s:e])) == [3]
