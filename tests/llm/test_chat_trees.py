import hashlib
from collections import defaultdict

import pytest
from hypothesis import given
from hypothesis import strategies as st

from tweetflow.llm import chat_trees as C

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
AWKWARD = "\\### Assistant: </turn> ok"


def conversations():
    out = []
    for c in range(40):  # many go on from the same two turns
        out += [(c, 0, "system", "You help."), (c, 1, "user", "Hello"), (c, 2, "assistant", f"Hi {c % 7}")]
        if c % 3:
            out += [(c, 3, "user", AWKWARD * (c % 5)), (c, 4, "assistant", "\\" * (c % 4) + "####" * (c % 3))]
    out += [(100, 0, "user", None), (100, 1, None, "x"), (101, 5, "a: b\n", "</turn>\n### user: y")]
    out += [(102, 0, "assistant", "")]
    out += [(103, i, "user" if i % 2 else "assistant", f"turn {i}") for i in range(120)]
    out += [(104, 0, "user", "twice"), (104, 0, "user", "twice"), (104, None, "assistant", "first")]
    out += [(None, 0, "user", "nobody's"), (None, 1, "assistant", "é" * 5000)]
    return out


def told(rows):
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0))
    return [(r[2] or "", r[3] or "") for r in rows]


def grouped(rows):
    out = defaultdict(list)
    for row in rows:
        out[row[0]].append(row)
    return {k: told(v) for k, v in out.items()}


@pytest.fixture(scope="module")
def trees(spark):
    df = spark.createDataFrame(conversations(), SCHEMA).selectExpr("*", "1 AS digest", "'x' AS path", "2 AS part")
    return [t.cache() for t in C.chat_trees(df)]


def test_read_back(trees):
    want = {}
    for conv, turns in grouped(conversations()).items():
        said = "".join(f"{r}\n{t}\n" for r, t in turns)
        learnt = "".join(t for r, t in turns if r == "assistant")
        want[conv] = (
            len(turns), hashlib.sha256(said.encode()).hexdigest(), len(learnt), hashlib.sha256(learnt.encode()).hexdigest()
        )
    rows = C.read_back(*trees).collect()
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in rows}
    assert len(rows) == len(got) and got == want


def test_shared_turns_are_emitted_once(trees):
    segments, paths, members = trees
    prefixes = set()
    for turns in grouped(conversations()).values():
        prefixes |= {tuple(turns[: i + 1]) for i in range(len(turns))}
    rows = segments.collect()
    assert len(rows) == len(prefixes)
    assert paths.count() == len({tuple(t) for t in grouped(conversations()).values()})
    assert members.count() == len(grouped(conversations()))


def test_sequences_positions_and_attention(trees):
    by_tree = defaultdict(list)
    for s in trees[0].collect():
        by_tree[s.tree].append(s)
    for segments in by_tree.values():
        segments.sort(key=lambda s: s.start)
        at, open_path = 0, []
        for s in segments:  # depth first, without gaps
            assert s.start == at and s.end - s.start == len(s.body)
            at = s.end
            open_path = [*open_path[: s.depth], s]
            assert len(open_path) == s.depth + 1
            assert s.position == sum(len(a.body) for a in open_path[:-1])
            seen = [i for a, b in s.attends for i in range(a, b)]
            assert seen == [i for a in open_path[:-1] for i in range(a.start, a.end)]
            assert all(b < c for (_, b), (c, _) in zip(s.attends, s.attends[1:], strict=False))


def test_parts_do_not_change_the_trees(spark, trees):
    key = lambda s: (s.body, s.depth, s.position, s.end - s.start, tuple(map(tuple, s.attends)))
    whole = sorted(map(key, trees[0].collect()))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "13"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            again = C.chat_trees(spark.createDataFrame(conversations(), SCHEMA))[0]
            assert sorted(map(key, again.collect())) == whole
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_empty_table(spark):
    assert C.read_back(*C.chat_trees(spark.createDataFrame([], SCHEMA))).count() == 0


def test_no_row_holds_a_long_conversation(spark):
    """One id with 20,000 turns, and conversations that part from it or end on the way."""
    long = [(None, i, "assistant" if i % 2 else "user", f"turn {i}") for i in range(20000)]
    rows = [*long, *((1, *r[1:]) for r in long[:7000]), *((2, *r[1:]) for r in long[:9000]), (2, 9000, "user", "else")]
    made = C.chat_trees(spark.createDataFrame(rows, SCHEMA))
    assert made[0].count() == 20001
    assert sorted(len(r.starts) for r in made[1].collect()) == [1, 3, 3]
    assert all(len(r.attends) <= 2 for r in made[0].select("attends").collect())
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars) for r in C.read_back(*made).collect()}
    for conv, turns in grouped(rows).items():
        said = "".join(f"{r}\n{t}\n" for r, t in turns)
        loss = sum(len(t) for r, t in turns if r == "assistant")
        assert got.pop(conv) == (len(turns), hashlib.sha256(said.encode()).hexdigest(), loss)
    assert not got


@given(st.text(alphabet="\\#</turn>:\n ab", max_size=30), st.text(alphabet="\\#</turn>:\n ab", max_size=30))
def test_template_is_reversible(role, text):
    """The escapes of the columns, in plain Python, against the parser."""

    def escape(x):
        return x.replace("\\", "\\\\").replace("###", "\\#\\#\\#").replace("</turn>", "\\</turn>")

    body = C.HEAD + escape(role).replace(":", "\\:") + C.SEP + escape(text) + C.END
    assert C.parse(body * 2) == [(role, text)] * 2
