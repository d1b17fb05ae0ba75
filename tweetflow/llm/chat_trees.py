"""Chat formatting as prefix trees.

Conversations that begin with the same turns share them: each shared turn is
emitted once, followed by everything that goes on from it, depth first. Every
segment (a turn) has the position its first token has in its conversations, and
the intervals of its tree's sequence that its tokens attend to besides the
earlier tokens of the segment itself: those of its ancestors. Tokens are code
points here.

Neither a tree nor a conversation is ever held in one place. Turns are rows, each
with a digest of its conversation up to it. Turns that the same conversations go
through follow one another as a run: a conversation is a path of runs, sorted
with the others. A run is new where a path parts from the one before it, and the
sum of the new runs' lengths so far is where it is emitted. Texts stay out of the
sort and are joined to their segments afterwards.

A path has a new run only where another conversation ends or parts from it, each
time after more turns, so a path of k runs takes some k * k / 2 turns in the table.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tweetflow.llm.frames import bound_batches, pick, stored

#: The template: a turn is HEAD role SEP text END.
HEAD, SEP, END = "### ", ": ", "</turn>\n"
_TURN = re.compile(r"### ((?:\\.|[^\\:])*): ((?:\\.|[^\\])*?)</turn>\n", re.DOTALL)
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_DIGEST = 32  # hex digits of a run in a path


def escape(text: Column) -> Column:
    """A backslash before backslashes and before what marks turns."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    text = F.replace(text, F.lit("###"), F.lit("\\#\\#\\#"))
    return F.replace(text, F.lit("</turn>"), F.lit("\\</turn>"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def parse(text: str) -> list[tuple[str, str]]:
    """``(role, text)`` of the turns of a formatted conversation."""
    turns, at = [], 0
    while at < len(text):
        match = _TURN.match(text, at)
        if match is None:
            raise ValueError(f"no turn at {at}")
        turns.append((unescape(match[1]), unescape(match[2])))
        at = match.end()
    return turns


def _turns(conversations: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """``conv_id, turn, digest, role, body, chars, loss``: formatted turns.

    ``loss`` is where the text of an assistant's turn begins and ends, else null.
    """
    own = pick(conversations, conv_id=conv_id, turn=turn, role=role, text=text)
    role_, text_ = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    named = F.replace(escape(role_), F.lit(":"), F.lit("\\:"))
    body = F.concat(F.lit(HEAD), named, F.lit(SEP), escape(text_), F.lit(END))
    begin = F.length(named) + len(HEAD) + len(SEP)
    loss = F.when(
        role_ == "assistant",
        F.struct(begin.alias("start"), (F.length(body) - len(END)).alias("end")),
    )
    return own.select(
        "conv_id",
        "turn",
        F.unhex(F.substring(F.sha2(body, 256), 1, _DIGEST)).alias("digest"),
        role_.alias("role"),
        body.alias("body"),
        F.length(body).cast("bigint").alias("chars"),
        loss.alias("loss"),
    )


def _chained(turns: DataFrame) -> DataFrame:
    """The turns in order, without texts: ``conv_id, depth, node, digest, chars, position``.

    ``node`` is a digest of the conversation up to and with the turn.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, depth = None, None
        for batch in batches:
            depths, nodes, positions = [], [], []
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "digest", "chars"))
            for number, digest, chars in zip(*columns, strict=True):
                if depth is None or number != conv:
                    conv, depth, node, position = number, 0, b"", 0
                node = hashlib.blake2b(node + digest, digest_size=_DIGEST // 2).digest()
                depths.append(depth)
                nodes.append(node)
                positions.append(position)
                depth += 1
                position += chars
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), pa.array(depths, pa.int64()), pa.array(nodes, pa.binary()),
                 batch.column("digest"), batch.column("chars"), pa.array(positions, pa.int64())],
                names=["conv_id", "depth", "node", "digest", "chars", "position"],
            )

    schema = T.StructType.fromDDL("depth bigint, node binary, digest binary, chars bigint, position bigint")
    ordered = turns.select("conv_id", "turn", "role", "digest", "chars").repartition("conv_id")
    ordered = ordered.sortWithinPartitions("conv_id", "turn", "role", "digest", "chars")
    return ordered.mapInArrow(run, T.StructType([turns.schema["conv_id"], *schema]))


def _in_runs(chained: DataFrame) -> DataFrame:
    """The turns with ``run`` and ``run_position``, the node and place of their run's first turn.

    A run goes on as long as as many rows go through the next turn; ``closes``
    is true of its last turn.
    """
    names = ["conv_id", "depth", "node", "digest", "chars", "position", "run", "run_position", "closes"]
    types = [pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, through, conv_type = None, None, None

        def rows(out):
            columns = zip(*out, strict=True) if out else [[]] * len(names)
            arrays = [pa.array(x, t) for x, t in zip(columns, [conv_type, *types], strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for batch in batches:
            conv_type, out = batch.schema.field("conv_id").type, []
            for *turn, n in zip(*(batch.column(c).to_pylist() for c in (*names[:6], "n")), strict=True):
                fresh = turn[1] == 0 or n != through
                if held is not None:
                    out.append((*held, fresh))
                if fresh:
                    head, at = turn[2], turn[5]
                held, through = (*turn, head, at), n
            yield rows(out)
        if held is not None:
            yield rows([(*held, True)])

    schema = T.StructType.fromDDL("run binary, run_position bigint, closes boolean")
    counts = chained.groupBy("node").agg(F.count("*").alias("n"))
    ordered = chained.join(counts, "node").select(*names[:6], "n").repartition("conv_id")
    ordered = ordered.sortWithinPartitions("conv_id", "depth")
    return ordered.mapInArrow(run, T.StructType([*chained.schema, *schema]))


def _paths(turned: DataFrame) -> DataFrame:
    """``conv_id, path_key, path, chars``: a conversation as first nodes and lengths of its runs."""
    length = F.col("position") + F.col("chars") - F.col("run_position")
    run = F.struct("depth", F.lower(F.hex("run")).alias("run"), length.alias("chars"))
    grouped = turned.filter("closes").groupBy("conv_id").agg(F.array_sort(F.collect_list(run)).alias("t"))
    path = F.array_join(F.transform("t", lambda t: t.run), "")
    return grouped.select(
        "conv_id",
        path.alias("path"),
        F.transform("t", lambda t: t.chars).alias("chars"),
    ).withColumn("path_key", F.sha2("path", 256))


def _digests(path: str) -> list[str]:
    return [path[i : i + _DIGEST] for i in range(0, len(path), _DIGEST)]


def _common(a: list[str], b: list[str]) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


class _Walk:
    """Paths in order: which runs of each are new, and where each run is emitted."""

    def __init__(self, path: list[str], starts: list[int], at: int):
        self.path, self.starts, self.at = path, starts, at

    def step(self, path: list[str], chars: list[int]) -> int:
        """Go on to ``path``; how many of its runs have been emitted before."""
        shared = _common(self.path, path)
        starts = self.starts[:shared]
        for n in chars[shared:]:
            starts.append(self.at)
            self.at += n
        self.path, self.starts = path, starts
        return shared


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per part: its first and last path, and how much it emits."""
    part, walk, first = None, None, None

    def row():
        chars = pa.array([first[1]], pa.list_(pa.int64()))
        starts = pa.array([walk.starts], pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([first[0]]), chars, pa.array(["".join(walk.path)]), starts,
             pa.array([walk.at], pa.int64())],
            names=["part", "first", "first_chars", "last", "last_starts", "total"],
        )

    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("part", "path", "chars"))
        for number, path, chars in zip(*columns, strict=True):
            if number != part:
                if part is not None:
                    yield row()
                part, walk, first = number, _Walk([], [], 0), (path, chars)
            walk.step(_digests(path), chars)
    if part is not None:
        yield row()


def _carried(summaries: list) -> dict[int, tuple[list[str], list[int], int]]:
    """Where each part takes up: the path before it, its starts, and the next free place."""
    carried, path, starts, at = {}, [], [], 0
    for s in sorted(summaries, key=lambda s: s.part):
        carried[s.part] = (path, starts, at)
        shared = _common(path, _digests(s.first))
        # Runs shared with the path before were emitted there, not here.
        spared = sum(s.first_chars[:shared])
        here = [starts[j] if x < spared else at + x - spared for j, x in enumerate(s.last_starts)]
        path, starts, at = _digests(s.last), here, at + s.total - spared
    return carried


_INTERVAL = pa.struct([("start", pa.int64()), ("end", pa.int64())])
_PLACED = pa.schema(
    [
        ("tree", pa.int64()),
        ("path_key", pa.string()),
        ("starts", pa.list_(pa.int64())),
        ("chars", pa.list_(pa.int64())),
        ("run", pa.binary()),
        ("run_start", pa.int64()),
        ("before", pa.list_(_INTERVAL)),
    ]
)
PLACES = (
    "tree bigint, path_key string, starts array<bigint>, chars array<bigint>, run binary, run_start bigint,"
    " before array<struct<start:bigint,end:bigint>>"
)
_HELD = 1 << 16  # starts and intervals in a batch


def _places(sorted_paths: DataFrame) -> DataFrame:
    """A row for each distinct path, with the places of its runs, and one for each run.

    The row of a run has no ``path_key``; ``before`` are the intervals of the
    runs before it, those that touch joined.
    """
    schema = (
        "part int, first string, first_chars array<bigint>, last string, last_starts array<bigint>,"
        " total bigint"
    )
    parts = sorted_paths.repartition("part").sortWithinPartitions("part", "path")
    columns = parts.select("part", "path", "chars", "path_key")
    carried = _carried(columns.mapInArrow(_summaries, schema).collect())  # one row per part

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        part, walk = None, None
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("part", "path", "chars", "path_key"))
            for number, path, chars, key in zip(*columns, strict=True):
                if number != part:
                    before, starts, at = carried[number]
                    part, walk = number, _Walk(before, list(starts), at)
                shared = walk.step(_digests(path), chars)
                tree = walk.starts[0]
                starts = [s - tree for s in walk.starts]
                yield {"tree": tree, "path_key": key, "starts": starts, "chars": chars}
                attends = []
                for i, (start, n) in enumerate(zip(starts, chars, strict=True)):
                    if i >= shared:
                        run = bytes.fromhex(walk.path[i])
                        yield {"tree": tree, "run": run, "run_start": start, "before": [*attends]}
                    if attends and attends[-1]["end"] == start:
                        attends[-1] = {"start": attends[-1]["start"], "end": start + n}
                    else:
                        attends.append({"start": start, "end": start + n})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held = [], 0
        for row in rows(batches):
            out.append(row)
            held += 8 + len(row.get("starts", ())) + len(row.get("before", ()))
            if held > _HELD:
                yield pa.RecordBatch.from_pylist(out, schema=_PLACED)
                out, held = [], 0
        yield pa.RecordBatch.from_pylist(out, schema=_PLACED)

    return columns.mapInArrow(run, PLACES)


def _attends() -> Column:
    """The intervals before the run, and the turns of the run before this one."""
    before, start = F.col("before"), F.col("run_start")
    last = F.element_at(before, -1)
    touches = (F.size(before) > 0) & F.coalesce(F.try_element_at(before, F.lit(-1)).end == start, F.lit(False))
    interval = lambda a: F.array(F.struct(a.alias("start"), F.col("start").alias("end")))
    return (
        F.when(F.col("start") == start, before)
        .when(touches, F.concat(F.slice(before, 1, F.size(before) - 1), interval(last.start)))
        .otherwise(F.concat(before, interval(start)))
    )


def chat_trees(
    conversations: DataFrame,
    *,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(segments, paths, members)`` of all conversations.

    ``segments``: ``tree, start, end, position, depth, attends, role, body,
    loss, run_start``, each turn once per tree; ``start`` and ``end`` are places
    in the tree's sequence, ``position`` the place in the conversation,
    ``attends`` the ancestors' intervals, ``loss`` what to learn of ``body``,
    ``run_start`` where the turn's run begins. ``paths``: ``path_key, tree,
    starts, chars`` of each distinct conversation, with places and lengths of its
    runs; ``members``: ``conv_id, path_key``.

    Turns are ordered by number, then role and text digest, so turns that share
    a number have a fixed order and repeated rows stay repeated turns. Null
    roles and texts are empty; rows without ``conv_id`` are one conversation;
    null turn numbers come first.
    """
    turns = _turns(conversations, conv_id, turn, role, text)
    bound_batches(conversations.sparkSession)
    turned = stored(_in_runs(stored(_chained(turns), "chained")), "turned")
    paths = stored(_paths(turned), "paths")
    members = paths.select("conv_id", "path_key")
    # Copies of a conversation are one path, reduced before the shuffle.
    distinct = paths.groupBy("path_key").agg(
        F.first("path").alias("path"), F.first("chars").alias("chars")
    )
    parts = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = distinct.repartitionByRange(parts, "path").withColumn("part", F.spark_partition_id())
    placed = stored(_places(stored(ranged, "sorted")), "places")
    # What a turn is and where it stands in its run is the same in all conversations through it.
    columns = ("depth", "digest", "chars", "position", "run", "run_position")
    nodes = turned.groupBy("node").agg(*(F.first(c).alias(c) for c in columns))
    runs = placed.filter(F.col("path_key").isNull()).select("tree", "run", "run_start", "before")
    start = F.col("run_start") + F.col("position") - F.col("run_position")
    new = (
        nodes.join(runs, "run")
        .withColumn("start", start)
        .select(
            "tree",
            "start",
            (F.col("start") + F.col("chars")).alias("end"),
            "position",
            F.col("depth").cast("int").alias("depth"),
            _attends().alias("attends"),
            "digest",
            "run_start",
        )
    )
    bodies = turns.groupBy("digest").agg(
        F.first("role").alias("role"), F.first("body").alias("body"), F.first("loss").alias("loss")
    )
    segments = stored(
        new.join(bodies, "digest").select(
            "tree", "start", "end", "position", "depth", "attends", "role", "body", "loss", "run_start"
        ),
        "segments",
    )
    told = placed.filter(F.col("path_key").isNotNull()).select("path_key", "tree", "starts", "chars")
    return segments, told, members


def read_back(segments: DataFrame, paths: DataFrame, members: DataFrame) -> DataFrame:
    """Each conversation as it is found in the trees: ``conv_id`` and what was read.

    ``n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``. A path
    is read once, however many conversations it stands for, turn by turn: no
    more of it is held than a batch of turns.
    """
    bound_batches(segments.sparkSession)
    asked = paths.select("path_key", "tree", F.explode("starts").alias("run_start"))
    found = segments.select("tree", "run_start", "start", "body", "loss").join(asked, ["tree", "run_start"])
    texts = found.select("path_key", "start", "body", "loss").repartition("path_key")
    texts = texts.sortWithinPartitions("path_key", "start")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, n_turns, loss_chars, formatted = None, 0, 0, 0
        said, learnt = hashlib.sha256(), hashlib.sha256()

        def row():
            return {
                "path_key": key,
                "n_turns": n_turns,
                "turns_sha256": said.hexdigest(),
                "loss_chars": loss_chars,
                "loss_sha256": learnt.hexdigest(),
                "formatted_chars": formatted,
            }

        for batch in batches:
            out = []
            columns = (batch.column(c).to_pylist() for c in ("path_key", "body", "loss"))
            for path, body, loss in zip(*columns, strict=True):
                if path != key:
                    if key is not None:
                        out.append(row())
                    key, n_turns, loss_chars, formatted = path, 0, 0, 0
                    said, learnt = hashlib.sha256(), hashlib.sha256()
                for role, text in parse(body):
                    n_turns += 1
                    said.update(f"{role}\n{text}\n".encode())
                if loss:
                    part = unescape(body[loss["start"] : loss["end"]])
                    loss_chars += len(part)
                    learnt.update(part.encode())
                formatted += len(body)
            yield pa.RecordBatch.from_pylist(out, schema=_READ)
        if key is not None:
            yield pa.RecordBatch.from_pylist([row()], schema=_READ)

    read = texts.mapInArrow(
        run,
        "path_key string, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string,"
        " formatted_chars bigint",
    )
    return members.join(read, "path_key").drop("path_key")


_READ = pa.schema(
    [
        ("path_key", pa.string()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
    ]
)
