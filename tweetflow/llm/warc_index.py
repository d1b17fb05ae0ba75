"""WARC archives that are read by their index.

Every task writes archives of its own: one gzip member per record, so that any
record can be read alone. The index has the file, offset, length, URL and digest
of each record; it is a table, and only what a finished task wrote is in it, so
files left by lost tasks are never read. Reading selects rows of the index
first, sorts them by place, joins neighbouring byte ranges and reads each range
once.

Archives lie in a shared folder on any file system that pyarrow can open.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tweetflow.llm.frames import bound_batches, pick, stored

#: Payloads from this size on are written once; equal ones refer to it.
REVISIT_BYTES = 1000
#: An archive is closed when it has grown to this size.
ARCHIVE_BYTES = 1 << 30
#: Ranges closer than this are read in one go, up to so many bytes at a time.
GAP_BYTES = 64 << 10
READ_BYTES = 8 << 20
#: Compressed bytes that a task reads, about.
TASK_BYTES = 128 << 20
#: The table has no time of capture.
DATE = "1970-01-01T00:00:00Z"

INDEX = (
    "file string, offset bigint, length bigint, url string, payload_digest string, page_id bigint,"
    " record_type string"
)
RECORD = (
    "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string,"
    " refers_to bigint, html string"
)


def _file_system(path: str) -> tuple[fs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def _record_id(page_id: int | None, url: str | None, digest: str) -> str:
    name = hashlib.sha256(f"{page_id}\n{url}\n{digest}".encode()).digest()
    return f"<urn:uuid:{uuid.UUID(bytes=name[:16], version=4)}>"


def _line(value: str | None) -> str:
    """A header value; line ends cannot stand in one."""
    return "" if value is None else value.replace("\r", "%0D").replace("\n", "%0A")


def record_bytes(row: dict) -> bytes:
    """One record, with its HTTP head; a revisit has the head only."""
    payload = (row["html"] or "").encode()
    revisit = row["owner"] is not None
    head = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = head if revisit else head + payload
    page_id, url, digest = row["page_id"], row["url"], row["payload_digest"]
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_record_id(page_id, url, digest)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {_line(url)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"Page-ID: {'' if page_id is None else page_id}",
    ]
    if revisit:
        owner = row["owner"]
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {_record_id(owner['page_id'], owner['url'], digest)}",
            f"WARC-Refers-To-Target-URI: {_line(owner['url'])}",
            f"Refers-To-Page-ID: {'' if owner['page_id'] is None else owner['page_id']}",
        ]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """A record read back; a payload that does not fit its digest is an error."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    if lines[0] != "WARC/1.1" or not rest.endswith(b"\r\n\r\n"):
        raise ValueError("not a WARC record")
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"record {fields['WARC-Record-ID']} is damaged")
    number = lambda name: int(fields[name]) if fields.get(name) else None
    return {
        "page_id": number("Page-ID"),
        "url": fields["WARC-Target-URI"],
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": fields["WARC-Type"],
        "refers_to": number("Refers-To-Page-ID"),
        "html": None if revisit else payload.decode(),
    }


class _Archives:
    """Writes records one after the other, beginning a new file when one is full."""

    def __init__(self, folder: str, archive_bytes: int):
        self.folder, self.archive_bytes = folder, archive_bytes
        self.stream, self.name, self.at = None, "", 0

    def write(self, record: bytes) -> tuple[str, int, int]:
        if self.stream is None or self.at >= self.archive_bytes:
            self.close()
            self.name, self.at = f"{uuid.uuid4().hex}.warc.gz", 0
            system, path = _file_system(self.folder)
            self.stream = system.open_output_stream(f"{path}/{self.name}", compression=None)
        pack = zlib.compressobj(6, zlib.DEFLATED, 31)
        data = pack.compress(record) + pack.flush()
        self.stream.write(data)
        self.at += len(data)
        return self.name, self.at - len(data), len(data)

    def close(self) -> None:
        if self.stream is not None:
            self.stream.close()


def write_archives(
    pages: DataFrame,
    folder: str,
    *,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Write a record per row of ``pages`` to ``folder``; the index of what was written.

    Of the records with equal payloads of ``REVISIT_BYTES`` or more, the one
    with the largest page id (and then URL) is the response, the others revisit
    it; rows that share that id and URL are all responses. A null html is an
    empty payload, a null URL an empty one; null ids come before all others, so
    where all ids are null a revisit refers to null.
    """
    bound_batches(pages.sparkSession)
    own = pick(pages, page_id=page_id, url=url, html=html)
    payload = F.coalesce("html", F.lit(""))
    keyed = own.withColumn("payload_digest", F.sha1(payload))
    # A digest of many pages is reduced within each task before the shuffle.
    owners = (
        keyed.filter(F.octet_length(payload) >= REVISIT_BYTES)
        .groupBy("payload_digest")
        .agg(F.max(F.struct("page_id", "url")).alias("owner"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("payload_digest", "owner")
    )
    # Stored, so that its size is known when the join is planned: pages stay
    # where they are unless the payloads that recur are too many to send round.
    owners = stored(owners, "owners")
    mine = F.struct("page_id", "url")
    rows = keyed.join(owners, "payload_digest", "left").withColumn(
        "owner", F.when(~mine.eqNullSafe(F.col("owner")), F.col("owner"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archives = _Archives(folder, archive_bytes)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                written = []
                for row in batch.slice(at, 256).to_pylist():
                    file, offset, length = archives.write(record_bytes(row))
                    kind = "response" if row["owner"] is None else "revisit"
                    written.append((file, offset, length, row["url"], row["payload_digest"], row["page_id"], kind))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*written, strict=True), _INDEX_TYPES, strict=True)],
                    names=[c.split()[0] for c in INDEX.split(", ")],
                )
        archives.close()

    columns = ["page_id", "url", "html", "payload_digest", "owner"]
    return stored(rows.select(*columns).mapInArrow(run, INDEX), "index")


_INDEX_TYPES = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]


def ranges(places: Iterator[tuple[str, int, int]]) -> Iterator[tuple[str, int, int, list[tuple[int, int]]]]:
    """Sorted ``(file, offset, length)`` joined to ranges: file, start, end, records.

    Records that lie within ``GAP_BYTES`` of one another are read in one range,
    until it has ``READ_BYTES``.
    """
    file, start, end, records = None, 0, 0, []
    for name, offset, length in places:
        if file == name and offset - end <= GAP_BYTES and offset + length - start <= READ_BYTES:
            end = max(end, offset + length)
            records.append((offset, length))
        else:
            if records:
                yield file, start, end, records
            file, start, end, records = name, offset, offset + length, [(offset, length)]
    if records:
        yield file, start, end, records


def read_records(selected: DataFrame, folder: str) -> DataFrame:
    """The records that rows of the index name, parsed; columns of ``RECORD``.

    Tasks get stretches of archives, so an archive is read by as many tasks as
    it is long, and each reads its ranges in order. There are as many tasks as
    the bytes that are read need: the index itself is small and says little
    about them. An index row that comes twice is read twice.
    """
    spark = selected.sparkSession
    bound_batches(spark)
    n_bytes = selected.agg(F.sum("length")).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, n_bytes // TASK_BYTES + 1)
    stretch = (F.col("offset") / F.lit(4 * READ_BYTES)).cast("bigint").alias("stretch")
    placed = (
        selected.select("file", stretch, "offset", "length")
        .repartition(tasks, "file", "stretch")
        .sortWithinPartitions("file", "offset")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = _file_system(folder)

        def places():
            for batch in batches:
                columns = (batch.column(c).to_pylist() for c in ("file", "offset", "length"))
                yield from zip(*columns, strict=True)

        name, source = None, None
        for file, start, end, records in ranges(places()):
            if file != name:
                if source is not None:
                    source.close()
                name, source = file, system.open_input_file(f"{path}/{file}")
            source.seek(start)
            data = source.read(end - start)
            rows = [
                parse_record(zlib.decompress(data[o - start : o - start + n], 31)) for o, n in records
            ]
            yield pa.RecordBatch.from_pylist(rows, schema=_RECORD_SCHEMA)
        if source is not None:
            source.close()

    return placed.mapInArrow(run, RECORD)


_RECORD_SCHEMA = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("html", pa.string()),
    ]
)
