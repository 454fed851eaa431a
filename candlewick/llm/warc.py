"""WARC archives: written by tasks, indexed first, read by coalesced byte ranges.

``write`` packs rows into gzip members, one per record, in files of bounded size.  ``index`` lists offset, length,
URL, digest and type of every record of any archive files.  ``read`` takes selected index rows, sorts them
by file and offset, joins ranges that lie close to each other into one read, and yields the records.

A task writes to names of its own and reports them only when it is done, so a lost or repeated
attempt leaves a file that no one reads.  Files are reached through the file system of their URI.
"""

from __future__ import annotations

import base64
import hashlib
import math
import uuid
import zlib
from collections.abc import Iterable, Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FILE_BYTES = 256 << 20
#: Ranges of one file that are at most this far apart become one read, up to ``READ_BYTES``.
GAP_BYTES = 64 << 10
READ_BYTES = 8 << 20
#: A record's block is indexed without being held: this much is inflated at a time.
INFLATE_BYTES = 1 << 20

_END = b"\r\n"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
INDEX_SCHEMA = (
    "file string, offset bigint, length bigint, record_id string, url string, record_type string,"
    " payload_digest string, refers_to string"
)
RECORD_SCHEMA = f"{INDEX_SCHEMA}, payload binary"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload, usedforsecurity=False).digest()).decode()


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if "://" in uri or ":/" in uri else (fs.LocalFileSystem(), uri)


def _root(spark: SparkSession) -> str:
    """What stands before a path without scheme where Spark's default file system is not the local one."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    root = (conf.get("fs.defaultFS") or "file:///").rstrip("/")
    return "" if root.startswith("file:") else root


def _located(files: DataFrame) -> DataFrame:
    root, name = _root(files.sparkSession), F.col("file")
    return files.withColumn("file", F.when(name.startswith("/"), F.concat(F.lit(root), name)).otherwise(name)) if root else files


def _one_line(value: str) -> str:
    """A header value; line breaks would end it."""
    return value.replace("\r", "%0D").replace("\n", "%0A")


def record(record_id: str, url: str, payload: bytes, sha: str, refers_to: str | None, date: str) -> bytes:
    """One record.  A revisit carries the digest of the payload it refers to, and only HTTP headers."""
    block = _HTTP % len(payload) + (b"" if refers_to is not None else payload)
    head = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<{record_id}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", _one_line(url)),
        ("WARC-Payload-Digest", f"sha1:{sha}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if refers_to is not None:
        head[5:5] = [
            ("WARC-Refers-To", f"<{refers_to}>"),
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        ]
    lines = b"".join(f"{k}: {v}".encode() + _END for k, v in head)
    return b"WARC/1.1\r\n" + lines + _END + block + _END + _END


def mark_revisits(rows: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``rows`` (``page_id``, ``url``, ``payload`` as text) with ``sha1`` and ``response_id``.

    ``response_id`` is the smallest page_id among equal payloads of at least ``min_bytes`` bytes; it is
    null for a row that is itself a response.  So a row that repeats the smallest page_id is a response too.  Counted by digest
    first, so a payload with a third of the rows is one row per task when it is grouped.
    """
    hashed = rows.withColumn("payload", F.coalesce("payload", F.lit(""))).withColumn("sha1", F.sha1("payload"))
    repeated = (
        hashed.filter(F.octet_length("payload") >= min_bytes)
        .groupBy("sha1")
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("sha1", "first_id")
    )
    joined = hashed.join(repeated, "sha1", "left")
    same = F.col("page_id").eqNullSafe(F.col("first_id"))
    return joined.select("page_id", "url", "payload", "sha1", F.when(~same, F.col("first_id")).alias("response_id"))


def write(rows: DataFrame, folder: str, date: str | None = None) -> DataFrame:
    """Write archives of ``rows`` (as ``mark_revisits`` returns) below ``folder``; returns the lazy list of ``file``s.

    Store the list once: each run of it writes new files.  Record ids end in ``:<page_id>``, nothing for a null id; that of a
    response names its payload, so that revisits can refer to it, and that of a revisit its file and number.  Rows
    that repeat both page_id and payload share the id of their response.  A null URL is empty; an empty table gives no file.
    """
    folder = _root(rows.sparkSession) + folder if folder.startswith("/") else folder
    stamp = date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _open(folder)
        store.create_dir(root, recursive=True)
        done, out, name, number = [], None, "", 0
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                payload = row["payload"].encode("utf-8")
                of, page = row["response_id"], "" if row["page_id"] is None else row["page_id"]
                sha, number = base64.b32encode(bytes.fromhex(row["sha1"])).decode(), number + 1
                own = f"urn:page:{sha}:{page}" if of is None else f"urn:page:{name.partition('.')[0]}-{number}:{page}"
                raw = record(own, row["url"] or "", payload, sha, None if of is None else f"urn:page:{sha}:{of}", stamp)
                packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                out.write(packer.compress(raw) + packer.flush())
                if out.tell() >= FILE_BYTES:
                    out.close()
                    done.append(f"{folder}/{name}")
                    out = None
        if out is not None:
            out.close()
            done.append(f"{folder}/{name}")
        yield pa.RecordBatch.from_arrays([pa.array(done, pa.string())], names=["file"])

    return rows.mapInArrow(run, "file string")


def _headers(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines) if k}


def _index_row(file: str, offset: int, length: int, head: bytes) -> dict:
    h = _headers(head)
    strip = lambda v: None if v is None else v.strip("<>")
    return {
        "file": file,
        "offset": offset,
        "length": length,
        "record_id": strip(h.get("warc-record-id")),
        "url": h.get("warc-target-uri"),
        "record_type": h.get("warc-type"),
        "payload_digest": (h.get("warc-payload-digest") or "").removeprefix("sha1:") or None,
        "refers_to": strip(h.get("warc-refers-to")),
    }


def scan(file: str) -> Iterator[dict]:
    """Index rows of one file of gzip members, holding one piece of it and one record's headers at a time."""
    store, path = _open(file)
    with store.open_input_stream(path, compression=None) as stream:
        data, start = stream.read(INFLATE_BYTES), 0
        while data:
            member, head, at = zlib.decompressobj(31), b"", start
            while not member.eof:
                piece = member.decompress(data, INFLATE_BYTES)
                if b"\r\n\r\n" not in head:
                    head += piece
                left = member.unused_data if member.eof else member.unconsumed_tail
                at += len(data) - len(left)
                data = left
                if not piece and not data and not member.eof:
                    data = stream.read(INFLATE_BYTES)
                    if not data:
                        raise ValueError(f"{file} ends within the record at {start}")
            data = data or stream.read(INFLATE_BYTES)
            yield _index_row(file, start, at - start, head.partition(b"\r\n\r\n")[0])
            start = at


def index(files: DataFrame) -> DataFrame:
    """Index rows (``INDEX_SCHEMA``) of the archives named in column ``file``, each file scanned by one task.

    There are as many tasks as files: names are small, and adaptive execution would join all of them into one.
    """
    names = _located(files.select("file")).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column("file").to_pylist():
                rows = []
                for row in scan(file):
                    rows.append(row)
                    if len(rows) == 10_000:
                        yield _batch(rows, _INDEX)
                        rows = []
                if rows:
                    yield _batch(rows, _INDEX)

    # By another expression than the names are made distinct by, or that exchange, which may be merged, would serve for both.
    return names.repartition(max(1, names.count()), F.xxhash64("file")).mapInArrow(run, INDEX_SCHEMA)


_INDEX = pa.schema(
    [("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())]
    + [(c, pa.string()) for c in ("record_id", "url", "record_type", "payload_digest", "refers_to")]
)
_RECORD = _INDEX.append(pa.field("payload", pa.binary()))


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def coalesce(rows: Iterable[dict], gap: int = GAP_BYTES, most: int = READ_BYTES) -> Iterator[list[dict]]:
    """Index rows sorted by file and offset, cut into runs that one read covers."""
    held: list[dict] = []
    for row in rows:
        if held and (
            row["file"] != held[-1]["file"]
            or row["offset"] - (held[-1]["offset"] + held[-1]["length"]) > gap
            or row["offset"] + row["length"] - held[0]["offset"] > most
        ):
            yield held
            held = []
        held.append(row)
    if held:
        yield held


def payload_of(raw: bytes) -> bytes:
    """What follows the HTTP headers of a record's block."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    size = int(_headers(head).get("content-length", "0"))
    return rest[:size].partition(b"\r\n\r\n")[2]


def read(selected: DataFrame) -> DataFrame:
    """Records (``RECORD_SCHEMA``) of the selected index rows, by coalesced reads in file order.

    The number of tasks follows from the bytes to be read, not from those of the index rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in batch.to_pylist())
        opened, stream = None, None
        for group in coalesce(rows):
            if group[0]["file"] != opened:
                if stream is not None:
                    stream.close()
                opened = group[0]["file"]
                store, path = _open(opened)
                stream = store.open_input_file(path)
            start = group[0]["offset"]
            data = stream.read_at(group[-1]["offset"] + group[-1]["length"] - start, start)
            out = []
            for row in group:
                at = row["offset"] - start
                raw = zlib.decompress(data[at : at + row["length"]], 31)
                out.append(row | {"payload": payload_of(raw)})
            yield _batch(out, _RECORD)
        if stream is not None:
            stream.close()

    columns = [f.name for f in _INDEX]
    wanted = _located(selected.select(*columns))
    tasks = math.ceil((wanted.agg(F.sum("length")).first()[0] or 0) / READ_BYTES)
    part = F.floor(F.col("offset") / READ_BYTES)
    sorted_rows = wanted.repartition(max(1, tasks), "file", part).sortWithinPartitions("file", "offset")
    return sorted_rows.mapInArrow(run, RECORD_SCHEMA)


MEASURED = ["record_id", "record_type", "refers_to", "named_digest", "payload_bytes", "payload_digest"]


def measured(records: DataFrame) -> DataFrame:
    """Records with ``payload_bytes`` and ``payload_digest`` of the payload that was read, without the payload itself, and with
    the digest that their header names as ``named_digest``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            payloads = batch.column("payload").to_pylist()
            sizes = pa.array([len(p) for p in payloads], pa.int64())
            seen = pa.array([digest(p) for p in payloads], pa.string())
            columns = [batch.column(c) for c in ("record_id", "record_type", "refers_to", "payload_digest")]
            yield pa.RecordBatch.from_arrays([*columns, sizes, seen], names=MEASURED)

    kinds = [f"{c} {'bigint' if c == 'payload_bytes' else 'string'}" for c in MEASURED]
    return records.mapInArrow(run, ", ".join(kinds))


def resolved(records: DataFrame) -> DataFrame:
    """``measured`` records in which a revisit has the size and digest of the payload it refers to.

    They meet by the digest that the revisit names and the one that was read, so ids that are repeated do not matter; a
    payload that is in no record leaves both null.
    """
    columns = ("record_id", "record_type", "refers_to", "payload_bytes", "payload_digest")
    revisits = records.filter("record_type = 'revisit'")
    stored = records.filter("record_type = 'response'").groupBy(F.col("payload_digest").alias("__digest")).agg(
        F.first("payload_bytes").alias("__bytes")
    )
    full = revisits.join(stored, F.col("named_digest") == F.col("__digest"), "left").select(
        "record_id", "record_type", "refers_to", F.col("__bytes").alias("payload_bytes"), F.col("__digest").alias("payload_digest")
    )
    return records.filter("record_type <> 'revisit'").select(*columns).unionByName(full)


def page_id(record_id: Column | str) -> Column:
    """Page id of a record id that ``write`` made; null for a page without an id."""
    c = F.col(record_id) if isinstance(record_id, str) else record_id
    return F.substring_index(c, ":", -1).try_cast("bigint")
