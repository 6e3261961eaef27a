"""WARC archives written with an index, and read back through it.

Every task writes its records into one archive, each record a gzip member of its own, and
returns an index row per record: file, offset, length, URL and digest. The index is stored
once, so a repeated task leaves at most an archive that no index row names. Reading sorts
the index rows of the selected records by file and offset, joins neighbouring byte ranges
into one read, and takes the records apart again; every payload is checked against the
digest in its record.

Records with equal payloads of at least ``LEAST_REVISIT`` bytes are stored once: the one
with the smallest id is a response, the others are revisits, which hold the HTTP header
(with the payload's length) and name the response.

Archives go through pyarrow's file systems, so the folder may be local, shared or remote.

Defined cases: a null html is an empty payload, a null URL has no target line. A null id
never is the smallest; if all ids of a payload are null, all its records are responses.
Rows that repeat an id and a payload are all responses, or all revisits. An empty table
gives no archive. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postgauge.session import ensure_checkpoint_dir, settle

#: Payload bytes from which equal payloads are stored once.
LEAST_REVISIT = 100
#: Bytes between two ranges that are read along, and bytes of one read about.
GAP_BYTES, READ_BYTES = 1 << 16, 4 << 20
#: Time stamp of the records, as the tables have none.
DATE = "1970-01-01T00:00:00Z"

_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_INDEX = (
    "page_id long, url string, file string, offset long, length long, payload_digest string, "
    "record_type string"
)
_RECORD = (
    "page_id long, url string, record_type string, payload binary, payload_bytes long, "
    "payload_digest string, refers_to long"
)


def shared_folder(spark, name: str) -> str:
    """A new folder in the shared checkpoint folder, as a URI."""
    ensure_checkpoint_dir(spark)
    root = spark.sparkContext.getCheckpointDir()
    if root.startswith("file:"):
        root = "file:///" + root[len("file:") :].lstrip("/")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def record(
    page_id: int | None,
    url: str | None,
    payload: bytes,
    digest: str,
    refers_to: int | None,
    revisit: bool,
) -> bytes:
    """One WARC record."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (b"" if revisit else payload)
    shown = "" if page_id is None else page_id
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{shown}:{digest}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"Content-Type: application/http; msgtype=response\r\nContent-Length: {len(block)}",
    ]
    if url is not None:
        lines.insert(3, f"WARC-Target-URI: {quote(url, safe='%!#$&()*+,/:;=?@[]~' + chr(39))}")
    if revisit:
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}:{digest}>"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """The fields of one record; ``payload`` is None for a revisit."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(
        int(line[15:]) for line in http.decode().split("\r\n") if line.startswith("Content-Length:")
    )
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != length or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")

    def page(value: str) -> int | None:
        shown = value.split(":")[2]
        return int(shown) if shown else None

    return {
        "page_id": page(fields["WARC-Record-ID"]),
        "record_type": fields["WARC-Type"],
        "payload": None if revisit else payload,
        "payload_bytes": length,
        "payload_digest": digest,
        "refers_to": page(fields["WARC-Refers-To"]) if revisit else None,
    }


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _open(folder: str):
    return fs.FileSystem.from_uri(folder)


def write_archives(
    pages: DataFrame,
    folder: str,
    id_column: str = "page_id",
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """Write all pages as archives below ``folder``; returns the stored index."""
    body = F.coalesce(F.col(html).cast("binary"), F.lit(b""))
    base = pages.select(
        F.col(id_column).cast("long").alias("page_id"),
        F.col(url).cast("string").alias("url"),
        body.alias("payload"),
        F.sha2(body, 256).alias("digest"),
    )
    repeated = (
        base.filter(F.octet_length("payload") >= LEAST_REVISIT)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
        .filter("n > 1 AND first_id IS NOT NULL")
        .select("digest", "first_id")
    )
    revisits = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    typed = base.join(repeated, "digest", "left").select(
        "page_id", "url", "payload", "digest", "first_id", F.coalesce(revisits, F.lit(False)).alias("revisit")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = _open(folder)
        task = TaskContext.get()
        name = f"pages-{task.partitionId():06d}-{task.taskAttemptId()}-{uuid.uuid4().hex}.warc.gz"
        out, at = None, 0
        for batch in batches:
            rows = []
            for page_id, address, payload, digest, first_id, revisit in zip(
                *(column.to_pylist() for column in batch.columns), strict=True
            ):
                if out is None:
                    system.create_dir(path, recursive=True)
                    out = system.open_output_stream(f"{path}/{name}", compression=None)
                data = _member(record(page_id, address, payload, digest, first_id, revisit))
                out.write(data)
                kind = "revisit" if revisit else "response"
                rows.append((page_id, address, name, at, len(data), digest, kind))
                at += len(data)
            yield _batch(rows, _INDEX)
        if out is not None:
            out.close()

    return settle(typed.mapInArrow(run, _INDEX))


_ARROW = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [field.strip().split(" ") for field in schema.split(",")]
    columns = zip(*rows, strict=True) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), _ARROW[kind]) for c, (_, kind) in zip(columns, fields, strict=True)],
        names=[name for name, _ in fields],
    )


def _reads(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
    """Index rows sorted by file and offset, in groups that one read covers."""
    group: list[tuple] = []
    for row in rows:
        if group:
            last = group[-1]
            gap = row[3] - (last[3] + last[4])
            size = row[3] + row[4] - group[0][3]
            if row[2] != last[2] or gap > GAP_BYTES or size > READ_BYTES:
                yield group
                group = []
        group.append(row)
    if group:
        yield group


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """The records that ``index`` rows name, read in sorted, coalesced byte ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = _open(folder)
        name, handle = None, None
        rows = (
            row
            for batch in batches
            for row in zip(*(column.to_pylist() for column in batch.columns), strict=True)
        )
        for group in _reads(rows):
            if group[0][2] != name:
                if handle is not None:
                    handle.close()
                name = group[0][2]
                handle = system.open_input_file(f"{path}/{name}")
            start = group[0][3]
            data = handle.read_at(group[-1][3] + group[-1][4] - start, start)
            out = []
            for row in group:
                member = data[row[3] - start : row[3] - start + row[4]]
                found = parse(zlib.decompress(member, 31))
                out.append(
                    (
                        found["page_id"],
                        row[1],
                        found["record_type"],
                        found["payload"],
                        found["payload_bytes"],
                        found["payload_digest"],
                        found["refers_to"],
                    )
                )
            yield _batch(out, _RECORD)
        if handle is not None:
            handle.close()

    ordered = index.repartition("file").sortWithinPartitions("file", "offset")
    names = [field.strip().split(" ")[0] for field in _INDEX.split(",")]
    return ordered.select(*names).mapInArrow(run, _RECORD)


def round_trip(pages: DataFrame, **columns: str) -> DataFrame:
    """Write all pages, read all records back and return what they hold, without payloads."""
    folder = shared_folder(pages.sparkSession, "warc")
    index = write_archives(pages, folder, **columns)
    return read_records(index, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
