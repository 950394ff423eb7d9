"""Write pages as WARC archives and read selected records back by an index.

Each task writes one archive of gzip members, one per record, to a folder that all
executors share, and returns an index row per record: file, offset, length, URL and
digest. The index is a stored table; an archive left by a broken-off attempt has a name of
its own and is in no index. Readers sort the wanted records by place, join ranges that lie
close together into one read, and check each payload against its digest.

Pages with equal payloads are stored once: the record of the largest page id is a
response, the others are revisit records that refer to it. Payloads below ``least`` bytes
are always responses.

Defined results: NULL html counts as an empty payload, NULL URLs as ``about:blank``. NULL
ids count as smallest; if a group has no other, all its records are responses. Rows equal
in id and payload are one page delivered twice and share their record type. Characters
that may not stand in a header line are percent-encoded. An empty table gives no records.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.snapshots import shared_dir
from .common import as_bytes, stage

HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
GAP = 64 * 1024  # bytes not wanted that are cheaper to read than to skip
RANGE = 8 * 1024 * 1024  # the longest joined read, unless one record is longer

INDEX = (
    "page_id long, url string, path string, offset long, length long, record_type string, "
    "payload_digest string, payload_bytes long, refers_to long"
)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(url: str, page_id: int | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record; a revisit if it refers to another page."""
    revisit = refers_to is not None
    block = HTTP if revisit else HTTP + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'none' if page_id is None else page_id}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {quote(url, safe=''':/?#[]@!$&'()*+,;=%-._~''') or 'about:blank'}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {len(payload)}",
        f"WARC-Block-Digest: sha1:{payload_digest(block)}",
        "Content-Type: application/http; msgtype=response",
    ]
    if revisit:
        lines += [f"WARC-Profile: {IDENTICAL}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and payload of one record."""
    raw = gzip.decompress(member)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    return fields, block.partition(b"\r\n\r\n")[2]


def with_refers_to(pages: DataFrame, least: int) -> DataFrame:
    """Each page with the page its record refers to, NULL for responses.

    Groups are formed from digests alone, combined below the exchange.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html"),
        F.sha2(html, 256).alias("_digest"),
        F.octet_length(html).alias("_bytes"),
    )
    groups = rows.groupBy("_digest").agg(F.max("page_id").alias("_newest"), F.count("*").alias("_copies"))
    groups = groups.filter("_copies > 1")
    other = (F.col("_bytes") >= least) & ~F.col("page_id").eqNullSafe(F.col("_newest"))
    return rows.join(groups, "_digest", "left").select(
        "page_id", "url", "html", F.when(other, F.col("_newest")).alias("refers_to")
    )


def write_archives(pages: DataFrame, least: int = 0, folder: str | None = None) -> DataFrame:
    """Write a record per page; returns the stored index."""
    spark = pages.sparkSession
    folder = folder or shared_dir(spark, "warc")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uri = folder if ":/" in folder else f"file://{folder}"
        files, root = fs.FileSystem.from_uri(uri)
        files.create_dir(root)
        name, out, place = f"{uuid.uuid4().hex}.warc.gz", None, 0
        path = f"{uri}/{name}"
        for batch in batches:
            ids, urls, refers = (batch.column(i).to_pylist() for i in (0, 1, 3))
            index: list[tuple] = []
            for page_id, url, payload, other in zip(ids, urls, as_bytes(batch.column(2)), refers):
                digest = payload_digest(payload)
                whole = record(url or "", page_id, payload, digest, other)
                packer = zlib.compressobj(1, zlib.DEFLATED, 31)
                member = packer.compress(whole) + packer.flush()
                out = out or files.open_output_stream(f"{root}/{name}", compression=None)
                out.write(member)
                kind = "response" if other is None else "revisit"
                index.append((page_id, url, path, place, len(member), kind, digest, len(payload), other))
                place += len(member)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*index) if index else [()] * 9, INDEX_TYPES)],
                names=INDEX_NAMES,
            )
        if out:
            out.close()

    return stage(with_refers_to(pages, least).mapInArrow(write, INDEX), "warc-index")


INDEX_NAMES = [c.split()[0] for c in INDEX.split(", ")]
INDEX_TYPES = [pa.int64() if c.endswith("long") else pa.string() for c in INDEX.split(", ")]


def ranges(offsets: list[int], lengths: list[int]) -> Iterator[tuple[int, int, list[int]]]:
    """Join records sorted by offset into reads: start, end, positions of their records."""
    start = end = 0
    members: list[int] = []
    for i, (offset, length) in enumerate(zip(offsets, lengths)):
        if members and (offset - end > GAP or offset + length - start > RANGE):
            yield start, end, members
            members = []
        start = offset if not members else start
        end = offset + length
        members.append(i)
    if members:
        yield start, end, members


READ = "page_id long, url string, record_type string, payload_digest string, refers_to long, payload_bytes long, html string, intact boolean"


def read_records(selected: DataFrame, with_html: bool = True) -> DataFrame:
    """The records that rows of an index name, read from the archives.

    ``selected`` needs path, offset, length, page_id, url and payload_digest. Rows are
    dealt by file and place, so that neighbours meet in a task. A revisit has no payload,
    only its length; ``with_html=False`` checks the payloads and leaves them out;
    ``intact`` says that a response's payload has the digest it was stored under.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files = None
        for batch in batches:
            rows = []
            for path, records in batch.groupby("path", sort=False):
                files = files or fs.FileSystem.from_uri(path)[0]
                records = records.sort_values("offset")
                with files.open_input_file(fs.FileSystem.from_uri(path)[1]) as source:
                    wanted = list(records.itertuples(index=False))
                    offsets, lengths = records["offset"].tolist(), records["length"].tolist()
                    for start, end, members in ranges(offsets, lengths):
                        block = source.read_at(end - start, start)
                        for i in members:
                            at = offsets[i] - start
                            fields, payload = parse(block[at : at + lengths[i]])
                            rows.append(_checked(wanted[i], fields, payload, with_html))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in READ.split(", ")]).astype(
                {"page_id": "Int64", "refers_to": "Int64"}
            )

    near = selected.repartition(F.col("path"), F.floor(F.col("offset") / RANGE)).sortWithinPartitions("path", "offset")
    return near.mapInPandas(read, READ)


def _checked(row: tuple, fields: dict[str, str], payload: bytes, with_html: bool) -> tuple:
    kind = fields["WARC-Type"]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    found = fields["WARC-Record-ID"][len("<urn:page:") : -1]
    refers = fields.get("WARC-Refers-To")
    return (
        None if found == "none" else int(found),
        row.url,
        kind,
        digest,
        int(refers[len("<urn:page:") : -1]) if refers else None,
        len(payload) if kind == "response" else int(fields["X-Payload-Length"]),
        payload.decode() if kind == "response" and with_html else None,
        kind == "revisit" or payload_digest(payload) == digest == row.payload_digest,
    )
