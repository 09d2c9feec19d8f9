"""WARC archives: writing with revisits, and a reader that gets past damage.

Writing. Equal payloads are found by their SHA-1; the row of the smallest key keeps the
payload as `response`, the others are `revisit` records that name it. The records go
through Spark's own text writer, whose rows are the records and whose line separator is
their common end, so any file system, retried task and lost executor is handled as for
any other table. Files are named part-*.txt; put a name ending in .warc or .warc.gz on
them when they leave the cluster.

Reading. Each member (or, in files that are not compressed, each record) is checked: its
compression sums, version line, header lines, length, closing blank lines, block digest
and payload digest. Where a check fails, the reader searches for the next version line or
member that passes them all and goes on there. What lies between is reported as a gap: file, offset,
length, and the first check that failed. A file is read by one task, so the writer bounds
the records of a file; readable files have up to 2 GB, the bound of Spark's `binaryFile`.

Rows without a payload have an empty one. Rows without a key come after all others when
the smallest is chosen. Rows that repeat the smallest key with its payload are all
responses. Other columns play no part. No rows give no records.
"""

from __future__ import annotations

import re
import zlib
from base64 import b32encode
from collections.abc import Iterator
from hashlib import sha1
from urllib.parse import quote, unquote
from uuid import UUID

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bound_batches, release_memory, stored

# The format's version, its line end, the end of a record, the header lines each
# record has, the one it can have twice, and the profile of one that stands for an equal one.
VERSION = b"WARC/1.1"
LINE = b"\r\n"
RECORD_END = b"\r\n\r\n"
REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")
MAY_REPEAT = "warc-concurrent-to"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MEMBER_START = b"\x1f\x8b\x08"
RESPONSE, REVISIT = "response", "revisit"

# A member ends in the fourth byte of its length, which is zero below 16 MB; the writer
# puts that byte between rows.
MEMBER_END = b"\0"
EMPTY_MEMBER = zlib.compress(b"", 9, 31)
# Payload bytes of a file, on average.
FILE_BYTES = 64 << 20
# Compressed bytes taken at once, and the most that header lines may have.
SLICE_BYTES = 16 << 10
HEADER_BYTES = 1 << 20
VERSION_LINE = re.compile(rb"WARC/[0-9]+\.[0-9]+\r?\n")
START = re.compile(rb"\x1f\x8b\x08|WARC/[0-9]+\.[0-9]+\r?\n")

ROWS = (
    "file string, offset bigint, length bigint, problem string, type string, record_id string, date string, "
    "target_uri string, key string, refers_to_id string, refers_to string, payload_digest string, "
    "payload_bytes bigint, payload binary"
)


def digest_of(data: bytes) -> str:
    """Bare base32 SHA-1."""
    return b32encode(sha1(data).digest()).decode()


# ---- writing


def record_id(key: str | None, digest: str, kind: str) -> str:
    name = "\n".join([kind, digest, "" if key is None else f"={key}"])
    return f"<urn:uuid:{UUID(bytes=sha1(name.encode()).digest()[:16], version=5)}>"


def one_line(text: str) -> str:
    """Control characters, which would end or break a header line, as %XX."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def make_record(key, url, payload: bytes, digest: str, revisits: bool, first, date: str, content: str) -> bytes:
    """A whole record without its closing blank lines.

    The block is an HTTP answer; that of a revisit has the header only, in which the
    length of the payload still stands.
    """
    kind = REVISIT if revisits else RESPONSE
    http = f"HTTP/1.1 200 OK\r\nContent-Type: {content}\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisits else http + payload
    lines = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", record_id(key, digest, kind)),
        ("WARC-Date", date),
        ("WARC-Target-URI", None if url is None else one_line(url)),
        ("WARC-Profile", SAME_PAYLOAD if revisits else None),
        ("WARC-Refers-To", record_id(first, digest, RESPONSE) if revisits else None),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{digest_of(block)}"),
        ("X-Key", None if key is None else quote(key)),
        ("X-Refers-To-Key", quote(first) if revisits and first is not None else None),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    head = "".join(f"{name}: {value}\r\n" for name, value in lines if value is not None)
    return b"".join([VERSION, LINE, head.encode(), LINE, block])


def as_member(record: bytes) -> bytes:
    """A compressed record as the writer's row: without the zero byte at its end."""
    member = zlib.compress(record + RECORD_END, 6, 31)
    if not member.endswith(MEMBER_END):
        member += EMPTY_MEMBER
    return member[: -len(MEMBER_END)]


def with_first(pages: DataFrame, sums: DataFrame, least: int = 0) -> DataFrame:
    """Add to rows (key, url, payload, digest) which row holds the payload; `sums` has
    (key, digest, size) of the same rows.

    Only payloads that occur more than once are joined; each task reduces its rows to one
    per payload before that shuffle, and where the groups are not few enough for a
    broadcast, adaptive execution splits the rows of a payload that very many share.
    """
    groups = (
        sums.where(F.col("size") >= least)
        .groupBy("digest")
        .agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("digest", "first", F.lit(True).alias("shared"))
    )
    # From a table of known size, so that broadcasting it is decided on that size.
    joined = pages.join(stored(groups, "payloads"), "digest", "left")
    revisits = F.coalesce("shared", F.lit(False)) & ~F.col("key").eqNullSafe(F.col("first"))
    return joined.withColumn("revisits", revisits)


def write_archive(
    pages: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html", *,
    least: int = 0, compress: bool = True, date: str = "1970-01-01T00:00:00Z",
    content: str = "text/html; charset=utf-8", file_bytes: int = FILE_BYTES,
) -> None:
    """One record per row. Payloads of fewer than `least` bytes are always written in full.

    `payload` is text, written as UTF-8, or binary. Equal texts count as equal whatever
    the url. Keys are compared in their own type and written as text.
    """
    spark = pages.sparkSession
    bound_batches(spark)
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(key).alias("key"), F.col(url).cast("string").alias("url"), body.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    # The payloads are read twice and not a third time.
    sums = stored(rows.select("key", "digest", F.octet_length("payload").alias("size")), "digests")
    joined = with_first(rows, sums, least)
    records_per_file = max(1, int(file_bytes / ((sums.agg(F.avg("size")).first()[0] or 0) + 1024)))

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for r in batch.to_pylist():
                digest = b32encode(bytes.fromhex(r["digest"])).decode()
                record = make_record(r["key"], r["url"], r["payload"], digest, r["revisits"], r["first"], date, content)
                made.append(as_member(record) if compress else record)
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.large_binary())], ["value"])
        release_memory()

    texts = {name: F.col(name).cast("string").alias(name) for name in ("key", "first")}
    columns = [texts.get(c, F.col(c)) for c in ("key", "url", "payload", "digest", "revisits", "first")]
    (
        joined.select(*columns)
        .mapInArrow(records, "value binary")
        .select(F.col("value").cast("string").alias("value"))
        .write.option("lineSep", (MEMBER_END if compress else RECORD_END).decode())
        .option("maxRecordsPerFile", records_per_file)
        .text(path)
    )


# ---- reading


class Damaged(Exception):
    """The check that failed."""


def parse_record(data: bytes, at: int) -> tuple[dict, int]:
    """The record at a place of uncompressed data, and where it ends; all checks pass."""
    version = VERSION_LINE.match(data, at)
    if not version:
        raise Damaged("no version line")
    end = data.find(RECORD_END, version.end() - 2, version.end() + HEADER_BYTES)
    if end < 0:
        raise Damaged("header lines do not end")
    fields = {}
    for line in data[version.end() : end].split(LINE):
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("header line without a colon")
        name = name.strip().lower().decode("latin-1")
        if name in fields and name != MAY_REPEAT:
            # The lines of two records run together.
            raise Damaged("header line twice")
        fields[name] = value.strip().decode("utf-8", "replace")
    start = end + len(RECORD_END)
    missing = [name for name in REQUIRED if name not in fields]
    if missing:
        raise Damaged(f"{missing[0]} is missing")
    size = fields["content-length"]
    if not size.isascii() or not size.isdigit():
        raise Damaged("no length")
    stop = start + int(size)
    if data[stop : stop + len(RECORD_END)] != RECORD_END:
        raise Damaged("record does not end where its length says")
    return checked(fields, data[start:stop]), stop + len(RECORD_END)


def checked(fields: dict, block: bytes) -> dict:
    def check(name: str, data: bytes) -> None:
        kind, colon, value = fields.get(name, "").partition(":")
        # Other kinds of digests are not checked.
        if colon and kind.lower() == "sha1" and value.upper() != digest_of(data):
            raise Damaged(f"{name} differs")

    check("warc-block-digest", block)
    kind = fields.get("warc-type")
    size, payload = len(block), block
    if fields.get("content-type", "").startswith("application/http"):
        head, end, payload = block.partition(RECORD_END)
        if not end:
            raise Damaged("block without an HTTP header")
        stated = re.search(rb"(?im)^content-length:[ \t]*([0-9]+)", head)
        size = int(stated[1]) if stated and kind == REVISIT else len(payload)
    if kind == REVISIT:
        payload = None
    else:
        check("warc-payload-digest", payload)
    key, first = fields.get("x-key"), fields.get("x-refers-to-key")
    return {
        "type": kind,
        "record_id": fields.get("warc-record-id"),
        "date": fields.get("warc-date"),
        "target_uri": fields.get("warc-target-uri"),
        "key": None if key is None else unquote(key),
        "refers_to_id": fields.get("warc-refers-to"),
        "refers_to": None if first is None else unquote(first),
        "payload_digest": fields.get("warc-payload-digest", "").partition(":")[2] or None,
        "payload_bytes": size,
        "payload": payload,
    }


def parse_member(data: bytes, at: int) -> tuple[list[dict], int]:
    """Rows of the compressed member at a place, and where it ends."""
    unpack, parts, end = zlib.decompressobj(31), [], at
    try:
        # In slices, because what follows the member is copied with each call.
        while not unpack.eof and end < len(data):
            parts.append(unpack.decompress(data[end : end + SLICE_BYTES]))
            end = min(end + SLICE_BYTES, len(data))
    except zlib.error as error:
        raise Damaged("member cannot be unpacked") from error
    if not unpack.eof:
        raise Damaged("member does not end")
    end -= len(unpack.unused_data)
    # A member can hold many records, whole or damaged; places in it are those of the member.
    rows = list(salvage(b"".join(parts)))
    if rows and all(r.get("problem") for r in rows):
        raise Damaged(rows[0]["problem"])
    return [r | {"offset": at, "length": end - at} for r in rows], end


def salvage(data: bytes) -> Iterator[dict]:
    """All records that pass the checks, and a row with `problem` for each gap."""
    at, lost, problem = 0, None, None
    while at < len(data):
        try:
            if data.startswith(MEMBER_START, at):
                rows, end = parse_member(data, at)
            else:
                record, end = parse_record(data, at)
                rows = [record | {"offset": at, "length": end - at}]
        except Damaged as failed:
            if lost is None:
                lost, problem = at, str(failed)
            following = START.search(data, at + 1)
            at = following.start() if following else len(data)
            continue
        if lost is not None:
            yield {"offset": lost, "length": at - lost, "problem": problem}
            lost = None
        yield from rows
        at = end
    if lost is not None:
        yield {"offset": lost, "length": len(data) - lost, "problem": problem}


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Rows of both kinds: records, whose `problem` is null, and gaps."""
    bound_batches(spark)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch["path"], batch["content"]):
                name, found, size = file.as_py(), [], 0
                # In parts, so that what is made of a file is not in memory twice.
                for row in salvage(content.as_py()):
                    found.append(row | {"file": name})
                    size += len(row.get("payload") or b"") + 1024
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pylist(found, SCHEMA)
                        found, size = [], 0
                yield pa.RecordBatch.from_pylist(found, SCHEMA)
        release_memory()

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(rows, ROWS)


_ARROW = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}
SCHEMA = pa.schema([(name, _ARROW[kind]) for name, kind in (field.split() for field in ROWS.split(", "))])


def records(archive: DataFrame) -> DataFrame:
    return archive.where("problem IS NULL").drop("problem")


def gaps(archive: DataFrame) -> DataFrame:
    """The log of what was not readable: file, offset, length, problem."""
    return archive.where("problem IS NOT NULL").select("file", "offset", "length", "problem")


def write_gaps(archive: DataFrame, path: str) -> None:
    """The log as JSON lines."""
    gaps(archive).write.json(path)
