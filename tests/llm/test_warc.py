import gzip
import hashlib
import random
from base64 import b32encode
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from fieldgauge.llm import queries, warc

SCHEMA = "page_id long, url string, html string, digest string, revisits int"
ROWS = [
    (5, "http://a/5", "same", "x", 1),
    (2, "http://a/2", "same", "x", 1),
    (9, "http://a/9", "same", "x", 1),
    (1, None, None, None, None),
    (3, "http://a\r\nWARC-Type: evil", "", "x", 1),
    (4, "http://é/4", "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n", "x", 1),
    (6, "u", "\x1f\x8b\x08 é🙂\r\n\r\n\x00", "x", 1),
    (7, "u", "long " * 400_000, "x", 1),
    (8, "u", "long " * 400_000, "x", 1),
    (None, "u", "no key", "x", 1),
    (None, "u", "same", "x", 1),
    (10, "u", "repeated", "x", 1),
    (10, "u", "repeated", "x", 1),
]


def expected(rows, least=0):
    groups = defaultdict(list)
    for key, _, html, *_ in rows:
        groups[html or ""].append(key)
    out = []
    for key, _, html, *_ in rows:
        data = (html or "").encode()
        known = [k for k in groups[html or ""] if k is not None]
        first = min(known) if known else None
        revisits = len(data) >= least and len(groups[html or ""]) > 1 and key != first
        digest = b32encode(hashlib.sha1(data).digest()).decode()
        out.append((key, len(data), digest, "revisit" if revisits else "response", first if revisits else None))
    return sorted(out, key=repr)


def digests(archive):
    rows = warc.records(archive).select("key", "payload_bytes", "payload_digest", "type", "refers_to").collect()
    number = lambda text: None if text is None else int(text)
    return sorted(((number(r.key), *r[1:4], number(r.refers_to)) for r in rows), key=repr)


@pytest.mark.parametrize("compress", [True, False])
@pytest.mark.parametrize("least", [0, 5])
def test_round_trip(spark, tmp_path, compress, least):
    pages = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    path = str(tmp_path / "warc")
    warc.write_archive(pages, path, least=least, compress=compress, file_bytes=1_000_000)
    archive = warc.read_archive(spark, path)
    assert warc.gaps(archive).collect() == []
    assert digests(archive) == expected(ROWS, least)
    # Payloads come back whole, and each revisit finds its response by record id.
    got = {r.key: r.payload for r in warc.records(archive).where("type = 'response'").collect()}
    for key, _, html, *_ in ROWS:
        if key is not None and str(key) in got:
            assert bytes(got[str(key)]).decode() == (html or "")
    ids = {r.record_id for r in archive.where("type = 'response'").collect()}
    assert all(r.refers_to_id in ids for r in archive.where("type = 'revisit'").collect())


def test_files_are_what_other_readers_expect(spark, tmp_path):
    pages = spark.createDataFrame(ROWS, SCHEMA)
    packed, plain = str(tmp_path / "packed"), str(tmp_path / "plain")
    warc.write_archive(pages.coalesce(1), packed)
    warc.write_archive(pages.coalesce(1), plain, compress=False)
    bodies = []
    for name in (packed, plain):
        files = sorted(f.path.removeprefix("file:") for f in spark.read.format("binaryFile").load(name).collect())
        data = [open(f, "rb").read() for f in files]
        bodies.append(sorted(b"".join(gzip.decompress(d) if name == packed else d for d in data).split(b"WARC/1.1\r\nWARC-Type")))
    assert bodies[0] == bodies[1]


def test_files_are_bounded(spark, tmp_path):
    pages = spark.range(400).selectExpr("id page_id", "'u' url", "repeat(cast(id as string), 1000) html").coalesce(1)
    warc.write_archive(pages, str(tmp_path / "w"), compress=False, file_bytes=100_000)
    files = spark.read.format("binaryFile").load(str(tmp_path / "w"))
    assert files.count() >= 9 and files.agg(F.max("length")).first()[0] < 250_000


def test_empty_table(spark, tmp_path):
    warc.write_archive(spark.createDataFrame([], SCHEMA), str(tmp_path / "w"))
    assert warc.read_archive(spark, str(tmp_path / "w")).collect() == []


def archive_of(count, compress):
    made = []
    for n in range(count):
        payload = f"page {n} ".encode() * (n + 1)
        record = warc.make_record(str(n), f"http://x/{n}", payload, warc.digest_of(payload), False, None, "2024-01-01T00:00:00Z", "text/html")
        made.append(warc.as_member(record) + warc.MEMBER_END if compress else record + warc.RECORD_END)
    return made


def check_cover(data, rows):
    """Records and gaps lie side by side and cover the file."""
    at = 0
    for row in rows:
        assert row["offset"] == at and row["length"] > 0
        at += row["length"]
    assert at == len(data)


@pytest.mark.parametrize("compress", [True, False])
def test_damage(compress):
    """Whatever is done to one record, all others come back and the gap is that record."""
    made = archive_of(12, compress)
    rng = random.Random(2)
    damages = [
        lambda r: r[: len(r) // 2],
        lambda r: r[len(r) // 3 :],
        lambda r: b"",
        lambda r: b"junk" + r[4:],
        lambda r: r[:30] + bytes([r[30] ^ 1]) + r[31:],
        lambda r: rng.randbytes(5000),
        lambda r: r[:-1],
        lambda r: r[: len(r) * 2 // 3] + b"\0" * (len(r) - len(r) * 2 // 3),
    ]
    for damage in damages:
        for n in (0, 5, 11):
            bad = damage(made[n])
            data = b"".join([*made[:n], bad, *made[n + 1 :]])
            rows = list(warc.salvage(data))
            check_cover(data, rows)
            found = [r["key"] for r in rows if not r.get("problem")]
            assert found == [str(k) for k in range(12) if k != n]
            lost = [r for r in rows if r.get("problem")]
            assert len(lost) == bool(bad)
            if lost:
                assert lost[0]["offset"] == sum(map(len, made[:n])) and lost[0]["length"] == len(bad)


def test_every_single_byte(spark):
    """A changed byte never yields a changed payload, and never costs another record."""
    for compress in (True, False):
        made = archive_of(3, compress)
        data = b"".join(made)
        whole = {r["key"]: r["payload"] for r in warc.salvage(data)}
        first, second = len(made[0]), len(made[0]) + len(made[1])
        for at in range(first, second):
            rows = list(warc.salvage(data[:at] + bytes([data[at] ^ 0x15]) + data[at + 1 :]))
            kept = {r["key"]: r["payload"] for r in rows if not r.get("problem")}
            assert kept["0"] == whole["0"] and kept["2"] == whole["2"]
            assert all(p == whole[k] for k, p in kept.items() if k in whole)


def test_truncated_and_foreign_files(spark, tmp_path):
    made = archive_of(6, False)
    text = b"".join(made)
    cases = {
        # One stream for all records, as some writers make it.
        "one_member": (gzip.compress(text), 6, 0),
        "cut": (text[:-10], 5, 1),
        "cut_member": (b"".join(archive_of(6, True))[:-10], 5, 1),
        "junk_only": (b"no archive at all" * 100, 0, 1),
        "empty": (b"", 0, 0),
        "bad_inside": (gzip.compress(b"".join([*made[:2], made[2][:50], *made[3:]])), 5, 1),
        "lines": (b"WARC/1.0\nno colon\n\n" + text, 6, 1),
        "other_kinds": (b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <x:1>\r\nWARC-Date: 2024-01-01T00:00:00Z\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" + text, 7, 0),
        "bad_digest": (text.replace(b"page 3 page", b"page 3 pagf"), 5, 1),
    }
    for name, (data, _, _) in cases.items():
        (tmp_path / name).write_bytes(data)
    archive = warc.read_archive(spark, str(tmp_path))
    for name, (_, good, bad) in cases.items():
        own = archive.where(F.col("file").endswith(f"/{name}"))
        assert (warc.records(own).count(), warc.gaps(own).count()) == (good, bad), name
    warc.write_gaps(archive, str(tmp_path / "log"))
    log = spark.read.json(str(tmp_path / "log"))
    assert log.count() == 6 and set(log.columns) == {"file", "offset", "length", "problem"}


def test_large_members_end_in_zero():
    record = b"x" * (17 << 20)
    row = warc.as_member(record)
    assert gzip.decompress(row + warc.MEMBER_END) == record + warc.RECORD_END


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html").collect()
    got = sorted(map(tuple, queries.op12_warc_archive(spark, sf).collect()), key=repr)
    assert got == expected(pages)
