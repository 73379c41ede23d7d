"""Archives against plain readings of the pages."""

from __future__ import annotations

import base64
import gzip
import hashlib
import random
from collections import defaultdict

import pytest

from fraudspark.llm import warc
from tests.llm.corpus import prose, rows_of

SCHEMA = "page_id bigint, url string, html string, record string, chunk string, bytes string, digest string, type string"


def pages() -> list[tuple[int | None, str | None, str | None]]:
    rng = random.Random(5)
    rows: list[tuple[int | None, str | None, str | None]] = []
    for i in range(60):
        rows.append((i, f"http://a.example/{i}?q=ü x", f"<html>{prose(rng, rng.choice((1, 40, 400)))}</html>"))
    same = rows[4][2]
    rows += [(100 + i, f"http://b.example/{i}", same) for i in range(70)] + [(None, "u", same)]
    rows += [(200, None, None), (201, "", ""), (202, "x\r\nWARC-Type: y", None), (None, None, None)]
    rows += [rows[60], rows[60], rows[7], (300, "v", "\r\n\r\nWARC/1.1\r\n\r\n"), (301, "v", "é" * 5000), (302, "l", "long " * 200_000)]
    rows += [(None, "n", "no id"), (None, "n", "no id"), (169, "again", same)]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c", "d", "e") for r in rows], SCHEMA).repartition(3)


def expected(rows, least: int):
    groups = defaultdict(list)
    for i, _, t in rows:
        groups[t or ""].append(i)
    out = []
    for i, _, t in rows:
        data = (t or "").encode()
        ids = [x for x in groups[t or ""] if x is not None]
        keep = max(ids) if ids and len(data) >= least else i
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((i, len(data), digest, "response" if keep == i else "revisit", None if keep == i else keep))
    return sorted(out, key=repr)


@pytest.mark.parametrize("chunk,archive,least", [(1000, 20_000, 0), (warc.CHUNK_BYTES, warc.ARCHIVE_BYTES, 6)])
def test_round_trip(spark, chunk, archive, least):
    rows = pages()
    manifest = warc.archive(frame(spark, rows), least, chunk, archive)
    found = warc.read_records(manifest, chunk)
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert rows_of(found, *columns) == expected(rows, least)
    assert {(r["record_type"], r["intact"]) for r in found.collect()} == {("response", True), ("revisit", None)}
    names = {r["record_id"]: r["page_id"] for r in found.collect() if r["record_type"] == "response"}
    assert all(names[r["refers_to_record"]] == r["refers_to"] for r in found.collect() if r["record_type"] == "revisit")
    pieces = defaultdict(list)
    for r in warc.read_chunks(manifest, chunk).where("record_type = 'response'").collect():
        assert len(r["data"]) <= chunk
        pieces[r["record_id"], r["page_id"]].append((r["chunk"], bytes(r["data"]), r["last"], r["payload_digest"]))
    whole = defaultdict(set)
    for i, _, t in rows:
        whole[i].add((t or "").encode())
    for (_, page), parts in pieces.items():
        parts.sort()
        assert [p[2] for p in parts] == [False] * (len(parts) - 1) + [True]
        sofar = b""
        for _, data, _, digest in parts:
            sofar += data
            assert digest == warc.base32(hashlib.sha1(sofar).digest())
        assert sofar in whole[page]


def test_archives_are_plain_warc(spark):
    rows = pages()
    manifest = warc.archive(frame(spark, rows), 0, 1000, 20_000).collect()
    assert sum(r["records"] for r in manifest) == len(rows) and len(manifest) > 5
    for r in manifest:
        data = open(r["archive"].removeprefix("file:"), "rb").read()
        assert len(data) == r["bytes"]
        plain, count = gzip.decompress(data), 0
        while plain:
            head, _, rest = plain.partition(b"\r\n\r\n")
            fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
            size = int(fields["Content-Length"])
            assert head.startswith(b"WARC/1.1\r\n") and rest[size : size + 4] == b"\r\n\r\n"
            assert (fields["WARC-Type"] == "revisit") == ("WARC-Refers-To" in fields)
            assert rest[:size].startswith(b"HTTP/1.1 200 OK\r\n")
            plain, count = rest[size + 4 :], count + 1
        assert count == r["records"]


def test_only_finished_tasks_count_and_broken_archives_are_seen(spark, tmp_path):
    manifest = warc.archive(frame(spark, pages()), 0, 1000, 20_000)
    before = manifest.count()
    first = manifest.first()["archive"].removeprefix("file:")
    open(first.rsplit("/", 1)[0] + "/0-0-0.warc.gz", "wb").write(b"left by a lost task")
    assert warc.read_records(manifest).count() == len(pages()) and manifest.count() == before
    short = str(tmp_path / "short.warc.gz")
    open(short, "wb").write(gzip.compress(gzip.decompress(open(first, "rb").read())[:-30]))
    with pytest.raises(Exception, match="ends within a record"):
        warc.read_records(spark.createDataFrame([(short,)], "archive string")).collect()


def test_no_pages(spark):
    assert warc.digest(warc.archive(frame(spark, []))).count() == 0
