"""WARC: round trips, roles against a plain version, broken archives."""

import base64
import gzip
import hashlib
import io
import random

import pytest

from corvid.llm import warc
from corvid.llm.common import written


def pages(spark, rows):
    return spark.createDataFrame([(p, u, h, 1, "x") for p, u, h in rows],
                                 "page_id long, url string, html string, records long, archive string")


ROWS = [
    (5, "http://a/1", "<p>one</p>"), (2, "http://a/2", "<p>one</p>"), (9, "http://a/3", "<p>one</p>"),
    (1, None, ""), (3, "http://b/ x\r\nWARC-Type: fake", None), (4, "http://b/é", "ünï\r\n\r\nWARC/1.1\r\n"),
    (7, "http://c", "x" * 3_000_000), (2, "http://a/2", "<p>one</p>"), (None, "http://n", "<p>one</p>"),
    (None, "http://m", "alone"), (11, "http://z", "\x00\x01"),
]


def brute(rows):
    first = {}
    for p, _, h in rows:
        if p is not None:
            first[h or ""] = min(p, first.get(h or "", p))
    out = []
    for p, _, h in rows:
        data, of = (h or "").encode(), first.get(h or "")
        revisit = of is not None and of != p
        out.append((p, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                    "revisit" if revisit else "response", of if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("archive_bytes", [1 << 30, 500])
def test_round_trip(spark, archive_bytes):
    rng = random.Random(1)
    rows = ROWS + [(100 + i, f"http://h/{i}", rng.choice(["same", f"own {i}", "<b>other</b>" * 50])) for i in range(60)]
    manifest = warc.write_archives(pages(spark, rows), archive_bytes=archive_bytes)
    got = written(warc.read_archives(manifest), "records")
    digests = got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted((tuple(r) for r in digests), key=str) == brute(rows)
    assert manifest.agg({"records": "sum"}).first()[0] == len(rows)
    texts = sorted(r.payload.decode() for r in got.collect() if r.payload is not None)
    want = [r for r in brute(rows) if r[3] == "response"]
    assert len(texts) == len(want)
    by_digest = {base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode(): h or "" for _, _, h in rows}
    assert texts == sorted(by_digest[w[2]] for w in want)


def test_small_payloads_can_stay_responses(spark):
    got = warc.read_archives(warc.write_archives(pages(spark, ROWS), min_bytes=11), keep_payload=False).collect()
    assert {r.record_type for r in got} == {"response"}


def test_members_are_single_records_of_plain_gzip(spark):
    manifest = warc.write_archives(pages(spark, ROWS))
    for row in manifest.collect():
        system, path = warc.open_folder(row.archive)
        raw = system.open_input_stream(path, compression=None).read()
        assert gzip.decompress(raw).count(b"WARC/1.1\r\nWARC-Type") == row.records
        for step in (1, 7, 1 << 20):
            if len(raw) < 10_000 or step > 1:
                assert len(list(warc.members(io.BytesIO(raw), step))) == row.records


def member(**changes):
    data = warc.record_bytes(1, "http://a", b"hello", None, False)
    for old, new in changes.values():
        data = data.replace(old, new)
    return data


@pytest.mark.parametrize("data", [
    member(a=(b"hello", b"jello")), member(a=(b"WARC/1.1", b"WRAC/1.1")), member(a=(b"Content-Length: ", b"Content-Length: 9")),
    member(a=(b"\r\nhello", b"\r\nhello!")), b"", b"nothing of the kind"])
def test_broken_records_raise(data):
    with pytest.raises(warc.WarcError):
        warc.parse_record(data)


def test_broken_archives_raise():
    whole = warc.gzip_member(member())
    for raw in (whole[:-3], whole + b"garbage", whole + whole[:20]):
        with pytest.raises(warc.WarcError):
            list(warc.members(io.BytesIO(raw)))


def test_empty_table(spark):
    assert warc.read_archives(warc.write_archives(pages(spark, []))).count() == 0
