import base64
import gzip
import hashlib
import zlib

import pytest

from brandbook.llm import warc as W

DATE = "2024-01-01T00:00:00Z"


def sha(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def pages(spark):
    rows = [(i, f"http://h/{i}", f"<p>{i % 4}\r\n\r\nWARC/1.1\r\n</p>") for i in range(30)]
    rows += [(100, None, None), (101, "http://x\r\ny", ""), (None, "u", "only"), (7, "http://h/7", "<p>3\r\n\r\nWARC/1.1\r\n</p>"), (102, "v", "Ünï" * 200_000)]
    return rows, spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, payload string")


@pytest.mark.parametrize(("least", "batch"), [(0, 1 << 20), (10, 1), (0, 1)])
def test_round_trip(spark, least, batch):
    rows, frame = pages(spark)
    payloads = [(p, (h or "").encode()) for p, _, h in rows]
    last = {}
    for p, b in payloads:
        last[b] = max(-1 if p is None else p, last.get(b, -1))
    got = W.round_trip(frame, DATE, least, batch).collect()
    seen, want = set(), []
    for p, b in payloads:
        original = len(b) < least or last[b] in (p, -1)
        if original and len(b) >= least:
            original = b not in seen
            seen.add(b)
        want.append((p, len(b), sha(b), "response" if original else "revisit", None if original else last[b]))
    assert sorted(str(tuple(r)[:5]) for r in got) == sorted(map(str, want))
    assert len({r.record_id for r in got}) == len(rows)


def test_files_are_warc_with_a_gzip_member_a_record(spark, tmp_path):
    _, frame = pages(spark)
    W.write_archive(frame, f"{tmp_path}/a", DATE, file_records=4)
    files = sorted((tmp_path / "a").glob("part-*"))
    assert len(files) >= 9
    data = files[0].read_bytes()
    raw = gzip.decompress(data)
    assert raw.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and raw.endswith(b"\r\n\r\n")
    members = []
    while data:
        one = zlib.decompressobj(31)
        members.append(one.decompress(data))
        data = one.unused_data
    assert b"".join(members) == raw and len([m for m in members if m]) == 4 == len(list(W.parse_records(files[0].read_bytes())))


def record(kind, rid, block, version="1.1", **more):
    lines = [f"WARC/{version}", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{rid}>", *(f"{k.replace('_', '-')}: {v}" for k, v in more.items()), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


HTTP = {"Content_Type": "application/http;msgtype=response"}


@pytest.mark.parametrize("batch", [1 << 20, 1])
@pytest.mark.parametrize("form", ["plain", "file", "record"])
def test_a_mixed_archive_keeps_all_but_repeated_payloads(spark, tmp_path, form, batch):
    page = b"HTTP/1.1 404 Not Found\r\nX-Odd: yes\r\n\r\nabc\r\n\r\nWARC/1.0 not a record"
    digest = sha(page.split(b"\r\n\r\n", 1)[1])
    kept = [
        record("warcinfo", 1, b"software: x\r\n", Content_Type="application/warc-fields"),
        record("request", 2, b"GET / HTTP/1.1\r\nHost: a\r\n\r\n", "1.0", WARC_Concurrent_To="<urn:uuid:3>", Content_Type="application/http;msgtype=request"),
        record("metadata", 4, b"via: http://a/\r\n"),
        record("revisit", 5, b"", WARC_Target_URI="http://lost/"),
        record("revisit", 6, b"HTTP/1.1 200 OK\r\n\r\n", WARC_Payload_Digest=f"sha1:{sha(b'elsewhere')}", WARC_Refers_To="<urn:uuid:old>"),
        record("response", 7, b"\x00\xff dns", Content_Type="text/dns"),
        record("response", 8, page, WARC_Target_URI="http://b/", WARC_Date="2001-02-03T04:05:06Z", X_Page_ID=9, **HTTP),
    ]
    twin = record("response", 3, page, "1.0", WARC_Target_URI="http://a/", WARC_Date="1999-01-01T00:00:00Z", WARC_Block_Digest="sha1:X", X_Page_ID=2, **HTTP)
    old = record("revisit", 10, b"HTTP/1.1 200 OK\r\n\r\n", WARC_Payload_Digest=f"sha1:{digest}", WARC_Refers_To="<urn:uuid:old>")
    folder = tmp_path / "a"
    (folder / "deep").mkdir(parents=True)
    for name, records in (("one.warc", [*kept[:4], twin]), ("deep/one.warc", [*kept[4:], old])):
        data = b"".join(map(gzip.compress, records)) if form == "record" else gzip.compress(b"".join(records)) if form == "file" else b"".join(records)
        (folder / name).write_bytes(data)
    W.deduplicate(spark, str(folder), f"{tmp_path}/b", batch_bytes=batch)
    whole = [w for f in (tmp_path / "b").glob("part-*") for _, _, w in W.parse_records(f.read_bytes())]
    assert set(kept) <= set(whole) and len(whole) == len(kept) + 2
    a, b = sorted((w for w in whole if w not in kept), key=lambda w: b"uuid:10" in w)
    assert a.startswith(b"WARC/1.1\r\n") and a.endswith(b"\r\n\r\nHTTP/1.1 404 Not Found\r\nX-Odd: yes\r\n\r\n\r\n\r\n") and b"Block-Digest" not in a
    for line in ("WARC-Type: revisit", "WARC-Record-ID: <urn:uuid:3>", "WARC-Date: 1999-01-01T00:00:00Z", "WARC-Target-URI: http://a/", "WARC-Refers-To: <urn:uuid:8>", "WARC-Refers-To-Target-URI: http://b/", "WARC-Refers-To-Date: 2001-02-03T04:05:06Z", f"WARC-Payload-Digest: sha1:{digest}"):
        assert f"\r\n{line}\r\n".encode() in a
    assert b"WARC-Refers-To: <urn:uuid:8>\r\n" in b and b"uuid:old" not in b
    got = {r.record_id: r for r in W.read_archive(spark, f"{tmp_path}/b").collect()}
    assert got["<urn:uuid:3>"].refers_to == 9 and got["<urn:uuid:5>"].payload_digest is None


def test_empty_table(spark):
    _, frame = pages(spark)
    assert W.round_trip(frame.limit(0), DATE).count() == 0
