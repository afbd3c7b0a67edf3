"""ARC and WARC files of other writers: bytes of any kind, odd header lines, missing headers."""

import gzip

import pytest
from pyspark.sql import functions as F

from loomset.llm.warc import ARC_FIELDS, convert_arc, read_arc, read_warc, sha1_base32, write_arc
from loomset.session import scratch_path

IMAGE = bytes(range(256)) * 40
LATIN = "<p>café</p>".encode("latin-1")
# url, type, stored reply, payload
RECORDS = [
    ("http://a/one two three.html", "text/html; charset=iso-8859-1", b"HTTP/1.1 200 OK\r\nServer: caf\xe9\r\n\r\n" + LATIN, LATIN),
    ("http://a/i.png", "image/png", b"HTTP/1.0 200 OK\nContent-Type: image/png\n\n" + IMAGE, IMAGE),
    ("http://b/i.png", "image/png", b"HTTP/1.0 404 Not Found\nx-page-id: 5\n\n" + IMAGE, IMAGE),
    ("http://c/i.png", "image/png", b"HTTP/1.0 200 OK\nX-Page-Id:4\n\n" + IMAGE, IMAGE),
    ("dns:a", "text/dns", b"20200101\na 1.2.3.4\n", b"20200101\na 1.2.3.4\n"),
    ("http://d/", "no-type", b"", b""),
]


def _arc(version: int) -> list[bytes]:
    """The version block and the records of an ARC file, each with its closing line break."""
    block = f"{version} 0 other\n{' '.join(ARC_FIELDS[version])}\n".encode()
    parts = [b"filedesc://f.arc 0.0.0.0 20200101000000 text/plain %d\n" % len(block) + block + b"\n"]
    for url, mime, stored, _ in RECORDS:
        more = " 200 - - 17 f.arc" if version == 2 else ""
        parts.append(f"{url} 1.2.3.4 20200102030405 {mime}{more} {len(stored)}\n".encode() + stored + b"\n")
    return parts


def _folder(tmp_path, data: bytes) -> str:
    (tmp_path / "part-0").write_bytes(data)
    return str(tmp_path)


@pytest.mark.parametrize("version", [1, 2])
@pytest.mark.parametrize("packed", [False, True])
def test_foreign_arc_to_warc(spark, tmp_path, version, packed):
    parts = _arc(version)
    arc = _folder(tmp_path, b"".join(map(gzip.compress, parts)) if packed else b"".join(parts))
    read = {r["url"]: r for r in read_arc(spark, arc).collect()}
    assert {u: (r["mime"], bytes(r["payload"])) for u, r in read.items()} == {u: (m, p) for u, m, _, p in RECORDS}
    assert read["http://a/i.png"]["status"] == "200" and read["http://c/i.png"]["page_id"] == 4

    rows = {r["url"]: r for r in read_warc(spark, convert_arc(spark, arc, scratch_path(spark, "warc"))).collect()}
    kinds = {u: r["record_type"] for u, r in rows.items()}
    # The record without an id and the one with the larger id revisit the one with the smallest.
    assert kinds == {
        "http://a/one%20two%20three.html": "response", "http://a/i.png": "revisit", "http://b/i.png": "revisit",
        "http://c/i.png": "response", "dns:a": "response", "http://d/": "resource",
    }
    for url, _, _, payload in RECORDS:
        r = rows[url.replace(" ", "%20")]
        assert r["payload_digest"] == sha1_base32(payload) and r["payload_bytes"] == len(payload)
        assert r["payload"] is None if r["record_type"] == "revisit" else bytes(r["payload"]) == payload
    first = rows["http://c/i.png"]
    assert all(rows[u]["refers_to_record"] == first["record_id"] and rows[u]["refers_to"] == 4 for u in ("http://a/i.png", "http://b/i.png"))


def test_pages_of_bytes_and_long_pages(spark):
    pages = spark.createDataFrame([(1, "u", bytearray(IMAGE)), (2, "v", bytearray(b"\xff" * 3_000_000)), (3, "w", None)], "page_id long, url string, html binary")
    arc = write_arc(pages, scratch_path(spark, "arc"), 2)
    got = {r["page_id"]: bytes(r["payload"]) for r in read_warc(spark, convert_arc(spark, arc, scratch_path(spark, "warc"))).collect()}
    assert got == {1: IMAGE, 2: b"\xff" * 3_000_000, 3: b""}


def _warc(block: bytes, *lines: str) -> bytes:
    return "\r\n".join(["WARC/1.0", *lines, f"content-length: {len(block)}"]).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def test_warc_of_other_writers(spark, tmp_path):
    reply = b"HTTP/1.1 200 OK\r\n\r\n" + LATIN
    data = _warc(b"x: y\r\n", "WARC-Type: warcinfo") + _warc(reply, "WARC-Type:response", "WARC-Target-URI: <http://a/>")
    data += _warc(b"GET / HTTP/1.1\r\n\r\n", "WARC-Type: request", "WARC-Payload-Digest: sha1:" + "A" * 32)
    data += _warc(b"HTTP/1.1 200 OK\r\n\r\n", "WARC-Type: revisit", "WARC-Payload-Digest: sha1:" + sha1_base32(LATIN), "WARC-Refers-To: <urn:uuid:1>")
    data += _warc(b"abc", "WARC-Type: resource", "WARC-Block-Digest: md5:0")
    got = {r["record_type"]: r for r in read_warc(spark, _folder(tmp_path, data)).collect()}
    assert set(got) == {"response", "request", "revisit", "resource"}
    assert got["response"]["url"] == "http://a/" and bytes(got["response"]["payload"]) == LATIN
    assert got["response"]["payload_digest"] == got["revisit"]["payload_digest"] == sha1_base32(LATIN)
    assert got["revisit"]["payload_bytes"] is None and got["revisit"]["refers_to_record"] == "<urn:uuid:1>"
    assert got["resource"]["payload_bytes"] == 3


@pytest.mark.parametrize("name", ["WARC-Block-Digest", "WARC-Payload-Digest"])
def test_wrong_digests_are_refused(spark, tmp_path, name):
    data = _warc(b"abc", "WARC-Type: resource", f"{name}: sha1:{'A' * 32}")
    with pytest.raises(Exception, match="digest"):
        read_warc(spark, _folder(tmp_path, data)).agg(F.count("*")).collect()
