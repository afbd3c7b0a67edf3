"""Web archives: write and parse legacy ARC files, and convert them to WARC.

An ARC file is a version block and records, each a header line and as many bytes as the line declares.
The version block names the version and lists the fields of header lines: version 1 has five, version 2
adds result code, checksum, location, offset and file name. The converter reads both, and synthesises for
each record a WARC identifier (a UUID made from the record's contents), an ISO timestamp from the 14
digits, a type, and base32 SHA-1 digests of block and payload. Records that declare more bytes than are
left get ``WARC-Truncated: length``; a header line that does not fit its version raises ``ValueError``.
Header lines are read around their address and date, so a url or a type may hold spaces.

Blocks stay bytes from file to file: images and texts of any charset pass unchanged. Header text that is
not UTF-8 is read as Latin-1, and a url's white space is percent-encoded in WARC headers. The head of a
stored reply ends at its first blank line, with or without carriage returns.

Of records with equal payloads of at least ``min_bytes`` bytes the one with the smallest page id is the
response and the others become revisits without payload, which name its record, url and date; rows that repeat the smallest id are all
responses, and a record without an id is never first where another has one. Payload equality is decided
on digest and length, by aggregation of narrow rows; payloads are not shuffled while the table of shared
digests is small enough to broadcast.

Archives are written by Spark's text writer, which passes bytes on as they are, one whole archive in a
row and a file, gzip-compressed, to the shared folder; a task closes an archive once it holds ``ARCHIVE_BYTES``, so memory is bounded by that
and the longest record. Null html is an empty payload, a null or blank url is written as ``-``. An empty
table gives no archive and an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomset.llm.common import hint_small
from loomset.session import materialize, scratch_path

ARCHIVE_BYTES = 16 << 20
DATE = "20240101000000"
ADDRESS = "0.0.0.0"
# The field lists of the two ARC versions and the names of WARC headers.
ARC_FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"],
}
WARC_VERSION = "WARC/1.1"
_HEADER_LINE = {
    1: re.compile(r"(.*) (\S+) (\d{1,14}) (.*\S) (\d+)"),
    2: re.compile(r"(.*) (\S+) (\d{1,14}) (.*\S) (\d+|-) (\S+) (\S+) (\d+|-) (\S+) (\d+)"),
}
_HEAD_END = re.compile(rb"\r?\n\r?\n")
_RECORD = "url string, address string, date string, mime string, status string, page_id long, head binary, payload binary, payload_bytes long, digest string, truncated boolean"


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _archives(records, first: bytes, tail: bytes):
    """Rows of whole archives from an iterator of records; ``tail`` is what the writer appends."""
    parts, size = [], 0
    for record in records:
        if parts and size + len(record) > ARCHIVE_BYTES:
            yield first + tail.join(parts)
            parts, size = [], 0
        parts.append(record)
        size += len(record)
    if parts:
        yield first + tail.join(parts)


def _batches(rows, column: str = "value", most: int = 4):
    """Record batches of a few rows each."""
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= most:
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], [column])
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], [column])


def _write(rows: DataFrame, path: str, tail: str) -> str:
    """Rows of one binary ``value`` as files; the cast to text keeps the bytes, whatever they are."""
    rows.select(F.col("value").cast("string")).write.option("lineSep", tail).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").option("maxRecordsPerFile", 1).text(path)
    return path


def _text(data: bytes) -> str:
    """Header bytes as text: UTF-8, or Latin-1 where they are not."""
    try:
        return data.decode("utf-8")
    except UnicodeDecodeError:
        return data.decode("latin-1")


def _line(url: str | None) -> str:
    """A url without the white space and control characters that would break a header line."""
    clean = "".join(c if " " < c != "\x7f" and not c.isspace() else "".join(f"%{b:02X}" for b in c.encode("utf-8")) for c in url or "")
    return clean or "-"


def arc_header(version: int, url: str, length: int, checksum: str, status: str = "200", mime: str = "text/html", date: str = DATE) -> str:
    fields = [url, ADDRESS, date, mime] + ([status, checksum, "-", "0", "-"] if version == 2 else []) + [str(length)]
    return " ".join(fields)


def write_arc(pages: DataFrame, path: str, version: int = 1) -> str:
    """``pages`` (page_id, url, html as text or bytes) as ARC files; the page id travels as a header of the stored HTTP reply."""
    definition = " ".join(ARC_FIELDS[version]) + "\n"
    block = f"{version} 0 loomset\n{definition}"
    first = arc_header(version, "filedesc://pages.arc", len(block), "-", mime="text/plain") + "\n" + block + "\n"

    def run(batches):
        def records():
            for batch in batches:
                for page_id, url, html in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                    html = html or b""
                    size = len(html)
                    own = "" if page_id is None else f"X-Page-Id: {page_id}\r\n"
                    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{own}Content-Length: {size}\r\n\r\n"
                    checksum = sha1_base32(html) if version == 2 else "-"
                    line = arc_header(version, _line(url), len(head) + size, checksum) + "\n" + head
                    yield line.encode("utf-8") + html

        yield from _batches(_archives(records(), first.encode("utf-8"), b"\n"))

    plain = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("binary").alias("html"))
    return _write(plain.mapInArrow(run, "value binary"), path, "\n")


def parse_arc(data: bytes):
    """(fields, block, truncated) of every record after the version block."""
    at, fields = 0, None
    while at < len(data):
        if data[at : at + 1] in (b"\n", b"\r"):
            at += 1
            continue
        end = data.find(b"\n", at)
        end = len(data) if end < 0 else end
        line = _text(data[at:end]).rstrip("\r")
        declared = line.rpartition(" ")[2]
        if not re.fullmatch("[0-9]+", declared):
            raise ValueError(f"not an ARC header line: {line!r}"[:300])
        length = int(declared)
        block = data[end + 1 : end + 1 + length]
        at = end + 1 + length
        if fields is None:
            opening, _, names = _text(block).partition("\n")
            names = names.strip().split("\n")[0].split()
            version = _number(opening.split(" ")[0])
            fields = ARC_FIELDS.get(version)
            if fields is None or names != fields:
                raise ValueError(f"unknown ARC version: {opening!r} {names!r}"[:300])
            continue
        found = _HEADER_LINE[version].fullmatch(line)
        if found is None:
            raise ValueError(f"an ARC header line that does not hold the {len(fields)} fields of version {version}: {line!r}"[:300])
        yield dict(zip(fields, found.groups(), strict=True)), block, len(block) < length


def _unpack(data: bytes) -> bytes:
    """The bytes of a plain file, or of all members of a gzip file."""
    return gzip.GzipFile(fileobj=io.BytesIO(data)).read() if data[:2] == b"\x1f\x8b" else data


def _http(block: bytes) -> tuple[bytes, bytes, dict[str, str]]:
    """Head, payload and lower-case header fields of a stored HTTP reply; a block without one is all payload."""
    end = _HEAD_END.search(block) if block.startswith(b"HTTP/") else None
    if end is None:
        return b"", block, {}
    head = block[: end.end()]
    return head, block[end.end() :], _fields(_text(head).splitlines()[1:])


def _fields(lines: list[str]) -> dict[str, str]:
    """Header fields by lower-case name; of a repeated name the last counts."""
    pairs = [line.partition(":") for line in lines]
    return {name.strip().lower(): value.strip() for name, colon, value in pairs if colon}


def _status(head: bytes) -> str | None:
    words = _text(head).split(None, 2)
    return words[1] if len(words) > 1 else None


def _number(text: str | None) -> int | None:
    return int(text) if text and re.fullmatch("-?[0-9]{1,18}", text) else None


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")


def read_arc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records of ARC files as rows; without ``payloads`` only their sizes and digests."""

    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                for fields, block, truncated in parse_arc(_unpack(content.as_py())):
                    head, payload, http = _http(block)
                    status = fields.get("Result-code") or _status(head)
                    rows.append((fields["URL"], fields["IP-address"], fields["Archive-date"], fields["Content-type"], status, _number(http.get("x-page-id")), head, payload if payloads else None, len(payload), sha1_base32(payload), truncated))
                    size += len(block) if payloads else 100
                    if size >= 4 << 20:
                        yield _rows(rows, _ARROW)
                        rows, size = [], 0
                if rows:
                    yield _rows(rows, _ARROW)

    return _files(spark, path).mapInArrow(run, _RECORD)


_ARROW = [("url", pa.string()), ("address", pa.string()), ("date", pa.string()), ("mime", pa.string()), ("status", pa.string()), ("page_id", pa.int64()), ("head", pa.binary()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("digest", pa.string()), ("truncated", pa.bool_())]


def _rows(rows: list[tuple], schema: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, schema, strict=True)], [n for n, _ in schema])


def iso_date(digits: str) -> str:
    """14 digits, or a prefix of them, as an ISO 8601 time; missing parts are the earliest."""
    d = digits + "00000101000000"[len(digits):] if len(digits) < 14 else digits[:14]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def record_id(page_id: int | None, url: str, date: str, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}|{url}|{date}|{digest}')}>"


def warc_record(row: dict) -> bytes:
    """One record without its closing blank lines. A revisit names the record ``first`` (page_id, url, date)."""
    url, date, revisit, first = row["url"], iso_date(row["date"]), row["revisit"], row["first"]
    block = row["head"] + (b"" if revisit else row["payload"])
    http = bool(row["head"])
    kind = "revisit" if revisit else "response" if http or not url.startswith(("http:", "https:")) else "resource"
    lines = [
        WARC_VERSION, f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(row['page_id'], url, date, row['digest'])}",
        f"WARC-Target-URI: {_line(url)}", f"WARC-Date: {date}", f"WARC-IP-Address: {row['address']}",
        f"WARC-Payload-Digest: sha1:{row['digest']}", f"WARC-Block-Digest: sha1:{sha1_base32(block)}",
        f"X-Payload-Length: {row['payload_bytes']}",
    ]
    if row["page_id"] is not None:
        lines.append(f"X-Page-Id: {row['page_id']}")
    if revisit:
        told = iso_date(first["date"])
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {record_id(first['page_id'], first['url'], told, row['digest'])}",
            f"WARC-Refers-To-Target-URI: {_line(first['url'])}", f"WARC-Refers-To-Date: {told}",
            f"X-Refers-To-Page-Id: {first['page_id']}",
        ]
    if row["truncated"]:
        lines.append("WARC-Truncated: length")
    lines += [f"Content-Type: {'application/http; msgtype=response' if http else row['mime']}", f"Content-Length: {len(block)}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode("utf-8") + block


def convert_arc(spark: SparkSession, arc: str, path: str, min_bytes: int = 0) -> str:
    """The ARC files of a folder as WARC files in ``path``."""
    narrow = read_arc(spark, arc, payloads=False).where(F.col("payload_bytes") >= min_bytes)
    named = F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url", "date"))
    groups = narrow.groupBy("digest", "payload_bytes").agg(F.min(named).alias("first"), F.count("*").alias("n"))
    shared = materialize(groups.where("n > 1").drop("n"), "shared_payloads")
    in_bytes = shared.agg(F.sum(F.coalesce(F.octet_length("first.url"), F.lit(0)) + 128)).first()[0] or 0
    full = read_arc(spark, arc).join(hint_small(shared, in_bytes, 1), ["digest", "payload_bytes"], "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first.page_id"))
    full = full.withColumn("revisit", revisit).withColumn("payload", F.when(revisit, F.lit(None)).otherwise(F.col("payload")))
    opening = f"{WARC_VERSION}\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, 'loomset')}>\r\nWARC-Date: {iso_date(DATE)}\r\nContent-Type: application/warc-fields\r\nContent-Length: 19\r\n\r\nsoftware: loomset\r\n\r\n\r\n"

    def run(batches):
        def records():
            for batch in batches:
                names = batch.schema.names
                for values in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                    yield warc_record(dict(zip(names, values, strict=True)))

        yield from _batches(_archives(records(), opening.encode("utf-8"), b"\r\n\r\n"))

    return _write(full.mapInArrow(run, "value binary"), path, "\r\n\r\n")


def parse_warc(data: bytes):
    """(headers by lower-case name, block) of every record."""
    at = 0
    while at < len(data):
        cut = data.index(b"\r\n\r\n", at) + 4
        lines = _text(data[at:cut]).split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a WARC record: {lines[0]!r}"[:300])
        headers = _fields(lines[1:])
        end = cut + int(headers["content-length"])
        if data[end : end + 4] != b"\r\n\r\n":
            raise ValueError("a WARC record does not end where it declares")
        yield headers, data[cut:end]
        at = end + 4


def _differs(digest: str | None, data: bytes) -> bool:
    """Whether a base32 SHA-1 digest is told and is not that of ``data``; digests by other rules are not judged."""
    told = (digest or "").upper()
    return re.fullmatch("SHA1:[A-Z2-7]{32}", told) is not None and told != "SHA1:" + sha1_base32(data)


def _warc_row(h: dict[str, str], block: bytes, payloads: bool) -> tuple:
    kind, name = h.get("warc-type"), h.get("warc-record-id")
    if _differs(h.get("warc-block-digest"), block):
        raise ValueError(f"block digest of {name} does not match")
    payload = _http(block)[1] if kind == "response" else block
    told = h.get("warc-payload-digest")
    if kind in ("response", "resource") and "warc-truncated" not in h and _differs(told, payload):
        raise ValueError(f"payload digest of {name} does not match")
    if kind == "revisit":
        n, digest, payload = _number(h.get("x-payload-length")), told, None
    else:
        n, digest = len(payload), "sha1:" + sha1_base32(payload)
    digest = digest and digest.partition(":")[2]
    url = h.get("warc-target-uri")
    return (
        _number(h.get("x-page-id")), url and url.strip("<>"), h.get("warc-date"), name, kind, n, digest,
        _number(h.get("x-refers-to-page-id")), payload if payloads else None, h.get("warc-refers-to"),
    )


_WARC = [("page_id", pa.int64()), ("url", pa.string()), ("date", pa.string()), ("record_id", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()), ("refers_to_record", pa.string())]
_WARC_ROW = "page_id long, url string, date string, record_id string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary, refers_to_record string"


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records of WARC files as rows, but for ``warcinfo``; SHA-1 digests that are told are checked.

    Files of other writers may lack digests, page ids and lengths: a digest is then taken from the payload,
    and what only a header could tell is null.
    """

    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                for h, block in parse_warc(_unpack(content.as_py())):
                    if h.get("warc-type") == "warcinfo":
                        continue
                    rows.append(_warc_row(h, block, payloads))
                    size += len(block) if payloads else 100
                    if size >= 4 << 20:
                        yield _rows(rows, _WARC)
                        rows, size = [], 0
                if rows:
                    yield _rows(rows, _WARC)

    return _files(spark, path).mapInArrow(run, _WARC_ROW)


def archive_round_trip(pages: DataFrame, version: int = 2, min_bytes: int = 0) -> DataFrame:
    """``pages`` written as ARC, converted to WARC and read back: one row per page."""
    spark = pages.sparkSession
    arc = write_arc(pages, scratch_path(spark, "arc"), version)
    warc = convert_arc(spark, arc, scratch_path(spark, "warc"), min_bytes)
    return read_warc(spark, warc, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id", "date")
