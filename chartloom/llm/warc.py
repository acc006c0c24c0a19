"""Web archives as Zstandard files: one frame per record, a dictionary in a leading skippable frame.

A Spark write makes the files. Each row is one frame and the text sink's line separator is an
empty skippable frame, which decoders pass over, so that a part file is a valid archive and
Spark's commit protocol covers lost executors and any file system.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Fixed values of the format: skippable frames (any of 16 magic numbers), the one that holds a
# dictionary, the magic number of a dictionary's own frame and of its raw form.
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
DICTIONARY_FRAME = 0x184D2A5D
ZSTD_FRAME = 0xFD2FB528
SEPARATOR = struct.pack("<II", SKIPPABLE[0], 0).decode("latin-1")  # a skippable frame of no bytes

ARCHIVE_BYTES = 16 << 20  # payload per archive, about
TRAIN_BYTES = 2 << 20
DICTIONARY_BYTES = 16 << 10
LARGEST_RECORD = 1 << 30
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _block_head(length: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()


def _record(page: str, url: str | None, payload: bytes, digest: str, response: str | None) -> bytes:
    """A response, or a revisit of ``response``: its block is the response's head without the payload."""
    block = _block_head(len(payload)) + (payload if response is None else b"")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if response is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{page}>",
        f"WARC-Target-URI: {''.join((url or '').split())}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
    ]
    if response is not None:
        lines += [f"WARC-Profile: {IDENTICAL}", f"WARC-Refers-To: <urn:page:{response}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _trained(samples: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """A dictionary of the first records of an archive; none if they are too few."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=3) if len(samples) > 8 else None
    except zstandard.ZstdError:
        return None


def _frames(records: Iterator[bytes]) -> Iterator[bytes]:
    """The dictionary's skippable frame, then a frame for each record."""
    first, size = [], 0
    for record in records:
        first.append(record)
        size += len(record)
        if size >= TRAIN_BYTES:
            break
    if not first:
        return
    known = _trained([r[:65_536] for r in first])
    if known is not None:
        packed = zstandard.ZstdCompressor(level=3).compress(known.as_bytes())
        yield struct.pack("<II", DICTIONARY_FRAME, len(packed)) + packed
    tool = zstandard.ZstdCompressor(level=3, dict_data=known, write_content_size=True, write_checksum=True)
    for record in first:
        yield tool.compress(record)
    for record in records:
        yield tool.compress(record)


def with_revisits(pages: DataFrame, id: str, url: str, html: str, least: int, parts: int) -> DataFrame:
    """id, url, payload, sha1 and refers_to (null for responses) of each page, in ``parts`` partitions.

    Pages are equal if SHA-1 and SHA-256 of their payloads are. Who revisits whom is found without
    payloads, from digests that are combined in the tasks first, so a payload that very many pages
    share is a row per task there. Payloads are shuffled once, to their archives, where the
    revisits of the same pages meet them.
    """
    payload = F.coalesce(F.col(html).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id).alias("id"), F.col(url).alias("url"), payload.alias("payload")).withColumn("sha1", F.sha1("payload"))
    names = rows.select("id", "sha1", F.sha2("payload", 256).alias("sha2"), F.length("payload").alias("size"))
    last = names.where(F.col("size") >= least).groupBy("sha1", "sha2").agg(F.max("id").alias("refers_to"), F.count("*").alias("n"))
    revisits = names.join(last.where("n > 1"), ["sha1", "sha2"]).where("id < refers_to").select("id", "sha1", "refers_to").distinct()
    return rows.repartition(parts, "id", "sha1").join(revisits, ["id", "sha1"], "left").select("id", "url", "payload", "sha1", "refers_to")


def write_archives(
    pages: DataFrame, path: str, id: str = "page_id", url: str = "url", html: str = "html", least: int = 0, archive_bytes: int = ARCHIVE_BYTES
) -> None:
    """Archives of all pages in the new folder ``path``, each of about ``archive_bytes`` of payload.

    Of pages with equal payloads of at least ``least`` bytes the one with the largest id becomes a
    response and the others revisit it; smaller ones are responses. A null payload is an empty
    one; a null url is written as an empty target. Rows that repeat an id are written each (as
    responses if the id is the largest). An empty table gives an empty archive folder.
    """
    size = pages.agg(F.sum(F.octet_length(html))).first()[0] or 0
    rows = with_revisits(pages, id, url, html, least, max(1, -(-size // archive_bytes)))
    rows = rows.withColumns({c: F.col(c).cast("string") for c in ("id", "refers_to")})

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[bytes]:
            for batch in batches:
                for page, target, payload, sha1, response in zip(*(batch[c] for c in ("id", "url", "payload", "sha1", "refers_to")), strict=True):
                    digest = base64.b32encode(bytes.fromhex(sha1.as_py())).decode()
                    name = page.as_py()
                    yield _record("" if name is None else name, target.as_py(), payload.as_py(), digest, response.as_py())

        group, held = [], 0
        for frame in _frames(records()):
            group.append(frame)
            held += len(frame)
            if held > 4 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(group, pa.binary())], names=["frame"])
                group, held = [], 0
        if group:
            yield pa.RecordBatch.from_arrays([pa.array(group, pa.binary())], names=["frame"])

    frames = rows.mapInArrow(archive, "frame binary")
    frames.select(F.col("frame").cast("string").alias("value")).write.option("lineSep", SEPARATOR).text(path)


def _expect(truth: bool, name: str, said: str) -> None:
    if not truth:
        raise ValueError(f"{name}: {said}")


def read_frames(content: bytes, name: str = "archive") -> Iterator[bytes]:
    """The records of an archive, one per frame; the dictionary comes from the leading skippable frame."""
    view, at, tool, seen = memoryview(content), 0, zstandard.ZstdDecompressor(), False
    while at < len(view):
        _expect(at + 8 <= len(view), name, f"cut off at byte {at}")
        magic, length = struct.unpack_from("<II", view, at)
        if magic in SKIPPABLE:
            _expect(at + 8 + length <= len(view), name, f"skippable frame at byte {at} is cut off")
            if magic == DICTIONARY_FRAME:
                _expect(not seen and at == 0, name, "a dictionary must lead the archive")
                body = bytes(view[at + 8 : at + 8 + length])
                if body[:4] == struct.pack("<I", ZSTD_FRAME):
                    body = zstandard.ZstdDecompressor().decompress(body)
                tool = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(body))
            at += 8 + length
            continue
        _expect(magic == ZSTD_FRAME, name, f"no frame at byte {at}")
        seen = True
        declared = zstandard.frame_content_size(view[at : at + 18])
        _expect(0 <= declared <= LARGEST_RECORD, name, f"frame at byte {at} declares no usable size")
        reader = tool.decompressobj()
        record = reader.decompress(view[at:])
        _expect(reader.eof and len(record) == declared, name, f"frame at byte {at} does not hold {declared} bytes")
        at = len(view) - len(reader.unused_data)
        yield record


def parse_record(record: bytes, name: str = "archive") -> dict:
    """Headers, block and payload of a record, with all lengths and digests checked."""
    head, blank, rest = record.partition(b"\r\n\r\n")
    _expect(bool(blank), name, "no end of the headers")
    version, *lines = head.decode("utf-8").split("\r\n")
    _expect(version in ("WARC/1.0", "WARC/1.1"), name, f"unknown version {version[:20]!r}")
    headers: dict[str, str] = {}
    for line in lines:
        key, colon, value = line.partition(":")
        _expect(bool(colon) and key == key.strip() != "", name, f"malformed header {line[:40]!r}")
        _expect(key.lower() not in headers, name, f"header {key} twice")
        headers[key.lower()] = value.strip()
    for key in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        _expect(key in headers, name, f"no header {key}")
    length = headers["content-length"]
    _expect(length.isascii() and length.isdigit() and int(length) + 4 == len(rest), name, "Content-Length does not fit the record")
    _expect(rest.endswith(b"\r\n\r\n"), name, "no end of the record")
    block = rest[:-4]
    if "warc-block-digest" in headers:
        _expect(headers["warc-block-digest"] == f"sha1:{base32_sha1(block)}", name, "wrong block digest")
    http, blank, payload = block.partition(b"\r\n\r\n")
    _expect(bool(blank) and http.startswith(b"HTTP/"), name, "no HTTP message in the block")
    lengths = [x.partition(b":")[2].strip() for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
    _expect(len(lengths) == 1 and lengths[0].isdigit(), name, "no length of the payload")
    full = int(lengths[0])
    digest = headers.get("warc-payload-digest", "").removeprefix("sha1:")
    if headers["warc-type"] == "response":
        _expect(len(payload) == full and digest == base32_sha1(payload), name, "the payload does not fit its length or digest")
    else:
        _expect(headers["warc-type"] == "revisit" and not payload, name, "a revisit must have no payload")
        _expect("warc-refers-to" in headers, name, "a revisit must refer to a record")
    return {"headers": headers, "payload": payload, "payload_bytes": full, "payload_digest": digest}


def read_archives(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """One row per record of all archives under ``path``, validated.

    Columns: record_id, url, payload_bytes, payload_digest, record_type, refers_to and, if asked
    for, payload. A damaged archive raises an error that names it.
    """
    files = spark.read.format("binaryFile").load(path).where("length > 0").select("path", "content")
    extra = ", payload binary" if with_payload else ""
    names = ["record_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"] + ["payload"] * with_payload
    kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary()]

    def urn(value: str | None) -> str | None:
        return None if value is None else value.removeprefix("<urn:page:").removesuffix(">")

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"], strict=True):
                rows, held = [], 0
                for record in read_frames(content.as_buffer(), name.as_py()):
                    got = parse_record(record, name.as_py())
                    h = got["headers"]
                    row = (urn(h["warc-record-id"]), h.get("warc-target-uri"), got["payload_bytes"], got["payload_digest"], h["warc-type"], urn(h.get("warc-refers-to")))
                    rows.append((*row, got["payload"]) if with_payload else row)
                    held += len(record) if with_payload else 200
                    if held > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds)], names=names)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds)], names=names)

    return files.mapInArrow(parse, f"record_id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string{extra}")


def archived_pages(pages: DataFrame, folder: str, id: str = "page_id", url: str = "url", html: str = "html", least: int = 0) -> DataFrame:
    """Pages written to archives in a new folder under ``folder`` and read back, one row per page.

    A null id comes back as null.
    """
    path = f"{folder.rstrip('/')}/warc-{uuid.uuid4().hex}"
    write_archives(pages, path, id, url, html, least)
    kind = pages.schema[id].dataType

    def back(column: str) -> Column:
        return F.when(F.col(column) != "", F.col(column)).cast(kind)

    rows = read_archives(pages.sparkSession, path)
    return rows.select(back("record_id").alias(id), "payload_bytes", "payload_digest", "record_type", back("refers_to").alias("refers_to"))
