"""WARC archives compressed record by record with Zstandard and a shared dictionary.

An archive starts with a skippable frame (magic 0x184D2A5D) that holds the
archive's dictionary, followed by one Zstandard frame per record. Writing
trains the dictionary on the first records of the archive; reading loads it
from the leading frame, decodes frame by frame, and checks the version line,
the mandatory headers, the declared lengths and the payload digest.

Of the records with equal payloads of at least ``MIN_SHARED`` bytes the one
with the smallest id is a response and the others are revisits, which carry
the HTTP header and refer to it.

Archives are written by the tasks into a folder of the cluster's shared
storage, under names that only the winning attempt's manifest lists, and read
back by Spark's binary file reader. An archive is closed after
``ARCHIVE_BYTES`` of payload, which bounds what a reading task holds.

Defined results: a null page has an empty payload; a null id is written as
``null`` and comes last; rows that repeat the smallest id are all responses;
an empty table gives an empty result; input columns may have any names.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailspark.runtime import remove_path, scratch_path

from .common import key_part, settled, small

VERSION = b"WARC/1.1"
DICTIONARY_MAGIC = 0x184D2A5D
ZSTD_MAGIC = 0xFD2FB528
DATE = "2024-01-01T00:00:00Z"
REQUIRED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MIN_SHARED = 100
ARCHIVE_BYTES = 16 << 20
#: Bytes that the decoder is fed at a time; what it leaves of them is all that is read twice.
FEED = 16 << 10
#: Records and bytes that the dictionary of an archive is trained on, and its size.
SAMPLE, SAMPLE_BYTES, DICTIONARY_BYTES, LEVEL = 256, 2 << 20, 32 << 10, 3


class WarcError(ValueError):
    """The archive or a record breaks the format."""


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def _page_id(record_id: str) -> int | None:
    name = record_id.removeprefix("<urn:page:").removesuffix(">")
    return None if name == "null" else int(name)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None,
           revisit: bool) -> bytes:
    """One serialized record; a revisit holds the HTTP header only."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if revisit else http + payload
    target = "".join(c for c in url or "about:blank" if c.isprintable() and c != " ")
    headers = [("WARC-Type", "revisit" if revisit else "response"),
               ("WARC-Record-ID", _record_id(page_id)), ("WARC-Date", DATE),
               ("WARC-Target-URI", target), ("Content-Type", "application/http;msgtype=response"),
               ("WARC-Payload-Digest", "sha256:" + hashlib.sha256(payload).hexdigest())]
    if revisit:
        headers += [("WARC-Refers-To", _record_id(refers_to)), ("WARC-Profile", PROFILE)]
    headers.append(("Content-Length", str(len(block))))
    head = "".join(f"{k}: {v}\r\n" for k, v in headers).encode()
    return b"%s\r\n%s\r\n%s\r\n\r\n" % (VERSION, head, block)


def archive(records: list[bytes]) -> bytes:
    """Records as one archive: dictionary frame, then one frame per record."""
    sample, room = [], SAMPLE_BYTES
    for r in records[:SAMPLE]:
        sample.append(r[:room])
        room -= len(sample[-1])
        if room <= 0:
            break
    out, dictionary = [], None
    try:
        dictionary = zstandard.train_dictionary(DICTIONARY_BYTES, sample)
    except zstandard.ZstdError:  # too little to learn from: no dictionary frame
        pass
    if dictionary:
        body = dictionary.as_bytes()
        out.append(struct.pack("<II", DICTIONARY_MAGIC, len(body)) + body)
    packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_checksum=True)
    return b"".join([*out, *map(packer.compress, records)])


def frames(data: bytes) -> Iterator[bytes]:
    """The decoded records of an archive, one per frame."""
    view, at, dictionary = memoryview(data), 0, None
    if len(data) >= 8 and struct.unpack_from("<I", data)[0] == DICTIONARY_MAGIC:
        size = struct.unpack_from("<I", data, 4)[0]
        if 8 + size > len(data):
            raise WarcError("dictionary frame is cut off")
        body, at = bytes(view[8:8 + size]), 8 + size
        if struct.unpack_from("<I", body)[0] == ZSTD_MAGIC:  # the dictionary may be compressed
            body = zstandard.ZstdDecompressor().decompressobj().decompress(body)
        dictionary = zstandard.ZstdCompressionDict(body)
    opener = zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary else (
        zstandard.ZstdDecompressor())
    while at < len(data):
        if len(data) - at < 8 or struct.unpack_from("<I", data, at)[0] != ZSTD_MAGIC:
            raise WarcError(f"no frame at byte {at}")
        frame, parts, fed = opener.decompressobj(), [], at
        try:
            while not frame.eof and fed < len(data):
                parts.append(frame.decompress(view[fed:fed + FEED]))
                fed = min(fed + FEED, len(data))
        except zstandard.ZstdError as e:
            raise WarcError(f"frame at byte {at}: {e}") from e
        if not frame.eof:
            raise WarcError(f"frame at byte {at} is cut off")
        yield b"".join(parts)
        at = fed - len(frame.unused_data)


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one record, validated."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not gap or lines[0] != VERSION:
        raise WarcError("no WARC/1.1 header")
    headers: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.decode().partition(":")
        if not colon or not name.strip() or name in headers:
            raise WarcError(f"bad header line {line!r}")
        headers[name] = value.strip()
    if missing := [x for x in REQUIRED if x not in headers]:
        raise WarcError(f"headers missing: {missing}")
    if not headers["Content-Length"].isdigit():
        raise WarcError("bad Content-Length")
    n = int(headers["Content-Length"])
    if len(rest) != n + 4 or rest[n:] != b"\r\n\r\n":
        raise WarcError(f"block of {len(rest) - 4} bytes, {n} declared")
    return headers, rest[:n]


def described(data: bytes) -> dict:
    """What a record says of its page, checked against its payload."""
    headers, block = parse(data)
    http, gap, payload = block.partition(b"\r\n\r\n")
    fields = dict(x.split(b": ", 1) for x in http.split(b"\r\n")[1:])
    n = int(fields.get(b"Content-Length", b"-1"))
    revisit = headers["WARC-Type"] == "revisit"
    digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
    if not gap or n < 0 or (payload if revisit else len(payload) != n):
        raise WarcError("HTTP length and payload differ")
    if not revisit and hashlib.sha256(payload).hexdigest() != digest:
        raise WarcError("payload digest differs")
    return {"page_id": _page_id(headers["WARC-Record-ID"]), "url": headers["WARC-Target-URI"],
            "payload_bytes": n, "payload_digest": digest, "record_type": headers["WARC-Type"],
            "refers_to": _page_id(headers["WARC-Refers-To"]) if revisit else None,
            "payload": None if revisit else payload}


def with_references(pages: DataFrame, page_id: str = "page_id", url: str = "url",
                    page: str = "html") -> DataFrame:
    """``(page_id, url, html, refers_to)``: refers_to is null for responses.

    Payloads meet by digest, and a small payload has a key that nothing shares.
    The first ids are a settled table, so a payload that many pages share is
    split over tasks where the join is not a broadcast.
    """
    body = F.coalesce(pages[f"`{page}`"], F.lit(""))
    rows = pages.select(
        pages[f"`{page_id}`"].cast("long").alias("page_id"), pages[f"`{url}`"].alias("url"),
        body.alias("html"),
        F.when(F.octet_length(body) >= MIN_SHARED, F.sha2(body, 256))
        .otherwise(key_part(pages[f"`{page_id}`"])).alias("digest"))
    first = settled(
        rows.where(F.octet_length("html") >= MIN_SHARED).groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1").drop("n"))
    later = F.col("page_id").isNull() | (F.col("page_id") > F.col("first"))
    return rows.join(small(first), "digest", "left").select(
        "page_id", "url", "html", F.when(later, F.col("first")).alias("refers_to"))


def write_warc(pages: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write archives of ``with_references`` rows into ``path``; the manifest ``(name, records)``.

    Names hold a part of their own per attempt, so a task that is run again
    never touches another attempt's files; only the manifest's files count.
    """
    filesystem, folder = pafs.FileSystem.from_uri(path)
    filesystem.create_dir(folder, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = pafs.FileSystem.from_uri(path)
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            name = f"{uuid.uuid4().hex}.warc.zst"
            with fs.open_output_stream(f"{folder}/{name}", compression=None) as f:
                f.write(archive(held))
            return pa.RecordBatch.from_pydict({"name": [name], "records": [len(held)]})

        for batch in batches:
            for i in range(batch.num_rows):
                page_id, url, page, refers_to = (c[i].as_py() for c in batch.columns)
                held.append(record(page_id, url, page.encode(), refers_to, refers_to is not None))
                size += len(held[-1])
                if size >= archive_bytes:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return settled(pages.mapInArrow(run, "name string, records long"))


def read_warc(spark: SparkSession, path: str, manifest: DataFrame | None = None,
              payloads: bool = False) -> DataFrame:
    """One row per record of the archives in ``path`` (those of the manifest, if given)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(path)
    files = files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")
    if manifest is not None:
        files = files.join(manifest.select("name"), "name", "left_semi")
    schema = ("page_id long, url string, payload_bytes long, payload_digest string, "
              "record_type string, refers_to long" + (", payload binary" if payloads else ""))
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows = [described(x) for x in frames(content.as_py())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[c] for r in rows], _ARROW[c]) for c in names], names=names)

    return files.select("content").mapInArrow(run, schema)


_ARROW = {"page_id": pa.int64(), "url": pa.string(), "payload_bytes": pa.int64(),
          "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64(),
          "payload": pa.binary()}


def round_trip(pages: DataFrame, page_id: str = "page_id", url: str = "url",
               page: str = "html") -> DataFrame:
    """Write every page to archives in the shared folder and read them back."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    if "://" not in path and ":/" in path:  # file:/folder, as Hadoop writes it
        path = path.replace(":/", ":///", 1)
    try:
        manifest = write_warc(with_references(pages, page_id, url, page), path)
        return settled(read_warc(spark, path, manifest).drop("url"))
    finally:
        remove_path(spark, path)
