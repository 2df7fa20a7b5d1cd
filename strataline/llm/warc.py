"""WARC archives in zstandard: the dictionary in the leading skippable frame, one frame per record."""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataline.llm.caches import in_worker
from strataline.llm.storage import AttemptFile, bounded_batches, new_folder, opened, sampled

#: Fixed values of the zstandard and WARC formats.
DICTIONARY_FRAME = 0x184D2A5D
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

LEVEL = 3
#: The dictionary is trained on about so many payloads, drawn by hash, of which those of at most
#: so many bytes are taken. It decides how small the archives get, never what they hold.
TRAINING_PAGES = 1000
TRAINING_BYTES = 20_000
DICTIONARY_BYTES = 64 * 1024
READ_BYTES = 1 << 20

ROWS = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"
_STATUS = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "


def digest_text(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()  # noqa: S324 - the format's digest


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One record: a response with its payload, or a revisit with the same HTTP head and no payload.

    Line breaks in a url are percent-encoded; a null page_id or url leaves its header out.
    """
    block = _STATUS + str(len(payload)).encode() + b"\r\n\r\n" + (b"" if revisit else payload)
    heads = [("WARC-Type", "revisit" if revisit else "response")]
    if page_id is not None:
        heads.append(("WARC-Record-ID", f"<urn:page:{page_id}>"))
    if url is not None:
        heads.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    heads += [
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{digest_text(payload)}"),
    ]
    if revisit:
        heads.append(("WARC-Profile", REVISIT_PROFILE))
        heads.append(("WARC-Refers-To", f"<urn:page:{refers_to}>"))
    heads.append(("Content-Length", str(len(block))))
    lines = "".join(f"{k}: {v}\r\n" for k, v in heads).encode()
    return VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple:
    """(page_id, url, payload or None, payload_bytes, digest, type, refers_to) of one record.

    Raises ValueError where the version, a needed header, a length or a digest is not right.
    """
    head, mark, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not mark or lines[0] != VERSION:
        raise ValueError("a frame does not start with a WARC header")
    heads: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.decode().partition(": ")
        if not colon or name.lower() in heads:
            raise ValueError(f"a header is malformed or repeated: {line!r}")
        heads[name.lower()] = value
    missing = {"warc-type", "warc-date", "content-length", "warc-payload-digest"} - heads.keys()
    if missing:
        raise ValueError(f"headers are missing: {sorted(missing)}")
    length = int(heads["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError("the block's length is not the header's")
    http, _, payload = rest[:length].partition(b"\r\n\r\n")
    if not (stated := re.search(rb"(?m)^Content-Length: (\d+)\r?$", http)):
        raise ValueError("the HTTP head states no length")
    kind, digest = heads["warc-type"], heads["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response":
        if len(payload) != int(stated[1]) or digest_text(payload) != digest:
            raise ValueError("the payload's length or digest is not the stated one")
    elif kind != "revisit" or payload or "warc-refers-to" not in heads:
        raise ValueError(f"no response and no complete revisit: {kind}")
    number = lambda v: None if v is None else int(v.removeprefix("<urn:page:").removesuffix(">"))
    return (
        number(heads.get("warc-record-id")),
        heads.get("warc-target-uri"),
        payload if kind == "response" else None,
        int(stated[1]),
        digest,
        kind,
        number(heads.get("warc-refers-to")) if kind == "revisit" else None,
    )


def archive_head(dictionary: bytes) -> bytes:
    """The leading skippable frame."""
    return struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary


def _options(dictionary: bytes) -> dict:
    return {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}


def read_records(stream) -> Iterator[bytes]:
    """Each frame's content, in order. Holds one frame; raises ValueError on a damaged archive."""
    head = stream.read(8)
    if len(head) != 8 or struct.unpack("<I", head[:4])[0] != DICTIONARY_FRAME:
        raise ValueError("the archive does not start with a dictionary frame")
    size = struct.unpack("<I", head[4:])[0]
    dictionary = stream.read(size)
    if len(dictionary) != size:
        raise ValueError("the dictionary frame is cut off")
    if dictionary[:4] == ZSTD_MAGIC:  # the format also allows a compressed dictionary
        dictionary = zstandard.ZstdDecompressor().decompress(dictionary)
    decompressor = zstandard.ZstdDecompressor(**_options(dictionary))
    rest = b""
    while True:
        frame, parts = decompressor.decompressobj(), []
        while not frame.eof:
            rest = rest or stream.read(READ_BYTES)
            if not rest:
                if parts or frame.unconsumed_tail:
                    raise ValueError("the last frame is cut off")
                return
            parts.append(frame.decompress(rest))
            rest = frame.unused_data if frame.eof else b""
        yield b"".join(parts)


def _trained(payloads: DataFrame) -> bytes:
    payload = F.col("payload")
    some = sampled(payloads, TRAINING_PAGES, "page_id", "payload").select("payload")
    some = some.where(F.length(payload).between(1, TRAINING_BYTES))

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        samples = [p for batch in batches for p in batch[0].to_pylist()]
        try:
            found = zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
        except zstandard.ZstdError:  # too few samples
            found = b""
        yield pa.RecordBatch.from_pydict({"dictionary": pa.array([found], pa.binary())})

    return max((bytes(r[0]) for r in some.coalesce(1).mapInArrow(in_worker(train), "dictionary binary").collect()), key=len, default=b"")


def write_archives(pages: DataFrame, folder: str | None = None, revisit_bytes: int = 0) -> list[str]:
    """Write a record per row of `pages` (page_id, url, html) and return the archives' addresses.

    The payload is the html in UTF-8; null counts as empty. Of records with equal payloads of at
    least `revisit_bytes` bytes, those with the largest page_id are responses and the others
    revisit it; rows that repeat the largest id are responses too, and so are rows of a payload
    that has no id at all. A null id beside others revisits. Other columns are not read; an empty
    table gives no archive. Equal payloads are found by SHA-1: one narrow grouping
    with map-side combining, joined back on the digest, where adaptive execution splits a payload
    that a third of the pages share. One archive per partition.
    """
    spark = pages.sparkSession
    bounded_batches(spark)
    folder = folder or new_folder(spark, "warc")
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload")
    )
    dictionary = _trained(rows)
    rows = rows.withColumn("digest", F.sha1("payload"))
    equal = (
        rows.groupBy("digest")
        .agg(F.max("page_id").alias("kept_id"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 and kept_id is not null")
        .select("digest", "kept_id")
    )
    revisit = F.col("kept_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("kept_id")) & (F.length("payload") >= revisit_bytes)
    typed = rows.join(equal, "digest", "left").select("page_id", "url", "payload", "kept_id", revisit.alias("revisit"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True, **_options(dictionary))
        file = None
        for batch in batches:
            if file is None:
                file = AttemptFile(folder, f"pages-{TaskContext.get().partitionId():06d}.warc.zst")
                file.write(archive_head(dictionary))
            for page_id, url, data, kept, again in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                file.write(compressor.compress(record(page_id, url, data, kept, again)))
        if file is not None:
            yield pa.RecordBatch.from_pydict({"path": pa.array([file.commit()], pa.string())})

    return sorted(r[0] for r in typed.mapInArrow(in_worker(write), "path string").collect())  # one row per archive


def read_archives(spark: SparkSession, archives: list[str]) -> DataFrame:
    """The records of archives, one task per archive: page_id, url, payload (null for revisits),
    payload_bytes, payload_digest, record_type, refers_to."""
    bounded_batches(spark)
    schema = pa.schema(
        [("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64())]
        + [("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch[0].to_pylist():
                fs, at = opened(path)
                some: list[tuple] = []
                with fs.open_input_stream(at, compression=None) as stream:
                    for data in read_records(stream):
                        some.append(parse(data))
                        if len(some) == 256:
                            yield _table(some, schema)
                            some = []
                if some:
                    yield _table(some, schema)

    listed = spark.createDataFrame([(p,) for p in archives], "path string").repartition(max(1, len(archives)))
    return listed.mapInArrow(in_worker(read), ROWS)


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema
    )
