"""Token-id files: one zstandard frame per document under a shared, trained dictionary.

A shard file holds, little-endian:
  magic `SLTOKID1`, the sha256 of the dictionary (32 bytes),
  one zstandard frame per document (its ids as unsigned 32-bit integers),
  an index with one entry per document: doc_id int64, is_null uint8, offset uint64,
  bytes uint64, n_tokens uint64,
  a footer: offset of the index uint64, number of documents uint64, magic.
The dictionary lies beside the shards. One document is read with the index and one frame.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataline.llm.caches import in_worker
from strataline.llm.storage import AttemptFile, bounded_batches, new_folder, opened, sampled
from strataline.llm.tokenization import encoder, in_groups

MAGIC = b"SLTOKID1"
INDEX = np.dtype([("doc_id", "<i8"), ("is_null", "u1"), ("offset", "<u8"), ("bytes", "<u8"), ("n_tokens", "<u8")])
FOOTER = 8 + 8 + len(MAGIC)
LEVEL = 3
#: The dictionary is trained on about so many documents, drawn by hash, of which those of at most
#: so many characters are taken. It decides how small the files get, never what they hold.
TRAINING_DOCUMENTS = 2000
TRAINING_CHARS = 20_000
DICTIONARY_BYTES = 64 * 1024

MANIFEST = "shard int, path string, n_docs long, n_tokens long, first_id long, last_id long"
MANIFEST_ARROW = pa.schema(
    [("shard", pa.int32()), ("path", pa.string()), *((c, pa.int64()) for c in ("n_docs", "n_tokens", "first_id", "last_id"))]
)


@dataclass(frozen=True)
class TokenFiles:
    """A written set of shards, in ascending order of their documents.

    `shards` has (shard, path, n_docs, n_tokens, first_id, last_id); one row per file.
    """

    folder: str
    dictionary: str
    shards: list[tuple]


def trained(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary from serialised id arrays. Too few samples to train on: their own bytes;
    none: empty."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size]


def _dictionary(documents: DataFrame, tokenizer_path: str, end: bytes) -> bytes:
    text = F.col("text")
    some = sampled(documents, TRAINING_DOCUMENTS, "doc_id", "text")
    some = some.where(text.isNotNull() & F.length(text).between(1, TRAINING_CHARS)).select("text")

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        samples: list[bytes] = []
        for batch in batches:
            samples += [ids + end for ids in encoder(tokenizer_path, "space_leads").encode(batch[0].to_pylist())]
        yield pa.RecordBatch.from_pydict({"dictionary": pa.array([trained(samples)], pa.binary())})

    found = some.coalesce(1).mapInArrow(in_worker(train, "tokens"), "dictionary binary").collect()
    return max((bytes(row[0]) for row in found), key=len, default=b"")


def compression(dictionary: bytes) -> dict:
    return {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}


def write_token_files(documents: DataFrame, tokenizer_path: str, end_id: int = 2, folder: str | None = None) -> TokenFiles:
    """Encode every whole text, append the end id, and write shards in ascending doc_id order.

    Takes `doc_id` and `text`; other columns are not read. A null text counts as empty, null
    ids come first, rows that share an id follow each other in order of their text's hash, equal
    rows in any order. An empty table gives no shard. Shards are range partitions of (doc_id, hash
    of the text, place in the input), as many as the session has shuffle partitions, so neither an
    id nor a row that repeats very often fills one shard; a task streams its rows and holds one
    batch.
    """
    spark = documents.sparkSession
    bounded_batches(spark)
    folder = folder or new_folder(spark, "token-files")
    end = np.array([end_id], "<u4").tobytes()
    documents = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    dictionary = _dictionary(documents, tokenizer_path, end)
    name = AttemptFile(folder, "dictionary.zdict")
    name.write(dictionary)
    dictionary_uri = name.commit()
    digest = hashlib.sha256(dictionary).digest()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        tokens = encoder(tokenizer_path, "space_leads")
        compressor = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True, **compression(dictionary))
        file = None
        entries: list[np.ndarray] = []
        for batch in in_groups(batches):
            if file is None:
                file = AttemptFile(folder, f"shard-{shard:06d}.ids")
                file.write(MAGIC + digest)
            ids = batch[0].to_pylist()
            some = np.zeros(len(ids), INDEX)
            for k, (doc_id, data) in enumerate(zip(ids, tokens.encode(batch[1].to_pylist()), strict=True)):
                data += end
                frame = compressor.compress(data)
                some[k] = (doc_id or 0, doc_id is None, file.size, len(frame), len(data) // 4)
                file.write(frame)
            entries.append(some)
        if file is None:
            return
        index = np.concatenate(entries)
        at = file.size
        file.write(index.tobytes())
        file.write(np.array([at, len(index)], "<u8").tobytes() + MAGIC)
        present = index["doc_id"][index["is_null"] == 0]
        first, last = (int(present[0]), int(present[-1])) if len(present) else (None, None)
        row = (shard, file.commit(), len(index), int(index["n_tokens"].sum()), first, last)
        yield pa.RecordBatch.from_arrays(
            [pa.array([v], f.type) for v, f in zip(row, MANIFEST_ARROW, strict=True)], schema=MANIFEST_ARROW
        )

    # Equal rows differ in their place in the input alone, which spreads them over shards as well.
    keys = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc(), F.col("at").asc()]
    rows = (
        documents.withColumn("at", F.monotonically_increasing_id())
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .select("doc_id", "text")
        .mapInArrow(in_worker(write, "tokens"), MANIFEST)
        .collect()  # one row per shard
    )
    return TokenFiles(folder, dictionary_uri, sorted(tuple(r) for r in rows))


def _open_shard(path: str, dictionary: bytes):
    """The shard's file and its index, after the checks of its magics and dictionary hash."""
    fs, at = opened(path)
    file = fs.open_input_file(at)
    size = file.size()
    head = file.read_at(len(MAGIC) + 32, 0)
    foot = file.read_at(FOOTER, size - FOOTER)
    if head[: len(MAGIC)] != MAGIC or foot[16:] != MAGIC:
        raise ValueError(f"{path} is no complete token file")
    if head[len(MAGIC) :] != hashlib.sha256(dictionary).digest():
        raise ValueError(f"{path} was written with another dictionary")
    start, count = (int(v) for v in np.frombuffer(foot[:16], "<u8"))
    return file, np.frombuffer(file.read_at(count * INDEX.itemsize, start), INDEX)


def _read_whole(uri: str) -> bytes:
    fs, at = opened(uri)
    with fs.open_input_file(at) as file:
        return file.read()


def _ids(file, entry: np.void, decompressor: zstandard.ZstdDecompressor) -> bytes:
    data = decompressor.decompress(file.read_at(int(entry["bytes"]), int(entry["offset"])))
    if len(data) != 4 * int(entry["n_tokens"]):
        raise ValueError("a frame does not hold the number of ids that the index says")
    return data


def read_token_files(spark: SparkSession, files: TokenFiles) -> DataFrame:
    """One row per document: doc_id, start (ids of all documents before it), n_tokens, ids.

    One task per shard, one frame in memory at a time.
    """
    bounded_batches(spark)
    before, rows = 0, []
    for shard in files.shards:
        rows.append((shard[1], before))
        before += shard[3]
    dictionary_uri = files.dictionary
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dictionary = None
        for batch in batches:
            for path, start in zip(batch[0].to_pylist(), batch[1].to_pylist(), strict=True):
                dictionary = _read_whole(dictionary_uri) if dictionary is None else dictionary
                decompressor = zstandard.ZstdDecompressor(**compression(dictionary))
                file, index = _open_shard(path, dictionary)
                starts = start + np.concatenate([[0], np.cumsum(index["n_tokens"].astype(np.int64))])
                for a in range(0, len(index), 256):
                    some = index[a : a + 256]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(some["doc_id"], pa.int64(), mask=some["is_null"] == 1),
                            pa.array(starts[a : a + len(some)], pa.int64()),
                            pa.array(some["n_tokens"].astype(np.int64)),
                            pa.array([_ids(file, entry, decompressor) for entry in some], pa.binary()),
                        ],
                        schema=schema,
                    )
                file.close()

    listed = spark.createDataFrame(rows, "path string, before long").repartition(max(1, len(rows)))
    return listed.mapInArrow(in_worker(read), "doc_id long, start long, n_tokens long, ids binary")


def read_document(files: TokenFiles, doc_id: int) -> list[np.ndarray]:
    """The ids of each row with this id, by index: no shard is read whole."""
    dictionary = _read_whole(files.dictionary)
    decompressor = zstandard.ZstdDecompressor(**compression(dictionary))
    found = []
    for _, path, _, _, first, last in files.shards:
        if first is None or not first <= doc_id <= last:
            continue
        file, index = _open_shard(path, dictionary)
        for entry in index[(index["doc_id"] == doc_id) & (index["is_null"] == 0)]:
            found.append(np.frombuffer(_ids(file, entry, decompressor), "<u4"))
        file.close()
    return found
