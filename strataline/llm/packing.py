"""Packing of token ids into sequences of a fixed length by Karmarkar-Karp multiway differencing."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataline.llm.caches import in_worker
from strataline.llm.storage import bounded_batches
from strataline.llm.tokenization import encoder, in_groups

#: Tokens in a sequence.
CAPACITY = 2048
#: What is left of a document after its full sequences is cut into equal pieces of at most this.
PIECE_LIMIT = 512
#: Windows that are balanced together, and the tokens left free in each on average, so that
#: near-equal windows need not be filled to the last token.
BATCH_WINDOWS = 256
FREE = 8

SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def differencing(sizes: np.ndarray, windows: int, blocks: bool = False) -> np.ndarray:
    """The window of each piece, by Karmarkar-Karp differencing into `windows` sets.

    Every piece starts as a partial partition with one filled set; with `blocks`, every run of
    `windows` pieces in order of size starts as one, which leaves far fewer to merge. The two
    partitions with the largest spread are merged, fullest set with emptiest, until one is left;
    the choices are then read back from the last merge to the first. Ties fall by position.
    """
    n = len(sizes)
    if windows == 1 or n <= 1:
        return np.zeros(n, np.int64)
    order = np.argsort(-sizes, kind="stable")
    step = windows if blocks else 1
    members = [order[k : k + step] for k in range(0, n, step)]
    sums: dict[int, np.ndarray] = {}
    heap: list[tuple[int, int]] = []
    for i, some in enumerate(members):
        sums[i] = np.zeros(windows, np.int64)
        sums[i][: len(some)] = sizes[some]
        sums[i] -= sums[i][-1]
        heap.append((-int(sums[i][0]), i))
    heapq.heapify(heap)
    merges: list[tuple[int, int, np.ndarray]] = []
    while len(heap) > 1:
        (_, a), (_, b) = heapq.heappop(heap), heapq.heappop(heap)
        both = sums.pop(a) + sums.pop(b)[::-1]
        order = np.argsort(-both, kind="stable")
        both = both[order]
        both -= both[-1]
        node = len(members) + len(merges)
        merges.append((a, b, order))
        sums[node] = both
        heapq.heappush(heap, (-int(both[0]), node))
    place: dict[int, np.ndarray] = {len(members) + len(merges) - 1: np.arange(windows)}
    for k in range(len(merges) - 1, -1, -1):
        a, b, order = merges[k]
        own = place.pop(len(members) + k)
        for child, position in ((a, order), (b, windows - 1 - order)):
            at = np.empty(windows, np.int64)
            at[position] = own
            place[child] = at
    out = np.empty(n, np.int64)
    for i, some in enumerate(members):
        out[some] = place[i][: len(some)]
    return out


def balanced(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Near-equal windows, none above the capacity: the number of windows rises until all fit.

    Each number is tried from blocks of pieces first, then from single pieces.
    """
    if len(sizes) and sizes.max() > capacity:
        raise ValueError("a piece is longer than a sequence")
    windows = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        for blocks in (True, False):
            window = differencing(sizes, windows, blocks)
            filled = np.bincount(window, weights=sizes, minlength=windows) if len(sizes) else np.zeros(1)
            over = int(np.maximum(filled - capacity, 0).sum())
            if not over:
                return window
        windows = min(len(sizes), windows + max(1, over // capacity))


def cuts(n_tokens: int, capacity: int, piece_limit: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full sequences first, then equal parts of the rest."""
    full = n_tokens // capacity
    pieces = [(k * capacity, capacity) for k in range(full)]
    rest = n_tokens - full * capacity
    parts = -(-rest // piece_limit)
    edges = [full * capacity + rest * k // parts for k in range(parts + 1)] if parts else []
    return pieces + [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def pack_documents(
    documents: DataFrame,
    tokenizer_path: str,
    end_id: int = 1,
    capacity: int = CAPACITY,
    piece_limit: int = PIECE_LIMIT,
    batch_windows: int = BATCH_WINDOWS,
) -> DataFrame:
    """Pieces of all documents with their ids, sequence and offset.

    Takes `doc_id` and `text`; other columns are not read. A null or empty text has only the
    end id. Repeated rows are packed once each; a null doc_id stays null. An empty table gives
    an empty result. `ids` are little-endian unsigned 32-bit integers.

    Nothing is shuffled. Each task reads its rows in order, sends full sequences out at once,
    and gathers the remaining pieces until they fill a batch of windows, which is balanced and
    sent out. So a task holds one batch, and at most the last window of each batch and of each
    input partition is not filled. A sequence's id is the partition's number times 2^40 plus a
    count, the same when a lost task is repeated.
    """
    if not 0 < piece_limit <= capacity:
        raise ValueError("piece_limit must lie between 1 and the capacity")
    bounded_batches(documents.sparkSession)
    schema = pa.schema(
        [(c, pa.binary() if c == "ids" else pa.int64()) for c in [f.split()[0] for f in SCHEMA.split(", ")]]
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 40
        tokens = encoder(tokenizer_path, "spaces_dropped")
        end = np.array([end_id], "<u4").tobytes()
        sent = 0
        rows: list[tuple] = []
        waiting: list[tuple] = []
        waiting_tokens = 0

        def out() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            rows.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
            )

        def flush() -> None:
            nonlocal sent, waiting_tokens
            sizes = np.array([p[2] for p in waiting], np.int64)
            window = balanced(sizes, capacity)
            offsets = dict.fromkeys(window.tolist(), 0)
            numbers = {w: base + sent + k for k, w in enumerate(sorted(offsets))}
            sent += len(offsets)
            for piece, w in zip(waiting, window.tolist(), strict=True):
                rows.append((*piece, numbers[w], offsets[w]))
                offsets[w] += piece[2]
            waiting.clear()
            waiting_tokens = 0

        for batch in in_groups(batches):
            for doc_id, ids in zip(batch[0].to_pylist(), tokens.encode(batch[1].to_pylist()), strict=True):
                ids += end
                n = len(ids) // 4
                for start, length in cuts(n, capacity, piece_limit):
                    piece = (doc_id, start, length, ids[4 * start : 4 * (start + length)], n)
                    if length == capacity:
                        rows.append((*piece, base + sent, 0))
                        sent += 1
                        continue
                    if waiting_tokens + length > batch_windows * max(capacity - FREE, piece_limit):
                        flush()
                    waiting.append(piece)
                    waiting_tokens += length
                if len(rows) >= 2000:
                    yield out()
        if waiting:
            flush()
        if rows:
            yield out()

    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(in_worker(pack, "tokens"), SCHEMA)
