"""Packing of tokenized documents into sequences by Karmarkar-Karp multiway differencing.

Documents are cut where a sequence is full, and what is left over into pieces of at most
``piece`` tokens. Full pieces are sequences of their own. The others are dealt by hash to
blocks of about ``windows`` sequences each. In a block, every piece starts as a partition of
its own: one loaded window and the rest empty. The two partitions with the largest imbalance
are merged with opposing order, the fullest window of one with the emptiest of the other,
until one partition is left. If its fullest window exceeds the capacity, the block is
partitioned again over one window more.

Null texts are empty; an empty document is one piece, its end token. Repeated rows are packed
once each, their rows only differ in place. Rows without a ``doc_id`` are packed like others.
An empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import base64
import heapq
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panewise.llm.tables import stored

CAPACITY = 2048
END = 1
PIECE = 512
#: The quick encoder looks ahead over white space on its stack, which fails between 400,000 and 1,200,000 characters.
LONGEST_SPACE = 100_000
WINDOWS = 64

_PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, dealt bigint"
_PLACES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


@lru_cache(maxsize=2)
def _encoding(ranks: str, pattern: str):
    import tiktoken

    with open(ranks, "rb") as lines:
        table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("pieces", pat_str=pattern, mergeable_ranks=table, special_tokens={})


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer


def byte_pairs(text: str | None, tokenizer: str, ranks: str, pattern: str) -> list[int]:
    """Token ids of a text. The rank file holds the vocabulary and merges of the tokenizer file."""
    if not text:
        return []
    if len(text) > LONGEST_SPACE and any(m.end() - m.start() > LONGEST_SPACE for m in re.finditer(r"\s+", text)):
        return _tokenizer(tokenizer).encode(text, add_special_tokens=False).ids
    return _encoding(ranks, pattern).encode_ordinary(text)


def cuts(count: int, capacity: int, piece: int) -> Iterator[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``count`` tokens."""
    start = 0
    while count - start >= capacity:
        yield start, capacity
        start += capacity
    while start < count:
        length = min(piece, count - start)
        yield start, length
        start += length


def differencing(sizes: list[int], windows: int) -> list[list[int]]:
    """Divide items over ``windows`` with nearly equal sums: the item numbers of each window."""
    heap = []
    for item, size in enumerate(sizes):
        loads = np.zeros(windows, dtype=np.int64)
        loads[0] = size
        heap.append((-size, item, loads, [[item], *([] for _ in range(windows - 1))]))
    heapq.heapify(heap)
    for turn in range(len(sizes), 2 * len(sizes) - 1):
        _, _, loads, held = heapq.heappop(heap)
        _, _, others, theirs = heapq.heappop(heap)
        loads = loads + others[::-1]
        order = np.argsort(-loads, kind="stable")
        theirs.reverse()
        held = [held[k] + theirs[k] for k in order.tolist()]
        loads = loads[order]
        heapq.heappush(heap, (int(loads[-1] - loads[0]), turn, loads, held))
    return heap[0][3] if heap else []


def near_equal_windows(sizes: list[int], capacity: int) -> list[list[int]]:
    """Windows within ``capacity``, as few as differencing reaches."""
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        held = differencing(sizes, windows)
        if all(sum(sizes[item] for item in window) <= capacity for window in held):
            return [window for window in held if window]
        windows += 1


def _cut_documents(tokenizer: str, ranks: str, pattern: str, capacity: int, piece: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.array([*byte_pairs(text.as_py(), tokenizer, ranks, pattern), END], dtype="<u4")
                for start, length in cuts(len(ids), capacity, piece):
                    crc = zlib.crc32(ids[start : start + length].tobytes())
                    # Dealt by content and place: the same after a lost task, and hot sources spread out.
                    dealt = zlib.crc32(f"{doc_id}:{start}:{crc}".encode())
                    rows.append((doc_id, start, length, crc, len(ids), dealt))
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=[c.split()[0] for c in _PIECES.split(", ")])

    return run


def pieces(docs: DataFrame, tokenizer: str, ranks: str, pattern: str, capacity: int = CAPACITY, piece: int = PIECE) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, dealt): the pieces of every document."""
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        _cut_documents(tokenizer, ranks, pattern, capacity, piece), _PIECES
    )


def pack(
    docs: DataFrame,
    tokenizer: str,
    ranks: str,
    pattern: str,
    capacity: int = CAPACITY,
    piece: int = PIECE,
    windows: int = WINDOWS,
) -> DataFrame:
    """Place every piece of every document: ``sequence_id`` and ``offset`` there.

    ``tokenizer`` is the path of a byte-level vocabulary for ``tokenizers``; ``ranks`` and ``pattern`` are
    the same vocabulary and its word pattern for ``tiktoken``, which gives the same ids in a third of the time.
    The pieces, a few numbers each, are written to the shared folder; texts never move.
    """
    spark = docs.sparkSession
    cut = stored(pieces(docs, tokenizer, ranks, pattern, capacity, piece), "pieces")
    total = cut.where(F.col("length") < capacity).agg(F.sum("length")).first()[0] or 0
    blocks = max(1, total // (windows * capacity))

    def place(frame):
        # Equal content goes in one order, whatever order the shuffle brings.
        frame = frame.sort_values(["doc_id", "start", "ids_crc32"], kind="stable").reset_index(drop=True)
        sizes = frame["length"].tolist()
        block = int(frame["block"].iloc[0])
        sequence, offset = [0] * len(sizes), [0] * len(sizes)
        for number, window in enumerate(near_equal_windows(sizes, capacity)):
            at = 0
            for item in window:
                # Even numbers for blocks, odd ones for full pieces.
                sequence[item], offset[item] = 2 * (number * blocks + block), at
                at += sizes[item]
        frame["sequence_id"], frame["offset"] = sequence, offset
        return frame[[c.split()[0] for c in _PLACES.split(", ")]]

    partial = cut.where(F.col("length") < capacity).withColumn("block", F.col("dealt") % blocks)
    placed = partial.groupBy("block").applyInPandas(place, _PLACES)
    full = cut.where(F.col("length") >= capacity).withColumns(
        {"sequence_id": 2 * F.monotonically_increasing_id() + 1, "offset": F.lit(0).cast("bigint")}
    )
    return placed.unionByName(full.drop("dealt"))
