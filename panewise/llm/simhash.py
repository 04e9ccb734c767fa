"""SimHash near-dedup by meet-in-the-middle ball hashing.

Fingerprints that differ in at most ``2 r`` of 64 bits differ in at most ``r`` bits of their
upper or their lower half (``r`` is 2). Within a half, two values at most ``r`` apart meet half
way: both have some value within ``r / 2`` flips. So every distinct fingerprint emits, for each
half, all variants within half that radius: 2 x 33 keys of 32 bits, where variants of the whole
fingerprint would be 2,081. Keys are shuffled and sorted once, and each task streams through its
keys: fingerprints that meet at a key are compared on all 64 bits, and a spanning forest of the
links they have is given out, never all pairs. A key at which more than ``PART`` fingerprints meet
is not compared: its fingerprints emit their 2,081 whole variants within two flips instead. Two
that share one differ in at most four bits, so every variant links its fingerprints to the least
of them, without a comparison; work stays in proportion to the fingerprints however hot the key.

Null and empty texts have fingerprint zero and link like any other. A row without a ``doc_id``
gets its fingerprint, is linked to nothing and names no component. Repeated rows each get
their row. An empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panewise.llm.components import components
from panewise.llm.tables import stored
from panewise.llm.words import encode

SHINGLE = 4
DISTANCE = 4
SEED = 42
PART = 256  # most fingerprints of one key that are compared with each other
TASK_ROWS = 1 << 20  # keys that one task emits

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of a text: bits set in over half of the shingles' hashes."""
    from xxhash import xxh64_intdigest

    words = text.translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    reach = min(shingle, len(words))
    stops = ends[reach - 1 :].tolist()
    starts = [0, *(ends[: len(stops) - 1] + 1).tolist()]
    hashes = np.array(
        [xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, stops, strict=True)], dtype="<u8"
    )
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        block = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes), bitorder="little").tobytes(), "little")


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(encode(text.as_py()), shingle) for text in batch.column(1)]
            values = np.array(found, dtype=np.uint64).view(np.int64)
            yield pa.record_batch([batch.column(0), pa.array(values)], names=["doc_id", "fp"])

    return run


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): the fingerprint of every document as a signed 64-bit number."""
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        _fingerprints(shingle), "doc_id bigint, fp bigint"
    )


def forest(left: np.ndarray, right: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links (index in left, index in right) that span what the two sides link to each other."""
    close = np.bitwise_count(left[:, None] ^ right[None, :]) <= distance
    rows, columns = np.nonzero(close)
    nodes = len(left) + len(right)
    parent = list(range(nodes))

    def root(node: int) -> int:
        while parent[node] != node:
            parent[node] = parent[parent[node]]
            node = parent[node]
        return node

    links = []
    for a, b in zip(rows.tolist(), columns.tolist(), strict=True):
        x, y = root(a), root(len(left) + b)
        if x != y:
            parent[y] = x
            links.append((a, b))
            if len(links) == nodes - 1:
                break  # all are joined
    return links


LINKS = "a bigint, b bigint, hot boolean"


def _links_batch(pairs: np.ndarray, hot: bool) -> pa.RecordBatch:
    a, b = (np.ascontiguousarray(pairs[:, side]).view(np.int64) for side in (0, 1))
    return pa.record_batch([pa.array(a), pa.array(b), pa.array(np.full(len(a), hot))], names=["a", "b", "hot"])


def _at_keys(distance: int, part: int):
    """Links among the fingerprints of each key, from rows (key, fp) sorted by key.

    At most ``part`` fingerprints are held. When a key has more, each of them is given out
    once as (fp, fp, hot), and the rest of the key streams through.
    """

    def linked(held: np.ndarray, hot: bool) -> list[np.ndarray]:
        if hot or len(held) < 2:
            return []
        pairs = np.array(forest(held, held, distance), dtype=np.int64)
        return [held[pairs[pairs[:, 0] != pairs[:, 1]]]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, hot = None, np.zeros(0, dtype=np.uint64), False
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, values = (batch.column(k).to_numpy().view(np.uint64) for k in (0, 1))
            edges = np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1, [len(keys)]])
            # A key of one row links nothing, but the first and the last may go on in other batches.
            looked_at = np.diff(edges) > 1
            looked_at[[0, -1]] = True
            pairs, hot_ones = [], []
            for at in np.flatnonzero(looked_at).tolist():
                here = values[edges[at] : edges[at + 1]]
                if keys[edges[at]] != current:
                    pairs += linked(held, hot)
                    current, held, hot = keys[edges[at]], here[:0], False
                if hot:
                    hot_ones.append(here)
                    continue
                held = np.concatenate([held, here])
                if len(held) > part:
                    hot_ones.append(held)
                    held, hot = held[:0], True
            if pairs:
                yield _links_batch(np.concatenate(pairs), False)
            if hot_ones:
                yield _links_batch(np.stack([np.concatenate(hot_ones)] * 2, axis=1), True)
        for pairs in linked(held, hot):
            yield _links_batch(pairs, False)

    return run


def _to_least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b): each fingerprint of a variant with the least of it, from rows (key, fp) sorted by both."""
    key, least = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys, values = (batch.column(k).to_numpy() for k in (0, 1))
        edges = np.flatnonzero(np.diff(keys, prepend=keys[0]) != 0)
        edges = np.concatenate([[0], edges]).astype(np.int64)
        firsts = values[edges].copy()
        if key is not None and keys[0] == key:
            firsts[0] = least
        key, least = keys[-1], firsts[-1]
        pairs = np.stack([np.repeat(firsts, np.diff(np.append(edges, len(keys)))), values], axis=1)
        pairs = np.unique(pairs[pairs[:, 0] != pairs[:, 1]], axis=0)
        yield pa.record_batch([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], names=["a", "b"])


def _flips(bits: int, most: int) -> list[int]:
    """All values of ``bits`` bits, signed if there are 64, with at most ``most`` bits set."""
    values = [sum(1 << bit for bit in chosen) for count in range(most + 1) for chosen in combinations(range(bits), count)]
    return [value - (1 << 64) if value >> 63 else value for value in values]


def ball_keys(fp: str, radius: int) -> list:
    """The variants of both halves of a fingerprint within ``radius`` flips (0 or 1), tagged by half."""
    keys = []
    for half, value in enumerate((F.shiftrightunsigned(fp, 32), F.col(fp).bitwiseAND(0xFFFFFFFF))):
        keys += [value.bitwiseXOR(flip) + F.lit(half << 32) for flip in _flips(32, radius)]
    return keys


def _dealt(keyed: DataFrame, *order: str) -> DataFrame:
    return keyed.repartition("key").sortWithinPartitions(*order)


def _spread(distinct: DataFrame, count: int, keys: int) -> DataFrame:
    """Enough tasks for rows that each become ``keys`` rows: a short table sits in a few."""
    tasks = max(distinct.sparkSession.sparkContext.defaultParallelism, -(-count * keys // TASK_ROWS))
    return distinct.repartition(tasks, "fp")


def links(distinct: DataFrame, distance: int = DISTANCE, part: int = PART) -> DataFrame:
    """(a, b): links between distinct fingerprints ``fp`` that join all that are ``distance`` apart or less."""
    if distance not in (0, 2, 4):
        raise ValueError("balls of half the distance meet for an even number of bits, and halves for up to 4")
    keys = F.array(*ball_keys("fp", 0 if distance < 2 else 1))
    keyed = _spread(distinct, distinct.count(), 66).select(F.explode(keys).alias("key"), "fp")
    found = stored(_dealt(keyed, "key").mapInArrow(_at_keys(distance, part), LINKS), "half-keys")
    hot = stored(found.where("hot").select(F.col("a").alias("fp")).distinct(), "hot-fingerprints")
    compared = found.where("not hot").select("a", "b")
    masks = F.lit(_flips(64, distance // 2)).cast("array<bigint>")
    ball = F.explode(F.transform(masks, lambda mask: F.col("fp").bitwiseXOR(mask))).alias("key")
    variants = _spread(hot, hot.count(), 2081).select(ball, "fp")
    linked = _dealt(variants, "key", "fp").mapInArrow(_to_least, "a bigint, b bigint")
    return compared.unionByName(linked)


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, fp, component_id): the least ``doc_id`` reachable over links between fingerprints."""
    printed = stored(fingerprints(docs, shingle), "fingerprints")
    least = printed.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("least"))
    grouped = components(links(least.select("fp"), distance)).withColumnRenamed("node", "fp")
    rooted = least.join(grouped, "fp", "left").withColumn("root", F.coalesce("component", "fp"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(smallest, "root").select("fp", "component_id")
    # A fingerprint that a great many documents share is small on this side and split on the other.
    joined = printed.join(named, "fp", "left")
    return joined.withColumn("component_id", F.expr("case when doc_id is not null then component_id end"))


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """The rows of ``docs`` whose ``doc_id`` is the least of its component, with all their columns.

    Rows without a ``doc_id`` stay; rows that share one stay or go together.
    """
    found = near_duplicates(docs, shingle, distance).where("doc_id <> component_id")
    gone = stored(found.select("doc_id").distinct(), "near-duplicates")
    # They grow with the documents: both sides are shuffled at every size.
    return docs.join(gone.hint("merge"), "doc_id", "left_anti")
