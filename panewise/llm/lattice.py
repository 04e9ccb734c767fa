"""LM scoring by subword lattices: the probability of a text over all of its segmentations.

The pieces are an existing tokenizer's vocabulary; their unigram scores are learned from how
that tokenizer cuts the words of the learning documents. A word with a word mark in front is a
lattice of pieces, with single bytes for characters beyond the vocabulary; a word of the
learning documents is also one piece as a whole, scored by its own frequency. Whole words
have the share of all tokens that are not met for the first time. Forward recursion in log
space sums the probabilities of all paths; words and one end make up a document.

A word's probability does not depend on its neighbours, so a word is scored once. Texts stay
in blocks: a block lists its distinct words with their learning counts, and each document as
numbers into that list. Only the lists are shuffled: by word, for counts over all documents, and
back to their blocks. A word has at most one row per block, however frequent it is.

Null and empty texts are the end alone. Rows without a ``doc_id`` are scored, but neither
learned from nor held out. Repeated rows count as often as they come. An empty table gives no rows;
further columns are ignored. Words are told apart by 64-bit hashes inside a block, and by
their bytes from there on.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panewise.llm.tables import stored
from panewise.llm.words import cut, groups

BLOCK_BYTES = 12 << 20
MARK = "▁"
ADDED = 0.5

_BLOCKS = "block bigint, place int, word string, learned bigint, doc_id bigint, is_learned boolean, tokens binary"
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


class _Block:
    """Documents of a task whose words are listed together."""

    def __init__(self) -> None:
        self.size = 0
        self.words, self.ids, self.is_learned = [], [], []

    def add(self, texts: list[bytes], ids: list, is_learned: list[bool]) -> None:
        found = cut([text.translate(_LOWER) for text in texts])
        self.words.append((found, found.hashes()))
        self.ids += ids
        self.is_learned += is_learned
        self.size += len(found.data)

    def batches(self, block: int) -> Iterator[pa.RecordBatch]:
        hashes = np.concatenate([h for _, h in self.words])
        codes, distinct = pd.factorize(hashes)
        counts = np.concatenate([np.diff(found.first) for found, _ in self.words])
        weights = np.repeat(np.array(self.is_learned, dtype=np.float64), counts)
        learned = np.bincount(codes, weights=weights, minlength=len(distinct)).astype(np.int64)
        new = np.maximum.accumulate(codes) if len(codes) else codes
        first = np.flatnonzero(np.concatenate([[True], new[1:] > new[:-1]])) if len(codes) else codes
        listed, at = [], 0
        for found, own in self.words:
            raw = found.data.tobytes()
            mine = first[(first >= at) & (first < at + len(own))] - at
            listed += [raw[a:b] for a, b in zip(found.starts[mine].tolist(), found.ends[mine].tolist(), strict=True)]
            at += len(own)
        size = len(listed)
        yield _rows(block, size, place=pa.array(np.arange(size, dtype=np.int32)), word=pa.array(listed, pa.binary()).cast(pa.string()), learned=pa.array(learned))
        edges = np.concatenate([[0], np.cumsum(counts)]) * 4
        raw = codes.astype("<i4").tobytes()
        tokens = [zlib.compress(raw[a:b], 1) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
        yield _rows(
            block, len(tokens), doc_id=pa.array(self.ids, pa.int64()), is_learned=pa.array(self.is_learned), tokens=pa.array(tokens, pa.binary())
        )


def _rows(block: int, size: int, **columns: pa.Array) -> pa.RecordBatch:
    kinds = {
        "block": pa.int64(), "place": pa.int32(), "word": pa.string(), "learned": pa.int64(),
        "doc_id": pa.int64(), "is_learned": pa.bool_(), "tokens": pa.binary(),
    }
    columns["block"] = pa.array(np.full(size, block))
    return pa.record_batch({name: columns.get(name, pa.nulls(size, kind)) for name, kind in kinds.items()})


def _in_blocks(block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A lost task writes its blocks anew; they are read back only when the table is whole.
        number = TaskContext.get().partitionId() << 32
        block = _Block()
        for batch in batches:
            ids, is_learned = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at, held in groups(batch.column(2).to_pylist()):
                if block.size and block.size + sum(map(len, held)) > block_bytes:
                    yield from block.batches(number)
                    number, block = number + 1, _Block()
                block.add(held, ids[at : at + len(held)], is_learned[at : at + len(held)])
        if block.size:
            yield from block.batches(number)

    return run


@lru_cache(maxsize=2)
def _processor(model: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=model)


def vocabulary(model: str) -> tuple[list[str], list[str]]:
    """The pieces that stand for text, and the 256 that stand for bytes."""
    from sentencepiece import SentencePieceProcessor

    known: SentencePieceProcessor = _processor(model)
    plain = [k for k in range(known.get_piece_size()) if not (known.is_control(k) or known.is_unknown(k) or known.is_unused(k))]
    return (
        [known.id_to_piece(k) for k in plain if not known.is_byte(k)],
        [f"<0x{byte:02X}>" for byte in range(256)],
    )


def _count_pieces(model: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts = _processor(model), Counter()
        for batch in batches:
            words, times = batch.column("word").to_pylist(), batch.column("count").to_pylist()
            for ids, count in zip(known.encode(words, num_threads=1), times, strict=True):
                for piece in ids:
                    counts[piece] += count
        pieces = list(counts)
        yield pa.record_batch(
            [pa.array([known.id_to_piece(p) for p in pieces], pa.string()), pa.array([counts[p] for p in pieces], pa.int64())],
            names=["piece", "times"],
        )

    return run


class Lattice:
    """Natural log probabilities of pieces, and of words over all segmentations."""

    def __init__(
        self, pieces: list[str], bytes_: list[str], counts: dict[str, int], tokens: int, once: int, ends: int
    ) -> None:
        total = sum(counts.get(p, 0) for p in (*pieces, *bytes_))
        whole = math.log(total + ADDED * (len(pieces) + len(bytes_)))
        score = lambda count: math.log(count + ADDED) - whole
        # Tokens that occur once were new when they came: their share is left to the pieces.
        known = (tokens - once + ADDED) / (tokens + 1)
        self.log_word = math.log(known / max(tokens, 1))
        self.log_pieces = math.log(1.0 - known)
        self.end = math.log(known * (ends + ADDED) / (tokens + ADDED))
        self.byte = [score(counts.get(b, 0)) for b in bytes_]
        #: Every beginning of a piece; the score where it is a piece itself.
        self.table: dict[str, float | None] = {}
        for piece in pieces:
            for stop in range(1, len(piece)):
                self.table.setdefault(piece[:stop], None)
            self.table[piece] = score(counts.get(piece, 0))

    def word(self, word: str, count: int = 0) -> float:
        """Log of the summed probability of all segmentations of a word with this learning count."""
        text, table = MARK + word, self.table
        size = len(text)
        arriving: list[list[float]] = [[] for _ in range(size + 1)]
        arriving[0].append(self.log_pieces)
        if count:
            arriving[size].append(self.log_word + math.log(count))
        for at in range(size):
            terms = arriving[at]
            most = max(terms)
            alpha = most if len(terms) == 1 else most + math.log(sum([math.exp(t - most) for t in terms]))
            arriving[at] = []
            spelled = alpha
            for byte in text[at].encode("utf-8", "surrogatepass"):
                spelled += self.byte[byte]
            arriving[at + 1].append(spelled)
            for stop in range(at + 1, size + 1):
                piece = text[at:stop]
                if piece not in table:
                    break
                score = table[piece]
                if score is not None:
                    arriving[stop].append(alpha + score)
        terms = arriving[size]
        most = max(terms)
        return most + math.log(sum([math.exp(t - most) for t in terms]))


def _score_words(lattice) -> object:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = lattice.value
        for batch in batches:
            words, counts = batch.column("word").to_pylist(), batch.column("count").to_pylist()
            found = [known.word(word, count) for word, count in zip(words, counts, strict=True)]
            yield pa.record_batch([*batch.columns, pa.array(found, pa.float64())], names=["word", "count", "log_p"])

    return run


def _score_documents(words: pd.DataFrame, docs: pd.DataFrame) -> pd.DataFrame:
    """Sums over the tokens of each document of a block."""
    size = int(words["place"].max()) + 1 if len(words) else 0
    count, log_p = np.zeros(size, dtype=np.int64), np.zeros(size)
    place = words["place"].to_numpy()
    count[place], log_p[place] = words["count"].to_numpy(), words["log_p"].to_numpy()
    log_count = np.log10(count + ADDED)
    rows = []
    for tokens in docs["tokens"]:
        held = np.frombuffer(zlib.decompress(tokens), dtype="<i4")
        rows.append((len(held), int((count[held] > 0).sum()), log_count[held].sum(), log_p[held].sum()))
    columns = list(zip(*rows, strict=True)) or [[]] * 4
    out = docs[["doc_id", "is_learned"]].reset_index(drop=True)
    for name, values in zip(("n_words", "n_known", "log_counts", "log_p"), columns, strict=True):
        out[name] = values
    return out


def score(docs: DataFrame, learned: Column, model: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Token counts, base score and lattice score (log10) of every document.

    ``learned`` is true for the documents to learn from; ``model`` is the path of the
    tokenizer. Gives (doc_id, is_learned, n_tokens, n_known, train_tokens, base_score, score).
    """
    spark = docs.sparkSession
    fed = docs.select(F.col("doc_id").cast("bigint"), F.coalesce(learned, F.lit(False)), "text")
    blocks = stored(fed.mapInArrow(_in_blocks(block_bytes), _BLOCKS), "blocks")
    listed = blocks.where("word is not null").select("block", "place", "word", "learned")
    held = blocks.where("tokens is not null").select(F.col("block").alias("home"), "doc_id", "is_learned", "tokens")
    counts = stored(listed.groupBy("word").agg(F.sum("learned").alias("count")), "word-counts")
    ends = held.where("is_learned").count()
    distinct, total, once = (
        counts.where("count > 0")
        .agg(F.count("word"), F.coalesce(F.sum("count"), F.lit(0)), F.count_if(F.col("count") == 1))
        .first()
    )
    n, v = total + ends, distinct + (1 if ends else 0)

    seen = counts.where("count > 0").mapInArrow(_count_pieces(model), "piece string, times bigint")
    # At most the vocabulary reaches the driver.
    times = dict(seen.groupBy("piece").agg(F.sum("times")).collect())
    lattice = Lattice(*vocabulary(model), times, n, once, ends)
    shared = spark.sparkContext.broadcast(lattice)
    scored = counts.mapInArrow(_score_words(shared), "word string, count bigint, log_p double")
    back = listed.select("block", "place", "word").join(scored, "word").select("block", "place", "count", "log_p")
    sums = (
        back.groupBy("block")
        .cogroup(held.groupBy("home"))
        .applyInPandas(
            _score_documents,
            "doc_id bigint, is_learned boolean, n_words bigint, n_known bigint, log_counts double, log_p double",
        )
    )
    tokens = F.col("n_words") + 1
    return sums.select(
        "doc_id",
        "is_learned",
        tokens.alias("n_tokens"),
        (F.col("n_known") + (1 if ends else 0)).cast("bigint").alias("n_known"),
        F.lit(n).cast("bigint").alias("train_tokens"),
        (F.col("log_counts") + math.log10(ends + ADDED) - tokens * math.log10(n + ADDED * (v + 1))).alias("base_score"),
        ((F.col("log_p") + lattice.end) / math.log(10.0)).alias("score"),
    )
