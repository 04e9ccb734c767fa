"""Benchmark decontamination: a prefix-filtered set join of windows against documents.

A window is a run of ``size`` consecutive words of a benchmark item, or all words of a shorter
item. Its words are ordered by rarity in the documents. To contain a window, a document must
contain all of its words, so the necessary prefix is a single one, the rarest; a window whose
rarest word occurs in no document is out at once. Documents meet windows on that word only.
The length and the place of the word in the window bound where the window may start, and the
words from there on are compared one by one.

Documents are read where they lie: the windows come to them, in blocks of at most
``BLOCK_WINDOWS``, which bounds what is broadcast. Only what matched is shuffled.

Null texts have no words. Items without words or without an ``item_id`` match nothing; a
repeated item counts once. Repeated documents each get their row, and so do rows without a
``doc_id``; the key of a document is its id and a hash of its text. Empty tables give no rows,
or rows without hits; further columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panewise.llm.tables import stored

SIZE = 10
BLOCK_WINDOWS = 1 << 18  # some 30 MB of windows of ten words

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Runs of digits, letters and characters beyond ASCII, A-Z in lower case; none for null."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lowered, SEPARATORS), "")


def item_windows(benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """(item_id, window): the distinct windows of each item, as arrays of words."""
    items = benchmark.where("item_id is not null").select("item_id", words_of(F.col("text")).alias("words"))
    count = F.size("words")
    runs = F.transform(
        F.sequence(F.lit(0), F.greatest(count - size, F.lit(0))),
        lambda start: F.slice(F.col("words"), start + 1, size),
    )
    return items.where(count > 0).select("item_id", F.explode(runs).alias("window")).distinct()


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words_of(F.col("text")).alias("words"))


def necessary_words(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """(window, word, place): the rarest word of each window that can occur at all, and its place."""
    placed = windows.select("window", F.posexplode("window").alias("place", "word"))
    # The vocabulary of a block of windows is bounded by the block.
    vocabulary = F.broadcast(placed.select("word").distinct())
    seen = docs.select(F.explode(words_of(F.col("text"))).alias("word")).join(vocabulary, "word")
    frequency = seen.groupBy("word").agg(F.count(F.lit(1)).alias("frequency"))
    ranked = placed.join(frequency, "word", "left").withColumn("frequency", F.coalesce("frequency", F.lit(0)))
    rarest = ranked.groupBy("window").agg(F.min(F.struct("frequency", "word", "place")).alias("rarest"))
    return rarest.where("rarest.frequency > 0").select("window", "rarest.word", "rarest.place")


def _occurrences(docs: DataFrame, necessary: DataFrame) -> DataFrame:
    tokens = _keyed(docs).select("doc_id", "text_hash", "words", F.posexplode("words").alias("at", "word"))
    start, length = F.col("at") - F.col("place"), F.size("window")
    within = (start >= 0) & (start + length <= F.size("words"))
    met = tokens.join(F.broadcast(necessary), "word").where(within)
    return met.where(F.slice("words", start + 1, length) == F.col("window")).select(
        "doc_id", "text_hash", start.alias("start"), (start + length).alias("end"), "window"
    )


def occurrences(docs: DataFrame, windows: DataFrame, block: int = BLOCK_WINDOWS) -> DataFrame:
    """(doc_id, text_hash, start, end, window): every place where a distinct window occurs."""
    distinct = stored(windows.select("window").distinct(), "windows")
    blocks = max(1, -(-distinct.count() // block))
    found = []
    for number in range(blocks):
        own = distinct.where(F.pmod(F.xxhash64("window"), F.lit(blocks)) == number)
        necessary = stored(necessary_words(docs, own), "necessary-words")
        found.append(_occurrences(docs, necessary))
    return reduce(DataFrame.unionByName, found)


def covered(spans: Column) -> Column:
    """Number of words inside sorted, possibly overlapping spans (start, end)."""
    start = F.struct(F.lit(0).cast("bigint").alias("sum"), F.lit(0).alias("until"))
    return F.aggregate(
        spans,
        start,
        lambda held, span: F.struct(
            (held["sum"] + F.greatest(span["end"] - F.greatest(span["start"], held["until"]), F.lit(0))).alias("sum"),
            F.greatest(span["end"], held["until"]).alias("until"),
        ),
        lambda held: held["sum"],
    )


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, block: int = BLOCK_WINDOWS) -> DataFrame:
    """(doc_id, text_hash, n_words, n_hit, item_ids) for every row of ``docs``; ``item_ids`` are sorted strings."""
    windows = stored(item_windows(benchmark, size), "item-windows")
    found = stored(occurrences(docs, windows, block), "occurrences")
    key = ["doc_id", "text_hash"]
    spans = found.groupBy(*key).agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("spans"))
    hits = spans.select(*key, covered(F.col("spans")).alias("n_hit"))
    ids = found.select(*key, "window").distinct().join(windows, "window")
    ids = ids.groupBy(*key).agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids"))
    both = hits.alias("h").join(ids.alias("i"), (F.col("h.doc_id").eqNullSafe(F.col("i.doc_id"))) & (F.col("h.text_hash") == F.col("i.text_hash")))
    both = both.select("h.doc_id", "h.text_hash", "n_hit", "item_ids").alias("f")
    base = _keyed(docs).select(*key, F.size("words").cast("bigint").alias("n_words")).alias("d")
    same = (F.col("d.doc_id").eqNullSafe(F.col("f.doc_id"))) & (F.col("d.text_hash") == F.col("f.text_hash"))
    return base.join(both, same, "left").select(
        "d.doc_id",
        "d.text_hash",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, block: int = BLOCK_WINDOWS) -> DataFrame:
    """The rows of ``docs`` in which no window of the benchmark occurs, with all their columns."""
    found = stored(occurrences(docs, item_windows(benchmark, size), block), "occurrences")
    hit = found.select(F.col("doc_id").alias("_hit_id"), F.col("text_hash").alias("_hit_hash")).distinct()
    same = docs["doc_id"].eqNullSafe(F.col("_hit_id")) & (F.xxhash64(docs["text"]) == F.col("_hit_hash"))
    # Hits grow with the documents: both sides are shuffled at every size.
    return docs.join(hit.hint("merge"), same, "left_anti")
