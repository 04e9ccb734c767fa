"""Quality rules: an isolation forest over rule statistics of whole documents.

Counts per document are exact. An isolation forest splits at random: the values that it splits at
come from small subsamples, which the method is defined by, drawn by hash from all documents. How
long the paths of a tree are is then learned from all documents, by counting those that end at each
leaf; a document that the splits set apart after few steps is unlike the rest. The score from which
a document counts as an outlier is calibrated on all labelled rows: of all thresholds that keep the
stated share of good rows, the one that finds the most bad ones for the good ones it loses.

Null texts have no words. Documents without words, or that break a base rule, are not kept.
Rows without a ``doc_id``, repeated rows and further columns change nothing: every row is judged
by its own text. Without good labelled rows nothing but the base rules rejects; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panewise.llm.tables import drawn, stored
from panewise.llm.words import Words, chain, cut, groups
from panewise.operators.numbering import sum_before

LEAST_WORDS = 50
MOST_REPEATED = 50  # per cent of the words
SYMBOLS = b"#*$%&|<>"

#: The forest: documents whose values are split at, in all and by each tree.
TREES = 100
TREE_ROWS = 256
FOREST_ROWS = 20_000
KEPT_GOOD = 0.99
BINS = 4096  # of scores between 0 and 1, summed up one by one

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_EXTRA = ["n_upper", "n_marks", "n_lines", "n_distinct", "longest_run"]
_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))
_UPPER = (np.arange(256) >= 65) & (np.arange(256) <= 90)
_MARK = np.isin(np.arange(256), list(b"!?;:=_~^\"'()[]{}/\\"))


def _per_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between neighbouring bounds."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _grouped(doc: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, new): the sort by (doc, value), kept in row order, and where a new pair begins in it."""
    order = np.lexsort((value, doc))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (doc[order][1:] != doc[order][:-1]) | (value[order][1:] != value[order][:-1])
    return order, new


def _repeated(doc: np.ndarray, value: np.ndarray) -> np.ndarray:
    """True where a (doc, value) pair occurs twice or more."""
    order, new = _grouped(doc, value)
    single = new & np.concatenate([new[1:], [True]])
    out = np.zeros(len(doc), dtype=bool)
    out[order] = ~single
    return out


def _later(doc: np.ndarray, value: np.ndarray) -> np.ndarray:
    """True where a (doc, value) pair has occurred before."""
    order, new = _grouped(doc, value)
    out = np.zeros(len(doc), dtype=bool)
    out[order] = ~new
    return out


def _duplicate_lines(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Per text: lines with a word that equal an earlier line, byte by byte, and lines with a word."""
    data, texts = words.data, len(words.first) - 1
    ends = np.flatnonzero(data == 10)
    starts = np.concatenate([[0], ends[:-1] + 1])
    has_word = np.searchsorted(words.starts, starts) < np.searchsorted(words.starts, ends)
    starts, ends = starts[has_word], ends[has_word]
    raw = data.tobytes()
    doc = np.searchsorted(words.offsets, starts, side="right") - 1
    lines = [(d, raw[a:b]) for d, a, b in zip(doc.tolist(), starts.tolist(), ends.tolist(), strict=True)]
    seen: set[tuple[int, bytes]] = set()
    again = np.zeros(len(lines), dtype=bool)
    for k, line in enumerate(lines):
        if line in seen:
            again[k] = True
        else:
            seen.add(line)
    return np.bincount(doc[again], minlength=texts), np.bincount(doc, minlength=texts)


def statistics(texts: list[bytes]) -> dict[str, np.ndarray]:
    """Rule statistics of a group of texts."""
    words = cut(texts)
    doc, hashes, texts_n = words.doc, words.hashes(), len(texts)
    n_words = np.diff(words.first)
    lead = (words.data & 0xC0) != 0x80  # first byte of a code point
    white = np.isin(words.data, [9, 10, 11, 12, 13, 32])
    out = {"n_words": n_words, "word_chars": _per_text(lead & ~white, words.offsets)}
    out["n_symbols"] = _per_text(_SYMBOL[words.data], words.offsets)
    out["n_dup_lines"], out["n_lines"] = _duplicate_lines(words)
    covered = np.zeros(len(doc), dtype=bool)
    windows = chain(hashes, 3)
    inside = np.flatnonzero(doc[2:] == doc[:-2]) if len(doc) > 2 else np.zeros(0, dtype=np.int64)
    twice = inside[_repeated(doc[inside], windows[inside])] if len(inside) else inside
    for k in range(3):
        covered[twice + k] = True
    out["n_repeat_words"] = np.bincount(doc[covered], minlength=texts_n)
    out["n_upper"] = _per_text(_UPPER[words.data], words.offsets)
    out["n_marks"] = _per_text(_MARK[words.data], words.offsets)
    later = _later(doc, hashes)
    out["n_distinct"] = n_words - np.bincount(doc[later], minlength=texts_n)
    same = np.concatenate([[False], (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])]) if len(doc) else doc > 0
    out["longest_run"] = np.bincount(doc[same], minlength=texts_n)
    return out


_STATISTICS = "doc_id bigint, " + ", ".join(f"{name} bigint" for name in COUNTS + _EXTRA)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1).to_pylist()
        for first, held in groups(texts):
            found = statistics(held)
            columns = [pa.array(found[name].astype(np.int64)) for name in COUNTS + _EXTRA]
            yield pa.record_batch([ids.slice(first, len(held)), *columns], names=["doc_id", *COUNTS, *_EXTRA])


def rule_statistics(docs: DataFrame) -> DataFrame:
    """One row per document: the counts of the base rules, and those that only the forest looks at."""
    counted = docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(_count, _STATISTICS)
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


def features(counts: dict[str, np.ndarray]) -> np.ndarray:
    """What the splits are made on: shares, so that long documents are not outliers as such."""
    c = {name: np.asarray(value, dtype=np.float64) for name, value in counts.items()}
    words, chars, lines = np.maximum(c["n_words"], 1), np.maximum(c["word_chars"], 1), np.maximum(c["n_lines"], 1)
    return np.stack(
        [
            c["word_chars"] / words,
            c["n_symbols"] / words,
            c["n_dup_lines"] / lines,
            c["n_repeat_words"] / words,
            c["n_upper"] / chars,
            c["n_marks"] / chars,
            c["n_distinct"] / words ** 0.9,
            c["longest_run"] / words,
        ],
        axis=1,
    )


@dataclass(frozen=True)
class Forest:
    """Isolation trees as arrays (tree, node): children of node k are 2k + 1 and 2k + 2."""

    feature: np.ndarray  # -1 at a leaf
    split: np.ndarray
    length: np.ndarray  # path length that a document has when it ends at this node
    unit: float  # expected path length in a tree of this size

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Anomaly scores between 0 and 1; 0.5 is usual."""
        total = np.zeros(len(rows))
        for length, node in zip(self.length, self.leaves(rows), strict=True):
            total += length[node]
        return 2.0 ** (-total / len(self.feature) / self.unit)

    def leaves(self, rows: np.ndarray) -> Iterator[np.ndarray]:
        """For each tree, the nodes at which the rows end."""
        depth = int(np.log2(self.feature.shape[1] + 1)) - 1
        every = np.arange(len(rows))
        for feature, split in zip(self.feature, self.split, strict=True):
            node = np.zeros(len(rows), dtype=np.int64)
            for _ in range(depth):
                chosen = feature[node]
                right = rows[every, np.maximum(chosen, 0)] >= split[node]
                node = np.where(chosen < 0, node, 2 * node + 1 + right)
            yield node

    def weighed(self, ended: np.ndarray) -> Forest:
        """The same splits, with path lengths by the rows of a whole table that ``ended`` at each (tree, node)."""
        rows = int(ended[0].sum())
        size = min(TREE_ROWS, rows)
        level = np.floor(np.log2(np.arange(self.feature.shape[1]) + 1))
        whole = np.arange(size + 1)
        # Of a subsample, a leaf would hold this many rows.
        share = np.interp(ended * (size / max(rows, 1)), whole, [_expected(int(n)) for n in whole])
        return replace(self, length=np.where(self.feature < 0, level + share, 0.0), unit=max(_expected(size), 1e-9))


def _expected(count: int) -> float:
    """Mean path length of an unsuccessful search among ``count`` rows."""
    if count < 2:
        return 0.0
    return 2.0 * (np.log(count - 1) + np.euler_gamma) - 2.0 * (count - 1) / count if count > 2 else 1.0


def grow(rows: np.ndarray, trees: int = TREES, tree_rows: int = TREE_ROWS, seed: int = 9) -> Forest:
    rng = np.random.default_rng(seed)
    size = min(tree_rows, len(rows))
    depth = max(1, int(np.ceil(np.log2(max(size, 2)))))
    nodes = 2 ** (depth + 1) - 1
    feature = np.full((trees, nodes), -1)
    split, length = np.zeros((trees, nodes)), np.zeros((trees, nodes))
    for tree in range(trees):
        open_nodes = [(0, 0, rng.choice(len(rows), size, replace=False))]
        while open_nodes:
            node, level, members = open_nodes.pop()
            values = rows[members]
            low, high = values.min(axis=0), values.max(axis=0)
            varied = np.flatnonzero(high > low)
            if level == depth or len(members) < 2 or not len(varied):
                length[tree, node] = level + _expected(len(members))
                continue
            chosen = int(rng.choice(varied))
            at = rng.uniform(low[chosen], high[chosen])
            right = values[:, chosen] >= at
            feature[tree, node], split[tree, node] = chosen, at
            open_nodes.append((2 * node + 1, level + 1, members[~right]))
            open_nodes.append((2 * node + 2, level + 1, members[right]))
    return Forest(feature, split, length, max(_expected(size), 1e-9))


def calibrate(scores: np.ndarray, good: np.ndarray, kept_good: float = KEPT_GOOD) -> float:
    """The score from which documents are rejected; above every score if there are no good rows."""
    if not good.any():
        return 2.0
    # From the highest score down: rows from each different score on, good ones lost and bad ones found.
    order = np.argsort(-scores, kind="stable")
    at, good = scores[order], good[order]
    last = np.append(at[1:] != at[:-1], True)
    lost = np.cumsum(good)[last] / good.sum()
    found = np.cumsum(~good)[last] / max(int((~good).sum()), 1)
    gain = np.where(1 - lost >= kept_good, found - lost, 0.0)
    # Of equal gains the least score, as it rejects most.
    best = len(gain) - 1 - int(np.argmax(gain[::-1]))
    return float(at[last][best]) if gain[best] > 0 else 2.0


def _drawn(df: DataFrame, count: int, most: int, *key: str) -> DataFrame:
    """About ``most`` of ``count`` rows, drawn by a hash of the key."""
    # The limit only bounds what equal rows could add to the share.
    return df.where(drawn(min(1.0, most / max(count, 1)), *key)).limit(2 * most)


def _ended(rows: DataFrame, forest: Forest, names: list[str]) -> np.ndarray:
    """How many of the rows end at each (tree, node)."""
    trees, nodes = forest.feature.shape

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((trees, nodes), dtype=np.int64)
        for batch in batches:
            found = features({n: batch.column(n).to_numpy() for n in names})
            for tree, ends in enumerate(forest.leaves(found)):
                total[tree] += np.bincount(ends, minlength=nodes)
        place = np.flatnonzero(total)
        yield pa.record_batch([pa.array(place), pa.array(total.ravel()[place])], names=["place", "rows"])

    counted = rows.select(names).mapInArrow(count, "place bigint, rows bigint").groupBy("place").agg(F.sum("rows").alias("rows"))
    ended = np.zeros(trees * nodes, dtype=np.int64)
    for row in counted.collect():  # bounded by the nodes of the forest
        ended[row["place"]] = row["rows"]
    return ended.reshape(trees, nodes)


def threshold(scored: DataFrame, kept_good: float = KEPT_GOOD) -> float:
    """``calibrate`` over a table (anomaly, good, bad) of any size: the rows of each kind by score.

    Scores are summed up from the highest down, inside bins and over the bins before.
    """
    bins = F.least(F.floor(F.col("anomaly") * BINS), F.lit(BINS - 1)).alias("bin")
    by_score = scored.groupBy(bins, "anomaly").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    by_score = stored(by_score, "scores")
    per_bin = by_score.groupBy("bin").agg(F.sum("good").alias("all_good"), F.sum("bad").alias("all_bad"))
    every, down = Window.partitionBy(F.lit(0)), Window.partitionBy(F.lit(0)).orderBy(F.desc("bin"))
    starts = per_bin.select(
        "bin",
        *[sum_before(f"all_{kind}", down).alias(f"{kind}_before") for kind in ("good", "bad")],
        *[F.sum(f"all_{kind}").over(every).alias(f"{kind}_rows") for kind in ("good", "bad")],
    )
    so_far = Window.partitionBy("bin").orderBy(F.desc("anomaly")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lost, found = [
        (F.col(f"{kind}_before") + F.sum(kind).over(so_far)) / F.greatest(f"{kind}_rows", F.lit(1)) for kind in ("good", "bad")
    ]
    gains = by_score.join(F.broadcast(starts), "bin").select("anomaly", "good_rows", lost.alias("lost"), found.alias("found"))
    gains = gains.where((F.col("good_rows") > 0) & (1 - F.col("lost") >= kept_good) & (F.col("found") > F.col("lost")))
    # Of equal gains the least score, as it rejects most.
    best = gains.agg(F.max(F.struct((F.col("found") - F.col("lost")).alias("gain"), (-F.col("anomaly")).alias("less")))).first()[0]
    return 2.0 if best is None else -best["less"]


def isolation_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rule statistics, ``base_failed``, ``anomaly`` (the forest's score) and ``kept`` for every document.

    ``labels`` has (doc_id, quality): 1 for good rows, 0 for bad ones.
    """
    counted = stored(rule_statistics(docs), "rule-statistics")
    names = [*COUNTS, *_EXTRA]
    passing = counted.where(~F.col("base_failed"))
    sample = _drawn(passing, passing.count(), FOREST_ROWS, "doc_id", *names).select(names).toPandas()
    if not len(sample):
        return counted.withColumns({"anomaly": F.lit(None).cast("double"), "kept": ~F.col("base_failed")})
    split = grow(features({n: sample[n].to_numpy() for n in names}))
    forest = split.weighed(_ended(passing, split, names))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = forest.scores(features({n: batch.column(n).to_numpy() for n in names}))
            yield pa.record_batch([*batch.columns, pa.array(score)], names=[*batch.schema.names, "anomaly"])

    judged = stored(counted.mapInArrow(judge, f"{_STATISTICS}, base_failed boolean, anomaly double"), "anomaly")
    # Repeated labels are added up first, so that no number has many rows on both sides.
    marked = labels.where("quality is not null").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.count_if(F.col("quality") == 1).alias("good"), F.count_if(F.col("quality") != 1).alias("bad")
    )
    known = judged.where(~F.col("base_failed")).select("doc_id", "anomaly").join(marked, "doc_id")
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("anomaly") < threshold(known)))
