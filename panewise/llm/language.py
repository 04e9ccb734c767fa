"""Language identification in two steps: a family first, then a language within it.

Texts become shares of hashed character 1- to 3-grams. Families are not listed anywhere: the
mean profiles of the learned languages are joined, closest first, until the next join would
be wider than usual. One-versus-rest linear support vector machines choose the family;
one-versus-one machines then separate the languages of that family by votes.

Learning rows are a bounded sample per language, drawn by hash from all rows that have a text
with a letter, a language and a place in the learning fold; prediction sees nothing but the
text. Null texts and texts without a letter are ``und`` with score 0, and so is everything
when nothing could be learned. Rows without a ``doc_id`` are predicted but never learned from.
Repeated rows each get a row; an empty table gives none; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panewise.llm.tables import drawn

UNKNOWN = "und"
WIDTH = 4096
#: Most learning rows per language and most languages; both bound what reaches the driver.
LEARNED_ROWS = 300
LANGUAGES = 200
LEARNED_CHARS = 20_000  # longer texts are not drawn for learning; prediction takes whole texts
BLOCK = 1 << 18

_FOLDED = np.arange(0x250, dtype=np.uint32)
for _c in range(0x250):
    _low = chr(_c).lower()
    _FOLDED[_c] = ord(_low) if len(_low) == 1 and chr(_c).isalpha() else (_c if chr(_c).isalpha() else 32)


def profile(text: str, width: int = WIDTH) -> np.ndarray | None:
    """Square roots of the shares of hashed character 1- to 3-grams; None without a letter."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    total = np.zeros(width, dtype=np.int64)
    letters = False
    for at in range(0, len(points), BLOCK):
        # Blocks overlap by the reach of a 3-gram; every gram is counted where it ends.
        block = points[max(0, at - 2) : at + BLOCK]
        small = block < 0x250
        folded = np.where(small, _FOLDED[np.where(small, block, 0)], block)
        letters = letters or bool((small & (folded != 32)).any()) or any(chr(c).isalpha() for c in set(block[~small].tolist()))
        lead = len(block) - len(points[at : at + BLOCK])
        one = folded * np.uint32(2654435761)
        total += np.bincount((one[lead:] >> np.uint32(20)) % width, minlength=width)
        two = (one[:-1] * np.uint32(40503) + one[1:]) * np.uint32(2246822519)
        total += np.bincount((two[max(lead - 1, 0) :] >> np.uint32(20)) % width, minlength=width)
        three = (two[:-1] * np.uint32(40503) + one[2:]) * np.uint32(3266489917)
        total += np.bincount((three[max(lead - 2, 0) :] >> np.uint32(20)) % width, minlength=width)
    if not letters:
        return None
    return np.sqrt(total / total.sum())


def linear_svm(rows: np.ndarray, positive: np.ndarray, rounds: int = 150, penalty: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear support vector machine: squared hinge loss, accelerated gradient steps."""
    sign = np.where(positive, 1.0, -1.0)
    share = np.where(positive, 0.5 / max(positive.sum(), 1), 0.5 / max((~positive).sum(), 1))
    data = np.concatenate([rows, np.ones((len(rows), 1))], axis=1)
    weights, ahead, pace = np.zeros(data.shape[1]), np.zeros(data.shape[1]), 1.0
    step = 1.0 / (2.0 * 2.0 + penalty)  # rows have length 1, and 1 more for the bias
    for _ in range(rounds):
        margin = np.maximum(1.0 - sign * (data @ ahead), 0.0)
        slope = penalty * ahead - 2.0 * (data.T @ (share * sign * margin))
        new = ahead - step * slope
        quicker = (1.0 + np.sqrt(1.0 + 4.0 * pace * pace)) / 2.0
        ahead = new + (pace - 1.0) / quicker * (new - weights)
        weights, pace = new, quicker
    return weights[:-1], float(weights[-1])


def families(means: np.ndarray) -> list[list[int]]:
    """Closely related profiles: single-link joins no wider than the mean distance to the nearest two."""
    count = len(means)
    if count < 3:
        return [list(range(count))]
    apart = np.linalg.norm(means[:, None] - means[None, :], axis=2)
    np.fill_diagonal(apart, np.inf)
    limit = np.sort(apart, axis=1)[:, 0].mean() * 1.1
    family = list(range(count))
    for a, b in sorted(((a, b) for a in range(count) for b in range(a)), key=lambda ab: apart[ab]):
        if apart[a, b] <= limit:
            old, new = family[a], family[b]
            family = [new if f == old else f for f in family]
    return [[k for k in range(count) if family[k] == f] for f in dict.fromkeys(family)]


@dataclass(frozen=True)
class Identifier:
    languages: list[str]
    groups: list[list[int]]
    family: list[tuple[np.ndarray, float]]  # one machine per family
    pairs: dict[tuple[int, int], tuple[np.ndarray, float]]  # above zero: the first language

    def predict(self, text: str | None) -> tuple[str, float]:
        row = profile(text) if text else None
        if row is None or not self.languages:
            return UNKNOWN, 0.0
        chosen, sure = 0, 1.0
        if len(self.groups) > 1:
            margins = np.array([weights @ row + bias for weights, bias in self.family])
            order = np.argsort(-margins, kind="stable")
            chosen = int(order[0])
            sure = 1.0 / (1.0 + np.exp(-2.0 * (margins[order[0]] - margins[order[1]])))
        members = self.groups[chosen]
        votes = dict.fromkeys(members, 0.0)
        for a in members:
            for b in members:
                if a < b:
                    weights, bias = self.pairs[a, b]
                    share = 1.0 / (1.0 + np.exp(-4.0 * (weights @ row + bias)))
                    votes[a] += share
                    votes[b] += 1.0 - share
        best = max(members, key=lambda k: (votes[k], -k))
        within = votes[best] / (len(members) - 1) if len(members) > 1 else 1.0
        return self.languages[best], float(min(1.0, max(0.0, sure * within)))


def learn(texts: list[str], langs: list[str]) -> Identifier:
    held = [(row, lang) for text, lang in zip(texts, langs, strict=True) if (row := profile(text)) is not None]
    names = sorted({lang for _, lang in held})
    if not names:
        return Identifier([], [], [], {})
    rows = np.array([row for row, _ in held])
    label = np.array([names.index(lang) for _, lang in held])
    means = np.array([rows[label == k].mean(axis=0) for k in range(len(names))])
    groups = families(means)
    family = []
    if len(groups) > 1:
        family = [linear_svm(rows, np.isin(label, members)) for members in groups]
    pairs = {}
    for members in groups:
        for a in members:
            for b in members:
                if a < b:
                    own = (label == a) | (label == b)
                    pairs[a, b] = linear_svm(rows[own], label[own] == a)
    return Identifier(names, groups, family, pairs)


def learning_rows(docs: DataFrame, fold: Column, most: int = LEARNED_ROWS) -> DataFrame:
    """(lang, text): about ``most`` rows per language, drawn by hash from those where ``fold`` holds."""
    named = docs.select("doc_id", "lang", "text").where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.coalesce(fold, F.lit(False)))
    named = named.where((F.length("text") <= LEARNED_CHARS) & (F.length("text") > 0))
    counts = named.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES)
    shares = counts.select("lang", F.least(F.lit(1.0), most / F.col("n")).alias("share"))
    # At most LANGUAGES rows are broadcast.
    return named.join(F.broadcast(shares), "lang").where(drawn(F.col("share"), "doc_id")).select("lang", "text")


def identify(docs: DataFrame, fold: Column, most: int = LEARNED_ROWS) -> DataFrame:
    """(doc_id, lang_pred, score) for every row of ``docs``; learns from rows where ``fold`` holds."""
    learned = learning_rows(docs, fold, most).toPandas().sort_values(["lang", "text"])
    model = learn(learned["text"].tolist(), learned["lang"].tolist())
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            found = [known.predict(text.as_py()) for text in batch.column(1)]
            columns = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.record_batch([batch.column(0), *columns], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        run, "doc_id bigint, lang_pred string, score double"
    )
