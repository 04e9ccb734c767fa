"""Substring dedup with suffix automata of reference shards.

A passage goes when its words also start in a document with a smaller ``doc_id``, for every
run of ``length`` words. Every document is a reference for the later ones, so automata of all
text cannot go to all tasks. They are kept to what can match, in shards:

1. Every window of ``length`` words is named by an anchor, the least hash among its ``GRAM``-word
   runs; equal windows have equal anchors. Neighbouring windows with one anchor are a region.
   About one word in sixteen begins a region.
2. Only anchors that occur in two documents or more go on. Equal regions are taken together
   before anything is shuffled by anchor, so copies of a passage cost a row per task.
3. An anchor with more than ``CROWDED`` different regions may be a short notice in front of as many
   different texts, which share no window. Its regions are cut to the runs of windows whose
   hash another of them holds too; equal runs are taken together and go on in their place.
   All other windows of such a region are in no other one.
4. The different regions of an anchor are its reference shard, or several shards when there
   are many. A suffix automaton is built per shard; each state holds the least ``doc_id`` of
   its strings. All regions of the anchor stream through it for matching statistics: a match
   of ``length`` words ends wherever the state for that length is known, and it belongs to
   an earlier document if the state's ``doc_id`` is smaller. A region that has its anchor to
   itself is its own automaton, and is not sent anywhere.
5. Matched windows go back to their documents, where their union, the maximal spans, is removed.

Null and short texts lose nothing. Rows without a ``doc_id`` have no order: they lose nothing and
are no reference. Rows that share a ``doc_id`` are not smaller than one another; each gets its
row, by its own text. An empty table gives no rows; further columns are ignored. Words are
compared by 64-bit hashes to find candidates, and by their bytes in the automata; regions
are taken as equal when their anchor and a second 64-bit hash are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panewise.llm.tables import stored
from panewise.llm.words import chain, cut, encode, groups, mix

LENGTH = 50
GRAM = 20
SHARD_REGIONS = 4096
BUNDLE_REGIONS = 1024
CROWDED = 64

_OCCURRENCES = "anchor bigint, region bigint, doc_id bigint, text_hash bigint, first int, windows int"
_KEY = ["doc_id", "text_hash"]


def _least_places(values: np.ndarray, reach: int) -> np.ndarray:
    """Place of the leftmost least value in every run of ``reach`` values."""
    best, place, size = values, np.arange(len(values)), 1
    while size < reach:
        step = min(size, reach - size)
        count = len(best) - step
        right = best[step:] < best[:count]
        place = np.where(right, place[step:], place[:count])
        best = np.where(right, best[step:], best[:count])
        size += step
    return place


def regions(texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Regions of a group of texts: (text number, anchor, region hash, first window, windows)."""
    words = cut(texts)
    doc, hashes = words.doc, words.hashes()
    none = np.zeros(0, dtype=np.int64)
    if len(hashes) < length:
        return none, none, none, none, none
    grams = chain(hashes, gram)
    place = _least_places(grams, length - gram + 1)
    inside = doc[length - 1 :] == doc[: len(doc) - length + 1]
    starts = np.flatnonzero(inside)
    if not len(starts):
        return none, none, none, none, none
    place = place[starts]
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (place[1:] != place[:-1]) | (doc[starts[1:]] != doc[starts[:-1]])
    begin = np.flatnonzero(new)
    count = np.diff(np.concatenate([begin, [len(starts)]]))
    first, anchor = starts[begin], grams[place[begin]]
    # The hash of a region runs over the hashes of its windows, which overlap.
    windows = mix(chain(hashes, length) ^ np.uint64(0x5851F42D4C957F2D))[starts]
    turn = (np.arange(len(starts)) - np.repeat(begin, count)).astype(np.uint64)
    region = np.add.reduceat(mix(windows + turn), begin)
    number = doc[first]
    return number, anchor.view(np.int64), region.view(np.int64), first - words.first[number], count


def _regions(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for at, held in groups(batch.column(2).to_pylist()):
                number, anchor, region, first, count = regions(held, length, gram)
                yield pa.record_batch(
                    [
                        pa.array(anchor),
                        pa.array(region),
                        pa.array(ids[at + number]),
                        pa.array(hashes[at + number]),
                        pa.array(first.astype(np.int32)),
                        pa.array(count.astype(np.int32)),
                    ],
                    names=[c.split()[0] for c in _OCCURRENCES.split(", ")],
                )

    return run


class Automaton:
    """A suffix automaton of several word sequences; every state holds the least label of its strings."""

    def __init__(self) -> None:
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.label: list[int | None] = [None]

    def _state(self, length: int, link: int, following: dict[bytes, int]) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        self.label.append(None)
        return len(self.next) - 1

    def _split(self, state: int, word: bytes, target: int) -> int:
        """A copy of ``target`` for the strings that also follow ``state``."""
        copy = self._state(self.length[state] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = copy
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, word: bytes) -> int:
        target = self.next[last].get(word)
        if target is not None:
            return target if self.length[target] == self.length[last] + 1 else self._split(last, word, target)
        new = self._state(self.length[last] + 1, 0, {})
        while last >= 0 and word not in self.next[last]:
            self.next[last][word] = new
            last = self.link[last]
        if last >= 0:
            target = self.next[last][word]
            near = self.length[target] == self.length[last] + 1
            self.link[new] = target if near else self._split(last, word, target)
        return new

    def add(self, words: list[bytes]) -> None:
        last = 0
        for word in words:
            last = self._extend(last, word)

    def name(self, words: list[bytes], label: int) -> None:
        """Note the label of an added sequence; call it when all are added."""
        state = 0
        for word in words:
            state = self.next[state][word]
            if self.label[state] is None or label < self.label[state]:
                self.label[state] = label

    def spread(self) -> None:
        """Hand labels down to all suffixes."""
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            label, link = self.label[state], self.link[state]
            if label is not None and (self.label[link] is None or label < self.label[link]):
                self.label[link] = label

    def least(self, words: list[bytes], length: int) -> list[int | None]:
        """For every run of ``length`` words: the least label of a sequence that holds it, or None."""
        found, state, matched = [], 0, 0
        for place, word in enumerate(words):
            while state and word not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if word in self.next[state]:
                state, matched = self.next[state][word], matched + 1
            if matched >= length:
                while self.length[self.link[state]] >= length:
                    state = self.link[state]
                matched = length
            if place >= length - 1:
                found.append(self.label[state] if matched == length else None)
        return found


_BODIES = "anchor bigint, region bigint, label bigint, words binary, hashes array<bigint>"
_BODY_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
_RUNS = "anchor bigint, region bigint, label bigint, words binary, first int, run bigint"
_RUN_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64()]


def _window_hashes(body: bytes, length: int) -> np.ndarray:
    return mix(chain(cut([body]).hashes(), length)).view(np.int64)


def _batch(rows: list[tuple], types: list[pa.DataType], schema: str) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(types)
    names = [c.split()[0] for c in schema.split(", ")]
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns, types, strict=True)], names=names)


def _texts(length: int):
    """Cut the words of regions out of the documents that stand for them; window hashes at crowded anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, wanted in zip(batch.column("text"), batch.column("wanted"), strict=True):
                words = encode(text.as_py()).split()
                for want in wanted.as_py():
                    body = b" ".join(words[want["first"] : want["first"] + want["windows"] + length - 1])
                    hashes = _window_hashes(body, length) if want["crowded"] else None
                    rows.append((want["anchor"], want["region"], want["label"], body, hashes))
            yield _batch(rows, _BODY_TYPES, _BODIES)

    return run


def _cut_runs(length: int):
    """Cut regions to their runs of shared windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                places, words = np.unique(row["places"]), row["words"].split()
                for part in np.split(places, np.flatnonzero(np.diff(places) > 1) + 1):
                    first, windows = int(part[0]), len(part)
                    body = b" ".join(words[first : first + windows + length - 1])
                    turn = np.arange(windows, dtype=np.uint64)
                    name = mix(_window_hashes(body, length).view(np.uint64) + turn).sum(dtype=np.uint64).view(np.int64)
                    rows.append((row["anchor"], row["region"], row["label"], body, first, int(name)))
            yield _batch(rows, _RUN_TYPES, _RUNS)

    return run


def _match(length: int):
    """Stream the regions of each anchor through the automata of its shards, for a bundle of shards."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["anchor", "shard"], kind="stable")
        bodies = [bytes(body).split() for body in frame["words"]]
        labels, reference = frame["label"].tolist(), frame["reference"].tolist()
        anchor, shard = frame["anchor"].to_numpy(), frame["shard"].to_numpy()
        new = np.flatnonzero((anchor[1:] != anchor[:-1]) | (shard[1:] != shard[:-1])) + 1
        edges = [0, *new.tolist(), len(bodies)]
        least = []
        for begin, end in zip(edges[:-1], edges[1:], strict=True):
            automaton = Automaton()
            own = [row for row in range(begin, end) if reference[row]]
            for row in own:
                automaton.add(bodies[row])
            for row in own:
                automaton.name(bodies[row], labels[row])
            automaton.spread()
            least += [automaton.least(body, length) for body in bodies[begin:end]]
        return pd.DataFrame({"anchor": frame["anchor"], "region": frame["region"], "sources": least})

    return run


def _shared_runs(bodies: DataFrame, length: int) -> DataFrame:
    """Runs of windows that two regions of a crowded anchor hold, region by region."""
    windows = bodies.select("anchor", "region", F.posexplode("hashes").alias("place", "hash"))
    # A hash that comes twice in one region is kept as well, which only leaves more to the automata.
    held = windows.groupBy("anchor", "hash").agg(F.count(F.lit(1)).alias("times")).where("times > 1")
    shared = stored(held.select("anchor", "hash"), "shared-windows")
    places = windows.join(shared, ["anchor", "hash"]).groupBy("anchor", "region").agg(F.collect_list("place").alias("places"))
    return bodies.join(places, ["anchor", "region"]).select("anchor", "region", "label", "words", "places").mapInArrow(
        _cut_runs(length), _RUNS
    )


def _matched(bodies: DataFrame, length: int, shard: int) -> DataFrame:
    """(anchor, region, sources) of the different regions of each anchor, by the automata of its shards."""
    sizes = stored(bodies.groupBy("anchor").agg(F.ceil(F.count(F.lit(1)) / shard).cast("bigint").alias("shards")), "shards")
    sized = bodies.join(sizes, "anchor")
    own = F.pmod(F.xxhash64("region"), F.col("shards"))
    sent = sized.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("shards") - 1)))
    # Shards are small as a rule; a task's call takes a bundle of them.
    bundles = max(1, bodies.count() // BUNDLE_REGIONS)
    bundle = F.pmod(F.xxhash64("anchor", "shard"), F.lit(bundles))
    found = (
        sent.withColumn("reference", F.col("shard") == own)
        .groupBy(bundle.alias("bundle"))
        .applyInPandas(_match(length), "anchor bigint, region bigint, sources array<bigint>")
    )
    least = found.groupBy("anchor", "region").agg(F.collect_list("sources").alias("lists"))
    merged = F.transform(
        F.sequence(F.lit(0), F.size(F.col("lists")[0]) - 1),
        lambda k: F.array_min(F.transform("lists", lambda held: F.get(held, k))),
    )
    return least.select("anchor", "region", merged.alias("sources"))


def sources(
    docs: DataFrame, shared: DataFrame, length: int = LENGTH, shard: int = SHARD_REGIONS, crowded: int = CROWDED
) -> DataFrame:
    """(anchor, region, place, sources): the least ``doc_id`` that holds each window of a region from a place on.

    A region may have several rows; a window counts by the least of them.
    """
    place = F.struct(*_KEY, "first", "windows")
    different = stored(shared.groupBy("anchor", "region").agg(F.min(place).alias("at")), "regions")
    sizes = different.groupBy("anchor").agg(F.count(F.lit(1)).alias("size"))
    sized = stored(different.join(sizes, "anchor"), "sized-regions")
    want = F.struct(
        "anchor", "region", F.col("at.doc_id").alias("label"), (F.col("size") > crowded).alias("crowded"), "at.first", "at.windows"
    )
    wanted = (
        sized.where("size > 1")
        .groupBy(F.col("at.doc_id").alias("doc_id"), F.col("at.text_hash").alias("text_hash"))
        .agg(F.collect_list(want).alias("wanted"))
    )
    bodies = stored(docs.join(wanted, _KEY).select("text", "wanted").mapInArrow(_texts(length), _BODIES), "region-words")
    runs = stored(_shared_runs(bodies.where("hashes is not null"), length), "shared-runs")
    different_runs = runs.groupBy("anchor", "run").agg(F.min("label").alias("label"), F.first("words").alias("words"))
    few = bodies.where("hashes is null").select("anchor", "region", "label", "words")
    # Runs and regions never share an anchor: an anchor is crowded or it is not.
    least = stored(_matched(few.unionByName(different_runs.withColumnRenamed("run", "region")), length, shard), "matched")
    by_itself = sized.where((F.col("size") == 1) | (F.col("size") > crowded)).select(
        "anchor", "region", F.lit(0).alias("place"), F.array_repeat(F.col("at.doc_id"), F.col("at.windows")).alias("sources")
    )
    of_few = least.join(few.select("anchor", "region"), ["anchor", "region"]).select("anchor", "region", F.lit(0).alias("place"), "sources")
    of_runs = runs.join(least.withColumnRenamed("region", "run"), ["anchor", "run"]).select(
        "anchor", "region", F.col("first").alias("place"), "sources"
    )
    return by_itself.unionByName(of_few).unionByName(of_runs)


def _remove(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, removed, kept = [], [], []
            for text, starts in zip(batch.column("text"), batch.column("starts"), strict=True):
                words = encode(text.as_py()).split()
                starts = starts.as_py()
                if starts:
                    edge = np.zeros(len(words) + 1, dtype=np.int64)
                    starts = np.unique(starts)
                    edge[starts] += 1
                    np.add.at(edge, starts + length, -1)
                    gone = np.cumsum(edge[:-1]) > 0
                    left = [word for word, out in zip(words, gone.tolist(), strict=True) if not out]
                else:
                    left = words
                counts.append(len(words))
                removed.append(len(words) - len(left))
                kept.append(b" ".join(left).decode("utf-8", "surrogatepass"))
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_text"],
            )

    return run


def without_repeats(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, shard: int = SHARD_REGIONS, crowded: int = CROWDED
) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text) for every document; kept words are joined by one space."""
    keyed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    cut_up = keyed.where("doc_id is not null and text is not null").mapInArrow(_regions(length, gram), _OCCURRENCES)
    occurrences = stored(cut_up, "regions-of-documents")
    ends = occurrences.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    # Written first, so that both sides of the join are plain shuffles, and a hot anchor is split.
    repeated = stored(ends.where("low < high").select("anchor"), "repeated-anchors")
    shared = stored(occurrences.join(repeated, "anchor"), "shared-regions")
    once = keyed.where("doc_id is not null and text is not null")
    known = stored(sources(once, shared, length, shard, crowded), "sources")
    starts = F.transform(
        F.filter(F.sequence(F.lit(0), F.size("sources") - 1), lambda k: F.get("sources", k) < F.col("doc_id")),
        lambda k: k + F.col("first") + F.col("place"),
    )
    gone = shared.join(known, ["anchor", "region"]).withColumn("starts", starts).where(F.size("starts") > 0)
    gone = gone.groupBy(*_KEY).agg(F.flatten(F.collect_list("starts")).alias("starts"))
    return keyed.join(gone, _KEY, "left").select("doc_id", "text", "starts").mapInArrow(
        _remove(length), "doc_id bigint, n_words bigint, n_removed bigint, kept_text string"
    )
