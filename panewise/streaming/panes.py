"""Sliding top-k over a stream with a ring of panes as state, and a result on every slide.

A window is ``length / slide`` panes. Keyed by window, state would hold a row per word for each
of them. Here the words are dealt over ``shards``; a shard keeps the open panes, with the counts of all
their words, neighbours in one row, and throws the oldest away when the last window over it has closed.
A timer on the next window to close moves the sum over the panes from window to window, one pane in
and one out, and gives out the shard's first ``k`` words of each; only those of the shards are
ranked against each other, in the micro-batch that closes the window.

One more key holds no words but the clock: it gives out a row without a word for every slide that
the watermark passes, also when nothing had arrived, so that a quiet slide has a list, an empty one.

Time moves with the rows: the watermark follows the latest of them. Where a stream may fall silent
altogether, rows without text keep it moving (``union_live`` joins in such a heartbeat). Rows count
for the windows over them that are still open, and are lost to those that have closed.
"""

from __future__ import annotations

import heapq
import json
from collections import Counter, deque
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.readwriter import DataStreamWriter
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from panewise.functions.clock import from_instant
from panewise.operators.topk import TOP_K, WORD_COUNTS, top_k_per_window
from panewise.streaming.sinks import per_batch

SHARDS = 16
CLOCK = -1
MARKS = 10_000  # rows that are given out at once
CHUNK = 64  # panes that share a row of state, as each row costs a call to the store
HELD = 16  # chunks whose counts are in memory while rows come in
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Timers need this store; logging what changed makes small commits cheap.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

Panes = dict[int, Counter]
OUTPUT = "window_start bigint, window_end bigint, word string, count bigint"  # times in ms, so that no time zone matters


@contextmanager
def timer_state(spark: SparkSession) -> Iterator[None]:
    """Start queries with the state store that keeps timers, and put the setting back."""
    before = {name: spark.conf.get(name, None) for name in STATE}
    for name, value in STATE.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def _frame(rows: list[tuple[int, str | None, int]], length: int) -> pd.DataFrame:
    """Rows (window end in ms, word, count) as a frame of ``OUTPUT``."""
    ends = pd.Series([end for end, _, _ in rows], dtype="int64")
    return pd.DataFrame(
        {
            "window_start": ends - length,
            "window_end": ends,
            "word": pd.Series([word for _, word, _ in rows], dtype=object),
            "count": pd.Series([count for _, _, count in rows], dtype="int64"),
        }
    )


def _in_order(item: tuple[str, int]) -> tuple[int, bytes]:
    return -item[1], item[0].encode("utf-8", "surrogatepass")


class PaneRing(StatefulProcessor):
    """State per shard: the open panes in chunks of neighbours (the counts of the words of each pane as
    JSON), and the end of the next window to close, for which a timer is set. Times are in ms."""

    def __init__(self, length: int, slide: int, k: int) -> None:
        self.length, self.slide, self.k = length, slide, k
        self.span = slide * CHUNK

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.chunks = handle.getMapState("chunks", "chunk bigint", "panes string")
        self.next = handle.getValueState("next", "window_end bigint")

    def close(self) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()
        first = None
        held: dict[int, Panes] = {}  # chunks that rows have just come for
        for part in rows:
            # Panes over which every window has closed are late.
            part = part[part["pane"] + self.length > passed]
            if not len(part):
                continue
            least = int(part["pane"].min())
            first = least if first is None else min(first, least)
            if key[0] == CLOCK:
                continue
            for pane, words in part.groupby("pane")["word"]:
                chunk = int(pane) // self.span
                if chunk not in held:
                    if len(held) >= HELD:
                        self._store(held)
                    held[chunk] = self._load(chunk)
                held[chunk].setdefault(int(pane), Counter()).update(words.tolist())
        self._store(held)
        if first is not None:
            end = self._first_end(first, passed)
            # The clock has started once and for all; words may come for an earlier window than awaited.
            if not self.next.exists() or (key[0] != CLOCK and end < self.next.get()[0]):
                self._wait_for(end)
        return iter(())

    def _load(self, chunk: int) -> Panes:
        known = self.chunks.getValue((chunk,))
        return {int(pane): Counter(counts) for pane, counts in json.loads(known[0]).items()} if known else {}

    def _store(self, held: dict[int, Panes]) -> None:
        for chunk, panes in held.items():
            self.chunks.updateValue((chunk,), (json.dumps(panes),))
        held.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        end, passed = expiredTimerInfo.getExpiryTimeInMs() + 1, timerValues.getCurrentWatermarkInMs()
        if not self.next.exists() or end != self.next.get()[0]:
            return  # an earlier window has come up since
        if passed < end:
            self.handle.registerTimer(end - 1)  # the watermark is inside the last millisecond of the window
        elif key[0] == CLOCK:
            yield from self._pass_slides(end, passed)
        else:
            yield from self._close_windows(end, passed)

    def _close_windows(self, end: int, passed: int) -> Iterator[pd.DataFrame]:
        """All windows that have closed: each takes in one pane and lets go of one."""
        chunks = sorted(chunk[0] for chunk in self.chunks.keys())
        ahead = (item for chunk in chunks for item in sorted(self._load(chunk).items()) if item[0] >= end - self.length)
        inside: deque[tuple[int, Counter]] = deque()  # the panes of the window, oldest first
        total: Counter = Counter()
        rows: list[tuple[int, str | None, int]] = []
        after = next(ahead, None)
        while end <= passed:
            while inside and inside[0][0] < end - self.length:
                total.subtract(inside.popleft()[1])
                total = +total  # words that are gone
            while after and after[0] < end:
                inside.append(after)
                total.update(after[1])
                after = next(ahead, None)
            if not inside:
                if not after:
                    break
                end = max(end, after[0] + self.slide)
                continue
            rows += [(end, word, count) for word, count in heapq.nsmallest(self.k, total.items(), key=_in_order)]
            if len(rows) >= MARKS:
                yield _frame(rows, self.length)
                rows = []
            end += self.slide
        if rows:
            yield _frame(rows, self.length)
        for chunk in chunks:
            open_panes: Panes = {}
            if (chunk + 1) * self.span - self.slide + self.length > passed:
                open_panes = {pane: counts for pane, counts in self._load(chunk).items() if pane + self.length > passed}
            if open_panes:
                self._store({chunk: open_panes})
                self._wait_for(self._first_end(min(open_panes), passed))
                return
            self.chunks.removeKey((chunk,))
        self.next.clear()

    def _pass_slides(self, end: int, passed: int) -> Iterator[pd.DataFrame]:
        while end <= passed:
            count = min(MARKS, (passed - end) // self.slide + 1)
            yield _frame([(end + k * self.slide, None, 0) for k in range(count)], self.length)
            end += count * self.slide
        self._wait_for(end)

    def _first_end(self, pane: int, passed: int) -> int:
        """The end of the first window over a pane that is still open."""
        return max(pane, passed // self.slide * self.slide) + self.slide

    def _wait_for(self, end: int) -> None:
        self.next.update((end,))
        self.handle.registerTimer(end - 1)


def pane_ring_counts(
    rows: DataFrame,
    ts: str,
    words: str,
    length: int = 5,
    slide: int = 1,
    k: int = TOP_K,
    delay: str = "0 seconds",
    shards: int = SHARDS,
) -> DataFrame:
    """(window_start, window_end, word, count): the first ``k`` words of each shard for every window
    that has closed, and a row without a word for every slide.

    ``words`` is an array column, which may be empty; ``ts`` is a ``timestamp``. Start the query
    within ``timer_state``. The number of shards belongs to the checkpoint: it cannot change later.
    """
    if slide <= 0 or length <= 0 or length % slide:
        raise ValueError(f"window length {length} must be a positive multiple of the slide {slide}")
    timed = rows.where(F.col(ts).isNotNull()).withWatermark(ts, delay)
    # The plain number has no watermark of its own, so that Spark leaves late rows to the ring.
    pane = (F.unix_millis(ts) - F.pmod(F.unix_millis(ts), F.lit(1000 * slide))).alias("pane")
    # The clock gets a row without a word along with the words.
    told = F.concat(F.array(F.lit(None).cast("string")), F.array_compact(F.coalesce(words, F.array().cast("array<string>"))))
    dealt = timed.select(pane, F.explode(told).alias("word"))
    shard = F.when(F.col("word").isNull(), CLOCK).otherwise(F.pmod(F.xxhash64("word"), F.lit(shards))).cast("int")
    ring = PaneRing(1000 * length, 1000 * slide, k)
    found = (
        dealt.withColumn("shard", shard)
        .groupBy("shard")
        .transformWithStateInPandas(ring, OUTPUT, outputMode="append", timeMode="eventTime")
    )
    return found.withColumns({name: F.timestamp_millis(name) for name in ("window_start", "window_end")})


def _closed(frame: DataFrame) -> DataFrame:
    return frame.withColumns({name: from_instant(F.col(name)) for name in ("window_start", "window_end")})


def ring_topk_writer(
    counts: DataFrame,
    path: str,
    checkpoint: str,
    k: int = TOP_K,
    shape: Callable[[DataFrame], DataFrame] = lambda ranked: ranked,
) -> DataStreamWriter:
    """Rank the words of every closed window of ``pane_ring_counts`` and store them in the given ``shape``."""
    return per_batch(
        counts, path, checkpoint, lambda frame: shape(top_k_per_window(_closed(frame).where("word IS NOT NULL"), k))
    )


def lists_of_every_slide(counts: DataFrame, k: int = TOP_K) -> DataFrame:
    """(window_start, window_end, word_counts): one list per window, empty if it only has a row without a word.

    A row without a word, at most one per window, says that there is a window. The rows are read
    once, as a stream must: it goes first, so k + 1 rows of a window hold all that its list needs.
    """
    order = Window.partitionBy("window_start", "window_end").orderBy(F.asc_nulls_first("said"), F.desc("count"), F.asc("word"))
    first = (
        counts.withColumn("said", F.when(F.col("word").isNotNull(), 1))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k + 1)
    )
    entry = F.when(F.col("word").isNotNull(), F.struct("rank", "word", "count"))
    ordered = F.slice(F.array_sort(F.collect_list(entry)), 1, k)
    words = F.transform(ordered, lambda e: F.struct(e["word"].alias("word"), e["count"].alias("count")))
    return first.groupBy("window_start", "window_end").agg(words.cast(WORD_COUNTS).alias("word_counts"))


def every_slide_writer(
    counts: DataFrame, path: str, checkpoint: str, k: int = TOP_K, shape: Callable[[DataFrame], DataFrame] = lambda lists: lists
) -> DataStreamWriter:
    """Store the list of every slide that has passed, also of quiet ones."""
    return per_batch(counts, path, checkpoint, lambda frame: shape(lists_of_every_slide(_closed(frame), k)))
