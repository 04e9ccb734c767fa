"""Counts and reductions over sliding time windows.

Windows are half-open, ``[start, start + length)``, start at multiples of ``slide`` seconds
since the epoch, and include the partial ones at both ends of the data. A row with a null
time belongs to no window.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panewise.functions.clock import pane_start, plus_seconds, slide_number, slide_time, whole_div

# Panes are gathered in chunks of 2^6 slides before they are combined into windows. Each
# chunk also gets the first panes of the next one, so a longer chunk repeats fewer of them.
CHUNK_BITS = 6
# Blocks of panes whose running results are made together: 2^3, so that one in eight is sent twice.
BLOCK_BITS = 3
# Tasks that the keys of a chunk are dealt to where the number of tasks is set: enough for a large
# vocabulary, and few enough that the first words of a window's share are far fewer than its words.
SHARES = 8


def _check(length: int, slide: int) -> None:
    if slide <= 0 or length <= 0 or length % slide:
        raise ValueError(f"window length {length} must be a positive multiple of the slide {slide}")


def _window_columns(window: Column) -> list[Column]:
    return [window.start.alias("window_start"), window.end.alias("window_end")]


def pane_counts(
    df: DataFrame, ts: str, keys: list[str], slide: int = 1, partitions: int | None = None
) -> DataFrame:
    """(ts, *keys, count): rows per key in each slide. Partial counts are made before the shuffle.

    With ``partitions``, for many rows that seldom repeat a key in a slide, the rows themselves are
    shuffled, to that many tasks, so that none holds counts beyond its share.
    """
    pane = pane_start(F.col(ts), slide)
    if partitions:
        df = df.select(pane.alias(ts), *keys).repartition(partitions, ts, *keys)
        return df.groupBy(ts, *keys).agg(F.count(F.lit(1)).alias("count"))
    return df.groupBy(pane.alias(ts), *keys).agg(F.count(F.lit(1)).alias("count"))


def sliding_counts(
    df: DataFrame, ts: str, keys: list[str], length: int = 5, slide: int = 1, partitions: int | None = None
) -> DataFrame:
    """(window_start, window_end, *keys, count), counted in one step.

    Each row is expanded to all its windows before the partial count. This is the form for
    rows that seldom repeat a key within a slide, and for streams, where the window is the state.
    With ``partitions``, each row is a pane of its own, expanded after the shuffle to that many tasks.
    """
    _check(length, slide)
    if partitions:
        panes = df.select(pane_start(F.col(ts), slide).alias(ts), *keys, F.lit(1).cast("bigint").alias("count"))
        return sliding_counts_from_panes(panes, ts, keys, length, slide, partitions)
    window = F.window(ts, f"{length} seconds", f"{slide} seconds")
    return (
        df.groupBy(window.alias("window"), *keys)
        .agg(F.count(F.lit(1)).alias("count"))
        .select(*_window_columns(F.col("window")), *keys, "count")
    )


def sliding_counts_from_panes(
    panes: DataFrame, ts: str, keys: list[str], length: int = 5, slide: int = 1, partitions: int | None = None
) -> DataFrame:
    """(window_start, window_end, *keys, count), combined from ``pane_counts``.

    Panes travel once, not once per window: they are shuffled by (chunk of time,
    keys), with the panes that windows of the chunk before reach into repeated there,
    and expanded to windows after the shuffle. The sum then needs no shuffle of its own.
    This is the form for many rows per key and slide: only panes are expanded, not rows.
    With ``partitions`` there are that many tasks, so that the counts that one holds are bounded,
    and a chunk's keys are dealt to ``SHARES`` of them.
    """
    _check(length, slide)
    reach = length // slide - 1
    bits = max(CHUNK_BITS, reach.bit_length())
    pane = F.col("_pane")
    share = F.pmod(F.xxhash64(*keys), F.lit(SHARES)) if partitions and keys else F.lit(0).cast("bigint")
    dealt = (partitions, "_chunk", "_share") if partitions else ("_chunk", *keys)
    gathered = (
        panes.withColumn("_pane", slide_number(panes, ts, slide))
        .withColumn(
            "_chunk",
            F.explode(F.array_distinct(F.array(F.shiftright(pane - reach, bits), F.shiftright(pane, bits)))),
        )
        .select("_chunk", "_pane", *keys, "count")
        .withColumn("_share", share)
        .repartition(*dealt)
    )
    first_of_chunk = F.shiftleft("_chunk", bits)
    starts = F.sequence(
        F.greatest(pane - reach, first_of_chunk),
        F.least(pane, first_of_chunk + ((1 << bits) - 1)),
    )
    start = slide_time(panes, ts, F.col("_start"), slide)
    return (
        gathered.withColumn("_start", F.explode(starts))
        .groupBy("_chunk", *(["_share"] if partitions else []), "_start", *keys)
        .agg(F.sum("count").alias("count"))
        .select(start.alias("window_start"), *keys, "count")
        .select("window_start", plus_seconds(F.col("window_start"), length).alias("window_end"), *keys, "count")
    )


def windowed_rows(df: DataFrame, ts: str, length: int = 5, slide: int = 1) -> DataFrame:
    """Every row once per window it falls in, with ``window_start`` and ``window_end``. No shuffle."""
    _check(length, slide)
    window = F.window(ts, f"{length} seconds", f"{slide} seconds")
    return df.select("*", window.alias("_window")).select(*df.columns, *_window_columns(F.col("_window")))


def windowed_reduce(
    df: DataFrame, ts: str, values: list[Column], length: int = 5, slide: int = 1, keys: list[str] | None = None
) -> DataFrame:
    """Reduce each window, or each key of each window, to one row of aggregate ``values``."""
    _check(length, slide)
    keys = keys or []
    window = F.window(ts, f"{length} seconds", f"{slide} seconds")
    if not df.isStreaming:
        # Grouped by the columns that the result has, its partitioning serves a join on them.
        return windowed_rows(df, ts, length, slide).groupBy("window_start", "window_end", *keys).agg(*values)
    # On a stream the window itself carries the watermark.
    reduced = df.groupBy(window.alias("_window"), *keys).agg(*values)
    names = [name for name in reduced.columns if name != "_window" and name not in keys]
    return reduced.select(*_window_columns(F.col("_window")), *keys, *names)


#: A reduction: the aggregate over the rows of a pane, and the one that combines two such results.
Reduction = tuple[Column, Callable[[str], Column]]


def sliding_reduce(
    df: DataFrame, ts: str, values: dict[str, Reduction], length: int = 5, slide: int = 1, keys: list[str] | None = None
) -> DataFrame:
    """(window_start, window_end, *keys, *values): reduce sliding windows at a cost that does not depend on their length.

    For any reduction that may be combined in any order; it needs no inverse, so it serves minima as
    well as sums. Rows are reduced to panes. The panes of a window are the end of one block of
    ``length / slide`` panes and the beginning of the next, so two running results per block, from
    its front and from its back, hold all that windows need: each is two of them combined, where
    ``windowed_reduce`` would combine as many as a window has panes.

    Panes are shuffled once, by chunk of blocks and key; the first block of a chunk goes to the one
    before it too, whose last windows reach into it.
    """
    _check(length, slide)
    keys, size, names = keys or [], length // slide, list(values)
    reduced = [value.alias(name) for name, (value, _) in values.items()]
    panes = df.where(F.col(ts).isNotNull()).groupBy(pane_start(F.col(ts), slide).alias("_ts"), *keys).agg(*reduced)
    pane, block, chunk = F.col("_pane"), F.col("_block"), F.col("_chunk")
    numbered = panes.select(slide_number(panes, "_ts", slide).alias("_pane"), *keys, *names)
    blocked = numbered.withColumn("_block", whole_div(pane - F.pmod(pane, F.lit(size)), size))
    chunk_of = lambda number: F.shiftright(number, BLOCK_BITS)
    gathered = blocked.withColumn(
        "_chunk", F.explode(F.array_distinct(F.array(chunk_of(block), chunk_of(block - 1))))
    ).repartition("_chunk", *keys)
    in_block = Window.partitionBy("_chunk", *keys, "_block").orderBy("_pane")
    so_far = in_block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    from_here = in_block.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    first, last = block * size, block * size + (size - 1)
    combine = {name: combined for name, (_, combined) in values.items()}
    running = gathered.select(
        "_chunk",
        *keys,
        # The result from the back serves the windows that start after the pane before, in this chunk.
        F.when(chunk_of(block) == chunk, F.coalesce(F.lag("_pane").over(in_block) + 1, first)).alias("_back_from"),
        pane.alias("_back_to"),
        F.struct(*[combine[name](name).over(from_here).alias(name) for name in names]).alias("_back"),
        # The one from the front serves those that end before the next pane, and start in the block before.
        F.when(chunk_of(block - 1) == chunk, pane - (size - 1)).alias("_front_from"),
        (F.least(F.coalesce(F.lead("_pane").over(in_block), last) - 1, last - 1) - (size - 1)).alias("_front_to"),
        F.struct(*[combine[name](name).over(so_far).alias(name) for name in names]).alias("_front"),
    )
    parts = F.filter(
        F.array(*[F.struct(F.col(f"_{side}_from").alias("a"), F.col(f"_{side}_to").alias("b"), F.col(f"_{side}").alias("part")) for side in ("back", "front")]),
        lambda part: part["a"] <= part["b"],
    )
    start = slide_time(panes, "_ts", F.col("_start"), slide)
    return (
        running.select("_chunk", *keys, F.explode(parts).alias("_p"))
        .select("_chunk", *keys, F.explode(F.sequence("_p.a", "_p.b")).alias("_start"), "_p.part.*")
        .groupBy("_chunk", "_start", *keys)
        .agg(*[combine[name](name).alias(name) for name in names])
        .select(start.alias("window_start"), *keys, *names)
        .select("window_start", plus_seconds(F.col("window_start"), length).alias("window_end"), *keys, *names)
    )


def join_windowed(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join two reduced window streams on window and key.

    Both sides hold one row per (window, key) and are already partitioned by it, so the
    join is one to one and adds no shuffle, however many rows a key had.
    """
    return left.join(right, ["window_start", "window_end", *keys], how)


def windowed_join_stream(
    left: DataFrame,
    right: DataFrame,
    ts: str,
    values: tuple[list[Column], list[Column]],
    length: int,
    slide: int,
    keys: list[str],
    delay: str = "0 seconds",
) -> DataFrame:
    """Reduce two streams per window and key, and join what both have, as each window closes.

    Both streams carry the same watermark column ``ts``, of type ``timestamp``. The join is on the
    window, so its state is bounded by the watermark as that of the reductions is: a side waits
    only until its window has closed on both. Time is that of the slower stream unless the session
    says otherwise (``spark.sql.streaming.multipleWatermarkPolicy``); rows later than ``delay`` are lost
    to windows that have closed.
    """
    _check(length, slide)
    window = F.window(ts, f"{length} seconds", f"{slide} seconds")
    sides = [
        side.withWatermark(ts, delay).groupBy(window.alias("_window"), *keys).agg(*aggregates)
        for side, aggregates in zip((left, right), values, strict=True)
    ]
    joined = sides[0].join(sides[1], ["_window", *keys])
    names = [name for name in joined.columns if name != "_window" and name not in keys]
    return joined.select(*_window_columns(F.col("_window")), *keys, *names)


def all_windows(df: DataFrame, ts: str, length: int = 5, slide: int = 1) -> DataFrame:
    """(window_start): every window from the first to the last that holds a row, in order of time.

    Only the two ends of the time range reach the driver; the list itself is made by tasks.
    """
    _check(length, slide)
    panes = df.select(pane_start(F.col(ts), slide).alias("pane"))
    low, high = panes.select(slide_number(panes, "pane", slide).alias("n")).agg(F.min("n"), F.max("n")).first()
    first, end = (0, 0) if low is None else (low - length // slide + 1, high + 1)
    numbers = df.sparkSession.range(first, end)
    return numbers.select(slide_time(panes, "pane", F.col("id"), slide).alias("window_start"))


def fill_empty_windows(counts: DataFrame, spine: DataFrame, length: int = 5) -> DataFrame:
    """(window_start, window_end, count): one row for every window of ``spine``, 0 where nothing arrived.

    The spine joins the counts as rows of count 0, so one sum replaces a join.
    """
    rows = counts.select("window_start", "count").unionByName(
        spine.select("window_start", F.lit(0).cast("bigint").alias("count"))
    )
    return (
        rows.groupBy("window_start")
        .agg(F.sum("count").alias("count"))
        .select("window_start", plus_seconds(F.col("window_start"), length).alias("window_end"), "count")
    )
