"""Feeding, running and watching streaming queries."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter
from pyspark.sql.types import LongType, StructField, StructType

from panewise.functions.clock import from_instant, whole_div
from panewise.functions.text import words_of_length
from panewise.operators.topk import TOP_K, top_k_per_window
from panewise.operators.windows import sliding_counts
from panewise.session import shared_path
from panewise.sources.lines import WORD_LENGTH
from panewise.streaming.sinks import append, per_batch

POLL = "100 milliseconds"
WINDOW_LENGTH = 5  # seconds

SLICE_ROWS = 200_000_000  # most rows that one micro-batch of a bounded replay brings
BLOCKS = 8  # least number of blocks that a slice is written in
BLOCK_ROWS = 1_000_000


def in_slices(df: DataFrame, position: str, total: int, least_slices: int = 2) -> Iterator[DataFrame]:
    """Cut a table of ``total`` rows, numbered by ``position``, into slices in that order.

    At least ``least_slices``, and none larger than ``SLICE_ROWS``. The table is computed once,
    into one folder per slice; blocks of neighbouring rows share a task, so that a slice is
    a moderate number of files, written by many tasks.
    """
    spark = df.sparkSession
    rows = max(1, min(-(-total // least_slices), SLICE_ROWS))
    block = max(1, min(rows // BLOCKS, BLOCK_ROWS))
    stage = shared_path(spark, "slices")
    (
        df.withColumn("slice", whole_div(F.col(position), rows))
        .repartition(whole_div(F.col(position), block))
        # In order, so that state is asked for one neighbourhood after the other.
        .sortWithinPartitions("slice", position)
        .write.partitionBy("slice")
        .parquet(stage)
    )
    staged = spark.read.schema(StructType([*df.schema.fields, StructField("slice", LongType())])).parquet(stage)
    for number in range(-(-total // rows)):
        yield staged.where(F.col("slice") == number).drop("slice")


def stream_slices(slices: Iterator[DataFrame], path: str, writer: Callable[[], DataStreamWriter]) -> None:
    """Append slice after slice to ``path``, and run the stream over it up to there each time.

    Every run picks up at the checkpoint of the one before. A slice is one micro-batch: files
    of one slice cannot overtake each other, and the state never holds more than a slice.
    """
    for part in slices:
        append(part, path)
        run_to_end(writer())


def run_to_end(writer: DataStreamWriter) -> StreamingQuery:
    """Process everything there is, in as many micro-batches as the source asks for, and stop."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def idle_for(seconds: float) -> Callable[[StreamingQuery], bool]:
    """A stop condition: nothing has arrived for so long."""
    since: list[float] = []

    def idle(query: StreamingQuery) -> bool:
        status = query.status
        waiting = status["message"].startswith("Waiting") and not status["isDataAvailable"] and not status["isTriggerActive"]
        if not waiting:
            since.clear()
        elif not since:
            since.append(time.monotonic())
        return bool(since) and time.monotonic() - since[0] >= seconds

    return idle


def poll_until(
    writer: DataStreamWriter, stop: Callable[[StreamingQuery], bool], interval: str = POLL, look: float = 0.1
) -> StreamingQuery:
    """Look for new data every ``interval``, through empty looks too, until ``stop`` says so.

    Empty looks run no batch. The condition is asked every ``look`` seconds; a failed query raises.
    """
    query = writer.trigger(processingTime=interval).start()
    try:
        while not query.awaitTermination(look) and not stop(query):
            pass
    finally:
        query.stop()
    return query


def sliding_word_counts_stream(
    sentences: DataFrame, length: int = 5, slide: int = 1, size: int = WORD_LENGTH, delay: str = "0 seconds"
) -> DataFrame:
    """Counts per word and window of a stream of sentences, given out when the window has closed.

    ``arrival_ts`` must be a ``timestamp``. The watermark only serves to drop closed windows
    from the state; rows later than ``delay`` are lost to windows that have closed.
    """
    words = sentences.withWatermark("arrival_ts", delay).select(
        "arrival_ts", F.explode(words_of_length(F.col("text"), size)).alias("word")
    )
    return sliding_counts(words, "arrival_ts", ["word"], length, slide)


def topk_writer(
    counts: DataFrame,
    path: str,
    checkpoint: str,
    k: int = TOP_K,
    shape: Callable[[DataFrame], DataFrame] = lambda ranked: ranked,
    console: bool = False,
) -> DataStreamWriter:
    """Rank every closed window of a stream of counts and store the result in the given ``shape``.

    In append mode a window arrives whole in one micro-batch, so it is ranked there.
    """

    def rank(frame: DataFrame) -> DataFrame:
        zoneless = frame.withColumns(
            {name: from_instant(F.col(name)) for name in ("window_start", "window_end")}
        )
        return shape(top_k_per_window(zoneless, k))

    return per_batch(counts, path, checkpoint, rank, console)


def progress_table(query: StreamingQuery, trigger_ms: int = 1000) -> DataFrame:
    """(batch, rows, duration_ms, overrun): the recent micro-batches of a query.

    ``overrun`` marks the ones that took longer than the trigger interval. Spark keeps the
    last ``spark.sql.streaming.numRecentProgressUpdates`` of them.
    """
    rows = []
    for progress in query.recentProgress:
        took = int(progress["durationMs"].get("triggerExecution", 0))
        rows.append((int(progress["batchId"]), int(progress["numInputRows"]), took, took > trigger_ms))
    return SparkSession.active().createDataFrame(rows, "batch bigint, rows bigint, duration_ms bigint, overrun boolean")
