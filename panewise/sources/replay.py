"""Replay lines forever at a fixed rate, by one or more producers.

Every producer sends the whole list of lines from its start and begins again at its end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panewise.functions.clock import arrival_time
from panewise.sources.lines import RATE
from panewise.sources.positioned import POSITION, Positioned, position_stream

ROWS_PER_TASK = 10_000_000  # of one micro-batch of a replayed stream

BLOCK_CYCLES = 1 << 12  # repetitions of a line that are made as one array
COLUMNS = ["producer", "position", "seq", "text", "arrival_ts"]


def _producers(count: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias("producer")


def cyclic_replay(
    lines: DataFrame, line_count: int, seconds: int, rate: int = RATE, producers: int = 1
) -> DataFrame:
    """(producer, position, seq, text, arrival_ts): what ``seconds`` of replay send.

    Line ``seq`` is sent at positions ``seq``, ``seq + line_count``, and so on, so every
    line makes its own rows and nothing is joined.
    """
    total, every = rate * seconds, max(line_count, 1)
    if total == 0 or line_count == 0:
        lines = lines.limit(0)
    sent = lines.where(F.col("seq") < total).select("seq", "text")
    span = every * BLOCK_CYCLES
    if total > span:
        # Many repetitions: blocks of them are spread first, so none is one task's array.
        blocks = F.sequence(F.col("seq"), F.lit(total - 1), F.lit(span).cast("bigint"))
        sent = sent.withColumn("begin", F.explode(blocks)).repartition("begin")
    else:
        sent = sent.withColumn("begin", F.col("seq"))
    end = F.least(F.lit(total - 1).cast("bigint"), F.col("begin") + (span - 1))
    positions = F.sequence("begin", end, F.lit(every).cast("bigint"))
    return (
        sent.select("seq", "text", F.explode(positions).alias("position"))
        .select("*", _producers(producers))
        .withColumn("arrival_ts", arrival_time(F.col("position"), rate))
        .select(*COLUMNS)
    )


def cyclic_replay_stream(
    spark: SparkSession,
    lines: DataFrame,
    line_count: int,
    rate: int = RATE,
    producers: int = 1,
    seconds_per_batch: int = 1,
) -> DataFrame:
    """The same rows as a stream that brings ``seconds_per_batch`` of replay per micro-batch.

    ``lines`` is read again for every batch, so it should be a stored table.
    """
    rows = rate * seconds_per_batch
    ticks = (
        spark.readStream.format("rate-micro-batch")
        .option("rowsPerBatch", rows)
        .option("numPartitions", max(spark.sparkContext.defaultParallelism, rows // ROWS_PER_TASK))
        .option("advanceMillisPerBatch", 1000 * seconds_per_batch)
        .load()
    )
    return (
        ticks.select(F.col("value").alias("position"), (F.col("value") % line_count).alias("seq"))
        .join(lines.select("seq", "text"), "seq")
        .select("*", _producers(producers))
        .withColumn("arrival_ts", arrival_time(F.col("position"), rate))
        .select(*COLUMNS)
    )


def stored_replay_stream(
    spark: SparkSession,
    stored: Positioned,
    limit: int,
    rate: int = RATE,
    producers: int = 1,
    seconds_per_batch: int = 1,
) -> DataFrame:
    """The first ``limit`` rows of the replay of lines stored by position, ``seconds_per_batch`` of it per micro-batch.

    A micro-batch reads the buckets of the lines that it sends, not the others.
    """
    sent = position_stream(spark, stored, rate * seconds_per_batch, limit)
    return (
        sent.select(POSITION, (F.col(POSITION) % max(stored.rows, 1)).alias("seq"), "text")
        .select("*", _producers(producers))
        .withColumn("arrival_ts", arrival_time(F.col(POSITION), rate))
        .select(*COLUMNS)
    )
