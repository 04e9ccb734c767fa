"""Global positions for ordered rows without a global sort in one task.

A plain ``row_number()`` over a whole table sends every row to one task. Here rows are
numbered inside buckets of the key, and only bucket totals travel further up.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panewise.session import shared_path

# Keys are unique 64-bit numbers, so a bucket holds at most 2^8 rows, however they are spread.
BUCKET_BITS = 8
# Totals are summed up in one step while there are at most this many; beyond it, they are
# grouped by these further bits: at most 2^16 totals in a group, 2^20 groups in a group of
# groups, and 2^20 of those at the top.
ONE_STEP = 1 << 20
GROUP_BITS = (16, 20)
# Weight that one task handles where there is much: Spark's own number of tasks would let them grow.
TASK_WEIGHT = 1 << 16

_POSITION_BITS = 33  # row part of monotonically_increasing_id()


def bucket_of(key: str) -> Column:
    return F.shiftright(F.col(key).cast("bigint"), BUCKET_BITS)


def sum_before(value: str, window) -> Column:
    """Sum of ``value`` over the rows before this one in ``window``."""
    frame = window.rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(frame), F.lit(0)).cast("bigint")


def _bucket_starts(totals: DataFrame, group_bits: tuple[int, ...]) -> DataFrame:
    """(bucket, total) -> (bucket, start): the sum of the totals of all earlier buckets."""
    if not group_bits:
        top = Window.partitionBy(F.lit(0)).orderBy("bucket")
        return totals.select("bucket", sum_before("total", top).alias("start"))
    grouped = totals.withColumn("group", F.shiftright("bucket", group_bits[0]))
    group_totals = grouped.groupBy(F.col("group").alias("bucket")).agg(F.sum("total").alias("total"))
    group_starts = _bucket_starts(group_totals, group_bits[1:]).select(
        F.col("bucket").alias("group"), F.col("start").alias("group_start")
    )
    inner = sum_before("total", Window.partitionBy("group").orderBy("bucket"))
    return (
        grouped.withColumn("inner", inner)
        .join(group_starts, "group")
        .select("bucket", (F.col("inner") + F.col("group_start")).alias("start"))
    )


@dataclass(frozen=True)
class Starts:
    """Where each bucket of a numbered table begins, and the sum of all weights."""

    buckets: DataFrame  # (bucket, start)
    few: bool  # at most ONE_STEP buckets, so that they may be broadcast
    total: int
    size: int = 0  # of all rows, if they have been measured

    @property
    def partitions(self) -> int | None:
        """Tasks for the whole weight, none with much more than ``TASK_WEIGHT``; None if Spark may choose."""
        return self.tasks(TASK_WEIGHT)

    def tasks(self, weight: int, size: int | None = None) -> int | None:
        """Tasks that have ``weight`` each, and ``size``, or less; None if Spark may choose."""
        tasks = max(-(-self.total // weight), -(-self.size // size) if size else 0)
        return tasks if tasks > self.buckets.sparkSession.sparkContext.defaultParallelism else None

    def first_key(self, least: int) -> int | None:
        """A key below which every offset range ends at or before ``least``."""
        bucket = self.buckets.where(F.col("start") <= least).agg(F.max("bucket")).first()[0]
        return None if bucket is None else bucket << BUCKET_BITS


def bucket_starts(df: DataFrame, key: str, weight: str, size: str | None = None) -> Starts:
    """Sum ``weight`` per bucket of ``key``, and ``size`` if there is one, in one pass that reads nothing else.

    The sums are written to the shared folder, so that later steps never repeat the pass. Null
    keys have no place in the order and repeated ones none of their own: both raise. Four numbers
    mark the keys that a bucket has, one bit each, so repeated ones show in the same pass.
    """
    path = shared_path(df.sparkSession, "totals")
    low = F.col(key).cast("bigint").bitwiseAND((1 << BUCKET_BITS) - 1)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), low.bitwiseAND(63).cast("int"))
    words = range((1 << BUCKET_BITS) // 64)
    marks = [F.bit_or(F.when(F.shiftright(low, 6) == word, bit)) for word in words]
    keys = sum((F.coalesce(F.bit_count(mark), F.lit(0)) for mark in marks), F.lit(0))
    totals = df.groupBy(bucket_of(key).alias("bucket")).agg(
        F.sum(weight).cast("bigint").alias("total"),
        (F.sum(size) if size else F.lit(0)).cast("bigint").alias("size"),
        (F.count(F.lit(1)) - keys).alias("repeated")
    )
    totals.write.parquet(path)
    totals = df.sparkSession.read.parquet(path)
    count, total, sizes, nulls, repeated = totals.agg(
        F.count("bucket"), F.sum("total"), F.sum("size"), F.count_if(F.col("bucket").isNull()), F.count_if(F.col("repeated") > 0)
    ).first()
    if nulls or repeated:
        raise ValueError(f"{key} numbers the rows, so it must be neither null nor repeated")
    totals = totals.drop("size", "repeated")
    few = count <= ONE_STEP
    return Starts(_bucket_starts(totals, () if few else GROUP_BITS), few, total or 0, sizes or 0)


def with_offset(
    df: DataFrame, key: str, weight: str, name: str, starts: Starts | None = None, least: int = 0
) -> DataFrame:
    """Add ``name``: the sum of ``weight`` over all rows with a smaller ``key``.

    ``key`` must be a unique whole number. Rows are shuffled once, by bucket. ``starts``
    may be handed in when it is there already. With ``least``, buckets that end at or
    before that offset may be left out, and are then not even read.
    """
    starts = starts or bucket_starts(df, key, weight)
    first_key = starts.first_key(least) if least > 0 else None
    if first_key is not None:
        df = df.where(F.col(key) >= first_key)
    begin = starts.buckets.select(F.col("bucket").alias("_bucket"), F.col("start").alias("_start"))
    inner = sum_before(weight, Window.partitionBy("_bucket").orderBy(key))
    df = df.withColumn("_bucket", bucket_of(key))
    if starts.partitions:
        df = df.repartition(starts.partitions, "_bucket")
    return (
        df.withColumn("_inner", inner)
        # Many starts are merged: the rows are partitioned and sorted by bucket already.
        .join(F.broadcast(begin) if starts.few else begin.hint("merge"), "_bucket")
        .withColumn(name, F.col("_inner") + F.col("_start"))
        .drop("_bucket", "_inner", "_start")
    )


def with_position(df: DataFrame, key: str, name: str) -> DataFrame:
    """Add ``name``: the 0-based position of the row by ``key``, a unique whole number."""
    return with_offset(df.withColumn("_one", F.lit(1)), key, "_one", name).drop("_one")


def with_rank(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Sort by any ``order`` and add ``name``: the 1-based position in it.

    The range-partitioned sort is written once, so that its partitions are fixed while
    the rows per partition are counted; one small row per partition is broadcast.
    """
    spark = df.sparkSession
    path = shared_path(spark, "ranked")
    df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path).withColumn("_part", F.shiftright("_id", _POSITION_BITS))
    starts = (
        rows.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("total"))
        .select("_part", sum_before("total", Window.partitionBy(F.lit(0)).orderBy("_part")).alias("_start"))
    )
    inside = F.col("_id").bitwiseAND((1 << _POSITION_BITS) - 1)
    return (
        rows.join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + inside + 1)
        .drop("_part", "_id", "_start")
    )
