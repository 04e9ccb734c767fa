"""First-in first-out reads of an ordered table. ``key`` is its unique arrival number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panewise.functions.clock import whole_div
from panewise.functions.templates import Template, select_matching
from panewise.operators.numbering import with_position

BATCH_SIZE = 50


def fifo_batches(df: DataFrame, key: str, size: int = BATCH_SIZE, template: Template | None = None) -> DataFrame:
    """Add ``position`` and ``batch``: which of the consecutive reads of ``size`` matching rows brings the row."""
    matching = with_position(select_matching(df, template or {}), key, "position")
    return matching.withColumn("batch", whole_div(F.col("position"), size))


def fifo_head(df: DataFrame, key: str, template: Template | None = None, count: int = 1) -> DataFrame:
    """The oldest ``count`` matching rows; none if nothing matches."""
    return select_matching(df, template or {}).orderBy(key).limit(count)


def sub_stream(key: Column, count: int) -> Column:
    """Which of ``count`` competing readers gets a row. Each row goes to exactly one."""
    return F.pmod(key, F.lit(count))


def union_streams(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows of all streams, duplicates included."""
    for other in others:
        first = first.unionByName(other)
    return first
