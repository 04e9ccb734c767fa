"""Ranking: count descending, then word ascending by its bytes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panewise.operators.numbering import with_rank

TOP_K = 10

WORD_COUNTS = "array<struct<word:string,count:bigint>>"


def by_count() -> list[Column]:
    return [F.desc("count"), F.asc("word")]


def global_sort(counts: DataFrame) -> DataFrame:
    """All rows with their ``rank`` in the whole list."""
    return with_rank(counts, by_count(), "rank")


def top_k(counts: DataFrame, k: int = TOP_K) -> DataFrame:
    """The first ``k`` rows of one list: each task keeps ``k``, then those are merged."""
    return counts.orderBy(*by_count()).limit(k)


def top_k_per_window(counts: DataFrame, k: int = TOP_K) -> DataFrame:
    """(window_start, window_end, rank, word, count): the first ``k`` words of every window.

    Spark limits each window to ``k`` rows per task before the shuffle, so a window with
    a large vocabulary does not end up in one task.
    """
    order = Window.partitionBy("window_start", "window_end").orderBy(*by_count())
    return (
        counts.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("window_start", "window_end", F.col("rank").cast("bigint").alias("rank"), "word", "count")
    )


def with_weight(ranked: DataFrame) -> DataFrame:
    """Add ``weight``: the count scaled so that the largest of its window is 100; null if that is 0."""
    largest = F.greatest(
        F.max("count").over(Window.partitionBy("window_start", "window_end")), F.lit(0).cast("bigint")
    )
    return ranked.withColumn("weight", F.col("count") / F.nullif(largest / F.lit(100.0), F.lit(0.0)))


def word_count_lists(ranked: DataFrame) -> DataFrame:
    """(window_start, window_end, word_counts): the ranked rows of a window as one array, best first."""
    row = F.struct("rank", "word", "count")
    ordered = F.array_sort(F.collect_list(row))
    return ranked.groupBy("window_start", "window_end").agg(
        F.transform(ordered, lambda r: F.struct(r["word"].alias("word"), r["count"].alias("count")))
        .cast(WORD_COUNTS)
        .alias("word_counts")
    )


def as_json(lists: DataFrame) -> DataFrame:
    """(window_start, window_end, json): each list as a JSON array, ``[]`` when it is empty or missing."""
    empty = F.array().cast(WORD_COUNTS)
    return lists.select(
        "window_start", "window_end", F.to_json(F.coalesce("word_counts", empty)).alias("json")
    )
