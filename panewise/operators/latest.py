"""Keyed results: every result is a new version of a row, and readers see the latest one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panewise.operators.topk import WORD_COUNTS

SNAPSHOT_ID = 1  # key of the one row that holds the current top list


def latest_by_key(df: DataFrame, keys: list[str], version: list[str]) -> DataFrame:
    """The row with the greatest ``version`` of every key.

    An aggregate, not a ranking: each task keeps one row per key before the shuffle.
    """
    newest = F.max_by(F.struct(*df.columns), F.struct(*version)).alias("row")
    return df.groupBy(*keys).agg(newest).select("row.*")


def snapshot_versions(lists: DataFrame) -> DataFrame:
    """(id, version, word_counts): each window's list as a version of the row ``SNAPSHOT_ID``."""
    return lists.select(
        F.lit(SNAPSHOT_ID).alias("id"), F.col("window_end").alias("version"), "word_counts"
    )


def lookup(versions: DataFrame, key: int = SNAPSHOT_ID) -> DataFrame:
    """The current row with that ``id``, or no row. It stays where it is."""
    return latest_by_key(versions.where(F.col("id") == key), ["id"], ["version"])


def lookup_or_empty(versions: DataFrame, keys: list[int]) -> DataFrame:
    """(id, word_counts): the current list of each asked ``id``, an empty one where there is none.

    Empty lists enter as versions older than any other, so nothing is joined.
    """
    defaults = versions.sparkSession.range(0, 1, 1, 1).select(
        F.explode(F.array(*map(F.lit, keys))).alias("id"),
        F.lit(None).cast(versions.schema["version"].dataType).alias("version"),
        F.array().cast(WORD_COUNTS).alias("word_counts"),
    )
    known = versions.where(F.col("id").isin(keys)).select("id", "version", "word_counts")
    return latest_by_key(known.unionByName(defaults), ["id"], ["version"]).select("id", "word_counts")
