"""How much arrives, and whether it is too much."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panewise.functions.clock import pane_start, whole_div


def arrival_rate(df: DataFrame, ts: str, seconds: int = 1) -> DataFrame:
    """(slot, n): rows per slot of ``seconds``, for slots in which something arrived."""
    return df.groupBy(pane_start(F.col(ts), seconds).alias("slot")).agg(F.count(F.lit(1)).alias("n"))


def overruns(rates: DataFrame, budget: int) -> DataFrame:
    """(slot, n, over): the slots that brought more than ``budget`` rows, and by how many."""
    return rates.where(F.col("n") > budget).withColumn("over", F.col("n") - budget)


def overruns_of_mean(rates: DataFrame, times: int = 3, of: int = 2) -> DataFrame:
    """(slot, n, over): the slots that brought more than ``times / of`` of the mean of all slots.

    There is one row per slot here, so the mean of all of them is one task's work; nothing is read
    twice, and no job runs before the result is asked for.
    """
    whole = Window.partitionBy(F.lit(0))
    budget = whole_div(F.sum("n").over(whole) * times, F.count("n").over(whole) * of)
    return rates.withColumn("_budget", budget).where(F.col("n") > F.col("_budget")).select("slot", "n", (F.col("n") - F.col("_budget")).alias("over"))
