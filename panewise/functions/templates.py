"""Query by example: a template names the values a record must have.

A template is a dict of field -> value. A field that is missing or ``None`` matches
anything, so an empty template selects every record.
"""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Template = dict[str, Any]


def matches(template: Template) -> Column:
    """Plain equalities joined by AND, so Catalyst can push them into the scan.

    A record whose field is null does not match a template that sets that field.
    """
    tests = [F.col(field) == F.lit(value) for field, value in template.items() if value is not None]
    return reduce(lambda left, right: left & right, tests, F.lit(True))


def select_matching(df: DataFrame, template: Template) -> DataFrame:
    return df.where(matches(template))


def demux(df: DataFrame, streams: dict[str, Template], name: str = "stream") -> DataFrame:
    """Tell several streams of one record type apart: one row per (stream, matching record).

    A record that fits several templates appears once for each of them; readers that
    compete for records would give it to only one. The templates become one projection,
    so nothing is joined or shuffled, and their OR is pushed into the scan.
    """
    if not streams:
        return df.limit(0).select(F.lit("").alias(name), "*")
    hits = F.array(*[F.when(matches(template), F.lit(key)) for key, template in streams.items()])
    anything = reduce(lambda left, right: left | right, [matches(t) for t in streams.values()])
    return df.where(anything).select(F.explode(F.array_compact(hits)).alias(name), "*")
