"""Time arithmetic in whole seconds, independent of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START = "2024-01-01 00:00:00"  # arrival time of the first sentence


def whole_div(value: Column, by: int | Column) -> Column:
    """Integer division that stays in bigint."""
    return F.call_function("div", value, by if isinstance(by, Column) else F.lit(by))


def arrival_time(position: Column, rate: int, start: str = START) -> Column:
    """When the item at ``position`` arrives, at ``rate`` items per second."""
    return F.timestamp_add("SECOND", whole_div(position, rate), F.lit(start).cast("timestamp_ntz"))


def pane_start(ts: Column, seconds: int) -> Column:
    """``ts`` rounded down to a multiple of ``seconds`` since the epoch."""
    return F.window(ts, f"{seconds} seconds").start


def plus_seconds(ts: Column, seconds: int) -> Column:
    return ts + F.expr(f"interval {seconds} seconds")


def _is_zoneless(df: DataFrame, ts: str) -> bool:
    return df.schema[ts].dataType.simpleString() == "timestamp_ntz"


def _zoneless_seconds(ts: Column) -> Column:
    """Whole seconds since the epoch of a zoneless time, read as UTC.

    ``timestampdiff`` and ``unix_timestamp`` go through the session zone and shift the hour
    that a change to summer time skips; the fields of a zoneless time do not.
    """
    day = F.unix_date(ts.cast("date")).cast("bigint")
    return day * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def _zoneless_epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def slide_number(df: DataFrame, ts: str, slide: int) -> Column:
    """Which slide since the epoch a pane start ``ts``, a multiple of ``slide``, is."""
    time = F.col(ts)
    return whole_div(_zoneless_seconds(time) if _is_zoneless(df, ts) else F.unix_seconds(time), slide)


def slide_time(df: DataFrame, ts: str, number: Column, slide: int) -> Column:
    """The time of a slide number, in the type of column ``ts`` of ``df``."""
    seconds = number * slide
    if _is_zoneless(df, ts):
        return F.timestamp_add("SECOND", seconds, _zoneless_epoch())
    return F.timestamp_seconds(seconds)


def to_instant(ts: Column) -> Column:
    """A zoneless time, read as UTC, as the ``timestamp`` that watermarks ask for."""
    micros = (F.extract(F.lit("SECOND"), ts) % 1 * 1000000).cast("bigint")
    return F.timestamp_micros(_zoneless_seconds(ts) * 1000000 + micros)


def from_instant(ts: Column) -> Column:
    """The reverse of ``to_instant``."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(ts), _zoneless_epoch())
