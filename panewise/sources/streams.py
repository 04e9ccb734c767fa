"""Streaming sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from panewise.functions.templates import Template, select_matching


def stream_source(
    spark: SparkSession,
    path: str,
    schema: StructType,
    template: Template | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """The Parquet files below ``path`` as a stream of the rows that match ``template``.

    New files are taken oldest first, at most ``max_files`` per micro-batch. The checkpoint of
    the query records which were read, so a restart neither loses nor repeats rows.
    """
    if not path:
        raise ValueError("the folder that holds the stream is not set")
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return select_matching(reader.parquet(path), template or {})


def union_live(ts: str, *streams: DataFrame, delay: str = "0 seconds", wait_for_all: bool = False) -> DataFrame:
    """All rows of several streams as one, with a watermark on ``ts``.

    Whose time counts must be said. By default it is that of whichever stream is furthest ahead: an
    idle one holds nothing back, and rows of one that lags by more than ``delay`` are lost to windows
    that have closed. With ``wait_for_all`` every stream has a watermark of its own and the least counts:
    nothing is lost to another stream's lead, but nothing is given out while one is idle.
    Rows that only move time on must live until an aggregate or a stateful step: a filter right after
    the union is carried out before it, and time then stands still.
    ``wait_for_all`` needs the session's ``spark.sql.streaming.multipleWatermarkPolicy`` to be ``min``, as it is unless set.
    """
    if not streams:
        raise ValueError("there is no stream to unite")
    if wait_for_all:
        policy = streams[0].sparkSession.conf.get("spark.sql.streaming.multipleWatermarkPolicy", "min")
        if policy != "min":
            raise ValueError(f"the session takes the {policy} of several watermarks, not the min")
        streams = tuple(stream.withWatermark(ts, delay) for stream in streams)
    whole = streams[0]
    for other in streams[1:]:
        whole = whole.unionByName(other)
    return whole if wait_for_all else whole.withWatermark(ts, delay)


def heartbeat(spark: SparkSession, schema: StructType, ts: str, every_seconds: int = 1) -> DataFrame:
    """A stream of rows that hold only the current time: in a union it moves time on when all else is silent."""
    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load().where(F.unix_seconds("timestamp") % every_seconds == 0)
    return ticks.select(
        *[(F.col("timestamp") if f.name == ts else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
    )
