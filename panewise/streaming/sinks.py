"""Where results go: appended tables, keyed versions, the console."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.readwriter import DataStreamWriter
from pyspark.sql.types import StructType

from panewise.sources.files import Folder


def append(df: DataFrame, path: str) -> None:
    """Add the rows of a batch frame to a table."""
    df.write.mode("append").parquet(path)


def append_stream(df: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Add the rows of a stream to a table, each exactly once."""
    return df.writeStream.outputMode("append").format("parquet").option("path", path).option(
        "checkpointLocation", checkpoint
    )


def per_batch(
    df: DataFrame,
    path: str,
    checkpoint: str,
    result: Callable[[DataFrame], DataFrame],
    console: bool = False,
) -> DataStreamWriter:
    """Apply batch code to every micro-batch and add what it returns to a table.

    A batch owns the folder ``batch=<id>`` and overwrites it, so a repeated batch changes nothing.
    """

    def write(frame: DataFrame, batch_id: int) -> None:
        rows = result(frame)
        if console:
            rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
            print_rows(rows)
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        if console:
            rows.unpersist()

    return df.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(write)


def print_rows(rows: DataFrame) -> None:
    """Print every row. The driver holds one partition at a time: a batch may close many windows."""
    print("\t".join(rows.columns))
    for row in rows.toLocalIterator():
        print("\t".join("" if value is None else str(value) for value in row))


def stored_batches(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """What ``per_batch`` has written so far. With a ``schema``, nothing is an empty frame."""
    if schema is not None and not any(name.startswith("batch=") for name in Folder(spark, path).names()):
        return spark.createDataFrame([], schema)
    return spark.read.parquet(path).drop("batch")
