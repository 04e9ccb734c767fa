"""Numbered rows as a stream that knows how far it has come.

A table is stored by buckets of row numbers. The stream's offset is the number of rows it has
sent, so a micro-batch is a range of positions, of a size that is set: its tasks open the buckets
that hold those rows and no others, however long the table is. A restarted query goes on at its
checkpoint's position. A cyclic stream starts again at row 0 when it has sent the last one.

Spark's own sources bound a batch by files. This one is a Python data source: its tasks read the
buckets with pyarrow, from the shared folder that Spark has written them to.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StructType

from panewise.functions.clock import whole_div

FORMAT = "positioned"
BUCKET = "_bucket"
BUCKET_ROWS = 50_000
POSITION = "position"


@dataclass(frozen=True)
class Positioned:
    """A stored table of rows numbered from 0."""

    path: str
    rows: int
    schema: StructType  # without the number
    bucket_rows: int


def store_by_position(df: DataFrame, position: str, path: str, bucket_rows: int = BUCKET_ROWS) -> Positioned:
    """Store rows that are numbered from 0 without gaps by ``position``; one file per bucket."""
    bucketed = df.withColumnRenamed(position, POSITION).withColumn(BUCKET, whole_div(F.col(POSITION), bucket_rows))
    bucketed.repartition(BUCKET).sortWithinPartitions(BUCKET, POSITION).write.partitionBy(BUCKET).parquet(path)
    schema = StructType([field for field in df.schema.fields if field.name != position])
    stored = df.sparkSession.read.schema(f"{POSITION} bigint, {BUCKET} bigint").parquet(path)
    return Positioned(path, stored.count(), schema, bucket_rows)


@dataclass
class Range(InputPartition):
    """Positions from ``start`` to before ``end``, at most as many as a bucket has rows."""

    start: int
    end: int


class PositionedReader(DataSourceStreamReader):
    def __init__(self, schema: StructType, options: dict[str, str]) -> None:
        self.schema, self.path = schema, options["path"]
        self.rows, self.bucket_rows = int(options["rows"]), int(options["bucket_rows"])
        self.batch_rows, self.limit = int(options["batch_rows"]), int(options["limit"])
        self.sent = 0

    def initialOffset(self) -> dict:
        return {"sent": 0}

    def latestOffset(self) -> dict:
        self.sent = min(self.sent + self.batch_rows, max(self.limit, self.sent)) if self.rows else self.sent
        return {"sent": self.sent}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        # A restarted query asks for the range it had reached before it asks for more.
        self.sent = max(self.sent, end["sent"])
        step, stop = self.bucket_rows, end["sent"]
        return [Range(at, min(at + step, stop)) for at in range(start["sent"], stop, step)]

    def read(self, partition: Range) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        positions = np.arange(partition.start, partition.end, dtype=np.int64)
        wanted = positions % self.rows
        found = pa.concat_tables([self._bucket(b) for b in np.unique(wanted // self.bucket_rows).tolist()])
        found = found.filter(pc.is_in(found[POSITION], pa.array(np.unique(wanted)))).sort_by(POSITION)
        rows = found.take(np.searchsorted(found[POSITION].to_numpy(), wanted))
        names = [field.name for field in self.schema.fields if field.name != POSITION]
        whole = pa.table([pa.array(positions), *(rows[name] for name in names)], names=[POSITION, *names])
        yield from whole.combine_chunks().to_batches(max_chunksize=10_000)

    def _bucket(self, number: int):
        import pyarrow.dataset as ds
        from pyarrow.fs import FileSystem

        uri = re.sub(r"^file:/(?=[^/])", "file:///", f"{self.path}/{BUCKET}={number}")
        files, path = FileSystem.from_uri(uri)
        return ds.dataset(path, filesystem=files, format="parquet").to_table()


class PositionedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return self.options["schema"]

    def streamReader(self, schema: StructType) -> PositionedReader:
        return PositionedReader(schema, dict(self.options))


def position_stream(spark: SparkSession, stored: Positioned, batch_rows: int, limit: int | None = None) -> DataFrame:
    """(position, ...): ``batch_rows`` rows of a stored table per micro-batch.

    It ends at ``limit`` rows, which is the number of rows if not given; a higher one starts over.
    """
    spark.dataSource.register(PositionedSource)
    columns = [f"{POSITION} bigint", *(f"`{f.name}` {f.dataType.simpleString()}" for f in stored.schema.fields)]
    options = {
        "path": stored.path,
        "rows": stored.rows,
        "bucket_rows": stored.bucket_rows,
        "batch_rows": batch_rows,
        "limit": stored.rows if limit is None else limit,
        "schema": ", ".join(columns),
    }
    return spark.readStream.format(FORMAT).options(**{key: str(value) for key, value in options.items()}).load()


def all_sent(limit: int) -> Callable[[StreamingQuery], bool]:
    """A stop condition: all positions up to ``limit`` have been processed."""

    def done(query: StreamingQuery) -> bool:
        last = query.lastProgress
        if limit <= 0:
            return not query.status["isTriggerActive"]
        return last is not None and f'"sent": {limit}' in str(last["sources"][0]["endOffset"]).replace("'", '"')

    return done
