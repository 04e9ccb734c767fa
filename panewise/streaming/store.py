"""A keyed result store: batches of versions go in, the current row of a key comes out.

Rows are dealt over buckets by their key. A manifest, one small file per batch, names the files
that are current in every bucket; it appears under its number whole or not at all, so readers see
the state before a batch or after it. A batch first writes its rows to files that nobody
names yet. Where a bucket then has more than ``runs`` files, they are merged into one that keeps the
greatest version of each key. With one run a bucket is always a single file, and a lookup reads
just that; more runs make batches cheaper that touch many buckets, as only a share of them is merged.

A batch that is written again after a crash finds its number in the manifest and changes nothing;
one that crashed before its manifest left files that nobody names. ``compact`` removes those and
what no longer is current.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from panewise.operators.latest import latest_by_key
from panewise.sources.files import Folder

BUCKETS = 16
BUCKET = "_bucket"


@dataclass(frozen=True)
class Manifest:
    """What is current: the last batch, and for every bucket its files, oldest first."""

    number: int = -1
    batch: int = -1
    buckets: dict[int, list[str]] = field(default_factory=dict)

    def text(self) -> str:
        return json.dumps({"batch": self.batch, "buckets": {str(b): files for b, files in sorted(self.buckets.items())}})


class KeyedStore:
    """Rows by key below ``path``. ``schema``, ``keys``, ``version`` and ``buckets`` belong to the store for good."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: StructType,
        keys: list[str],
        version: list[str],
        buckets: int = BUCKETS,
        runs: int = 1,
    ) -> None:
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.keys, self.version, self.buckets, self.runs = keys, version, buckets, runs
        self._manifests, self._data = Folder(spark, f"{self.path}/manifest"), Folder(spark, f"{self.path}/data")

    def manifest(self) -> Manifest:
        """The current state."""
        numbers = [int(name) for name in self._manifests.names() if name.isdigit()]
        if not numbers:
            return Manifest()
        read = json.loads(self._manifests.read(f"{max(numbers):012d}"))
        return Manifest(max(numbers), read["batch"], {int(b): files for b, files in read["buckets"].items()})

    def put(self, rows: DataFrame, batch: int) -> bool:
        """Add the versions of a batch, numbered in order. False if the store has that batch already."""
        now = self.manifest()
        if batch <= now.batch:
            return False
        newest = latest_by_key(rows.select(*self.schema.names), self.keys, self.version)
        written = self._write(newest.withColumn(BUCKET, self._bucket(*map(F.col, self.keys))))
        buckets = {b: [*now.buckets.get(b, []), *files] for b, files in written.items()}
        full = {b: files for b, files in buckets.items() if len(files) > self.runs}
        if full:
            merged = latest_by_key(self._read(full, BUCKET), [BUCKET, *self.keys], self.version)
            buckets |= self._write(merged)
        after = Manifest(now.number + 1, batch, now.buckets | buckets)
        self._manifests.write_new(f"{after.number:012d}", after.text())
        return True

    def lookup(self, *key: object) -> DataFrame:
        """The current row of a key, or no row. Only the files of the key's bucket are read."""
        values = [F.lit(value).cast(self.schema[name].dataType) for name, value in zip(self.keys, key, strict=True)]
        # Without a table below it, this is evaluated without a job.
        bucket = self.spark.sql("SELECT 1").select(self._bucket(*values)).first()[0]
        rows = self._read({bucket: self.manifest().buckets.get(bucket, [])})
        for name, value in zip(self.keys, values, strict=True):
            rows = rows.where(F.col(name) == value)
        return rows if self.runs == 1 else latest_by_key(rows, self.keys, self.version)

    def current(self) -> DataFrame:
        """All current rows."""
        rows = self._read(self.manifest().buckets)
        return rows if self.runs == 1 else latest_by_key(rows, self.keys, self.version)

    def compact(self, keep: int = 1) -> int:
        """Remove all but the last ``keep`` manifests and the files that those do not name. Returns how many folders went.

        No batch may be under way, and no reader may be at work on older states than those kept.
        """
        numbers = sorted(name for name in self._manifests.names() if name.isdigit())
        kept = numbers[-keep:] if keep > 0 else numbers[-1:]
        named = {
            file.split("/")[0]
            for number in kept
            for files in json.loads(self._manifests.read(number))["buckets"].values()
            for file in files
        }
        for number in numbers[: len(numbers) - len(kept)]:
            self._manifests.delete(number)
        gone = [name for name in self._data.names() if name not in named]
        for name in gone:
            self._data.delete(name)
        return len(gone)

    def _bucket(self, *key: Column) -> Column:
        return F.pmod(F.xxhash64(*key), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame) -> dict[int, list[str]]:
        """Write rows by bucket, each bucket by one task. Returns the new folders by bucket."""
        name = uuid.uuid4().hex
        rows.repartition(self.buckets, BUCKET).write.partitionBy(BUCKET).parquet(f"{self.path}/data/{name}")
        folders = [folder for folder in self._data.names(name) if folder.startswith(f"{BUCKET}=")]
        return {int(folder.split("=")[1]): [f"{name}/{folder}"] for folder in folders}

    def _read(self, buckets: dict[int, list[str]], tag: str | None = None) -> DataFrame:
        files = [f"{self.path}/data/{file}" for held in buckets.values() for file in held]
        if not files:
            empty = self.spark.createDataFrame([], self.schema)
            return empty if tag is None else empty.withColumn(tag, F.lit(0))
        rows = self.spark.read.schema(self.schema).parquet(*files)
        return rows if tag is None else rows.withColumn(tag, self._bucket(*map(F.col, self.keys)))
