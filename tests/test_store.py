"""The keyed store: current versions, repeated and crashed batches, what a lookup reads."""

import pytest
from helpers import rows
from pyspark.sql import functions as F

from panewise.session import shared_path
from panewise.sources.files import Folder
from panewise.streaming.store import KeyedStore

SCHEMA = "id bigint, version int, value string"


@pytest.fixture(scope="module")
def batch(spark):
    return lambda *values: spark.createDataFrame(list(values), SCHEMA)


def new_store(spark, **settings):
    return KeyedStore(spark, shared_path(spark, "store"), spark.createDataFrame([], SCHEMA).schema, ["id"], ["version"], **settings)


@pytest.mark.parametrize("runs", [1, 3])
def test_the_greatest_version_of_each_key_is_current(spark, batch, runs):
    store = new_store(spark, buckets=4, runs=runs)
    assert rows(store.current()) == [] and rows(store.lookup(1)) == []
    assert store.put(batch((1, 1, "a"), (1, 3, "c"), (2, 5, "x"), (None, 1, "n")), 0)
    assert store.put(batch((1, 2, "b"), (2, 6, "y"), (3, 1, "z")), 1)
    assert store.put(batch((2, 7, None)), 7)
    found = {r["id"]: (r["version"], r["value"]) for r in store.current().collect()}
    assert found == {1: (3, "c"), 2: (7, None), 3: (1, "z"), None: (1, "n")}
    assert [rows(store.lookup(k)) for k in (1, 2, 3, 4)] == [[(1, 3, "c")], [(2, 7, None)], [(3, 1, "z")], []]


def test_a_repeated_batch_changes_nothing(spark, batch):
    store = new_store(spark)
    store.put(batch((1, 1, "a")), 3)
    before = store.manifest()
    assert not store.put(batch((1, 9, "again")), 3) and not store.put(batch((1, 9, "older")), 2)
    assert store.manifest() == before and rows(store.current()) == [(1, 1, "a")]


def test_a_batch_that_crashes_before_its_manifest_is_not_there(spark, batch, monkeypatch):
    store = new_store(spark)
    store.put(batch((1, 1, "a")), 0)

    def crash(name, text):
        raise RuntimeError("killed")

    monkeypatch.setattr(store._manifests, "write_new", crash)
    with pytest.raises(RuntimeError):
        store.put(batch((1, 2, "b")), 1)
    monkeypatch.undo()
    assert rows(store.lookup(1)) == [(1, 1, "a")]
    assert store.compact() == 2  # the batch's files, written and merged
    assert store.put(batch((1, 2, "b")), 1) and rows(store.lookup(1)) == [(1, 2, "b")]


def test_only_one_of_two_writers_adds_a_manifest(spark):
    folder = Folder(spark, shared_path(spark, "folder"))
    folder.write_new("1", "first")
    with pytest.raises(FileExistsError):
        folder.write_new("1", "second")
    assert folder.read("1") == "first" and folder.names() == ["1"]


def test_a_lookup_reads_one_file_and_compaction_removes_the_others(spark, batch):
    store = new_store(spark, buckets=2)
    for number in range(3):
        store.put(batch(*((k, number, f"v{number}") for k in range(50))), number)
    files = store.lookup(1).inputFiles()
    assert len(files) == 1 and rows(store.lookup(1)) == [(1, 2, "v2")]
    plan = store.lookup(1)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "EqualTo(id,1)" in plan
    assert store.compact() > 0 and store.compact() == 0
    assert len(Folder(spark, f"{store.path}/data").names()) == 1
    assert store.lookup(1).inputFiles() == files and store.current().count() == 50


def test_a_stream_keeps_its_current_result_in_the_store(spark, batch):
    source = shared_path(spark, "in")
    for number in range(3):
        batch((1, number, f"v{number}"), (number, 0, "own")).coalesce(1).write.mode("append").parquet(source)
    store, checkpoint = new_store(spark), shared_path(spark, "checkpoint")
    stream = spark.readStream.schema(store.schema).option("maxFilesPerTrigger", 1).parquet(source)
    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda frame, number: store.put(frame, number))
    writer.trigger(availableNow=True).start().awaitTermination()
    assert rows(store.current().where(F.col("id") == 1)) == [(1, 2, "v2")] and store.manifest().batch == 2
