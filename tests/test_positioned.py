"""Row-bounded streams of numbered tables, recorded progress, very many templates."""

import duckdb
import pytest
from helpers import at, rows
from pyspark.sql import functions as F

from panewise.operators import rates
from panewise.operators.template_index import match_templates
from panewise.session import shared_path
from panewise.sources import fifo, positioned, replay
from panewise.streaming import progress, runs, sinks


@pytest.fixture(scope="module")
def stored(spark):
    table = spark.range(230).select(
        F.col("id").alias("seq"), F.concat(F.lit("t"), "id").alias("text"), F.timestamp_seconds("id").cast("timestamp_ntz").alias("ts")
    )
    return positioned.store_by_position(table, "seq", shared_path(spark, "numbered"), bucket_rows=100)


def sent(spark, stored, batch_rows, limit, out, checkpoint):
    stream = positioned.position_stream(spark, stored, batch_rows, limit)
    writer = sinks.per_batch(stream, out, checkpoint, lambda frame: frame)
    return runs.poll_until(writer, positioned.all_sent(limit or stored.rows), look=0.05)


def test_batches_are_bounded_by_rows_and_a_restart_goes_on(spark, stored):
    out, checkpoint = shared_path(spark, "out"), shared_path(spark, "checkpoint")
    first = sent(spark, stored, 50, 120, out, checkpoint)
    assert [p["numInputRows"] for p in first.recentProgress if p["numInputRows"]] == [50, 50, 20]
    again = sent(spark, stored, 50, 500, out, checkpoint)  # round and round
    assert {p["numInputRows"] for p in again.recentProgress if p["numInputRows"]} == {50, 30}
    found = spark.read.parquet(out).orderBy("position").collect()
    assert [r["position"] for r in found] == list(range(500))
    assert all(r["text"] == f"t{r['position'] % 230}" and r["ts"].timestamp() >= 0 for r in found)


def test_a_task_opens_only_the_buckets_of_its_rows(spark, stored):
    opened = []

    class Watched(positioned.PositionedReader):
        def _bucket(self, number):
            opened.append(number)
            return super()._bucket(number)

    options = {"path": stored.path, "rows": "230", "bucket_rows": "100", "batch_rows": "50", "limit": "1000"}
    reader = Watched(spark.range(0).select(F.col("id").alias("position"), F.lit("").alias("text")).schema, options)
    assert reader.latestOffset() == {"sent": 50} and reader.latestOffset() == {"sent": 100}
    for part, buckets in ((positioned.Range(0, 50), [0]), (positioned.Range(150, 210), [1, 2]), (positioned.Range(220, 240), [0, 2])):
        opened.clear()
        batches = list(reader.read(part))
        assert opened == buckets and sum(b.num_rows for b in batches) == part.end - part.start
    assert reader.partitions({"sent": 100}, {"sent": 350}) == [positioned.Range(100, 200), positioned.Range(200, 300), positioned.Range(300, 350)]


def test_fifo_stream_equals_fifo_batches(spark):
    events = spark.createDataFrame([(k * 3, "ab"[k % 2]) for k in range(130)], "event_id bigint, kind string")
    batched = fifo.fifo_batches(events, "event_id", 20, {"kind": "a"})
    kept = positioned.store_by_position(batched.drop("batch"), "position", shared_path(spark, "fifo"))
    out, checkpoint = shared_path(spark, "out"), shared_path(spark, "checkpoint")
    sent(spark, kept, 20, None, out, checkpoint)
    found = spark.read.schema("event_id bigint, position bigint, batch bigint").parquet(out)
    assert rows(found) == rows(batched.select("event_id", "position", "batch"))


def test_replay_by_seconds(spark, stored):
    stream = replay.stored_replay_stream(spark, stored, 600, rate=100, producers=2, seconds_per_batch=2)
    out, checkpoint = shared_path(spark, "out"), shared_path(spark, "checkpoint")
    query = runs.poll_until(sinks.append_stream(stream, out, checkpoint), positioned.all_sent(600), look=0.05)
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [200, 200, 200]
    lines = spark.range(230).select(F.col("id").alias("seq"), F.concat(F.lit("t"), "id").alias("text"))
    assert rows(spark.read.schema(stream.schema).parquet(out)) == rows(replay.cyclic_replay(lines, 230, 6, producers=2))


def test_an_empty_table_sends_nothing(spark, stored):
    none = positioned.store_by_position(
        spark.createDataFrame([], "seq bigint, text string"), "seq", shared_path(spark, "none")
    )
    assert none.rows == 0
    out, checkpoint = shared_path(spark, "out"), shared_path(spark, "checkpoint")
    writer = sinks.per_batch(positioned.position_stream(spark, none, 10), out, checkpoint, lambda frame: frame)
    query = runs.poll_until(writer, runs.idle_for(0.5))
    assert query.exception() is None


def test_progress_of_150_batches_is_150_rows(spark, stored):
    path, out, checkpoint = (shared_path(spark, name) for name in ("progress", "out", "checkpoint"))
    stream = positioned.position_stream(spark, stored, 2, 300).select("position")
    with progress.recorded(spark, path) as recorder:
        query = runs.poll_until(stream.writeStream.format("noop").option("checkpointLocation", checkpoint), positioned.all_sent(300), "0 seconds", 0.05)
        assert recorder.wait_for(query)
    found = progress.recorded_progress(spark, path, trigger_ms=0).where("rows > 0")
    assert [r["batch"] for r in found.orderBy("batch").collect()] == list(range(150))
    assert found.agg(F.sum("rows")).first()[0] == 300 and found.where("overrun").count() == 150
    assert len(query.recentProgress) < 150


def test_overruns_of_the_mean_read_their_input_once(spark):
    slots = spark.createDataFrame([(at(k), n) for k, n in enumerate([10, 10, 10, 50])], "slot timestamp_ntz, n bigint")
    assert rows(rates.overruns_of_mean(slots)) == [(at(3), 50, 20)]
    assert rates.overruns_of_mean(slots.limit(0)).count() == 0
    path = shared_path(spark, "slots")
    slots.write.parquet(path)
    plan = rates.overruns_of_mean(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


@pytest.mark.parametrize("sent_to_all", [100_000, 0])
def test_ten_thousand_templates_equal_duckdb(spark, sent_to_all):
    events = [(k, k % 97 or None, "xyz"[k % 3] if k % 5 else None, k % 11) for k in range(3000)]
    templates = [(f"s{k}", k % 101 if k % 2 else None, "xyzw"[k % 4] if k % 3 else None, k % 13 if k % 5 else None) for k in range(10_000)]
    df = spark.createDataFrame(events, "id bigint, a bigint, b string, c bigint")
    index = spark.createDataFrame(templates, "stream string, a bigint, b string, c bigint")
    found = match_templates(df, index, ["a", "b", "c"], sent_to_all=sent_to_all)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert found.columns == ["stream", "id", "a", "b", "c"] and len(plan) < 20_000 and plan.count("Join") == 1
    paths = {name: shared_path(spark, name) for name in ("events", "templates", "found")}
    for name, frame in (("events", df), ("templates", index), ("found", found.select("stream", "id"))):
        frame.write.parquet(paths[name])
    total = "select count(*), sum(hash(stream || ':' || id)::hugeint % 1000003)"
    read = {name: f"read_parquet('{path}/*.parquet')" for name, path in paths.items()}
    wanted = duckdb.execute(f"""{total}
        from {read["templates"]} t join {read["events"]} e on coalesce(t.a = e.a, t.a is null)
          and coalesce(t.b = e.b, t.b is null) and coalesce(t.c = e.c, t.c is null)""").fetchall()
    assert duckdb.execute(f"{total} from {read['found']}").fetchall() == wanted
    assert match_templates(df, index.limit(0), ["a", "b", "c"]).count() == 0
