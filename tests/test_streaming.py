import time

from helpers import at, rows
from pyspark.sql import functions as F

from panewise.functions.clock import from_instant, to_instant
from panewise.operators import latest, topk, windows
from panewise.session import shared_path
from panewise.sources import replay
from panewise.sources.lines import sentences
from panewise.sources.streams import stream_source
from panewise.streaming import runs, sinks

SCHEMA = "seq bigint, text string, arrival_ts timestamp"


def one_row_per_file(spark, seconds, text="alpha"):
    path = shared_path(spark, "in")
    for n, second in enumerate(seconds):
        row = spark.createDataFrame([(n, text, at(second))], "seq bigint, text string, arrival_ts timestamp_ntz")
        sinks.append(row.withColumn("arrival_ts", to_instant(F.col("arrival_ts"))).coalesce(1), path)
        time.sleep(0.02)
    return path


def schema(spark):
    return spark.createDataFrame([], SCHEMA).schema


def test_late_rows(spark):
    path = one_row_per_file(spark, [0, 1, 2, 9, 3, 2])
    stream = stream_source(spark, path, schema(spark), max_files=1)
    out, checkpoint = shared_path(spark, "out"), shared_path(spark, "checkpoint")
    query = runs.run_to_end(runs.topk_writer(runs.sliding_word_counts_stream(stream), out, checkpoint))
    found = rows(sinks.stored_batches(spark, out), "window_end", "count")
    assert found == [(at(n + 1), c) for n, c in enumerate([1, 2, 3, 4, 4, 3, 2, 1])]
    progress = runs.progress_table(query, trigger_ms=-1)
    assert progress.agg(F.sum("rows")).first()[0] == 6
    assert progress.where("NOT overrun").count() == 0


def test_restart_continues_and_repeated_batch_changes_nothing(spark):
    path = one_row_per_file(spark, [0, 1])
    out, checkpoint = shared_path(spark, "out"), shared_path(spark, "checkpoint")

    def run():
        stream = stream_source(spark, path, schema(spark), max_files=1)
        runs.run_to_end(runs.topk_writer(runs.sliding_word_counts_stream(stream), out, checkpoint))
        return rows(sinks.stored_batches(spark, out), "window_end", "count")

    first = run()
    assert first == [(at(1), 1)] and run() == first
    late = spark.createDataFrame([(9, "alpha", at(3))], "seq bigint, text string, arrival_ts timestamp_ntz")
    sinks.append(late.withColumn("arrival_ts", to_instant(F.col("arrival_ts"))), path)
    assert run() == [(at(1), 1), (at(2), 2), (at(3), 2)]


def test_stream_equals_batch_on_closed_windows(spark):
    docs = spark.createDataFrame(
        [(n, "\n".join(f"word{(n * k) % 7} alpha beta{k % 3} x" for k in range(n % 5 + 1))) for n in range(300)],
        "doc_id bigint, text string",
    )
    batch = sentences(docs, rate=40)
    total = batch.count()
    path, out = shared_path(spark, "in"), shared_path(spark, "out")
    stored = batch.withColumn("arrival_ts", to_instant(F.col("arrival_ts")))
    checkpoint = shared_path(spark, "checkpoint")

    def writer():
        return runs.topk_writer(
            runs.sliding_word_counts_stream(stream_source(spark, path, stored.schema)),
            out,
            checkpoint,
            shape=lambda ranked: latest.snapshot_versions(topk.word_count_lists(ranked)),
            console=True,
        )

    runs.stream_slices(runs.in_slices(stored, "seq", total, 3), path, writer)
    assert rows(spark.read.parquet(path), "seq") == [(n,) for n in range(total)]
    words = batch.select("arrival_ts", F.explode(F.split("text", " ")).alias("word")).where("char_length(word) = 5")
    ranked = topk.top_k_per_window(windows.sliding_counts(words, "arrival_ts", ["word"]))
    expected = latest.snapshot_versions(topk.word_count_lists(ranked)).where(
        F.col("version") <= F.lit(batch.agg(F.max("arrival_ts")).first()[0])
    )
    as_json = ["id", "version", F.to_json("word_counts").alias("json")]
    assert rows(sinks.stored_batches(spark, out).select(*as_json)) == rows(expected.select(*as_json))


def test_template_on_a_polled_stream(spark):
    path = one_row_per_file(spark, [0, 1, 2])
    out = shared_path(spark, "out")
    stream = stream_source(spark, path, schema(spark), {"seq": 1}, max_files=1)
    runs.poll_until(sinks.append_stream(stream, out, shared_path(spark, "checkpoint")), runs.idle_for(2.0))
    assert rows(spark.read.schema(SCHEMA).parquet(out), "seq") == [(1,)]


def test_replay_stream_advances_by_the_second(spark):
    path, out = shared_path(spark, "lines"), shared_path(spark, "out")
    sinks.append(spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "seq bigint, text string"), path)
    stream = replay.cyclic_replay_stream(spark, spark.read.parquet(path), 3, rate=2)
    query = sinks.append_stream(stream, out, shared_path(spark, "checkpoint")).start()
    deadline = time.time() + 60
    while len(query.recentProgress) < 4 and time.time() < deadline:
        time.sleep(0.1)
    query.stop()
    found = rows(spark.read.parquet(out), "position", "text", "arrival_ts")
    assert len(found) >= 6
    assert found == [(n, "abc"[n % 3], at(n // 2)) for n in range(len(found))]


def test_instants_keep_the_time(spark):
    df = spark.createDataFrame([(at(0),), (at(0.123456),)], "ts timestamp_ntz")
    assert rows(df.select(from_instant(to_instant(F.col("ts"))).alias("ts"))) == rows(df)


def test_polling_waits_for_data_that_comes_later(spark):
    path, out = one_row_per_file(spark, [0]), shared_path(spark, "out")
    stream = stream_source(spark, path, schema(spark), {})
    looks, sent = [], []

    def stop(query):
        looks.append(query.lastProgress is not None and not query.status["isDataAvailable"])
        if looks.count(True) == 5 and not sent:
            sent.append(True)  # further looks may find no more than these five
            sinks.append(spark.createDataFrame([(9, 'late', at(9))], SCHEMA), path)
        return len(looks) > 400 or (looks.count(True) > 5 and spark.read.schema(SCHEMA).parquet(out).count() == 2)

    runs.poll_until(sinks.append_stream(stream, out, shared_path(spark, "checkpoint")), stop)
    assert rows(spark.read.schema(SCHEMA).parquet(out), "seq") == [(0,), (9,)]


def test_printing_takes_every_row(spark, capsys):
    sinks.print_rows(spark.range(3).select("id", F.when(F.col("id") == 1, "one").alias("name")))
    assert capsys.readouterr().out.splitlines() == ["id\tname", "0\t", "1\tone", "2\t"]


def test_no_batch_yet_is_an_empty_frame(spark):
    assert sinks.stored_batches(spark, shared_path(spark, "none"), "a int").columns == ["a"]
