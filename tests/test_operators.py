import json

import pytest
from helpers import at, rows
from pyspark.sql import functions as F

from panewise.functions.templates import demux, select_matching
from panewise.operators import latest, rates, topk
from panewise.sources import fifo, replay

COUNTS = "window_start timestamp_ntz, window_end timestamp_ntz, word string, count bigint"


def window(second, *counts):
    return [(at(second), at(second + 5), word, count) for word, count in counts]


def test_ties_are_ranked_by_word(spark):
    words = [(f"tie{n:02d}", 3) for n in range(12)]
    df = spark.createDataFrame(window(0, *reversed(words)) + window(1, ("é", 1), ("z", 1), ("Z", 1)), COUNTS)
    ranked = rows(topk.top_k_per_window(df), "window_start", "rank", "word")
    assert ranked == [(at(0), n + 1, words[n][0]) for n in range(10)] + [
        (at(1), 1, "Z"),
        (at(1), 2, "z"),
        (at(1), 3, "é"),
    ]
    assert [r["word"] for r in topk.top_k(df.where("count = 3"), 3).collect()] == ["tie00", "tie01", "tie02"]


def test_k_may_exceed_the_group_limit_of_spark(spark):
    df = spark.createDataFrame(window(0, *[(f"w{n:05d}", n) for n in range(3000)]), COUNTS)
    assert topk.top_k_per_window(df, 2000).count() == 2000


def test_weights(spark):
    df = spark.createDataFrame(window(0, ("a", 8), ("b", 2)) + window(1, ("c", 0)), COUNTS)
    assert rows(topk.with_weight(df), "word", "weight") == [("a", 100.0), ("b", 25.0), ("c", None)]


def test_lists_and_json(spark):
    df = spark.createDataFrame(window(0, ("beta", 1), ("alpha", 1), ('q"é', 5)), COUNTS)
    lists = topk.word_count_lists(topk.top_k_per_window(df))
    empty = lists.select("window_start", "window_end", F.lit(None).cast(topk.WORD_COUNTS).alias("word_counts"))
    texts = [r["json"] for r in topk.as_json(lists.unionByName(empty)).collect()]
    assert json.loads(texts[0]) == [
        {"word": 'q"é', "count": 5},
        {"word": "alpha", "count": 1},
        {"word": "beta", "count": 1},
    ]
    assert texts[1] == "[]"


def test_latest_version_wins(spark):
    df = spark.createDataFrame(
        [("a", 1, 5, "old"), ("a", 2, 1, "tie"), ("a", 2, 9, "new"), ("b", 1, 1, "only")],
        "key string, v bigint, id bigint, payload string",
    )
    assert rows(latest.latest_by_key(df, ["key"], ["v", "id"]), "key", "payload") == [("a", "new"), ("b", "only")]


def test_missing_snapshot_is_an_empty_list(spark):
    lists = topk.word_count_lists(
        topk.top_k_per_window(spark.createDataFrame(window(0, ("a", 1)) + window(1, ("b", 2)), COUNTS))
    )
    versions = latest.snapshot_versions(lists)
    assert [r["version"] for r in latest.lookup(versions).collect()] == [at(6)]
    assert latest.lookup(versions, 4).count() == 0
    found = {r["id"]: [tuple(w) for w in r["word_counts"]] for r in latest.lookup_or_empty(versions, [1, 4]).collect()}
    assert found == {1: [("b", 2)], 4: []}


def test_templates(spark):
    df = spark.createDataFrame([(1, "x", 1), (2, None, 1), (3, "y", 2)], "id bigint, kind string, user bigint")
    assert rows(select_matching(df, {"kind": "x", "user": None}), "id") == [(1,)]
    assert rows(select_matching(df, {}), "id") == [(1,), (2,), (3,)]
    assert rows(demux(df, {"x": {"kind": "x"}, "one": {"user": 1}, "none": {"kind": "q"}}), "stream", "id") == [
        ("one", 1),
        ("one", 2),
        ("x", 1),
    ]
    assert demux(df, {}).count() == 0


def test_fifo_reads(spark):
    df = spark.createDataFrame([(n * 1000, "ab"[n % 2]) for n in range(230)], "id bigint, kind string").repartition(4)
    batches = rows(fifo.fifo_batches(df, "id", 50, {"kind": "b"}), "id", "position", "batch")
    assert batches == [((2 * n + 1) * 1000, n, n // 50) for n in range(115)]
    assert rows(fifo.fifo_head(df, "id", {"kind": "b"}), "id") == [(1000,)]
    assert fifo.fifo_head(df, "id", {"kind": "none"}).count() == 0
    split = df.withColumn("reader", fifo.sub_stream(F.col("id"), 8))
    parts = [split.where(F.col("reader") == n).drop("reader") for n in range(8)]
    assert rows(fifo.union_streams(*parts)) == rows(df)
    assert fifo.union_streams(df, df).count() == 460


def test_replay_wraps_around(spark):
    lines = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "seq bigint, text string")
    sent = replay.cyclic_replay(lines, 3, seconds=4, rate=2)
    assert rows(sent, "position", "text", "arrival_ts") == [(n, "abc"[n % 3], at(n // 2)) for n in range(8)]
    twice = replay.cyclic_replay(lines, 3, seconds=4, rate=2, producers=2)
    assert rows(twice, "producer", "position") == [(p, n) for p in range(2) for n in range(8)]
    assert replay.cyclic_replay(lines, 3, seconds=0).count() == 0
    assert replay.cyclic_replay(lines, 3, seconds=1, rate=2).count() == 2


def test_rates(spark):
    df = spark.createDataFrame([(at(0),), (at(0),), (at(0),), (at(2),)], "ts timestamp_ntz")
    rate = rates.arrival_rate(df, "ts")
    assert rows(rate) == [(at(0), 3), (at(2), 1)]
    assert rows(rates.overruns(rate, 2)) == [(at(0), 3, 1)]
    assert rates.overruns(rate, 3).count() == 0


def test_settings_that_are_missing_raise(spark):
    from panewise.sources.streams import stream_source
    from panewise.sources.tables import table

    with pytest.raises(ValueError):
        table(spark, "", "events")
    with pytest.raises(ValueError):
        stream_source(spark, "", spark.range(1).schema)


def test_replay_of_few_lines_many_times(spark, monkeypatch):
    monkeypatch.setattr(replay, "BLOCK_CYCLES", 4)
    text = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "seq bigint, text string")
    sent = replay.cyclic_replay(text, 3, 20, rate=5)
    assert rows(sent, "position", "seq") == [(p, p % 3) for p in range(100)]
    monkeypatch.undo()
    huge = replay.cyclic_replay(text.limit(1), 1, 2**26, rate=100)
    assert huge.limit(10).count() == 10
