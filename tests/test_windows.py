import datetime as dt
import random
from collections import Counter

import pytest
from helpers import at, rows
from pyspark.sql import functions as F

from panewise.functions.clock import from_instant, to_instant
from panewise.operators import windows

SCHEMA = "ts timestamp_ntz, word string"
EPOCH = dt.datetime(1970, 1, 1)


def brute_counts(data, length, slide):
    counts = Counter()
    for ts, *key in data:
        second = int((ts - EPOCH).total_seconds() // 1)
        last = second // slide * slide
        for start in range(last - length + slide, last + 1, slide):
            counts[(EPOCH + dt.timedelta(seconds=start), EPOCH + dt.timedelta(seconds=start + length), *key)] += 1
    return sorted((*window, count) for window, count in counts.items())


def random_events(hot):
    rng = random.Random(7)
    base = [dt.datetime(2024, 1, 1), dt.datetime(1969, 12, 31, 23, 59, 30)]
    data = []
    for _ in range(1500):
        ts = rng.choice(base) + dt.timedelta(seconds=rng.randrange(400), microseconds=rng.randrange(10**6))
        data.append((at(3) if rng.random() < hot else ts, "hot" if rng.random() < hot else f"w{rng.randrange(40)}"))
    return data


@pytest.mark.parametrize("length, slide", [(5, 1), (1, 1), (60, 20), (100, 1), (7, 7)])
@pytest.mark.parametrize("hot", [0.0, 0.4])
def test_both_forms_equal_brute_force(spark, length, slide, hot):
    data = random_events(hot)
    df = spark.createDataFrame(data, SCHEMA).repartition(4)
    expected = brute_counts(data, length, slide)
    assert rows(windows.sliding_counts(df, "ts", ["word"], length, slide)) == expected
    panes = windows.pane_counts(df, "ts", ["word"], slide)
    assert rows(windows.sliding_counts_from_panes(panes, "ts", ["word"], length, slide)) == expected


def test_forms_agree_on_zoned_time(spark):
    df = spark.createDataFrame(random_events(0.2), SCHEMA).withColumn("ts", F.col("ts").cast("timestamp"))
    one = windows.sliding_counts(df, "ts", ["word"])
    two = windows.sliding_counts_from_panes(windows.pane_counts(df, "ts", ["word"]), "ts", ["word"])
    assert one.dtypes == two.dtypes and rows(one) == rows(two)


def test_without_key_and_null_time(spark):
    df = spark.createDataFrame([(at(0), "a"), (at(0), "b"), (None, "c")], SCHEMA)
    panes = windows.pane_counts(df, "ts", [])
    counts = windows.sliding_counts_from_panes(panes, "ts", [])
    assert rows(counts) == [(at(n), at(n + 5), 2) for n in range(-4, 1)]


@pytest.mark.parametrize("length, slide", [(5, 2), (0, 1), (5, 0), (3, 5)])
def test_length_must_be_a_multiple_of_the_slide(spark, length, slide):
    df = spark.createDataFrame([(at(0), "a")], SCHEMA)
    with pytest.raises(ValueError):
        windows.sliding_counts(df, "ts", ["word"], length, slide)


def test_gap_is_filled_with_zero(spark):
    df = spark.createDataFrame([(at(0), "a"), (at(20), "b")], SCHEMA)
    counts = windows.sliding_counts(df, "ts", [])
    assert counts.count() == 10
    filled = windows.fill_empty_windows(counts, windows.all_windows(df, "ts"))
    assert rows(filled) == [(at(n), at(n + 5), 0 if 1 <= n <= 15 else 1) for n in range(-4, 21)]


def test_no_rows_have_no_windows(spark):
    df = spark.createDataFrame([], SCHEMA)
    counts = windows.sliding_counts(df, "ts", [])
    assert windows.fill_empty_windows(counts, windows.all_windows(df, "ts")).count() == 0


def test_rows_and_reduction_of_windows(spark):
    df = spark.createDataFrame([(at(0), "a"), (at(2), "b")], SCHEMA)
    each = windows.windowed_rows(df, "ts", 4, 2)
    assert rows(each, "window_start", "word") == [(at(-2), "a"), (at(0), "a"), (at(0), "b"), (at(2), "b")]
    reduced = windows.windowed_reduce(df, "ts", [F.max("word").alias("last")], 4, 2)
    assert rows(reduced) == [(at(-2), at(2), "a"), (at(0), at(4), "b"), (at(2), at(6), "b")]


def test_join_of_reduced_streams_is_one_to_one(spark):
    left = spark.createDataFrame([(at(0), "a")] * 50 + [(at(1), "b")], SCHEMA)
    right = spark.createDataFrame([(at(0), "a")] * 70 + [(at(9), "b")], SCHEMA)
    sides = [
        windows.windowed_reduce(df, "ts", [F.count(F.lit(1)).alias(name)], 1, 1, ["word"])
        for df, name in ((left, "n_left"), (right, "n_right"))
    ]
    assert rows(windows.join_windowed(*sides, ["word"])) == [(at(0), at(1), "a", 50, 70)]


@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin"])
def test_session_zone_does_not_matter(spark, zone):
    # 02:30 on this day does not exist in Berlin.
    times = [dt.datetime(2024, 3, 31, 2, 30, n) for n in (0, 3)] + [dt.datetime(2024, 7, 1, 12)]
    data = [(ts, "a") for ts in times]
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame(data, SCHEMA)
        panes = windows.pane_counts(df, "ts", ["word"])
        assert rows(windows.sliding_counts_from_panes(panes, "ts", ["word"])) == brute_counts(data, 5, 1)
        assert windows.all_windows(df.where("ts < '2024-04-01'"), "ts").count() == 8
        zoned = df.withColumn("ts", to_instant(F.col("ts")))
        assert rows(zoned.select(from_instant(F.col("ts")).alias("ts"))) == [(ts,) for ts in times]
        one = windows.sliding_counts(zoned, "ts", ["word"])
        two = windows.sliding_counts_from_panes(windows.pane_counts(zoned, "ts", ["word"]), "ts", ["word"])
        assert rows(one) == rows(two)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_tasks_are_as_many_as_the_rows_ask_for(spark, monkeypatch):
    from panewise.operators import numbering
    from panewise.sources import lines

    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("seven words\nabcde fghij abcde\n").alias("text"))
    one = windows.sliding_counts(lines.document_words(docs), "arrival_ts", ["word"])
    monkeypatch.setattr(numbering, "TASK_WEIGHT", 300)
    starts = lines.line_starts(docs)
    assert starts.partitions == 20
    words = lines.document_words(docs, starts=starts)
    many = windows.sliding_counts(words, "arrival_ts", ["word"], partitions=20)
    panes = windows.pane_counts(words, "arrival_ts", ["word"], partitions=20)
    assert [df.rdd.getNumPartitions() for df in (words, panes, many)] == [20, 20, 20]
    from_panes = windows.sliding_counts_from_panes(panes, "arrival_ts", ["word"], partitions=20)
    assert rows(one) == rows(many) == rows(from_panes) and one.dtypes == many.dtypes == from_panes.dtypes


@pytest.mark.parametrize("limit", ["WINDOW_LINES", "WINDOW_BYTES"])
def test_tasks_of_word_windows_follow_lines_and_bytes(spark, monkeypatch, tmp_path, limit):
    from panewise.plans import queries
    from panewise.sources import lines

    text = "abcde fghij abcde\nklmno\n" if limit == "WINDOW_LINES" else "abcde fghij abcde klmno "  # 24 bytes
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.lit(text).alias("text"))
    docs.unionByName(docs.limit(1).select(F.lit(500).cast("bigint").alias("doc_id"), F.lit(None).cast("string").alias("text"))).write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    wanted = rows(queries.sliding_word_counts(spark, str(tmp_path)))
    top = rows(queries.windowed_topk(spark, str(tmp_path)))
    monkeypatch.setattr(lines, limit, 100 if limit == "WINDOW_LINES" else 1_000)
    starts = lines.line_starts(docs)
    tasks = 10 if limit == "WINDOW_LINES" else 12
    assert starts.partitions is None and lines.window_tasks(starts) == tasks
    for query in (queries.sliding_word_counts, queries.sliding_word_counts_panes):
        found = query(spark, str(tmp_path))
        assert found.rdd.getNumPartitions() == tasks and rows(found) == wanted
    assert rows(queries.windowed_topk(spark, str(tmp_path))) == top
