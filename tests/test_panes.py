"""Pane rings, lists of every slide, sliding reductions, joined and united streams."""

import random
import time
from collections import Counter

import pytest
from helpers import T0, at, rows
from pyspark.sql import functions as F

from panewise.functions.clock import from_instant, to_instant
from panewise.functions.text import words_of_length
from panewise.operators import windows
from panewise.session import shared_path
from panewise.sources.streams import stream_source, union_live
from panewise.streaming import panes, runs, sinks

SENTENCES = "seq bigint, text string, arrival_ts timestamp_ntz"


def fed(spark, batches):
    """A stream of sentences [(second, text)], one micro-batch per list."""
    path = shared_path(spark, "in")
    for batch in batches:
        frame = spark.createDataFrame([(n, text, at(second)) for n, (second, text) in enumerate(batch)], SENTENCES)
        sinks.append(frame.withColumn("arrival_ts", to_instant(F.col("arrival_ts"))).coalesce(1), path)
        time.sleep(0.02)
    schema = spark.createDataFrame([], SENTENCES.replace("_ntz", "")).schema
    return stream_source(spark, path, schema, max_files=1)


def every_slide(spark, stream, delay="0 seconds", **settings):
    words = stream.withColumn("words", words_of_length(F.col("text"), 5))
    counts = panes.pane_ring_counts(words, "arrival_ts", "words", delay=delay, **settings)
    out, checkpoint = shared_path(spark, "out"), shared_path(spark, "checkpoint")
    with panes.timer_state(spark):
        query = runs.run_to_end(panes.every_slide_writer(counts, out, checkpoint))
    lists = sinks.stored_batches(spark, out).collect()
    found = {(r["window_end"] - T0).seconds: [(w["word"], w["count"]) for w in r["word_counts"]] for r in lists}
    assert len(found) == len(lists)
    return found, query


def brute(batches, last):
    counts = {end: Counter() for end in range(1, last + 1)}
    for second, text in (row for batch in batches for row in batch):
        for end in range(second + 1, second + 6):
            if end in counts:
                counts[end].update(w for w in (text or "").split(" ") if len(w) == 5)
    return {end: sorted(c.items(), key=lambda i: (-i[1], i[0]))[:10] for end, c in counts.items()}


def test_every_slide_has_a_list_and_quiet_ones_an_empty_one(spark):
    batches = [[(0, "alpha bravo"), (1, "alpha")], [(2, "bravo bravo"), (9, "delta")], [(14, "alpha")], [(40, None)]]
    found, query = every_slide(spark, fed(spark, batches))
    assert found == brute(batches, 40)
    assert found[8] == [] and found[30] == [] and found[14] == [("delta", 1)] and found[15] == [("alpha", 1)]
    # When all windows have closed, only the clock is left.
    assert query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] <= 2


def test_the_clock_passes_a_gap_of_many_slides(spark, monkeypatch):
    monkeypatch.setattr(panes, "MARKS", 7)
    batches = [[(0, "alpha")], [(100, "bravo")], [(120, None)]]
    found, _ = every_slide(spark, fed(spark, batches))
    assert found == brute(batches, 120)


def test_late_rows_count_for_windows_that_are_open(spark):
    batches = [[(0, "alpha")], [(9, "bravo")], [(7, "later"), (2, "worse")], [(30, None)]]
    found, _ = every_slide(spark, fed(spark, batches))
    late = [[(0, "alpha"), (9, "bravo")], [(30, None)]]
    expected = brute(late, 30)
    for end in (10, 11, 12):  # those that had closed at 9 have lost the row of second 7
        expected[end] = sorted([*expected[end], ("later", 1)], key=lambda i: (-i[1], i[0]))
    assert found == expected


def test_a_delay_keeps_windows_open(spark):
    batches = [[(0, "alpha")], [(9, "bravo")], [(7, "later"), (6, "worse")], [(40, None)]]
    found, _ = every_slide(spark, fed(spark, batches), delay="5 seconds")
    assert found == brute(batches, 35)


def test_rings_equal_window_state_with_fewer_rows(spark):
    rng = random.Random(3)
    words = ["alpha", "bravo", "delta", "gamma", "sigma", "omega", "kappa", "theta", "zetas", "ninth", "tenth", "elevn", "x"]
    batches = [[(s, " ".join(rng.choices(words, k=40))) for s in range(b * 8, b * 8 + 8) for _ in range(3)] for b in range(4)]
    batches.append([(31 + 5, None)])
    found, query = every_slide(spark, fed(spark, batches), shards=4)
    assert found == brute(batches, 36)
    rings = max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress)
    out, checkpoint = shared_path(spark, "out"), shared_path(spark, "checkpoint")
    counts = runs.sliding_word_counts_stream(fed(spark, batches))
    query = runs.run_to_end(runs.topk_writer(counts, out, checkpoint))
    ranked = sinks.stored_batches(spark, out).orderBy("rank").collect()
    assert all([(r["word"], r["count"]) for r in ranked if r["window_end"] == at(e)] == found[e] for e in range(1, 37))
    assert rings < max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress) / 2


def test_a_restarted_ring_goes_on(spark):
    batches = [[(0, "alpha")], [(1, "alpha bravo")], [(2, "bravo")], [(20, None)]]
    path, checkpoint, out = (shared_path(spark, name) for name in ("in", "checkpoint", "out"))
    schema = spark.createDataFrame([], SENTENCES.replace("_ntz", "")).schema
    for batch in batches:
        frame = spark.createDataFrame([(n, text, at(second)) for n, (second, text) in enumerate(batch)], SENTENCES)
        sinks.append(frame.withColumn("arrival_ts", to_instant(F.col("arrival_ts"))).coalesce(1), path)
        words = stream_source(spark, path, schema).withColumn("words", words_of_length(F.col("text"), 5))
        with panes.timer_state(spark):
            runs.run_to_end(panes.every_slide_writer(panes.pane_ring_counts(words, "arrival_ts", "words"), out, checkpoint))
    found = {
        (r["window_end"] - T0).seconds: [(w["word"], w["count"]) for w in r["word_counts"]]
        for r in sinks.stored_batches(spark, out).collect()
    }
    assert found == brute(batches, 20)


@pytest.mark.parametrize(("length", "slide", "keys"), [(300, 60, []), (7, 1, ["k"]), (60, 60, []), (4, 2, ["k"]), (600, 1, [])])
def test_sliding_reduce_equals_the_direct_form(spark, length, slide, keys):
    rng = random.Random(length)
    # Crowded and empty stretches, times before the epoch, null times and values.
    seconds = [rng.choice([rng.randrange(-900, 900), rng.randrange(0, 40), 5000 + rng.randrange(30)]) for _ in range(400)]
    data = [(at(s) if s % 11 else None, rng.choice(["a", "b", None]), rng.choice([None, rng.randrange(100)])) for s in seconds]
    data += [(T0.replace(year=1969, second=s), "a", s) for s in range(20)]
    df = spark.createDataFrame(data, "ts timestamp_ntz, k string, v bigint")
    values = {
        "n": (F.count(F.lit(1)), F.sum),
        "total": (F.sum("v"), F.sum),
        "least": (F.min("v"), F.min),
        "most": (F.max("v"), F.max),
        "either": (F.bit_or("v"), F.bit_or),
    }
    direct = [F.count(F.lit(1)).alias("n"), F.sum("v").alias("total"), F.min("v").alias("least"), F.max("v").alias("most")]
    columns = ["window_start", "window_end", *keys, *values]
    found = windows.sliding_reduce(df, "ts", values, length, slide, keys)
    wanted = windows.windowed_reduce(df, "ts", [*direct, F.bit_or("v").alias("either")], length, slide, keys)
    as_set = lambda frame: sorted(map(str, frame.select(columns).collect()))
    assert as_set(found) == as_set(wanted)
    assert windows.sliding_reduce(df.limit(0), "ts", values, length, slide, keys).count() == 0


def test_sliding_reduce_shuffles_panes_once(spark):
    df = spark.createDataFrame([(at(1), "a", 1)], "ts timestamp_ntz, k string, v bigint")
    found = windows.sliding_reduce(df, "ts", {"least": (F.min("v"), F.min)}, 300, 1, ["k"])
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning") == 2 and "Expand" not in plan  # the panes' counts, and the chunks


def test_joined_streams_lose_late_rows_and_drop_closed_state(spark):
    left = [[(0, "l"), (3, "l")], [(9, "l")], [(10, "l")], [(4, "late")], [(40, "l")]]
    right = [[(1, "r"), (3, "r")], [(8, "r")], [(11, "r")], [(9, "r")], [(40, "r")]]
    sides = [fed(spark, side).select(F.col("arrival_ts").alias("ts"), F.lit(1).alias("k")) for side in (left, right)]
    counts = ([F.count(F.lit(1)).alias("a")], [F.count(F.lit(1)).alias("b")])
    joined = windows.windowed_join_stream(*sides, "ts", counts, 5, 5, ["k"])
    out, checkpoint = shared_path(spark, "out"), shared_path(spark, "checkpoint")
    zoneless = joined.withColumn("window_start", from_instant(F.col("window_start"))).drop("window_end")
    query = runs.run_to_end(sinks.per_batch(zoneless, out, checkpoint, lambda frame: frame))
    # Time had come to 8 on both sides and closed the window from 0 when the row of second 4 came.
    found = rows(sinks.stored_batches(spark, out), "window_start", "a", "b")
    assert found == [(at(0), 2, 2), (at(5), 1, 2), (at(10), 1, 1)]
    assert sum(o["numRowsTotal"] for o in query.recentProgress[-1]["stateOperators"]) <= 2


@pytest.mark.parametrize("wait", [False, True])
def test_an_idle_stream_holds_time_back_only_if_it_is_waited_for(spark, wait):
    busy, idle = fed(spark, [[(0, "alpha")], [(1, "bravo"), (20, "delta")]]), fed(spark, [[]])
    whole = union_live("arrival_ts", busy, idle, wait_for_all=wait)
    counts = whole.groupBy(F.window("arrival_ts", "5 seconds").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    out, checkpoint = shared_path(spark, "out"), shared_path(spark, "checkpoint")
    runs.run_to_end(sinks.append_stream(counts.select("n"), out, checkpoint))
    found = rows(spark.read.schema("n bigint").parquet(out))
    assert found == ([] if wait else [(2,)])


def test_united_streams_hold_the_rows_of_all(spark):
    sides = [fed(spark, side) for side in ([[(0, "a"), (0, "a")]], [[(7, "b")]], [[(3, None)]])]
    out, checkpoint = shared_path(spark, "out"), shared_path(spark, "checkpoint")
    runs.run_to_end(sinks.append_stream(union_live("arrival_ts", *sides).select("text"), out, checkpoint))
    assert sorted(str(r["text"]) for r in spark.read.parquet(out).collect()) == ["None", "a", "a", "b"]
    with pytest.raises(ValueError):
        union_live("arrival_ts")


def test_neighbouring_panes_share_a_row_of_state():
    import pandas as pd

    calls, kept, timers = [], {}, []

    class Map:
        getValue = staticmethod(lambda key: calls.append("get") or kept.get(key))
        updateValue = staticmethod(lambda key, value: calls.append("put") or kept.update({key: value}))
        removeKey = staticmethod(kept.pop)
        keys = staticmethod(lambda: iter(list(kept)))

    class Value(list):
        exists, get, update, clear = list.__len__, lambda self: self[0], lambda self, v: self.__setitem__(slice(None), [v]), list.clear

    class At:
        getCurrentWatermarkInMs = staticmethod(lambda: 0)

    class Handle:
        getMapState, getValueState, registerTimer = (lambda *_: Map), (lambda *_: Value()), (lambda _, at: timers.append(at))

    ring = panes.PaneRing(5000, 1000, 10)
    ring.init(Handle())
    rows = pd.DataFrame({"pane": [1000 * k for k in range(640)] * 2, "word": ["abcde", "fghij"] * 640})
    list(ring.handleInputRows((1,), iter([rows]), At))
    assert len(kept) == 10 and calls.count("get") == calls.count("put") == 10 and timers == [999]
