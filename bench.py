"""Times the registered queries and prints one JSON line.

BENCH_SF_DIR  folder of the tables      (default /root/testdata/sf0.1)
BENCH_CPUS    local cores               (default 8)
BENCH_RUNS    runs per query, best kept (default 2, after one warm-up query)
BENCH_ONLY    comma-separated names     (default: all)
BENCH_LIVE    seconds of a live replay at 500 sentences/s, with a 1 s trigger (default 0: none)
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import functions as F

from panewise.functions.clock import to_instant
from panewise.functions.text import words_of_length
from panewise.plans.queries import QUERIES
from panewise.session import build_session, shared_path
from panewise.sources import lines, positioned, replay
from panewise.sources.tables import table
from panewise.streaming import panes, progress, runs


def seconds(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def live_triggers(spark, sf_dir: str, duration: int, rate: int = 500) -> dict[str, list[int]]:
    """Milliseconds and state rows per 1 s trigger of the flagship query on a live replay of the lines."""
    docs = table(spark, sf_dir, "documents")
    text = lines.document_lines(docs).select("seq", "text")
    stored = positioned.store_by_position(text, "seq", shared_path(spark, "lines"), bucket_rows=1 << 14)
    sentences = replay.stored_replay_stream(spark, stored, rate * duration, rate)
    words = sentences.select(
        to_instant(F.col("arrival_ts")).alias("arrival_ts"), words_of_length(F.col("text"), lines.WORD_LENGTH).alias("words")
    )
    path = shared_path(spark, "progress")
    spark.conf.set("spark.sql.shuffle.partitions", "4")  # a trigger's work is small
    with panes.timer_state(spark), progress.recorded(spark, path) as recorder:
        counts = panes.pane_ring_counts(words, "arrival_ts", "words", shards=8)
        writer = panes.ring_topk_writer(counts, shared_path(spark, "topk"), shared_path(spark, "checkpoint"))
        recorder.wait_for(runs.poll_until(writer, positioned.all_sent(rate * duration), "1 second"))
    seen = progress.recorded_progress(spark, path).where("rows > 0").orderBy("batch").collect()
    return {name: [row[name] for row in seen] for name in ("duration_ms", "state_rows")}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_RUNS", "2"))
    only = [name for name in os.environ.get("BENCH_ONLY", "").split(",") if name]
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds(QUERIES["windowed_topk"], spark, sf_dir)
    times = {}
    for name in only or QUERIES:
        times[name] = round(min(seconds(QUERIES[name], spark, sf_dir) for _ in range(repeats)), 3)
        print(name, times[name], file=sys.stderr, flush=True)
    result = {
        "metric": "total time of the registered queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    live = int(os.environ.get("BENCH_LIVE", "0"))
    if live:
        result["live"] = live_triggers(spark, sf_dir, live)
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
