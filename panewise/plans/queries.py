"""The registered queries: every operator on the driver's tables, over all of their rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.readwriter import DataStreamWriter

from panewise.functions.clock import arrival_time, from_instant, plus_seconds, to_instant
from panewise.functions.ids import content_id
from panewise.functions.templates import demux, select_matching
from panewise.functions.text import tokens, unfold, words_of_length
from panewise.operators import latest, numbering, rates, topk, windows
from panewise.operators.numbering import Starts
from panewise.operators.template_index import match_templates
from panewise.session import shared_path
from panewise.sources import fifo, lines, positioned, replay
from panewise.sources.streams import stream_source, union_live
from panewise.sources.tables import table, table_pattern
from panewise.streaming import panes, runs, sinks
from panewise.streaming.store import KeyedStore

HOUR = 3600
WINDOW = "window_start timestamp_ntz, window_end timestamp_ntz"
REPLAY_BATCHES = 12  # micro-batches of the replayed stream
READERS = 8  # competing readers: two receivers of four threads
STREAMS = {
    "all": {},
    "clicks": {"event_type": "click"},
    "user_7": {"user_id": 7},
    "user_7_clicks": {"event_type": "click", "user_id": 7},
}

Query = Callable[[SparkSession, str], DataFrame]


# --- text ---------------------------------------------------------------------------------


def lines_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.document_lines(table(spark, sf_dir, "documents"))


def assign_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = lines.text_lines(table(spark, sf_dir, "documents"))
    return text.select(content_id(F.col("doc_id"), F.col("line_no")).alias("id"), "doc_id", "line_no")


def tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = lines.text_lines(table(spark, sf_dir, "documents"))
    return unfold(text, ["doc_id", "line_no"], tokens(F.col("text")), "word", "word_no")


def five_char_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.document_words(table(spark, sf_dir, "documents"))


# --- sliding windows over words -------------------------------------------------------------


def _words(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Starts]:
    """The words, and where the lines that have them begin, which tells how many tasks they need."""
    docs = table(spark, sf_dir, "documents")
    starts = lines.line_starts(docs)
    return lines.document_words(docs, starts=starts), starts


def pane_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    words, starts = _words(spark, sf_dir)
    return windows.pane_counts(words, "arrival_ts", ["word"], partitions=starts.partitions)


def sliding_word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    words, starts = _words(spark, sf_dir)
    return windows.sliding_counts(words, "arrival_ts", ["word"], partitions=lines.window_tasks(starts))


def sliding_word_counts_panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    words, starts = _words(spark, sf_dir)
    panes_of_words = windows.pane_counts(words, "arrival_ts", ["word"], partitions=starts.partitions)
    tasks = lines.window_tasks(starts)
    return windows.sliding_counts_from_panes(panes_of_words, "arrival_ts", ["word"], partitions=tasks)


def windowed_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Few words repeat within a second at this rate, so panes would hardly be fewer rows.
    return topk.top_k_per_window(sliding_word_counts(spark, sf_dir))


def topk_last_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    starts = lines.line_starts(docs)
    last = max(starts.total - 1, 0) // lines.RATE  # second of the last sentence
    recent = lines.document_words(docs, starts=starts, since=max(last - 4, 0) * lines.RATE)
    counts = recent.groupBy("word").agg(F.count(F.lit(1)).alias("count"))
    return topk.top_k(counts)


def word_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    weighted = topk.with_weight(windowed_topk(spark, sf_dir))
    return weighted.withColumn("weight", F.round("weight", 6))


def topk_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.as_json(topk.word_count_lists(windowed_topk(spark, sf_dir)))


def global_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = lines.text_lines(table(spark, sf_dir, "documents"))
    words = unfold(text, [], words_of_length(F.col("text"), lines.WORD_LENGTH), "word")
    return topk.global_sort(words.groupBy("word").agg(F.count(F.lit(1)).alias("count")))


# --- the current result -----------------------------------------------------------------------


def _snapshot_store(spark: SparkSession, sf_dir: str) -> KeyedStore:
    """A store that has taken in the lists of all windows, in two batches."""
    docs = table(spark, sf_dir, "documents")
    starts = lines.line_starts(docs)
    words = lines.document_words(docs, starts=starts)
    counts = windows.sliding_counts(words, "arrival_ts", ["word"], partitions=lines.window_tasks(starts))
    path = shared_path(spark, "versions")
    sinks.append(latest.snapshot_versions(topk.word_count_lists(topk.top_k_per_window(counts))), path)
    versions = spark.read.parquet(path)
    store = KeyedStore(spark, shared_path(spark, "snapshots"), versions.schema, ["id"], ["version"])
    half = arrival_time(F.lit(starts.total // 2), lines.RATE)
    store.put(versions.where(F.col("version") < half), 0)
    store.put(versions.where(F.col("version") >= half), 1)
    return store


def latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    current = _snapshot_store(spark, sf_dir).lookup(latest.SNAPSHOT_ID)
    return current.select("id", "version", F.to_json("word_counts").alias("json"))


def snapshot_or_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, keys = _snapshot_store(spark, sf_dir), [latest.SNAPSHOT_ID, latest.SNAPSHOT_ID + 1]
    found = latest.lookup_or_empty(fifo.union_streams(*map(store.lookup, keys)), keys)
    return found.select("id", F.to_json("word_counts").alias("json"))


def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    store = KeyedStore(spark, shared_path(spark, "latest"), events.schema, ["user_id"], ["ts", "event_id"])
    clicks = F.col("event_type").eqNullSafe("click")
    store.put(events.where(clicks), 0)
    store.put(events.where(~clicks), 1)
    return store.current()


# --- templates, ordered reads, replay -----------------------------------------------------------


def template_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select_matching(table(spark, sf_dir, "events"), STREAMS["clicks"])


def demux_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    return demux(events, STREAMS)


def fifo_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    return fifo.fifo_batches(events, "event_id", template=STREAMS["clicks"])


def fifo_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    matching = numbering.with_position(select_matching(events, STREAMS["user_7"]), "event_id", "position")
    stored = positioned.store_by_position(matching.drop("user_id"), "position", shared_path(spark, "fifo"))
    out = shared_path(spark, "read")
    stream = positioned.position_stream(spark, stored, fifo.BATCH_SIZE)
    writer = sinks.per_batch(stream, out, shared_path(spark, "checkpoint"), lambda frame: frame)
    runs.poll_until(writer, positioned.all_sent(stored.rows), look=0.05)
    # Which micro-batch brought a row is in the folder that it was written to.
    schema = "position bigint, event_id bigint, event_type string, value double, batch bigint"
    return spark.read.schema(schema).parquet(out) if stored.rows else spark.createDataFrame([], schema)


def template_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every type, every user and every type of every user as a template, and one that sets nothing."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "user_id")
    told = [F.coalesce(F.col(field).cast("string"), F.lit("*")) for field in ("event_type", "user_id")]
    templates = events.cube("event_type", "user_id").agg(F.grouping_id().alias("_open"))
    # A null that cube put there leaves a field open; one from a record would match nothing.
    meant = (F.col("event_type").isNotNull() | (F.col("_open") >= 2)) & (F.col("user_id").isNotNull() | (F.col("_open") % 2 == 1))
    named = templates.where(meant).select(F.concat_ws(":", *told).alias("stream"), "event_type", "user_id")
    return match_templates(events, named, ["event_type", "user_id"]).select("stream", "event_id")


def fifo_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fifo.fifo_head(table(spark, sf_dir, "events"), "event_id", STREAMS["user_7_clicks"])


def substreams_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    return events.withColumn("reader", fifo.sub_stream(F.col("event_id"), READERS))


def union_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select(
        F.lit("documents").alias("origin"), F.col("doc_id").alias("id"), F.lit(0).cast("bigint").alias("part"), "text"
    )
    conversations = table(spark, sf_dir, "conversations").select(
        F.lit("conversations").alias("origin"), F.col("conv_id").alias("id"), F.col("turn").alias("part"), "text"
    )
    return fifo.union_streams(documents, conversations)


def _replay_seconds(line_count: int) -> int:
    """Long enough to send every line twice and about half of them a third time."""
    return line_count * 5 // 2 // lines.RATE + 1


def cyclic_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    starts = lines.line_starts(docs)
    text = lines.document_lines(docs, starts)
    return replay.cyclic_replay(text, starts.total, _replay_seconds(starts.total), producers=2)


def cyclic_replay_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    starts = lines.line_starts(docs)
    text = lines.document_lines(docs, starts).select("seq", "text")
    stored = positioned.store_by_position(text, "seq", shared_path(spark, "lines"), bucket_rows=1 << 14)
    seconds, out = _replay_seconds(starts.total), shared_path(spark, "replay")
    limit = seconds * lines.RATE if starts.total else 0
    stream = replay.stored_replay_stream(spark, stored, limit, seconds_per_batch=-(-seconds // REPLAY_BATCHES))
    writer = sinks.append_stream(stream, out, shared_path(spark, "checkpoint"))
    runs.poll_until(writer, positioned.all_sent(limit), look=0.05)
    return spark.read.schema(stream.schema).parquet(out)


# --- events -----------------------------------------------------------------------------------


def sliding_event_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    panes = windows.pane_counts(table(spark, sf_dir, "events"), "ts", ["event_type"], HOUR)
    return windows.sliding_counts_from_panes(panes, "ts", ["event_type"], 5 * HOUR, HOUR)


def sliding_counts_with_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("ts")
    panes = windows.pane_counts(events, "ts", [], 60)
    counts = windows.sliding_counts_from_panes(panes, "ts", [], 300, 60)
    return windows.fill_empty_windows(counts, windows.all_windows(events, "ts", 300, 60), 300)


def arrival_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates.arrival_rate(table(spark, sf_dir, "events"), "ts", 60)


def overrun_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    hourly = rates.arrival_rate(table(spark, sf_dir, "events"), "ts", HOUR)
    return rates.overruns_of_mean(hourly)


def windowed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    return windows.windowed_rows(events, "ts", 5 * HOUR, HOUR)


def windowed_reduce(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Summing ten decimals exactly makes the result independent of row order.
    values = [
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("value").cast("decimal(28,10)")).cast("double").alias("total"),
        F.min("value").alias("least"),
        F.max("value").alias("most"),
    ]
    return windows.windowed_reduce(table(spark, sf_dir, "events"), "ts", values, 5 * HOUR, HOUR)


def sliding_reduce(spark: SparkSession, sf_dir: str) -> DataFrame:
    exact = F.col("value").cast("decimal(28,10)")
    values = {
        "n": (F.count(F.lit(1)), F.sum),
        "total": (F.sum(exact), F.sum),
        "least": (F.min("value"), F.min),
        "most": (F.max("value"), F.max),
    }
    # 300 panes a window.
    reduced = windows.sliding_reduce(table(spark, sf_dir, "events"), "ts", values, 5 * HOUR, 60)
    return reduced.withColumn("total", F.col("total").cast("double"))


def topk_every_slide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three most frequent types of event of five minutes, every minute, quiet ones included."""
    events = table(spark, sf_dir, "events").select("ts", F.col("event_type").alias("word"))
    known = events.where("word IS NOT NULL")
    counts = windows.sliding_counts_from_panes(windows.pane_counts(known, "ts", ["word"], 60), "ts", ["word"], 300, 60)
    spine = windows.all_windows(events, "ts", 300, 60).select(
        "window_start",
        plus_seconds(F.col("window_start"), 300).alias("window_end"),
        F.lit(None).cast("string").alias("word"),
        F.lit(0).cast("bigint").alias("count"),
    )
    return topk.as_json(panes.lists_of_every_slide(counts.unionByName(spine), 3))


def windowed_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("ts", "user_id", "event_type")

    def hourly(kind: str, name: str) -> DataFrame:
        rows = select_matching(events, {"event_type": kind})
        return windows.windowed_reduce(rows, "ts", [F.count(F.lit(1)).alias(name)], HOUR, HOUR, ["user_id"])

    return windows.join_windowed(hourly("view", "views"), hourly("purchase", "purchases"), ["user_id"])


# --- streams ------------------------------------------------------------------------------------


def append_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    path = shared_path(spark, "appended")
    clicks = F.col("event_type").eqNullSafe("click")
    sinks.append(events.where(clicks), path)
    sinks.append(events.where(~clicks), path)
    return spark.read.parquet(path)


def stream_source_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    stream = stream_source(spark, table_pattern(sf_dir, "events"), schema, {"event_type": "purchase"})
    path = shared_path(spark, "streamed")
    runs.run_to_end(sinks.append_stream(stream, path, shared_path(spark, "checkpoint")))
    return spark.read.parquet(path)


def poll_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "conversations").schema
    stream = stream_source(spark, table_pattern(sf_dir, "conversations"), schema, {"role": "user"}, max_files=1)
    path = shared_path(spark, "polled")
    runs.poll_until(sinks.append_stream(stream, path, shared_path(spark, "checkpoint")), runs.idle_for(2.0))
    return spark.read.parquet(path)


StreamWriter = Callable[[DataFrame, str, str], DataStreamWriter]


def _streamed_topk(spark: SparkSession, sf_dir: str, rank: StreamWriter, schema: str) -> DataFrame:
    """Feed the sentences in slices, rank every closed window as the stream goes, read what was stored."""
    docs = table(spark, sf_dir, "documents")
    starts = lines.line_starts(docs)
    sentences = lines.sentences(docs, starts=starts).withColumn("arrival_ts", to_instant(F.col("arrival_ts")))
    source, out, checkpoint = (shared_path(spark, name) for name in ("sentences", "topk", "checkpoint"))

    def writer() -> DataStreamWriter:
        return rank(stream_source(spark, source, sentences.schema), out, checkpoint)

    runs.stream_slices(runs.in_slices(sentences, "seq", starts.total), source, writer)
    if starts.total:
        # One row without text, a window's length after the last, closes the windows that are still open.
        end = (starts.total - 1) // lines.RATE + runs.WINDOW_LENGTH
        closing = spark.range(1, numPartitions=1).select(
            F.lit(starts.total).cast("bigint").alias("seq"),
            F.lit(None).cast("string").alias("id"),
            F.lit(None).cast("string").alias("text"),
            to_instant(arrival_time(F.lit(end * lines.RATE), lines.RATE)).alias("arrival_ts"),
        )
        runs.stream_slices(iter([closing]), source, writer)
    return sinks.stored_batches(spark, out, schema)


def sliding_topk_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    def writer(stream: DataFrame, out: str, checkpoint: str) -> DataStreamWriter:
        words = stream.withColumn("words", words_of_length(F.col("text"), lines.WORD_LENGTH))
        return panes.ring_topk_writer(panes.pane_ring_counts(words, "arrival_ts", "words"), out, checkpoint)

    with panes.timer_state(spark):
        return _streamed_topk(spark, sf_dir, writer, f"{WINDOW}, rank bigint, word string, count bigint")


def foreach_batch_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    def writer(stream: DataFrame, out: str, checkpoint: str) -> DataStreamWriter:
        counts = runs.sliding_word_counts_stream(stream)
        shape = lambda ranked: latest.snapshot_versions(topk.word_count_lists(ranked))
        return runs.topk_writer(counts, out, checkpoint, shape=shape)

    versions = _streamed_topk(spark, sf_dir, writer, f"id int, version timestamp_ntz, word_counts {topk.WORD_COUNTS}")
    return versions.select("id", "version", F.to_json("word_counts").alias("json"))


def _streamed_events(
    spark: SparkSession, events: DataFrame, length: int, closing: list[str], rank: StreamWriter, schema: str
) -> DataFrame:
    """Feed events in order of time, in two slices, and a row per type of ``closing`` that closes the last windows."""
    timed = events.where("ts IS NOT NULL").withColumn("ts", to_instant(F.col("ts")))
    ranked = numbering.with_rank(timed, [F.asc("ts"), F.asc("event_id")], "seq").withColumn("seq", F.col("seq") - 1)
    total, last = timed.agg(F.count("ts"), F.max(F.unix_seconds("ts"))).first()
    source, out, checkpoint = (shared_path(spark, name) for name in ("events", "out", "checkpoint"))

    def writer() -> DataStreamWriter:
        return rank(stream_source(spark, source, ranked.schema), out, checkpoint)

    runs.stream_slices(runs.in_slices(ranked, "seq", total), source, writer)
    if total:
        end = F.timestamp_seconds(F.lit(last // HOUR * HOUR + length))
        row = [(end if f.name == "ts" else F.lit(None)).cast(f.dataType).alias(f.name) for f in ranked.schema.fields]
        rows = spark.range(1, numPartitions=1).select(*row)
        kinds = F.explode(F.lit(closing).cast("array<string>"))
        runs.stream_slices(iter([rows.withColumn("event_type", kinds)]), source, writer)
    return sinks.stored_batches(spark, out, schema)


def topk_every_slide_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three most frequent types of one user's events of five hours, every hour, quiet ones included."""
    events = select_matching(table(spark, sf_dir, "events"), STREAMS["user_7"]).select("event_id", "ts", "event_type")

    def writer(stream: DataFrame, out: str, checkpoint: str) -> DataStreamWriter:
        kinds = stream.withColumn("words", F.when(F.col("event_id").isNotNull(), F.array("event_type")))
        counts = panes.pane_ring_counts(kinds, "ts", "words", 5 * HOUR, HOUR, k=3)
        return panes.every_slide_writer(counts, out, checkpoint, 3, topk.as_json)

    with panes.timer_state(spark):
        return _streamed_events(spark, events, 5 * HOUR, ["closing"], writer, f"{WINDOW}, json string")


def windowed_join_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")

    def writer(stream: DataFrame, out: str, checkpoint: str) -> DataStreamWriter:
        sides = [select_matching(stream, {"event_type": kind}).select("ts", "user_id") for kind in ("view", "purchase")]
        counts = [[F.count(F.lit(1)).alias(name)] for name in ("views", "purchases")]
        joined = windows.windowed_join_stream(*sides, "ts", tuple(counts), HOUR, HOUR, ["user_id"])
        zoneless = {name: from_instant(F.col(name)) for name in ("window_start", "window_end")}
        return sinks.per_batch(joined.withColumns(zoneless), out, checkpoint, lambda frame: frame)

    schema = f"{WINDOW}, user_id bigint, views bigint, purchases bigint"
    return _streamed_events(spark, events, HOUR, ["view", "purchase"], writer, schema)


def union_live_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views and purchases as two streams, counted together per hour; a third one only moves time on."""
    events = table(spark, sf_dir, "events")
    schema = events.select("ts", "event_type").schema
    pattern, beat = table_pattern(sf_dir, "events"), shared_path(spark, "heartbeat")
    end = events.agg(plus_seconds(F.max("ts"), 2 * HOUR).alias("ts")).withColumn("event_type", F.lit(None).cast("string"))
    sinks.append(end.where("ts IS NOT NULL"), beat)
    kinds = [stream_source(spark, pattern, schema, {"event_type": kind}) for kind in ("view", "purchase")]
    streams = [s.withColumn("ts", to_instant(F.col("ts"))) for s in (*kinds, stream_source(spark, beat, schema))]
    whole = union_live("ts", *streams)
    counts = whole.groupBy(F.window("ts", f"{HOUR} seconds").alias("w")).agg(F.count("event_type").alias("n"))
    slots = counts.where("n > 0").select(from_instant(F.col("w.start")).alias("slot"), "n")
    out = shared_path(spark, "united")
    runs.run_to_end(sinks.append_stream(slots, out, shared_path(spark, "checkpoint")))
    return spark.read.schema(slots.schema).parquet(out)


QUERIES: dict[str, Query] = {
    "lines_source": lines_source,
    "cyclic_replay": cyclic_replay,
    "cyclic_replay_stream": cyclic_replay_stream,
    "stream_source": stream_source_query,
    "fifo_batches": fifo_batches,
    "poll_source": poll_source,
    "fifo_head": fifo_head,
    "latest_snapshot": latest_snapshot,
    "snapshot_or_empty": snapshot_or_empty,
    "substreams_split": substreams_split,
    "append_sink": append_sink,
    "upsert_latest": upsert_latest,
    "foreach_batch_topk": foreach_batch_topk,
    "topk_json": topk_json,
    "tokenize": tokenize,
    "five_char_words": five_char_words,
    "template_match": template_match,
    "demux_templates": demux_templates,
    "assign_ids": assign_ids,
    "sliding_word_counts": sliding_word_counts,
    "pane_counts": pane_counts,
    "sliding_word_counts_panes": sliding_word_counts_panes,
    "arrival_rate": arrival_rate,
    "overrun_report": overrun_report,
    "sliding_event_counts": sliding_event_counts,
    "sliding_counts_with_empty": sliding_counts_with_empty,
    "windowed_topk": windowed_topk,
    "word_weights": word_weights,
    "global_sort": global_sort,
    "topk_last_window": topk_last_window,
    "union_streams": union_streams,
    "sliding_topk_stream": sliding_topk_stream,
    "windowed_join": windowed_join,
    "windowed_reduce": windowed_reduce,
    "windowed_rows": windowed_rows,
    "fifo_stream": fifo_stream,
    "template_index": template_index,
    "sliding_reduce": sliding_reduce,
    "topk_every_slide": topk_every_slide,
    "topk_every_slide_stream": topk_every_slide_stream,
    "windowed_join_stream": windowed_join_stream,
    "union_live": union_live_query,
}
