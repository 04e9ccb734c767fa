"""Text as an ordered, timed stream of lines (sentences) and words."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panewise.functions.clock import arrival_time
from panewise.functions.ids import content_id
from panewise.functions.text import line_array, line_count, unfold, words_of_length
from panewise.operators.numbering import Starts, bucket_starts, sum_before, with_offset

RATE = 100  # sentences per second
WORD_LENGTH = 5
# Lines, and bytes of text, whose words one task counts by window, where there are many: a few hundred
# thousand words in the windows of each, whatever the table.
WINDOW_LINES = 1 << 15
WINDOW_BYTES = 1 << 24


def _line_arrays(docs: DataFrame) -> DataFrame:
    """(doc_id, lines), cut where the text lies."""
    return docs.where("text IS NOT NULL").select("doc_id", line_array(F.col("text")).alias("lines"))


def text_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, line_no, text): the lines of each document, numbered from 0."""
    lines = unfold(_line_arrays(docs), ["doc_id"], F.col("lines"), "text", "line_no")
    return lines.select("doc_id", "line_no", "text")


def line_starts(docs: DataFrame) -> Starts:
    """How many lines come before each bucket of documents, how many there are in all, and how many bytes."""
    counts = docs.where("text IS NOT NULL").select(
        "doc_id", line_count(F.col("text")).alias("n_lines"), F.octet_length("text").alias("n_bytes")
    )
    return bucket_starts(counts, "doc_id", "n_lines", "n_bytes")


def window_tasks(starts: Starts) -> int | None:
    """Tasks that the words of so many lines are counted by window in; None if Spark may choose."""
    return starts.tasks(WINDOW_LINES, WINDOW_BYTES)


def _per_line(
    docs: DataFrame, name: str, value: Callable[[Column], Column], starts: Starts | None, since: int = 0
) -> DataFrame:
    """(doc_id, line_no, seq, name): one row per line, in global order.

    ``value`` turns the array of lines into an array with one element per line. It runs
    before the shuffle, so only what it keeps of the text travels.
    """
    rows = _line_arrays(docs).select(
        "doc_id", F.size("lines").alias("n_lines"), value(F.col("lines")).alias("values")
    )
    placed = with_offset(rows, "doc_id", "n_lines", "first_seq", starts or line_starts(docs), since)
    return unfold(placed, ["doc_id", "first_seq"], F.col("values"), name, "line_no").select(
        "doc_id", "line_no", (F.col("first_seq") + F.col("line_no")).alias("seq"), name
    )


def document_lines(docs: DataFrame, starts: Starts | None = None) -> DataFrame:
    """(doc_id, line_no, seq, text): all lines in order of (doc_id, line_no), ``seq`` from 0."""
    return _per_line(docs, "text", lambda lines: lines, starts)


def sentences(docs: DataFrame, rate: int = RATE, starts: Starts | None = None) -> DataFrame:
    """(seq, id, text, arrival_ts): the lines as a stream that brings ``rate`` of them a second."""
    return document_lines(docs, starts).select(
        "seq",
        content_id(F.col("doc_id"), F.col("line_no")).alias("id"),
        "text",
        arrival_time(F.col("seq"), rate).alias("arrival_ts"),
    )


def document_words(
    docs: DataFrame, size: int = WORD_LENGTH, rate: int = RATE, starts: Starts | None = None, since: int = 0
) -> DataFrame:
    """(seq, arrival_ts, word): the words of ``size`` characters, cut out before lines are numbered.

    Only lines from number ``since`` on are given; documents well before it are not read.
    """

    def kept(lines: Column) -> Column:
        return F.transform(lines, lambda line: words_of_length(line, size))

    words = _per_line(docs, "words", kept, starts, since)
    if since > 0:
        words = words.where(F.col("seq") >= since)
    return words.select("seq", arrival_time(F.col("seq"), rate).alias("arrival_ts"), F.explode("words").alias("word"))


def text_file_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, seq, text): the lines of text files, ``seq`` from 0 within each file.

    Files may be cut into splits. A split is read by one task from front to back, so a line's number
    there follows from Spark's running row id and the first one of its split. One row per split is
    counted and added up; the text stays where it was read unless there are too many splits to send
    to every task.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"),
        F.col("value").alias("text"),
    )
    splits = lines.groupBy("file", "block").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("total"))
    before = sum_before("total", Window.partitionBy("file").orderBy("block"))
    starts = splits.select("file", "block", (before - F.col("first")).alias("shift"))
    return lines.join(starts, ["file", "block"]).select("file", (F.col("id") + F.col("shift")).alias("seq"), "text")
