"""Column expressions that cut text into lines and words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def line_array(text: Column) -> Column:
    """The lines of a text, ended by LF, CR LF or CR.

    As with any line reader, an end mark after the last line opens no further line,
    so an empty text has no line at all.
    """
    # A pattern of one character is not run as a regular expression.
    pieces = F.when(F.contains(text, F.lit("\r")), F.split(text, "\r\n|\r|\n")).otherwise(F.split(text, "\n"))
    last_is_empty = F.endswith(text, F.lit("\n")) | F.endswith(text, F.lit("\r")) | (text == "")
    return F.when(last_is_empty, F.slice(pieces, F.lit(1), F.size(pieces) - 1)).otherwise(pieces)


def line_count(text: Column) -> Column:
    """``size(line_array(text))``, without cutting texts that end their lines with LF only."""
    ends = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit("")))
    closed = (text == "") | F.endswith(text, F.lit("\n"))
    by_size = F.size(line_array(text))
    return F.when(F.contains(text, F.lit("\r")), by_size).otherwise(ends + (~closed).cast("int"))


def tokens(line: Column) -> Column:
    """The pieces between single spaces. Empty pieces stay, but those at the end are dropped.

    An empty line is one empty piece; a line of spaces only has no piece.
    """
    trimmed = F.rtrim(line)
    return (
        F.when(line == "", F.array(F.lit("")))
        .when(trimmed == "", F.array().cast("array<string>"))
        .otherwise(F.split(trimmed, " "))
    )


def utf16_length(word: Column) -> Column:
    """Length in UTF-16 units: a character above U+FFFF counts twice."""
    return F.shiftright(F.octet_length(F.encode(word, "UTF-16BE")), 1)


def has_length(word: Column, size: int) -> Column:
    """True for words of ``size`` UTF-16 units.

    Most words are told apart by their bytes, whose number is known: a unit takes one to
    three. Only words that may hold a character above U+FFFF pay for the encoding: it takes
    four bytes and two units, so a word of ``size`` units with one has ``size + 2`` bytes or more.
    """
    size_in_bytes = F.octet_length(word)
    return (
        F.when((size_in_bytes < size) | (size_in_bytes > 3 * size), False)
        .when(size_in_bytes < size + 2, F.char_length(word) == size)
        .otherwise((F.char_length(word) <= size) & (utf16_length(word) == size))
    )


def words_of_length(line: Column, size: int) -> Column:
    """The pieces of ``size`` units, filtered inside the array so that only they are exploded."""
    return F.filter(F.split(line, " "), lambda word: has_length(word, size))


def unfold(df: DataFrame, keep: list[str], array: Column, name: str, position: str | None = None) -> DataFrame:
    """One row per element of ``array``, with its 0-based ``position`` if asked for.

    Rows without elements are dropped after the unfolding. The plain ``explode`` makes
    Spark test the array's size first, that is, cut every text twice.
    """
    unfolded = df.select(*keep, F.posexplode_outer(array).alias("_at", name)).where("_at IS NOT NULL")
    if position is None:
        return unfolded.select(*keep, name)
    return unfolded.select(*keep, F.col("_at").cast("bigint").alias(position), name)
