import pytest
from helpers import rows
from pyspark.sql import functions as F

from panewise.functions.ids import content_id, random_id
from panewise.functions.text import line_array, line_count, tokens, unfold, utf16_length, words_of_length
from panewise.sources.lines import document_lines, text_file_lines, text_lines

FIVE_LINES = ["aaaaaaaaaaaa", "bbbbbbbbb", "cccc", "dddd", "eee"]


def one(spark, value, expression):
    return spark.createDataFrame([(value,)], "text string").select(expression(F.col("text"))).first()[0]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("a\nb", ["a", "b"]),
        ("a\nb\n", ["a", "b"]),
        ("a\r\nb\rc\n\n", ["a", "b", "c", ""]),
        ("\n", [""]),
        ("", []),
        (None, None),
        ("no end", ["no end"]),
    ],
)
def test_line_array(spark, text, expected):
    assert one(spark, text, line_array) == expected
    assert one(spark, text, line_count) == (None if expected is None else len(expected))


@pytest.mark.parametrize(
    "line, expected",
    [
        ("a  hello   ", ["a", "", "hello"]),
        (" lead", ["", "lead"]),
        ("   ", []),
        ("", [""]),
        ("tab\there", ["tab\there"]),
        (None, None),
    ],
)
def test_tokens(spark, line, expected):
    assert one(spark, line, tokens) == expected


@pytest.mark.parametrize(
    "line, expected",
    [
        ("a  hello   ", ["hello"]),
        ("That. that. THAT.", ["That.", "that.", "THAT."]),
        ("\U0001f600abc \U0001f600abcd \U0001f600\U0001f600x éèàçù", ["\U0001f600abc", "\U0001f600\U0001f600x", "éèàçù"]),
        (" ".join(FIVE_LINES), []),
        ("", []),
    ],
)
def test_words_of_five_units(spark, line, expected):
    assert one(spark, line, lambda text: words_of_length(text, 5)) == expected


def test_utf16_length(spark):
    assert one(spark, "a\U0001f600é", utf16_length) == 4


def test_unfold_drops_rows_without_elements(spark):
    df = spark.createDataFrame([(1, ["a", None]), (2, []), (3, None)], "id int, items array<string>")
    assert [tuple(r) for r in unfold(df, ["id"], F.col("items"), "item", "at").orderBy("at").collect()] == [
        (1, 0, "a"),
        (1, 1, None),
    ]


def test_document_lines_follow_the_key_not_the_file_order(spark):
    docs = spark.createDataFrame(
        [(900, "x\ny"), (-3, "a"), (5, ""), (7, None), (300, "b\n\nc\n")], "doc_id bigint, text string"
    )
    expected = [(-3, 0, 0, "a"), (300, 0, 1, "b"), (300, 1, 2, ""), (300, 2, 3, "c"), (900, 0, 4, "x"), (900, 1, 5, "y")]
    assert rows(document_lines(docs)) == expected
    assert rows(text_lines(docs)) == [(d, n, t) for d, n, _, t in expected]


def test_ids(spark):
    df = spark.range(3).withColumn("n", F.lit(1))
    assert df.select(content_id(F.col("id"), F.col("n")).alias("k")).distinct().count() == 3
    assert df.select(random_id().alias("k")).distinct().count() == 3


def test_text_file_lines_across_splits(spark, tmp_path):
    text = [f"line {n} " + "x" * (n % 37) for n in range(3000)]
    (tmp_path / "a.txt").write_text("\n".join(text) + "\n")
    (tmp_path / "b.txt").write_text("\r\n".join(FIVE_LINES))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        found = text_file_lines(spark, str(tmp_path)).orderBy("file", "seq").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r["text"] for r in found] == text + FIVE_LINES
    assert [r["seq"] for r in found] == list(range(3000)) + list(range(5))
