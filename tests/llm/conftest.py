import pytest

COPIES = "doc_id bigint, text string, lang string, source string, n_chars bigint, fp string, text_hash string, block int"


@pytest.fixture(scope="module")
def frame(spark):
    """Documents with further columns whose names clash with those that operators use."""

    def make(rows):
        full = [(i, t, "en", "s", None if t is None else len(t), "x", "y", 1) for i, t in rows]
        return spark.createDataFrame(full, COPIES)

    return make


@pytest.fixture(scope="module")
def odd(frame):
    """Null id, null text, empty text, a repeated row, one very long text."""
    long = " ".join(f"w{k % 997}x{k}" for k in range(30_000))
    return frame([(None, "a b c"), (1, None), (2, ""), (3, "same same same"), (3, "same same same"), (4, long)])
