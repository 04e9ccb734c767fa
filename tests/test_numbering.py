import random

import pytest
from helpers import rows
from pyspark.sql import functions as F

from panewise.operators import numbering


@pytest.fixture(params=["one step", "all levels"])
def levels(request, monkeypatch):
    if request.param == "all levels":
        monkeypatch.setattr(numbering, "ONE_STEP", 0)


def keys_and_weights():
    rng = random.Random(1)
    dense = list(range(0, 1500, 2))
    hashed = [rng.getrandbits(63) - (1 << 62) for _ in range(300)]
    ends = [-(1 << 63), (1 << 63) - 1, -1, 1]
    return [(key, rng.choice([0, 1, 5, 1000000])) for key in set(dense + hashed + ends)]


def test_offsets_equal_brute_force(spark, levels):
    data = keys_and_weights()
    expected, total = [], 0
    for key, weight in sorted(data):
        expected.append((key, weight, total))
        total += weight
    df = spark.createDataFrame(data, "key bigint, weight bigint").repartition(4)
    assert rows(numbering.with_offset(df, "key", "weight", "offset")) == expected
    assert numbering.bucket_starts(df, "key", "weight").total == total


def test_least_keeps_everything_from_there_on(spark, levels):
    df = spark.range(5000).withColumn("weight", F.lit(3))
    tail = numbering.with_offset(df, "id", "weight", "offset", least=9000)
    found = rows(tail, "id", "offset")
    assert found == [(n, 3 * n) for n in range(found[0][0], 5000)]
    assert 3000 - 256 < found[0][0] <= 3000


def test_positions(spark, levels):
    keys = [key for key, _ in keys_and_weights()]
    df = spark.createDataFrame([(key,) for key in keys], "key bigint").repartition(3)
    assert rows(numbering.with_position(df, "key", "position")) == [(k, n) for n, k in enumerate(sorted(keys))]


def test_empty_table(spark, levels):
    df = spark.createDataFrame([], "key bigint, weight bigint")
    assert numbering.with_offset(df, "key", "weight", "offset").count() == 0
    assert numbering.bucket_starts(df, "key", "weight").total == 0


def test_rank_when_most_rows_tie(spark):
    data = [(f"w{n:05d}", 1 if n % 3 else n) for n in range(2000)]
    df = spark.createDataFrame(data, "word string, count bigint").repartition(4)
    ranked = numbering.with_rank(df, [F.desc("count"), F.asc("word")], "rank")
    expected = sorted(data, key=lambda row: (-row[1], row[0]))
    assert rows(ranked, "rank", "word", "count") == [(n + 1, w, c) for n, (w, c) in enumerate(expected)]


@pytest.mark.parametrize("keys", [[1, 2, None], [7] * 300, [1, 2, 2], [-1, 5, -1], [1 << 40, 1 << 40]])
def test_null_and_repeated_keys_raise(spark, keys):
    df = spark.createDataFrame([(k,) for k in keys], "doc_id bigint")
    with pytest.raises(ValueError, match="neither null nor repeated"):
        numbering.with_position(df, "doc_id", "at")


def test_all_keys_of_a_bucket_may_be_there(spark):
    df = spark.range(-256, 512).withColumn("weight", F.lit(1))
    assert numbering.bucket_starts(df, "id", "weight").total == 768
