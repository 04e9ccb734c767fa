"""Every registered query against its SQL, and the plans that scale depends on."""

import os
import re

import duckdb
import pytest

import __spark_entry__ as contract
from panewise.functions.templates import select_matching
from panewise.operators import topk, windows
from panewise.plans.oracles import ORACLES
from panewise.plans.queries import QUERIES
from panewise.sources.tables import table

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
PLANNED = """
lines_source cyclic_replay cyclic_replay_stream stream_source fifo_batches poll_source fifo_head latest_snapshot
snapshot_or_empty substreams_split append_sink upsert_latest foreach_batch_topk topk_json tokenize five_char_words
template_match demux_templates assign_ids sliding_word_counts pane_counts sliding_word_counts_panes arrival_rate
overrun_report sliding_event_counts sliding_counts_with_empty windowed_topk word_weights global_sort topk_last_window
union_streams sliding_topk_stream windowed_join windowed_reduce windowed_rows fifo_stream template_index sliding_reduce topk_every_slide topk_every_slide_stream
windowed_join_stream union_live
""".split()
DUCKDB_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in ("documents", "conversations", "events"):
        connection.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return connection


def executed_plan(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


def test_names_follow_the_inventory():
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())
    assert sorted(QUERIES) == sorted(PLANNED)
    assert sorted(ORACLES) == sorted(PLANNED)


@pytest.mark.parametrize("name", PLANNED)
def test_query_equals_its_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    cursor = duck.execute(ORACLES[name])
    expected_columns = [column[0] for column in cursor.description]
    expected_types = {column[0]: str(column[1]) for column in cursor.description}
    expected = cursor.fetchall()
    assert {column: DUCKDB_TYPES[kind] for column, kind in df.dtypes} == expected_types
    found = [tuple(row) for row in df.select(*expected_columns).collect()]
    assert sorted(found, key=str) == sorted(expected, key=str)
    assert found or name == "windowed_join"


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() == 230


def test_template_reaches_the_scan(spark):
    events = table(spark, SF_DIR, "events").select("event_id", "event_type")
    plan = executed_plan(select_matching(events, {"event_type": "click"}).select("event_id"))
    assert "EqualTo(event_type,click)" in plan
    assert re.search(r"ReadSchema: struct<event_id:bigint,event_type:string>", plan)


def test_panes_are_shuffled_once_before_they_become_windows(spark):
    events = table(spark, SF_DIR, "events")
    panes = windows.pane_counts(events, "ts", ["event_type"], 60)
    plan = executed_plan(windows.sliding_counts_from_panes(panes, "ts", ["event_type"], 300, 60))
    assert plan.count("Exchange hashpartitioning") == 2 and "Expand" not in plan


def test_top_k_is_limited_before_its_shuffle(spark):
    events = table(spark, SF_DIR, "events").withColumnRenamed("event_type", "word")
    plan = executed_plan(topk.top_k_per_window(windows.sliding_counts(events, "ts", ["word"], 300, 60)))
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


@pytest.mark.parametrize("name", ["windowed_topk", "demux_templates", "windowed_join", "cyclic_replay", "fifo_batches"])
def test_no_cross_joins(spark, name):
    plan = executed_plan(QUERIES[name](spark, SF_DIR))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("name", ["windowed_topk", "five_char_words", "tokenize"])
def test_text_is_not_shuffled(spark, name):
    plan = executed_plan(QUERIES[name](spark, SF_DIR))
    # Right above a scan, only what was cut may be shuffled.
    assert not re.search(r"Exchange[^\n]*\n[^\n]*(Filter|ColumnarToRow|FileScan)[^\n]*(\n[^\n]*(ColumnarToRow|Filter))*\n[^\n]*FileScan[^\n]*text", plan)


def test_windowed_join_shuffles_each_side_once(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert executed_plan(QUERIES["windowed_join"](spark, SF_DIR)).count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
