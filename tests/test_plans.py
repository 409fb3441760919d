"""Plan-shape checks: the scale properties the design relies on."""
import re

import __spark_entry__ as E
from conftest import SF001


def plan(spark, name, mode="simple"):
    df = E.queries()[name](spark, SF001)
    return df._jdf.queryExecution().executedPlan().toString() if mode == "executed" else \
        df._jdf.queryExecution().sparkPlan().toString()


def test_aggregates_are_partial_before_the_shuffle(spark):
    lines = plan(spark, "state_sentiment", "executed").splitlines()
    exchange = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning(window" in line)
    # printed top-down: the final aggregate is above the exchange, the partial one below it
    assert "partial_sum" not in "".join(lines[:exchange])
    assert "partial_sum" in lines[exchange + 1] and "partial_count" in lines[exchange + 1]


def test_top_k_limits_each_window_before_the_shuffle(spark):
    df = E.queries()["trending_topics"](spark, SF001)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in p
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"WindowGroupLimit .*Partial", final) and re.search(r"WindowGroupLimit .*Final", final)


def test_join_of_aggregates_adds_no_shuffle(spark):
    # the plan a large cluster gets: no broadcast, no runtime re-plan
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        p = E.queries()["sentiment_weather"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    lines = p.splitlines()
    join = next(i for i, line in enumerate(lines) if "SortMergeJoin [window" in line)
    # the join's children are Sort over HashAggregate, not a new Exchange
    child_ops = [line.strip(" :+-*()0123456789") for line in lines[join + 1:join + 4]]
    before_exchange = child_ops[:next((i for i, op in enumerate(child_ops) if op.startswith("Exchange")), 3)]
    assert before_exchange[0].startswith("Sort") and any(op.startswith("HashAggregate") for op in before_exchange), child_ops


def test_documents_are_never_broadcast(spark):
    df = E.queries()["sentiment_scores"](spark, SF001)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString()
    broadcast_scans = re.findall(r"BroadcastExchange[\s\S]*?FileScan parquet \[([^\]]*)\]", final)
    assert not any("text" in cols for cols in broadcast_scans)
    assert "SortMergeJoin [event_id" in final


def test_scans_read_only_needed_columns(spark):
    p = plan(spark, "hashtags", "executed")
    docs = re.search(r"FileScan parquet \[([^\]]*)\][^\n]*documents\.parquet", p)
    assert [c.split("#")[0] for c in docs.group(1).split(",")] == ["doc_id", "text"]


def test_state_codes_read_no_documents(spark):
    p = plan(spark, "state_codes", "executed")
    events = re.search(r"FileScan parquet \[([^\]]*)\][^\n]*events\.parquet", p)
    assert {c.split("#")[0] for c in events.group(1).split(",")} == {"event_id", "user_id"}
    assert "documents.parquet" not in p and "Exchange hashpartitioning" not in p


def test_sliding_counts_copy_pane_counts_not_rows(spark):
    p = plan(spark, "hashtag_counts_many_panes", "executed")
    lines = p.splitlines()
    copies = [i for i, line in enumerate(lines) if "Generate explode" in line and "nth" in line]
    partial = [i for i, line in enumerate(lines) if "partial_count(1)" in line]
    assert copies and partial and max(copies) < min(partial)  # printed top-down: rows are counted below the copying
    assert "Expand" not in p


def test_json_is_parsed_once(spark):
    p = plan(spark, "reject_records", "executed")
    for line in p.splitlines():
        if line.strip(" :+-").startswith("Filter"):
            assert "parseJson" not in line and "schemaOfVariant" not in line, line


def test_no_python_in_the_default_path(spark):
    for name in ("classify_posts", "state_sentiment", "trending_topics", "sentiment_weather"):
        p = plan(spark, name, "executed")
        assert "ArrowEvalPython" not in p and "BatchEvalPython" not in p, name


def test_weather_filter_reaches_the_scan(spark):
    p = plan(spark, "state_temperature", "executed")
    scan = next(line for line in p.splitlines() if "FileScan parquet" in line and "events.parquet" in line)
    assert re.search(r"PushedFilters: \[[^\]]*In\(event_type, \[click,view\]\)", scan), scan
    assert "props" not in scan and "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint" in scan


def test_few_panes_are_grouped_by_window(spark):
    from chirpwave.operators.windows import MIN_PANES, pane_count
    assert pane_count("4 hours", "2 hours") == 2 < MIN_PANES <= pane_count("24 hours", "2 hours") == 12
    assert pane_count("5 hours", "2 hours") == pane_count("2 hours", "2 hours") == pane_count("1 month", "1 day") == 0
    assert "nth" not in plan(spark, "hashtag_counts_sliding", "executed")
