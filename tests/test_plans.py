"""The physical plans keep the properties the scale design relies on."""

import re

from linefold.config import LogSpec, SummarySpec
from linefold.plans.numbering import number_within_groups
from linefold.operators.summary import summarize
from linefold.sinks.ledger import SummaryLedger
from linefold.sources import kafka
from linefold.sources.lines import read_lines, write_lines
from tests.conftest import SF_SMALL


def executed(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_split_runs_once_per_line(spark, scratch):
    write_lines(spark.createDataFrame([("1|2024-01-01 00:00:00 000|||APP_1|||||sms||||||mo",)], "value string"),
                f"{scratch}/t")
    df = summarize(read_lines(spark, f"{scratch}/t"), LogSpec.transaction_log(), SummarySpec())
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1, plan
    assert "Generate explode" in plan
    # the predicate and reject test sit above the Generate and read the array
    filt = [line for line in plan.splitlines() if "Filter" in line][0]
    assert "split(" not in filt and "_parts" in filt


def test_text_scan_reads_only_the_line(spark, scratch):
    write_lines(spark.createDataFrame([("a|b",)], "value string"), f"{scratch}/t")
    df = summarize(read_lines(spark, f"{scratch}/t"), LogSpec.transaction_log(), SummarySpec())
    assert "ReadSchema: struct<value:string>" in physical(df)


def test_count_is_partial_then_final(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    from linefold.plans.events_log import event_lines

    plan = executed(summarize(event_lines(ev), LogSpec.transaction_log(), SummarySpec()))
    assert "partial_count" in plan
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1


def test_ledger_read_prunes_batches(spark, scratch):
    led = SummaryLedger(spark, scratch, ["d", "a"])
    for b in range(3):
        led.fold(spark.createDataFrame([("d", "a", 1)], "d string, a string, count bigint"), b)
    led.compact(1)
    plan = physical(led.read())
    assert "ledger/batch_id=2" in plan and "batch_id=0" not in plan and "_segments/0" in plan
    assert "partial_sum" in plan


def files_read(df):
    """Files that the scans of an executed plan opened."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    if "AdaptiveSparkPlan" in plan.nodeName():
        plan = plan.executedPlan()
    total, waiting = 0, [plan]
    while waiting:
        node = waiting.pop()
        if node.metrics().contains("numFiles"):
            total += node.metrics().apply("numFiles").value()
        children = node.children()
        waiting += [children.apply(i) for i in range(children.size())]
        if "QueryStage" in node.nodeName():
            waiting.append(node.plan())
    return total


def test_a_few_days_are_read_from_their_own_files(spark, scratch):
    """Neither a read of days nor a compaction opens the files of the other days' history."""
    led = SummaryLedger(spark, scratch, ["d", "a"])
    for b in range(6):
        rows = [(f"d{i}", "a", 1) for i in range(b * 10, b * 10 + 10)] + [("d3", "b", 1)]
        led.fold(spark.createDataFrame(rows, "d string, a string, count bigint"), b)
        led.compact(b)
    whole, some = led.read(), led.read(["d3", "d25"])
    assert len(led.segments.manifest().segments) == 6
    assert files_read(whole) >= 60 and files_read(some) <= 7
    assert "PartitionFilters: [_first" in physical(some)
    assert {tuple(r) for r in some.collect()} == {("d3", "a", 1), ("d3", "b", 6), ("d25", "a", 1)}
    # what a compaction reads: the batches since the last one, and the segments it merges (none here)
    led.fold(spark.createDataFrame([("d59", "a", 1)], "d string, a string, count bigint"), 6)
    kept = {s.name for s in led.segments.manifest().segments}
    led.compact(6)
    assert kept < {s.name for s in led.segments.manifest().segments}


def test_topic_filter_is_below_the_numbering(spark):
    """Other topics are dropped before the window's exchange, and lines rendered after it."""
    from linefold.plans.catalog import q_topic_subscribe

    lines = physical(q_topic_subscribe(spark, SF_SMALL)).splitlines()
    window = next(i for i, l in enumerate(lines) if "Window [row_number()" in l)
    exchange = next(i for i, l in enumerate(lines) if i > window and "Exchange hashpartitioning" in l)
    assert any("Filter" in l and "event_id" in l and "t1" in l for l in lines[exchange:])
    assert not any("APP_" in l for l in lines[window:])


def test_start_offsets_are_broadcast(spark):
    rows = [("t0", 0, o, None, None, "v") for o in range(20)]
    rec = spark.createDataFrame(rows, "topic string, partition int, offset bigint, timestamp timestamp, key string, value string")
    starts = kafka.start_offsets(spark, {("t0", 0): 5})
    assert "BroadcastHashJoin" in physical(kafka.from_offsets(rec, starts))


def test_numbering_does_not_reshuffle_rows_for_the_join(spark):
    """With broadcasts off (big inputs), the join reuses the window's partitioning."""
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").selectExpr("event_id", "user_id % 3 AS g", "event_type")
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = physical(number_within_groups(ev, ["g"], "event_id", "n", block_width=64)).splitlines()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    join = next(i for i, l in enumerate(lines) if "SortMergeJoin" in l)
    window = next(i for i, l in enumerate(lines) if "row_number()" in l)
    assert join < window
    # nothing between the join and the per-block window re-partitions the rows
    assert not any("Exchange" in l for l in lines[join:window])
