"""Command line: the original config layout drives batch, stream and show."""

import json

from linefold import cli
from linefold.config import TRANSACTION_FIELD_NAMES
from linefold.sinks.batch_table import BatchTable
from linefold.sinks.ledger import SummaryLedger
from linefold.streaming.jobs import COUNT_SCHEMA, TOTAL_SCHEMA
from linefold.plans.events_log import event_lines
from linefold.sources.lines import write_lines
from tests.conftest import SF_SMALL

CONF = {
    "application": {"appName": "t", "duration": 2000},
    "input": {
        "fieldCount": 60,
        "delimeter": "|",
        "fields": TRANSACTION_FIELD_NAMES,
        "selectedFields": ["time_stamp", "app_id", "channel_type", "travel_direction"],
        "time_stamp": {"fieldNumber": 2, "substring": True, "substringValue": [0, 10]},
        "app_id": {"fieldNumber": 5, "substring": False},
        "channel_type": {"fieldNumber": 10, "substring": False},
        "travel_direction": {"fieldNumber": 16, "substring": False},
    },
    "query": {
        "whereClause": "channel_type = 'sms' AND travel_direction = 'mo'",
        "groupingFields": ["time_stamp", "app_id"],
    },
    "output": {"tableName": "daily_summary", "temporyView": "temp_view"},
    "kafka": {"bootstrapServers": "broker-a:1234", "topicSet": "calls;texts", "topicSetSeperator": ";", "groupId": "g",
              "startingOffsets": "earliest", "options": {"failOnDataLoss": "false"}},
}


def test_config_specs_match_builtin_layout():
    from linefold.config import LogSpec, SummarySpec

    log, summary = cli.specs(CONF)
    assert log.fields == LogSpec.transaction_log().fields
    assert summary == SummarySpec()
    assert cli.trigger_of(CONF, once=False) == {"processingTime": "2000 milliseconds"}


def test_stream_then_show(spark, scratch, tmp_path, capsys):
    conf = tmp_path / "job.json"
    conf.write_text(json.dumps(CONF))
    lines = event_lines(spark.read.parquet(f"{SF_SMALL}/events.parquet"))
    write_lines(lines, f"{scratch}/in")
    args = ["stream", "--config", str(conf), "--summary", f"{scratch}/summary",
            "--checkpoint", f"{scratch}/ckpt", "--lines", f"{scratch}/in", "--once", "--show", "2"]
    assert cli.main(args, spark) == 0
    led = SummaryLedger(spark, f"{scratch}/summary", ["time_stamp", "app_id"])
    from linefold.config import LogSpec, SummarySpec
    from linefold.operators.summary import summarize

    want = {tuple(r) for r in summarize(lines, LogSpec.transaction_log(), SummarySpec()).collect()}
    assert {tuple(r) for r in led.read().collect()} == want
    assert cli.main(["show", "--config", str(conf), "--summary", f"{scratch}/summary", "--compat"], spark) == 0
    assert "APP_" in capsys.readouterr().out
    # the whole result goes to --out
    assert cli.main(["show", "--config", str(conf), "--summary", f"{scratch}/summary", "--out", f"{scratch}/shown"], spark) == 0
    assert cli.main(["batch", "--config", str(conf), "--lines", f"{scratch}/in", "--out", f"{scratch}/batch"], spark) == 0
    assert capsys.readouterr().out == ""
    for out in ("shown", "batch"):
        assert {tuple(r) for r in spark.read.parquet(f"{scratch}/{out}").collect()} == want


def test_counts_total_and_archive_commands(spark, scratch, tmp_path):
    conf = tmp_path / "job.json"
    conf.write_text(json.dumps(CONF))
    lines = event_lines(spark.read.parquet(f"{SF_SMALL}/events.parquet"))
    n = lines.count()
    write_lines(lines.repartition(3), f"{scratch}/in")
    for cmd in ("counts", "total", "archive"):
        args = [cmd, "--config", str(conf), "--out", f"{scratch}/{cmd}", "--checkpoint", f"{scratch}/ckpt-{cmd}",
                "--lines", f"{scratch}/in", "--max-files", "1", "--once"]
        assert cli.main(args, spark) == 0
    counts = BatchTable(spark, f"{scratch}/counts", COUNT_SCHEMA).read().collect()
    assert len(counts) == 3 and sum(r["n"] for r in counts) == n  # one file a batch
    totals = BatchTable(spark, f"{scratch}/total", TOTAL_SCHEMA).read().collect()
    assert max(r["total"] for r in totals) == n
    assert sorted(r[0] for r in spark.read.parquet(f"{scratch}/archive").collect()) == sorted(r["value"] for r in lines.collect())
    from linefold.sinks.archive import Archive

    assert cli.main(["pack", "--out", f"{scratch}/archive"], spark) == 0
    packed = Archive(spark, f"{scratch}/archive")
    assert packed.segments.upto() == 2
    assert sorted(r[0] for r in packed.read().collect()) == sorted(r["value"] for r in lines.collect())
    # a bounded run with a long trigger ends by itself
    args = ["counts", "--config", str(conf), "--out", f"{scratch}/more", "--checkpoint", f"{scratch}/ckpt-more",
            "--lines", f"{scratch}/in", "--timeout", "3"]
    assert cli.main(args, spark) == 0


def test_kafka_options_from_the_command_line():
    import argparse

    seen = {}

    def fake(spark, spec, from_offsets=None):
        seen.update(spec=spec, offsets=from_offsets)
        return "stream"

    old = cli.kafka_lines
    cli.kafka_lines = fake
    try:
        args = argparse.Namespace(kafka=True, landed=None, growing=None, max_offsets=500, from_offsets='{"calls": {"0": 17, "2": 3}}')
        assert cli.source_of(None, CONF, args) == "stream"
    finally:
        cli.kafka_lines = old
    assert seen["offsets"] == {("calls", 0): 17, ("calls", 2): 3}
    opts = seen["spec"].subscribe_options()
    assert opts["maxOffsetsPerTrigger"] == "500" and opts["failOnDataLoss"] == "false"
    assert opts["startingOffsets"] == "earliest" and opts["subscribe"] == "calls,texts"


def test_landed_topics_and_a_lost_checkpoint(spark, scratch, tmp_path):
    from linefold.config import LogSpec, SummarySpec
    from linefold.operators.summary import summarize
    from linefold.sources.landed import land_records

    conf = tmp_path / "job.json"
    conf.write_text(json.dumps(CONF))
    lines = event_lines(spark.read.parquet(f"{SF_SMALL}/events.parquet"))
    records = lines.selectExpr("IF(event_id % 2 = 0, 'calls', 'texts') AS topic", "0 AS partition", "event_id DIV 2 AS offset", "value")
    common = ["stream", "--config", str(conf), "--summary", f"{scratch}/summary", "--landed", f"{scratch}/topics", "--once"]
    land_records(records.filter("offset < 200"), f"{scratch}/topics", "a")
    assert cli.main([*common, "--checkpoint", f"{scratch}/lost", "--ranges", f"{scratch}/ranges"], spark) == 0
    ledger = SummaryLedger(spark, f"{scratch}/summary", ["time_stamp", "app_id"])
    assert ledger.next_offsets() == {("calls", 0): 200, ("texts", 0): 200}
    land_records(records.filter("offset >= 200"), f"{scratch}/topics", "b")
    assert cli.main([*common, "--checkpoint", f"{scratch}/new", "--takeover", "--ranges", f"{scratch}/ranges"], spark) == 0
    want = {tuple(r) for r in summarize(lines, LogSpec.transaction_log(), SummarySpec()).collect()}
    assert {tuple(r) for r in ledger.read().collect()} == want
    assert cli.main(["ranges", "--checkpoint", f"{scratch}/lost", "--out", f"{scratch}/log"], spark) == 0
    got = {(r["topic"], r["from_offset"], r["until_offset"]) for r in spark.read.parquet(f"{scratch}/log").collect()}
    assert got == {("calls", None, 200), ("texts", None, 200)}


def test_another_count_column_end_to_end(spark, scratch, tmp_path):
    from linefold.sinks.tables import SummaryTable

    db = "lf_test_cli"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{scratch}/wh'")
    output = {"tableName": f"{db}.per_day", "columnNames": "time_stamp, app_id, hits",
              "createTableQuery": "time_stamp String, app_id String, hits String"}
    conf = tmp_path / "job.json"
    conf.write_text(json.dumps({**CONF, "output": output}))
    lines = event_lines(spark.read.parquet(f"{SF_SMALL}/events.parquet"))
    write_lines(lines, f"{scratch}/in")
    try:
        args = ["stream", "--config", str(conf), "--summary", f"{scratch}/summary", "--checkpoint", f"{scratch}/ckpt",
                "--lines", f"{scratch}/in", "--once", "--mirror-table"]
        assert cli.main(args, spark) == 0
        table = SummaryTable(spark, f"{db}.per_day", ["time_stamp", "app_id"], count_col="hits").read()
        from linefold.config import LogSpec, SummarySpec
        from linefold.operators.summary import summarize

        want = {tuple(map(str, r)) for r in summarize(lines, LogSpec.transaction_log(), SummarySpec()).collect()}
        assert {(r["time_stamp"], r["app_id"], r["hits"]) for r in table.collect()} == want
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
