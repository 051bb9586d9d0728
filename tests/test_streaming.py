"""Stream jobs: restart, strict resume, replay after a lost commit, running total, archive."""

import json

import pytest
from pyspark.sql import functions as F

from linefold.config import LogSpec, SummarySpec
from linefold.operators.summary import summarize
from linefold.session import HadoopFS
from linefold.sinks.batch_table import BatchTable
from linefold.sinks.ledger import SummaryLedger
from linefold.plans.events_log import event_lines
from linefold.sources.lines import stream_lines, write_lines
from linefold.streaming.jobs import (
    COUNT_SCHEMA,
    REJECT_SCHEMA,
    TOTAL_SCHEMA,
    CheckpointError,
    run_bounded,
    start_archive,
    start_batch_counts,
    start_console_preview,
    start_running_total,
    start_summary_stream,
)
from tests.conftest import SF_SMALL

NOW = {"availableNow": True}


@pytest.fixture(scope="module")
def lines(spark):
    return event_lines(spark.read.parquet(f"{SF_SMALL}/events.parquet"))


def as_dict(df, keys=("time_stamp", "app_id"), val="count"):
    return {tuple(r[k] for k in keys): r[val] for r in df.collect()}


def test_summary_stream_restart_and_replay(spark, scratch, lines):
    inp, ckpt = f"{scratch}/in", f"{scratch}/ckpt"
    lspec, sspec = LogSpec.transaction_log(), SummarySpec()
    led = SummaryLedger(spark, f"{scratch}/summary", sspec.keys)
    rejects = BatchTable(spark, f"{scratch}/rejects", REJECT_SCHEMA)

    def run(resume):
        q = start_summary_stream(
            stream_lines(spark, inp), lspec, sspec, led, ckpt,
            trigger=NOW, resume=resume, reject_sink=rejects, compact_every=2,
        )
        run_bounded(q)

    HadoopFS(spark).mkdirs(inp)
    with pytest.raises(CheckpointError):
        run("require")  # nothing to resume from yet
    for k in range(3):
        write_lines(lines.filter(F.col("event_id") % 3 == k), inp)
        run("auto" if k == 0 else "require")
    # lose the newest commit: the restart re-runs that batch over the same files
    fs = HadoopFS(spark)
    fs.delete(f"{ckpt}/commits/2")
    fs.delete(f"{ckpt}/commits/.2.crc")
    run("require")
    write_lines(spark.createDataFrame([("junk",)], "value string"), inp)
    run("require")
    assert as_dict(led.read()) == as_dict(summarize(lines, lspec, sspec))
    assert [r["value"] for r in rejects.read().collect()] == ["junk"]
    # a new checkpoint next to a ledger holding batches is refused
    with pytest.raises(CheckpointError):
        run_bounded(start_summary_stream(
            stream_lines(spark, inp), lspec, sspec, led, f"{scratch}/other", trigger=NOW))
    with pytest.raises(CheckpointError):
        start_summary_stream(stream_lines(spark, inp), lspec, sspec, led, ckpt, trigger=NOW, resume="new")


def test_bounded_run_stops_a_long_trigger(spark, scratch, lines):
    inp, ckpt = f"{scratch}/in", f"{scratch}/ckpt"
    write_lines(lines, inp)
    sink = BatchTable(spark, f"{scratch}/n", COUNT_SCHEMA)
    q = start_batch_counts(stream_lines(spark, inp), sink, ckpt, trigger={"processingTime": "1 second"})
    q.processAllAvailable()
    assert run_bounded(q, 0.2) is False
    assert not q.isActive
    assert sum(r["n"] for r in sink.read().collect()) == lines.count()


def test_running_total_survives_restart(spark, scratch, lines):
    inp, ckpt = f"{scratch}/in", f"{scratch}/ckpt"
    sink = BatchTable(spark, f"{scratch}/t", TOTAL_SCHEMA)
    sizes = []
    for k in range(3):
        part = lines.filter(F.col("event_id") % 3 == k)
        sizes.append(part.count())
        write_lines(part, inp)
        run_bounded(start_running_total(stream_lines(spark, inp), sink, ckpt, trigger=NOW, compact_every=2))
    got = sorted((r["batch_id"], r["total"]) for r in sink.read().collect())
    assert got == [(0, sizes[0]), (1, sizes[0] + sizes[1]), (2, sum(sizes))]
    assert [r["total"] for r in sink.latest().collect()] == [sum(sizes)]


def test_console_preview_runs(spark, scratch, lines):
    inp = f"{scratch}/in"
    write_lines(lines, inp)
    q = start_console_preview(stream_lines(spark, inp), f"{scratch}/ckpt", num_rows=3, trigger=NOW)
    assert run_bounded(q) is True


def test_archive_every_line_once(spark, scratch, lines):
    inp, ckpt, out = f"{scratch}/in", f"{scratch}/ckpt", f"{scratch}/archive"
    for k in range(2):
        write_lines(lines.filter(F.col("event_id") % 2 == k), inp)
        run_bounded(start_archive(stream_lines(spark, inp), out, ckpt, trigger=NOW))
    # replay the last batch
    HadoopFS(spark).delete(f"{ckpt}/commits/1")
    run_bounded(start_archive(stream_lines(spark, inp), out, ckpt, trigger=NOW))
    got = sorted(r["value"] for r in spark.read.parquet(out).collect())
    assert got == sorted(r["value"] for r in lines.collect())
    # a new checkpoint would restart batch ids under the sink's log: refused
    with pytest.raises(CheckpointError):
        start_archive(stream_lines(spark, inp), out, f"{scratch}/other", trigger=NOW)


def test_new_checkpoint_refused_after_full_compaction(spark, scratch, lines):
    """History that only survives in the compacted base still blocks a fresh checkpoint."""
    lspec, sspec = LogSpec.transaction_log(), SummarySpec()
    led = SummaryLedger(spark, f"{scratch}/summary", sspec.keys)
    led.fold(summarize(lines, lspec, sspec), 0)
    led.compact(0)
    assert led.batch_ids() == [] and not led.is_empty()
    HadoopFS(spark).mkdirs(f"{scratch}/in")
    with pytest.raises(CheckpointError):
        start_summary_stream(stream_lines(spark, f"{scratch}/in"), lspec, sspec, led, f"{scratch}/ckpt", trigger=NOW)


class _FakeProgress:
    def __init__(self, payload):
        self.json = json.dumps(payload)


class _FakeQuery:
    """Just enough of a StreamingQuery for progress parsing."""

    def __init__(self, payload):
        self.lastProgress = _FakeProgress(payload)


def test_progress_offset_ranges_kafka_shape():
    from linefold.streaming.jobs import progress_offset_ranges

    q = _FakeQuery({"sources": [{
        "description": "KafkaV2[Subscribe[t]]",
        "startOffset": {"t": {"0": 5, "1": 7}},
        "endOffset": {"t": {"0": 9, "1": 7, "2": 3}},
    }]})
    got = sorted((r["topic"], r["partition"], r["from_offset"], r["until_offset"]) for r in progress_offset_ranges(q))
    assert got == [("t", 0, 5, 9), ("t", 1, 7, 7), ("t", 2, 0, 3)]  # partition 2 is new: read from 0
    first = _FakeQuery({"sources": [{"startOffset": None, "endOffset": {"t": {"0": 9}}}]})
    assert progress_offset_ranges(first) == [{"topic": "t", "partition": 0, "from_offset": None, "until_offset": 9}]


def test_an_output_belongs_to_one_checkpoint(spark, scratch, lines):
    """Neither another ledger on a used checkpoint nor another checkpoint on a used ledger can start."""
    inp = f"{scratch}/in"
    write_lines(lines.limit(5), inp)
    keys = ("time_stamp", "app_id")
    first, second = (SummaryLedger(spark, f"{scratch}/{n}", keys) for n in ("a", "b"))

    def run(ledger, ckpt):
        run_bounded(start_summary_stream(
            stream_lines(spark, inp), LogSpec.transaction_log(), SummarySpec(predicate=None), ledger, f"{scratch}/{ckpt}", trigger=NOW))

    run(first, "ckpt1")
    with pytest.raises(CheckpointError):
        run(second, "ckpt1")  # empty, and the checkpoint's batches are elsewhere
    run(second, "ckpt2")
    for ledger, ckpt in ((first, "ckpt2"), (second, "ckpt1"), (first, "ckpt3")):
        with pytest.raises(CheckpointError):
            run(ledger, ckpt)
    write_lines(lines.limit(3), inp)
    run(first, "ckpt1")
    assert sum(r["count"] for r in first.read().collect()) == 8


def test_ranges_come_from_the_fold_itself(spark, scratch, lines):
    from linefold.plans.records import event_records
    from linefold.streaming.jobs import RANGE_SCHEMA

    records = event_records(spark.read.parquet(f"{SF_SMALL}/events.parquet")).select("topic", "partition", "offset", "value")
    led = SummaryLedger(spark, f"{scratch}/summary", ("time_stamp", "app_id"))
    ranges = BatchTable(spark, f"{scratch}/ranges", RANGE_SCHEMA)
    want = set()
    for k in range(2):
        part = records.filter(F.col("offset").between(k * 50, k * 50 + 49 if k == 0 else 10**9))
        part.write.mode("append").parquet(f"{scratch}/in")
        want |= {(k, r["topic"], r["partition"], r["lo"], r["hi"] + 1) for r in part.groupBy("topic", "partition").agg(F.min("offset").alias("lo"), F.max("offset").alias("hi")).collect()}
        stream = spark.readStream.schema(part.schema).parquet(f"{scratch}/in")
        run_bounded(start_summary_stream(stream, LogSpec.transaction_log(), SummarySpec(), led, f"{scratch}/ckpt", trigger=NOW, range_sink=ranges))
    got = {(r["batch_id"], r["topic"], r["partition"], r["from_offset"], r["until_offset"]) for r in ranges.read().collect()}
    assert got == want
    assert as_dict(led.read()) == as_dict(summarize(lines, LogSpec.transaction_log(), SummarySpec()))


def test_archive_keeps_line_ends_and_nulls(spark, scratch):
    values = [("a\nb",), ("c",), (None,), ("",)]
    spark.createDataFrame(values, "value string").write.parquet(f"{scratch}/in")
    stream = lambda: spark.readStream.schema("value string").parquet(f"{scratch}/in")
    run_bounded(start_archive(stream(), f"{scratch}/out", f"{scratch}/ckpt", trigger=NOW))
    got = [r["value"] for r in spark.read.parquet(f"{scratch}/out").collect()]
    assert sorted(got, key=str) == sorted((v for v, in values), key=str)
    with pytest.raises(Exception, match="cannot hold NULL or a line end"):
        run_bounded(start_archive(stream(), f"{scratch}/text", f"{scratch}/ckpt2", trigger=NOW, fmt="text"))


def test_progress_offset_ranges_file_source(spark, scratch, lines):
    from linefold.streaming.jobs import progress_offset_ranges

    write_lines(lines.limit(5), f"{scratch}/in")
    q = start_batch_counts(stream_lines(spark, f"{scratch}/in"), BatchTable(spark, f"{scratch}/n", COUNT_SCHEMA),
                           f"{scratch}/ckpt", trigger=NOW)
    run_bounded(q)
    assert progress_offset_ranges(q) == []


def test_failfast_stream_stops_on_a_bad_line(spark, scratch, lines):
    """mode='failfast' fails the batch on a malformed line, as the original jobs did."""
    inp = f"{scratch}/in"
    write_lines(lines.limit(20), inp)
    write_lines(spark.createDataFrame([("|||",)], "value string"), inp)
    led = SummaryLedger(spark, f"{scratch}/summary", ("time_stamp", "app_id"))
    q = start_summary_stream(stream_lines(spark, inp), LogSpec.transaction_log(), SummarySpec(), led,
                             f"{scratch}/ckpt", trigger=NOW, mode="failfast")
    with pytest.raises(Exception, match="malformed log line"):
        run_bounded(q)
    assert led.is_empty()  # nothing of the failed batch was folded


def test_random_slicings_and_replays_equal_batch(spark, lines):
    """Property: whatever the slicing and whichever batch is replayed, the stream gives the batch answer."""
    import random

    from linefold.session import scratch_path

    lspec, sspec = LogSpec.transaction_log(), SummarySpec()
    expected = as_dict(summarize(lines, lspec, sspec))
    rng = random.Random(11)
    fs = HadoopFS(spark)
    for trial in range(2):
        root = scratch_path(spark, f"stream-prop{trial}")
        n, salt = rng.randint(2, 4), rng.randint(0, 10**6)
        sliced = lines.withColumn("_s", F.abs(F.hash(F.col("event_id"), F.lit(salt))) % n)
        led = SummaryLedger(spark, f"{root}/summary", sspec.keys)
        replay_after = rng.randrange(n)

        def run():
            run_bounded(start_summary_stream(stream_lines(spark, f"{root}/in"), lspec, sspec, led,
                                             f"{root}/ckpt", trigger=NOW))

        for k in range(n):
            write_lines(sliced.filter(F.col("_s") == k), f"{root}/in")
            run()
            if k == replay_after:
                fs.delete(f"{root}/ckpt/commits/{k}")
                fs.delete(f"{root}/ckpt/commits/.{k}.crc")
                run()
        assert as_dict(led.read()) == expected, (n, salt, replay_after)


def test_bad_predicate_fails_before_the_stream_starts(spark, scratch):
    HadoopFS(spark).mkdirs(f"{scratch}/in")
    led = SummaryLedger(spark, f"{scratch}/summary", ("time_stamp", "app_id"))
    with pytest.raises(Exception, match="(?i)no_such_field|cannot be resolved|UNRESOLVED"):
        start_summary_stream(stream_lines(spark, f"{scratch}/in"), LogSpec.transaction_log(),
                             SummarySpec(predicate="no_such_field = 'x'"), led, f"{scratch}/ckpt", trigger=NOW)
    assert not spark.streams.active


def test_mirror_table_is_exact_after_replay(spark, scratch, lines):
    """The catalog table mirrored from the ledger counts a replayed batch once."""
    from linefold.sinks.tables import SummaryTable

    db = "lf_test_mirror"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{scratch}/wh'")
    table = SummaryTable(spark, f"{db}.daily_summary", ["time_stamp", "app_id"], by_day=True)
    lspec, sspec = LogSpec.transaction_log(), SummarySpec()
    led = SummaryLedger(spark, f"{scratch}/summary", sspec.keys)
    try:
        def run():
            run_bounded(start_summary_stream(stream_lines(spark, f"{scratch}/in"), lspec, sspec, led,
                                             f"{scratch}/ckpt", trigger=NOW, mirror_table=table))

        for k in range(2):
            write_lines(lines.filter(F.col("event_id") % 2 == k), f"{scratch}/in")
            run()
        fs = HadoopFS(spark)
        fs.delete(f"{scratch}/ckpt/commits/1")
        fs.delete(f"{scratch}/ckpt/commits/.1.crc")
        run()
        want = {k: str(v) for k, v in as_dict(summarize(lines, lspec, sspec)).items()}
        assert as_dict(table.read()) == want
        assert dict(table.read().dtypes)["count"] == "string"
        # a batch of one day leaves the files of the other days as they are
        files = lambda: {f for r in table.read().inputFiles() for f in [r]}
        before = files()
        day = min(want)[0]
        one = lines.filter(F.substring("value", 1, 1) != "").filter(F.col("value").contains(f"|{day} "))
        write_lines(one.limit(3), f"{scratch}/in")
        run()
        changed = {f.split("time_stamp=")[1].split("/")[0] for f in before ^ files()}
        assert changed <= {day}
        assert as_dict(table.read()) == {k: str(v) for k, v in as_dict(led.read()).items()}
    finally:
        table.drop()
        spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
