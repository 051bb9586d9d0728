"""Files that still grow, and one reading of a batch for all its outputs."""

import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from linefold.config import FieldSpec, LogSpec, SummarySpec
from linefold.operators.parse import parse, rejects
from linefold.operators.summary import count_with_rejects, rejected_lines, summarize
from linefold.sinks.batch_table import BatchTable
from linefold.sinks.ledger import SummaryLedger
from linefold.sources import growing
from linefold.sources.growing import ByteRange, stream_growing, whole_lines
from linefold.streaming.jobs import COUNT_SCHEMA, REJECT_SCHEMA, fold_batch, run_bounded, start_summary_stream

LOG = LogSpec((FieldSpec("d", 1, (0, 2)), FieldSpec("a", 2)), "|", 2)
SUM = SummarySpec(predicate="a <> 'skip'", keys=("d", "a"))


def folder(scratch, name="logs"):
    path = f"{scratch.removeprefix('file:')}/{name}"
    os.makedirs(path, exist_ok=True)
    return path


def append(path, data):
    with open(path, "ab") as f:
        f.write(data)


def collected(spark, logs, checkpoint, **options):
    seen = []

    def each(batch, _):
        seen.extend(r["value"] for r in batch.collect())

    q = stream_growing(spark, logs, **options).writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    run_bounded(q.trigger(availableNow=True).start())
    return sorted(seen)


def test_appended_lines_are_read_once(spark, scratch):
    logs = folder(scratch)
    run = lambda: collected(spark, logs, f"{scratch}/ckpt", split_bytes=7)
    append(f"{logs}/a.log", b"one\ntwo\r\n\nunfin")
    append(f"{logs}/.hidden", b"no\n")
    assert run() == ["", "one", "two"]
    append(f"{logs}/a.log", b"ished\n" + "ü" .encode() * 40 + b"\n")
    append(f"{logs}/b.log", b"new file\nno end")
    assert run() == ["new file", "unfinished", "ü" * 40]
    assert run() == []
    append(f"{logs}/b.log", b"\n\xff\rlast\n")
    assert run() == ["last", "no end", "�"]


def test_truncated_files(spark, scratch):
    logs = folder(scratch)
    append(f"{logs}/a.log", b"one\ntwo\n")
    assert collected(spark, logs, f"{scratch}/fail") == collected(spark, logs, f"{scratch}/go", on_truncate="restart") == ["one", "two"]
    with open(f"{logs}/a.log", "wb") as f:
        f.write(b"new\n")
    with pytest.raises(Exception, match="truncated or replaced"):
        collected(spark, logs, f"{scratch}/fail")
    assert collected(spark, logs, f"{scratch}/go", on_truncate="restart") == ["new"]
    append(f"{logs}/b.log.gz", b"x")
    with pytest.raises(Exception, match="compressed"):
        collected(spark, logs, f"{scratch}/go", on_truncate="restart")
    assert collected(spark, logs, f"{scratch}/some", pattern="a.*") == ["new"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([b"", b"a", b"bcd", b"x\ry", b"z\r", b"long" * 6]), max_size=12), st.integers(1, 9), st.integers(0, 40))
def test_every_split_reads_each_line_once(lines, split, skip):
    import io

    data = b"".join(line + b"\n" for line in lines)
    # a batch that begins behind some line's end
    starts = [0, *(i + 1 for i, c in enumerate(data) if c == 10)]
    first = starts[skip % len(starts)]
    old, growing.BLOCK = growing.BLOCK, 5
    try:
        got = []
        for low in range(first, len(data), split):
            part = ByteRange("", "f", low, min(low + split, len(data)), len(data), low == first)
            got += whole_lines(io.BytesIO(data), part)
    finally:
        growing.BLOCK = old
    assert got == data[first:].replace(b"\r\n", b"\n").replace(b"\r", b"\n").split(b"\n")[:-1]


def test_growing_files_fold_like_a_batch(spark, scratch):
    logs, ledger = folder(scratch), SummaryLedger(spark, f"{scratch}/summary", SUM.keys)
    rows = [f"d{i % 3}|{'skip' if i % 5 == 0 else 'a'}{'' if i % 5 == 0 else i % 2}" for i in range(300)]
    for k in range(3):
        text = "\n".join(rows[k * 100 : k * 100 + 100]).encode()
        append(f"{logs}/server.log", text[:350])
        run_bounded(start_summary_stream(stream_growing(spark, logs), LOG, SUM, ledger, f"{scratch}/ckpt", trigger={"availableNow": True}))
        append(f"{logs}/server.log", text[350:] + b"\n")
    run_bounded(start_summary_stream(stream_growing(spark, logs), LOG, SUM, ledger, f"{scratch}/ckpt", trigger={"availableNow": True}))
    want = summarize(spark.createDataFrame([(r,) for r in rows], "value string"), LOG, SUM)
    assert sorted(map(tuple, ledger.read().collect())) == sorted(map(tuple, want.collect()))


LINES = ["d1|a", "d1|a", "d2|b", "x", "x", "", None, "d3|skip", "d1|a|more", "|", None]


def test_one_pass_gives_counts_and_rejects(spark):
    lines = spark.createDataFrame([(v,) for v in LINES], "value string").repartition(3)
    parsed = parse(lines, LOG)
    both = count_with_rejects(parsed, SUM)
    counts = both.filter("_reject IS NULL").select("d", "a", "count")
    assert sorted(map(tuple, counts.collect())) == sorted(map(tuple, summarize(lines, LOG, SUM).collect())) == [("d1", "a", 3), ("d2", "b", 1)]
    key = lambda r: str(tuple(r))
    assert sorted(rejected_lines(both).collect(), key=key) == sorted(rejects(parsed).collect(), key=key)


def test_a_batch_is_read_once_for_all_outputs(spark, scratch):
    """Rows that leave the source while a batch is folded with rejects and counts: each once."""
    passed = spark.sparkContext.accumulator(0)

    def through(batches):
        for b in batches:
            passed.add(b.num_rows)
            yield b

    rows = [(v,) for v in LINES] * 20
    batch = spark.createDataFrame(rows, "value string").repartition(4).mapInArrow(through, "value string")
    ledger = SummaryLedger(spark, f"{scratch}/summary", SUM.keys)
    rejected, counted = BatchTable(spark, f"{scratch}/rejects", REJECT_SCHEMA), BatchTable(spark, f"{scratch}/counts", COUNT_SCHEMA)
    for _ in range(2):  # the second time as a replay
        passed.value = 0
        fold_batch(batch, 0, LOG, SUM, ledger, reject_sink=rejected, count_sink=counted)
        assert passed.value == len(rows)
    assert sorted(map(tuple, ledger.read().collect())) == [("d1", "a", 60), ("d2", "b", 20)]
    assert [(r["batch_id"], r["n"]) for r in counted.read().collect()] == [(0, len(rows))]
    found = {tuple(r) for r in rejected.read().groupBy("value", "reason").agg(F.count("*")).collect()}
    short = "short_field:d"
    assert found == {("x", short, 40), ("", short, 20), ("|", short, 20), (None, "null_value", 40)}
    # a compacted batch that is replayed by its owner is not read for nothing, and stays counted
    for out in (ledger, rejected, counted):
        out.bind("stream")
        out.compact(0)
    fold_batch(batch, 0, LOG, SUM, ledger, owner="stream", reject_sink=rejected, count_sink=counted)
    assert [(r["batch_id"], r["n"]) for r in counted.read().collect()] == [(0, len(rows))]


def test_total_in_the_state_store(spark, scratch):
    """The state's total is the sink's, also after a stop between the two."""
    from linefold import cli
    from linefold.sources.lines import stream_lines, write_lines
    from linefold.streaming.jobs import TOTAL_SCHEMA, CheckpointError, start_running_total, total_of_checkpoint

    sink = BatchTable(spark, f"{scratch}/total", TOTAL_SCHEMA)
    write = sink.write
    start = lambda: start_running_total(stream_lines(spark, f"{scratch}/in"), sink, f"{scratch}/ckpt", trigger={"availableNow": True})
    with pytest.raises(CheckpointError):
        total_of_checkpoint(spark, f"{scratch}/ckpt")
    for k in range(2):
        write_lines(spark.createDataFrame([(f"l{i}",) for i in range(10 + k)], "value string"), f"{scratch}/in")
        run_bounded(start())
    state = lambda: [tuple(r) for r in total_of_checkpoint(spark, f"{scratch}/ckpt").collect()]
    latest = lambda: [(r["batch_id"], r["total"]) for r in sink.latest().collect()]
    assert state() == latest() == [(1, 21)]

    def dies(df, *args):
        df.collect()  # the batch's state is computed, its sink is not written
        raise OSError("lost")

    write_lines(spark.createDataFrame([("more",)], "value string"), f"{scratch}/in")
    sink.write = dies
    with pytest.raises(Exception, match="lost"):
        run_bounded(start())
    sink.write = write
    assert state() == latest() == [(1, 21)]
    run_bounded(start())
    assert state() == latest() == [(2, 22)]
    assert cli.main(["state-total", "--checkpoint", f"{scratch}/ckpt", "--out", f"{scratch}/out"], spark) == 0
    assert [tuple(r) for r in spark.read.parquet(f"{scratch}/out").collect()] == [(2, 22)]
