"""Tiered segments: how many there are, what a write and a compaction cost, crashes at every step."""

import pytest
from pyspark.sql.types import LongType, StructField, StructType

from linefold.session import HadoopFS
from linefold.sinks.batch_table import BatchTable
from linefold.sinks.ledger import SummaryLedger
from linefold.sinks.segments import Manifest
from linefold.sinks.tables import SummaryTable

SCHEMA = StructType([StructField("n", LongType())])


def one(spark, n):
    return spark.createDataFrame([(n,)], "n bigint")


@pytest.mark.parametrize("fanout", [2, 4, 8])
def test_segments_grow_with_the_logarithm_of_the_batches(fanout):
    """10,000 batches, each a compaction of its own: few segments, contiguous, each row moved once per tier."""
    state, moved = Manifest(), 0
    for b in range(10_000):
        taken, tier = state.merged(fanout)
        moved += 1 + sum(s.upto - s.first + 1 for s in state.segments[len(state.segments) - taken :])
        state = state.with_segment(f"s{b}", b, fanout)
        assert state.upto == b and state.segments[-1].tier == tier
    tiers = next(t for t in range(30) if fanout**t >= 10_000)
    assert len(state.segments) <= (fanout - 1) * tiers + 1
    assert moved <= 10_000 * (tiers + 1)
    at = 0
    for s in state.segments:
        assert s.first == at and s.upto >= s.first
        at = s.upto + 1
    assert at == 10_000 and Manifest.load(state.dump()) == state


def test_a_write_costs_the_same_however_long_the_history(spark, scratch):
    t = BatchTable(spark, scratch, SCHEMA, fanout=3)
    calls = []
    for b in range(24):
        before = t._fs.calls
        t.write(one(spark, b), b)
        calls.append(t._fs.calls - before)
        if b % 2:
            t.compact(b - 1)
    assert set(calls) == {1}
    assert len(t.segments.manifest().segments) <= 5
    assert sorted(r["n"] for r in t.read().collect()) == list(range(24))
    plan = t.read()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2  # all segments are one scan, all partitions another


def test_ranges_of_batches_skip_segments(spark, scratch):
    t = BatchTable(spark, scratch, SCHEMA, fanout=3)
    for b in range(12):
        t.write(one(spark, b * 10), b)
        if b < 9:
            t.compact(b)
    assert sorted((r["batch_id"], r["n"]) for r in t.read(7, 10).collect()) == [(b, b * 10) for b in range(7, 11)]
    assert t.read(100).collect() == []
    of_one = t.read(11, 11)._jdf.queryExecution().executedPlan().toString()
    assert "_segments" not in of_one and "batch_id=11" in of_one and "batch_id=10" not in of_one


def test_replay_stays_exact_when_a_compaction_dies(spark, scratch, monkeypatch):
    """A compaction that dies before the manifest, or between it and the deletions, changes no row."""
    t = BatchTable(spark, scratch, SCHEMA, fanout=2)
    t.bind("stream")
    rows = lambda: sorted((r["batch_id"], r["n"]) for r in t.read().collect())
    for b in range(8):
        t.write(one(spark, b), b, "stream")
        t.write(one(spark, b), b, "stream")  # a replay before any compaction
        if b:
            for name in ("replace_text", "delete"):
                def dies(*args, **kwargs):
                    raise OSError("lost")

                with monkeypatch.context() as m:
                    m.setattr(HadoopFS, name, dies)
                    try:
                        t.compact(b - 1)
                    except OSError:
                        pass
                assert rows() == [(i, i) for i in range(b + 1)]
            t.compact(b - 1)
            t.write(one(spark, 999), 0, "stream")  # a proven replay of what is in segments
        assert rows() == [(i, i) for i in range(b + 1)]
    t.compact(7)
    t.write(one(spark, 8), 8, "stream")
    t.compact(8)
    assert t.segments.leftovers() == [] and rows() == [(i, i) for i in range(9)]
    assert [(r["batch_id"], r["n"]) for r in t.latest().collect()] == [(8, 8)]


def test_replace_text_is_one_step(spark, scratch):
    fs, file = HadoopFS(spark), f"{scratch}/state"
    fs.mkdirs(scratch)
    assert fs.read_text_or_none(file) is None
    for text in ("one", "two", "drei ü"):
        fs.replace_text(file, text)
        assert fs.read_text_or_none(file) == text
    assert fs.list_files(scratch) in (["state"], [".state.crc", "state"])


def test_empty_and_null_first_keys_stay_apart(spark, scratch):
    led = SummaryLedger(spark, scratch, ("d", "a"), fanout=2)
    rows = [(None, "x", 1), ("", "x", 2), ("d=1/%", "x", 4), ("__HIVE_DEFAULT_PARTITION__", "x", 8)]
    schema = "d string, a string, count bigint"
    for b in range(3):
        led.fold(spark.createDataFrame(rows, schema), b)
        led.compact(b - 1)
    whole = {r["d"]: r["count"] for r in led.read().collect()}
    assert whole == {d: 3 * n for d, _, n in rows}
    for days in ([None], [""], ["d=1/%"], [None, "d=1/%"], [], ["other"]):
        want = {d: n for d, n in whole.items() if d in days}
        assert {r["d"]: r["count"] for r in led.read(days).collect()} == want
        by_frame = spark.createDataFrame([(d,) for d in days], "d string")
        assert {r["d"]: r["count"] for r in led.read(by_frame).collect()} == want


def test_many_days_are_found_by_a_join(spark, scratch, monkeypatch):
    monkeypatch.setattr("linefold.sinks.ledger.DAYS", 2)
    led = SummaryLedger(spark, scratch, ("d", "a"))
    schema = "d string, a string, count bigint"
    for b in range(2):
        led.fold(spark.createDataFrame([(f"d{i}", "x", 1) for i in range(9)] + [(None, "x", 1)], schema), b)
    led.compact(0)
    days = spark.createDataFrame([("d1",), ("d2",), ("d3",), (None,)], "d string")
    assert led.day_values(days) is None
    assert {(r["d"], r["count"]) for r in led.read(days).collect()} == {("d1", 2), ("d2", 2), ("d3", 2), (None, 2)}


def test_replacing_days_leaves_the_session_alone(spark, scratch):
    mode = "spark.sql.sources.partitionOverwriteMode"
    db = "lf_test_days"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{scratch}/wh'")
    table = SummaryTable(spark, f"{db}.s", ["d", "a"], by_day=True)
    schema = "d string, a string, count bigint"
    try:
        table.replace_days(spark.createDataFrame([("d1", "a", 1), ("d2", "a", 2)], schema), ["d1", "d2"])
        seen = []
        original = type(spark.conf).set
        type(spark.conf).set = lambda self, k, v: (seen.append(k), original(self, k, v))[1]
        try:
            table.replace_days(spark.createDataFrame([("d2", "a", 5), ("d1", "b", 9)], schema), ["d2"])
        finally:
            type(spark.conf).set = original
        assert mode not in seen and spark.conf.get(mode).lower() == "static"
        assert {tuple(r[c] for c in ("d", "a", "count")) for r in table.read().collect()} == {("d1", "a", "1"), ("d2", "a", "5")}
    finally:
        table.drop()
        spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
