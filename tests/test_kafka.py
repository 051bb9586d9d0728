"""Kafka options and the Kafka-shaped table operators."""

import json

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from linefold.config import KafkaSpec
from linefold.plans.numbering import number_within_groups
from linefold.plans.records import event_records
from linefold.sources import kafka
from tests.conftest import SF_SMALL


def test_subscribe_options_dedupe_topics():
    spec = KafkaSpec("h1:9092,h2:9092", "a, b,a,,c", group_id="g")
    assert spec.topic_set() == ["a", "b", "c"]
    opts = spec.subscribe_options()
    assert opts == {
        "kafka.bootstrap.servers": "h1:9092,h2:9092",
        "kafka.group.id": "g",
        "subscribe": "a,b,c",
        "startingOffsets": "latest",
    }


def test_assign_options():
    spec = KafkaSpec("h:9092", "t")
    opts = spec.assign_options({("t", 1): 5, ("t", 0): 7, ("u", 2): 0})
    assert json.loads(opts["assign"]) == {"t": [0, 1], "u": [2]}
    assert json.loads(opts["startingOffsets"]) == {"t": {"0": 7, "1": 5}, "u": {"2": 0}}
    with pytest.raises(ValueError):
        spec.assign_options({})


def test_spec_from_original_config():
    spec = KafkaSpec.from_dict(
        {"bootstrapServers": "h:9092", "topicSet": "x;y;x", "topicSetSeperator": ";", "groupId": "g"}
    )
    assert spec.topic_set() == ["x", "y"]


def test_kafka_source_needs_connector(spark):
    # the connector jar is not installed here; the error names the data source
    with pytest.raises(Exception, match="(?i)kafka"):
        kafka.kafka_stream(spark, KafkaSpec("localhost:9092", "t"))


def records(spark):
    rows = [("t0", 0, o, None, None, f"v{o}") for o in range(10)] + [("t1", 0, o, None, None, f"w{o}") for o in range(3, 6)]
    return spark.createDataFrame(rows, "topic string, partition int, offset bigint, timestamp timestamp, key string, value string")


def test_subscribe_from_offsets_and_ranges(spark):
    r = records(spark)
    assert kafka.subscribe(r, "t1,t1").count() == 3
    starts = kafka.start_offsets(spark, {("t0", 0): 8, ("t1", 0): 0})
    got = sorted((x["topic"], x["offset"]) for x in kafka.from_offsets(r, starts).collect())
    assert got == [("t0", 8), ("t0", 9), ("t1", 3), ("t1", 4), ("t1", 5)]
    ranges = sorted(tuple(x) for x in kafka.offset_ranges(r).collect())
    assert ranges == [("t0", 0, 0, 10), ("t1", 0, 3, 6)]


def test_a_batch_cannot_start_at_latest(spark):
    with pytest.raises(ValueError, match="latest"):
        kafka.kafka_batch(spark, KafkaSpec("h:9092", "t"), starting="latest")


@pytest.mark.parametrize("width", [1, 7, 1 << 20])
def test_numbering_matches_window(spark, width):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").select("event_id", (F.col("user_id") % 3).alias("g"))
    ours = number_within_groups(ev, ["g"], "event_id", "n", block_width=width)
    w = Window.partitionBy("g").orderBy("event_id")
    ref = ev.withColumn("n", F.row_number().over(w) - 1)
    assert sorted(map(tuple, ours.select("event_id", "g", "n").collect())) == sorted(
        map(tuple, ref.select("event_id", "g", "n").collect())
    )


def test_event_records_offsets_dense(spark):
    rec = event_records(spark.read.parquet(f"{SF_SMALL}/events.parquet"))
    ranges = kafka.offset_ranges(rec).collect()
    counts = {(x["topic"], x["partition"]): x["n"] for x in rec.groupBy("topic", "partition").agg(F.count("*").alias("n")).collect()}
    for x in ranges:
        assert x["from_offset"] == 0 and x["until_offset"] == counts[(x["topic"], x["partition"])]


def test_numbering_keeps_null_keys(spark):
    rows = [("a", None), ("a", 3), ("a", 1), ("b", 2)]
    df = spark.createDataFrame(rows, "g string, k bigint")
    got = sorted((r["g"], r["k"] if r["k"] is not None else -1, r["n"])
                 for r in number_within_groups(df, ["g"], "k", "n", block_width=2).collect())
    assert got == [("a", -1, 0), ("a", 1, 1), ("a", 3, 2), ("b", 2, 0)]
