"""Kafka input.

Two halves:

* ``kafka_stream`` / ``kafka_batch`` build Spark's own Kafka source from a
  ``KafkaSpec``. The connector (``spark-sql-kafka-0-10``) must be on the
  session's classpath; it is not bundled here.
* Operators over a *Kafka-shaped* table ``(topic, partition, offset,
  timestamp, key, value)``, the schema Spark's Kafka source produces (and the
  layout of a landed topic): topic subscription, reading from explicit start
  offsets, and offset-range reports. They are how the same selections are
  done in batch, and how they are tested without a broker.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from linefold.config import KafkaSpec
from linefold.functions.split import sql_str
from linefold.sources.lines import record_values

START_SCHEMA = StructType(
    [
        StructField("topic", StringType(), False),
        StructField("partition", IntegerType(), False),
        StructField("from_offset", LongType(), False),
    ]
)


def kafka_stream(spark: SparkSession, spec: KafkaSpec, from_offsets: Mapping | None = None) -> DataFrame:
    """Streaming Kafka records, subscribed (S1) or assigned from offsets."""
    opts = spec.assign_options(from_offsets) if from_offsets else spec.subscribe_options()
    return spark.readStream.format("kafka").options(**opts).load()


def kafka_lines(spark: SparkSession, spec: KafkaSpec, from_offsets: Mapping | None = None) -> DataFrame:
    """Streaming record values as lines (``value STRING``), ready for ``parse``."""
    return record_values(kafka_stream(spark, spec, from_offsets))


def kafka_batch(
    spark: SparkSession,
    spec: KafkaSpec,
    from_offsets: Mapping | None = None,
    *,
    starting: str = "earliest",
    ending: str = "latest",
) -> DataFrame:
    """Batch read of a topic range, from ``starting`` (or ``from_offsets``) to ``ending``.

    The starting offsets of ``spec`` are for streams; a batch cannot start at ``latest``.
    """
    if starting == "latest":
        raise ValueError("a batch that starts at 'latest' reads nothing")
    if from_offsets:
        opts = spec.assign_options(from_offsets)
    else:
        opts = spec.subscribe_options() | {"startingOffsets": starting}
    opts["endingOffsets"] = ending
    return spark.read.format("kafka").options(**opts).load()


# -- operators over Kafka-shaped tables ---------------------------------------
def subscribe(records: DataFrame, topics: Iterable[str] | str, separator: str = ",") -> DataFrame:
    """Records of the given topics (S1, S2); duplicates in the list are ignored."""
    names = KafkaSpec("", topics, topic_separator=separator).topic_set()
    return records.filter(F.col("topic").isin(names))


def start_offsets(spark: SparkSession, from_offsets: Mapping[tuple[str, int], int]) -> DataFrame:
    """``topic, partition, from_offset`` from a ``{(topic, partition): offset}`` map.

    Literal rows, so that the planner knows their size.
    """
    if not from_offsets:
        return spark.createDataFrame([], START_SCHEMA)
    rows = ", ".join(f"({sql_str(t)}, {int(p)}, {int(o)}L)" for (t, p), o in sorted(from_offsets.items()))
    return spark.sql(f"SELECT * FROM VALUES {rows} AS s(topic, partition, from_offset)")


def from_offsets(records: DataFrame, starts: DataFrame) -> DataFrame:
    """Records of the assigned partitions at or after their start offset.

    ``starts`` has one row per assigned ``(topic, partition)``; unassigned
    partitions are not read. Spark broadcasts it by its own size threshold.
    """
    s = starts.select("topic", "partition", "from_offset")
    return records.join(
        s,
        (records["topic"] == s["topic"]) & (records["partition"] == s["partition"]) & (records["offset"] >= s["from_offset"]),
        "left_semi",
    )


def offset_ranges(records: DataFrame) -> DataFrame:
    """``topic, partition, from_offset, until_offset`` (until exclusive) per partition.

    From the records themselves: partitions without records are absent, and
    gaps (compacted topics) are not visible; for a live stream the query
    progress (``streaming.jobs.progress_offset_ranges``) is authoritative.
    """
    return records.groupBy("topic", "partition").agg(
        F.min("offset").alias("from_offset"), (F.max("offset") + 1).alias("until_offset")
    )
