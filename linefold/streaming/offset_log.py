"""Offset ranges out of a checkpoint's offset log (R6), and the sets of offsets a ledger has folded.

Before Spark runs batch ``N`` it writes where the batch ends to ``offsets/N``; it begins where
``offsets/N-1`` ends. For sources with Kafka's offsets (``{topic: {partition: offset}}``) that pair
gives the range of every topic partition, whether records are in it or not: partitions
without new records, and gaps left by compaction, are seen as they are, and the
batch itself is not read. Where the first batch begins, the Kafka source keeps in ``sources/<i>/0``.

The log keeps the newest batches only (``spark.sql.streaming.minBatchesToRetain``), so jobs store
each batch's ranges while it runs (``batch_ranges``); ``log_ranges`` reads all that is left.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linefold.functions.split import sql_str
from linefold.session import HadoopFS


class OffsetRange(NamedTuple):
    """Offsets ``first..until-1`` of a topic partition; ``first`` is None where it is not known."""

    topic: str
    partition: int
    first: int | None
    until: int


#: Per (topic, partition) the folded offsets as ascending, disjoint ``(first, until)``.
Intervals = dict[tuple[str, int], list[tuple[int, int]]]


def parse_offsets(text: str) -> list[dict[tuple[str, int], int]]:
    """Per source, the offsets in a file of the log (none for sources without Kafka's offsets)."""
    found = []
    for line in text.split("\n")[2:]:
        try:
            raw = json.loads(line)
        except ValueError:  # "-": the source has no offset yet
            raw = None
        maps = raw if isinstance(raw, dict) and all(isinstance(v, dict) for v in raw.values()) else {}
        found.append({(t, int(p)): int(o) for t, parts in maps.items() for p, o in parts.items()})
    return found


def _initial(fs: HadoopFS, checkpoint: str, source: int) -> dict[tuple[str, int], int]:
    """Where the Kafka source began, as it noted at its first start."""
    text = fs.read_text_or_none(f"{checkpoint}/sources/{source}/0")
    found = parse_offsets(f"\n\n{text[text.index('{'):]}") if text and "{" in text else []
    return found[0] if found else {}


def batch_ranges(fs: HadoopFS, checkpoint: str, batch_id: int) -> list[OffsetRange] | None:
    """The ranges of one batch, which may still be running; None if its sources have no Kafka offsets or the log is gone.

    A partition that the batch before did not know begins at 0; in the first batch, one whose start was not noted
    begins nowhere known.
    """
    checkpoint = checkpoint.rstrip("/")
    text = fs.read_text_or_none(f"{checkpoint}/offsets/{batch_id}")
    ends = parse_offsets(text) if text else []
    if not any(ends):
        return None
    before = fs.read_text_or_none(f"{checkpoint}/offsets/{batch_id - 1}") if batch_id else None
    if batch_id and before is None:
        return None
    starts = parse_offsets(before) if before else []
    out = []
    for i, of_source in enumerate(ends):
        begun = starts[i] if i < len(starts) else {}
        if of_source and not begun:
            begun = _initial(fs, checkpoint, i)
        unknown = None if batch_id == 0 and not begun else 0
        out += [OffsetRange(t, p, begun.get((t, p), unknown), until) for (t, p), until in sorted(of_source.items())]
    return out


def log_ranges(spark: SparkSession, checkpoint: str, initial: Mapping[tuple[str, int], int] | None = None) -> DataFrame:
    """``batch_id, topic, partition, from_offset, until_offset`` of every batch the log still holds.

    ``initial`` are the offsets the stream was started from, if the source did not note them; the first batch's
    ``from_offset`` is null where nothing tells it, as is that of the oldest batch in a log that lost older ones.
    """
    checkpoint = checkpoint.rstrip("/")
    noted = dict(initial or {}) or _initial(HadoopFS(spark), checkpoint, 0)
    files = spark.read.text(f"{checkpoint}/offsets", wholetext=True).select(
        F.col("_metadata.file_name").cast("bigint").alias("batch_id"), F.split("value", "\n").alias("lines")
    )
    offsets = F.from_json("json", "map<string,map<string,bigint>>")
    ends = (
        files.select("batch_id", F.posexplode("lines").alias("source", "json"))
        .filter("source >= 2")
        .select("batch_id", "source", F.explode(offsets).alias("topic", "parts"))
        .select("batch_id", "source", "topic", F.explode("parts").alias("partition", "until_offset"))
        .withColumn("partition", F.col("partition").cast("int"))
    )
    # the log is short: a window for each partition over the batches that it holds
    held = files.agg(F.min("batch_id").alias("oldest"))
    order = Window.partitionBy("source", "topic", "partition").orderBy("batch_id")
    first = starts_table(spark, noted)
    rows = ends.withColumn("before", F.lag("until_offset").over(order)).join(held, how="cross").join(first, ["topic", "partition"], "left")
    begun = F.when(F.col("batch_id") > F.col("oldest"), F.coalesce("before", F.lit(0))).when(F.col("batch_id") == 0, F.col("noted"))
    return rows.select("batch_id", "topic", "partition", begun.cast("bigint").alias("from_offset"), "until_offset")


def starts_table(spark: SparkSession, starts: Mapping[tuple[str, int], int]) -> DataFrame:
    """``topic, partition, noted`` as literal rows."""
    if not starts:
        return spark.createDataFrame([], "topic string, partition int, noted bigint")
    rows = ", ".join(f"({sql_str(t)}, {int(p)}, {int(o)}L)" for (t, p), o in sorted(starts.items()))
    return spark.sql(f"SELECT * FROM VALUES {rows} AS s(topic, partition, noted)")


# -- sets of folded offsets ------------------------------------------------------
def with_ranges(folded: Intervals, ranges: Iterable[OffsetRange]) -> Intervals:
    """The intervals with the ranges added; those that touch or overlap become one."""
    out = {k: list(v) for k, v in folded.items()}
    for r in ranges:
        if r.first is not None and r.first <= r.until:
            out.setdefault((r.topic, r.partition), []).append((r.first, r.until))
    for key, spans in out.items():
        joined: list[tuple[int, int]] = []
        for first, until in sorted(spans):
            if joined and first <= joined[-1][1]:
                joined[-1] = (joined[-1][0], max(joined[-1][1], until))
            else:
                joined.append((first, until))
        # an empty range only says where its partition stands
        out[key] = [s for s in joined if s[0] < s[1]] or joined[-1:]
    return out


def next_offsets(folded: Intervals) -> dict[tuple[str, int], int]:
    """Where to go on so that nothing is left out: the end of each partition's first interval."""
    return {key: spans[0][1] for key, spans in folded.items()}


def overlap(folded: Intervals, ranges: Iterable[OffsetRange]) -> Intervals:
    """The intervals that a batch with these ranges would fold again."""
    found: Intervals = {}
    for r in ranges:
        spans = [s for s in folded.get((r.topic, r.partition), []) if s[0] < r.until and (r.first is None or s[1] > r.first)]
        if spans:
            found[r.topic, r.partition] = spans
    return found


def without(records: DataFrame, folded: Intervals) -> DataFrame:
    """The records whose offsets are in none of the intervals (a few literal rows)."""
    rows = ", ".join(f"({sql_str(t)}, {p}, {a}L, {b}L)" for (t, p), spans in sorted(folded.items()) for a, b in spans)
    if not rows:
        return records
    done = records.sparkSession.sql(f"SELECT * FROM VALUES {rows} AS s(_topic, _partition, _first, _until)")
    within = (F.col("offset") >= F.col("_first")) & (F.col("offset") < F.col("_until"))
    return records.join(done, (F.col("topic") == F.col("_topic")) & (F.col("partition") == F.col("_partition")) & within, "left_anti")


def dump_intervals(folded: Intervals) -> list[list]:
    """The intervals as JSON values."""
    return [[t, p, [list(s) for s in spans]] for (t, p), spans in sorted(folded.items())]


def load_intervals(raw: Iterable) -> Intervals:
    return {(t, int(p)): [(int(a), int(b)) for a, b in spans] for t, p, spans in raw}
