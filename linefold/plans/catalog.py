"""Registered queries: one per operator group of the inventory.

Each query takes ``(spark, sf_dir)``, reads the given tables (``events``),
renders them as transaction-log lines and runs the library on them over the
whole table. Fold and stream queries render the lines once, partitioned by
slice (``event_id % 4``); stream queries land one slice after the other as text
files and run one ``availableNow`` micro-batch per slice, so batch ``k`` holds
slice ``k``. Their state lives under the session's shared checkpoint folder;
the staged lines are deleted when the query has used them. Every query returns a DataFrame; the stream and table
queries have already done their work when they return, and the DataFrame
reads what they left behind.

The modulo expressions here (``event_id % 4`` slices, ``% 5`` / ``% 6``
damage kinds, ``% 2`` topics, ``user_id % 3`` partitions) only assign rows to
batches and fixture roles; no query drops a row of ``events``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linefold.config import FieldSpec, KafkaSpec, LogSpec, SummarySpec
from linefold.operators.parse import parse, parse_accepted, rejects
from linefold.operators.summary import apply_predicate, count_by, preview, rollup_counts, summarize
from linefold.plans.events_log import damaged_event_lines, event_lines, ragged_event_lines
from linefold.plans.partitioning import spread
from linefold.plans.records import PARTITION_SQL, TOPIC_SQL, event_records
from linefold.session import HadoopFS, scratch_path
from linefold.sinks.batch_table import BatchTable
from linefold.sinks.ledger import SummaryLedger
from linefold.sinks.tables import SummaryTable
from linefold.sources import kafka
from linefold.sources.landed import land_records, landed_stream
from linefold.sources.lines import stream_lines, write_lines
from linefold.streaming.jobs import (
    COUNT_SCHEMA,
    RANGE_SCHEMA,
    REJECT_SCHEMA,
    TOTAL_SCHEMA,
    run_bounded,
    start_archive,
    start_batch_counts,
    start_running_total,
    start_summary_stream,
)
from linefold.streaming.offset_log import log_ranges

SLICES = 4
AVAILABLE_NOW = {"availableNow": True}
PARSED_COLS = ["id", "time_stamp", "app_id", "channel_type", "travel_direction"]
# Start offsets for the explicit-offset read: (topic, partition) -> first offset.
FROM_OFFSETS = {("t0", 0): 100, ("t0", 1): 0, ("t1", 2): 250}
SUBSCRIBED_TOPICS = "t1,t1"


def log_spec() -> LogSpec:
    """Transaction layout plus field 1 as ``id``."""
    return LogSpec.transaction_log().with_fields(FieldSpec("id", 1))


def summary_spec() -> SummarySpec:
    return SummarySpec()


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` table, spread over the cores if its scan is too coarse."""
    return spread(spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet"))


def lines_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_lines(events(spark, sf_dir))


@contextmanager
def staged(sliced: DataFrame, root: str) -> Iterator[Callable[[int], DataFrame]]:
    """Write ``sliced`` (with a ``slice`` column) once, partitioned by slice; gives a pruned read of one slice.

    The staged copy is deleted at the end, when every slice has been used.
    """
    spark, path = sliced.sparkSession, f"{root}/staged"
    sliced.write.partitionBy("slice").parquet(path)
    try:
        yield lambda k: spark.read.parquet(path).filter(F.col("slice") == k).drop("slice")
    finally:
        HadoopFS(spark).delete(path)


def sliced_lines(lines: DataFrame) -> DataFrame:
    return lines.select((F.col("event_id") % SLICES).alias("slice"), "value")


# -- batch queries -------------------------------------------------------------
def q_parse_lines(spark, sf_dir):
    return parse_accepted(lines_of(spark, sf_dir), log_spec()).select(*PARSED_COLS)


def q_parse_ragged(spark, sf_dir):
    return parse_accepted(ragged_event_lines(events(spark, sf_dir)), log_spec()).select(*PARSED_COLS)


def q_parse_rejects(spark, sf_dir):
    parsed = parse(damaged_event_lines(events(spark, sf_dir)), log_spec(), keep=["event_id"])
    return rejects(parsed, keep=["event_id"])


def q_filter_predicate(spark, sf_dir):
    good = parse_accepted(lines_of(spark, sf_dir), log_spec())
    return apply_predicate(good, summary_spec().predicate).select(*PARSED_COLS)


def q_group_count(spark, sf_dir):
    return summarize(lines_of(spark, sf_dir), LogSpec.transaction_log(), summary_spec())


def q_summary_rollup(spark, sf_dir):
    """Per-slice counts stored as strings, rolled up per key."""
    spec = summary_spec()
    good = apply_predicate(parse_accepted(lines_of(spark, sf_dir), log_spec()), spec.predicate)
    stored = count_by(good.withColumn("slice", F.col("id").cast("bigint") % SLICES), ["slice", *spec.keys])
    stored = stored.withColumn("count", F.col("count").cast("string"))
    return rollup_counts(stored, spec.keys, as_string=True)


def _fold_slices(spark, sf_dir, name: str, no_match: bool = False) -> SummaryLedger:
    lspec, sspec = LogSpec.transaction_log(), summary_spec()
    root = scratch_path(spark, name)
    ledger = SummaryLedger(spark, f"{root}/summary", sspec.keys)
    with staged(sliced_lines(lines_of(spark, sf_dir)), root) as part:
        for k in range(SLICES):
            ledger.fold(summarize(part(k), lspec, sspec), k)
        if no_match:
            # a batch of real lines, none of which passes, leaves no partition behind
            nothing = replace(sspec, predicate="channel_type = 'no such channel'")
            ledger.fold(summarize(part(0), lspec, nothing), SLICES)
    return ledger


def q_summary_fold(spark, sf_dir):
    return _fold_slices(spark, sf_dir, "summary_fold").read()


def q_summary_empty_batch(spark, sf_dir):
    return _fold_slices(spark, sf_dir, "summary_empty_batch", no_match=True).read()


def q_summary_read(spark, sf_dir):
    return _fold_slices(spark, sf_dir, "summary_read").read_compat()


def q_table_lifecycle(spark, sf_dir):
    """Fold the slices into a catalog table the original way, then read it back."""
    root = scratch_path(spark, "table_lifecycle")
    db = "linefold_" + root.rsplit("-", 1)[-1]
    spec = summary_spec()
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}` LOCATION '{root}/warehouse'")
    table = SummaryTable(spark, f"{db}.{spec.table}", spec.keys, staging_table=f"{db}.{spec.staging_table}")
    try:
        with staged(sliced_lines(lines_of(spark, sf_dir)), root) as part:
            for k in range(SLICES):
                table.rewrite_fold(summarize(part(k), LogSpec.transaction_log(), spec))
        snapshot = f"{root}/snapshot"
        table.read().write.mode("overwrite").parquet(snapshot)
    finally:
        table.drop_staging()
        table.drop()
        spark.sql(f"DROP DATABASE IF EXISTS `{db}` CASCADE")
    return spark.read.parquet(snapshot)


def q_summary_table_stream(spark, sf_dir):
    """Stream with the original catalog table (count as a string) kept equal to the ledger, day by day."""
    spec = summary_spec()
    with _landing(spark, sf_dir, "summary_table_stream") as landing:
        db = "linefold_" + landing.root.rsplit("-", 1)[-1]
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}` LOCATION '{landing.root}/warehouse'")
        table = SummaryTable(spark, f"{db}.{spec.table}", spec.keys, by_day=True)
        ledger = SummaryLedger(spark, f"{landing.root}/summary", spec.keys)
        try:
            _run_slices(landing, lambda resume: start_summary_stream(
                landing.stream(), LogSpec.transaction_log(), spec, ledger, landing.checkpoint,
                trigger=AVAILABLE_NOW, resume=resume, mirror_table=table))
            snapshot = f"{landing.root}/snapshot"
            table.read().select(*spec.keys, spec.count_col).write.mode("overwrite").parquet(snapshot)
        finally:
            table.drop()
            spark.sql(f"DROP DATABASE IF EXISTS `{db}` CASCADE")
    return spark.read.parquet(snapshot)


def q_preview(spark, sf_dir):
    """The first ten rows of the summary, in the order of its keys."""
    spec = summary_spec()
    return preview(summarize(lines_of(spark, sf_dir), LogSpec.transaction_log(), spec), 10, spec.keys)


# -- Kafka-shaped records ------------------------------------------------------
def records_of(spark, sf_dir):
    return event_records(events(spark, sf_dir))


def q_topic_subscribe(spark, sf_dir):
    return kafka.subscribe(records_of(spark, sf_dir), SUBSCRIBED_TOPICS).select("topic", "partition", "offset", "value")


def q_read_from_offsets(spark, sf_dir):
    starts = kafka.start_offsets(spark, FROM_OFFSETS)
    return kafka.from_offsets(records_of(spark, sf_dir), starts).select("topic", "partition", "offset", "value")


def q_offset_ranges(spark, sf_dir):
    return kafka.offset_ranges(records_of(spark, sf_dir))


# -- streams -------------------------------------------------------------------
class _Landing:
    """Input folder for a file stream, filled one slice at a time."""

    def __init__(self, spark, root: str, part: Callable[[int], DataFrame]):
        self.spark, self.root, self.part = spark, root, part
        self.input = f"{root}/input"
        self.checkpoint = f"{root}/checkpoint"

    def land(self, k: int) -> None:
        write_lines(self.part(k), self.input)

    def stream(self, **options) -> DataFrame:
        return stream_lines(self.spark, self.input, **options)


@contextmanager
def _landing(spark, sf_dir, name: str, lines: DataFrame | None = None) -> Iterator[_Landing]:
    root = scratch_path(spark, name)
    with staged(sliced_lines(lines if lines is not None else lines_of(spark, sf_dir)), root) as part:
        yield _Landing(spark, root, part)


def _run_slices(landing: _Landing, start, slices=range(SLICES)) -> None:
    for k in slices:
        landing.land(k)
        run_bounded(start(resume="auto"))


def q_summary_stream(spark, sf_dir):
    with _landing(spark, sf_dir, "summary_stream") as landing:
        ledger = SummaryLedger(spark, f"{landing.root}/summary", summary_spec().keys)
        _run_slices(landing, lambda resume: start_summary_stream(
            landing.stream(), LogSpec.transaction_log(), summary_spec(), ledger,
            landing.checkpoint, trigger=AVAILABLE_NOW, resume=resume))
    return ledger.read()


def q_summary_compact(spark, sf_dir):
    """Stream with ledger compaction every two batches and archived source files."""
    with _landing(spark, sf_dir, "summary_compact") as landing:
        ledger = SummaryLedger(spark, f"{landing.root}/summary", summary_spec().keys)
        _run_slices(landing, lambda resume: start_summary_stream(
            landing.stream(clean_source="archive", source_archive_dir=f"{landing.root}/done"),
            LogSpec.transaction_log(), summary_spec(), ledger,
            landing.checkpoint, trigger=AVAILABLE_NOW, resume=resume, compact_every=2))
    return ledger.read()


def q_summary_restart(spark, sf_dir):
    """A stopped stream and strict resumes still give the batch answer."""
    with _landing(spark, sf_dir, "summary_restart") as landing:
        ledger = SummaryLedger(spark, f"{landing.root}/summary", summary_spec().keys)

        def start(resume, trigger=AVAILABLE_NOW):
            return start_summary_stream(
                landing.stream(), LogSpec.transaction_log(), summary_spec(), ledger,
                landing.checkpoint, trigger=trigger, resume=resume,
            )

        # first run: a long-running trigger, drained, then stopped from outside
        landing.land(0)
        q = start("new", {"processingTime": "1 second"})
        q.processAllAvailable()
        run_bounded(q, 0.1)
        # later runs must resume from the checkpoint
        for k in range(1, SLICES):
            landing.land(k)
            run_bounded(start("require"))
    return ledger.read()


def q_kafka_summary_stream(spark, sf_dir):
    """Kafka-layout records as a stream: subscribe -> value -> parse -> fold.

    Records rendered from ``events`` land as parquet by topic, one slice per
    run; the stream reads them with the Kafka source's schema, keeps the
    subscribed topic (other topics' files are not read) and folds the record
    values into the ledger, as a Kafka source feeding the same job would.
    """
    root = scratch_path(spark, "kafka_summary_stream")
    ledger = SummaryLedger(spark, f"{root}/summary", summary_spec().keys)
    with staged(records_of(spark, sf_dir).withColumn("slice", F.col("offset") % SLICES), root) as part:
        for k in range(SLICES):
            part(k).write.mode("append").partitionBy("topic").parquet(f"{root}/input")
            stream = spark.readStream.schema(part(k).schema).parquet(f"{root}/input")
            run_bounded(start_summary_stream(
                kafka.subscribe(stream, SUBSCRIBED_TOPICS), LogSpec.transaction_log(), summary_spec(), ledger,
                f"{root}/checkpoint", trigger=AVAILABLE_NOW,
            ))
    return ledger.read()


def _quarters(spark, sf_dir) -> DataFrame:
    """Records with ``slice``: the quarter of its partition's offsets that a record is in."""
    sizes = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet").selectExpr(TOPIC_SQL, PARTITION_SQL)
    sizes = sizes.groupBy("topic", "partition").agg(F.count(F.lit(1)).alias("_size"))
    quarter = F.floor(F.col("offset") * SLICES / F.col("_size")).cast("bigint")
    return records_of(spark, sf_dir).join(sizes, ["topic", "partition"]).withColumn("slice", quarter).drop("_size")


def q_offset_report_stream(spark, sf_dir):
    """The stream that folds Kafka-layout records reports each batch's offset ranges.

    Run ``k`` lands the ``k``-th quarter of every partition's offsets, so each
    batch covers one contiguous range per partition, as a Kafka batch does.
    """
    root = scratch_path(spark, "offset_report_stream")
    ledger = SummaryLedger(spark, f"{root}/summary", summary_spec().keys)
    ranges = BatchTable(spark, f"{root}/ranges", RANGE_SCHEMA)
    columns = ["topic", "partition", "offset", "value"]
    with staged(_quarters(spark, sf_dir).select("slice", *columns), root) as part:
        for k in range(SLICES):
            part(k).write.mode("append").parquet(f"{root}/input")
            run_bounded(start_summary_stream(
                spark.readStream.schema(part(k).schema).parquet(f"{root}/input"),
                LogSpec.transaction_log(), summary_spec(), ledger, f"{root}/checkpoint",
                trigger=AVAILABLE_NOW, range_sink=ranges,
            ))
    return ranges.read().select(F.col("batch_id").alias("slice"), "topic", "partition", "from_offset", "until_offset")


@contextmanager
def _landed_quarters(spark, sf_dir, name: str) -> Iterator[tuple[str, Callable[[int], None]]]:
    """A folder for a query, and a function that lands the ``k``-th quarter of every partition's offsets in its ``topic``."""
    root = scratch_path(spark, name)
    with staged(_quarters(spark, sf_dir).select("slice", "topic", "partition", "offset", "value"), root) as part:
        yield root, lambda k: land_records(part(k), f"{root}/topic", f"quarter-{k}")


def _landed_spec(starting: str = "earliest", topics: str = "t0,t1") -> KafkaSpec:
    return KafkaSpec("landed", topics, starting_offsets=starting)


def q_topic_stream(spark, sf_dir):
    """A landed topic, subscribed to from its first offset and folded with Kafka's offsets in the checkpoint."""
    with _landed_quarters(spark, sf_dir, "topic_stream") as (root, land):
        ledger = SummaryLedger(spark, f"{root}/summary", summary_spec().keys)
        for k in range(SLICES):
            land(k)
            run_bounded(start_summary_stream(
                landed_stream(spark, f"{root}/topic", _landed_spec(topics=SUBSCRIBED_TOPICS)), LogSpec.transaction_log(),
                summary_spec(), ledger, f"{root}/checkpoint", trigger=AVAILABLE_NOW))
    return ledger.read()


def q_topic_from_latest(spark, sf_dir):
    """A subscription that starts at ``latest`` folds what lands after its start: the second half of every partition (S3)."""
    with _landed_quarters(spark, sf_dir, "topic_from_latest") as (root, land):
        ledger = SummaryLedger(spark, f"{root}/summary", summary_spec().keys)
        for k in range(SLICES // 2):
            land(k)
        query = start_summary_stream(
            landed_stream(spark, f"{root}/topic", _landed_spec("latest")), LogSpec.transaction_log(), summary_spec(), ledger,
            f"{root}/checkpoint", trigger={"processingTime": "1 second"})
        query.processAllAvailable()
        for k in range(SLICES // 2, SLICES):
            land(k)
        query.processAllAvailable()
        run_bounded(query, 0.1)
    return ledger.read()


def q_offset_log_ranges(spark, sf_dir):
    """Offset ranges of every batch and partition out of the checkpoint's offset log; no record is read for them."""
    starts = {(f"t{t}", p): 0 for t in range(2) for p in range(3)}
    with _landed_quarters(spark, sf_dir, "offset_log_ranges") as (root, land):
        ledger = SummaryLedger(spark, f"{root}/summary", summary_spec().keys)
        for k in range(SLICES):
            land(k)
            run_bounded(start_summary_stream(
                landed_stream(spark, f"{root}/topic", _landed_spec(), starts), LogSpec.transaction_log(), summary_spec(), ledger,
                f"{root}/checkpoint", trigger=AVAILABLE_NOW))
    ranges = log_ranges(spark, f"{root}/checkpoint", starts)
    return ranges.select(F.col("batch_id").alias("slice"), "topic", "partition", "from_offset", "until_offset")


def q_summary_takeover(spark, sf_dir):
    """The checkpoint is lost half way; a new stream goes on from the offsets the ledger holds, and reads some twice."""
    with _landed_quarters(spark, sf_dir, "summary_takeover") as (root, land):
        ledger = SummaryLedger(spark, f"{root}/summary", summary_spec().keys)

        def run(checkpoint: str, starts=None, **how) -> None:
            run_bounded(start_summary_stream(
                landed_stream(spark, f"{root}/topic", _landed_spec(), starts), LogSpec.transaction_log(), summary_spec(), ledger,
                f"{root}/{checkpoint}", trigger=AVAILABLE_NOW, compact_every=2, **how))

        for k in range(SLICES - 1):
            land(k)
            run("lost")
        # a tenth of what was folded is read again
        starts = {at: offset - offset // 10 for at, offset in ledger.next_offsets().items()}
        run("new", starts, takeover=True)
        land(SLICES - 1)
        run("new", starts, resume="require")
    return ledger.read()


def _damaged_stream(spark, sf_dir, name: str) -> tuple[SummaryLedger, BatchTable]:
    """Damaged lines through the stream: the ledger, and the rejects per batch next to it.

    Text files cannot hold a NULL line (it lands as an empty line), so here
    those are rejected as too short rather than as ``null_value``.
    """
    with _landing(spark, sf_dir, name, damaged_event_lines(events(spark, sf_dir))) as landing:
        ledger = SummaryLedger(spark, f"{landing.root}/summary", summary_spec().keys)
        rejected = BatchTable(spark, f"{landing.root}/rejects", REJECT_SCHEMA)
        _run_slices(landing, lambda resume: start_summary_stream(
            landing.stream(), LogSpec.transaction_log(), summary_spec(), ledger, landing.checkpoint,
            trigger=AVAILABLE_NOW, resume=resume, reject_sink=rejected, compact_every=2))
    return ledger, rejected


def q_stream_rejects(spark, sf_dir):
    rejected = _damaged_stream(spark, sf_dir, "stream_rejects")[1]
    return rejected.read().select(F.col("batch_id").alias("slice"), "value", "reason")


def q_stream_accepted(spark, sf_dir):
    """What the run of ``stream_rejects`` folded of the lines it did accept."""
    return _damaged_stream(spark, sf_dir, "stream_accepted")[0].read()


def q_batch_counts(spark, sf_dir):
    """Rows per micro-batch; the sink compacts every two batches, so the read joins segments and partitions."""
    with _landing(spark, sf_dir, "batch_counts") as landing:
        sink = BatchTable(spark, f"{landing.root}/counts", COUNT_SCHEMA)
        _run_slices(landing, lambda resume: start_batch_counts(
            landing.stream(), sink, landing.checkpoint, trigger=AVAILABLE_NOW, resume=resume, compact_every=2))
    return sink.read().select(F.col("batch_id").alias("slice"), "n")


def q_running_total(spark, sf_dir):
    with _landing(spark, sf_dir, "running_total") as landing:
        sink = BatchTable(spark, f"{landing.root}/totals", TOTAL_SCHEMA)
        _run_slices(landing, lambda resume: start_running_total(
            landing.stream(), sink, landing.checkpoint, trigger=AVAILABLE_NOW, resume=resume))
    return sink.read().select(F.col("batch_id").alias("slice"), "total")


def q_raw_archive(spark, sf_dir):
    with _landing(spark, sf_dir, "raw_archive") as landing:
        archive = f"{landing.root}/archive"
        _run_slices(landing, lambda resume: start_archive(
            landing.stream(), archive, landing.checkpoint, trigger=AVAILABLE_NOW, resume=resume))
    lines = spark.read.schema("value string").parquet(archive)
    return lines.select(F.substring_index("value", "|", 1).cast("bigint").alias("event_id"), "value")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "parse_lines": q_parse_lines,
    "parse_ragged": q_parse_ragged,
    "parse_rejects": q_parse_rejects,
    "filter_predicate": q_filter_predicate,
    "group_count": q_group_count,
    "summary_rollup": q_summary_rollup,
    "summary_fold": q_summary_fold,
    "summary_empty_batch": q_summary_empty_batch,
    "summary_read": q_summary_read,
    "summary_stream": q_summary_stream,
    "summary_restart": q_summary_restart,
    "summary_compact": q_summary_compact,
    "kafka_summary_stream": q_kafka_summary_stream,
    "stream_rejects": q_stream_rejects,
    "stream_accepted": q_stream_accepted,
    "batch_counts": q_batch_counts,
    "running_total": q_running_total,
    "raw_archive": q_raw_archive,
    "topic_subscribe": q_topic_subscribe,
    "read_from_offsets": q_read_from_offsets,
    "offset_ranges": q_offset_ranges,
    "offset_report_stream": q_offset_report_stream,
    "topic_stream": q_topic_stream,
    "topic_from_latest": q_topic_from_latest,
    "offset_log_ranges": q_offset_log_ranges,
    "summary_takeover": q_summary_takeover,
    "table_lifecycle": q_table_lifecycle,
    "summary_table_stream": q_summary_table_stream,
    "preview": q_preview,
}
