"""Structured Streaming jobs.

All jobs take a streaming line DataFrame (``value STRING``, from
``sources.lines.stream_lines`` or a Kafka source) and a checkpoint folder.
The checkpoint holds the source position; the sinks are idempotent per batch
id, so a batch re-run after a failure replaces its own output.

``resume`` decides how a checkpoint is used:

* ``"auto"``    resume when the checkpoint has query metadata, else start new;
* ``"require"`` refuse to start unless it has (a job that must never silently
  start from scratch);
* ``"new"``     refuse to start if it has.

An output belongs to the checkpoint of the stream that first wrote to it (its
``_owner`` file). Batch ids restart at 0 with a new checkpoint, so a fresh
checkpoint next to an output that holds batches would overwrite history, and a
checkpoint that has gone on with another output would leave a gap in this one.
Both starts are refused.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from linefold.config import LogSpec, SummarySpec
from linefold.operators.parse import REJECT_COL, accepted, parse, rejects
from linefold.operators.summary import apply_predicate, count_by, count_with_rejects, rejected_lines
from linefold.session import HadoopFS, scratch_path
from linefold.sinks.batch_table import BatchTable, Owned
from linefold.sinks.ledger import SummaryLedger
from linefold.sinks.tables import SummaryTable
from linefold.sources.kafka import offset_ranges
from linefold.streaming.offset_log import Intervals, OffsetRange, batch_ranges, overlap, without

DEFAULT_TRIGGER: Mapping = {"processingTime": "2 seconds"}
# A 2-second stream adds ~43k ledger partitions a day; folding them into the
# base every 100 batches keeps reads to one base plus < 100 small partitions.
DEFAULT_COMPACT_EVERY = 100
RESUME_MODES = ("auto", "require", "new")

COUNT_SCHEMA = StructType([StructField("n", LongType(), True)])
TOTAL_SCHEMA = StructType([StructField("total", LongType(), True)])
REJECT_SCHEMA = StructType([StructField("value", StringType(), True), StructField("reason", StringType(), True)])


class CheckpointError(RuntimeError):
    pass


def checkpoint_id(spark, checkpoint: str) -> str | None:
    """Id of the query whose checkpoint this is; None if no query has started from it."""
    fs, file = HadoopFS(spark), f"{checkpoint.rstrip('/')}/metadata"
    return json.loads(fs.read_text(file))["id"] if fs.exists(file) else None


def check_resume(spark, checkpoint: str, resume: str, *outputs, takeover: bool = False) -> bool:
    """Validate ``resume`` and the outputs against the checkpoint (R3, R4); True when resuming.

    With ``takeover`` a new checkpoint may go on with outputs that hold another stream's batches.
    """
    if resume not in RESUME_MODES:
        raise ValueError(f"resume must be one of {RESUME_MODES}")
    ident = checkpoint_id(spark, checkpoint)
    if resume == "require" and ident is None:
        raise CheckpointError(f"no checkpoint at {checkpoint}; the query must resume from one")
    if resume == "new" and ident is not None:
        raise CheckpointError(f"checkpoint {checkpoint} already exists")
    gone_on = any(n.isdigit() for n in HadoopFS(spark).list_files(f"{checkpoint.rstrip('/')}/commits"))
    for out in (o for o in outputs if o is not None):
        owner = out.owner() if isinstance(out, Owned) else None
        if takeover and isinstance(out, Owned) and not gone_on:
            continue
        if ident is None and (owner is not None or not out.is_empty()):
            raise CheckpointError(
                f"checkpoint {checkpoint} is new but {out.path} already holds batches; "
                "batch ids would restart at 0 and overwrite them"
            )
        if ident is not None and owner is not None and owner != ident:
            raise CheckpointError(f"{out.path} belongs to the stream {owner}, not to that of {checkpoint} ({ident})")
        if gone_on and owner is None and (isinstance(out, Owned) or out.is_empty()):
            raise CheckpointError(f"the stream of {checkpoint} has committed batches, but none of them to {out.path}")
    return ident is not None


def _ownership(spark: SparkSession, checkpoint: str, *outputs, takeover: bool = False) -> Callable[[], tuple[str, int]]:
    """A function for the batches: binds the outputs to the checkpoint at the first one, gives its id and its first batch's id.

    A stream that takes over keeps its batches behind all those that any of the outputs holds.
    """
    known: list[tuple[str, int]] = []

    def owner() -> tuple[str, int]:
        if not known:
            ident, first = checkpoint_id(spark, checkpoint), None
            owned = [o for o in outputs if o is not None]
            if takeover and any(o.owner() not in (None, ident) for o in owned):
                # a start that died after binding some of the outputs has settled the id with them
                settled = [o.first_batch() for o in owned if o.owner() == ident]
                newest = [o.newest_batch() for o in owned]
                first = settled[0] if settled else 1 + max((b for b in newest if b is not None), default=-1)
            for out in owned:
                out.bind(ident, first)
            known.append((ident, owned[0].first_batch() if owned else 0))
        return known[0]

    return owner


class _FileSinkLog:
    """A file sink's own batch log, as an output for ``check_resume``.

    The file sink skips batch ids already in ``path/_spark_metadata``; with a
    new checkpoint ids restart at 0, so new lines would be silently dropped.
    """

    def __init__(self, spark, path: str):
        self.path = path
        self._fs = HadoopFS(spark)

    def is_empty(self) -> bool:
        return not any(n.isdigit() or n.endswith(".compact") for n in self._fs.list_files(f"{self.path}/_spark_metadata"))


def _start(writer, checkpoint: str, trigger: Mapping | None, query_name: str | None) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint).trigger(**dict(trigger or DEFAULT_TRIGGER))
    if query_name:
        writer = writer.queryName(query_name)
    return writer.start()


def fold_batch(
    batch: DataFrame,
    batch_id: int,
    log_spec: LogSpec,
    summary_spec: SummarySpec,
    ledger: SummaryLedger,
    *,
    owner: str | None = None,
    ranges: list[OffsetRange] | None = None,
    reject_sink: BatchTable | None = None,
    range_sink: BatchTable | None = None,
    count_sink: BatchTable | None = None,
    compact_every: int | None = None,
    mode: str = "reject",
    show_rows: int | None = None,
    mirror_table: SummaryTable | None = None,
) -> None:
    """Parse, filter, count one batch and fold the counts into the ledger.

    ``reject_sink`` takes the rejected lines and ``range_sink`` the offset
    ranges (R6; the batch then has Kafka's columns), ``count_sink`` the rows of the batch (A3). The batch's source is
    read once for all of them: counts and rejected lines come out of one aggregation, whose result, small beside the
    batch, is written to the shared folder and read from there, and its rows are counted as they pass. Nothing of a
    batch is kept in memory or on local disks, however large it is. ``ranges``, where known from the
    checkpoint's offset log, are kept with the counts and are what ``range_sink`` gets; without
    them it gets an aggregate of the records.

    ``mirror_table`` (optional) is a catalog table in the original layout, kept
    equal to the ledger's summary: after each batch, the partitions of the days
    that the batch touched are overwritten from those days of the ledger. Being re-derived
    from the exact ledger, it never counts a replayed batch twice. ``show_rows``
    prints that many rows of the updated summary (T11); it reads the whole
    summary, so it is off by default.
    """
    spark, count_col, staged = batch.sparkSession, summary_spec.count_col, None
    seen = Observation()
    if count_sink is not None:
        batch = batch.observe(seen, F.count(F.lit(1)).alias("n"))
    parsed = parse(batch, log_spec)
    sinks = [s for s in (reject_sink, range_sink, count_sink) if s is not None]
    if reject_sink is not None and mode == "reject":
        staged = scratch_path(spark, "fold")
        both = count_with_rejects(parsed, summary_spec)
        both.write.parquet(staged)
        both = spark.read.schema(both.schema).parquet(staged)
        ledger.fold(both.filter(F.col(REJECT_COL).isNull()).select(*summary_spec.keys, count_col), batch_id, owner, ranges)
        reject_sink.write(rejected_lines(both, count_col), batch_id, owner)
        HadoopFS(spark).delete(staged)
        read = True
    else:
        good = apply_predicate(accepted(parsed, mode=mode), summary_spec.predicate)
        read = ledger.fold(count_by(good, summary_spec.keys, count_col), batch_id, owner, ranges)
    if count_sink is not None and read:  # a replay of what is in segments has been counted
        count_sink.write(spark.createDataFrame([(seen.get["n"],)], COUNT_SCHEMA), batch_id, owner)
    if range_sink is not None:
        range_sink.write(range_rows(batch, ranges), batch_id, owner)
    if mirror_table is not None:
        touched = ledger.batch(batch_id)
        days = ledger.day_values(touched)
        if days is None:
            mirror_table.replace_days(ledger.read(touched), touched)
        elif days:
            mirror_table.replace_days(ledger.read(days), days)
    if _compact_due(batch_id, compact_every):
        for out in (ledger, *sinks):
            out.compact(batch_id - 1)
    if show_rows:
        ledger.read().show(show_rows, truncate=False)


def redrive_rejects(
    ledger: SummaryLedger,
    reject_sink: BatchTable,
    log_spec: LogSpec,
    summary_spec: SummarySpec,
    *,
    batches: list[int] | None = None,
    still_rejected: BatchTable | None = None,
    mirror_table: SummaryTable | None = None,
) -> list[int]:
    """Parse the rejected lines of batches again, under a corrected spec, and revise the ledger with their counts.

    The totals are then those of a first run in which these lines had been parsed so; lines that were accepted
    keep what they were counted as. It always starts from all lines that a batch rejected and replaces what an earlier run
    added to it, so it can be repeated, with another correction too, and a run that died is done again. What is
    rejected under this spec as well goes to ``still_rejected``. Gives the batches.
    """
    if batches is None:
        rows = reject_sink.read().select(reject_sink.batch_col).distinct().collect()
        batches = sorted(r[0] for r in rows)
    for batch_id in batches:
        parsed = parse(reject_sink.read(batch_id, batch_id).select("value"), log_spec)
        good = apply_predicate(accepted(parsed), summary_spec.predicate)
        before = ledger.revisions.partitions_of([b for b in ledger.revisions.batch_ids() if b == batch_id])
        days = ledger.day_values(before) if mirror_table is not None else []
        ledger.revise(count_by(good, summary_spec.keys, summary_spec.count_col), batch_id)
        if still_rejected is not None:
            HadoopFS(ledger.spark).delete(f"{still_rejected.path}/{still_rejected.batch_col}={batch_id}")
            still_rejected.write(rejects(parsed), batch_id)
        if mirror_table is not None:
            now = ledger.revisions.partitions_of([b for b in ledger.revisions.batch_ids() if b == batch_id])
            touched = ledger.day_values(now)
            if days is None or touched is None:
                mirror_table.replace_days(ledger.read(), ledger.read().select(ledger.keys[0]))
            else:
                mirror_table.replace_days(ledger.read([*days, *touched]), [*days, *touched])
    return batches


def ranges_of(records: DataFrame, checkpoint: str, batch_id: int) -> list[OffsetRange] | None:
    """Offset ranges of a running batch of Kafka-shaped records, from the offset log; None if its source has no such offsets.

    Where the log does not tell where the first batch begins, its records do.
    """
    found = batch_ranges(HadoopFS(records.sparkSession), checkpoint, batch_id)
    if found and any(r.first is None for r in found):
        begun = {(r["topic"], r["partition"]): r["from_offset"] for r in offset_ranges(records).collect()}
        found = [r._replace(first=begun.get((r.topic, r.partition), r.until)) for r in found]
    return found


def range_rows(records: DataFrame, ranges: list[OffsetRange] | None) -> DataFrame:
    """The ranges as rows; those of the records where none are known."""
    return offset_ranges(records) if ranges is None else records.sparkSession.createDataFrame(ranges, RANGE_SCHEMA)


def validate_summary(spark, log_spec: LogSpec, summary_spec: SummarySpec) -> None:
    """Analyze parse -> predicate -> count on an empty frame: a bad predicate or
    key fails here, before a stream starts, not in its first micro-batch.
    """
    empty = spark.createDataFrame([], "value string")
    good = apply_predicate(accepted(parse(empty, log_spec)), summary_spec.predicate)
    count_by(good, summary_spec.keys, summary_spec.count_col).schema  # noqa: B018 - forces analysis


def start_summary_stream(
    lines: DataFrame,
    log_spec: LogSpec,
    summary_spec: SummarySpec,
    ledger: SummaryLedger,
    checkpoint: str,
    *,
    trigger: Mapping | None = None,
    resume: str = "auto",
    reject_sink: BatchTable | None = None,
    range_sink: BatchTable | None = None,
    count_sink: BatchTable | None = None,
    compact_every: int | None = DEFAULT_COMPACT_EVERY,
    mode: str = "reject",
    show_rows: int | None = None,
    mirror_table: SummaryTable | None = None,
    takeover: bool = False,
    query_name: str | None = None,
) -> StreamingQuery:
    """Stream lines into the running summary: parse -> filter -> count -> ledger.

    The ledger is compacted every ``compact_every`` batches (``None``: never).
    With ``range_sink`` the stream has Kafka's columns, and the offset ranges
    of each batch are reported under the batch's id (R6). With those columns and a source that has
    Kafka's offsets, the ledger keeps the ranges, too.

    ``takeover`` goes on after the checkpoint was lost: the stream has a new one and starts from
    ``ledger.next_offsets()``, or earlier. Its batches are kept behind those of the stream before, and records that
    the ledger has folded already are dropped. The stream before must not run any more.
    """
    spark = lines.sparkSession
    validate_summary(spark, log_spec, summary_spec)
    outputs = (ledger, reject_sink, range_sink, count_sink)
    check_resume(spark, checkpoint, resume, *outputs, takeover=takeover)
    owner = _ownership(spark, checkpoint, *outputs, takeover=takeover)
    records = {"topic", "partition", "offset"} <= set(lines.columns)
    if takeover and not records:
        raise CheckpointError("a stream can take over only with records that have topic, partition and offset")
    earlier: list[Intervals] = []  # what the streams before folded

    def _each(batch: DataFrame, batch_id: int) -> None:
        ident, first = owner()
        ranges = ranges_of(batch, checkpoint, batch_id) if records else None
        if first:
            if ranges is None:
                raise CheckpointError("the source has no Kafka offsets, so what was folded before cannot be told")
            if not earlier:
                earlier.append(ledger.folded_before(first))
            batch = without(batch, overlap(earlier[0], ranges))
        fold_batch(
            batch, first + batch_id, log_spec, summary_spec, ledger, owner=ident, ranges=ranges,
            reject_sink=reject_sink, range_sink=range_sink, count_sink=count_sink, compact_every=compact_every, mode=mode,
            show_rows=show_rows, mirror_table=mirror_table,
        )

    return _start(lines.writeStream.foreachBatch(_each), checkpoint, trigger, query_name)


def _into(sink: BatchTable, owner: Callable[[], tuple[str, int]], compact_every: int | None, rows=lambda batch, batch_id: batch):
    """Batch function that writes ``rows(batch, batch_id)`` to ``sink``."""

    def _each(batch: DataFrame, batch_id: int) -> None:
        sink.write(rows(batch, batch_id), batch_id, owner()[0])
        if _compact_due(batch_id, compact_every):
            sink.compact(batch_id - 1)

    return _each


def _compact_due(batch_id: int, every: int | None) -> bool:
    return bool(every) and batch_id > 0 and batch_id % every == 0


def start_batch_counts(
    lines: DataFrame,
    sink: BatchTable,
    checkpoint: str,
    *,
    trigger: Mapping | None = None,
    resume: str = "auto",
    compact_every: int | None = DEFAULT_COMPACT_EVERY,
    query_name: str | None = None,
) -> StreamingQuery:
    """Rows per micro-batch into ``sink`` as ``n`` per ``batch_id`` (A3)."""
    check_resume(lines.sparkSession, checkpoint, resume, sink)
    owner = _ownership(lines.sparkSession, checkpoint, sink)
    each = _into(sink, owner, compact_every, lambda batch, _: batch.agg(F.count(F.lit(1)).alias("n")))
    return _start(lines.writeStream.foreachBatch(each), checkpoint, trigger, query_name)


def start_running_total(
    lines: DataFrame,
    sink: BatchTable,
    checkpoint: str,
    *,
    trigger: Mapping | None = None,
    resume: str = "auto",
    compact_every: int | None = DEFAULT_COMPACT_EVERY,
    query_name: str | None = None,
) -> StreamingQuery:
    """Total rows seen so far, after each batch, as ``total`` per ``batch_id`` (A4).

    The total is a streaming global count kept in the state store of the
    checkpoint, so it survives a restart (unlike a counter in driver memory).
    Partial counts per task are combined before the single-row final state.
    """
    check_resume(lines.sparkSession, checkpoint, resume, sink)
    totals = lines.groupBy().agg(F.count(F.lit(1)).alias("total"))
    each = _into(sink, _ownership(lines.sparkSession, checkpoint, sink), compact_every)
    return _start(totals.writeStream.outputMode("update").foreachBatch(each), checkpoint, trigger, query_name)


def total_of_checkpoint(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """``batch_id, total``: the running total that the state store of ``start_running_total``'s checkpoint holds (A4).

    Read by Spark's state data source, as of the last committed batch (or an earlier one that the store still keeps), without the
    sink: what a stream that died between its state and its sink will go on from.
    """
    commits = [int(n) for n in HadoopFS(spark).list_files(f"{checkpoint.rstrip('/')}/commits") if n.isdigit()]
    if not commits:
        raise CheckpointError(f"no batch of {checkpoint} is committed")
    batch = max(commits) if batch_id is None else batch_id
    state = spark.read.format("statestore").option("batchId", batch).load(checkpoint)
    # a global count: one row, in one of the store's partitions
    total = F.coalesce(F.max(F.col("value.count")), F.lit(0)).cast("bigint").alias("total")
    return state.agg(total).select(F.lit(batch).cast("bigint").alias("batch_id"), "total")


RANGE_SCHEMA = StructType(
    [
        StructField("topic", StringType(), True),
        StructField("partition", IntegerType(), True),
        StructField("from_offset", LongType(), True),
        StructField("until_offset", LongType(), True),
    ]
)


def start_offset_report(
    records: DataFrame,
    sink: BatchTable,
    checkpoint: str,
    *,
    trigger: Mapping | None = None,
    resume: str = "auto",
    compact_every: int | None = DEFAULT_COMPACT_EVERY,
    query_name: str | None = None,
) -> StreamingQuery:
    """Per micro-batch, the offset range each (topic, partition) contributed.

    ``records`` is a stream of Kafka records (or any Kafka-shaped stream);
    each batch writes ``topic, partition, from_offset, until_offset`` (until
    exclusive) under its ``batch_id``: from the checkpoint's offset log if the source has Kafka's offsets, without
    reading a record; else from the batch's own rows with a partial min/max aggregate.
    """
    check_resume(records.sparkSession, checkpoint, resume, sink)

    def rows(batch: DataFrame, batch_id: int) -> DataFrame:
        return range_rows(batch, ranges_of(batch, checkpoint, batch_id))

    each = _into(sink, _ownership(records.sparkSession, checkpoint, sink), compact_every, rows)
    return _start(records.writeStream.foreachBatch(each), checkpoint, trigger, query_name)


def start_archive(
    lines: DataFrame,
    path: str,
    checkpoint: str,
    *,
    fmt: str = "parquet",
    trigger: Mapping | None = None,
    resume: str = "auto",
    query_name: str | None = None,
) -> StreamingQuery:
    """Append every raw line to files under ``path``, exactly once.

    The file sink commits each batch's files in its own log
    (``path/_spark_metadata``); readers of ``path`` see committed files only,
    so a replayed batch does not duplicate lines. Parquet keeps every value as it
    is, NULLs and line ends included. ``fmt="text"`` has one line per row, so a
    value that holds a line end, or a NULL, fails the batch.
    """
    check_resume(lines.sparkSession, checkpoint, resume, _FileSinkLog(lines.sparkSession, path))
    value = F.col("value").cast("string")
    if fmt == "text":
        whole = value.isNotNull() & ~value.rlike("[\\r\\n]")
        value = F.when(whole, value).otherwise(F.raise_error(F.lit("a text archive cannot hold NULL or a line end")))
    writer = lines.select(value.alias("value")).writeStream.format(fmt).option("path", path)
    return _start(writer, checkpoint, trigger, query_name)


def start_console_preview(
    lines: DataFrame,
    checkpoint: str,
    *,
    num_rows: int = 10,
    trigger: Mapping | None = None,
    query_name: str | None = None,
) -> StreamingQuery:
    """Print the first ``num_rows`` rows of every micro-batch to the driver log."""
    writer = lines.writeStream.format("console").option("numRows", int(num_rows)).option("truncate", "false")
    return _start(writer, checkpoint, trigger, query_name)


def run_bounded(query: StreamingQuery, timeout_s: float | None = None) -> bool:
    """Wait for the query to finish or for ``timeout_s``, then stop it.

    Returns True when the query ended by itself (e.g. an ``availableNow`` run).
    Re-raises the query's failure, if any.
    """
    finished = query.awaitTermination(timeout_s) if timeout_s is not None else query.awaitTermination()
    if not finished:
        query.stop()
    exc = query.exception()
    if exc is not None:
        raise exc
    return bool(finished) if timeout_s is not None else True


def progress_offset_ranges(query: StreamingQuery) -> list[dict]:
    """Offset ranges of the last batch per source partition, from query progress.

    For a Kafka source, ``startOffset``/``endOffset`` are maps topic ->
    partition -> offset; the end is exclusive. Returns rows
    ``{topic, partition, from_offset, until_offset}``; sources without such
    maps (files) contribute none. A partition that is new in this batch starts
    at 0; the start of a first batch is not in its progress, so it is None.
    Only the last batch is seen: for every batch's ranges give the stream a
    ``range_sink``, or read the checkpoint's log (``offset_log.log_ranges``).
    """
    prog = query.lastProgress
    if not prog:
        return []
    data = json.loads(prog.json) if hasattr(prog, "json") else dict(prog)

    def offsets(x):
        if isinstance(x, str):
            try:
                x = json.loads(x)
            except ValueError:
                return {}
        return x if isinstance(x, dict) else {}

    out: list[dict] = []
    for src in data.get("sources", []):
        start, end = offsets(src.get("startOffset")), offsets(src.get("endOffset"))
        for topic, parts in end.items():
            if not isinstance(parts, dict):
                continue
            begun = start.get(topic, {}) if isinstance(start.get(topic), dict) else {}
            for part, until in parts.items():
                begin = int(begun.get(part, 0)) if start else None
                out.append({"topic": topic, "partition": int(part), "from_offset": begin, "until_offset": int(until)})
    return out
