"""Command line: run the summary jobs from a config file.

The config is the original job configuration, as it is written (HOCON) or as JSON, with the sections ``input``,
``query``, ``output``, ``kafka`` and optionally ``application``
(``duration`` = micro-batch interval in ms). Only keys the jobs read are used.

    python -m linefold.cli batch   --config job.json --lines /logs/day/ --out /shared/day-summary [--show 20]
    python -m linefold.cli stream  --config job.json --summary /shared/summary --checkpoint /shared/ckpt SOURCE
        [--rejects DIR] [--ranges DIR] [--mirror-table] [--resume require] [--once | --timeout 60]
    python -m linefold.cli show    --config job.json --summary /shared/summary [--out DIR] [--compat]
    python -m linefold.cli counts  --config job.json --out /shared/counts --checkpoint /shared/ckpt2 SOURCE ...
    python -m linefold.cli total   --config job.json --out /shared/totals --checkpoint /shared/ckpt3 SOURCE ...
    python -m linefold.cli archive --config job.json --out /shared/archive --checkpoint /shared/ckpt4 SOURCE ...

    python -m linefold.cli redrive --config corrected.json --summary /shared/summary --rejects /shared/rejects [--still DIR]
    python -m linefold.cli pack    --out /shared/archive
    python -m linefold.cli ranges  --checkpoint /shared/ckpt --out /shared/ranges
    python -m linefold.cli state-total --checkpoint /shared/ckpt3 --out /shared/total

SOURCE is ``--lines DIR`` (``--max-files``, ``--clean-source``), ``--growing DIR`` (files that lines are still
appended to), ``--kafka``
(``--from-offsets '{"topic": {"0": 17}}'``, ``--max-offsets``; other options of
the source in the config's ``kafka.options``), or ``--landed DIR``, the config's topics as ``sources.landed`` keeps them.

``batch`` counts the lines once and writes the whole summary to ``--out``.
``stream`` folds every micro-batch into the ledger at ``--summary`` until
stopped (``--once``: until the input available now is consumed; ``--timeout``:
for that many seconds). ``--takeover`` goes on with a ledger whose checkpoint was lost, from the
offsets it holds; ``--checkpoint`` is a new one then. ``show`` writes the summary the ledger holds to
``--out``; without it, and wherever ``--show`` is given, rows are only printed
for a look. ``counts`` and ``total`` keep rows per batch and the running total,
``archive`` the raw lines, whose small files ``pack`` packs; ``ranges`` writes the offset ranges of the batches in a checkpoint's log, ``state-total`` the running
total in a checkpoint's state store. The session comes from ``spark-submit`` / the
environment; nothing global is set.
"""

from __future__ import annotations

import argparse
import json
import sys
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from linefold import hocon
from linefold.config import KafkaSpec, LogSpec, SummarySpec
from linefold.operators.summary import preview, summarize
from linefold.sinks.archive import Archive
from linefold.sinks.batch_table import BatchTable
from linefold.sinks.ledger import SummaryLedger
from linefold.sinks.tables import SummaryTable
from linefold.sources.growing import stream_growing
from linefold.sources.kafka import kafka_lines, kafka_stream
from linefold.sources.landed import landed_stream
from linefold.sources.lines import read_lines, record_values, stream_lines
from linefold.streaming.jobs import (
    COUNT_SCHEMA,
    RANGE_SCHEMA,
    REJECT_SCHEMA,
    TOTAL_SCHEMA,
    redrive_rejects,
    run_bounded,
    start_archive,
    start_batch_counts,
    start_running_total,
    start_summary_stream,
    total_of_checkpoint,
)
from linefold.streaming.offset_log import log_ranges


def load_config(path: str) -> dict:
    """The job config: JSON, or as the original jobs write it (see ``hocon``)."""
    with open(path) as f:
        return hocon.loads(f.read())


def specs(conf: dict) -> tuple[LogSpec, SummarySpec]:
    log = LogSpec.from_dict(conf["input"]) if "input" in conf else LogSpec.transaction_log()
    summary = SummarySpec.from_dict(conf.get("query", {}), conf.get("output", {}))
    return log, summary


def trigger_of(conf: dict, once: bool) -> dict:
    if once:
        return {"availableNow": True}
    ms = int(conf.get("application", {}).get("duration", 2000))
    return {"processingTime": f"{ms} milliseconds"}


def offsets_of(text: str | None) -> dict | None:
    """``{(topic, partition): offset}`` from ``{"topic": {"partition": offset}}``."""
    if not text:
        return None
    return {(t, int(p)): int(o) for t, parts in json.loads(text).items() for p, o in parts.items()}


def _add_stream_options(p: argparse.ArgumentParser) -> None:
    p.add_argument("--config", required=True)
    p.add_argument("--checkpoint", required=True)
    src = p.add_mutually_exclusive_group(required=True)
    src.add_argument("--lines", help="folder of text files")
    src.add_argument("--growing", help="folder of text files that still grow")
    src.add_argument("--kafka", action="store_true", help="the topics of the config")
    src.add_argument("--landed", help="folder of landed records of the config's topics")
    p.add_argument("--from-offsets", help="with --kafka or --landed: JSON of topic, partition and first offset; only those are read")
    p.add_argument("--max-offsets", type=int, help="with --kafka: records of a micro-batch at most")
    p.add_argument("--max-files", type=int, help="with --lines: files of a micro-batch at most")
    p.add_argument("--clean-source", choices=("archive", "delete", "off"), help="with --lines: what becomes of read files")
    p.add_argument("--source-archive", help="with --clean-source archive: where they go")
    p.add_argument("--resume", choices=("auto", "require", "new"), default="auto")
    p.add_argument("--compact-every", type=int, default=100, help="compact the output every N batches (0: never)")
    end = p.add_mutually_exclusive_group()
    end.add_argument("--once", action="store_true", help="stop when the available input is consumed")
    end.add_argument("--timeout", type=float, help="stop after this many seconds")


def source_of(
    spark: SparkSession, conf: dict, args: argparse.Namespace, records: bool = False, starts: dict | None = None
) -> DataFrame:
    """The stream that the options name; with ``records``, with Kafka's columns. ``starts`` is where one without given offsets begins."""
    starts = offsets_of(args.from_offsets) or starts
    if args.landed:
        stream = landed_stream(spark, args.landed, KafkaSpec.from_dict(conf["kafka"]), starts)
        return stream if records else record_values(stream)
    if args.kafka:
        spec = KafkaSpec.from_dict(conf["kafka"])
        if args.max_offsets:
            spec = replace(spec, extra={**spec.extra, "maxOffsetsPerTrigger": args.max_offsets})
        stream = kafka_stream if records else kafka_lines
        return stream(spark, spec, starts)
    if args.growing:
        return stream_growing(spark, args.growing)
    if records:
        raise SystemExit("--ranges and --takeover need --kafka or --landed")
    return stream_lines(
        spark, args.lines, max_files_per_trigger=args.max_files,
        clean_source=args.clean_source, source_archive_dir=args.source_archive,
    )


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    ap = argparse.ArgumentParser(prog="linefold")
    sub = ap.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("batch", help="count lines once and write the summary")
    b.add_argument("--config", required=True)
    b.add_argument("--lines", required=True, nargs="+")
    b.add_argument("--out", required=True, help="folder for the summary (parquet)")
    b.add_argument("--show", type=int, help="print this many of its rows, too")
    s = sub.add_parser("stream", help="fold a stream of lines into the ledger")
    _add_stream_options(s)
    s.add_argument("--summary", required=True)
    s.add_argument("--rejects", help="folder for the lines that cannot be parsed")
    s.add_argument("--ranges", help="folder for each batch's offset ranges (with --kafka or --landed)")
    s.add_argument("--counts", help="folder for the rows of each batch")
    s.add_argument("--takeover", action="store_true", help="go on after a lost checkpoint (with --kafka or --landed)")
    s.add_argument("--show", type=int, help="print this many summary rows after each batch")
    s.add_argument("--mirror-table", action="store_true",
                   help="keep the configured catalog table equal to the summary, by day")
    r = sub.add_parser("show", help="write or print the summary the ledger holds")
    r.add_argument("--config", required=True)
    r.add_argument("--summary", required=True)
    r.add_argument("--compat", action="store_true", help="count as a string")
    r.add_argument("--out", help="folder for the whole summary (parquet)")
    r.add_argument("--show", type=int, help="print this many rows (20 if there is no --out)")
    for name, what in (("counts", "rows of each micro-batch"), ("total", "running total"), ("archive", "raw lines")):
        p = sub.add_parser(name, help=f"keep the {what} of a stream")
        _add_stream_options(p)
        p.add_argument("--out", required=True, help="folder for the result")
        if name == "archive":
            p.add_argument("--format", choices=("parquet", "text"), default="parquet")
    for name, what in (("ranges", "offset ranges of the batches in a checkpoint's log"), ("state-total", "running total in a checkpoint's state")):
        o = sub.add_parser(name, help=f"write the {what}")
        o.add_argument("--checkpoint", required=True, help="of the stream that has them")
        o.add_argument("--out", required=True)
    d = sub.add_parser("redrive", help="parse rejected lines again under a corrected config")
    d.add_argument("--config", required=True)
    d.add_argument("--summary", required=True)
    d.add_argument("--rejects", required=True, help="folder that 'stream --rejects' wrote")
    d.add_argument("--still", help="folder for the lines that are rejected again")
    d.add_argument("--batches", type=int, nargs="+", help="only these batches")
    k = sub.add_parser("pack", help="pack the small files of an archive that 'archive' wrote")
    k.add_argument("--out", required=True, help="folder of the archive")
    k.add_argument("--format", choices=("parquet", "text"), default="parquet")
    args = ap.parse_args(argv)

    if args.cmd == "pack":
        Archive(spark or SparkSession.builder.appName("linefold").getOrCreate(), args.out, fmt=args.format).compact()
        return 0
    if args.cmd in ("ranges", "state-total"):
        spark = spark or SparkSession.builder.appName("linefold").getOrCreate()
        found = log_ranges(spark, args.checkpoint) if args.cmd == "ranges" else total_of_checkpoint(spark, args.checkpoint)
        found.write.parquet(args.out)
        return 0
    conf = load_config(args.config)
    log, summary = specs(conf)
    spark = spark or SparkSession.builder.appName(conf.get("application", {}).get("appName", "linefold")).getOrCreate()

    if args.cmd == "redrive":
        redrive_rejects(
            SummaryLedger(spark, args.summary, summary.keys, summary.count_col), BatchTable(spark, args.rejects, REJECT_SCHEMA),
            log, summary, batches=args.batches, still_rejected=BatchTable(spark, args.still, REJECT_SCHEMA) if args.still else None,
        )
        return 0
    if args.cmd in ("batch", "show"):
        if args.cmd == "batch":
            result = summarize(read_lines(spark, args.lines), log, summary)
        else:
            ledger = SummaryLedger(spark, args.summary, summary.keys, summary.count_col)
            result = ledger.read_compat() if args.compat else ledger.read()
        if args.out:
            result.write.parquet(args.out)
            result = spark.read.parquet(args.out)
        rows = args.show if args.out else args.show or 20
        if rows:
            preview(result, rows, summary.keys).show(rows, truncate=False)
        return 0

    how = {
        "trigger": trigger_of(conf, args.once),
        "resume": args.resume,
        "query_name": f"linefold-{args.cmd}",
    }
    every = args.compact_every or None
    if args.cmd == "counts":
        query = start_batch_counts(
            source_of(spark, conf, args), BatchTable(spark, args.out, COUNT_SCHEMA), args.checkpoint, compact_every=every, **how
        )
    elif args.cmd == "total":
        query = start_running_total(
            source_of(spark, conf, args), BatchTable(spark, args.out, TOTAL_SCHEMA), args.checkpoint, compact_every=every, **how
        )
    elif args.cmd == "archive":
        query = start_archive(source_of(spark, conf, args), args.out, args.checkpoint, fmt=args.format, **how)
    else:
        mirror = SummaryTable(spark, summary.table, summary.keys, count_col=summary.count_col, by_day=True)
        ledger = SummaryLedger(spark, args.summary, summary.keys, summary.count_col)
        # offsets are kept with the counts wherever the source has them
        records = bool(args.kafka or args.landed or args.ranges or args.takeover)
        query = start_summary_stream(
            source_of(spark, conf, args, records, ledger.next_offsets() if args.takeover else None), log, summary,
            ledger, args.checkpoint, takeover=args.takeover,
            reject_sink=BatchTable(spark, args.rejects, REJECT_SCHEMA) if args.rejects else None,
            range_sink=BatchTable(spark, args.ranges, RANGE_SCHEMA) if args.ranges else None,
            count_sink=BatchTable(spark, args.counts, COUNT_SCHEMA) if args.counts else None,
            compact_every=every, show_rows=args.show, mirror_table=mirror if args.mirror_table else None, **how,
        )
    run_bounded(query, args.timeout)
    return 0


if __name__ == "__main__":
    sys.exit(main())
