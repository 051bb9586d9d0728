"""Compaction of the raw-line archive.

``start_archive`` adds a few small files per batch, listed in the file sink's own log
(``_spark_metadata``). ``Archive.compact`` packs the lines of the batches that log has committed into files of about
``target`` bytes, as segments (see ``segments``) beside them, divided by the day the files were written. The manifest's
list of packed files is the hand-over: those are read from segments, the log's other files as they are, so every
line is read once at any moment, also when a compaction dies. Small files are deleted by the compaction after
the one that packed them; from the first compaction on the archive is read with ``Archive.read``.

Segments merge by size tiers, and a merge packs again, so there are about bytes / ``target`` files for each day.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from linefold.session import HadoopFS
from linefold.sinks.segments import FANOUT, Segments

TARGET = 128 << 20
DAY = "_written"
LOG = "_spark_metadata"


def _name(path: str) -> str:
    return path.rpartition("/")[2]


class Archive:
    def __init__(self, spark: SparkSession, path: str, *, fmt: str = "parquet", target: int = TARGET, fanout: int = FANOUT):
        self.spark, self.path, self.fmt, self.target = spark, path.rstrip("/"), fmt, target
        self._fs = HadoopFS(spark)
        schema = StructType([StructField("value", StringType(), True), StructField(DAY, StringType(), True)])
        self.segments = Segments(spark, self.path, schema, self._fs, partition=DAY, fanout=fanout)

    def committed(self) -> dict[int, list[tuple[str, int]]]:
        """Files and sizes that the sink's log names, by batch; those of a compacted log under its newest batch."""
        names = self._fs.list_files(f"{self.path}/{LOG}")
        compacted = max((int(n.removesuffix(".compact")) for n in names if n.endswith(".compact")), default=None)
        found: dict[int, list[tuple[str, int]]] = {}
        seen: set[str] = set()
        batches = sorted(int(n) for n in names if n.isdigit())
        # single batches first, so that a file is known under its own batch while its log is there
        for batch, name in [*((b, str(b)) for b in batches), *([(compacted, f"{compacted}.compact")] if compacted is not None else [])]:
            for line in self._fs.read_text(f"{self.path}/{LOG}/{name}").split("\n")[1:]:
                entry = json.loads(line) if line else {}
                if entry.get("action") == "add" and entry["path"] not in seen:
                    seen.add(entry["path"])
                    found.setdefault(batch, []).append((entry["path"], int(entry["size"])))
        return found

    def _files(self, upto: int | None = None) -> list[tuple[str, int]]:
        """Files of the batches up to ``upto`` that no segment covers.

        Told by their names, not by their batches: a compacted log no longer tells the batch of a file.
        """
        packed = set(self.segments.manifest().notes.get("packed", []))
        return [
            (p, n) for b, files in sorted(self.committed().items()) for p, n in files
            if (upto is None or b <= upto) and _name(p) not in packed
        ]

    def _lines(self, files: list[tuple[str, int]]) -> DataFrame:
        if not files:
            return self.spark.createDataFrame([], "value string")
        return self.spark.read.schema("value string").format(self.fmt).load([p for p, _ in files])

    def read(self) -> DataFrame:
        """Every archived line once: ``value STRING``."""
        state = self.segments.manifest()
        rows = self._lines(self._files())
        return rows.unionByName(self.segments.read(state.segments).select("value")) if state.segments else rows

    def compact(self, upto: int | None = None) -> int:
        """Pack the batches committed since the last compaction (up to ``upto``); gives how many files were packed."""
        state = self.segments.manifest()
        committed = self.committed()
        newest = max((b for b in committed if upto is None or b <= upto), default=None)
        files = self._files(newest) if newest is not None else []
        if not files:
            return 0
        taken, _ = state.merged(self.segments.fanout)
        merged = state.segments[len(state.segments) - taken :]
        total = sum(n for _, n in files) + sum(self._fs.size(f"{self.segments.folder}/{s.name}") for s in merged)
        parts = max(1, -(-total // self.target))
        written = F.date_format(F.col("_metadata.file_modification_time"), "yyyy-MM-dd")
        rows = self._lines(files)
        rows = rows.withColumn(DAY, written).select("value", DAY)
        # names as long as the sink's log has them; the log itself grows by each file, so this list is no longer than it
        named = {_name(p) for of_batch in committed.values() for p, _ in of_batch}
        packed = [n for n in state.notes.get("packed", []) if n in named] + [_name(p) for p, _ in files]
        notes = {"packed": packed, "last": [p for p, _ in files]}
        self.segments.add(rows, max(newest, (state.upto or 0)), lambda df: df.repartition(parts), notes=notes, dealt=True)
        for path in state.notes.get("last", []):
            self._fs.delete(path)
        return len(files)
