"""Immutable segments of a per-batch table, merged by size tiers, listed by one manifest.

A compaction takes the batches since the last one as a segment of tier 0. When
``FANOUT`` segments of a tier stand at the end of the list they become one of the next
tier, so after ``n`` compactions there are at most ``(FANOUT - 1) * log_FANOUT(n) + 1``
segments, and a row is written again once per tier. All merges that a compaction
brings about are one job: the new segment takes the tier it would end in.

The file ``_manifest`` is the only truth: which segments exist, in order, with the batches each
covers, the batch up to which everything is in segments, and what nobody needs any more. It is
replaced in one step, so a compaction that dies anywhere has either happened or not; folders
that no manifest names are leftovers. Whoever asks for the table's state opens this one file, and lists nothing.

What a compaction supersedes is deleted by the one after it: a DataFrame read before a
compaction stays readable through it.

Layout under ``path``::

    _manifest
    _segments/<upto>-<id>/[<partition>=.../]part-*.parquet
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from linefold.session import HadoopFS

MANIFEST = "_manifest"
FANOUT = 8


@dataclass(frozen=True)
class Segment:
    """Rows of the batches ``first..upto`` in the folder ``name``."""

    name: str
    first: int
    upto: int
    tier: int


@dataclass(frozen=True)
class Manifest:
    """The committed state of a table."""

    upto: int | None = None
    segments: tuple[Segment, ...] = ()
    #: folders that the last compaction superseded; the next one deletes them
    stale: tuple[str, ...] = ()
    #: what the table keeps with its state
    notes: dict = field(default_factory=dict)

    def merged(self, fanout: int = FANOUT) -> tuple[int, int]:
        """How many segments at the end the next one takes in, and its tier."""
        taken, tier = 0, 0
        while True:
            same = 0
            for s in reversed(self.segments[: len(self.segments) - taken]):
                if s.tier != tier:
                    break
                same += 1
            if same < fanout - 1:
                return taken, tier
            taken, tier = taken + same, tier + 1

    def with_segment(self, name: str, upto: int, fanout: int = FANOUT, notes: dict | None = None) -> Manifest:
        """The state after a compaction up to ``upto`` wrote the folder ``name``."""
        taken, tier = self.merged(fanout)
        kept, gone = self.segments[: len(self.segments) - taken], self.segments[len(self.segments) - taken :]
        first = gone[0].first if gone else 0 if self.upto is None else self.upto + 1
        return Manifest(upto, (*kept, Segment(name, first, upto, tier)), tuple(s.name for s in gone), self.notes if notes is None else notes)

    def dump(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def load(cls, text: str | None) -> Manifest:
        if text is None:
            return cls()
        raw = json.loads(text)
        return cls(raw["upto"], tuple(Segment(**s) for s in raw["segments"]), tuple(raw["stale"]), raw.get("notes", {}))


class Segments:
    """The segments under ``path``. ``schema`` is that of their rows, ``partition`` a column of it to divide them by."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, fs: HadoopFS, *, partition: str | None = None, fanout: int = FANOUT):
        self.spark, self.path, self.schema, self._fs = spark, path, schema, fs
        self.partition, self.fanout = partition, fanout
        self.folder = f"{path}/_segments"

    def manifest(self) -> Manifest:
        """The committed state: one call of the file system."""
        return Manifest.load(self._fs.read_text_or_none(f"{self.path}/{MANIFEST}"))

    def upto(self) -> int | None:
        """The newest batch that is in segments."""
        return self.manifest().upto

    def read(self, segments: tuple[Segment, ...] | None = None) -> DataFrame:
        """The rows of the given segments (all by default), as one scan."""
        segments = self.manifest().segments if segments is None else segments
        if not segments:
            return self.spark.createDataFrame([], self.schema)
        reader = self.spark.read.schema(self.schema)
        if self.partition is None:
            return reader.parquet(*[f"{self.folder}/{s.name}" for s in segments])
        frames = [reader.option("basePath", f"{self.folder}/{s.name}").parquet(f"{self.folder}/{s.name}") for s in segments]
        found = frames[0]
        for frame in frames[1:]:
            found = found.unionByName(frame)
        return found

    def add(
        self, rows: DataFrame, upto: int, merge: Callable[[DataFrame], DataFrame] = lambda df: df, notes: dict | None = None, dealt: bool = False
    ) -> Manifest:
        """Commit the rows of the batches since the last segment as part of a segment; gives the state before.

        ``merge`` is applied to the rows of the segment (the new ones, with those of the segments it takes in);
        ``notes`` replace those of the state in the same step. ``dealt`` tells that ``merge`` has dealt the rows out to files.
        """
        before = self.manifest()
        taken, _ = before.merged(self.fanout)
        old = before.segments[len(before.segments) - taken :]
        rows = merge(rows.unionByName(self.read(old)) if old else rows)
        name = f"{upto:012d}-{uuid.uuid4().hex[:8]}"
        if self.partition:
            # one file a value, unless it is large: adaptive execution splits and joins what this deals out
            rows = rows if dealt else rows.hint("rebalance", self.partition)
            rows.write.partitionBy(self.partition).parquet(f"{self.folder}/{name}")
        else:
            rows.write.parquet(f"{self.folder}/{name}")
        self._fs.replace_text(f"{self.path}/{MANIFEST}", before.with_segment(name, upto, self.fanout, notes).dump())
        for gone in self.leftovers():
            self._fs.delete(f"{self.folder}/{gone}")
        return before

    def leftovers(self) -> list[str]:
        """Folders that no reader needs: superseded before the last compaction, or of one that died before its commit."""
        now = self.manifest()
        named = {s.name for s in now.segments} | set(now.stale)
        return [d for d in self._fs.list_dirs_all(self.folder) if d not in named]
