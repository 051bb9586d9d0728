"""A parquet folder with one partition per micro-batch, written idempotently.

``write(df, batch_id)`` replaces partition ``batch_id=N`` and nothing else
(dynamic partition overwrite), so a batch that is replayed after a failure
overwrites its own earlier attempt instead of being added twice. A batch with
no rows writes no partition, on the first try and on a replay alike.
Uncommitted attempts live in a hidden staging folder that readers skip.

``compact(N)`` keeps the folder short for long-running streams: the rows of
the batches since the last compaction (with their ``batch_id``) become a segment (see
``segments``), hidden from partition discovery. Segments merge by size tiers, so a
read touches a number of them that grows with the logarithm of the batches, and the state
of the table is one small file, whatever its history: a write opens it once. The partitions a
segment covers are deleted by the compaction *after* it: a DataFrame read before a compaction
stays readable through it.

A table belongs to one stream: the id of the stream's checkpoint is kept in the
file ``_owner`` (``bind``). A batch that is in a segment already can only be a
replay by that stream, whose rows are already there: it is left alone if the
caller proves to be the owner, and refused otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from linefold.session import HadoopFS
from linefold.sinks.segments import FANOUT, Segments

BATCH_COL = "batch_id"
OWNER_FILE = "_owner"


class OwnerError(RuntimeError):
    """A table is used by another stream than the one it belongs to."""


class Owned:
    """Which stream (checkpoint id) a folder belongs to."""

    path: str
    _fs: HadoopFS

    def _owner_lines(self) -> list[str]:
        return (self._fs.read_text_or_none(f"{self.path}/{OWNER_FILE}") or "").splitlines()

    def owner(self) -> str | None:
        lines = self._owner_lines()
        return lines[0] if lines else None

    def first_batch(self) -> int:
        """Under which id the owner's batch 0 is kept: 0, or behind all batches of the streams it took over from."""
        lines = self._owner_lines()
        return int(lines[1]) if len(lines) > 1 else 0

    def newest_batch(self) -> int | None:
        """The newest batch that the folder holds."""
        raise NotImplementedError

    def bind(self, owner: str, first_batch: int | None = None) -> None:
        """Give the folder to the stream ``owner``; an error if it belongs to another.

        With ``first_batch`` the stream takes over: its batches are kept from that id on.
        """
        now = self.owner()
        if now == owner:
            return
        if now is not None and first_batch is None:
            raise OwnerError(f"{self.path} belongs to the stream {now}, not to {owner}")
        text = owner if first_batch is None else f"{owner}\n{first_batch}"
        self._fs.mkdirs(self.path)
        self._fs.replace_text(f"{self.path}/{OWNER_FILE}", text)


class BatchTable(Owned):
    def __init__(self, spark: SparkSession, path: str, schema: StructType, batch_col: str = BATCH_COL, *, fanout: int = FANOUT):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema
        self.batch_col = batch_col
        self._fs = HadoopFS(spark)
        self.segments = Segments(spark, self.path, self.read_schema, self._fs, fanout=fanout)

    @property
    def read_schema(self) -> StructType:
        return StructType(list(self.schema.fields) + [StructField(self.batch_col, LongType(), True)])

    def write(self, df: DataFrame, batch_id: int, owner: str | None = None) -> None:
        """Replace batch ``batch_id``. ``owner`` (a checkpoint id) proves that an already compacted one is a replay."""
        upto = self.segments.upto()
        if upto is not None and batch_id <= upto:
            if owner is None or owner != self.owner():
                raise OwnerError(f"batch {batch_id} of {self.path} is compacted (up to {upto}) and this is no proven replay")
            return
        cols = [F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields]
        (
            df.select(*cols, F.lit(int(batch_id)).cast("bigint").alias(self.batch_col))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(self.batch_col)
            .parquet(self.path)
        )

    def _partitions(self) -> list[int]:
        """Batch ids that have a partition folder (no data scan)."""
        prefix = f"{self.batch_col}="
        return sorted(int(d[len(prefix):]) for d in self._fs.list_dirs(self.path) if d.startswith(prefix))

    def batch_ids(self) -> list[int]:
        """Batch ids that are in no segment yet."""
        upto = self.segments.upto()
        return [b for b in self._partitions() if upto is None or b > upto]

    def is_empty(self) -> bool:
        return self.segments.upto() is None and not self._partitions()

    def newest_batch(self) -> int | None:
        upto = self.segments.upto()
        return max([*self._partitions()[-1:], *([] if upto is None else [upto])], default=None)

    def partitions_of(self, batch_ids: list[int]) -> DataFrame:
        """Rows of the given batches, from their partitions alone."""
        folders = [f"{self.path}/{self.batch_col}={b}" for b in batch_ids]
        if not folders:
            return self.spark.createDataFrame([], self.read_schema)
        return self.spark.read.schema(self.read_schema).option("basePath", self.path).parquet(*folders)

    def read(self, first: int | None = None, last: int | None = None) -> DataFrame:
        """All rows with their ``batch_id``, or those of the batches ``first..last``: other segments and partitions stay unread."""
        low, high = first if first is not None else 0, last if last is not None else (1 << 63) - 1
        state = self.segments.manifest()
        segments = tuple(s for s in state.segments if s.first <= high and s.upto >= low)
        live = [b for b in self._partitions() if (state.upto is None or b > state.upto) and low <= b <= high]
        rows = self.partitions_of(live)
        if segments:
            rows = rows.unionByName(self.segments.read(segments))
        if first is None and last is None:
            return rows
        return rows.filter(F.col(self.batch_col).between(low, high))

    def latest(self) -> DataFrame:
        """Rows of the newest batch that has rows (e.g. the current running total)."""
        live = self.batch_ids()
        if live:
            return self.partitions_of(live[-1:])
        # the newest segment that has rows
        for segment in reversed(self.segments.manifest().segments):
            rows = self.segments.read((segment,))
            newest = rows.agg(F.max(self.batch_col)).first()[0]
            if newest is not None:
                return rows.filter(F.col(self.batch_col) == newest)
        return self.spark.createDataFrame([], self.read_schema)

    def compact(self, upto: int) -> None:
        """Move the rows of the batches since the last compaction into segments; drop what the last one superseded."""
        before = self.segments.upto()
        if before is not None and upto <= before:
            return
        self.segments.add(self.partitions_of([b for b in self.batch_ids() if b <= upto]), int(upto))
        if before is not None:
            self.drop_batches(before)

    def drop_batches(self, upto: int) -> None:
        """Delete partitions with ``batch_id <= upto``."""
        for b in self._partitions():
            if b <= upto:
                self._fs.delete(f"{self.path}/{self.batch_col}={b}")
