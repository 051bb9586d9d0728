"""The running summary as a replay-safe ledger.

Each micro-batch's counts go to their own ledger partition ``batch_id=N``
(see ``BatchTable``); the summary is ``sum(count)`` per key over the ledger.
A replayed batch overwrites its own partition, so a stopped, restarted or
replayed stream gives the same totals as one batch job over the same lines.
Nothing expires: an old day that shows up again is simply added to.

Compaction keeps the ledger short: ``compact(N)`` moves the partial sums of the batches
up to ``N`` into segments (see ``segments``), which merge by size tiers, a key's counts
added up. Sums are additive, so a compaction reads only the batches since the last one and the
segments it merges, never the whole history, and one that dies half way is invisible. What a
compaction supersedes is deleted only by the next one, so a summary read before a
compaction stays readable through it. ``N`` must stay below the newest batch that may
still be replayed (the one being written).

With each batch the ledger can keep the offset ranges it came from (``fold(..., ranges=...)``): one more row of the
batch's own partition, so that counts and ranges are there together or not at all. ``folded()`` is what the ledger
holds of every topic partition, as intervals, and ``next_offsets()`` where a stream with a new checkpoint goes on.

A batch can be revised (``revise``): counts that were missing from it, such as those of lines that were rejected and
can be parsed now, are kept beside it under its id. Revising it again replaces what was added before.

Segments are partitioned by the first key (a day, as a rule; a key with very many values
makes very many folders). ``read(days=...)`` opens the folders of those days alone, so
what it costs to bring a few days up to date does not grow with the history.

A ledger belongs to one stream, named by its checkpoint's id in ``_owner``; see
``BatchTable`` for what that proves.

Layout under ``path``::

    _owner                                             id of the stream's checkpoint
    _manifest                                          which segments count
    ledger/batch_id=<N>/part-*.parquet                 keys..., count
    revisions/batch_id=<N>/part-*.parquet              keys..., count
    _segments/<name>/_first=<first key>/part-*.parquet keys..., count
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from linefold.session import HadoopFS
from linefold.sinks.batch_table import BatchTable, Owned, OwnerError
from linefold.sinks.segments import FANOUT, Segments
from linefold.streaming.offset_log import Intervals, OffsetRange, dump_intervals, load_intervals, next_offsets, with_ranges

#: The segments' partition column: ``v`` and the first key, ``n`` for a null one.
FIRST = "_first"
#: The column of the row that holds a batch's offset ranges, null in all others.
RANGES = "_ranges"
#: Days (values of the first key) that are pruned by name; more are found by a join.
DAYS = 1000


def among(column: str, values: Sequence[str | None]) -> Column:
    """Whether a column has one of the values (null is one)."""
    some = [v for v in values if v is not None]
    found = F.col(column).isin(some) if some else F.lit(False)
    return found | F.col(column).isNull() if None in values else found


class SummaryLedger(Owned):
    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], count_col: str = "count", *, fanout: int = FANOUT):
        self.spark = spark
        self.path = path.rstrip("/")
        self.keys = list(keys)
        self.count_col = count_col
        self.schema = StructType(
            [StructField(k, StringType(), True) for k in self.keys] + [StructField(count_col, LongType(), True)]
        )
        with_ranges = StructType([*self.schema.fields, StructField(RANGES, StringType(), True)])
        self.ledger = BatchTable(spark, f"{self.path}/ledger", with_ranges)
        self.revisions = BatchTable(spark, f"{self.path}/revisions", self.schema)
        self._fs = HadoopFS(spark)
        stored = StructType([*self.schema.fields, StructField(FIRST, StringType(), True)])
        self.segments = Segments(spark, self.path, stored, self._fs, partition=FIRST, fanout=fanout)

    # -- writing -------------------------------------------------------------
    def fold(
        self, counts: DataFrame, batch_id: int, owner: str | None = None, ranges: Sequence[OffsetRange] | None = None
    ) -> bool:
        """Record one batch's counts (``keys..., count``) as batch ``batch_id``, and the offsets they came from; False if it has them already.

        A batch that is in a segment already is refused unless ``owner`` proves it to be a replay.
        """
        upto = self.segments.upto()
        if upto is not None and batch_id <= upto:
            if owner is None or owner != self.owner():
                raise OwnerError(f"batch {batch_id} of {self.path} is in segments (up to {upto}) and this is no proven replay")
            return False
        rows = counts.select(*self.keys, self.count_col).withColumn(RANGES, F.lit(None).cast("string"))
        if ranges:
            kept = [None] * len(self.schema.fields) + [json.dumps(ranges)]
            rows = rows.unionByName(self.spark.createDataFrame([tuple(kept)], self.ledger.schema))
        self.ledger.write(rows, batch_id)
        return True

    def compact(self, upto: int) -> None:
        """Move batches ``<= upto`` into segments; drop what the last compaction superseded."""
        before = self.segments.upto()
        if before is not None and upto <= before:
            return
        batches = [b for b in self.batch_ids() if b <= upto]
        rows = self._live(batches)
        stored = [*self.keys, self.count_col, FIRST]
        self.segments.add(
            rows.withColumn(FIRST, F.lit(None).cast("string")).select(*stored),
            int(upto),
            # a folder's name cannot be empty or null, so it is marked, and the keys stay in the rows
            lambda df: self._summed(df).withColumn(FIRST, F.coalesce(F.concat(F.lit("v"), self.keys[0]), F.lit("n"))).select(*stored),
            notes={"folded": dump_intervals(self._folded(batches))},
        )
        if before is not None:
            self.ledger.drop_batches(before)

    def revise(self, counts: DataFrame, batch_id: int) -> None:
        """Add counts to a batch that was folded already (an empty one, too), in place of what an earlier revision added to it."""
        counts = counts.select(*self.keys, self.count_col)
        if counts.isEmpty():  # an overwrite without rows would leave the earlier revision
            self._fs.delete(f"{self.revisions.path}/{self.revisions.batch_col}={batch_id}")
        else:
            self.revisions.write(counts, batch_id)

    # -- offsets -------------------------------------------------------------
    def _folded(self, batches: Sequence[int]) -> Intervals:
        """What is folded in the segments and in these batches; a short row for each batch."""
        kept = load_intervals(self.segments.manifest().notes.get("folded", []))
        rows = self.ledger.partitions_of(batches).filter(F.col(RANGES).isNotNull()).select(RANGES).collect() if batches else []
        return with_ranges(kept, [OffsetRange(*r) for row in rows for r in json.loads(row[0])])

    def folded(self) -> Intervals:
        """Per (topic, partition), the offsets whose records the summary holds."""
        return self._folded(self.batch_ids())

    def folded_before(self, batch_id: int) -> Intervals:
        """What was folded by batches before ``batch_id``; those of later batches in segments are counted in."""
        return self._folded([b for b in self.batch_ids() if b < batch_id])

    def next_offsets(self) -> dict[tuple[str, int], int]:
        """Where a stream goes on that has lost its checkpoint: nothing is left out, and what is read twice is told by ``folded``."""
        found = next_offsets(self.folded())
        if not found and not self.is_empty():
            raise ValueError(f"{self.path} was folded without offset ranges")
        return found

    # -- reading -------------------------------------------------------------
    def _live(self, batches: Sequence[int]) -> DataFrame:
        """The counts of batches that are in no segment."""
        return self.ledger.partitions_of(list(batches)).filter(F.col(RANGES).isNull()).select(*self.keys, self.count_col)

    def _summed(self, parts: DataFrame) -> DataFrame:
        return parts.groupBy(*self.keys).agg(F.sum(self.count_col).alias(self.count_col))

    def read(self, days: Sequence[str | None] | DataFrame | None = None) -> DataFrame:
        """The summary: one row per key, ``keys..., count BIGINT``.

        ``days`` keeps the keys whose first one is among these values, or in the first column of a DataFrame.
        """
        live, base = self._live(self.batch_ids()), self.segments.read()
        if revised := self.revisions.batch_ids():
            live = live.unionByName(self.revisions.partitions_of(revised).select(*live.columns))
        if isinstance(days, DataFrame):
            values = self.day_values(days)
            if values is None:
                wanted = days.select(F.col(days.columns[0]).alias("_wanted")).distinct()
                live, base = (df.join(wanted, F.col(self.keys[0]).eqNullSafe(F.col("_wanted")), "left_semi") for df in (live, base))
                return self._summed(live.select(*self.keys, self.count_col).unionByName(base.select(*self.keys, self.count_col)))
            days = values
        if days is not None:
            folders = ["n" if d is None else f"v{d}" for d in days]
            live, base = live.filter(among(self.keys[0], days)), base.filter(among(FIRST, folders))
        return self._summed(live.select(*self.keys, self.count_col).unionByName(base.select(*self.keys, self.count_col)))

    def day_values(self, rows: DataFrame) -> list[str | None] | None:
        """The distinct values of the first column of ``rows``; None if there are more than ``DAYS``."""
        found = [r[0] for r in rows.select(rows.columns[0]).distinct().limit(DAYS + 1).collect()]
        return found if len(found) <= DAYS else None

    def read_compat(self) -> DataFrame:
        """The summary with ``count`` as a string, the original table layout."""
        return self.read().withColumn(self.count_col, F.col(self.count_col).cast("string"))

    def register(self, name: str, *, compat: bool = False) -> DataFrame:
        """Name the summary for SQL (``SELECT * FROM <name>``) as a temp view.

        The view holds the file listing of the moment: call again after new
        batches or a compaction to see them.
        """
        df = self.read_compat() if compat else self.read()
        df.createOrReplaceTempView(name)
        return df

    def batch_ids(self) -> list[int]:
        """Batches that are in no segment yet."""
        upto = self.segments.upto()
        return [b for b in self.ledger.batch_ids() if upto is None or b > upto]

    def batch(self, batch_id: int) -> DataFrame:
        """The counts of one batch that is in no segment yet (none: no rows)."""
        return self._live([b for b in self.batch_ids() if b == batch_id])

    def newest_batch(self) -> int | None:
        upto, live = self.segments.upto(), self.ledger.newest_batch()
        return max([b for b in (upto, live) if b is not None], default=None)

    def is_empty(self) -> bool:
        return self.segments.upto() is None and self.ledger.is_empty()
