"""Landed topics: Kafka records kept as files, read again as a stream with Kafka's own offsets.

A topic outlives the broker's retention as Parquet files. ``land_records`` writes
a batch of Kafka-shaped records; ``landed_stream`` reads the topics back as a stream whose
position is that of the Kafka source, ``{topic: {partition: offset}}``, with the same options:
``subscribe`` or ``assign``, and ``startingOffsets`` (``earliest``, ``latest`` or explicit). So the same job folds
from Kafka or from its archive, and a checkpoint's offset log reads alike. A batch takes all that
has landed: sources written in Python are not told where a batch begins, so they cannot bound it.

A landing is a folder of its own and counts when the committer has put ``_SUCCESS`` into it, so
a half-written one is never seen. Which offsets a file holds is read from its footer, once.
Data stay on the executors: an input partition is one file's records of one range.

Layout: ``<path>/<landing>/topic=<topic>/partition=<partition>/part-*.parquet``.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from linefold.config import KafkaSpec

SCHEMA = "topic string, partition int, offset bigint, timestamp timestamp_ntz, key string, value string"
#: Rows of a batch handed to Spark.
ROWS = 20_000

Offsets = dict[str, dict[str, int]]


def land_records(records: DataFrame, path: str, landing: str) -> None:
    """Write Kafka-shaped records as the landing ``landing``; a topic partition's records lie in the order of their offsets.

    A large topic partition is several files, each with a range of its offsets.
    """
    rows = records.selectExpr(*[f"CAST({c if c in records.columns else 'NULL'} AS {t}) AS {c}" for c, t in (x.split() for x in SCHEMA.split(", "))])
    rows = rows.repartitionByRange("topic", "partition", "offset").sortWithinPartitions("topic", "partition", "offset")
    rows.write.partitionBy("topic", "partition").parquet(f"{path}/{landing}")


def landed_stream(
    spark: SparkSession, path: str, spec: KafkaSpec, from_offsets: Mapping[tuple[str, int], int] | None = None
) -> DataFrame:
    """Stream of the landed topics, subscribed (S1) or assigned from offsets (S4), as ``sources.kafka.kafka_stream`` reads Kafka."""
    opts = spec.assign_options(from_offsets) if from_offsets else spec.subscribe_options()
    spark.dataSource.register(LandedTopics)
    return spark.readStream.format("landed_topics").options(**{k: v for k, v in opts.items() if not k.startswith("kafka.")}).load(path)


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    if re.match(r"file:/|/", path):
        return pafs.LocalFileSystem(), re.sub(r"^file:/+", "/", path)
    return pafs.FileSystem.from_uri(path)


@dataclass(frozen=True)
class LandedFile:
    """A file and the offsets it holds (``until`` exclusive)."""

    path: str
    topic: str
    partition: int
    first: int
    until: int


class LandedRange(InputPartition):
    """Records ``first..until-1`` of one file."""

    def __init__(self, root: str, file: str, topic: str, partition: int, first: int, until: int):
        super().__init__((root, file, first))
        self.root, self.file, self.topic, self.partition, self.first, self.until = root, file, topic, partition, first, until


class LandedTopics(DataSource):
    """``spark.readStream.format("landed_topics")``."""

    @classmethod
    def name(cls) -> str:
        return "landed_topics"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> LandedReader:  # noqa: N802 - Spark's name
        return LandedReader(self.options)


class LandedReader(DataSourceStreamReader):
    """Position and input partitions of the stream."""

    def __init__(self, options: Mapping[str, str]):
        self.root = options["path"].rstrip("/")
        self.assigned = {t: {str(p) for p in ps} for t, ps in json.loads(options["assign"]).items()} if "assign" in options else None
        self.topics = set(self.assigned or options["subscribe"].split(","))
        self.starting = options.get("startingOffsets", "latest")
        if "maxOffsetsPerTrigger" in options:
            raise ValueError("landed topics cannot bound a batch; land less at a time")
        # an explicit start may lie ahead of what has landed
        explicit = {} if self.starting in ("earliest", "latest") else json.loads(self.starting)
        self.explicit: Offsets = {t: {str(p): int(o) for p, o in ps.items()} for t, ps in explicit.items()}
        self.files: dict[str, LandedFile] = {}

    # -- what has landed
    def _list(self) -> list[LandedFile]:
        """The files of complete landings; only new ones are opened."""
        store, root = filesystem(self.root)
        for landing in store.get_file_info(pafs.FileSelector(root, allow_not_found=True)):
            if landing.type != pafs.FileType.Directory or landing.base_name.startswith((".", "_")):
                continue
            infos = store.get_file_info(pafs.FileSelector(landing.path, recursive=True))
            if not any(i.base_name == "_SUCCESS" for i in infos):
                continue
            for i in infos:
                found = re.search(r"/topic=([^/]+)/partition=(\d+)/[^/._][^/]*\.parquet$", i.path)
                if found and i.path not in self.files and unquote(found[1]) in self.topics:
                    self.files[i.path] = self._opened(store, i.path, unquote(found[1]), int(found[2]))
        return [f for f in self.files.values() if self._wanted(f.topic, f.partition)]

    def _wanted(self, topic: str, partition: int) -> bool:
        return topic in self.topics and (self.assigned is None or str(partition) in self.assigned[topic])

    @staticmethod
    def _opened(store: pafs.FileSystem, path: str, topic: str, partition: int) -> LandedFile:
        with store.open_input_file(path) as f:
            footer = pq.ParquetFile(f).metadata
            at = footer.schema.names.index("offset")
            groups = [footer.row_group(g).column(at).statistics for g in range(footer.num_row_groups)]
        return LandedFile(path, topic, partition, min((s.min for s in groups), default=0), max((s.max + 1 for s in groups), default=0))

    def _ends(self, files: list[LandedFile]) -> Offsets:
        ends: Offsets = {t: dict.fromkeys(ps, 0) for t, ps in (self.assigned or {}).items()}
        for f in files:
            of = ends.setdefault(f.topic, {})
            of[str(f.partition)] = max(of.get(str(f.partition), 0), f.until)
        return ends

    # -- Spark's side
    def initialOffset(self) -> Offsets:  # noqa: N802
        if self.explicit:
            return self.explicit
        files = self._list()
        if self.starting == "latest":
            return self._ends(files)
        begin: Offsets = {}
        for f in files:
            of = begin.setdefault(f.topic, {})
            of[str(f.partition)] = min(of.get(str(f.partition), f.first), f.first)
        return begin

    def latestOffset(self) -> Offsets:  # noqa: N802
        ends = self._ends(self._list())
        for topic, ps in self.explicit.items():
            for p, o in ps.items():
                ends.setdefault(topic, {})[p] = max(o, ends.get(topic, {}).get(p, o))
        return ends

    def partitions(self, start: Offsets, end: Offsets) -> list[LandedRange]:
        ranges = []
        for f in self._list():
            low = start.get(f.topic, {}).get(str(f.partition), 0)
            high = end.get(f.topic, {}).get(str(f.partition), 0)
            low, high = max(low, f.first), min(high, f.until)
            if low < high:
                ranges.append(LandedRange(self.root, f.path, f.topic, f.partition, low, high))
        return ranges

    def read(self, partition: LandedRange) -> Iterator[pa.RecordBatch]:
        store, _ = filesystem(partition.root)
        kinds = {"timestamp": pa.timestamp("us"), "key": pa.string(), "value": pa.string()}
        with store.open_input_file(partition.file) as f:
            for batch in pq.ParquetFile(f).iter_batches(ROWS, columns=["offset", *kinds]):
                keep = [partition.first <= o < partition.until for o in batch.column("offset").to_pylist()]
                batch = batch.filter(pa.array(keep))
                n = batch.num_rows
                columns = [pa.array([partition.topic] * n, pa.string()), pa.array([partition.partition] * n, pa.int32()), batch.column("offset")]
                columns += [batch.column(c).cast(k) for c, k in kinds.items()]
                yield pa.RecordBatch.from_arrays(columns, names=["topic", "partition", "offset", *kinds])

    def commit(self, end: Offsets) -> None:
        pass

    def stop(self) -> None:
        pass

