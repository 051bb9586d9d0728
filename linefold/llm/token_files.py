"""Token-id files: concatenated ids with Elias-Fano document boundaries.

A file set is a folder of Parquet files; a row is a block of consecutive
documents in ascending id order:

``block``          long    number of the block; ascending blocks hold ascending ids
``doc_ids``        binary  the documents' ids, little-endian signed 64-bit (see ``null_ids``)
``null_ids``       long    documents at the start whose id is null
``n_docs, n_ids``  long    documents and token ids in the block
``ids``            binary  the token ids, little-endian unsigned 16- or 32-bit (``id_bytes`` each)
``low, high``      binary  Elias-Fano code of the documents' end offsets
``samples``        binary  select directory: ones before every 512 bits of ``high``, 32-bit

Spark writes the files, so they are complete or absent and lie in whatever
store the path names; a lost task is run again without a trace. Blocks are
bounded by ids and by documents, so a task holds one block at a time.

Defined results: a null text is empty and has the end id alone; null ids come
first; repeated ids follow each other in the order of their texts' hashes; an empty
table gives an empty file set.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linefold.llm.common import materialize, ship
from linefold.llm.tokens import slices, tokenizer, vocabulary_path, with_end

END_ID = 2
BLOCK_DOCS = 4096
BLOCK_IDS = 2_000_000

SCHEMA = (
    "block long, doc_ids binary, null_ids long, n_docs long, n_ids long, "
    "id_bytes int, ids binary, low binary, high binary, samples binary"
)


class EliasFano:
    """A non-descending sequence below ``universe`` in about 2 + log2(universe / n) bits a value."""

    def __init__(self, n: int, universe: int, low: bytes, high: bytes, samples: bytes):
        self.n = n
        self.bits = max(0, int(universe // max(n, 1)).bit_length() - 1)
        self.low, self.high = np.frombuffer(low, np.uint8), np.frombuffer(high, np.uint8)
        self.samples = np.frombuffer(samples, np.uint32)

    @classmethod
    def encode(cls, values: np.ndarray, universe: int) -> EliasFano:
        n = len(values)
        bits = max(0, int(universe // max(n, 1)).bit_length() - 1)
        v = values.astype(np.int64)
        low = ((v[:, None] >> np.arange(bits)) & 1).astype(np.uint8) if bits else np.zeros((n, 0), np.uint8)
        ones = (v >> bits) + np.arange(n)
        high = np.zeros(n + (universe >> bits) + 1, np.uint8)
        high[ones] = 1
        packed = np.packbits(high, bitorder="little")
        packed = np.concatenate([packed, np.zeros(-len(packed) % 64, np.uint8)])
        per_block = np.bitwise_count(packed).reshape(-1, 64).sum(axis=1, dtype=np.uint32)
        samples = np.concatenate([[0], np.cumsum(per_block)[:-1]]).astype("<u4")
        return cls(n, universe, np.packbits(low.ravel(), bitorder="little").tobytes(), packed.tobytes(), samples.tobytes())

    def select(self, at: np.ndarray) -> np.ndarray:
        """The values at the places ``at``: the directory finds the 512 bits that hold each one's mark, and only those are looked into."""
        at = np.asarray(at, dtype=np.int64)
        if len(at) and not (0 <= at.min() and at.max() < self.n):
            raise IndexError(f"places must be from 0 to {self.n - 1}")
        out, each = np.zeros(len(at), np.int64), np.arange(self.bits, dtype=np.int64)
        for i in range(0, len(at), 1024):
            some = at[i : i + 1024]
            block = np.searchsorted(self.samples, some, side="right") - 1
            bits = np.unpackbits(self.high.reshape(-1, 64)[block], axis=1, bitorder="little")
            rank = (some - self.samples[block].astype(np.int64))[:, None] + 1
            ones = block * 512 + (np.cumsum(bits, axis=1, dtype=np.int16) < rank).sum(axis=1)
            place = some[:, None] * self.bits + each
            low = (self.low[place >> 3] >> (place & 7).astype(np.uint8)) & 1
            out[i : i + 1024] = (ones - some << self.bits) + low.astype(np.int64) @ (1 << each)
        return out

    def values(self) -> np.ndarray:
        """All values, for a scan."""
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n].astype(np.int64)
        low = np.unpackbits(self.low, bitorder="little")[: self.n * self.bits].reshape(self.n, self.bits)
        return (ones - np.arange(self.n) << self.bits) + low @ (1 << np.arange(self.bits, dtype=np.int64))


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), *[pa.binary()] * 4]
    names = [part.split()[0] for part in SCHEMA.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def write(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str | None = None,
    end_id: int = END_ID,
    block_docs: int = BLOCK_DOCS,
    block_ids: int = BLOCK_IDS,
) -> None:
    """Write the token-id files of ``docs`` to the folder ``path``.

    The one shuffle deals the texts out in ranges of their ids; a range is one task's blocks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = tokenizer(vocabulary or vocabulary_path())
        wide = words.library.get_vocab_size() > 1 << 16 or end_id >= 1 << 16
        number = TaskContext.get().partitionId() << 33
        held: list[tuple] = []  # (doc_id, ids)
        n_ids = 0

        def block() -> pa.RecordBatch:
            nonlocal held, n_ids, number
            ends = np.cumsum([len(x) for _, x in held])
            code = EliasFano.encode(ends, int(ends[-1]))
            known = np.array([d for d, _ in held if d is not None], dtype="<i8")
            ids = np.concatenate([x for _, x in held])
            row = (
                number, known.tobytes(), len(held) - len(known), len(held), int(ends[-1]), 4 if wide else 2,
                ids.tobytes(), code.low.tobytes(), code.high.tobytes(), code.samples.tobytes(),
            )
            held, n_ids, number = [], 0, number + 1
            return _rows([row])

        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in slices(texts):
                ids, offsets = with_end(*words.encode(texts[a:b]), end_id)
                ids, at = ids.astype("<u4" if wide else "<u2"), offsets.tolist()
                for i, start, stop in zip(range(a, b), at, at[1:]):
                    x = ids[start:stop]
                    if held and (len(held) >= block_docs or n_ids + len(x) > block_ids):
                        yield block()
                    held.append((doc_ids[i], x))
                    n_ids += len(x)
        if held:
            yield block()

    ship(docs.sparkSession)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    ordered = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    # the hash splits an id that very many rows share
    ordered = ordered.withColumn("h", F.xxhash64("text"))
    ordered = ordered.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h").select("doc_id", "text")
    ordered.mapInArrow(run, SCHEMA).write.parquet(path)


def read(spark: SparkSession, path: str, doc_ids: Sequence[int | None] | None = None) -> DataFrame:
    """The documents of a file set: ``doc_id, start, n_tokens, ids`` (``ids`` little-endian unsigned 32-bit).

    With ``doc_ids`` only those of these ids: of a block, the boundaries of the wanted documents are selected and nothing
    else is decoded. The offset of a block is the number of ids in all blocks before it, a running sum over one short row
    per block.
    """
    files = spark.read.parquet(path)
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    at = files.select("block", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).cast("long").alias("at"))
    at = materialize(at, "starts")  # its size is known then, and the files stay where they are if it is small
    wanted = None if doc_ids is None else np.array(sorted({d for d in doc_ids if d is not None}), dtype=np.int64)
    nulls = doc_ids is None or None in doc_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                known, null_ids = np.frombuffer(r["doc_ids"], "<i8"), r["null_ids"]
                places = np.arange(null_ids if nulls else 0)
                some = np.arange(len(known)) if wanted is None else np.flatnonzero(np.isin(known, wanted))
                places = np.concatenate([places, some + null_ids])
                code = EliasFano(r["n_docs"], r["n_ids"], r["low"], r["high"], r["samples"])
                for i in range(0, len(places), 1024):
                    here = places[i : i + 1024]
                    ends = code.select(here)
                    starts = np.where(here > 0, code.select(np.maximum(here - 1, 0)), 0)
                    parts = [r["ids"][a * r["id_bytes"] : b * r["id_bytes"]] for a, b in zip(starts.tolist(), ends.tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([None if p < null_ids else int(known[p - null_ids]) for p in here.tolist()], pa.int64()),
                            pa.array(starts + r["at"], pa.int64()),
                            pa.array(ends - starts, pa.int64()),
                            pa.array([np.frombuffer(x, f"<u{r['id_bytes']}").astype("<u4").tobytes() for x in parts], pa.binary()),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids"],
                    )

    ship(spark)
    return files.join(at, "block").mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")
