"""Packing documents into fixed windows by minimum bin slack.

A document of at least a window fills whole windows; what remains of each
document (shorter than a window) is packed with others. The longest remainder
opens a window; a subset-sum dynamic programme over bit sets (the lengths in
descending order, each as often as it occurs) finds the multiset of other
remainders that comes closest to the capacity, and backtracking gives the
counts. The same multiset is used again while it lasts.

Each task packs its own rows in pools of bounded size; what no longer fills a
window moves on to the next pool. At the end of a task it is cut where windows
end, and the last, short one into sequences of power-of-two lengths, which need no
padding.

Defined results: a null text is empty and has the end id alone; an empty table
gives no rows. Any ids may repeat or be null; other columns are never looked at.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linefold.llm.common import ship, tidied
from linefold.llm.tokens import WordTokenizer, slices, vocabulary_path, with_end

WINDOW = 2048
END_ID = 1
#: Remainders held for choice in a task.
POOL = 8192
#: Bytes of text encoded at a time: a worker's memory is its executor's.
SLICE = 2_000_000

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def fill(counts: dict[int, int], capacity: int, lengths: list[int] | None = None) -> dict[int, int]:
    """Multiset ``{length: count}`` out of ``counts`` with the largest sum up to ``capacity``.

    ``lengths``: the keys of ``counts`` in ascending order, where they are known.
    """
    lengths = sorted(counts) if lengths is None else lengths
    reach = 1  # bit s: a sum of s can be reached
    within = (1 << (capacity + 1)) - 1
    steps: list[tuple[int, int, int]] = []
    for length in reversed(lengths[: bisect_right(lengths, capacity)]):
        left, some = min(counts[length], capacity // length), 1
        while left > 0 and not reach >> capacity & 1:
            take = min(some, left)
            steps.append((length, take, reach))
            reach |= reach << (length * take) & within
            left, some = left - take, some * 2
        if reach >> capacity & 1:
            break
    at, chosen = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> at & 1:
            at -= length * take
            chosen[length] = chosen.get(length, 0) + take
    return chosen


class _Packer:
    """The sequences of one task. An item is ``(doc_id, start, doc_tokens, ids)``."""

    def __init__(self, window: int, pool: int, first: int):
        self.window, self.pool = window, pool
        self.next = first
        self.by_length: dict[int, list[tuple]] = {}
        self.counts: dict[int, int] = {}  # of the items in by_length
        self.lengths: list[int] = []  # its keys, ascending
        self.held = 0
        self.rows: list[tuple] = []

    def _sequence(self, parts: list[tuple]) -> None:
        offset = 0
        for doc_id, start, doc_tokens, ids in parts:
            self.rows.append((doc_id, start, len(ids), zlib.crc32(ids), doc_tokens, self.next, offset))
            offset += len(ids)
        self.next += 1

    def add(self, doc_id, ids: np.ndarray) -> None:
        n, w = len(ids), self.window
        whole = n - n % w
        for start in range(0, whole, w):
            self._sequence([(doc_id, start, n, ids[start : start + w])])
        if whole < n:
            self._hold((doc_id, whole, n, ids[whole:].copy()))
            if self.held >= self.pool:
                self.pack(last=False)

    def _hold(self, item: tuple) -> None:
        length = len(item[3])
        if length not in self.by_length:
            self.by_length[length], self.counts[length] = [], 0
            insort(self.lengths, length)
        self.by_length[length].append(item)
        self.counts[length] += 1
        self.held += 1

    def _take(self, length: int) -> tuple:
        items = self.by_length[length]
        item = items.pop()
        self.counts[length] -= 1
        if not items:
            del self.by_length[length], self.counts[length], self.lengths[bisect_left(self.lengths, length)]
        self.held -= 1
        return item

    def pack(self, last: bool) -> None:
        """Full windows from the pool; what fills none waits for the next pool, or is cut if this is the last."""
        waiting: list[tuple] = []
        while self.by_length and (last or self.held > self.pool // 8):
            longest = self.lengths[-1]
            self.counts[longest] -= 1
            pattern = fill(self.counts, self.window - longest, self.lengths)
            self.counts[longest] += 1
            pattern[longest] = pattern.get(longest, 0) + 1
            full = sum(k * v for k, v in pattern.items()) == self.window
            times = min(len(self.by_length[k]) // v for k, v in pattern.items()) if full else 1
            for _ in range(times):
                parts = [self._take(k) for k, v in pattern.items() for _ in range(v)]
                if full:
                    self._sequence(parts)
                else:
                    waiting += parts
        if last:
            self._cut(waiting)
            return
        for item in waiting:
            self._hold(item)

    def _cut(self, parts: list[tuple]) -> None:
        """Whole windows, and of what is left sequences of power-of-two lengths; pieces are cut where one ends."""
        left = sum(len(p[3]) for p in parts)
        parts = parts[::-1]
        while left:
            room = want = min(self.window, 1 << (left.bit_length() - 1))
            sequence = []
            while room:
                doc_id, start, doc_tokens, ids = parts.pop()
                if len(ids) > room:
                    parts.append((doc_id, start + room, doc_tokens, ids[room:]))
                    ids = ids[:room]
                sequence.append((doc_id, start, doc_tokens, ids))
                room -= len(ids)
            self._sequence(sequence)
            left -= want

    def drain(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) if self.rows else [()] * 7
        self.rows = []
        names = [part.split()[0] for part in SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str | None = None,
    window: int = WINDOW,
    end_id: int = END_ID,
    pool: int = POOL,
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    ``vocabulary`` is a path that every executor can read (the installed public one by default).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a task's own: a worker that serves other stages later does not keep it
        words = WordTokenizer(vocabulary or vocabulary_path())
        packer = _Packer(window, pool, TaskContext.get().partitionId() << 33)
        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for a, b in slices(texts, SLICE):
                ids, offsets = with_end(*words.encode(texts.slice(a, b - a)), end_id)
                at = offsets.tolist()
                for i, start, stop in zip(range(a, b), at, at[1:]):
                    packer.add(doc_ids[i], ids[start:stop])
                if len(packer.rows) > 10_000:
                    yield packer.drain()
        packer.pack(last=True)
        yield packer.drain()

    ship(docs.sparkSession)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text")).mapInArrow(tidied(run), SCHEMA)
