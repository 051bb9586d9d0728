"""Alignment of the tokens of two tokenizers over the same bytes, with corpus-wide counts of linked ids.

Every text is tokenised whole by both. Where tokens of both end before tokens of both
that begin with a space, the text is cut into windows of token ids: an anchor is taken
only where the byte offsets of both sides are the same, whatever the ids look like.
Natural text repeats its windows (about words), so a batch aligns a window once for
each pair of id tuples and remembers it: byte offsets at which both sides' tokens end cut it into groups,
and all pairs of a group are links.

The counts take one narrow pass and joins by pair. A task works on batches of documents
of bounded size. It writes the batch's list of distinct pairs, in rows of bounded length,
with how many documents of the batch hold each, and a row for each document: the pairs it holds,
as numbers into that list, and how often. No row grows with the batch. The pairs' counts
are summed over the corpus and joined back, a row for each batch and pair, and the
documents of a batch meet them as one group, which is a batch at most and is all that a task
has in memory at a time. The highest count of each id of A is a
table bounded by A's vocabulary.

Defined results: a null or empty text, and one whose tokens' bytes are not the text's
(one holding U+2581, say), has no tokens: all numbers are 0 and the digest is the empty
string. Ids may repeat or be null: each row is a document of its own. An empty table gives no
rows. Other columns are never looked at. A text is never cut: a batch holds one text at least.
"""

from __future__ import annotations

import hashlib
import os
import re
import unicodedata
from array import array
from collections import defaultdict
from collections.abc import Iterator
from itertools import count, islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linefold.llm.byte_bpe import LATIN, scanner
from linefold.llm.common import arrow_bytes, give_back, materialize, ship, text_of, tidied
from linefold.llm.tokens import PieceMemo, ragged, vocabulary_path

VOCABULARY_A, VOCABULARY_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Characters of a batch (a longer text is alone), and of a call of the tokenizers.
BATCH, SLICE = 4_000_000, 500_000
#: Distinct pre-tokens of each side that a worker remembers.
CACHE = 400_000
#: Pairs of a row, and bytes of texts that a task hands to its Python worker at once.
PAIRS, INPUT = 10_000, 4 << 20
#: Added to an id of B where it stands beside ids of A.
OF_B = np.uint32(1 << 31)

SCHEMA = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
#: A row of pairs, the first of which has the number ``first``, or of a document, which holds ``n_held`` of them.
_BATCHES = (
    "batch long, first long, pairs array<long>, holders array<int>, doc_id long, n_a long, n_b long, n_groups long, "
    "n_links long, groups_sha256 string, n_held long, held binary, times binary"
)


def byte_alphabet() -> dict[str, int]:
    """The characters by which a byte-level vocabulary writes bytes: printable Latin-1 as itself, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class _Side:
    """Bytes of a tokenizer's ids; an id without bytes of its own has a byte no text can hold."""

    _memo: PieceMemo | None = None

    def _table(self, pieces: dict[int, bytes]) -> None:
        every = [pieces.get(i) or b"\xff" for i in range(max(pieces) + 1)]
        self.lengths = np.array([len(p) for p in every], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(every), dtype=np.uint8)
        self.spaced = np.array([p[:1] == b" " for p in every])

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return self.bytes[ragged(self.starts[ids], self.lengths[ids])]


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    ids = array("I")
    for x in lists:
        ids.extend(x)
    return np.array(ids, dtype=np.uint32), np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)


class SideA(_Side):
    """Byte-level BPE of the tokenizers library, over a space and the text."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        letters = byte_alphabet()
        vocabulary = self.library.get_vocab(with_added_tokens=False)
        self._table({i: bytes(letters[c] for c in p) for p, i in vocabulary.items() if all(c in letters for c in p)})
        # the library encodes each pre-token alone, and its classes of Latin characters never changed
        kinds = {c: unicodedata.category(chr(c))[0] for c in range(LATIN)}
        blank = {*range(9, 14), 0x20, 0x85, 0xA0}
        self._find = scanner((c for c in kinds if kinds[c] == "L"), (c for c in kinds if kinds[c] == "N"), blank)
        self._is_latin = re.compile(f"[\\0-{chr(LATIN - 1)}]*").fullmatch
        self._memo = PieceMemo(self._learn, CACHE)

    def _learn(self, pieces: list[str]) -> list[list[int]]:
        """Ids of pre-tokens; words behind a space go to the library many at once, and are told apart by their spaces."""
        words = [p for p in pieces if p.startswith(" ") and p[1:].isalpha()]
        known: dict[str, list[int]] = {}
        for i in range(0, len(words), 5000):
            some = words[i : i + 5000]
            ids = self._whole_texts(["".join(some)])[0]
            cuts = np.flatnonzero(self.spaced[ids]).tolist()
            known.update(zip(some, (ids[a:b] for a, b in zip(cuts, [*cuts[1:], len(ids)]))))
        others = iter(self._whole_texts([p for p in pieces if p not in known]))
        return [known[p] if p in known else next(others) for p in pieces]

    def _whole_texts(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)] if texts else []

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        texts = [f" {t}" for t in texts]
        latin = [bool(self._is_latin(t)) for t in texts]
        ids, at = self._memo.encode([self._find(t) for t, easy in zip(texts, latin) if easy])
        if all(latin):
            return ids, at
        hard = iter(self._whole_texts([t for t, easy in zip(texts, latin) if not easy]))
        parts = iter(np.split(ids, at[1:-1]))
        every = [next(parts) if easy else np.array(next(hard), dtype=np.uint32) for easy in latin]
        return np.concatenate(every).astype(np.uint32), np.concatenate([[0], np.cumsum([len(x) for x in every])])


class SideB(_Side):
    """BPE with byte fallback of the sentencepiece library, which adds the space itself."""

    _find = staticmethod(re.compile(" +[^ ]*").findall)

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.library.get_piece_size()
        self._table({i: self._bytes(i) for i in range(size)})
        # where no piece goes on from another character into a space, no merge does, and a text is the sum of its
        # runs of spaces with what follows each
        if not any(re.search("[^▁]▁", self.library.id_to_piece(i)) for i in range(size)):
            self._memo = PieceMemo(self._learn, CACHE)

    def _learn(self, pieces: list[str]) -> list[list[int]]:
        """Ids of runs; the library adds a space, but not to an empty text."""
        lone = [self.library.piece_to_id("▁")]
        return [ids or lone for ids in self.library.encode([p[1:] for p in pieces], num_threads=1)]

    def _bytes(self, i: int) -> bytes:
        if self.library.is_byte(i):
            return bytes([int(self.library.id_to_piece(i)[3:-1], 16)])
        if self.library.is_unknown(i) or self.library.is_control(i):
            return b"\xff"
        return self.library.id_to_piece(i).replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if self._memo is None or any("▁" in t for t in texts):  # the mark of a space is no space
            return _flat(self.library.encode(texts, num_threads=1))
        return self._memo.encode([self._find(f" {t}") if t else [] for t in texts])


class Aligner:
    """Aligns windows, many at a time: each the bytes of its 32-bit ids, those of A and then those of B, which are marked."""

    def __init__(self, a: SideA, b: SideB):
        self.a, self.b = a, b
        decimals = [str(i).encode() + b"," for i in range(max(len(a.lengths), len(b.lengths)))]
        self._sizes = np.array([len(d) for d in decimals], dtype=np.int64)
        self._at = np.cumsum(self._sizes) - self._sizes
        self._digits = np.frombuffer(b"".join(decimals), dtype=np.uint8)

    def align(self, windows: list[bytes]) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray]:
        """For each window how many groups, their text (each group ends in a semicolon), how many links, and all links ``a << 32 | b``."""
        every = np.frombuffer(b"".join(windows), np.uint32)
        of_b = every >= OF_B
        ids_a, ids_b = every[~of_b].astype(np.int64), (every[of_b] - OF_B).astype(np.int64)
        ends_a, ends_b = np.cumsum(self.a.lengths[ids_a]), np.cumsum(self.b.lengths[ids_b])
        # both sides of a window have the same bytes, so offsets run through all windows, and a window's end is a group's
        shared = np.intersect1d(ends_a, ends_b, assume_unique=True)
        group_a, group_b = np.searchsorted(shared, ends_a), np.searchsorted(shared, ends_b)
        n_a, n_b = np.bincount(group_a, minlength=len(shared)), np.bincount(group_b, minlength=len(shared))
        upto_a, upto_b = np.cumsum(n_a), np.cumsum(n_b)
        last = np.cumsum(~of_b)[np.cumsum([len(w) // 4 for w in windows]) - 1] - 1
        group_at = np.concatenate([[0], group_a[last] + 1])  # first group of each window
        pairs = np.repeat(ids_a, n_b[group_a]) << 32 | ids_b[ragged((upto_b - n_b)[group_a], n_b[group_a])]
        link_at = np.concatenate([[0], np.cumsum(n_a * n_b)])[group_at]
        # the text: a group's ids of A, then its ids of B, each with the mark behind it
        place_a = np.arange(len(ids_a)) + (upto_b - n_b)[group_a]
        place_b = np.arange(len(ids_b)) + upto_a[group_b]
        ids, marks = np.empty(len(ids_a) + len(ids_b), np.int64), np.full(len(ids_a) + len(ids_b), ord(","), np.uint8)
        ids[place_a], ids[place_b] = ids_a, ids_b
        marks[place_a[upto_a - 1]], marks[place_b[upto_b - 1]] = ord("|"), ord(";")
        sizes = self._sizes[ids]
        text = self._digits[ragged(self._at[ids], sizes)]
        ends = np.cumsum(sizes)
        text[ends - 1] = marks
        text_at = np.concatenate([[0], ends[(upto_a + upto_b - 1)[group_at[1:] - 1]]]).tolist()
        raw = text.tobytes()
        return np.diff(group_at), [raw[i:j] for i, j in zip(text_at, text_at[1:])], np.diff(link_at), pairs

    def forget(self) -> None:
        """Give up what is remembered of texts."""
        for side in (self.a, self.b):
            if side._memo is not None:
                side._memo.forget()


def _packed(values: np.ndarray) -> bytes:
    """Unsigned values in as few whole bytes each as the largest needs."""
    most = int(values.max()) if len(values) else 0
    return values.astype("<u1" if most < 1 << 8 else "<u2" if most < 1 << 16 else "<u4" if most < 1 << 32 else "<u8").tobytes()


def _unpacked(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, f"<u{len(raw) // n}" if n else "<u1").astype(np.int64)


def _cut(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """The packed values in runs of these lengths."""
    raw = _packed(values)
    offsets = np.concatenate([[0], np.cumsum(lengths)]) * (len(raw) // max(len(values), 1))
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(raw)])


def _rows(number: int, n: int, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    """``n`` rows of a batch; null where they have no value."""
    types = {"long": pa.int64(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()), "string": pa.string(), "binary": pa.binary()}
    columns = {"batch": pa.array([number] * n, pa.int64())} | columns
    wanted = [c.split() for c in _BATCHES.split(", ")]
    return pa.RecordBatch.from_arrays([columns.get(c, pa.nulls(n, types[kind])) for c, kind in wanted], names=[c for c, _ in wanted])


class _Batch:
    """Documents of one batch: results of their own, their windows, and which pairs they hold."""

    def __init__(self, aligner: Aligner):
        self.aligner = aligner
        self.windows = self._numbers()  # in the order they came
        self.groups = self.n_links = np.zeros(0, np.int64)
        self.texts: list[bytes] = []
        self.links: list[np.ndarray] = []
        self.rows: list[tuple] = []  # doc_id, n_a, n_b, n_groups, n_links, digest
        self.held: list[np.ndarray] = []  # distinct windows of a document
        self.times: list[np.ndarray] = []
        self.chars = 0

    @staticmethod
    def _numbers() -> dict[bytes, int]:
        return defaultdict(count().__next__)

    @staticmethod
    def _whole(wanted: list[bytes], side: _Side, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Which texts' ids have the bytes of a space and the text."""
        ends = np.concatenate([[0], np.cumsum(side.lengths[ids])])[at]
        good = np.diff(ends) == np.array([len(w) for w in wanted])
        have = side.joined(ids).tobytes()
        for i in np.flatnonzero(good).tolist():
            good[i] = have[ends[i] : ends[i + 1]] == wanted[i]
        return good

    def add(self, doc_ids: list, texts: list[str]) -> None:
        """Take a slice of documents in."""
        self.chars += sum(map(len, texts))
        a, b = self.aligner.a, self.aligner.b
        (ids_a, at_a), (ids_b, at_b) = a.encode(texts), b.encode(texts)
        wanted = [f" {t}".encode() for t in texts]
        good = self._whole(wanted, a, ids_a, at_a) & self._whole(wanted, b, ids_b, at_b) & np.array([bool(t) for t in texts])
        size_a, size_b = np.where(good, np.diff(at_a), 0), np.where(good, np.diff(at_b), 0)
        ids_a, ids_b = ids_a[np.repeat(good, np.diff(at_a))], ids_b[np.repeat(good, np.diff(at_b))]
        # both sides have the same bytes, so anchors are found over the joined bytes of the slice; a document begins
        # with a space, so its end is an anchor
        stop_a, stop_b = (np.append(side.spaced[ids[1:]], True)[: len(ids)] for side, ids in ((a, ids_a), (b, ids_b)))
        after_a, after_b = np.flatnonzero(stop_a) + 1, np.flatnonzero(stop_b) + 1
        ends_a, ends_b = np.cumsum(a.lengths[ids_a]), np.cumsum(b.lengths[ids_b])
        _, cut_a, cut_b = np.intersect1d(ends_a[after_a - 1], ends_b[after_b - 1], assume_unique=True, return_indices=True)
        cut_a, cut_b = after_a[cut_a], after_b[cut_b]
        # window after window: its ids of A, then its ids of B
        ids = np.empty(len(ids_a) + len(ids_b), np.uint32)
        in_a, in_b = np.diff(cut_a, prepend=0), np.diff(cut_b, prepend=0)
        ids[np.arange(len(ids_a)) + np.repeat(cut_b - in_b, in_a)] = ids_a
        ids[np.arange(len(ids_b)) + np.repeat(cut_a, in_b)] = ids_b + OF_B
        raw, ends, number = ids.tobytes(), ((cut_a + cut_b) * 4).tolist(), self.windows.__getitem__
        numbers = [number(raw[i:j]) for i, j in zip([0, *ends], ends)]
        if len(self.windows) > len(self.groups):
            groups, of_groups, n_links, links = self.aligner.align(list(islice(self.windows, len(self.groups), None)))
            self.groups, self.n_links = np.append(self.groups, groups), np.append(self.n_links, n_links)
            self.texts += of_groups
            self.links.append(links)
        which, groups, n_links = np.array(numbers, dtype=np.int64), self.groups, self.n_links
        bounds = np.concatenate([[0], np.searchsorted(cut_a, np.cumsum(size_a), side="right")]).tolist()
        for k, doc_id in enumerate(doc_ids):
            mine = which[bounds[k] : bounds[k + 1]] if good[k] else which[:0]
            text = b"".join([self.texts[w] for w in numbers[bounds[k] : bounds[k + 1]]])[:-1] if good[k] else b""
            row = (int(size_a[k]), int(size_b[k]), int(groups[mine].sum()), int(n_links[mine].sum()))
            self.rows.append((doc_id, *row, hashlib.sha256(text).hexdigest() if good[k] else ""))
            some, times = np.unique(mine, return_counts=True)
            self.held.append(some.astype(np.uint32))
            self.times.append(times.astype(np.uint32))

    def close(self, number: int) -> Iterator[pa.RecordBatch]:
        """The batch's rows: its pairs, then its documents."""
        link_at = np.concatenate([[0], np.cumsum(self.n_links)])
        self.windows, self.texts = self._numbers(), []  # not asked for any more
        pairs, links = np.unique(np.concatenate([np.zeros(0, np.int64), *self.links]), return_inverse=True)
        self.links = []
        holders = np.zeros(len(pairs), dtype=np.int64)
        held, times, sizes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], []
        for a in range(0, len(self.held), 256):  # a few documents at a time: their distinct pairs
            some = self.held[a : a + 256]
            windows = np.concatenate(some)
            of_window = np.diff(link_at)[windows]
            every = np.repeat(np.repeat(np.arange(len(some)), [len(x) for x in some]), of_window) * len(pairs)
            every += links[ragged(link_at[windows], of_window)]
            order = np.argsort(every)
            every = every[order]
            first = np.flatnonzero(np.diff(every, prepend=-1))
            doc, pair = np.divmod(every[first], max(len(pairs), 1))
            if len(first):
                often = np.repeat(np.concatenate(self.times[a : a + 256]).astype(np.int64), of_window)
                times.append(np.add.reduceat(often[order], first))
            held.append(pair)
            sizes.append(np.bincount(doc, minlength=len(some)))
            holders += np.bincount(pair, minlength=len(pairs))[: len(pairs)]
        parts = np.append(np.arange(0, len(pairs), PAIRS), len(pairs))
        lists = {"pairs": pa.array(pairs, pa.int64()), "holders": pa.array(holders, pa.int32())}
        columns = {c: pa.ListArray.from_arrays(pa.array(parts, pa.int32()), x) for c, x in lists.items()}
        yield _rows(number, len(parts) - 1, {"first": pa.array(parts[:-1], pa.int64())} | columns)
        n_held = np.concatenate(sizes)
        columns = {c: pa.array(x, pa.int64()) for c, x in zip(("doc_id", "n_a", "n_b", "n_groups", "n_links"), zip(*self.rows))}
        columns["groups_sha256"] = pa.array([row[5] for row in self.rows], pa.string())
        packed = {"held": _cut(np.concatenate(held), n_held), "times": _cut(np.concatenate(times), n_held)}
        yield _rows(number, len(self.rows), columns | {"n_held": pa.array(n_held, pa.int64())} | packed)


_LOADED: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """The worker's tokenizers."""
    if (path_a, path_b) not in _LOADED:
        _LOADED.clear()
        _LOADED[path_a, path_b] = Aligner(SideA(path_a), SideB(path_b))
    return _LOADED[path_a, path_b]


def _summed(docs: pa.Table, answers: pa.Table) -> pa.Table:
    """Sums of the documents of a batch, from the counts of its pairs."""
    at, n_held = answers["at"].to_numpy(), docs["n_held"].to_numpy()
    held, times = (_unpacked(b"".join(docs[c].to_pylist()), int(n_held.sum())) for c in ("held", "times"))
    ends = np.cumsum(n_held)
    columns = {c: docs[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
    for name, of_pair in (("n_best", "best"), ("count_sum", "n")):
        values = np.zeros(len(at), np.int64)
        values[at] = answers[of_pair].to_numpy()
        upto = np.concatenate([[0], np.cumsum(values[held] * times)])
        columns[name] = pa.array(upto[ends] - upto[ends - n_held], pa.int64())
    give_back()
    return pa.table(columns | {"groups_sha256": docs["groups_sha256"]})


def align(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary_a: str | None = None,
    vocabulary_b: str | None = None,
    batch_chars: int = BATCH,
) -> DataFrame:
    """One row per document: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    The vocabularies are paths that every executor can read (the installed public ones by default).
    """
    return document_sums(*_tables(docs, id_col, text_col, vocabulary_a, vocabulary_b, batch_chars))


def pair_counts(batches: DataFrame) -> DataFrame:
    """``pair, n``: how many documents hold the pair ``a << 32 | b`` linked."""
    held = batches.select(F.explode(F.arrays_zip("pairs", "holders")).alias("p"))
    return held.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.holders").cast("long").alias("n"))


def _tables(docs, id_col, text_col, vocabulary_a, vocabulary_b, batch_chars) -> tuple[DataFrame, DataFrame]:
    path_a, path_b = vocabulary_a or vocabulary_path(VOCABULARY_A), vocabulary_b or vocabulary_path(VOCABULARY_B)

    def run(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = aligner(path_a, path_b)
        number = TaskContext.get().partitionId() << 33
        batch, ids, texts, size = _Batch(tokens), [], [], 0
        for record in records:
            for doc_id, text in zip(record.column(0).to_pylist(), record.column(1)):
                text = text.as_py()
                if texts and size + len(text) > SLICE:
                    batch.add(ids, texts)
                    ids, texts, size = [], [], 0
                    if batch.chars + len(text) > batch_chars:
                        yield from batch.close(number)
                        batch, number = _Batch(tokens), number + 1
                        give_back()
                ids.append(doc_id)
                texts.append(text)
                size += len(text)
        if texts:
            batch.add(ids, texts)
        if batch.rows:
            yield from batch.close(number)
        tokens.forget()  # a worker that waits, or serves other stages, keeps the tokenizers only

    ship(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_of(F.col(f"`{text_col}`")).alias("text"))
    with arrow_bytes(docs.sparkSession, INPUT):
        batches = materialize(rows.mapInArrow(tidied(run), _BATCHES), "links-batches")
    return batches, materialize(pair_counts(batches), "links-counts")


def document_sums(batches: DataFrame, counts: DataFrame) -> DataFrame:
    """The documents of the batches with their sums over the corpus-wide counts."""
    a = F.shiftright("pair", 32)
    highest = counts.groupBy(a.alias("a")).agg(F.max("n").alias("most"))
    # a row for each id of A at most: its vocabulary bounds what is broadcast
    counted = counts.join(F.broadcast(highest), a == F.col("a")).select("pair", "n", (F.col("n") == F.col("most")).cast("int").alias("best"))
    asked = batches.select("batch", "first", F.posexplode("pairs").alias("at", "pair"))
    answers = asked.join(counted, "pair").select(F.col("batch").alias("of"), (F.col("first") + F.col("at")).alias("at"), "n", "best")
    documents = batches.where(F.col("held").isNotNull()).drop("first", "pairs", "holders")
    return documents.groupBy("batch").cogroup(answers.groupBy("of")).applyInArrow(_summed, SCHEMA)
