"""Byte-level BPE encoding by a rank file, and decoding, with overlapping chunks for long texts.

The pattern cuts a text into pre-tokens, and the ranks turn the bytes of each into
ids. A match depends only on where it begins and on what follows, so two scans that
have one boundary in common agree from there on. A text longer than ``chunk``
characters is therefore cut into chunks that overlap, the chunks are pre-tokenised
in parallel, and two neighbours are stitched at the first boundary that both have in
their overlap. Every chunk then encodes the pre-tokens between its two stitches.

What a scan from the middle of a text finds is not to be trusted at once: it may begin
inside a pre-token. It meets the true boundaries at the end of that run, or, behind an
apostrophe, at the end of the next. So a chunk offers no boundary before its second as a
stitch to its successor, nor one that its end may have cut. Where two neighbours have no such
boundary in common (a run longer than the overlap), they are glued and scanned as one.

Decoding concatenates the raw bytes of the ids.

Classes of characters are those of the rank library, asked for every character once: Python's
own follow another version of Unicode.

Defined results: a null or empty text has no ids, and decodes to no bytes. Ids may
repeat or be null: the rows stay apart. Repeated rows give repeated rows, an empty
table none. Other columns are never looked at. Only the pre-tokens of one chunk, and for
a text's row its ids, are in memory at a time.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linefold.llm.common import materialize, ship, text_of
from linefold.llm.tokens import PieceMemo, ragged, slices, vocabulary_path

DEFAULT_RANKS = "byte_bpe_multi_50k.tiktoken"
#: Fixed value: the pattern that cuts a text before the merges (that of the public vocabularies).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters of a chunk, and how many of the next chunk's it holds besides.
CHUNK, OVERLAP = 32_768, 512
#: Distinct pre-tokens that a worker remembers, and characters it encodes at a time.
CACHE, SLICE = 150_000, 1_000_000

#: Texts below this code point are scanned with the classes of these characters alone, which is faster.
LATIN = 0x250

SCHEMA = "doc_id long, n_tokens long, ids binary"
_CHUNKS = "row long, part int, doc_id long, n_chars long, text string"
_EDGES = "row long, part int, head array<long>, tail array<long>"


def scanner(letters: Iterable[int], numbers: Iterable[int], spaces: Iterable[int]) -> Callable[[str], list[str]]:
    """A function that cuts a text into pre-tokens, with ``PATTERN``'s classes made of the given code points."""

    def ranges(points: Iterable[int]) -> str:
        points = sorted(points)
        firsts = [c for c, before in zip(points, [-2, *points]) if c != before + 1]
        lasts = [c for c, after in zip(points, [*points[1:], -2]) if after != c + 1]
        return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(firsts, lasts))

    word, number, space = map(ranges, (letters, numbers, spaces))
    pattern = PATTERN.replace(r"[^\s\p{L}\p{N}]", f"[^{space}{word}{number}]").replace(r"(?!\S)", f"(?![^{space}])")
    pattern = pattern.replace(r"\p{L}", f"[{word}]").replace(r"\p{N}", f"[{number}]").replace(r"\s", f"[{space}]")
    return re.compile(pattern).findall


def read_ranks(path: str) -> dict[bytes, int]:
    """Pieces and ranks of a rank file."""
    with open(path, "rb") as f:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, f)}


class Coder:
    """Pre-tokens and ids by one rank file."""

    def __init__(self, path: str, cache: int = CACHE):
        import tiktoken

        def library(pattern: str, ranks: dict[bytes, int]):
            return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

        encode = library(PATTERN, read_ranks(path)).encode_ordinary
        self._memo = PieceMemo(lambda pieces: list(map(encode, pieces)), cache)
        self.encode_pieces = self._memo.encode
        every = np.concatenate([np.arange(0xD800), np.arange(0xE000, 0x110000)]).astype("<u4").tobytes().decode("utf-32-le")
        classes = []
        for pattern in (r"\p{L}", r"\p{N}", r"\s"):
            of_class = library(pattern, {bytes([i]): i for i in range(256)})
            classes.append(list(map(ord, of_class.decode(of_class.encode_ordinary(every)))))
        self._find = scanner(*classes)
        self._find_latin = scanner(*([c for c in points if c < LATIN] for points in classes))
        self._is_latin = re.compile(f"[\\0-{chr(LATIN - 1)}]*").fullmatch

    def pieces(self, text: str) -> list[str]:
        """The pre-tokens of a text; together they are the text."""
        return (self._find_latin if self._is_latin(text) else self._find)(text)

    def ends(self, text: str) -> list[int]:
        """Where the pre-tokens of a text end."""
        return np.cumsum([len(p) for p in self.pieces(text)], dtype=np.int64).tolist()


class Decoder:
    """Bytes of the ids of one rank file."""

    def __init__(self, path: str):
        ranks = read_ranks(path)
        pieces = [b""] * (max(ranks.values()) + 1)
        for piece, rank in ranks.items():
            pieces[rank] = piece
        self._lengths = np.array([len(p) for p in pieces], dtype=np.int64)
        self._starts = np.cumsum(self._lengths) - self._lengths
        self._bytes = np.frombuffer(b"".join(pieces), dtype=np.uint8)

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the ids, one after another."""
        return self._bytes[ragged(self._starts[ids], self._lengths[ids])].tobytes()


_LOADED: dict[tuple[type, str], Coder | Decoder] = {}


def loaded(kind: type, path: str) -> Coder | Decoder:
    """The worker's coder or decoder for a rank file."""
    if (kind, path) not in _LOADED:
        _LOADED.clear()
        _LOADED[kind, path] = kind(path)
    return _LOADED[kind, path]


def _encoded(keys: list, lists: list[list[str]], words: Coder) -> pa.RecordBatch:
    ids, at = words.encode_pieces(lists)
    parts = [ids[at[i] : at[i + 1]].tobytes() for i in range(len(lists))]
    columns = [pa.array(keys, pa.int64()), pa.array(np.diff(at), pa.int64()), pa.array(parts, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids"])


def edges(text: str, part: int, last: bool, words: Coder, chunk: int, overlap: int) -> tuple[list[int], list[int]]:
    """Boundaries of a chunk that may meet those of its predecessor, and of its successor; positions in the whole text."""
    at = part * chunk
    ends = words.ends(text)
    if not last and ends:
        ends.pop()  # the chunk's end may have cut it
    head = [at, *(at + e for e in ends if e <= overlap)]
    trusted = ends if part == 0 else ends[1:]
    return head, [at + e for e in trusted if e >= chunk]


def _long(docs: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """Ids of the texts of several chunks."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                for some in range(0, len(text), chunk * 64):
                    at = range(some, min(some + chunk * 64, len(text)), chunk)
                    columns = [
                        pa.array([row] * len(at), pa.int64()),
                        pa.array([i // chunk for i in at], pa.int32()),
                        pa.array([doc_id] * len(at), pa.int64()),
                        pa.array([len(text)] * len(at), pa.int64()),
                        pa.array([text[i : i + chunk + overlap] for i in at], pa.string()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=["row", "part", "doc_id", "n_chars", "text"])
                row += 1

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = loaded(Coder, path)
        for batch in batches:
            rows, parts, sizes = (batch.column(c).to_pylist() for c in ("row", "part", "n_chars"))
            found = [
                edges(t.as_py(), p, (p + 1) * chunk >= n, words, chunk, overlap)
                for t, p, n in zip(batch.column("text"), parts, sizes)
            ]
            columns = [pa.array(rows, pa.int64()), pa.array(parts, pa.int32())]
            columns += [pa.array([f[i] for f in found], pa.list_(pa.int64())) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "part", "head", "tail"])

    def encode_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = loaded(Coder, path)
        for batch in batches:
            for r in batch.to_pylist():
                texts = [c["text"] for c in r["chunks"]]
                first = r["chunks"][0]["part"] * chunk
                text = "".join([t[:chunk] for t in texts[:-1]] + texts[-1:])[r["start"] - first :]
                pieces, length = words.pieces(text), 0
                if r["end"] is not None:
                    ends = np.cumsum([len(p) for p in pieces])
                    length = int(np.searchsorted(ends, r["end"] - r["start"])) + 1
                    if ends[length - 1] != r["end"] - r["start"]:
                        raise AssertionError("a stitch is no boundary")
                done = _encoded([r["row"]], [pieces[: length or None]], words)
                named = [pa.array([r["row"]], pa.int64()), pa.array([r["doc_id"]], pa.int64()), pa.array([r["block"]], pa.int32())]
                yield pa.RecordBatch.from_arrays([*named, *done.columns[1:]], names=["row", "doc_id", "block", "n_tokens", "ids"])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ids = b"".join(b["ids"] for b in r["blocks"])
                columns = [pa.array([r["doc_id"]], pa.int64()), pa.array([len(ids) // 4], pa.int64()), pa.array([ids], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids"])

    chunks = materialize(docs.mapInArrow(cut, _CHUNKS).repartition("row", "part"), "bpe-chunks")
    found = materialize(chunks.select("row", "part", "n_chars", "text").mapInArrow(scan, _EDGES), "bpe-edges")
    before = found.select("row", (F.col("part") + 1).alias("part"), F.col("tail").alias("before"))
    meets = F.array_min(F.array_intersect("head", "before"))
    stitched = found.join(before, ["row", "part"], "left").select(
        "row", "part", F.when(F.col("part") == 0, F.lit(0).cast("long")).otherwise(meets).alias("meets")
    )
    # glued chunks belong to the last one before them that has a stitch; a row a chunk, of one text
    upto, after = Window.partitionBy("row").orderBy("part"), Window.partitionBy("row").orderBy("part").rowsBetween(1, Window.unboundedFollowing)
    stitched = stitched.select(
        "row",
        "part",
        F.max(F.when(F.col("meets").isNotNull(), F.col("part"))).over(upto).alias("block"),
        F.last("meets", ignorenulls=True).over(upto).alias("start"),
        F.first("meets", ignorenulls=True).over(after).alias("end"),
    )
    blocks = (
        chunks.join(stitched, ["row", "part"])
        .groupBy("row", "block")
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.first("start").alias("start"),
            F.first("end").alias("end"),
            F.sort_array(F.collect_list(F.struct("part", "text"))).alias("chunks"),
        )
        .mapInArrow(encode_blocks, "row long, doc_id long, block int, n_tokens long, ids binary")
    )
    texts = blocks.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.sort_array(F.collect_list(F.struct("block", "ids"))).alias("blocks")
    )
    return texts.mapInArrow(joined, SCHEMA)


def encode(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    ranks: str | None = None,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """``doc_id, n_tokens, ids`` (``ids`` little-endian unsigned 32-bit) of every row.

    ``ranks`` is the path of a rank file that every executor can read (the installed public one by default).
    """
    path = ranks or vocabulary_path(DEFAULT_RANKS)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = loaded(Coder, path)
        for batch in (some.slice(i, 500) for some in batches for i in range(0, some.num_rows, 500)):
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in slices(texts, SLICE):
                yield _encoded(ids[a:b], [words.pieces(t) for t in texts[a:b]], words)

    ship(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_of(F.col(f"`{text_col}`")).alias("text"))
    one = F.char_length("text") <= chunk
    return rows.filter(one).mapInArrow(whole, SCHEMA).unionByName(_long(rows.filter(~one), path, chunk, overlap))


def decode(tokens: DataFrame, ranks: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded`` of rows ``doc_id, ids``.

    ``decoded`` are the bytes; ``ids_sha256`` is that of the decimal ids, joined by commas.
    """
    path = ranks or vocabulary_path(DEFAULT_RANKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = loaded(Decoder, path)
        for batch in batches:
            keys, packed = batch.column(0).to_pylist(), batch.column(1)
            for i in range(0, len(keys), 256):
                ids = [np.frombuffer(x.as_py() or b"", "<u4") for x in packed[i : i + 256]]
                digests = [hashlib.sha256(",".join(map(str, x.tolist())).encode()).hexdigest() for x in ids]
                columns = [
                    pa.array(keys[i : i + 256], pa.int64()),
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array(digests, pa.string()),
                    pa.array([words.decode(x) for x in ids], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded"])

    ship(tokens.sparkSession)
    return tokens.select("doc_id", "ids").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded binary")
