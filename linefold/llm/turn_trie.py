"""The trie of conversation prefixes, with totals of every node.

A node is a distinct sequence of first turns; its members are the conversations that
begin with it. A turn's id is a 128-bit hash of its role and text, so a conversation
becomes a short row of ids, and texts are read once and never shuffled. The rows are
sorted by their ids in ranges (a range may end inside a group of equal conversations), and
a task turns blocks of consecutive rows into matrices, a row a conversation, a column a
depth, padded with -1: lexsort orders them, the marks of changes against the row
before, OR-accumulated over the columns, begin the nodes of every depth, and reduceat
adds up their rows.

Only the nodes on the paths of a block's first and last row can go on in the blocks beside
it. A block gives these two paths with what it knows of their nodes; all its other nodes
are complete. Paths are recombined in the same way, as rows that weigh more than one
conversation, in as many rounds as it takes until one block holds them all: they are two
rows a block, whatever the block held.

A node's ends (conversations that stop there) are hashed in the block when it is complete.
Otherwise each block writes its piece of the list, and one sorted pass over all pieces hashes
every list as a stream, so that a node at which a third of all conversations end is held
by no task.

Defined results: turns are ordered by turn, null first, then by role and text as hashed;
a null role or text is empty, and repeated rows are repeated turns. Rows without a
conv_id belong to no conversation and are left out. An empty table has no conversation and
so no node, not even a root. Other columns are never looked at. A conversation's ids, 20 bytes
a turn, are one row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linefold.llm.common import materialize, ship, text_of

#: Every group of so many conversation numbers shares the first turns of its first one.
FAMILY = 5
#: The number of shared turns is below this.
HEADS = 9
#: Cells of a block's matrix (a longer conversation is alone), and paths that one block recombines.
CELLS, PATHS = 500_000, 20_000

#: What is summed for the nodes of a path: members, smallest member, and of what lies below and is complete the
#: children, leaves and saved bytes; then the bytes of the last text.
SUMS = ("n", "least", "children", "leaves", "saved", "size")
NODE = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string"
)
_PARTS = f"kind string, seq long, key binary, parent_key binary, {NODE}, path binary, piece string, " + ", ".join(
    f"{s} array<long>" for s in SUMS
)
_NAMES = [c.split()[0] for c in _PARTS.split(", ")]
_TYPES = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
_ARROW = pa.schema([(c.split()[0], _TYPES[c.split()[1]]) for c in _PARTS.split(", ")])
_FAR = np.iinfo(np.int64).max


def turns(rows: DataFrame) -> DataFrame:
    """``conv_id, ids, sizes``: ids (hexadecimal) and text bytes of the turns of every conversation, in order."""
    role, text = text_of(F.col("role")), text_of(F.col("text"))
    marked = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turn = F.struct(F.col("turn").cast("long").alias("turn"), F.md5(marked.cast("binary")).alias("id"), F.octet_length(text).alias("size"))
    grouped = (
        rows.select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
        .filter("conv_id IS NOT NULL")
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("t")).alias("t"))
    )
    return grouped.select("conv_id", F.col("t.id").alias("ids"), F.col("t.size").alias("sizes"))


def rebuilt(rows: DataFrame, family: int = FAMILY, heads: int = HEADS) -> DataFrame:
    """``conv_id, path, sizes``: each conversation with its first turns taken from the first one of its family.

    ``path`` holds the ids of the turns, 16 bytes each.
    """
    own = turns(rows)
    first = own.filter(F.col("conv_id") % family == 0).select(
        F.col("conv_id").alias("head"), *[F.slice(c, 1, heads - 1).alias(f"head_{c}") for c in ("ids", "sizes")]
    )
    shared = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    own = own.withColumn("head", F.col("conv_id") - F.col("conv_id") % family).withColumn("h", shared)

    def spliced(c: str) -> Column:
        none = F.array().cast("array<string>" if c == "ids" else "array<int>")
        rest = F.slice(c, F.col("h") + 1, F.greatest(F.size(c) - F.col("h"), F.lit(0)))
        return F.concat(F.slice(F.coalesce(f"head_{c}", none), F.lit(1), F.col("h")), rest)

    joined = own.join(first, "head", "left")
    path = F.unhex(F.array_join(spliced("ids"), ""))
    return joined.select("conv_id", path.alias("path"), spliced("sizes").alias("sizes"))


@dataclass
class Rows:
    """Rows of a block in order: paths, and for every row and depth (the root first) what ``SUMS`` lists."""

    paths: list[bytes]
    sums: dict[str, np.ndarray]
    conv: np.ndarray | None = None  # of rows that are conversations: their numbers


def key_of(path: bytes, depth: int) -> bytes:
    """The name of a node."""
    return hashlib.md5(path[: 16 * depth]).digest()


def _ids(paths: list[bytes], width: int) -> np.ndarray:
    """The padded matrix: a number for each id, in the order of the ids' bytes."""
    lengths = np.array([len(p) // 16 for p in paths], dtype=np.int64)
    halves = np.frombuffer(b"".join(paths), ">u8").reshape(-1, 2)
    order = np.lexsort((halves[:, 1], halves[:, 0]))
    new = np.any(halves[order][1:] != halves[order][:-1], axis=1)
    names = np.empty(len(halves), dtype=np.int32)
    if len(halves):
        names[order] = np.concatenate([[0], np.cumsum(new)])
    matrix = np.full((len(paths), width), -1, dtype=np.int32)
    row = np.repeat(np.arange(len(paths)), lengths)
    matrix[row, np.arange(len(halves)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = names
    return matrix


def block(rows: Rows, seq: int, whole: bool) -> list[dict]:
    """Nodes, open paths and pieces of ends of a block; with ``whole`` there is no other block, so all nodes are complete.

    ``seq`` and ``seq + 1`` are the places of its two paths in the order of all paths.
    """
    lengths = np.array([len(p) // 16 for p in rows.paths], dtype=np.int64)
    n, width = len(rows.paths), int(lengths.max())
    matrix = _ids(rows.paths, width)
    if rows.conv is not None:
        order = np.lexsort((rows.conv, *(matrix[:, d] for d in range(width - 1, -1, -1))))
        matrix, lengths = matrix[order], lengths[order]
        rows = Rows([rows.paths[i] for i in order], {k: v[order] for k, v in rows.sums.items()}, rows.conv[order])
    differs = np.logical_or.accumulate(matrix[1:] != matrix[:-1], axis=1)
    out: list[dict] = []
    # (sum, first path's or last path's, by depth) of the nodes that go on in other blocks
    open_nodes: list[dict[str, list[int]]] = [{s: [] for s in SUMS}, {s: [] for s in SUMS}]
    below: dict[str, np.ndarray] | None = None
    levels = []
    for d in range(width, -1, -1):
        new = np.concatenate([[True], differs[:, d - 1] if d else np.zeros(n - 1, bool)])
        starts = np.flatnonzero(new)
        there = lengths[starts] >= d
        sums = {}
        for s in SUMS:
            add = {"least": np.minimum, "size": np.maximum}.get(s, np.add)
            sums[s] = add.reduceat(rows.sums[s][:, d], starts)[there]
        is_open = np.zeros(len(starts), bool)
        if not whole:
            is_open[[0, -1]] = True
        nodes = {"start": starts[there], "end": np.append(starts[1:], n)[there], "open": is_open[there], **sums}
        if below is not None and len(below["start"]):
            # complete children are known whole; open ones are left to the paths
            done = ~below["open"]
            parent = np.searchsorted(nodes["start"], below["start"][done], side="right") - 1
            for s, values in (("children", np.ones(int(done.sum()), np.int64)), ("leaves", below["leaves"][done]), ("saved", below["saved"][done])):
                np.add.at(nodes[s], parent, values)
        close = ~nodes["open"]
        nodes["leaves"] += close & (nodes["children"] == 0)
        nodes["saved"] += close * (nodes["n"] - 1) * nodes["size"]
        levels.append((d, nodes))
        below = nodes
    levels.reverse()
    for d, nodes in levels:
        above = levels[d - 1][1] if d else None
        parents = np.searchsorted(above["start"], nodes["start"], side="right") - 1 if d else None
        for i in range(len(nodes["start"])):
            a, b = int(nodes["start"][i]), int(nodes["end"][i])
            path = rows.paths[a]
            ends = []
            if rows.conv is not None:
                stop = a + int(np.searchsorted(lengths[a:b] > d, True))  # shorter rows come first
                ends = rows.conv[a:stop].tolist()
            listed = ",".join(map(str, ends))
            if nodes["open"][i]:
                for side, holds in ((0, a == 0), (1, b == n and a > 0)):
                    if holds:
                        for s in SUMS:
                            open_nodes[side][s].append(int(nodes[s][i]))
                if listed:
                    out.append({"kind": "ends", "seq": seq, "key": key_of(path, d), "piece": listed})
                continue
            node = {
                "kind": "node", "seq": seq, "conv_id": int(nodes["least"][i]), "depth": d, "n_convs": int(nodes["n"][i]),
                "n_children": int(nodes["children"][i]), "n_leaves": int(nodes["leaves"][i]), "saved_tokens": int(nodes["saved"][i]),
            }
            if rows.conv is not None:
                node["ends_sha256"] = hashlib.sha256(listed.encode()).hexdigest()
            else:
                node["key"] = key_of(path, d)
            if d and above["open"][parents[i]]:
                node["parent_key"] = key_of(path, d - 1)
            elif d:
                node["parent_conv_id"] = int(above["least"][parents[i]])
            out.append(node)
    if not whole:
        first, last = rows.paths[0], rows.paths[-1]
        # nodes that both paths share are told once, with the first; the last has nothing to add to them
        common = len(last) // 16 + 1 - len(open_nodes[1]["n"])
        nothing = {"least": _FAR}
        out.append({"kind": "path", "seq": seq, "path": first, **{s: open_nodes[0][s] for s in SUMS}})
    if not whole and n > 1:
        out.append({"kind": "path", "seq": seq + 1, "path": last, **{s: [nothing.get(s, 0)] * common + open_nodes[1][s] for s in SUMS}})
    return out


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{k: r.get(k) for k in _NAMES} for r in rows], schema=_ARROW)


def _conversations(cells: int):
    """Blocks of sorted conversations."""

    def rows_of(held: list[tuple]) -> Rows:
        width = max(len(p) // 16 for p, _, _ in held)
        shape = (len(held), width + 1)
        conv, size, n = np.array([c for _, c, _ in held], dtype=np.int64), np.zeros(shape, np.int64), np.zeros(shape, np.int64)
        for i, (p, _, sizes) in enumerate(held):
            size[i, 1 : len(sizes) + 1] = sizes
            n[i, : len(p) // 16 + 1] = 1
        least, none = np.where(n > 0, conv[:, None], _FAR), np.zeros(shape, np.int64)
        return Rows([p for p, _, _ in held], {"n": n, "least": least, "children": none, "leaves": none, "saved": none, "size": size}, conv)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq, held, width = TaskContext.get().partitionId() << 33, [], 1
        for batch in batches:
            for path, conv, sizes in zip(*(batch.column(c) for c in ("path", "conv_id", "sizes"))):
                row = (path.as_py(), conv.as_py(), sizes.as_py())
                wider = max(width, len(row[0]) // 16 + 1)
                if held and wider * (len(held) + 1) > cells:
                    yield _batch(block(rows_of(held), seq, whole=False))
                    held, seq, wider = [], seq + 2, len(row[0]) // 16 + 1
                held.append(row)
                width = wider
        if held:
            yield _batch(block(rows_of(held), seq, whole=False))

    return run


def _paths(whole: bool, most: int):
    """Blocks of consecutive paths."""

    def rows_of(held: list[dict]) -> Rows:
        width = max(len(r["path"]) // 16 for r in held)
        sums = {s: np.full((len(held), width + 1), _FAR if s == "least" else 0, dtype=np.int64) for s in SUMS}
        for i, r in enumerate(held):
            for s in SUMS:
                sums[s][i, : len(r[s])] = r[s]
        return Rows([r["path"] for r in held], sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, seq = [], TaskContext.get().partitionId() << 33
        for batch in batches:
            held += batch.to_pylist()
            while not whole and len(held) > most:
                yield _batch(block(rows_of(held[:most]), seq, whole=False))
                held, seq = held[most:], seq + 2
        if held:
            yield _batch(block(rows_of(held), seq, whole))

    return run


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of the lists whose pieces come one after another."""
    key, digest = None, None
    for batch in batches:
        done = []
        for k, piece in zip(batch.column("key").to_pylist(), batch.column("piece").to_pylist()):
            if k != key:
                if key is not None:
                    done.append((key, digest.hexdigest()))
                key, digest = k, hashlib.sha256(piece.encode())
            else:
                digest.update(b"," + piece.encode())
        yield _digests(done)
    yield _digests([(key, digest.hexdigest())] if key is not None else [])


def _digests(rows: list[tuple[bytes, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string())], names=["key", "ends"])


def trie(rows: DataFrame, family: int = FAMILY, heads: int = HEADS, cells: int = CELLS, paths: int = PATHS) -> DataFrame:
    """One row per node: the columns of ``NODE``.

    ``rows`` has ``conv_id, turn, role, text``. ``cells`` bounds a block's matrix, ``paths`` the paths of one recombining block.
    """
    return nodes_of(materialize(rebuilt(rows, family, heads), "trie-paths"), cells, paths)


def nodes_of(conversations: DataFrame, cells: int = CELLS, paths: int = PATHS) -> DataFrame:
    """The nodes of written rows ``conv_id, path, sizes`` (see ``rebuilt``)."""
    ship(conversations.sparkSession)
    ordered = conversations.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    parts = materialize(ordered.select("path", "conv_id", "sizes").mapInArrow(_conversations(cells), _PARTS), "trie-blocks")
    found = [parts]
    columns = ["seq", "path", *SUMS]
    while (left := (open_paths := found[-1].filter("kind = 'path'").select(*columns)).count()) > paths:
        spread = open_paths.repartitionByRange(-(-left // paths), "seq").sortWithinPartitions("seq")
        found.append(materialize(spread.mapInArrow(_paths(False, paths), _PARTS), "trie-paths-round"))
    last = open_paths.coalesce(1).sortWithinPartitions("seq").mapInArrow(_paths(True, paths), _PARTS)
    found.append(materialize(last, "trie-last"))
    # nodes of paths: the blocks' nodes below them take their numbers, a few for each block
    on_paths = found[1].filter("kind = 'node'")
    for part in found[2:]:
        on_paths = on_paths.unionByName(part.filter("kind = 'node'"))
    numbers = on_paths.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_number"))
    pieces = parts.filter("kind = 'ends'").select("key", "seq", "piece")
    lists = pieces.repartition("key").sortWithinPartitions("key", "seq").mapInArrow(_hashes, "key binary, ends string")
    nothing = hashlib.sha256(b"").hexdigest()
    on_paths = on_paths.join(lists, "key", "left").withColumn("ends_sha256", F.coalesce("ends", F.lit(nothing)))
    wanted = [c.split()[0] for c in NODE.split(", ")]
    kept = [*wanted, "seq", "parent_key"]
    nodes = parts.filter("kind = 'node'").select(*kept).unionByName(on_paths.select(*kept))
    # by block, so that the children of one node are not one group
    asked = nodes.filter("parent_key IS NOT NULL").select("seq", "parent_key").distinct()
    answers = asked.join(numbers, "parent_key")
    parent = F.coalesce("parent_conv_id", "parent_number").alias("parent_conv_id")
    return nodes.join(answers, ["seq", "parent_key"], "left").select(*[parent if c == "parent_conv_id" else F.col(c) for c in wanted])
