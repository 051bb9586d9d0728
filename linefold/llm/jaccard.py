"""Self-join of documents by the Jaccard similarity of their shingle sets, with set relations.

Exact for any threshold (in percent): two sets link when ``100 * |x and y| >= percent * |x or y|``.

1. Equal sets become one class; the rest works on classes.
2. Inverted index. Under one order of all shingles (rare ones first), two linked sets share a shingle in their
   prefixes. Prefix postings ``(shingle, class, size, position)`` meet in buckets of shingles. An index list is sorted
   by size; its entries link to a hub, the first entry large enough, and are skipped by position where what follows
   in either set cannot reach the overlap.
3. The hubs' pairs are verified on the whole sets; links give components. A pair inside a component needs no look.
4. What is left are pairs of different components that meet in a list. A set's answers are derived from those of a
   highly similar one, its hub ``h``: ``|x and h| + |y and h| - |h| <= |x and y| <= min(|x and h|, |y and h|) +
   min(|x - h|, |y - h|)``. Pairs that neither this nor a bitmap of the sets decides stay open. They are not written
   out: a task keeps of each set its nearest partner, which is verified, and whether it has others.
5. Sets with several open partners meet with their texts. A task verifies there what is still in different components,
   and returns the links that join some: fewer than sets, however many pairs link.

The order of the shingles comes from a count sketch of fixed size over all documents. It only decides how long
lists get, never what is found. A frequent shingle's list is dealt over many buckets.

Defined results: null and empty texts, and texts without words, have an empty set and link with nothing. Ids may
be null or repeat; a component's id is its smallest one, nulls left aside. Other columns are never looked at.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import OrderedDict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linefold.llm.common import materialize, ship, text_of, tidied, with_row_id, without_rows
from linefold.llm.graph import components
from linefold.llm.shingles import mix, shingle_sets

PERCENT = 80
#: log2 of the counters of the sketch (4 MB at one byte each), and how many pieces they travel in.
SKETCH_BITS, SKETCH_PIECES = 22, 16
#: Postings in a bucket, and entries of a shingle that share a bucket.
BUCKET, LIST = 2_000_000, 50_000
#: Postings that a task holds before it deals them out.
HELD = 250_000
#: Bits that hint at the rows whose texts are wanted (1 MB).
HINT_BITS = 23
#: 64-bit words of the bitmap that bounds a difference of sets from below.
WORDS = 16
#: Shingles and sets that a task compares with as many others; larger groups are dealt over blocks of two parts.
GROUP_SHINGLES, GROUP_SETS = 2_000_000, 8192
#: Pairs that are looked at together.
PAIRS = 1 << 17
#: Stands for "no hub"; class keys are hashes and never this.
NO_HUB = -(2**63)


def _prefix(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _batch(names: str, **columns) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}
    parts = [p.split() for p in names.split(", ")]
    size = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays(
        [pa.array(columns.get(n, [None] * size), kinds[k]) for n, k in parts], names=[n for n, _ in parts]
    )


def _few(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The batches in smaller ones: the sets of a whole batch need not be in memory at once."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def _merged(pieces: DataFrame, dtype: str, combine: Callable) -> np.ndarray:
    """Arrays of one fixed length, cut in ``(piece, blob)`` by each task, combined piece by piece; small by construction."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for piece, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                x = np.frombuffer(zlib.decompress(blob), dtype)
                total[piece] = x if piece not in total else combine(total[piece], x)
        if total:
            yield _batch("piece int, blob binary", piece=list(total), blob=[zlib.compress(v.tobytes(), 1) for v in total.values()])

    rows = pieces.repartition(SKETCH_PIECES, "piece").mapInArrow(run, "piece int, blob binary").collect()
    return np.concatenate([np.frombuffer(zlib.decompress(r["blob"]), dtype) for r in sorted(rows, key=lambda r: r["piece"])]) if rows else np.zeros(0, dtype)


def _cut(array: np.ndarray) -> dict:
    return {"piece": list(range(SKETCH_PIECES)), "blob": [zlib.compress(x.tobytes(), 1) for x in np.split(array, SKETCH_PIECES)]}


def _counted(total: np.ndarray, more: np.ndarray) -> np.ndarray:
    return np.minimum(total.astype(np.uint64) + more, 2**32 - 1).astype(np.uint32)


def _digest(shingles: np.ndarray, seed: int) -> tuple[int, int]:
    d = hashlib.blake2b(shingles.tobytes(), digest_size=16, salt=seed.to_bytes(8, "little")).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def _sets(rows: DataFrame, seed: int) -> DataFrame:
    """Per row its class ``key`` (with ``tag``, the rest of the digest), set size and bitmap; and the tasks' shingle counts."""
    schema = "rid long, key long, tag long, n long, bitmap binary, piece int, blob binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, np.uint32)
        seen: set[tuple[int, int]] = set()
        for batch in _few(batches):
            rids, sets = batch.column(0), shingle_sets(batch.column(1).to_pylist())
            ids = [_digest(s, seed) for s in sets]
            fresh = [s for s, d in zip(sets, ids) if not (d in seen or seen.add(d))]
            if fresh:
                np.add.at(counts, np.concatenate(fresh) >> np.uint64(64 - SKETCH_BITS), np.uint32(1))
            maps = []
            for s in sets:
                odd = np.bincount(s & np.uint64(WORDS * 64 - 1), minlength=WORDS * 64) & 1
                maps.append(np.packbits(odd.astype(np.uint8)).tobytes())
            yield _batch(schema, rid=rids.to_pylist(), key=[k for k, _ in ids], tag=[t for _, t in ids], n=[len(s) for s in sets], bitmap=maps)
        if seen:
            yield _batch(schema, **_cut(counts))

    return materialize(rows.select("_rid", "_text").mapInArrow(tidied(run), schema), "sets")


def _classes(rows: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """The sets of all rows, a row per class, and the seed under which no two classes share a key."""
    for seed in range(16):
        sets = _sets(rows, seed)
        of_class = sets.filter("n > 0").groupBy("key").agg(
            F.min("rid").alias("rid"), F.first("n").alias("n"), F.first("bitmap").alias("bitmap"),
            F.min("tag").alias("lo"), F.max("tag").alias("hi"),
        )
        of_class = materialize(of_class, "classes")
        if of_class.filter("lo != hi").isEmpty():
            return sets, of_class.drop("lo", "hi"), seed
    raise RuntimeError("no seed keeps the classes apart")


_INDEX = "a long, b long, token long, key long, n long, pos long"


def _index(rows: DataFrame, classes: DataFrame, sketch: np.ndarray, seed: int, percent: int) -> DataFrame:
    """Lists of the inverted index: pairs ``(a, b)`` of an entry and its hub, and the entries of lists that matter."""
    spark = rows.sparkSession
    postings = classes.agg(F.sum(F.col("n") - F.ceil(F.col("n") * percent / 100) + 1)).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-postings // BUCKET))
    # half powers of two: nearly equal counts share a class, so that the order within it is random
    rank = spark.sparkContext.broadcast(np.round(2 * np.log2(1.0 + sketch)).astype(np.uint8))
    kinds = np.dtype([("token", "<u8"), ("key", "<i8"), ("n", "<u4"), ("pos", "<u4")])
    crowded = int(2 * np.log2(1 + LIST))  # rank from which a shingle's list is dealt over several buckets

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, seen, held, size = rank.value, set(), [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            rec = np.concatenate(held)
            top = order[rec["token"] >> np.uint64(64 - SKETCH_BITS)].astype(np.int64)
            lists = np.where(top >= crowded, np.ceil(2.0 ** (top / 2) / LIST), 1).astype(np.uint64)
            with np.errstate(over="ignore"):
                salt = rec["key"].astype(np.uint64) % lists
                where = (mix(rec["token"] + salt * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(buckets)).astype(np.int64)
            by = np.argsort(where, kind="stable")
            rec, where = rec[by], where[by]
            cuts = np.flatnonzero(np.diff(where, prepend=-1))
            blobs = [part.tobytes() for part in np.split(rec, cuts[1:])]
            yield _batch("bucket int, blob binary", bucket=where[cuts].tolist(), blob=blobs)

        for batch in _few(batches):
            for s in shingle_sets(batch.column(0).to_pylist()):
                if not len(s):
                    continue
                key, _ = _digest(s, seed)
                if key in seen:
                    continue
                seen.add(key)
                by_rank = (order[s >> np.uint64(64 - SKETCH_BITS)].astype(np.uint64) << np.uint64(56)) | (s >> np.uint64(8))
                p = _prefix(len(s), percent)
                first = np.argsort(by_rank, kind="stable")[:p]  # equal ranks: by the shingle itself, as s is sorted
                rec = np.empty(p, kinds)
                rec["token"], rec["key"], rec["n"], rec["pos"] = s[first], key, len(s), np.arange(p)
                held.append(rec)
                size += p
                if size > HELD:
                    yield from flush()
                    held, size = [], 0
        if held:
            yield from flush()

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = rank.value
        for rec in _by_bucket(batches, kinds):
            rec = rec[np.lexsort((rec["key"], rec["n"], rec["token"]))]
            new = np.concatenate([[True], (rec["token"][1:] != rec["token"][:-1]) | (rec["key"][1:] != rec["key"][:-1])])
            rec = rec[new]  # copies of a class from several tasks
            token, n, pos = rec["token"], rec["n"].astype(np.int64), rec["pos"].astype(np.int64)
            same = np.concatenate([[False], token[1:] == token[:-1]])
            near = same & (100 * np.concatenate([[0], n[:-1]]) >= percent * n)  # the entry before is large enough
            dealt = order[token >> np.uint64(64 - SKETCH_BITS)] >= crowded
            # a list of two matters only if its two can link by position, too
            first, last = ~same, np.concatenate([~same[1:], [True]])
            two = np.flatnonzero(first[:-1] & ~last[:-1] & last[1:])
            least = np.minimum(n[two] - pos[two], n[two + 1] - pos[two + 1])
            near[two + 1] &= least * (100 + percent) >= percent * (n[two] + n[two + 1])
            keep = near | np.concatenate([near[1:], [False]]) | dealt
            rec, token, n, pos = rec[keep], token[keep], n[keep], pos[keep]
            if not len(rec):
                continue
            number = np.cumsum(np.concatenate([[0], token[1:] != token[:-1]])).astype(np.int64)
            size = number << 32 | n
            hub = np.searchsorted(size, number << 32 | -(-percent * n // 100))
            rest = np.minimum(n - pos, n[hub] - pos[hub])
            ok = (hub != np.arange(len(rec))) & (rest * (100 + percent) >= percent * (n + n[hub]))
            pairs = np.unique(np.stack([rec["key"][ok], rec["key"][hub[ok]]], 1), axis=0)
            yield _batch(_INDEX, a=pairs[:, 0], b=pairs[:, 1])
            yield _batch(_INDEX, token=token.astype(np.int64), key=rec["key"], n=n, pos=pos)

    dealt = rows.select("_text").mapInArrow(tidied(deal), "bucket int, blob binary")
    # as many partitions as the session has, buckets of a partition one after another
    dealt = dealt.repartition("bucket").sortWithinPartitions("bucket")
    return materialize(dealt.mapInArrow(tidied(lists), _INDEX), "index")


def _by_bucket(batches: Iterator[pa.RecordBatch], kinds: np.dtype) -> Iterator[np.ndarray]:
    """All postings of a bucket, bucket after bucket."""
    current, held = None, []
    for batch in batches:
        for bucket, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
            if bucket != current and held:
                yield np.concatenate(held)
                held = []
            current = bucket
            held.append(np.frombuffer(blob.as_buffer(), kinds))
    if held:
        yield np.concatenate(held)


def _hinted(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The ``rows`` whose number, their first column, is among ``wanted(number)``, and few others.

    A bitmap of fixed size is all that travels: most unwanted texts stay out of the shuffle of the join that follows.
    """
    spark = rows.sparkSession

    def hashed(numbers: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return np.stack([mix(numbers.astype(np.uint64) * np.uint64(4) + np.uint64(k)) >> np.uint64(64 - HINT_BITS) for k in range(4)])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << HINT_BITS, bool)
        for batch in batches:
            bits[hashed(batch.column(0).to_numpy())] = True
        yield _batch("piece int, blob binary", **_cut(np.packbits(bits)))

    hint = spark.sparkContext.broadcast(_merged(wanted.mapInArrow(mark, "piece int, blob binary"), "u1", np.bitwise_or))

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(hint.value).astype(bool)
        for batch in batches:
            if len(bits):
                yield batch.filter(pa.array(bits[hashed(batch.column(0).to_numpy())].all(axis=0)))

    return rows.mapInArrow(tidied(some), rows.schema)


def _texts(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(key, text)`` of the wanted ``(key, rid)``."""
    likely = _hinted(rows.select(F.col("_rid").alias("rid"), "_text"), wanted.select("rid"))
    return materialize(likely.join(wanted, "rid").select("key", F.col("_text").alias("text")), "texts")


def _verified(pairs: DataFrame, texts: DataFrame, name: str) -> DataFrame:
    """``pairs`` ``(a, b)`` with their sets' sizes and overlap ``(na, nb, both)``."""
    schema = "a long, b long, na long, nb long, both long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: OrderedDict[int, np.ndarray] = OrderedDict()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                a, b, ta, tb = (part.column(i).to_pylist() for i in range(4))
                new = {k: t for k, t in [*zip(a, ta), *zip(b, tb)] if k not in known}
                known.update(zip(new, shingle_sets(list(new.values()))))
                sets = [(known[x], known[y]) for x, y in zip(a, b)]
                both = [len(np.intersect1d(x, y, assume_unique=True)) for x, y in sets]
                yield _batch(schema, a=a, b=b, na=[len(x) for x, _ in sets], nb=[len(y) for _, y in sets], both=both)
                while len(known) > 1024:
                    known.popitem(last=False)

    first = texts.select(F.col("key").alias("a"), F.col("text").alias("ta"))
    second = texts.select(F.col("key").alias("b"), F.col("text").alias("tb"))
    joined = pairs.select("a", "b").join(first, "a").join(second, "b").select("a", "b", "ta", "tb")
    return materialize(joined.mapInArrow(tidied(run), schema), name)


def _linked(percent: int) -> Column:
    return F.col("both") * 100 >= (F.col("na") + F.col("nb") - F.col("both")) * percent


def _labels(keys: DataFrame, links: DataFrame) -> DataFrame:
    """``(key, label)`` for all ``keys``: component by the links so far."""
    found = components(links).withColumnRenamed("label", "found")
    return materialize(keys.join(found, "key", "left").select("key", F.coalesce("found", "key").alias("label")), "labels")


_MEET = "anchor long, token long, key long, n long, rest long, label long, hub long, shared long, nhub long, bitmap binary"


def _meetings(index: DataFrame, labels: DataFrame, hubs: DataFrame, classes: DataFrame) -> DataFrame:
    """Entries of the lists that hold several components, and each class's bitmap, side by side under the list's anchor.

    The anchor of a list is its smallest component: lists of the same texts come together, so a class's bitmap travels
    to few places and a pair that meets in many lists is decided once.
    """
    best = hubs.groupBy(F.col("a").alias("key")).agg(F.max(F.struct("both", "b", "nb")).alias("h"))
    state = labels.join(best, "key", "left").select("key", "label", F.col("h.b").alias("hub"), F.col("h.both").alias("shared"), F.col("h.nb").alias("nhub"))
    entries = index.filter("token IS NOT NULL").select("token", "key", "n", (F.col("n") - F.col("pos")).alias("rest"))
    entries = entries.join(state, "key")
    mixed = entries.groupBy("token").agg(F.min("label").alias("anchor"), F.max("label").alias("l")).filter("anchor != l").drop("l")
    rows = materialize(entries.join(mixed, "token"), "meetings")
    maps = rows.select("anchor", "key").distinct().join(classes.select("key", "bitmap"), "key")
    empty = {f.split()[0]: F.lit(None).cast(f.split()[1]).alias(f.split()[0]) for f in _MEET.split(", ")}
    names = list(empty)
    maps = maps.select(*[F.col(c) if c in ("anchor", "key", "bitmap") else empty[c] for c in names])
    rows = rows.withColumn("bitmap", empty["bitmap"]).select(*names)
    # bitmaps (no token) first, then list after list
    return rows.unionByName(maps).repartition("anchor").sortWithinPartitions("anchor", F.asc_nulls_first("token"), F.desc("rest"))


_OPEN = "a long, b long, n long, anchor long, more int"


def _undecided(meetings: DataFrame, percent: int) -> DataFrame:
    """``(a, b, n, anchor, more)``: classes with pairs of different components that size, position, hubs and bitmaps do not decide.

    ``b`` is the partner in the anchor's lists whose bitmap is nearest to the one of ``a`` (of size ``n``), and ``more``
    tells that ``a`` has others there. Without an anchor: a link that the hub's answers prove and that joins components.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for entries, keys, maps in _by_anchor(batches):
            held.append(_AnchorPairs(entries, keys, maps, percent).rows())
            size += held[-1].shape[1]
            if size > 10_000:
                yield _open_rows(held)
                held, size = [], 0
        if held:
            yield _open_rows(held)

    return meetings.mapInArrow(tidied(run), _OPEN)


def _open_rows(held: list[np.ndarray]) -> pa.RecordBatch:
    a, b, n, anchor, more = np.concatenate(held, axis=1)
    none = more < 0
    columns = [pa.array(a), pa.array(b), pa.array(n), pa.array(anchor, mask=none), pa.array(more, pa.int32(), mask=none)]
    return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _OPEN.split(", ")])


class _AnchorPairs:
    """The pairs of classes that meet in the lists of an anchor. ``entries``: rows as in ``_MEET``, list after list."""

    def __init__(self, entries: np.ndarray, keys: np.ndarray, maps: np.ndarray, percent: int):
        by = np.argsort(keys)
        self.keys, self.maps, self.percent = keys[by], maps[by], percent
        self.anchor, self.token, key, n, self.rest, label, hub, shared, nhub = entries
        self.at = np.searchsorted(self.keys, key)
        state = np.zeros((5, len(keys)), np.int64)
        state[:, self.at] = n, label, hub, shared, nhub  # the same in all entries of a class
        self.n, label, self.hub, self.shared, self.nhub = state
        self.own = np.unique(label, return_inverse=True)[1]
        self.parent = np.arange(len(keys))
        self.comp = self.own
        self.nearest = np.full(len(keys), np.iinfo(np.int64).max)
        self.least, self.most = np.full(len(keys), len(keys)), np.full(len(keys), -1)
        self.links: list[tuple[int, int]] = []

    def rows(self) -> np.ndarray:
        """Columns as in ``_OPEN``; ``more`` is -1 where there is no anchor."""
        m = len(self.keys)
        new = np.concatenate([[True], self.token[1:] != self.token[:-1]])
        if new.sum() * m * m <= PAIRS:
            rest = np.zeros((new.sum(), m), np.int64)
            rest[np.cumsum(new) - 1, self.at] = self.rest
            both = np.minimum(rest[:, :, None], rest[:, None, :]).max(axis=0)
            meet = both * (100 + self.percent) >= self.percent * (self.n[:, None] + self.n[None, :])
            self._decide(*np.nonzero(np.triu(meet & (both > 0), 1)))
        else:
            seen = np.zeros((m, m), bool) if m <= 4096 else None
            cuts = [*np.flatnonzero(new).tolist(), len(new)]
            for a, b in zip(cuts, cuts[1:]):
                self._list(self.at[a:b], self.rest[a:b], seen)
        found = np.flatnonzero(self.most >= 0)
        proven = np.array(self.links, np.int64).reshape(-1, 2).T
        out = np.zeros((5, len(found) + proven.shape[1]), np.int64)
        out[:3, : len(found)] = self.keys[found], self.keys[self.nearest[found] & 0xFFFFFFFF], self.n[found]
        out[3, : len(found)], out[4, : len(found)] = self.anchor[0], self.least[found] != self.most[found]
        out[:2, len(found) :], out[4, len(found) :] = self.keys[proven], -1
        return out

    def _list(self, at: np.ndarray, rest: np.ndarray, seen: np.ndarray | None) -> None:
        """The pairs of a list, whose entries come by descending ``rest`` (what follows the shingle in the set)."""
        n, percent = self.n[at], self.percent
        step = max(1, min(128, PAIRS // len(at)))
        for i in range(0, len(at), step):
            a = slice(i, min(i + step, len(at)))
            # blocks by position: entries after the last one that can reach the overlap with this block are skipped
            can = np.flatnonzero(rest * (100 + percent) >= percent * (n + int(n[a].min())))
            b = slice(i, max(i, int(can[-1]) + 1 if len(can) else i))
            ok = self.comp[at[a], None] != self.comp[None, at[b]]
            ok &= np.minimum(rest[a, None], rest[None, b]) * (100 + percent) >= percent * (n[a, None] + n[None, b])
            x, y = np.nonzero(ok)
            x, y = at[x + i], at[y + i]
            x, y = np.minimum(x, y), np.maximum(x, y)
            if seen is not None:
                fresh = ~seen[x, y]
                x, y = x[fresh], y[fresh]
                seen[x, y] = True
            self._decide(x, y)

    def _decide(self, x: np.ndarray, y: np.ndarray) -> None:
        n, percent, hub, shared = self.n, self.percent, self.hub, self.shared
        ok = (self.comp[x] != self.comp[y]) & (100 * n[x] >= percent * n[y]) & (100 * n[y] >= percent * n[x])
        x, y = x[ok], y[ok]
        need = percent * (n[x] + n[y])  # to be reached by the overlap times (100 + percent)
        # the hub's answers, where both have the same hub (or one is the other's)
        same = (hub[x] == hub[y]) & (hub[x] != NO_HUB)
        upper = np.minimum(shared[x], shared[y]) + np.minimum(n[x] - shared[x], n[y] - shared[y])
        lower = shared[x] + shared[y] - self.nhub[x]
        proven = same & (lower * (100 + percent) >= need)
        self._join(x[proven], y[proven])
        open_ = (~same | (upper * (100 + percent) >= need)) & (self.comp[x] != self.comp[y])
        x, y = x[open_], y[open_]
        apart = np.bitwise_count(self.maps[x] ^ self.maps[y]).sum(axis=1, dtype=np.int64)
        near = (n[x] + n[y] - apart) * (100 + percent) >= 2 * percent * (n[x] + n[y])
        x, y, apart = x[near], y[near], apart[near]
        gap = apart * 1_000_000 // (n[x] + n[y])
        for one, other in ((x, y), (y, x)):
            np.minimum.at(self.nearest, one, gap << 32 | other)
            np.minimum.at(self.least, one, other)
            np.maximum.at(self.most, one, other)

    def _join(self, x: np.ndarray, y: np.ndarray) -> None:
        parent = self.parent

        def root(c: int) -> int:
            while parent[c] != c:
                c = parent[c]
            return int(c)

        before = len(self.links)
        for a, b in zip(x.tolist(), y.tolist()):
            ra, rb = root(self.own[a]), root(self.own[b])
            if ra != rb:
                parent[max(ra, rb)] = min(ra, rb)
                self.links.append((a, b))
        if len(self.links) > before:
            while (parent[parent] != parent).any():
                parent[:] = parent[parent]
            self.comp = parent[self.own]


def _by_anchor(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The entries of an anchor (a row for each column of ``_MEET``), its keys and their bitmaps, anchor after anchor."""
    now, held = None, []

    def whole() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        entries, keys, maps = zip(*held)
        return np.concatenate(entries, axis=1), np.concatenate(keys), np.concatenate(maps)

    for batch in batches:
        if not batch.num_rows:
            continue
        names = [c for c in batch.schema.names if c != "bitmap"]
        none = {c: NO_HUB if c == "hub" else 0 for c in names}
        columns = np.stack([batch.column(c).fill_null(none[c]).to_numpy() for c in names])
        blobs = batch.column("bitmap")
        maps = np.frombuffer(b"".join(blobs.drop_null().to_pylist()), np.uint64).reshape(-1, WORDS)
        upto = np.concatenate([[0], np.cumsum(blobs.is_valid().to_numpy(zero_copy_only=False))])
        cuts = [0, *(np.flatnonzero(np.diff(columns[0])) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if held and columns[0, a] != now:
                yield whole()
                held = []
            now = columns[0, a]
            i, j = int(upto[a]), int(upto[b])  # an anchor's bitmaps come before its lists
            held.append((columns[:, a + j - i : b], columns[2, a : a + j - i], maps[i:j]))
    if held:
        yield whole()


def _joining(groups: DataFrame, labels: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Links ``(a, b)`` between the classes ``(anchor, key, n)`` of an anchor that join components of ``labels``.

    A group too large for a task is dealt into parts, and every two parts meet in a block.
    """
    rows = groups.join(labels, "key")
    parts = F.greatest(F.ceil(F.sum("n") / GROUP_SHINGLES), F.ceil(F.count("key") / GROUP_SETS)).cast("int")
    mixed = rows.groupBy("anchor").agg(F.min("label").alias("l"), F.max("label").alias("m"), parts.alias("parts")).filter("l != m")
    rows = rows.join(mixed.select("anchor", "parts"), "anchor")
    rows = rows.withColumn("part", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.select("anchor", F.least("part", "other").alias("x"), F.greatest("part", "other").alias("y"), "part", "key", "label")
    rows = materialize(rows, "groups").join(texts, "key").select("anchor", "x", "y", "part", "key", "label", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, found = None, [], []
        for batch in _few(batches):
            *place, parts, keys, labels = (batch.column(i).to_pylist() for i in range(6))
            for at, *row in zip(zip(*place), parts, keys, labels, shingle_sets(batch.column(6).to_pylist())):
                if at != now and held:
                    found += _group_links(held, now[1] == now[2], percent)
                    held = []
                now = at
                held.append(row)
            if len(found) > 10_000:
                yield _batch("a long, b long", a=[a for a, _ in found], b=[b for _, b in found])
                found = []
        if held:
            found += _group_links(held, now[1] == now[2], percent)
        yield _batch("a long, b long", a=[a for a, _ in found], b=[b for _, b in found])

    rows = rows.repartition("anchor", "x", "y").sortWithinPartitions("anchor", "x", "y")
    return materialize(rows.mapInArrow(tidied(run), "a long, b long"), "joining")


def _group_links(rows: list[list], one: bool, percent: int) -> list[tuple[int, int]]:
    """Links that join components among ``rows`` (part, key, label, set); but for ``one`` part, between two parts only."""
    parts, keys, labels, sets = zip(*rows)
    part, n = np.array(parts), np.array([len(s) for s in sets])
    comp = np.unique(np.array(labels), return_inverse=True)[1]
    # bitmaps as above, with more bits where the sets are large
    bits = max(WORDS * 64, min(1 << int(2 * n.max()).bit_length(), 1 << 16, 1 << 28 - len(rows).bit_length()))
    maps = np.zeros((len(rows), bits // 8), np.uint8)
    for i, s in enumerate(sets):
        maps[i] = np.packbits((np.bincount(s & np.uint64(bits - 1), minlength=bits) & 1).astype(np.uint8))
    maps = maps.view(np.uint64)
    step = max(1, (1 << 18) // maps.shape[1])
    found: list[tuple[int, int]] = []
    for x in range(len(rows)):
        if (comp == comp[0]).all():
            break
        for i in range(x + 1, len(rows), step):
            b = slice(i, i + step)
            ok = (comp[b] != comp[x]) & (100 * n[b] >= percent * n[x]) & (percent * n[b] <= 100 * n[x])
            y = np.flatnonzero(ok if one else ok & (part[b] != part[x])) + i
            apart = np.bitwise_count(maps[y] ^ maps[x]).sum(axis=1, dtype=np.int64)
            y = y[(n[y] + n[x] - apart) * (100 + percent) >= 2 * percent * (n[y] + n[x])]
            while len(y):
                some = y[: max(1, int(np.searchsorted(np.cumsum(n[y]), 1_000_000)))]
                every = np.concatenate([sets[k] for k in some.tolist()])
                place = np.minimum(np.searchsorted(sets[x], every), n[x] - 1)
                both = np.add.reduceat((sets[x][place] == every).astype(np.int64), np.cumsum(n[some]) - n[some])
                linked = some[100 * both >= percent * (n[x] + n[some] - both)]
                others, first = np.unique(comp[linked], return_index=True)
                found += [(keys[x], keys[k]) for k in linked[first].tolist()]
                comp[np.isin(comp, others)] = comp[x]
                y = y[len(some) :]
                y = y[comp[y] != comp[x]]
    return found


def links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """The sets of all rows ``(rid, key, n)`` (key: class), and links ``(a, b)`` between classes that span the components."""
    spark = docs.sparkSession
    ship(spark)
    rows = with_row_id(docs.select(F.col(id_col).alias("_id"), text_of(F.col(text_col)).alias("_text")))
    sets, classes, seed = _classes(rows)
    sketch = _merged(sets.filter("piece IS NOT NULL").select("piece", "blob"), "u4", _counted)
    per_row = sets.filter("rid IS NOT NULL").select("rid", "key", "n")
    if not len(sketch):
        return per_row, spark.createDataFrame([], "a long, b long")
    index = _index(rows, classes, sketch, seed, percent)
    pairs = index.filter("a IS NOT NULL").select("a", "b").distinct()
    entries = index.filter("token IS NOT NULL").select("key").distinct()
    texts = _texts(rows, classes.join(entries, "key").select("key", "rid"))

    def only(verified: DataFrame) -> DataFrame:
        return verified.filter(_linked(percent)).select("a", "b")

    hubs = _verified(pairs, texts, "hubs")
    found = only(hubs)
    labels = _labels(entries, found)
    open_ = materialize(_undecided(_meetings(index, labels, hubs, classes), percent), "undecided")
    found = found.unionByName(open_.filter("anchor IS NULL").select("a", "b"))
    # a pair of each class first: in a large group of near copies they join its components
    first = open_.filter("anchor IS NOT NULL").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    first = materialize(first, "first-pairs")
    theirs = materialize(_hinted(texts, first.select(F.explode(F.array("a", "b")).alias("key"))), "first-texts")
    found = found.unionByName(only(_verified(first, theirs, "first")))
    groups = open_.filter("more = 1").select("anchor", F.col("a").alias("key"), "n")
    found = found.unionByName(_joining(groups, _labels(entries, found), texts, percent))
    return per_row, materialize(found, "found")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """``(_rid, _id, n_shingles, component_id, kept)``: one row per row of ``docs``.

    ``kept`` marks one row of each component: the one with the smallest id (a null id last), then the first read.
    """
    per_row, found = links(docs, id_col, text_col, percent)
    ids = with_row_id(docs.select(F.col(id_col).alias("_id"))).select("_rid", "_id")
    rows = ids.join(per_row, F.col("_rid") == F.col("rid")).drop("rid")
    label = components(found).withColumnRenamed("label", "found")
    # a row without shingles is a component of its own
    own = F.struct(F.lit(0).cast("long").alias("label"), F.col("_rid").alias("alone"))
    shared = F.struct(F.coalesce("found", "key").alias("label"), F.lit(-1).cast("long").alias("alone"))
    rows = rows.join(label, "key", "left").withColumn("c", F.when(F.col("n") > 0, shared).otherwise(own))
    rows = materialize(rows.select("_rid", "_id", "n", "c.label", "c.alone"), "members")
    first = F.min(F.struct(F.col("_id").isNull().alias("null"), "_id", "_rid")).alias("first")
    groups = materialize(rows.groupBy("label", "alone").agg(first), "groups")
    return rows.join(groups, ["label", "alone"]).select(
        "_rid", "_id", F.col("n").alias("n_shingles"), F.col("first._id").alias("component_id"),
        (F.col("_rid") == F.col("first._rid")).alias("kept"),
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each component; same columns."""
    dropped = materialize(near_groups(docs, id_col, text_col, percent).filter(~F.col("kept")).select("_rid"), "dropped")
    return without_rows(docs, dropped)
