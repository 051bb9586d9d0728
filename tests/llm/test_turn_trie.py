import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import types as T

from linefold.llm import queries, turn_trie

COLUMNS = [c.split()[0] for c in turn_trie.NODE.split(", ")]
SCHEMA = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()),
        *[T.StructField(n, T.StringType()) for n in ("ids", "path", "head", "h", "t", "seq", "key", "my.col")],
    ]
)


def brute(rows):
    """All nodes by dictionaries of prefixes."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    for conv, found in turns.items():
        turns[conv] = [t[2:] for t in sorted(found, key=lambda t: (t[0], t[1], _tie(*t[2:])))]
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        head = c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5))
        rebuilt[c] = tuple(turns.get(head, [])[:h]) + tuple(own[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c, path in rebuilt.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, of in members.items():
        mine = (len(of) - 1) * (len(node[-1][1].encode()) if node else 0)
        for d in range(len(node) + 1):
            saved[node[:d]] += mine
            leaves[node[:d]] += children[node] == 0
    return sorted(
        (
            min(of), len(node), min(members[node[:-1]]) if node else None, len(of), children[node], leaves[node], saved[node],
            hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest(),
        )
        for node, of in members.items()
    )


def _tie(role, text):
    return hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def nodes(df):
    assert df.columns == COLUMNS
    return sorted(tuple(r) for r in df.collect())


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


def shared_rows(seed, n, turns=6, texts=3):
    """Conversations that share many prefixes, a third of them all alike."""
    r = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(r.randint(0, turns) if c % 3 else 4):
            rows.append((c, t, "user" if t % 2 else None, f"t{r.randrange(texts) if c % 3 else 0}é"))
    return rows


def frame(spark, rows, path):
    spark.createDataFrame([(*r, *["x"] * 8) for r in rows], SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize(("seed", "cells", "paths"), [(1, 40, 4), (2, 7, 6), (3, 500_000, 20_000)])
def test_nodes_across_blocks_and_rounds(spark, scratch, seed, cells, paths):
    rows = shared_rows(seed, 120)
    got = nodes(turn_trie.trie(frame(spark, rows, scratch), cells=cells, paths=paths))
    assert order(got) == order(brute(rows))


def test_messy_conversations(spark, scratch):
    rows = [
        (0, 1, "user", "b"), (0, None, "system", None), (0, 0, None, "a"), (0, 0, None, "a"), (0, 0, "user", ""),
        (1, 0, None, "a"), (2, 5, "user", "ü" * 50_000), (3, None, None, None), (None, 0, "user", "lost"), (None, None, None, None),
        (-7, 1, "user", "minus"), (-5, 1, "user", "head"), (2**40, 0, "user", "far"), (10, 0, "a:b", "c"), (11, 0, "a", "b:c"),
        *[(4, t, "user", f"turn {t}") for t in range(700)], *[(9, t, "user", f"turn {t}") for t in range(700)],
    ]
    got = nodes(turn_trie.trie(frame(spark, rows, scratch), cells=300, paths=5))
    assert order(got) == order(brute(rows))


def test_no_conversations(spark, scratch):
    empty = turn_trie.trie(frame(spark, [], scratch))
    assert empty.columns == COLUMNS and empty.collect() == []


def test_rebuilt_without_turns_are_members_of_the_root(spark, scratch):
    c = next(c for c in range(1, 100) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 2)
    rows = [(c, 0, "user", "only")]
    assert nodes(turn_trie.trie(frame(spark, rows, scratch))) == brute(rows) == [
        (c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())
    ]


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert order(nodes(queries.op13_turn_trie(spark, sf))) == order(brute(rows))
