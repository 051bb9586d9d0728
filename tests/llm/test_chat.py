import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from linefold.llm import chat, queries

SCHEMA = "conv_id long, turn long, role string, text string, conv string, part string, line string, tie long"


def model(seed=1):
    rng = np.random.default_rng(seed)
    n = len(chat.STATES)
    m = chat.Model(*(chat._normal(rng.random(s) + 0.01) for s in ((n,), (n, n), (n, chat.N_MARKERS), (n, chat.N_SHAPES))))
    return m


def score(m, emission, path):
    s = m.start[path[0]] + emission[0, path[0]]
    for i in range(1, len(path)):
        s += m.step[path[i - 1], path[i]] + emission[i, path[i]]
    return s


def test_viterbi_finds_the_best_path():
    import itertools

    m, rng = model(), np.random.default_rng(2)
    e = m.emission(rng.integers(0, chat.N_MARKERS, 5), rng.integers(0, chat.N_SHAPES, 5))
    best = max(itertools.product(range(len(chat.STATES)), repeat=5), key=lambda p: score(m, e, p))
    assert m.decode(e) == list(best)


def rows_of(n_conv, turns, seed=0):
    rng = random.Random(seed)
    rows = []
    for c in range(n_conv):
        for t in range(turns):
            role = "user" if t % 2 == 0 else "assistant"
            lines = [rng.choice(["why is it so?", "because of that and more words here", "x", "Bob: hi"]) for _ in range(rng.randint(1, 4))]
            marker = "User: " if role == "user" else "AI: "
            rows.append((c, t, role, (marker if rng.random() < 0.7 else "") + "\n".join(lines), *["noise"] * 3, 1))
    return rows


def scores(m, lines, block):
    """Score of the path found for each conversation (equal lines allow several best paths)."""
    seen = lines.select("conv", "turn", "tie", "at", "line", "marker", "shape").collect()
    found = {}
    for r in chat.recover(lines, m, block=block).collect():
        found.setdefault((r["conv"], r["turn"], r["at"], r["line"]), []).append(chat.STATES.index((r["role"], r["begins"])))
    out = {}
    for r in sorted(seen):
        out.setdefault(r["conv"], []).append((r["marker"], r["shape"], found[r["conv"], r["turn"], r["at"], r["line"]].pop()))
    assert not any(found.values())
    return {c: score(m, m.emission(*(np.array(x) for x in list(zip(*p))[:2])), [x[2] for x in p]) for c, p in out.items()}


@pytest.mark.parametrize("block", [2, 7])
def test_blocks_decode_as_the_whole(spark, block, tmp_root):
    spark.createDataFrame(rows_of(4, 60), SCHEMA).coalesce(2).write.parquet(f"{tmp_root}/chat{block}")
    lines = chat.lines_of(spark.read.parquet(f"{tmp_root}/chat{block}"), "conv_id", "turn", "text")
    m = model(3)
    assert scores(m, lines, block) == pytest.approx(scores(m, lines, 4096))


def test_a_crowded_turn_is_cut(spark, tmp_root):
    rows = [(1, 5, "user", f"line {i}", *["noise"] * 3, 1) for i in range(300)]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{tmp_root}/crowded")
    lines = chat.lines_of(spark.read.parquet(f"{tmp_root}/crowded"), "conv_id", "turn", "text")
    m = model(4)
    assert scores(m, lines, 10) == pytest.approx(scores(m, lines, 4096))


def test_roles_of_unseen_conversations(spark):
    sf = "/root/testdata/sf0.01"
    truth = {(r["conv_id"], r["turn"]): r["role"] for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()}
    got = queries.op7_chat_roles(spark, sf).withColumn("held", F.crc32(F.col("conv_id").cast("string").cast("binary")) % 3 == 1).collect()
    held = [r for r in got if r["held"]]
    assert len({(r["conv_id"], r["turn"]) for r in got}) == len(truth)
    assert sum(r["role"] == truth[r["conv_id"], r["turn"]] for r in held) / len(held) > 0.85
    assert all(r["rendered"].startswith(f"<|{r['role']}|>\n") for r in got if r["begins"])


def test_nulls_repeats_and_empty_tables(spark, tmp_root):
    rows = [(None, 0, "user", "a", *["n"] * 3, 1), (None, 0, "user", None, *["n"] * 3, 1), (1, None, None, "", *["n"] * 3, 1), (1, 2, "tool", "b\n\nc", *["n"] * 3, 1), (1, 2, "tool", "b\n\nc", *["n"] * 3, 1)]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{tmp_root}/odd")
    lines = chat.lines_of(spark.read.parquet(f"{tmp_root}/odd"), "conv_id", "turn", "text", keep=["role"])
    m = chat.fit(lines)
    got = chat.recover(lines.drop("role"), m).collect()
    assert len(got) == 9 and len({r["conv"] for r in got}) == 3
    none = lines.filter("false")
    assert chat.recover(none.drop("role"), chat.fit(none)).count() == 0


def test_query_with_null_ids(spark, scratch):
    """A row without conv_id is a conversation of its own; its lines come back with a null id."""
    rows = [(None, 0, "user", "User: hello"), (None, None, None, None), (1, 0, "user", "User: hi"), (1, 1, "assistant", "Assistant: hey\nyou")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(scratch)
    got = queries.roles_of(spark.read.parquet(scratch)).collect()
    assert sorted((str(r["conv_id"]), r["line"]) for r in got) == [("1", 0), ("1", 0), ("1", 1), ("None", 0), ("None", 0)]
