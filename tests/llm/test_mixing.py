import re

import pytest

from linefold.llm import mixing

from .conftest import messy_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes: dict, weights=(5, 2, 1), most=3.0) -> dict:
    names = sorted((s for s in sizes if s is not None), key=lambda s: s) + [s for s in sizes if s is None]
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, free, left = {}, set(names), float(sum(sizes.values()))
    while free:
        share = left / sum(w[s] for s in free)
        over = [s for s in free if share * w[s] > most * sizes[s]]
        if not over:
            return target | {s: share * w[s] for s in free}
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
            free.remove(s)
    return target


def sizes_of(rows):
    out = {}
    for _, text, source in rows:
        out[source] = out.get(source, 0) + len(WORD.findall(text or ""))
    return out


def check(rows, got):
    sizes = sizes_of(rows)
    targets = brute_targets(sizes)
    assert len(got) == len(rows)
    taken, largest = dict.fromkeys(sizes, 0), dict.fromkeys(sizes, 0)
    for r in got:
        s = r["_source"]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(targets[s], rel=1e-9, abs=1e-9)
        assert 0 <= r["copies"] * r["_size"] <= 3 * r["_size"]
        taken[s] += r["copies"] * r["_size"]
        largest[s] = max(largest[s], r["_size"])
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= largest[s] / 2 + 1


@pytest.mark.parametrize("per_bucket", [4096, 1])
def test_targets_and_taken_words(messy, per_bucket):
    mix = mixing.Mix(messy, per_bucket=per_bucket)
    check([(r[0], r[1], r[3]) for r in messy_rows()], mix.decided(mix.slim).collect())


def test_documents_of_the_small_scale_come_near_and_reruns_agree(small):
    rows = [(r["doc_id"], r["text"], r["source"]) for r in small.collect()]
    first, second = (mixing.Mix(small, per_bucket=n) for n in (3, 3))
    one, two = (sorted(m.decided(m.slim).select("_id", "copies", "_source", "_size", "source_size", "target").collect()) for m in (first, second))
    assert one == two
    check(rows, one)


def test_bucketing_only_changes_where_the_budget_ends(small):
    """Whatever the buckets, all but the last documents before the budget's end follow the key order."""
    mix = mixing.Mix(small, per_bucket=5)
    rows = mix.decided(mix.slim).select("_source", "_key", "copies", "target", "source_size").collect()
    by = {}
    for r in rows:
        by.setdefault(r["_source"], []).append((r["_key"], r["copies"]))
    for pairs in by.values():
        copies = [c for _, c in sorted(pairs)]
        drops = [i for i in range(1, len(copies)) if copies[i] > copies[i - 1]]
        assert len(drops) <= 1  # the closing document alone is out of order


def test_mixed_rows_and_quality(messy, small):
    mix = mixing.Mix(messy)
    mixed = mix.mixed(messy)
    assert mixed.columns == messy.columns
    decided = mix.decided(mix.slim).collect()
    assert mixed.count() == sum(r["copies"] for r in decided)
    weighted = mixing.Mix(small, quality_col="n_chars")
    assert weighted.mixed(small).columns == small.columns


def test_empty_table(nothing):
    mix = mixing.Mix(nothing)
    assert mix.decided(mix.slim).count() == 0 and mix.mixed(nothing).count() == 0


def test_documents_are_not_shuffled_for_what_an_end_bucket_gives(spark, tmp_root):
    rows = [(i if i % 5 else None, "word " * (i % 7), "abc"[i % 3]) for i in range(9000)]
    path = f"{tmp_root}/mix-plan"
    spark.createDataFrame(rows, "doc_id long, text string, source string").coalesce(2).write.parquet(path)
    docs = spark.read.parquet(path)
    mix = mixing.Mix(docs)
    taken = mix.decided(mix.slim)
    check(rows, taken.collect())
    # room for a row per source, not for a row per document of the end buckets
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "12000")
    try:
        plans = [df._jdf.queryExecution().executedPlan().toString() for df in (taken, mix.mixed(docs))]
    finally:
        spark.conf.set(limit, before)
    assert all("BroadcastHashJoin" in p and "SortMergeJoin" not in p and "hashpartitioning" not in p for p in plans)
    assert mix.mixed(docs).count() == sum(r["copies"] for r in taken.collect())
