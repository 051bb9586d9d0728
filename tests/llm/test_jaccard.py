import random
import tracemalloc

import numpy as np
import pytest

from linefold.llm import graph, jaccard, shingles

from .conftest import WORDS, messy_rows, prose

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    import re

    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))


def shingles_of(text):
    w = words_of(text)
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows, percent=80):
    """``(id, set size, smallest id of the component)`` per row, by comparing all pairs."""
    sets = [shingles_of(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        least.setdefault(root(k), []).append(i)
    least = {r: min((i for i in ids if i is not None), default=None) for r, ids in least.items()}
    return sorted([(i, len(sets[k]), least[root(k)]) for k, (i, _) in enumerate(rows)], key=str)


def result(docs, **how):
    return sorted([(r["_id"], r["n_shingles"], r["component_id"]) for r in jaccard.near_groups(docs, **how).collect()], key=str)


def table(spark, path, rows):
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def near_copies(seed, n):
    """Groups around base texts with few to many changed words, chains, and passages shared by unlike texts."""
    rng = random.Random(seed)
    passage = prose(99, 60)
    rows = []
    while len(rows) < n:
        base = prose(rng.randint(0, 10**6), rng.choice([8, 25, 90, 200])).split()
        for _ in range(rng.randint(1, 9)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(copy) // 18))):
                copy[rng.randrange(len(copy))] = rng.choice(WORDS) + str(rng.randint(0, 9))
            if rng.random() < 0.2:
                copy = copy[: -rng.randint(1, max(1, len(copy) // 8))]
            if rng.random() < 0.3:
                base = copy  # a chain
            text = " ".join(copy)
            rows.append(text + (" " + passage if rng.random() < 0.3 else ""))
    return list(enumerate(rows[:n]))


def test_shingle_sets_are_those_of_the_words(messy):
    rows = [r[1] for r in messy_rows()] + ["a  b\tc", "A B C", "é É", "a b c d e f", "a b c d e a b c d e"]
    got = shingles.shingle_sets(rows)
    assert [len(s) for s in got] == [len(shingles_of(t)) for t in rows]
    assert all((np.diff(s.astype(object)) > 0).all() for s in got)
    assert (got[-5] == got[-4]).all() and not np.intersect1d(got[-5], got[-3]).size
    for i, a in enumerate(rows):
        for j, b in enumerate(rows):
            assert len(np.intersect1d(got[i], got[j])) == len(shingles_of(a) & shingles_of(b))


@pytest.mark.parametrize(("seed", "percent"), [(1, 80), (2, 80), (3, 60), (4, 95)])
def test_components_of_near_copies(spark, tmp_root, seed, percent):
    rows = near_copies(seed, 250)
    docs = table(spark, f"{tmp_root}/near{seed}", rows)
    assert result(docs, percent=percent) == brute(rows, percent)


def test_crowded_lists_are_dealt_and_still_found(spark, tmp_root, monkeypatch):
    monkeypatch.setattr(jaccard, "LIST", 8)
    monkeypatch.setattr(jaccard, "BUCKET", 500)
    rng = random.Random(5)
    base = prose(7, 150).split()
    rows = []
    for i in range(120):
        copy = list(base)
        for _ in range(rng.randint(0, 7)):
            copy[rng.randrange(len(copy))] = f"w{rng.randint(0, 999)}"
        rows.append((i, " ".join(copy)))
    docs = table(spark, f"{tmp_root}/crowded_lists", rows)
    assert result(docs) == brute(rows)


@pytest.mark.parametrize("part", [None, 300])
def test_a_large_group_of_near_copies_gives_no_rows_by_pair(spark, tmp_root, monkeypatch, part):
    """Copies with one word in 45 changed mostly link with each other, not with the first of a list; also in blocks of parts."""
    if part:
        monkeypatch.setattr(jaccard, "GROUP_SHINGLES", part)
    rng = random.Random(6)
    base = prose(8, 90).split()
    rows = []
    for i in range(240):
        copy = list(base)
        for at in rng.sample(range(90), rng.choice([1, 2, 2, 3])):
            copy[at] = f"w{rng.randint(0, 4)}"
        rows.append((i, " ".join(copy)))
    made = {}

    def counted(df, name, write=jaccard.materialize):
        out = write(df, name)
        made[name] = out.count()
        return out

    monkeypatch.setattr(jaccard, "materialize", counted)
    assert result(table(spark, f"{tmp_root}/group{part}", rows)) == brute(rows)
    assert max(v for k, v in made.items() if k in ("undecided", "first", "joining", "rest", "found")) <= 2 * len(rows)
    assert part is None or made["groups"] > 0


def test_open_pairs_meet_with_few_texts_but_their_own(spark, tmp_root, monkeypatch):
    """Texts whose pairs are all decided stay out of the join that verifies the open ones."""
    seen = {}

    def noted(pairs, texts, name, verify=jaccard._verified):
        ends = {x for r in pairs.collect() for x in r}
        seen[name] = len(ends), texts.count(), {r["key"] for r in texts.select("key").collect()} >= ends
        return verify(pairs, texts, name)

    monkeypatch.setattr(jaccard, "_verified", noted)
    rng, base = random.Random(6), prose(8, 90).split()
    rows = near_copies(1, 60)
    for i in range(1000, 1060):
        copy = list(base)
        for at in rng.sample(range(90), rng.choice([1, 2, 2, 3])):
            copy[at] = f"w{rng.randint(0, 4)}"
        rows.append((i, " ".join(copy)))
    assert result(table(spark, f"{tmp_root}/open_pairs", rows)) == brute(rows)
    ends, texts, all_there = seen["first"]
    assert all_there and 0 < ends <= texts <= ends + 5 and texts < seen["hubs"][1]


def test_a_long_list_is_looked_at_in_bounded_memory():
    m = 3000
    rng = np.random.default_rng(1)
    keys = np.arange(m)
    maps = rng.integers(0, 2**63, (m, jaccard.WORDS)).astype(np.uint64)
    ones = np.ones(m, np.int64)
    entries = np.stack([0 * ones, 7 * ones, keys, 400 * ones, 400 * ones, keys, jaccard.NO_HUB * ones, 0 * ones, 0 * ones])
    tracemalloc.start()
    try:
        found = jaccard._AnchorPairs(entries, keys, maps, 1).rows()
        assert found.shape[1] == m and (found[4] == 1).all()
        assert tracemalloc.get_traced_memory()[1] < 150e6
    finally:
        tracemalloc.stop()


def test_links_only_between_members_of_stars_are_found(spark, tmp_root):
    """Texts that shrink word by word: ends of the chain are unlike, neighbours link."""
    words = [f"w{i}" for i in range(160)]
    rows = [(i, " ".join(words[i * 4 : i * 4 + 60])) for i in range(25)]
    docs = table(spark, f"{tmp_root}/chain", rows)
    assert result(docs) == brute(rows)


def test_small_scale(small):
    rows = [(r["doc_id"], r["text"]) for r in small.collect()]
    assert result(small) == brute(rows)


def test_messy_and_empty_tables(messy, nothing):
    assert result(messy) == brute([r[:2] for r in messy_rows()])
    assert result(nothing) == []
    kept = jaccard.drop_near_copies(messy)
    assert kept.columns == messy.columns
    groups = {g for _, n, g in brute([r[:2] for r in messy_rows()]) if n}
    nulls = sum(not shingles_of(r[1]) for r in messy_rows())
    assert kept.filter("text IS NOT NULL").count() >= len(groups)
    assert kept.count() == sum(r["kept"] for r in jaccard.near_groups(messy).collect())
    assert kept.filter("trim(coalesce(text, '')) = ''").count() >= nulls - 1
    assert jaccard.drop_near_copies(nothing).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_components_of_random_graphs(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randint(-50, 400), rng.randint(-50, 400)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1060)] + [(2000, i) for i in range(2001, 2050)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[root(a)] = root(b)
    least = {}
    for x in parent:
        least[root(x)] = min(least.get(root(x), x), x)
    got = {r["key"]: r["label"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = {x for e in edges if e[0] != e[1] for x in e}
    assert got == {x: least[root(x)] for x in linked}
