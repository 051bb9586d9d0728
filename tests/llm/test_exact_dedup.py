from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from linefold.llm import exact_dedup

from .conftest import messy_rows

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(FOLD)].append(i)
    out = []
    for ids in groups.values():
        known = [i for i in ids if i is not None]
        out += [(i, max(known) if known else None, len(ids)) for i in ids]
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [16384, 7])
def test_groups_are_those_of_equal_texts(messy, block):
    got = exact_dedup.exact_groups(messy, block=block).collect()
    assert sorted([(r["_id"], r["keep_id"], r["group_size"]) for r in got], key=str) == brute([r[:2] for r in messy_rows()])
    assert sum(r["kept"] for r in got) == len({(r[1] or "").translate(FOLD) for r in messy_rows()})


def test_blocks_that_share_a_hash_are_told_apart(messy):
    got = exact_dedup.exact_groups(messy, block=50, block_hash=lambda b: F.pmod(F.xxhash64(b), F.lit(3))).collect()
    assert sorted([(r["_id"], r["keep_id"], r["group_size"]) for r in got], key=str) == brute([r[:2] for r in messy_rows()])


def test_same_blocks_in_another_order_or_number_differ(spark):
    texts = ["ab", "ba", "abab", "aab", "abb", "ab", "a", "aa", "aaa", "aaaa", "aaaaa", "aaaa", ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = exact_dedup.exact_groups(docs, block=1).collect()
    assert sorted([(r["_id"], r["keep_id"], r["group_size"]) for r in got], key=str) == brute(list(enumerate(texts)))


def test_dropping_keeps_columns_and_one_row_of_each_group(messy):
    kept = exact_dedup.drop_exact_copies(messy)
    assert kept.columns == messy.columns
    folded = [(r["text"] or "").translate(FOLD) for r in kept.collect()]
    assert len(folded) == len(set(folded)) == len({(r[1] or "").translate(FOLD) for r in messy_rows()})


def test_empty_table(nothing):
    assert exact_dedup.exact_groups(nothing).count() == 0
    assert exact_dedup.drop_exact_copies(nothing).columns == nothing.columns
