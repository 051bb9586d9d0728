import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from linefold.llm import fingerprints, queries

from .conftest import WORDS, messy_rows, prose

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def edited(texts):
    out = []
    for i, t in enumerate(texts):
        half = len(t) // 2
        out.append(t[: len(t) - half] + texts[(i + 1) % len(texts)][:half])
    return out


def test_likeness_estimates_jaccard(spark):
    rng = random.Random(3)
    pairs = []
    for k in range(150):
        words = [rng.choice(WORDS) + str(rng.randint(0, 99)) for _ in range(rng.choice([6, 30, 120, 800]))]
        other = [w if rng.random() > k / 1500 else "changed" + str(rng.randint(0, 99)) for w in words]
        pairs.append((" ".join(words), " ".join(other)))
    docs = spark.createDataFrame(pairs, "a string, b string")
    got = docs.select("a", "b", fingerprints.likeness(fingerprints.fingerprint(F.col("a")), fingerprints.fingerprint(F.col("b"))).alias("x")).collect()
    errors = [r["x"] - jaccard(shingles(r["a"]), shingles(r["b"])) for r in got]
    assert abs(sum(errors)) / len(errors) < 0.02
    assert (sum(e * e for e in errors) / len(errors)) ** 0.5 < 0.06
    assert all(0 <= r["x"] <= 1 for r in got)


def test_equal_texts_case_and_emptiness(spark):
    texts = ["a b c", "A B  C", "", None, " ", "a b", prose(1, 50), prose(1, 50).upper(), "x", "Ä b", "ä b"]
    docs = spark.createDataFrame(list(enumerate(texts)), "i int, t string").coalesce(1)
    fp = [r[0] for r in docs.select(fingerprints.fingerprint(F.col("t"))).collect()]
    assert fp[0] == fp[1] and fp[6] == fp[7] and fp[9] != fp[10]
    assert fp[2] == fp[3] == fp[4] == "" and len(set(map(len, fp))) == 2
    near = lambda a, b: spark.range(1).select(fingerprints.likeness(F.lit(fp[a]), F.lit(fp[b]))).first()[0]
    assert near(2, 3) == 1.0 and near(0, 1) == 1.0 and near(2, 0) == 0.0 and near(8, 0) == 0.0


@pytest.mark.parametrize("per_bucket", [4096, 1, 3])
def test_next_documents_by_ascending_id(spark, monkeypatch, tmp_root, per_bucket):
    monkeypatch.setattr(fingerprints, "PER_BUCKET", per_bucket)
    rng = random.Random(per_bucket)
    ids = rng.sample(range(-(2**62), 2**62, 2**40), 40) + list(range(300, 360)) + [2**62 + 5]
    rows = [(i, prose(i, rng.randint(0, 20))) for i in ids]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_root}/ids{per_bucket}")
    docs = spark.read.parquet(f"{tmp_root}/ids{per_bucket}")
    path_rows = sorted(rows)
    got = {r["_id"]: r["_next"]["text"] for r in fingerprints.with_next(docs, "doc_id", "text").collect()}
    assert got == {i: path_rows[(k + 1) % len(path_rows)][1] for k, (i, _) in enumerate(path_rows)}


def test_a_shared_id_is_cut_by_hash(spark, monkeypatch, tmp_root):
    monkeypatch.setattr(fingerprints, "PER_BUCKET", 2)
    rows = [(None if i % 3 == 0 else 7, f"word{i} more{i % 11}") for i in range(400)] + [(9, "last")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_root}/shared_id")
    docs = spark.read.parquet(f"{tmp_root}/shared_id")
    got = fingerprints.with_next(docs, "doc_id", "text").select("_text", "_id", "_next.text", "_bucket").collect()
    after = {r["_text"]: r["text"] for r in got}
    at, seen = "last", []
    for _ in rows:
        at = after[at]
        seen.append(at)
    assert sorted(seen) == sorted(t for _, t in rows) and seen[-1] == "last"  # one ring through all rows
    assert len({r["_bucket"] for r in got}) > 50


def test_query_over_the_small_scale(spark, small):
    rows = sorted((r["doc_id"], r["text"]) for r in small.collect())
    texts = [t for _, t in rows]
    got = sorted(queries.op5_fingerprints(spark, "/root/testdata/sf0.001").collect())
    assert [r["doc_id"] for r in got] == [i for i, _ in rows]
    assert [r["edited_sha256"] for r in got] == [hashlib.sha256(t.encode()).hexdigest() for t in edited(texts)]
    assert [r["n_chars"] for r in got] == [len(t) for t in texts]
    sets, changed = [shingles(t) for t in texts], [shingles(t) for t in edited(texts)]
    errors = [r["near_edited"] - jaccard(a, b) for r, a, b in zip(got, sets, changed)]
    assert (sum(e * e for e in errors) / len(errors)) ** 0.5 < 0.06


def test_messy_and_empty_tables(messy, nothing):
    rows = fingerprints.with_next(messy, "doc_id", "text").collect()
    assert sorted(r["_text"] for r in rows) == sorted(r[1] or "" for r in messy_rows())
    assert sorted(r["_next"]["text"] for r in rows) == sorted(r[1] or "" for r in messy_rows())
    assert fingerprints.with_next(nothing, "doc_id", "text").count() == 0


def test_next_texts_and_even_buckets(spark, scratch, monkeypatch):
    """Every bucket, the outer ones too, holds about as many documents; the next text is that of the next id."""
    monkeypatch.setattr(fingerprints, "PER_BUCKET", 4)
    rows = [(i * 7 + 3, f"text number {i} of some words") for i in range(6000)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(scratch)
    found = fingerprints.with_next(spark.read.parquet(scratch), "doc_id", "text")
    sizes = [r["count"] for r in found.groupBy("_bucket").count().collect()]
    assert len(sizes) > 1000 and max(sizes) <= 24
    after = {r["_id"]: r["t"] for r in found.selectExpr("_id", "_next.text AS t").collect()}
    texts = [t for _, t in rows]
    assert [after[i] for i, _ in rows] == [*texts[1:], texts[0]]
