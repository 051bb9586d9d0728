import zlib
from functools import lru_cache

import numpy as np
import pytest

from linefold.llm import lang_id, queries

from .conftest import messy_rows


def brute(model, word):
    """Sum over all segmentations of a marked word, for each language."""
    pieces = {}

    @lru_cache(None)
    def ahead(at):
        if at == len(marked):
            return np.ones(len(model.languages))
        total = np.zeros(len(model.languages))
        for end in range(at + 1, len(marked) + 1):
            total = total + pieces.get(marked[at:end], model.p[-2] if end == at + 1 else 0.0) * ahead(end)
        return total

    marked = "▁" + word
    for end in range(1, len(marked) + 1):
        for at in range(end):
            row = model.row_of.get(marked[at:end])
            if row is not None:
                pieces[marked[at:end]] = model.p[row]
    return ahead(0)


@pytest.fixture(scope="module")
def toy():
    pieces = ["▁", "a", "b", "c", "ab", "bc", "▁a", "▁ab", "abc", "cc"]
    model = lang_id.Unigrams(pieces, ["x", "y"])
    rng = np.random.default_rng(1)
    model.p[:-2] = rng.random((len(pieces), 2)) * 0.1
    model.p[-2] = 1e-4
    with np.errstate(over="ignore"):
        keys = {p: int(lang_id._prefix_hashes(lang_id._codes([p], len(p)))[-1][0]) for p in pieces}
    model.row_of = {p: int(np.searchsorted(model.keys, np.uint64(k))) for p, k in keys.items()}
    return model


def test_forward_sums_over_all_segmentations(toy):
    words = ["a", "abc", "abcab", "zzz", "azbcc", "abcabcabcabcab"]
    got = toy.log_words(words)
    for w, row in zip(words, got):
        assert np.allclose(np.exp(row), brute(toy, w), rtol=1e-9)


def test_long_words_stay_in_range(toy):
    one = toy.log_words(["abc" * 10])[0]
    many = toy.log_words(["abc" * 3000])[0]
    assert np.isfinite(many).all() and (many < one).all()


def test_learning_raises_the_likelihood_of_the_words():
    model = lang_id.Unigrams(["▁", "a", "b", "ab", "▁a", "▁b"], ["x", "y"])
    words, counts = ["abab", "bbbb"], np.array([[9.0, 1.0], [1.0, 9.0]])
    before = (model.log_words(words) * counts).sum()
    model.fit(words, counts, rounds=3)
    after = model.log_words(words)
    assert (after * counts).sum() > before and after[0, 0] > after[0, 1] and after[1, 1] > after[1, 0]
    assert np.allclose(model.p.sum(axis=0), 1.0)


def test_query_learns_from_the_other_rows_and_predicts_all(spark, small):
    truth = {r["doc_id"]: r["lang"] for r in small.collect()}
    got = queries.op6_language_id(spark, "/root/testdata/sf0.001").collect()
    assert sorted(r["doc_id"] for r in got) == sorted(truth)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) / len(held) >= 0.97


def test_held_out_labels_and_the_bound_do_not_reach_the_model(spark, small):
    from pyspark.sql import functions as F

    few = lang_id.learn(small, per_language=2)
    assert few.languages == lang_id.learn(small, per_language=3).languages
    odd = small.withColumn("lang", F.when(lang_id.is_held_out(F.col("doc_id")), F.lit("zz")).otherwise(F.col("lang")))
    assert "zz" not in lang_id.learn(odd, per_language=2).languages


def test_messy_and_empty_tables(messy, nothing, small):
    model = lang_id.learn(small, per_language=20)
    got = lang_id.predict(messy, model)
    assert got.columns == [*messy.columns, "lang_pred", "score"]
    rows = got.collect()
    assert len(rows) == len(messy_rows())
    for r in rows:
        if r["text"] is None or not any(c.isalpha() for c in r["text"]):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        else:
            assert r["lang_pred"] in model.languages and 0 < r["score"] <= 1
    assert lang_id.predict(nothing, model).count() == 0
    unlearnt = lang_id.learn(nothing)
    assert {r["lang_pred"] for r in lang_id.predict(messy, unlearnt).collect()} == {"und"}
    assert lang_id.predict(messy, lang_id.learn(messy)).count() == len(messy_rows())


def test_unlearnt_scripts_speak_for_no_language(spark, small):
    """An unknown character has one probability, so foreign texts have a very low fit, and learnt ones never have."""
    model = lang_id.learn(small, per_language=50)
    assert (model.p[-2] == lang_id.UNKNOWN).all() and np.allclose(model.p[:-2].sum(axis=0), 1.0)
    foreign = ["Съешь же ещё этих мягких французских булок", "我能吞下玻璃而不伤身体我能吞下玻璃", "აბგდევზთიკლმნოპჟრსტუფქღყშჩცძწჭხჯჰ"]
    docs = spark.createDataFrame(list(enumerate(foreign)), "doc_id long, text string")
    ownfit = [r["fit"] for r in lang_id.predict(small, model, fit="fit").collect() if r["lang_pred"] != "und"]
    fits = {r["doc_id"]: r["fit"] for r in lang_id.predict(docs, model, fit="fit").collect()}
    assert min(ownfit) > -5
    assert fits[1] < -9 and fits[2] < -9  # Cyrillic is in the vocabulary, letter by letter
    assert fits[0] < min(ownfit)


def test_very_long_words_are_learnt():
    model = lang_id.Unigrams(["▁", "a", "b", "▁a", "▁b"], ["x", "y"])
    model.fit(["a" * 500, "b" * 500], np.array([[9.0, 0.0], [0.0, 9.0]]), rounds=2)
    logs = model.log_words(["aaa", "bbb"])
    assert np.isfinite(logs).all() and logs[0, 0] > logs[0, 1] and logs[1, 1] > logs[1, 0]


def test_too_many_labels_are_refused(spark, monkeypatch):
    monkeypatch.setattr(lang_id, "LABELS", 2)
    docs = spark.createDataFrame([(i, "some words", f"l{i % 3}") for i in range(30)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="labels"):
        lang_id.learn(docs)
