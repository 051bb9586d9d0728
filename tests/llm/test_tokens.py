import shutil
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from linefold.llm import packing, token_files, tokens

from .conftest import messy_rows


@pytest.fixture(scope="module")
def words():
    return tokens.WordTokenizer(tokens.vocabulary_path(), cache=50)


def crc(ids):
    return zlib.crc32(np.asarray(ids, dtype="<u4").tobytes())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("aB'stré1. \n\t\x1c\x85\xa0 ́你😀İß<|>")), max_size=30), max_size=6))
def test_ids_are_those_of_the_library(texts):
    words = _shared()
    ids, offsets = words.encode(texts)
    expected = [e.ids for e in words.library.encode_batch(texts, add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == expected


def _shared(cache=[]):  # noqa: B006 - one instance for all examples
    if not cache:
        cache.append(tokens.WordTokenizer(tokens.vocabulary_path(), cache=50))
    return cache[0]


def test_ids_of_whole_documents(words, small):
    texts = [r["text"] for r in small.collect()] + ["a <|endoftext|> b", "it's DON'T 'S's", "x\x1cy z"]
    expected = [e.ids for e in words.library.encode_batch(texts, add_special_tokens=False)]
    for _ in range(2):  # from the library, then from the dictionaries
        ids, offsets = words.encode(texts)
        assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == expected


def test_the_pretokens_of_a_distinct_piece_are_looked_up_once():
    """A word that is everywhere costs a lookup of its pre-tokens, not one an occurrence; odd pieces stand between plain ones."""

    class Counted(tokens.Numbered):
        asked = 0

        def __getitem__(self, key):
            Counted.asked += 1
            return super().__getitem__(key)

    words = tokens.WordTokenizer(tokens.vocabulary_path())
    words._pretokens._pieces = Counted()
    texts = [" the  cat's\t" * 500, "", "x\x85y the\x1cz <|endoftext|> İ 12", "\n a\xa0b\n"]
    ids, offsets = words.encode(texts)
    expected = [e.ids for e in words.library.encode_batch(texts, add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == expected
    assert Counted.asked <= 20


def test_new_plain_pretokens_go_to_the_bare_model_in_short_texts():
    """The library's normalizer and pattern see only odd pieces, and no text of plain pre-tokens is long."""

    class Seen:
        def __init__(self, library):
            self.library, self.texts = library, []

        def encode_batch_fast(self, texts, **how):
            self.texts += texts
            return self.library.encode_batch_fast(texts, **how)

    words = tokens.WordTokenizer(tokens.vocabulary_path())
    plain, whole = Seen(words._plain), Seen(words.library)
    words._plain, words.library = plain, whole
    texts = [" ".join(f"{a}Öé{b}'s" for a in "abcdefghij" for b in map("".join, combinations("klmnopqrstuvw", 3))), "x\x85y"]
    expected = [e.ids for e in whole.library.encode_batch(texts, add_special_tokens=False)]
    ids, offsets = words.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == expected
    assert len(plain.texts) > 4 and max(len(t.split()) for t in plain.texts) <= 500
    assert sum(map(len, whole.texts)) < 10_000 < len(texts[0])  # odd pieces, and what came with the line break


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_columns_are_encoded_as_lists_are(words, kind):
    texts = ["a  bé", "x", "", "it's <|endoftext|>\x85 y", "你好 12", " \n", "end"]
    column = pa.array(["before", *texts, "after"], kind).slice(1, len(texts))
    for some in (column, column.slice(2, 1), column.slice(0, 0)):
        ids, offsets = words.encode(some)
        expected, at = words.encode(some.to_pylist())
        assert ids.tolist() == expected.tolist() and offsets.tolist() == at.tolist()
    assert list(tokens.slices(column, 6)) == [(0, 1), (1, 3), (3, 4), (4, 5), (5, 7)]


def test_a_worker_keeps_no_tokenizer_after_packing(spark, small, tmp_path):
    """Python workers wait beside the executor's heap while other stages run."""
    path = str(shutil.copy(tokens.vocabulary_path(), tmp_path / "own.json"))

    def alive(batches):
        import gc

        from linefold.llm.tokens import _LOADED

        for batch in batches:
            found = sum(type(x).__name__ == "WordTokenizer" for x in gc.get_objects())
            found -= sum(k != path for k in _LOADED)  # those of other tests
            yield pa.RecordBatch.from_arrays([pa.array([found] * batch.num_rows, pa.int64())], names=["n"])

    packing.pack(small.repartition(4), vocabulary=path).write.format("noop").mode("overwrite").save()
    assert {r["n"] for r in spark.range(8).repartition(4).mapInArrow(alive, "n long").collect()} == {0}


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 3), max_size=6), st.integers(1, 60))
def test_fill_comes_closest_to_the_capacity(counts, capacity):
    chosen = packing.fill(counts, capacity)
    assert all(0 < v <= counts[k] for k, v in chosen.items())
    items = [k for k, v in counts.items() for _ in range(v)]
    sums = {sum(c) for n in range(min(len(items), 7) + 1) for c in combinations(items, n)}
    best = max(s for s in sums if s <= capacity)
    assert sum(k * v for k, v in chosen.items()) >= best and sum(k * v for k, v in chosen.items()) <= capacity


def check_pieces(rows, ids_of, window):
    """``ids_of``: for each document, all its ids; documents with equal ids may share a doc_id."""
    pieces, sequences = defaultdict(Counter), defaultdict(list)
    total = 0
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]][(r["start"], r["length"], r["ids_crc32"], r["doc_tokens"])] += 1
        total += r["length"]
    assert total == sum(len(x) for _, x in ids_of)
    by_id = defaultdict(list)
    for i, x in ids_of:
        by_id[i].append(x)
    assert set(pieces) == set(by_id)
    for i, group in by_id.items():
        for start, length, code, n in pieces[i]:
            assert any(len(x) == n and crc(x[start : start + length]) == code for x in group)
        if len(group) == 1:
            at = 0
            for start, length, _, _ in sorted(pieces[i]):
                assert start == at
                at += length
            assert at == len(group[0])
    padding = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
        padding += window - at if at & (at - 1) else 0
    return padding, len(sequences)


@pytest.mark.parametrize(("window", "pool"), [(2048, 8192), (64, 16)])
def test_every_id_is_in_one_piece_and_nothing_is_padded(spark, words, small, window, pool):
    rows = small.collect()
    ids, offsets = words.encode([r["text"] for r in rows])
    expected = [(r["doc_id"], [*ids[a:b].tolist(), 1]) for r, a, b in zip(rows, offsets, offsets[1:])]
    got = packing.pack(small, window=window, pool=pool).collect()
    padding, sequences = check_pieces(got, expected, window)
    assert padding == 0
    assert sequences <= sum(len(x) for _, x in expected) / window + 11 * 4


def test_messy_and_empty_tables(spark, words, messy, nothing):
    ids, offsets = words.encode([r[1] or "" for r in messy_rows()])
    expected = [(r[0], [*ids[a:b].tolist(), 1]) for r, a, b in zip(messy_rows(), offsets, offsets[1:])]
    check_pieces(packing.pack(messy).collect(), expected, 2048)
    assert packing.pack(nothing).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 4000), min_size=1, max_size=700))
def test_elias_fano_gives_back_every_offset(lengths):
    ends = np.cumsum(lengths)
    code = token_files.EliasFano.encode(ends, int(ends[-1]))
    again = token_files.EliasFano(len(ends), int(ends[-1]), code.low.tobytes(), code.high.tobytes(), code.samples.tobytes())
    assert again.values().tolist() == ends.tolist()
    assert again.select(np.arange(len(ends))).tolist() == ends.tolist()
    assert again.select(np.arange(len(ends))[::-17]).tolist() == ends[::-17].tolist()
    assert again.select(np.zeros(0, int)).tolist() == []
    for outside in (-1, len(ends)):
        with pytest.raises(IndexError):
            again.select(np.array([outside]))
    n, u = len(ends), int(ends[-1])
    assert 8 * (len(code.low) + len(code.high)) <= n * (3 + max(0, np.log2(max(1, u / n)))) + 1200


def expected_files(words, rows):
    ids, offsets = words.encode([t or "" for _, t in rows])
    out, at = [], 0
    for (i, _), a, b in zip(rows, offsets, offsets[1:]):
        x = [*ids[a:b].tolist(), 2]
        out.append((i, at, len(x), crc(x)))
        at += len(x)
    return out


def read_back(spark, path):
    rows = token_files.read(spark, path).collect()
    return sorted((r["doc_id"], r["start"], r["n_tokens"], zlib.crc32(r["ids"])) for r in rows)


@pytest.mark.parametrize("blocks", [{}, {"block_docs": 3}, {"block_ids": 500}])
def test_files_round_trip(spark, words, small, scratch, blocks):
    token_files.write(small, scratch, **blocks)
    rows = sorted((r["doc_id"], r["text"]) for r in small.collect())
    assert read_back(spark, scratch) == expected_files(words, rows)


def test_single_documents_are_fetched(spark, messy, scratch):
    """Documents by id: their own starts and ids, repeats and null ids included, the others left alone."""
    token_files.write(messy, scratch, block_docs=4)
    every = [tuple(r) for r in token_files.read(spark, scratch).collect()]
    for ids in ([8], [6, 2**62, 10**9], [None], [None, 9, 9], []):
        got = [tuple(r) for r in token_files.read(spark, scratch, doc_ids=ids).collect()]
        assert sorted(got, key=str) == sorted((r for r in every if r[0] in ids), key=str)


def test_files_of_messy_and_empty_tables(spark, words, messy, nothing, scratch):
    token_files.write(messy, f"{scratch}/a", block_docs=4)
    got = sorted(token_files.read(spark, f"{scratch}/a").collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted((r[0] for r in messy_rows()), key=lambda i: (i is not None, i))
    assert [r["start"] for r in got] == np.cumsum([0, *[r["n_tokens"] for r in got]])[:-1].tolist()
    alone = Counter((i, n, code) for row in messy_rows() for i, _, n, code in expected_files(words, [row[:2]]))
    assert Counter((r["doc_id"], r["n_tokens"], zlib.crc32(r["ids"])) for r in got) == alone
    token_files.write(nothing, f"{scratch}/b")
    assert token_files.read(spark, f"{scratch}/b").count() == 0
