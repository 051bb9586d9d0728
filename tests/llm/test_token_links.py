import hashlib
from collections import Counter

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from linefold.llm import queries, token_links
from linefold.llm.tokens import vocabulary_path

from .conftest import messy_rows

COLUMNS = [c.split()[0] for c in token_links.SCHEMA.split(", ")]
ODD = ["x▁y", "a  b\n\n c \t", "<s> <|endoftext|> </s> <unk>", "\x00 q", " ", "  lead", "ｆｕｌｌ ﬁne", "tab\tand　wide", "a​b"]


@pytest.fixture(scope="module")
def sides():
    return token_links.SideA(vocabulary_path(token_links.VOCABULARY_A)), token_links.SideB(vocabulary_path(token_links.VOCABULARY_B))


def groups_of(text, sides):
    """Groups of one text, token by token, or None where a side's bytes are not the text's."""
    a, b = sides
    if not text:
        return None
    ids = a.library.encode(f" {text}", add_special_tokens=False).ids, b.library.encode(text)
    ends = []
    for side, of in zip(sides, ids):
        pieces = [side.bytes[side.starts[i] : side.starts[i] + side.lengths[i]].tobytes() for i in of]
        if b"".join(pieces) != f" {text}".encode():
            return None
        ends.append([sum(map(len, pieces[: k + 1])) for k in range(len(pieces))])
    shared, found, i, j = set(ends[0]) & set(ends[1]), [], 0, 0
    for x, at in enumerate(ends[0]):
        if at in shared:
            y = ends[1].index(at)
            found.append((ids[0][i : x + 1], ids[1][j : y + 1]))
            i, j = x + 1, y + 1
    return found


def brute(rows, sides):
    every = [(i, groups_of(t, sides)) for i, t in rows]
    links = [[(p, q) for a, b in g or [] for p in a for q in b] for _, g in every]
    counts = Counter(x for some in links for x in set(some))
    highest = Counter()
    for (p, _), n in counts.items():
        highest[p] = max(highest[p], n)
    out = []
    for (i, g), some in zip(every, links):
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in g or [])
        out.append(
            (
                i, sum(len(a) for a, _ in g or []), sum(len(b) for _, b in g or []), len(g or []), len(some),
                sum(counts[x] == highest[x[0]] for x in some), sum(counts[x] for x in some),
                hashlib.sha256(text.encode()).hexdigest() if g else "",
            )
        )
    return sorted(out, key=str)


def test_sums_of_messy_documents(spark, messy, sides):
    odd = spark.createDataFrame(list(enumerate(ODD, 100)), "doc_id long, text string")
    docs = messy.select("doc_id", "text", "key", "name").unionByName(odd, allowMissingColumns=True)
    rows = [(r[0], r[1] if len(r[1] or "") < 5000 else r[1][:2000]) for r in messy_rows()] + list(enumerate(ODD, 100))
    short = docs.withColumn("text", F.expr("if(length(text) < 5000, text, left(text, 2000))"))
    for batch in (token_links.BATCH, 500):
        got = token_links.align(short, batch_chars=batch)
        assert got.columns == COLUMNS
        assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, sides)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab'sThe 1²½ \t\n\x1c\x85\xa0é́你😀<s>.-▁")), max_size=60))
def test_ids_of_latin_and_other_texts(sides, text):
    a = sides[0]
    ids, at = a.encode([text, "plain words", text])
    want = [a.library.encode(f" {t}", add_special_tokens=False).ids for t in (text, "plain words", text)]
    assert [ids[i:j].tolist() for i, j in zip(at, at[1:])] == want
    b = sides[1]
    ids, at = b.encode([text, "plain words", text])
    assert [ids[i:j].tolist() for i, j in zip(at, at[1:])] == b.library.encode([text, "plain words", text])


def test_a_very_long_text(spark, sides):
    rows = [(0, "word " * 100_000), (1, "x" * 30_000), (2, "word")]
    got = {r["doc_id"]: r for r in token_links.align(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0]["n_groups"] == len(groups_of("word " * 300, sides)) - 300 + 100_000 and got[0]["count_sum"] >= 200_000
    assert got[1]["n_a"] > 0 and got[2]["n_links"] == 1


def test_pairs_count_documents_not_occurrences(spark, sides):
    rows = [(0, "word word word"), (1, "word"), (1, "word"), (2, "other")]
    got = token_links.align(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, sides)


def test_workers_remember_no_texts_between_tasks(spark, sides):
    def remembered(batches):
        for batch in batches:
            kept = [len(s._memo._pieces) for x in token_links._LOADED.values() for s in (x.a, x.b)]
            yield pa.RecordBatch.from_arrays([pa.array([len(kept)] * len(batch)), pa.array([sum(kept)] * len(batch))], names=["sides", "pieces"])

    rows = [(i, f"word{i} of text {i}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    assert sorted((tuple(r) for r in token_links.align(docs).collect()), key=str) == brute(rows, sides)
    found = spark.range(0, 64, 1, 16).mapInArrow(remembered, "sides long, pieces long").collect()
    assert max(r["sides"] for r in found) == 2 and max(r["pieces"] for r in found) == 0


def test_a_window_is_one_key(sides):
    """Windows of the same ids of A and of B are one; their groups, texts and links are those of the windows alone."""
    aligner = token_links.Aligner(*sides)
    batch = token_links._Batch(aligner)
    batch.add([0, 1], ["one two one", "two"])
    batch.add([2], ["one three"])
    assert all(isinstance(w, bytes) for w in batch.windows) and len(batch.windows) == len(batch.groups) == len(batch.n_links) == len(batch.texts)
    for i, w in enumerate(batch.windows):
        groups, texts, n_links, links = aligner.align([w])
        at = int(batch.n_links[:i].sum())
        assert [groups[0], texts[0], n_links[0]] == [batch.groups[i], batch.texts[i], batch.n_links[i]]
        assert links.tolist() == [x for some in batch.links for x in some.tolist()][at : at + n_links[0]]


def test_no_row_grows_with_its_batch(spark, sides):
    """All documents are one batch; its rows are those of a few pairs, or of one document."""
    rows = [(i, f"word{i} of text {i * 7} and {i * i} more") for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    batches, counts = token_links._tables(docs, "doc_id", "text", None, None, token_links.BATCH)
    assert batches.select("batch").distinct().count() == 1
    assert batches.agg(F.max(F.length(F.to_json(F.struct("*"))))).first()[0] < 300_000
    assert sorted((tuple(r) for r in token_links.document_sums(batches, counts).collect()), key=str) == brute(rows, sides)


def test_rows_of_a_batch(sides, monkeypatch):
    """Pairs in rows of bounded length; a document's distinct pairs and how often it holds each."""
    monkeypatch.setattr(token_links, "PAIRS", 3)
    texts = ["one two one two one", "", "two " * 300, "x▁y", "three"]
    batch = token_links._Batch(token_links.Aligner(*sides))
    batch.add([5, None, 7, 7, 9], texts)
    pairs, docs = (r.to_pylist() for r in batch.close(11))
    assert {r["batch"] for r in pairs + docs} == {11} and [r["doc_id"] for r in docs] == [5, None, 7, 7, 9]
    assert [r["first"] for r in pairs] == [*range(0, 3 * len(pairs), 3)] and len(pairs) > 1
    every = [p for r in pairs for p in r["pairs"]]
    want = [Counter(p << 32 | q for a, b in groups_of(t, sides) or [] for p in a for q in b) for t in texts]
    got = []
    for r in docs:
        held, times = (token_links._unpacked(r[c], r["n_held"]) for c in ("held", "times"))
        got.append(dict(zip([every[i] for i in held], times.tolist())))
    assert got == want and max(want[2].values()) > 255
    assert [n for r in pairs for n in r["holders"]] == [sum(p in w for w in want) for p in every]


def test_batches_without_pairs(spark):
    rows = [(1, None), (2, ""), (3, "x▁y"), (None, "")]
    got = token_links.align(spark.createDataFrame(rows, "doc_id long, text string"), batch_chars=1)
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted([(i, 0, 0, 0, 0, 0, 0, "") for i, _ in rows], key=str)


def test_no_documents(nothing):
    assert token_links.align(nothing).collect() == []


def test_query(spark, small, sides):
    got = sorted((tuple(r) for r in queries.op12_token_links(spark, "/root/testdata/sf0.001").collect()), key=str)
    some = [(r["doc_id"], r["text"]) for r in small.collect()]
    assert [r[:5] + r[7:] for r in got] == [r[:5] + r[7:] for r in brute(some, sides)] and got == brute(some, sides)
