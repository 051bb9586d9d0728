import ast
from pathlib import Path

import corpus_pipeline
from linefold.llm import lang_id, mixing, tokens

from .conftest import messy_rows
from .test_exact_dedup import FOLD
from .test_jaccard import brute
from .test_tokens import check_pieces

SF = "/root/testdata/sf0.001"


def write(spark, df, path):
    df.write.parquet(path)
    return spark.read.parquet(path)


def test_columns_called_like_the_prediction_stay(spark, small, scratch):
    from pyspark.sql import functions as F

    docs = small.withColumns({c: F.lit("mine") for c in ("_lang_pred", "_lang_score", "score", "fit", "row", "lang_pred")})
    docs = write(spark, docs, f"{scratch}/clash")
    got = corpus_pipeline.language(spark, docs, SF)
    assert got.columns == docs.columns and got.count() == docs.count()
    assert {tuple(r) for r in got.select("_lang_pred", "_lang_score", "score", "fit", "row", "lang_pred").collect()} == {("mine",) * 6}


def test_unlearnt_scripts_go(spark, small, scratch):
    rows = small.limit(0).unionByName(spark.createDataFrame([(10**6, "我能吞下玻璃而不伤身体我能吞下玻璃")], "doc_id long, text string"), allowMissingColumns=True)
    docs = write(spark, small.unionByName(rows), f"{scratch}/foreign")
    got = {r["doc_id"] for r in corpus_pipeline.language(spark, docs, SF).select("doc_id").collect()}
    assert got == {r["doc_id"] for r in small.select("doc_id").collect()}


def test_stages_against_brute_force(spark, small, scratch):
    docs, columns = small, small.columns
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    stage = dict(corpus_pipeline.STAGES)

    clear = write(spark, stage["language_id"](spark, docs, SF), f"{scratch}/1")
    assert clear.columns == columns and sorted(r["doc_id"] for r in clear.collect()) == sorted(r["doc_id"] for r in docs.collect())

    single = write(spark, stage["exact_dedup"](spark, clear, SF), f"{scratch}/2")
    last = {}
    for r in sorted(clear.collect()):
        last[r["text"].translate(FOLD)] = r["doc_id"]
    assert single.columns == columns and sorted(r["doc_id"] for r in single.collect()) == sorted(last.values())

    apart = write(spark, stage["near_dedup"](spark, single, SF), f"{scratch}/3")
    groups = {g for _, _, g in brute([(r["doc_id"], r["text"]) for r in single.collect()])}
    assert apart.columns == columns and {r["doc_id"] for r in apart.collect()} == groups

    mixed = write(spark, stage["mix_sources"](spark, apart, SF), f"{scratch}/4")
    assert mixed.columns == columns
    mix = mixing.Mix(apart)
    copies = {r["_id"]: r["copies"] for r in mix.decided(mix.slim).collect()}
    assert sorted(r["doc_id"] for r in mixed.collect()) == sorted(i for i, n in copies.items() for _ in range(n))

    rows = mixed.collect()
    ids, offsets = tokens.WordTokenizer(tokens.vocabulary_path()).encode([r["text"] for r in rows])
    expected = [(r["doc_id"], [*ids[a:b].tolist(), 1]) for r, a, b in zip(rows, offsets, offsets[1:])]
    padding, _ = check_pieces(stage["pack"](spark, mixed, SF).collect(), expected, 2048)
    assert padding == 0


def test_run_gives_the_pieces(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert got.count() > 0


def test_unreadable_documents_go_and_stages_take_any_rows(spark, messy, nothing, scratch):
    stage = dict(corpus_pipeline.STAGES)
    kept = stage["language_id"](spark, messy, SF)
    letters = [r for r in messy_rows() if any(c.isalpha() for c in r[1] or "")]
    assert kept.columns == messy.columns and 0 < kept.count() <= len(letters)
    docs = nothing
    for i, (name, f) in enumerate(corpus_pipeline.STAGES):
        docs = write(spark, f(spark, docs, SF), f"{scratch}/{i}")
        assert docs.count() == 0


def test_import_errors_are_not_swallowed():
    root = Path(corpus_pipeline.__file__).resolve().parent
    for path in [root / "corpus_pipeline.py", *(root / "linefold/llm").glob("*.py")]:
        for node in ast.walk(ast.parse(path.read_text())):
            if isinstance(node, ast.Try):  # what is caught is named, and is no import error
                caught = [h.type.id for h in node.handlers if isinstance(h.type, ast.Name)]
                assert len(caught) == len(node.handlers) and set(caught) <= {"AnalysisException"}, path
    assert lang_id.UND == "und"
