"""Java String.split semantics of the field functions."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from linefold.config import FieldSpec, LogSpec
from linefold.functions.split import field_from_parts_sql, java_split_sql, regex_literal
from linefold.operators.parse import parse


def java_split_model(line, delim):
    """What ``line.split(Pattern.quote(delim))`` returns on the JVM."""
    if line == "":
        return [""]
    parts = line.split(delim)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def field_model(line, delim, n):
    parts = java_split_model(line, delim)
    return parts[n - 1] if n <= len(parts) else " "


def _frame(spark, lines):
    return spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "i int, value string")


def check_lines(spark, lines, delim, upto=6):
    df = _frame(spark, lines)
    parts = java_split_sql("value", delim)
    cols = [F.expr(parts).alias("parts")]
    cols += [F.expr(field_from_parts_sql(parts, n)).alias(f"f{n}") for n in range(1, upto + 1)]
    got = {r["i"]: r for r in df.select("i", *cols).collect()}
    for i, line in enumerate(lines):
        r = got[i]
        assert list(r["parts"]) == java_split_model(line, delim), (line, r["parts"])
        for n in range(1, upto + 1):
            assert r[f"f{n}"] == field_model(line, delim, n), (line, n, r[f"f{n}"])


def test_hand_written_edges(spark):
    # FIXTURES.md section 3 plus interior empties
    lines = ["a|b||", "", "|||", "|a", "x", "a||c", "a|b|c", "||x||", "|"]
    check_lines(spark, lines, "|")


def test_regex_literal_quotes_metacharacters():
    assert regex_literal("|") == "\\|"
    assert regex_literal("a.b") == "a\\.b"
    assert regex_literal("d") == "d"


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="ab| ", max_size=12), min_size=1, max_size=40))
def test_single_char_delimiter_matches_java(spark, lines):
    check_lines(spark, lines, "|")


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text(alphabet="abx.", max_size=12), min_size=1, max_size=40))
def test_multi_char_delimiter_matches_java(spark, lines):
    check_lines(spark, lines, "ab")


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text(alphabet="ab.", max_size=10), min_size=1, max_size=40))
def test_regex_metachar_delimiter(spark, lines):
    check_lines(spark, lines, ".")


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text(alphabet="ab| ", max_size=14), min_size=1, max_size=40))
def test_parse_fields_match_java(spark, lines):
    spec = LogSpec(tuple(FieldSpec(f"f{n}", n) for n in (1, 2, 3, 5)), "|", 6)
    got = {r["i"]: r for r in parse(_frame(spark, lines), spec, keep=["i"]).collect()}
    for i, line in enumerate(lines):
        for n in (1, 2, 3, 5):
            assert got[i][f"f{n}"] == field_model(line, "|", n), (line, n)
        assert got[i]["_reject"] is None


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="a||| ", max_size=30), min_size=1, max_size=60))
def test_parse_fields_match_java_many_pipes(spark, lines):
    ordinals = (1, 2, 4, 7, 9)
    spec = LogSpec(tuple(FieldSpec(f"f{n}", n) for n in ordinals), "|", 12)
    got = {r["i"]: r for r in parse(_frame(spark, lines), spec, keep=["i"]).collect()}
    for i, line in enumerate(lines):
        for n in ordinals:
            assert got[i][f"f{n}"] == field_model(line, "|", n), (line, n)


@pytest.mark.parametrize("delim,alphabet", [(".", "ab. "), ("\\", "ab\\ "), ("ab", "abx"), ("'", "a' "), ("$", "a$ ")])
def test_parse_any_delimiter_matches_java(spark, delim, alphabet):
    @settings(max_examples=8, deadline=None)
    @given(st.lists(st.text(alphabet=alphabet, max_size=16), min_size=1, max_size=40))
    def check(lines):
        ordinals = (1, 2, 3, 5)
        spec = LogSpec(tuple(FieldSpec(f"f{n}", n) for n in ordinals), delim, 8)
        got = {r["i"]: r for r in parse(_frame(spark, lines), spec, keep=["i"]).collect()}
        for i, line in enumerate(lines):
            for n in ordinals:
                assert got[i][f"f{n}"] == field_model(line, delim, n), (line, n)

    check()
