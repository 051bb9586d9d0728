"""Parser: reject routing, fail-fast, layout, specs."""

import pytest
from pyspark.sql import functions as F

from linefold.config import FieldSpec, LogSpec
from linefold.operators.parse import accepted, parse, parse_accepted, rejects

FULL = (
    "17|2024-01-05 10:11:12 345|||APP_000003|||||sms||||||mo" + "|" * 44
)


def spec():
    return LogSpec.transaction_log().with_fields(FieldSpec("id", 1))


def frame(spark, lines):
    return spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "i int, value string")


def lines_only(spark, lines):
    return spark.createDataFrame([(v,) for v in lines], "value string")


def by_i(df):
    return {r["i"]: r.asDict() for r in df.collect()}


def test_full_line(spark):
    r = by_i(parse(frame(spark, [FULL]), spec(), keep=["i"]))[0]
    assert r["id"] == "17"
    assert r["time_stamp"] == "2024-01-05"
    assert r["app_id"] == "APP_000003"
    assert r["channel_type"] == "sms"
    assert r["travel_direction"] == "mo"
    assert r["_reject"] is None


def test_fixture_table(spark):
    # FIXTURES.md section 3, written by hand
    lines = [
        "a|b||",
        "",
        "|||",
        "|a",
        None,
        FULL + "|x61|x62|x63",
        "17|2024-01-05 10:11:12 345|||APP_000003",
        "17|2024-01",
    ]
    got = by_i(parse(frame(spark, lines), spec(), keep=["i"]))
    assert got[0]["_reject"] == "short_field:time_stamp"  # field 2 'b' is too short
    assert got[1]["_reject"] == "short_field:time_stamp" and got[1]["id"] == ""
    assert got[2]["_reject"] == "short_field:time_stamp" and got[2]["id"] == " "
    assert got[3]["_reject"] == "short_field:time_stamp" and got[3]["id"] == ""
    assert got[4]["_reject"] == "null_value"
    assert got[5]["_reject"] is None and got[5]["travel_direction"] == "mo"
    assert got[6]["_reject"] is None
    assert got[6]["channel_type"] == " " and got[6]["travel_direction"] == " "
    assert got[7]["_reject"] == "short_field:time_stamp"


def test_accepted_and_rejects_split_the_input(spark):
    lines = [FULL, None, "", FULL]
    parsed = parse(frame(spark, lines), spec(), keep=["i"])
    good = accepted(parsed)
    bad = rejects(parsed, keep=["i"])
    assert sorted(r["i"] for r in good.collect()) == [0, 3]
    assert sorted((r["i"], r["reason"]) for r in bad.collect()) == [
        (1, "null_value"),
        (2, "short_field:time_stamp"),
    ]
    assert "value" not in good.columns and "_reject" not in good.columns


def test_schema_is_nullable_strings(spark):
    df = parse_accepted(lines_only(spark, [FULL]), LogSpec.transaction_log())
    assert df.columns == ["time_stamp", "app_id", "channel_type", "travel_direction"]
    for f in df.schema.fields:
        assert f.dataType.simpleString() == "string" and f.nullable


def test_failfast_raises_before_predicate(spark):
    df = parse_accepted(frame(spark, [FULL, "|||"]), spec(), mode="failfast")
    # the bad line would be dropped by this predicate, yet it still fails the job
    with pytest.raises(Exception, match="malformed log line"):
        df.filter(F.col("id") == "17").collect()


def test_failfast_passes_good_lines(spark):
    df = parse_accepted(frame(spark, [FULL]), spec(), mode="failfast")
    assert df.count() == 1


def test_binary_value_is_cast(spark):
    df = spark.createDataFrame([(bytearray(FULL.encode()),)], "value binary")
    r = parse_accepted(df, spec()).collect()[0]
    assert r["app_id"] == "APP_000003"


def test_spec_from_original_config_keys():
    conf = {
        "fieldCount": 60,
        "delimeter": "|",
        "fields": "id,time_stamp,sp_id, dest_protocol",
        "selectedFields": ["time_stamp", "app_id"],
        "time_stamp": {"fieldNumber": 2, "substring": True, "substringValue": [0, 10]},
        "app_id": {"fieldNumber": 5, "substring": False},
    }
    s = LogSpec.from_dict(conf)
    assert s.fields == (FieldSpec("time_stamp", 2, (0, 10)), FieldSpec("app_id", 5))
    assert s.field_names[-1] == "dest_protocol"  # leading space trimmed


def test_transaction_layout_names():
    s = LogSpec.transaction_log()
    assert len(s.field_names) == 60
    assert s.ordinal_of("travel_direction") == 16
    assert s.ordinal_of("masked_msisdn") == 25


def test_spec_validation():
    with pytest.raises(ValueError):
        FieldSpec("x", 0)
    with pytest.raises(ValueError):
        FieldSpec("x", 1, (5, 2))
    with pytest.raises(ValueError):
        LogSpec((FieldSpec("x", 61),), "|", 60)
    with pytest.raises(ValueError):
        LogSpec((FieldSpec("x", 1), FieldSpec("x", 2)))


def test_select_by_declared_name(spark):
    s = LogSpec.transaction_log().select("time_stamp", "msisdn", "app_id", slices={"time_stamp": (0, 10)})
    assert [(f.name, f.ordinal, f.slice) for f in s.fields] == [
        ("time_stamp", 2, (0, 10)), ("msisdn", 24, None), ("app_id", 5, None)
    ]
    line = "|".join(["1", "2024-01-05 10:11:12 345", "", "", "APP_1"] + [""] * 18 + ["94770000000"] + [""] * 36)
    r = parse_accepted(lines_only(spark, [line]), s).collect()[0]
    assert (r["time_stamp"], r["msisdn"], r["app_id"]) == ("2024-01-05", "94770000000", "APP_1")
    with pytest.raises(ValueError):
        LogSpec.transaction_log().select("nope")
