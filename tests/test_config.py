"""Spec parsing edge cases."""

import json

import pytest

from linefold.config import FieldSpec, KafkaSpec, LogSpec, SummarySpec


def test_summary_spec_from_dict_variants():
    s = SummarySpec.from_dict({"whereClause": "x = 1", "groupingFields": "a, b"}, {"tableName": "t"})
    assert s.predicate == "x = 1" and s.keys == ("a", "b") and s.table == "t"
    assert SummarySpec.from_dict({}) == SummarySpec()
    with pytest.raises(ValueError):
        SummarySpec(keys=())


def test_log_spec_snake_case_and_lookup():
    s = LogSpec.from_dict({
        "delimiter": ";", "field_count": 5, "field_names": ["a", "b", "c"],
        "selected_fields": ["b", "c"], "c": {"ordinal": 3, "slice": [0, 2]},
    })
    assert s.delimiter == ";" and s.fields == (FieldSpec("b", 2), FieldSpec("c", 3, (0, 2)))
    assert s.max_ordinal == 3 and s.names == ["b", "c"]


def test_kafka_extra_options_and_batch_defaults():
    spec = KafkaSpec("h:9092", ["a", "a", "b"], extra={"maxOffsetsPerTrigger": 1000, "failOnDataLoss": "false"})
    opts = spec.subscribe_options()
    assert opts["subscribe"] == "a,b"
    assert opts["maxOffsetsPerTrigger"] == "1000" and opts["failOnDataLoss"] == "false"
    assign = json.loads(spec.assign_options({("a", 0): 3})["assign"])
    assert assign == {"a": [0]}
    with pytest.raises(ValueError):
        KafkaSpec("h:9092", "").subscribe_options()


def test_booleans_may_be_strings():
    conf = {"fields": "a,b", "fieldCount": 2, "selectedFields": ["b"], "b": {"fieldNumber": 2, "substring": "false", "substringValue": [0, 1]}}
    assert LogSpec.from_dict(conf).fields == (FieldSpec("b", 2),)
    conf["b"]["substring"] = "true"
    assert LogSpec.from_dict(conf).fields == (FieldSpec("b", 2, (0, 1)),)
    conf["b"]["substring"] = "maybe"
    with pytest.raises(ValueError):
        LogSpec.from_dict(conf)


def test_output_columns_name_the_count():
    query = {"groupingFields": ["d", "a"]}
    assert SummarySpec.from_dict(query, {"columnNames": "d, a, hits"}).count_col == "hits"
    assert SummarySpec.from_dict(query, {"createTableQuery": "CREATE TABLE t (d STRING, a STRING, `hits` STRING)"}).count_col == "hits"
    for output in ({"columnNames": "a, d, hits"}, {"columnNames": "d, hits"}, {"columnNames": "d,a,x", "createTableQuery": "d String, a String, y String"}):
        with pytest.raises(ValueError):
            SummarySpec.from_dict(query, output)
