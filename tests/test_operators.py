"""Small operators: input spreading, summary helpers."""

from pyspark.sql import functions as F

from linefold.plans.partitioning import spread
from linefold.operators.summary import apply_predicate, count_by, preview, row_count


def test_spread_only_when_too_few_partitions(spark):
    one = spark.range(0, 100, 1, 1)
    assert spread(one, 4).rdd.getNumPartitions() == 4
    many = spark.range(0, 100, 1, 8)
    assert spread(many, 4) is many


def test_predicate_string_column_and_none(spark):
    df = spark.range(10)
    assert apply_predicate(df, "id < 3").count() == 3
    assert apply_predicate(df, F.col("id") > 7).count() == 2
    assert apply_predicate(df, None).count() == 10
    assert apply_predicate(df, "  ").count() == 10


def test_counts(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "y")], "k1 string, k2 string")
    got = {(r["k1"], r["k2"]): r["count"] for r in count_by(df, ["k1", "k2"]).collect()}
    assert got == {("a", "x"): 2, ("b", "y"): 1}
    assert row_count(df).collect()[0]["n"] == 3
    assert preview(df, 2).count() == 2
    assert [r["k1"] for r in preview(df, 2, ["k1"]).collect()] == ["a", "a"]
