"""Connected components of a graph given by its links, in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linefold.llm.common import materialize


def components(links: DataFrame) -> DataFrame:
    """``(key, label)`` for every end of ``links(a, b)``: the smallest key of its component.

    Alternates two steps until nothing changes: every node points its larger neighbours to its smallest one, then
    its smaller ones. A round is written out, and minima are combined before the shuffle, so a node with very many
    links is no large task.
    """
    edges = materialize(
        links.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialize(large.filter("u != v"), "links")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        edges = materialize(small.filter("u != v").distinct(), "links")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    found = edges.groupBy("u").agg(F.min("v").alias("label")).select(F.col("u").alias("key"), "label")
    return found.unionByName(found.select(F.col("label").alias("key"), "label").distinct())
