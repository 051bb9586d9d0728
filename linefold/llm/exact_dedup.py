"""Exact deduplication by deterministic block naming.

Each normalised text is cut into blocks of ``block`` code points. The distinct
blocks are sorted and numbered: a block's integer name. Neighbouring names are
then paired, the distinct pairs sorted and numbered, and so on until every
document has a single name. Two documents have the same (level, name) exactly
when their texts are equal: naming is by content, so nothing can collide.

A 64-bit hash of a block only carries its name back to where the block
occurs. Hashes that stand for two different blocks are found and named by
content instead (``_clashing``).

Defined results: a null text counts as empty; an empty text is one empty
block. Of equal texts the row with the largest id stays (null ids are the
smallest; among repeated rows of that id, the last one read). Other columns
are never looked at, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linefold.llm.common import ascii_lower, materialize, with_row_id, without_rows

#: Code points in a block: most texts are one block, long ones a few.
BLOCK = 16384
_NONE = -(2**63)  # stands for the missing right half of a last odd pair


def _blocks(norm: Column, block: int) -> Column:
    cut = F.regexp_extract_all(norm, F.lit(f"(?s).{{1,{block}}}"), F.lit(0))
    return F.when(F.char_length(norm) <= block, F.array(norm)).otherwise(cut)


def _number(distinct: DataFrame, keys: list[str], keep: list[str], sign: int = 1) -> DataFrame:
    """Sort the distinct ``keys`` (hash-dealt by them) and number them; written out, so numbers stay."""
    number = F.monotonically_increasing_id()
    return materialize(
        distinct.sortWithinPartitions(*keys).select(*keep, (number if sign > 0 else -1 - number).alias("name")),
        "names",
    )


def _clashing(names: DataFrame) -> DataFrame:
    """Hashes that stand for more than one block."""
    return names.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h")


def identities(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    block: int = BLOCK,
    normalise: Callable[[Column], Column] = ascii_lower,
    block_hash: Callable[[Column], Column] = F.xxhash64,
) -> DataFrame:
    """``(_rid, _id, sha256, level, name)``: one row per row of ``docs``, equal (level, name) for equal texts only.

    ``_rid`` is the row number of :func:`linefold.llm.common.with_row_id`.
    """
    src = with_row_id(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))).select(
        "_rid", "_id", normalise(F.col("_text")).alias("norm")
    )

    def exploded(*cols: str) -> DataFrame:
        return src.select(*cols, F.posexplode(_blocks(F.col("norm"), block)).alias("pos", "block")).select(
            *cols, "pos", block_hash(F.col("block")).alias("h"), "block"
        )

    names = _number(exploded().select("h", "block").distinct(), ["h", "block"], ["h"])
    slim = materialize(
        src.select(
            "_rid",
            "_id",
            F.sha2(F.col("norm").cast("binary"), 256).alias("sha256"),
            F.transform(_blocks(F.col("norm"), block), lambda b: block_hash(b)).alias("hs"),
        ),
        "blocks",
    )
    occurrences = slim.select("_rid", F.size("hs").alias("n"), F.posexplode("hs").alias("pos", "h"))
    clash = _clashing(names)
    if clash.isEmpty():
        named = occurrences.join(names, "h")
    else:
        clash = materialize(clash, "clash")
        by_content = _number(
            exploded().join(clash, "h", "left_semi").select("h", "block").distinct(), ["h", "block"], ["h", "block"], -1
        )
        rare = exploded("_rid").join(by_content, ["h", "block"]).select("_rid", "pos", F.col("name").alias("name_"))
        named = (
            occurrences.join(names.join(clash, "h", "left_anti"), "h", "left")
            .join(rare, ["_rid", "pos"], "left")
            .withColumn("name", F.coalesce("name", "name_"))
        )
    current = materialize(named.select("_rid", "n", "pos", "name"), "level")
    longest = current.agg(F.max("n")).first()[0] or 1
    done = current.filter("n = 1").select("_rid", F.lit(0).alias("level"), "name")
    level = 0
    while longest > 1:
        level += 1
        even = F.col("pos") % 2 == 0
        pairs = materialize(
            current.filter("n > 1")
            .groupBy("_rid", "n", F.floor(F.col("pos") / 2).cast("int").alias("pair"))
            .agg(
                F.max(F.when(even, F.col("name"))).alias("l"),
                F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(_NONE).cast("long")).alias("r"),
            ),
            "pairs",
        )
        names = _number(pairs.select("l", "r").distinct(), ["l", "r"], ["l", "r"])
        current = materialize(
            pairs.join(names, ["l", "r"]).select(
                "_rid", F.ceil(F.col("n") / 2).cast("int").alias("n"), F.col("pair").alias("pos"), "name"
            ),
            "level",
        )
        done = done.union(current.filter("n = 1").select("_rid", F.lit(level).alias("level"), "name"))
        longest = (longest + 1) // 2
    return slim.select("_rid", "_id", "sha256").join(done, "_rid")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``(_rid, _id, sha256, keep_id, group_size, kept)``: one row per row of ``docs``.

    A row per group meets its members in a join whose hot groups Spark can
    split; counting and choosing is combined before the shuffle.
    """
    named = materialize(identities(docs, id_col, text_col, **how), "identities")
    groups = named.groupBy("level", "name").agg(
        F.max(F.struct("_id", "_rid")).alias("top"), F.count(F.lit(1)).alias("group_size")
    )
    return named.join(groups, ["level", "name"]).select(
        "_rid",
        "_id",
        "sha256",
        F.col("top._id").alias("keep_id"),
        "group_size",
        (F.col("_rid") == F.col("top._rid")).alias("kept"),
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` without the rows that do not stay; same columns."""
    dropped = materialize(exact_groups(docs, id_col, text_col, **how).filter(~F.col("kept")).select("_rid"), "dropped")
    return without_rows(docs, dropped)
