"""A corpus from the documents table: language, exact copies, near copies, source mix, packed windows.

Every stage takes the documents that the one before it kept, written as Parquet
and read again, and all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linefold.llm import exact_dedup, jaccard, lang_id, mixing, packing
from linefold.session import scratch_path

#: Least posterior of the predicted language, and least mean log probability a letter in it: texts whose letters are
#: mostly outside the learnt languages' alphabets lie near ``log(lang_id.UNKNOWN)``, -13.8.
MIN_SCORE, MIN_FIT = 0.5, -9.0


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be told; texts without letters, undecided ones, and those in unlearnt scripts go.

    The models are learnt from the labelled rows of ``docs`` itself. A label never decides about its own row.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text"))
    found = lang_id.predict(rows, lang_id.learn(docs), lang="lang", score="score", fit="fit")
    clear = (F.col("lang") != lang_id.UND) & (F.col("score") >= MIN_SCORE) & (F.col("fit") >= MIN_FIT)
    return found.filter(clear).select("row.*")


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_exact_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return jaccard.drop_near_copies(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, each as often as it is taken."""
    return mixing.Mix(docs).mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in windows of 2048 tokens."""
    return packing.pack(docs)


STAGES = [("language_id", language), ("exact_dedup", exact), ("near_dedup", near), ("mix_sources", mix), ("pack", pack)]

#: SQL has no language model, tokenizer or ordered sampling by hashed keys to compare with.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
