import pytest
from pyspark.sql import types as T

#: Columns of documents, and others with names that operators use inside.
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        *[T.StructField(n, T.StringType()) for n in ("_rid", "_row", "_text", "key", "name", "_size", "label", "n", "pii_", "my.col")],
    ]
)
WORDS = "the quick brown fox jumps over a lazy dog while seven wizards mix strange potions at night".split()


def prose(seed: int, n: int) -> str:
    out, x = [], seed * 2654435761 + 1
    for _ in range(n):
        x = (x * 1103515245 + 12345) % 2**31
        out.append(WORDS[(x >> 8) % len(WORDS)] + str((x >> 16) % 7))
    return " ".join(out)


def messy_rows() -> list[tuple]:
    """Nulls, empty and very long texts, ties, repeated rows, odd blanks and characters."""
    long = prose(5, 30_000)
    texts = [
        (0, prose(1, 40), "en", "b"),
        (1, prose(1, 40).upper(), "en", "a"),
        (2, prose(2, 3), "en", None),
        (3, "", "de", "a"),
        (4, None, None, "a"),
        (5, " \t\n", "de", None),
        (6, long, "en", "c"),
        (7, long + " end", "en", "c"),
        (8, "Éa straße\x0bça İ ＡＢ 你好 \U0001f600 ñ", "es", "a"),
        (8, "Éa straße\x0bça İ ＡＢ 你好 \U0001f600 ñ", "es", "a"),
        (9, prose(3, 200), "fr", "\U0001f600"),
        (9, prose(3, 199) + " other", "fr", "é"),
        (None, prose(4, 60), None, "b"),
        (None, prose(4, 60), "en", "b"),
        (None, None, None, None),
        (12, "x", "en", "a"),
        (13, "123 456 !? ...", "en", "a"),
        (2**62, prose(6, 5), "en", "z"),
        (-7, prose(6, 4), "en", "z"),
    ]
    return [(i, t, lang, s, len(t or ""), *["noise"] * 10) for i, t, lang, s in texts]


@pytest.fixture(scope="session")
def messy(spark, tmp_root):
    path = f"{tmp_root}/messy"
    spark.createDataFrame(messy_rows(), SCHEMA).coalesce(2).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def nothing(spark, tmp_root):
    path = f"{tmp_root}/nothing"
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def small(spark):
    """The documents of the smallest scale."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
