"""Line sources: text files in batch or as a stream.

A line source is any DataFrame with a string column ``value``, which is what
Spark's text source and (after a cast) its Kafka source produce.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Batch read of text files, one row per line: ``value STRING``."""
    return spark.read.text(path)


def stream_lines(
    spark: SparkSession,
    path: str,
    *,
    max_files_per_trigger: int | None = None,
    latest_first: bool = False,
    clean_source: str | None = None,
    source_archive_dir: str | None = None,
    max_file_age: str | None = None,
) -> DataFrame:
    """Streaming read of text files landing in ``path``.

    New files are picked up once each; the file log in the query checkpoint
    records which, so a restarted query neither skips nor repeats a file.
    ``max_files_per_trigger`` bounds the size of one micro-batch.

    The source lists ``path`` on every trigger, so a landing folder that only
    grows makes each trigger slower. ``clean_source="archive"`` (with
    ``source_archive_dir``) or ``"delete"`` moves processed files away once
    their batch is committed; ``max_file_age`` (e.g. ``"7d"``) bounds how far
    back the listing looks.
    """
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    if latest_first:
        reader = reader.option("latestFirst", "true")
    if clean_source:
        if clean_source not in ("archive", "delete", "off"):
            raise ValueError("clean_source must be 'archive', 'delete' or 'off'")
        if clean_source == "archive" and not source_archive_dir:
            raise ValueError("clean_source='archive' needs source_archive_dir")
        reader = reader.option("cleanSource", clean_source)
        if source_archive_dir:
            reader = reader.option("sourceArchiveDir", source_archive_dir)
    if max_file_age:
        reader = reader.option("maxFileAge", max_file_age)
    return reader.load(path)


def record_values(records: DataFrame) -> DataFrame:
    """The record value as a string line (S5): ``value STRING``."""
    return records.select(F.col("value").cast("string").alias("value"))


def write_lines(lines: DataFrame, path: str, *, mode: str = "append") -> None:
    """Append lines as text files (used to land input for a file stream)."""
    lines.select(F.col("value").cast("string")).write.mode(mode).text(path)
