"""Column expressions and helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import shutil
import tempfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import linefold
from linefold.session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: A word: a maximal run of anything but the six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"
#: Length of all paths up to which the files' numbers are broadcast.
FILES_BYTES = 64 << 20


def text_of(col: Column) -> Column:
    """The text, a null one as the empty text."""
    return F.coalesce(col.cast("string"), F.lit(""))


def ascii_lower(col: Column) -> Column:
    """A-Z folded to a-z, every other character as it is.

    ``lower`` folds all of Unicode, so it is used only where the text is pure
    ASCII (as many bytes as characters); there both agree and it is far cheaper.
    """
    t = text_of(col)
    return F.when(F.octet_length(t) == F.char_length(t), F.lower(t)).otherwise(F.translate(t, UPPER, LOWER))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to a new folder under the shared checkpoint folder and read it back.

    Cuts the lineage (row numbers and names given before stay as written) and
    survives the loss of any executor. The folder stays until the checkpoint
    folder is cleaned, as lazy results may still read it.
    """
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bits of a row number that count the rows of a file; the others number the files.
ROW_BITS = 40


def with_row_id(df: DataFrame, name: str = "_rid") -> DataFrame:
    """Number the rows (unique, not dense): the number of the row's file in the order of their paths, and its place there.

    So a row has its number however a scan is split, whichever executors are there. What does not read files
    directly is written out first. The files' numbers are a row a file.
    """
    try:
        # the file's own columns, whatever columns of the table are called
        place = df.metadataColumn("_metadata")
        located = df.select("*", place.getField("file_path").alias("_file"), place.getField("row_index").alias("_place"))
    except AnalysisException:
        return with_row_id(materialize(df, "rows"), name)
    paths = sorted(r[0] for r in located.select("_file").distinct().collect())
    numbers = df.sparkSession.createDataFrame([(p, i << ROW_BITS) for i, p in enumerate(paths)], "_file string, _first long")
    if sum(map(len, paths)) <= FILES_BYTES:
        numbers = F.broadcast(numbers)
    number = (F.col("_first") + F.col("_place")).alias(name)
    return located.join(numbers, "_file").select(*[F.col(f"`{c}`") for c in df.columns], number)


def without_rows(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """``docs`` without the rows whose numbers ``dropped(_rid)`` lists; the columns of ``docs``, whatever they are called."""
    rows = with_row_id(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")))
    return rows.join(dropped, "_rid", "left_anti").select("_row.*")


def give_back() -> None:
    """Return freed memory to the system: a Python worker that waits for its next task keeps it beside the JVM otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:  # another C library than glibc has none
        trim(0)


def tidied(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` as a task's function that gives back its memory at the end."""

    def tidy(batches: Iterator) -> Iterator:
        yield from run(batches)
        give_back()

    return tidy


@contextmanager
def arrow_bytes(spark: SparkSession, most: int) -> Iterator[None]:
    """What runs inside hands Python workers about ``most`` bytes at once, one row at least; else it is 10,000 rows up to 64 MB."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, most)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once per context (``addPyFile`` of a small archive).

    Where the package is installed on every node the archive is not needed and does no harm.
    """
    sc = spark.sparkContext
    root = Path(linefold.__file__).resolve().parent
    if getattr(sc, "_linefold_shipped", False) or not root.is_dir():
        return
    archive = f"{tempfile.mkdtemp(prefix='linefold-ship-')}/linefold"
    sc.addPyFile(shutil.make_archive(archive, "zip", root_dir=root.parent, base_dir=root.name))
    sc._linefold_shipped = True
