"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Sources get weights and share the whole word count by them; no target
exceeds ``max_epochs`` times its source (the excess goes to the others by
weight). Whole epochs of a source come first. For the rest each document draws
an exponential key with its quality as the rate; in the order of the keys,
documents are taken while the running sum of their sizes stays in the budget,
and one more, the nearest in size to what is left, closes the gap if that
brings the sum nearer.

Keys are hashes of id and text, so a rerun takes the same documents. A source
is never sorted in one task: its key range is cut into one bucket for some
``per_bucket`` documents, sizes are summed by bucket, and only the bucket in
which the budget ends is sorted. What is taken there is told by the last row of
the run in that order and by the closing row, so that a document needs nothing
but its source's row: documents are never shuffled.

Defined results: a null or empty text has size 0; a null source is a source
of its own, the last; an empty table gives no rows. Among equal keys the order
is id, then size, then the order of reading (rows equal in all of these are
interchangeable). Other columns, however named, pass through.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linefold.llm.common import WORD, materialize, text_of, with_row_id

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
PER_BUCKET = 4096
#: The order of a source's documents.
_ORDER = ("_key", "_id", "_size", "_rid")


def word_count(text: Column) -> Column:
    """Number of words of a text (0 for null)."""
    return F.size(F.regexp_extract_all(text_of(text), F.lit(WORD), F.lit(0))).cast("long")


def quality(text: Column, size: Column) -> Column:
    """Quality weight from 0.5 to 2: two for natural word lengths (4 to 8 characters a word), less the further off.

    A cheap stand-in for a quality model; callers with one pass its score as ``quality_col``.
    """
    per_word = F.char_length(text_of(text)) / F.greatest(size, F.lit(1))
    off = F.greatest(F.lit(4.0) - per_word, per_word - F.lit(8.0), F.lit(0.0))
    return F.greatest(F.lit(0.5), F.lit(2.0) / (F.lit(1.0) + off))


def _key(identity: list[Column], rate: Column) -> Column:
    """Exponential arrival time with the given rate, from a hash."""
    uniform = (F.shiftrightunsigned(F.xxhash64(*identity), 11).cast("double") + 0.5) / float(2**53)
    return -F.log(uniform) / rate


def _targets(slim: DataFrame, weights: Sequence[float], max_epochs: float) -> DataFrame:
    """``(source, source_size, n, target)``, a row per source: tiny next to the documents."""
    total = slim.groupBy("_source").agg(F.sum("_size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    # the two windows below run over one row per source
    rank = F.row_number().over(Window.orderBy(F.asc_nulls_last("_source"))) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    s = total.withColumn("w", weight).withColumn("cap", F.lit(float(max_epochs)) * F.col("source_size"))
    everything = Window.partitionBy(F.lit(0))
    before = Window.orderBy(F.col("cap") / F.col("w"), F.asc_nulls_last("_source")).rowsBetween(
        Window.unboundedPreceding, -1
    )
    # Sources in the order in which they reach their cap. `level` is the words per weight left for a source and
    # all after it if all before it are capped; it rises up to the first uncapped source and falls after it.
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (
        F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0))
    )
    s = s.withColumn("level", level).withColumn("level", F.max("level").over(everything))
    return s.select("_source", "source_size", "n", F.least("cap", F.col("level") * F.col("w")).alias("target"))


def _bucket(per_bucket: int) -> Column:
    """Bucket of a document in its source: the same order as the keys, about ``per_bucket`` documents in each."""
    count = F.greatest(F.lit(1), F.ceil(F.col("n") / per_bucket))
    return F.least(count - 1, F.floor((F.lit(1.0) - F.exp(-F.col("_key"))) * count)).cast("long")


class Mix:
    """The sampling decisions for a table of documents.

    ``sources``: a row per source with its target, whole epochs, the bucket in which its budget ends, the ``last``
    row of that bucket's run, and the number of the row that closes the gap.
    """

    def __init__(
        self,
        docs: DataFrame,
        id_col: str = "doc_id",
        text_col: str = "text",
        source_col: str = "source",
        quality_col: str | None = None,
        weights: Sequence[float] = WEIGHTS,
        max_epochs: float = MAX_EPOCHS,
        per_bucket: int = PER_BUCKET,
    ):
        self._cols = (id_col, text_col, source_col, quality_col)
        self._per_bucket = per_bucket
        self.slim = materialize(self._sized(docs).drop("_row"), "sizes")
        targets = materialize(_targets(self.slim, weights, max_epochs), "targets")
        epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
        targets = targets.withColumn("epochs", epochs.cast("long")).withColumn(
            "budget", F.col("target") - F.col("epochs") * F.col("source_size")
        )
        keyed = self.slim.join(targets, self.slim["_source"].eqNullSafe(targets["_source"])).drop(targets["_source"])
        keyed = keyed.withColumn("bucket", _bucket(per_bucket))
        by_bucket = keyed.groupBy("_source", "bucket", "budget").agg(F.sum("_size").alias("words"))
        running = Window.partitionBy("_source").orderBy("bucket")
        ends = (
            by_bucket.withColumn("after", F.sum("words").over(running))
            .filter(F.col("after") > F.col("budget"))
            .groupBy("_source")
            .agg(F.min_by(F.struct("bucket", (F.col("after") - F.col("words")).alias("before")), "bucket").alias("e"))
            .select(F.col("_source").alias("_s"), F.col("e.bucket").alias("end"), F.col("e.before").alias("before"))
        )
        ended = materialize(targets.join(ends, F.col("_source").eqNullSafe(F.col("_s")), "left").drop("_s"), "ends")
        picks = self._picks(ended)
        self.sources = materialize(
            ended.join(picks, F.col("_source").eqNullSafe(F.col("_s")), "left").drop("_s"), "sources"
        )

    def _sized(self, docs: DataFrame) -> DataFrame:
        """Rows of ``docs`` (whole, as ``_row``) with their number, source, size and key."""
        id_col, text_col, source_col, quality_col = self._cols
        rate = F.greatest(F.coalesce(F.col("_given"), F.lit(1.0)), F.lit(1e-6)) if quality_col else quality(F.col("_text"), F.col("_size"))
        packed = docs.select(
            F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
            F.col(id_col).alias("_id"),
            F.col(text_col).alias("_text"),
            F.col(source_col).alias("_source"),
            (F.col(quality_col) if quality_col else F.lit(1.0)).alias("_given"),
        )
        return (
            with_row_id(packed)
            .withColumn("_size", word_count(F.col("_text")))
            .withColumn("_key", _key([F.col("_id"), F.col("_text")], rate))
            .select("_rid", "_id", "_source", "_size", "_key", "_row")
        )

    def _picks(self, ended: DataFrame) -> DataFrame:
        """What is taken from the end buckets, a row per source: the end of the longest run of keys that fits, and the row that closes the gap."""
        s = ended.withColumnRenamed("_source", "_s")
        last = (
            self.slim.join(s, F.col("_source").eqNullSafe(F.col("_s")))
            .filter(_bucket(self._per_bucket) == F.col("end"))
            .withColumn("left", F.col("budget") - F.col("before"))
        )
        by_key = Window.partitionBy("_source").orderBy(*_ORDER)
        ran = last.withColumn("run", F.sum("_size").over(by_key.rowsBetween(Window.unboundedPreceding, 0)))
        ran = ran.withColumn("fits", F.col("run") <= F.col("left"))
        whole = Window.partitionBy("_source")
        ran = ran.withColumn("gap", F.col("left") - F.coalesce(F.max(F.when(F.col("fits"), F.col("run"))).over(whole), F.lit(0)))
        miss = F.when(~F.col("fits"), F.abs(F.col("_size") - F.col("gap")))
        ran = ran.withColumn("miss", miss)
        closing = F.row_number().over(whole.orderBy(F.asc_nulls_last("miss"), *_ORDER)) == 1
        ran = ran.withColumn("closes", closing & F.col("miss").isNotNull() & (F.col("miss") < F.col("gap")))
        return ran.groupBy(F.col("_source").alias("_s")).agg(
            F.max(F.when(F.col("fits"), F.struct(*_ORDER))).alias("last"),
            F.max(F.when(F.col("closes"), F.col("_rid"))).alias("closing"),
        )

    def decided(self, sized: DataFrame) -> DataFrame:
        """``sized`` (rows with ``_rid``, ``_id``, ``_source``, ``_size``, ``_key``) with ``source_size``, ``target`` and ``copies``.

        Sources are few next to the documents and read from files, so Spark's own size threshold broadcasts them
        when they fit and shuffles otherwise.
        """
        s = self.sources.withColumnRenamed("_source", "_s")
        out = sized.join(s, F.col("_source").eqNullSafe(F.col("_s")))
        bucket = _bucket(self._per_bucket)
        before = (bucket < F.coalesce(F.col("end"), F.lit(2**62))) & (F.col("budget") > 0)
        picked = (bucket == F.col("end")) & (F.struct(*_ORDER) <= F.col("last")) | (F.col("_rid") == F.col("closing"))
        copies = F.col("epochs") + F.when(before | picked, F.lit(1)).otherwise(F.lit(0))
        return out.withColumn("copies", copies).drop(
            "_s", "n", "epochs", "budget", "end", "before", "last", "closing"
        )

    def mixed(self, docs: DataFrame) -> DataFrame:
        """The mix itself: the rows of ``docs`` (the table given at the start), each as often as it is taken."""
        taken = self.decided(self._sized(docs)).filter("copies > 0")
        each = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
        return taken.select("_row", each.alias("_copy")).select("_row.*")
