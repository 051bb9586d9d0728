"""Document fingerprints by one-permutation MinHash.

The hashes of a text's distinct five-word shingles are binned once by their
high bits; a bin keeps its smallest hash. An empty bin takes over the value of
another by optimal densification: universal hashes of (bin, attempt) name bins
until a filled one is met. Of each bin's value the ``BITS`` low-order bits are
packed; the share of equal bins of two fingerprints, corrected for chance
agreement of ``BITS`` bits, estimates the Jaccard likeness of the shingle sets.

All of it is array expressions on the row. Sorting the hashes together with one
sentinel per bin (the bin's largest value) leaves exactly one leading value in
each bin: its smallest hash, or the sentinel if it is empty.

Defined results: words are runs of anything but ASCII blanks, A-Z folded; a text
with one to four words has one shingle, all its words; one without words (or
null) has the empty fingerprint, which is like itself (1.0) and unlike any other
(0.0). Equal texts have equal fingerprints.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linefold.llm.common import WORD, ascii_lower, let, materialize, text_of, with_row_id

BIN_BITS = 7
BINS = 1 << BIN_BITS
BITS = 8
SHINGLE = 5
#: Hashed attempts at a filled bin; after them the filled bin with the smallest hash is taken, as more attempts would end at some filled bin.
ATTEMPTS = 8
#: Quantiles of the ids, and documents in a bucket of consecutive ones.
KNOTS = 128
PER_BUCKET = 4096

_LOW = (1 << 64 - BIN_BITS) - 1
#: A value per bin that no smaller one of the bin follows, as signed numbers in ascending order.
_SENTINELS = sorted((((b << 64 - BIN_BITS) | _LOW) + 2**63) % 2**64 - 2**63 for b in range(BINS))


def shingle_hashes(text: Column) -> Column:
    """Hash of every shingle of the text, in order, repeats included."""
    words = F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0))

    def shingles(h: Column) -> Column:
        at = lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(SHINGLE)])
        rows = F.transform(F.sequence(F.lit(0), F.size(h) - SHINGLE), at)
        return F.when(F.size(h) >= SHINGLE, rows).when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<bigint>"))

    return let(F.transform(words, lambda w: F.xxhash64(w)), shingles)


def _bins(hashes: Column) -> Column:
    """One value per bin, a sentinel in an empty one."""
    every = F.sort_array(F.concat(hashes, F.array(*[F.lit(s).cast("long") for s in _SENTINELS])))
    bin_of = lambda x: F.shiftrightunsigned(x, 64 - BIN_BITS)
    return let(every, lambda a: F.filter(a, lambda x, i: (i == 0) | (bin_of(x) != bin_of(F.get(a, i - 1)))))


def _filled(value: Column) -> Column:
    return value.bitwiseAND(F.lit(_LOW)) != F.lit(_LOW)


def _densified(bins: Column) -> Column:
    def dense(v: Column) -> Column:
        places = F.filter(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda q: _filled(F.get(v, q)))

        def with_places(filled: Column) -> Column:
            def value(x: Column, p: Column) -> Column:
                tried = [F.get(v, F.pmod(F.xxhash64(p, F.lit(a)), F.lit(BINS)).cast("int")) for a in range(ATTEMPTS)]
                nearest = F.array_min(F.transform(filled, lambda q: F.struct(F.xxhash64(p, q).alias("h"), F.get(v, q).alias("v"))))["v"]
                return F.coalesce(F.when(_filled(x), x), *[F.when(_filled(t), t) for t in tried], nearest)

            return F.transform(v, value)

        return F.when(F.exists(v, lambda x: ~_filled(x)), let(places, with_places)).otherwise(v)

    return let(bins, dense)


def fingerprint(text: Column) -> Column:
    """The packed fingerprint as lowercase hex, ``BINS * BITS`` bits; empty for a text without words."""

    def packed(hashes: Column) -> Column:
        low = lambda x: F.lpad(F.lower(F.hex(x.bitwiseAND(F.lit((1 << BITS) - 1)))), BITS // 4, "0")
        return F.when(F.size(hashes) == 0, F.lit("")).otherwise(F.array_join(F.transform(_densified(_bins(hashes)), low), ""))

    return let(shingle_hashes(text), packed)


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard likeness of two fingerprints, from 0 to 1, without chance agreement."""
    width, chance = BITS // 4, 1.0 / (1 << BITS)

    def share(pair: Column) -> Column:
        same = lambda i: F.substring(pair["x"], i * width + 1, F.lit(width)) == F.substring(pair["y"], i * width + 1, F.lit(width))
        equal = F.size(F.filter(F.sequence(F.lit(0), F.lit(BINS - 1)), same))
        return F.greatest(F.lit(0.0), (equal / BINS - chance) / (1 - chance))

    # binary, so that a piece is found without walking over characters
    pair = F.struct(a.cast("binary").alias("x"), b.cast("binary").alias("y"))
    return F.when(a == b, F.lit(1.0)).when((a == "") | (b == ""), F.lit(0.0)).otherwise(let(pair, share))


def _bucket(docs: DataFrame) -> tuple[Column, Column, Column]:
    """The columns ``_below`` and ``_upto``, and from them the bucket of consecutive documents in the order of (_key, _hash), about ``PER_BUCKET`` of them in each.

    The buckets follow the quantiles of the ids, evenly cut in between; an id that fills more than one quantile is
    cut by the hash.
    """
    quantiles = F.percentile_approx("_key", [i / KNOTS for i in range(1, KNOTS)], 10000)
    n, knots, least, most = docs.agg(F.count(F.lit(1)), quantiles, F.min("_id"), F.max("_id")).first()
    # the smallest and the largest id bound the outer quantiles (rows without an id lie below)
    knots = sorted([*(knots or [0]), *(k for k in (least, most) if k is not None)])
    cuts = max(1, -(-n // (KNOTS * PER_BUCKET)))
    every = F.array(*[F.lit(k).cast("long") for k in knots])
    below = F.size(F.filter(every, lambda k: k < F.col("_key")))
    upto = F.size(F.filter(every, lambda k: k <= F.col("_key")))
    lo, hi = F.get(every, F.col("_below") - 1).cast("double"), F.get(every, F.col("_below")).cast("double")
    even = F.coalesce((F.col("_key").cast("double") - lo) / F.nullif(hi - lo, F.lit(0.0)), F.lit(0.0))
    by_hash = F.col("_hash").cast("double") / 2.0**64 + 0.5
    hot = F.col("_upto") - F.col("_below")
    inside = F.when(hot >= 2, F.least(by_hash * hot * cuts, hot * cuts - 1)).otherwise(F.least(even * cuts, F.lit(cuts - 1)))
    number = F.col("_below") * cuts + F.floor(inside)
    return below, upto, number


def with_next(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows with their own and the next document's text and fingerprint, by ascending id; the last one's next is the first.

    One shuffle of the texts, by buckets of consecutive documents. The first document of a bucket also goes to the
    bucket before, where it ends the sequence.
    """
    rows = with_row_id(docs.select(F.col(id_col).cast("long").alias("_id"), text_of(F.col(text_col)).alias("_text")))
    rows = rows.withColumns({"_key": F.coalesce("_id", F.lit(-(2**63)).cast("long")), "_hash": F.xxhash64("_text")})
    below, upto, number = _bucket(rows)
    rows = rows.withColumns({"_below": below, "_upto": upto}).withColumn("_bucket", number.cast("long")).drop("_below", "_upto")
    order = ["_key", "_hash", "_rid"]
    heads = rows.groupBy("_bucket").agg(F.min(F.struct(*order)).alias("head"))
    # one row per bucket of some thousand documents
    by_bucket = Window.orderBy("_bucket")
    whole = by_bucket.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.coalesce(F.lag("_bucket").over(by_bucket), F.last("_bucket").over(whole))
    heads = materialize(heads.select(before.alias("_to"), F.col("head._rid").alias("_head")), "heads")
    full = rows.withColumn("_fp", fingerprint(F.col("_text")))
    ends = full.join(heads, F.col("_rid") == F.col("_head")).withColumn("_bucket", F.col("_to")).drop("_to", "_head")
    dealt = full.withColumn("_end", F.lit(False)).unionByName(ends.withColumn("_end", F.lit(True)))
    following = Window.partitionBy("_bucket").orderBy("_end", *order)
    after = F.lead(F.struct(F.col("_text").alias("text"), F.col("_fp").alias("fp"))).over(following)
    return dealt.withColumn("_next", after).filter(~F.col("_end"))
