"""Predicate, counts and roll-ups.

Every aggregate here is algebraic, so Spark plans it as partial hash
aggregate -> exchange on the keys -> final aggregate. The exchange carries at
most one row per key per map task, whatever the input size or key skew: a key
holding a third of all lines costs one partial row per task, not a third of
the data in one reducer. No salting is needed for that reason.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linefold.config import LogSpec, SummarySpec
from linefold.operators.parse import REJECT_COL, VALUE_COL, parse_accepted


def apply_predicate(df: DataFrame, predicate: str | Column | None) -> DataFrame:
    """Filter by a SQL predicate string (as configured) or a Column."""
    if predicate is None or (isinstance(predicate, str) and not predicate.strip()):
        return df
    return df.filter(F.expr(predicate) if isinstance(predicate, str) else predicate)


def count_by(df: DataFrame, keys: Sequence[str], count_col: str = "count") -> DataFrame:
    """Rows per key, ``keys..., count BIGINT`` (A1)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))


#: Of a batch read once: the rejected line (null in rows that are counts), and the task that read it.
REJECTED, TASK = "_rejected_line", "_rejected_task"


def count_with_rejects(parsed: DataFrame, spec: SummarySpec) -> DataFrame:
    """Counts per key and the rejected lines of ``parse``'s result, in one pass over it (A1, P5).

    One aggregation has two kinds of rows: ``keys..., count`` with a null ``_reject``, and
    ``_reject, _rejected_line, count`` with null keys. A line that is rejected very often costs a row for
    each task that read it. ``rejected_lines`` writes the second kind out again.
    """
    bad = F.col(REJECT_COL).isNotNull()
    wanted = spec.predicate
    if wanted is not None and (not isinstance(wanted, str) or wanted.strip()):
        parsed = parsed.filter(F.when(bad, F.lit(True)).otherwise(F.expr(wanted) if isinstance(wanted, str) else wanted))
    keys = [F.when(~bad, F.col(k)).alias(k) for k in spec.keys]
    rejected = [F.col(REJECT_COL), F.when(bad, F.col(VALUE_COL)).alias(REJECTED), F.when(bad, F.spark_partition_id()).alias(TASK)]
    return parsed.groupBy(*keys, *rejected).agg(F.count(F.lit(1)).alias(spec.count_col))


def rejected_lines(counted: DataFrame, count_col: str = "count") -> DataFrame:
    """``value, reason`` of every rejected line in ``count_with_rejects``' rows, as often as it came."""
    times = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(count_col)))
    rows = counted.filter(F.col(REJECT_COL).isNotNull()).select(F.col(REJECTED).alias(VALUE_COL), F.col(REJECT_COL).alias("reason"), times)
    return rows.select(VALUE_COL, "reason")


def summarize(lines: DataFrame, log_spec: LogSpec, spec: SummarySpec, *, mode: str = "reject", **kw) -> DataFrame:
    """Lines -> parse -> predicate -> count per key: the per-batch summary."""
    parsed = parse_accepted(lines, log_spec, mode=mode, **kw)
    return count_by(apply_predicate(parsed, spec.predicate), spec.keys, spec.count_col)


def rollup_counts(
    df: DataFrame, keys: Sequence[str], count_col: str = "count", *, as_string: bool = False
) -> DataFrame:
    """Sum stored counts per key.

    Counts may be stored as strings (the table layout the original jobs used);
    they are read as BIGINT, so totals past 2^31 stay exact. A cell that is not
    a number fails with its value: skipping it would make the total wrong, and a
    fold that writes the total back would lose the cell for good. NULL cells add
    nothing, as in any sum. ``as_string`` casts the total back for that layout.
    """
    stored = F.col(count_col)
    number = stored.try_cast("bigint")
    bad = F.raise_error(F.concat(F.lit(f"{count_col} holds a value that is no count: "), stored.cast("string")))
    total = F.sum(F.when(stored.isNotNull() & number.isNull(), bad).otherwise(number))
    if as_string:
        total = total.cast("string")
    return df.groupBy(*keys).agg(total.alias(count_col))


def row_count(df: DataFrame, col: str = "n") -> DataFrame:
    """One row holding the number of rows of ``df`` (A3)."""
    return df.agg(F.count(F.lit(1)).alias(col))


def preview(df: DataFrame, n: int = 10, order: Sequence[str] = ()) -> DataFrame:
    """First ``n`` rows, for a look at a table or batch (T11); with ``order``, always the same ones."""
    return (df.orderBy(*order) if order else df).limit(n)
