"""Parse raw log lines into named string fields (P1-P7), with reject routing.

``parse`` is narrow (a one-row ``Generate`` and a projection, fused into one
codegen stage): no shuffle, no Python. It keeps the raw line, adds one
nullable string column per selected field and a ``_reject`` reason that is
NULL for good lines. ``accepted`` and ``rejects`` split that
frame. A job that needs both reads its input once with ``summary.count_with_rejects``
(the streaming fold does).

Reject reasons:

* ``null_value``          the line itself is NULL;
* ``short_field:<name>``  a sliced field is shorter than its slice end.

A line is judged before any predicate runs, as the original jobs failed on
such lines before filtering. ``mode="failfast"`` reproduces that failure with
``raise_error`` instead of routing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linefold.config import LogSpec
from linefold.functions.split import (
    field_from_parts_sql,
    java_field_from_raw_sql,
    java_split_sql,
    raw_split_sql,
    slice_chars_sql,
    sql_ident,
    sql_str,
    too_short_sql,
)

REJECT_COL = "_reject"
VALUE_COL = "value"
PARTS_COL = "_parts"
MODES = ("reject", "failfast")


def split_expr(line: str, spec: LogSpec) -> str:
    """SQL of the per-line field array that ``field_exprs`` reads.

    One-character delimiter: Spark's split of the raw line, bounded after the
    highest selected field (no trim of the line). Otherwise the exact
    ``String.split`` array.
    """
    if len(spec.delimiter) == 1:
        return raw_split_sql(line, spec.delimiter, spec.max_ordinal + 1)
    return java_split_sql(line, spec.delimiter)


def field_exprs(parts: str, line: str, spec: LogSpec) -> list[tuple[str, str, str | None]]:
    """``(name, value SQL, short-field test SQL or None)`` for each selected field."""
    out = []
    for f in spec.fields:
        if len(spec.delimiter) == 1:
            v = java_field_from_raw_sql(parts, line, spec.delimiter, f.ordinal, spec.max_ordinal + 1)
        else:
            v = field_from_parts_sql(parts, f.ordinal)
        if f.slice is None:
            out.append((f.name, v, None))
        else:
            begin, end = f.slice
            out.append((f.name, slice_chars_sql(v, begin, end), too_short_sql(v, end)))
    return out


def reject_reason_sql(line: str, checks: list[tuple[str, str | None]]) -> str:
    """First failing check, as a reason string; NULL when the line is good."""
    whens = [f"WHEN {line} IS NULL THEN 'null_value'"]
    for name, short in checks:
        if short is not None:
            whens.append(f"WHEN {short} THEN {sql_str('short_field:' + name)}")
    return "CASE " + " ".join(whens) + " END"


def parse(
    lines: DataFrame,
    spec: LogSpec,
    *,
    value_col: str = VALUE_COL,
    keep: tuple[str, ...] | list[str] = (),
) -> DataFrame:
    """``keep..., value, <fields...>, _reject`` for every input line.

    ``value_col`` names the string column holding the line (a binary Kafka
    ``value`` is cast). Field columns are nullable strings, as in the schema the
    spec describes; they are only meaningful where ``_reject`` is NULL.

    The line is split once, into an array holding only fields up to the
    highest selected ordinal, by a one-element ``explode``; a selected field
    that comes out empty is then told apart as interior (``""``) or trailing
    (``" "``) from the rest of the array, so the line itself is never trimmed. That ``Generate``
    node is deliberate: Catalyst pushes filters on the fields (the reject test,
    the user predicate) below a plain projection and would then re-evaluate the
    split -- and whatever expression produced the line -- once per field
    reference, since filters get no common-subexpression elimination. A filter
    on generated columns stays above the ``Generate``, which evaluates the
    split exactly once per line, inside whole-stage codegen.

    Both projections are handed over as SQL text, two JVM calls in all,
    because a stream rebuilds them for every micro-batch.
    """
    kept = [sql_ident(k) for k in keep]
    line, parts = sql_ident(VALUE_COL), sql_ident(PARTS_COL)
    split = lines.selectExpr(
        *kept,
        f"CAST({sql_ident(value_col)} AS STRING) AS {line}",
        f"explode(array({split_expr(line, spec)})) AS {parts}",
    )
    cols = field_exprs(parts, line, spec)
    reason = reject_reason_sql(line, [(n, s) for n, _, s in cols])
    return split.selectExpr(
        *kept,
        line,
        *[f"{v} AS {sql_ident(n)}" for n, v, _ in cols],
        f"{reason} AS {sql_ident(REJECT_COL)}",
    )


def accepted(parsed: DataFrame, *, mode: str = "reject") -> DataFrame:
    """Good lines only, without the raw line and the reason column."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    reason = F.col(REJECT_COL)
    if mode == "failfast":
        cond = F.when(
            reason.isNotNull(), F.raise_error(F.concat(F.lit("malformed log line: "), reason))
        ).otherwise(F.lit(True))
    else:
        cond = reason.isNull()
    return parsed.filter(cond).drop(REJECT_COL, VALUE_COL)


def rejects(parsed: DataFrame, keep: tuple[str, ...] | list[str] = ()) -> DataFrame:
    """``keep..., value, reason`` for every rejected line."""
    return parsed.filter(F.col(REJECT_COL).isNotNull()).select(
        *[F.col(k) for k in keep], F.col(VALUE_COL), F.col(REJECT_COL).alias("reason")
    )


def parse_accepted(lines: DataFrame, spec: LogSpec, *, mode: str = "reject", **kw) -> DataFrame:
    """``accepted(parse(lines, spec))``: the selected fields of the good lines."""
    return accepted(parse(lines, spec, **kw), mode=mode)
