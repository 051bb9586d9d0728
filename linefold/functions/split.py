"""Field extraction with java.lang.String.split semantics, as column expressions.

Log lines are split the way ``line.split(regexQuoted(delimiter))`` does on the
JVM, which differs from Spark's ``split`` at the ends of a line:

* trailing empty fields are dropped (``"a|b||"`` has 2 fields, not 4);
* a line made only of delimiters has no fields at all;
* an empty line has one field, the empty string.

Fields missing after that are padded with a single space ``" "``; interior
empty fields stay ``""``. Everything here is a native Catalyst expression, so
it stays inside whole-stage codegen and never leaves the JVM.
"""

from __future__ import annotations

PAD = " "


def regex_literal(text: str) -> str:
    """Java-regex pattern matching ``text`` literally.

    Every non-alphanumeric character is backslash-escaped (always literal in
    Java regex); letters and digits are left alone, since ``\\d`` etc. would
    turn them into classes.
    """
    return "".join(c if c.isalnum() else "\\" + c for c in text)


# Building a projection from F.* calls costs one JVM round trip per call; a
# streaming fold rebuilds its projection every micro-batch. These builders
# return SQL text for ``selectExpr``: one round trip per projection.
def sql_str(text: str) -> str:
    """A Spark SQL string literal holding ``text``."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def java_split_sql(line: str, delimiter: str, limit: int | None = None) -> str:
    """Array of the fields of the SQL expression ``line``, as ``String.split`` would return them.

    ``limit`` (optional, > 0) is a hint for callers that need only fields
    ``1..limit-1``: with a one-character delimiter the array then stops after
    ``limit`` elements, the last holding the rest of the line. A character-set
    trim would be wrong for longer delimiters, so their trailing empty elements
    are cut off the full array.
    """
    pattern = sql_str(regex_literal(delimiter))
    n = -1 if limit is None else int(limit)
    if len(delimiter) == 1:
        trimmed = f"TRIM(TRAILING {sql_str(delimiter)} FROM {line})"
        return (
            f"CASE WHEN {trimmed} = '' AND {line} <> '' THEN CAST(array() AS ARRAY<STRING>) "
            f"ELSE split({trimmed}, {pattern}, {n}) END"
        )
    parts = f"split({line}, {pattern}, -1)"
    from_end = f"array_position(transform(reverse({parts}), x -> x <> ''), true)"
    keep = f"CASE WHEN {from_end} = 0 THEN 0 ELSE size({parts}) - {from_end} + 1 END"
    return f"CASE WHEN {line} = '' THEN {parts} ELSE slice({parts}, 1, {keep}) END"


def field_from_parts_sql(parts: str, ordinal: int) -> str:
    """Field ``ordinal`` (1-based) of a field array, padded with ``" "``; NULL for a NULL line."""
    return f"CASE WHEN {parts} IS NOT NULL THEN coalesce(get({parts}, {ordinal - 1}), {sql_str(PAD)}) END"


def slice_chars_sql(value: str, begin: int, end: int) -> str:
    """Characters ``[begin, end)`` of ``value`` (0-based, end exclusive)."""
    return f"substring({value}, {begin + 1}, {end - begin})"


def too_short_sql(value: str, end: int) -> str:
    """True when ``value`` cannot be sliced up to ``end``."""
    return f"length({value}) < {end}"


def raw_split_sql(line: str, delimiter: str, limit: int) -> str:
    """Spark's own split (trailing empties kept) into at most ``limit`` elements."""
    return f"split({line}, {sql_str(regex_literal(delimiter))}, {int(limit)})"


def java_field_from_raw_sql(parts: str, line: str, delimiter: str, ordinal: int, limit: int) -> str:
    """Field ``ordinal`` with ``String.split`` semantics, from ``raw_split_sql(line, d, limit)``.

    Trailing empties matter only for a field that is itself empty: it is
    missing (``" "``) iff everything from it to the end of the line is
    delimiters, else it is an interior ``""``. A non-empty field is taken as
    is, so full lines never pay for trimming the line. One-character
    delimiters only; ``ordinal < limit``.
    """
    if len(delimiter) != 1 or not 1 <= ordinal < limit:
        raise ValueError("one-character delimiter and 1 <= ordinal < limit required")
    item = f"get({parts}, {ordinal - 1})"
    tail = f"replace(array_join(slice({parts}, {ordinal}, {int(limit)}), ''), {sql_str(delimiter)}, '')"
    on_empty_line = sql_str("") if ordinal == 1 else sql_str(PAD)
    return (
        f"CASE WHEN {parts} IS NULL THEN NULL"
        f" WHEN {line} = '' THEN {on_empty_line}"
        f" WHEN {item} IS NULL THEN {sql_str(PAD)}"
        f" WHEN {item} <> '' THEN {item}"
        f" WHEN {tail} = '' THEN {sql_str(PAD)}"
        f" ELSE '' END"
    )
