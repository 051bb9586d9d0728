"""Transaction-log lines rendered from the ``events`` table.

The test tables carry no raw log, so the jobs run on lines Spark renders from
``events`` in the 60-field transaction layout. Rendering is one projection;
it scales with ``events`` like any scan.

Layout (1-based fields, the rest empty):

====  ==================================================================
 1    ``event_id``
 2    ``ts`` as ``yyyy-MM-dd HH:mm:ss SSS`` (``ts`` is TIMESTAMP_NTZ, so the
      text does not depend on the session time zone)
 5    ``APP_`` + ``user_id % 20`` zero-padded to 6 digits
10    ``ussd`` when ``event_id % 3 = 0``, else ``sms``
16    ``mo`` for ``view`` and ``click`` events, else ``mt``
====  ==================================================================

Fields 17-60 are empty, so field 16 is the last non-empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linefold.config import TRANSACTION_FIELD_COUNT
from linefold.functions.split import sql_str


def ts_text_sql(ts: str = "ts") -> str:
    """``yyyy-MM-dd HH:mm:ss SSS`` of a TIMESTAMP_NTZ, without any time-zone step.

    The first 19 characters of its ISO text, plus milliseconds taken from the
    epoch microseconds: casting to a zoned timestamp shifts by whole seconds
    only, so the sub-second part is the same in every session time zone.
    (``date_format`` would shift the rest of the text; ``extract(SECOND ...)``
    gives the same digits through decimal arithmetic, about 6x slower.)
    """
    millis = f"CAST(pmod(unix_micros(CAST({ts} AS TIMESTAMP)), 1000000) div 1000 AS STRING)"
    return f"concat(substring(CAST({ts} AS STRING), 1, 19), ' ', lpad({millis}, 3, '0'))"


def zero_pad_sql(x: str, width: int) -> str:
    """``printf('%0<width>d', x)`` for values of at most ``width - 1`` digits."""
    return (
        f"CASE WHEN {x} < 0 THEN concat('-', lpad(CAST(-({x}) AS STRING), {width - 1}, '0')) "
        f"ELSE lpad(CAST({x} AS STRING), {width}, '0') END"
    )


# SQL text of the rendered fields; user_id % 20 has at most two digits, so
# padding to 6 never truncates.
FIELD_SQL = {
    1: "CAST(event_id AS STRING)",
    2: ts_text_sql("ts"),
    5: f"concat('APP_', {zero_pad_sql('user_id % 20', 6)})",
    10: "CASE WHEN event_id % 3 = 0 THEN 'ussd' ELSE 'sms' END",
    16: "CASE WHEN event_type IN ('view', 'click') THEN 'mo' ELSE 'mt' END",
}


def _concat(parts: list[str]) -> str:
    """``concat`` of SQL expressions, adjacent literal pipes merged into one literal."""
    merged: list[str] = []
    pending = ""
    for p in parts:
        if p == "|":
            pending += "|"
            continue
        if pending:
            merged.append(sql_str(pending))
            pending = ""
        merged.append(p)
    if pending:
        merged.append(sql_str(pending))
    return "concat(" + ", ".join(merged) + ")"


def render_line_sql(upto: int = TRANSACTION_FIELD_COUNT, fields: dict[int, str] | None = None) -> str:
    """SQL text of the rendered line, cut after field ``upto`` (60 = the full line)."""
    fields = FIELD_SQL if fields is None else fields
    parts: list[str] = []
    for i in range(1, upto + 1):
        if i > 1:
            parts.append("|")
        if i in fields:
            parts.append(fields[i])
    return _concat(parts)


def render_line(upto: int = TRANSACTION_FIELD_COUNT) -> Column:
    """The rendered line as a column over ``events`` columns."""
    return F.expr(render_line_sql(upto))


def event_lines(events: DataFrame) -> DataFrame:
    """``event_id, value``: one full transaction line per event."""
    return events.selectExpr("event_id", f"{render_line_sql()} AS value")


def ragged_event_lines(events: DataFrame) -> DataFrame:
    """``event_id, value`` with line ends varied by ``event_id % 5``.

    0 full line; 1 three extra fields 61-63 appended; 2 cut after field 5;
    3 cut after field 16 (no trailing empties); 4 field 10 left empty.
    """
    full = render_line_sql()
    no_channel = render_line_sql(fields={k: v for k, v in FIELD_SQL.items() if k != 10})
    value = (
        "CASE event_id % 5"
        f" WHEN 0 THEN {full}"
        f" WHEN 1 THEN concat({full}, '|x61|x62|x63')"
        f" WHEN 2 THEN {render_line_sql(5)}"
        f" WHEN 3 THEN {render_line_sql(16)}"
        f" ELSE {no_channel} END"
    )
    return events.selectExpr("event_id", f"{value} AS value")


def damaged_event_lines(events: DataFrame) -> DataFrame:
    """``event_id, value`` where most lines cannot be parsed, by ``event_id % 6``.

    0 NULL; 1 empty line; 2 delimiters only; 3 field 2 holds only the month
    (``yyyy-MM``, too short for the 10-character day slice); 4 full line
    (good); 5 field 1 only.
    """
    value = (
        "CASE event_id % 6"
        " WHEN 0 THEN CAST(NULL AS STRING)"
        " WHEN 1 THEN ''"
        " WHEN 2 THEN '|||'"
        f" WHEN 3 THEN concat({FIELD_SQL[1]}, '|', substring(CAST(ts AS STRING), 1, 7))"
        f" WHEN 4 THEN {render_line_sql()}"
        f" ELSE {FIELD_SQL[1]} END"
    )
    return events.selectExpr("event_id", f"{value} AS value")
