"""Kafka-shaped records rendered from the ``events`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from linefold.plans.events_log import render_line_sql
from linefold.plans.numbering import number_within_groups

RECORD_COLUMNS = ("topic", "partition", "offset", "timestamp", "key", "value")
TOPIC_SQL = "concat('t', CAST(event_id % 2 AS STRING)) AS topic"
PARTITION_SQL = "CAST(user_id % 3 AS INT) AS `partition`"


def event_records(events: DataFrame, *, block_width: int = 1 << 20) -> DataFrame:
    """Records of ``events``, and their ``event_id``.

    topic ``t<event_id % 2>``, partition ``user_id % 3``, offset = 0-based
    position of ``event_id`` within its (topic, partition), timestamp ``ts``,
    no key, value = the rendered transaction line. The four raw columns are
    numbered; lines are rendered after that, so the shuffle carries no lines.
    """
    raw = events.selectExpr(TOPIC_SQL, PARTITION_SQL, "event_id", "ts", "user_id", "event_type")
    numbered = number_within_groups(raw, ["topic", "partition"], "event_id", "offset", block_width=block_width)
    return numbered.selectExpr(
        "topic", "`partition`", "offset", "ts AS timestamp", "CAST(NULL AS STRING) AS key", f"{render_line_sql()} AS value", "event_id"
    )
