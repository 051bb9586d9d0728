"""DuckDB oracles for the registered queries.

Written from the ``events`` columns directly, never by parsing lines, so they
are independent of the parser.
"""

from __future__ import annotations

# Field values the line renderer puts into the transaction layout.
_EV = """
  SELECT
    event_id,
    event_id % 4 AS slice,
    CAST(event_id AS VARCHAR) AS id,
    strftime(ts, '%Y-%m-%d') AS day,
    printf('APP_%06d', user_id % 20) AS app,
    CASE WHEN event_id % 3 = 0 THEN 'ussd' ELSE 'sms' END AS channel,
    CASE WHEN event_type IN ('view', 'click') THEN 'mo' ELSE 'mt' END AS direction,
    strftime(ts, '%Y-%m-%d %H:%M:%S %g') AS ts_text,
    strftime(ts, '%Y-%m') AS month,
    user_id
  FROM events
"""

# The full 60-field line.
_LINE = (
    "id || '|' || ts_text || '|||' || app || '|||||' || channel || '||||||' || direction || repeat('|', 44)"
)

_PASS = "channel = 'sms' AND direction = 'mo'"

_GROUP_COUNT = f"""
  WITH ev AS ({_EV})
  SELECT day AS time_stamp, app AS app_id, COUNT(*) AS "count"
  FROM ev WHERE {_PASS} GROUP BY day, app
"""

_PARSED = """id, day AS time_stamp, app AS app_id, channel AS channel_type, direction AS travel_direction"""

_RECORDS = f"""
  WITH ev AS ({_EV})
  SELECT
    't' || CAST(event_id % 2 AS VARCHAR) AS topic,
    CAST(user_id % 3 AS INTEGER) AS "partition",
    CAST(ROW_NUMBER() OVER (PARTITION BY event_id % 2, user_id % 3 ORDER BY event_id) - 1 AS BIGINT) AS "offset",
    {_LINE} AS value
  FROM ev
"""

_RANGES = f"""
  WITH r AS ({_RECORDS}),
  q AS (
    SELECT topic, "partition", "offset",
      CAST(floor("offset" * 4 / COUNT(*) OVER (PARTITION BY topic, "partition")) AS BIGINT) AS slice
    FROM r
  )
  SELECT slice, topic, "partition", MIN("offset") AS from_offset, MAX("offset") + 1 AS until_offset
  FROM q GROUP BY slice, topic, "partition"
"""

_OF_TOPIC_1 = f"""
  WITH ev AS ({_EV})
  SELECT day AS time_stamp, app AS app_id, COUNT(*) AS "count"
  FROM ev WHERE {_PASS} AND 't' || CAST(event_id % 2 AS VARCHAR) IN ('t1') GROUP BY day, app
"""

ORACLES: dict[str, str] = {
    "parse_lines": f"WITH ev AS ({_EV}) SELECT {_PARSED} FROM ev",
    "parse_ragged": f"""
      WITH ev AS ({_EV})
      SELECT id, day AS time_stamp, app AS app_id,
        CASE event_id % 5 WHEN 2 THEN ' ' WHEN 4 THEN '' ELSE channel END AS channel_type,
        CASE event_id % 5 WHEN 2 THEN ' ' ELSE direction END AS travel_direction
      FROM ev
    """,
    "parse_rejects": f"""
      WITH ev AS ({_EV})
      SELECT event_id,
        CASE event_id % 6
          WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '|||'
          WHEN 3 THEN id || '|' || month ELSE id END AS value,
        CASE WHEN event_id % 6 = 0 THEN 'null_value' ELSE 'short_field:time_stamp' END AS reason
      FROM ev WHERE event_id % 6 <> 4
    """,
    "filter_predicate": f"WITH ev AS ({_EV}) SELECT {_PARSED} FROM ev WHERE {_PASS}",
    "group_count": _GROUP_COUNT,
    "summary_rollup": f"""
      WITH ev AS ({_EV}),
      stored AS (
        SELECT slice, day, app, CAST(COUNT(*) AS VARCHAR) AS n
        FROM ev WHERE {_PASS} GROUP BY slice, day, app
      )
      SELECT day AS time_stamp, app AS app_id, CAST(SUM(CAST(n AS BIGINT)) AS VARCHAR) AS "count"
      FROM stored GROUP BY day, app
    """,
    "summary_fold": _GROUP_COUNT,
    "summary_empty_batch": _GROUP_COUNT,
    "summary_read": f"""
      SELECT time_stamp, app_id, CAST("count" AS VARCHAR) AS "count" FROM ({_GROUP_COUNT})
    """,
    "summary_stream": _GROUP_COUNT,
    "summary_restart": _GROUP_COUNT,
    "summary_compact": _GROUP_COUNT,
    "kafka_summary_stream": _OF_TOPIC_1,
    "topic_stream": _OF_TOPIC_1,
    "stream_rejects": f"""
      WITH ev AS ({_EV})
      SELECT slice,
        CASE event_id % 6
          WHEN 0 THEN '' WHEN 1 THEN '' WHEN 2 THEN '|||'
          WHEN 3 THEN id || '|' || month ELSE id END AS value,
        'short_field:time_stamp' AS reason
      FROM ev WHERE event_id % 6 <> 4
    """,
    "stream_accepted": f"""
      WITH ev AS ({_EV})
      SELECT day AS time_stamp, app AS app_id, COUNT(*) AS "count"
      FROM ev WHERE {_PASS} AND event_id % 6 = 4 GROUP BY day, app
    """,
    "preview": f"SELECT * FROM ({_GROUP_COUNT}) ORDER BY time_stamp, app_id LIMIT 10",
    "batch_counts": f"WITH ev AS ({_EV}) SELECT slice, COUNT(*) AS n FROM ev GROUP BY slice",
    "running_total": f"""
      WITH ev AS ({_EV})
      SELECT slice, CAST(SUM(COUNT(*)) OVER (ORDER BY slice) AS BIGINT) AS total
      FROM ev GROUP BY slice
    """,
    "raw_archive": f"WITH ev AS ({_EV}) SELECT event_id, {_LINE} AS value FROM ev",
    "topic_subscribe": f"""SELECT topic, "partition", "offset", value FROM ({_RECORDS}) WHERE topic IN ('t1')""",
    "read_from_offsets": f"""
      SELECT r.topic, r."partition", r."offset", r.value
      FROM ({_RECORDS}) r
      JOIN (VALUES ('t0', 0, 100), ('t0', 1, 0), ('t1', 2, 250)) AS s(topic, part, from_offset)
        ON r.topic = s.topic AND r."partition" = s.part AND r."offset" >= s.from_offset
    """,
    "offset_ranges": f"""
      SELECT topic, "partition", MIN("offset") AS from_offset, MAX("offset") + 1 AS until_offset
      FROM ({_RECORDS}) GROUP BY topic, "partition"
    """,
    "summary_table_stream": f"""
      SELECT time_stamp, app_id, CAST("count" AS VARCHAR) AS "count" FROM ({_GROUP_COUNT})
    """,
    "offset_report_stream": _RANGES,
    "offset_log_ranges": _RANGES,
    "summary_takeover": _GROUP_COUNT,
    "topic_from_latest": f"""
      WITH ev AS ({_EV}),
      numbered AS (
        SELECT *,
          floor((ROW_NUMBER() OVER (PARTITION BY event_id % 2, user_id % 3 ORDER BY event_id) - 1) * 4
            / COUNT(*) OVER (PARTITION BY event_id % 2, user_id % 3)) AS quarter
        FROM ev
      )
      SELECT day AS time_stamp, app AS app_id, COUNT(*) AS "count"
      FROM numbered WHERE {_PASS} AND quarter >= 2 GROUP BY day, app
    """,
    "table_lifecycle": f"""
      SELECT time_stamp, app_id, CAST("count" AS VARCHAR) AS "count" FROM ({_GROUP_COUNT})
    """,
}
