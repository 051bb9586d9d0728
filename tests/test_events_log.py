"""Rendered lines do not depend on the session time zone."""

import duckdb

from linefold.plans.events_log import event_lines
from tests.conftest import SF_SMALL


def test_render_is_time_zone_free(spark):
    path = f"{SF_SMALL}/events.parquet"
    want = dict(
        duckdb.sql(
            f"SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S %g') FROM read_parquet('{path}')"
        ).fetchall()
    )
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("Pacific/Auckland", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            got = {r["event_id"]: r["value"].split("|")[1] for r in event_lines(spark.read.parquet(path)).collect()}
            assert got == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
