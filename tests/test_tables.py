"""Catalog summary table: lifecycle statements and the rewrite fold."""

from linefold.sinks.tables import SummaryTable


def test_table_lifecycle(spark, scratch):
    db = "lf_test_tables"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{scratch}/wh'")
    t = SummaryTable(spark, f"{db}.daily_summary", ["d", "a"], staging_table=f"{db}.temp_view")
    try:
        t.create()
        t.create()  # if absent: no error
        c1 = spark.createDataFrame([("d1", "a", 10)], "d string, a string, count bigint")
        assert t.rewrite_fold(c1)
        c2 = spark.createDataFrame([("d1", "a", 3), ("d2", "b", 1)], "d string, a string, count bigint")
        assert t.rewrite_fold(c2)
        assert not t.rewrite_fold(c2.limit(0))  # empty batch skipped
        rows = {(r["d"], r["a"]): r["count"] for r in t.read().collect()}
        assert rows == {("d1", "a"): "13", ("d2", "b"): "1"}
        assert dict(t.read().dtypes)["count"] == "string"
        assert not spark.catalog.tableExists(f"{db}.temp_view")
        t.truncate()
        assert t.read().count() == 0
    finally:
        t.drop_staging()
        t.drop()
        spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")


def test_interrupted_fold_is_finished(spark, scratch):
    db = "lf_test_tables2"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{scratch}/wh'")
    t = SummaryTable(spark, f"{db}.daily_summary", ["d", "a"], staging_table=f"{db}.temp_view")
    try:
        t.create()
        t.append(spark.createDataFrame([("d1", "a", 10), ("d1", "a", 3)], "d string, a string, count bigint"))
        # die after filling staging with the roll-up, before truncate/refill
        t.create_staging()
        t.append_staging(t.rollup())
        c = spark.createDataFrame([("d2", "b", 1)], "d string, a string, count bigint")
        assert t.rewrite_fold(c)
        rows = sorted((r["d"], r["a"], r["count"]) for r in t.read().collect())
        assert rows == [("d1", "a", "13"), ("d2", "b", "1")]
    finally:
        t.drop_staging()
        t.drop()
        spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")


def test_interrupted_before_staging_filled_keeps_table(spark, scratch):
    db = "lf_test_tables3"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{scratch}/wh'")
    t = SummaryTable(spark, f"{db}.daily_summary", ["d", "a"], staging_table=f"{db}.temp_view")
    try:
        t.create()
        t.append(spark.createDataFrame([("d1", "a", 10)], "d string, a string, count bigint"))
        t.create_staging()  # died here
        assert t.finish_interrupted_fold()
        assert [(r["d"], r["count"]) for r in t.read().collect()] == [("d1", "10")]
        assert not t.staging_exists()
    finally:
        t.drop_staging()
        t.drop()
        spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")


def test_swapped_table_is_never_seen_empty(spark, scratch):
    """A reader that polls during the folds sees the total before or after each, never less."""
    import threading
    import time

    db = "lf_test_swap"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{scratch}/wh'")
    t = SummaryTable(spark, f"{db}.daily_summary", ["d", "a"])
    schema = "d string, a string, count bigint"
    seen, failed, stop = [], [], threading.Event()

    def poll():
        while not stop.is_set():
            try:
                seen.append(sum(int(r["count"]) for r in spark.sql(f"SELECT count FROM {db}.daily_summary").collect()))
            except Exception as e:  # noqa: BLE001 - told below
                failed.append(str(e))
            time.sleep(0.02)

    try:
        assert t.swap_fold(spark.createDataFrame([("d0", "a", 5)], schema))
        reader = threading.Thread(target=poll)
        reader.start()
        try:
            for k in range(1, 5):
                assert t.swap_fold(spark.createDataFrame([("d0", "a", 1), (f"d{k}", "b", 9)], schema))
                assert not t.swap_fold(spark.createDataFrame([], schema))
        finally:
            stop.set()
            reader.join()
        assert not failed, failed[0]
        assert len(seen) > 4 and seen == sorted(seen) and set(seen) <= {5 + 10 * k for k in range(5)}
        rows = {(r["d"], r["a"]): r["count"] for r in t.read().collect()}
        assert rows == {("d0", "a"): "9", **{(f"d{k}", "b"): "9" for k in range(1, 5)}}
        from linefold.session import HadoopFS

        home = t.location().rpartition("/")[0]
        assert len(HadoopFS(spark).list_dirs_all(home)) == 2  # this one, and the one before for readers
    finally:
        t.drop()
        spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
