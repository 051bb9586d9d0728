"""The summary as a catalog table in the original layout.

``SummaryTable`` keeps the statements the original jobs ran against their
metastore table ``(keys..., count STRING)``: create if absent, append by
column list, roll up, truncate, a staging table, drop. ``rewrite_fold``
strings them together into the fold those jobs did after each batch
(append, re-aggregate the whole table into staging, truncate, refill from
staging, drop staging).

That fold rewrites the whole table per batch and is neither atomic nor
idempotent: a failure between statements, or a batch replayed after one,
leaves duplicate or double-counted keys. It is here for users who must keep
writing that table; streams should fold into ``SummaryLedger`` instead.

Tables are managed parquet tables in the session catalog (TRUNCATE is not
allowed on external tables), so they live under ``spark.sql.warehouse.dir``.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linefold.functions.split import sql_str
from linefold.operators.summary import rollup_counts
from linefold.session import HadoopFS
from linefold.sinks.ledger import among


def _q(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


class SummaryTable:
    def __init__(
        self,
        spark: SparkSession,
        table: str,
        keys: Sequence[str],
        *,
        count_col: str = "count",
        count_type: str = "STRING",
        staging_table: str | None = None,
        by_day: bool = False,
    ):
        self.spark = spark
        self.table = table
        self.staging = staging_table or f"{table}_staging"
        self.keys = list(keys)
        self.count_col = count_col
        self.count_type = count_type
        self.by_day = by_day

    @property
    def columns(self) -> list[str]:
        return [*self.keys, self.count_col]

    def _ddl(self, name: str) -> str:
        cols = ", ".join([f"`{k}` STRING" for k in self.keys] + [f"`{self.count_col}` {self.count_type}"])
        parts = f" PARTITIONED BY (`{self.keys[0]}`)" if self.by_day else ""
        return f"CREATE TABLE IF NOT EXISTS {_q(name)} ({cols}) USING parquet{parts}"

    def _insert(self, name: str, df: DataFrame) -> None:
        view = f"linefold_in_{uuid.uuid4().hex[:10]}"
        df.createOrReplaceTempView(view)  # T7
        try:
            cols = ", ".join(f"`{c}`" for c in self.columns)
            self.spark.sql(f"INSERT INTO {_q(name)} SELECT {cols} FROM `{view}`")
        finally:
            self.spark.catalog.dropTempView(view)

    # T1, T2
    def create(self) -> None:
        self.spark.sql(self._ddl(self.table))

    def create_staging(self) -> None:
        self.spark.sql(self._ddl(self.staging))

    # T3, T4
    def append(self, df: DataFrame) -> None:
        """Append ``keys..., count``; store assignment casts the count to the column type."""
        self._insert(self.table, df)

    def append_staging(self, df: DataFrame) -> None:
        self._insert(self.staging, df)

    def refill_from_staging(self) -> None:
        self._insert(self.table, self.spark.table(self.staging))

    def replace_days(self, summary: DataFrame, touched: DataFrame | Sequence[str | None]) -> None:
        """Overwrite the partitions of the days (values of the first key) in ``touched`` with ``summary``'s rows of them.

        For a table made with ``by_day``: other days' files stay as they are, so a batch costs its own days and not
        the whole history. ``summary`` must not read this table; one derived from the ledger qualifies, best already
        pruned to the days (``ledger.read(days)``). Each day is swapped by itself: a reader may see one day already
        replaced and the next one not yet. How partitions are overwritten is an option of this write alone.
        """
        if not self.by_day:
            raise ValueError(f"{self.table} is not partitioned by {self.keys[0]}")
        self.create()
        day = self.keys[0]
        if isinstance(touched, DataFrame):
            days = touched.select(day).distinct()
            if days.isEmpty():
                return
            rows = summary.join(days, summary[day].eqNullSafe(days[day]), "left_semi")
        elif touched:
            rows = summary.filter(among(day, touched))
        else:
            return
        rows = rows.select(*self.keys[1:], F.col(self.count_col).cast(self.count_type).alias(self.count_col), day)
        # an insert into the table would take the mode from the session; a write to its files takes it as an option
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(self.location())
        if isinstance(touched, DataFrame) or not all(touched):
            self.spark.sql(f"ALTER TABLE {_q(self.table)} RECOVER PARTITIONS")
        else:
            parts = " ".join(f"PARTITION (`{day}`={sql_str(d)})" for d in touched)
            self.spark.sql(f"ALTER TABLE {_q(self.table)} ADD IF NOT EXISTS {parts}")
        self.spark.catalog.refreshTable(self.table)

    def location(self) -> str:
        """The folder of the table's files."""
        found = self.spark.sql(f"DESCRIBE TABLE EXTENDED {_q(self.table)}").filter("col_name = 'Location'").first()
        return found["data_type"]

    # T5, T6
    def truncate(self) -> None:
        self.spark.sql(f"TRUNCATE TABLE {_q(self.table)}")

    def drop_staging(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {_q(self.staging)}")

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {_q(self.table)}")

    # S7, A2
    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def rollup(self) -> DataFrame:
        """Per-key sum of the stored counts, count as a string like the column."""
        return rollup_counts(self.read(), self.keys, self.count_col, as_string=True)

    def staging_exists(self) -> bool:
        return self.spark.catalog.tableExists(self.staging)

    def finish_interrupted_fold(self) -> bool:
        """Complete a fold that died between statements; True if there was one.

        A filled staging table holds the complete roll-up (each INSERT commits
        whole), so the table is rebuilt from it whether or not the truncate
        had happened. An empty one means the fold died before filling it,
        while the table was still intact: it is only dropped.
        """
        if not self.staging_exists():
            return False
        if not self.spark.table(self.staging).isEmpty():
            self.truncate()
            self.refill_from_staging()
        self.drop_staging()
        return True

    def swap_fold(self, counts: DataFrame) -> bool:
        """Fold one batch's counts in without ever showing an empty or half-written table; False if the batch is empty.

        The roll-up of the table and the batch is written to a new folder beside the table's, and the catalog's one
        entry for the table's place is changed to it: a reader sees the summary before or after. The folder before
        the last one is deleted, so a query that began before a swap can end. Like ``rewrite_fold`` it counts a
        replayed batch twice, and it is for one writer at a time.
        """
        if self.by_day:
            raise ValueError(f"{self.table} is partitioned; replace_days swaps its days")
        self.create()
        self.finish_interrupted_fold()
        counts = counts.persist()  # the emptiness test and the roll-up both need the small aggregate
        try:
            if counts.isEmpty():
                return False
            both = self.read().select(*self.columns).unionByName(
                counts.select(*self.keys, F.col(self.count_col).cast(self.count_type).alias(self.count_col))
            )
            now = self.location()
            home = now.rpartition("/")[0] if re.search(r"/_v-\d+-[0-9a-f]+$", now) else f"{now}_versions"
            number = int(found[1]) + 1 if (found := re.search(r"/_v-(\d+)-[0-9a-f]+$", now)) else 0
            fresh = f"{home}/_v-{number}-{uuid.uuid4().hex[:8]}"
            rollup = rollup_counts(both, self.keys, self.count_col, as_string=self.count_type.upper() == "STRING")
            rollup.select(*self.columns).write.parquet(fresh)
        finally:
            counts.unpersist()
        self.spark.sql(f"ALTER TABLE {_q(self.table)} SET LOCATION {sql_str(fresh)}")
        self.spark.catalog.refreshTable(self.table)
        fs = HadoopFS(self.spark)
        for old in fs.list_dirs_all(home):
            version = re.fullmatch(r"_v-(\d+)-[0-9a-f]+", old)
            # also what a fold that died before its swap has left
            if version and f"{home}/{old}" not in (fresh, now) and int(version[1]) <= number:
                fs.delete(f"{home}/{old}")
        return True

    def rewrite_fold(self, counts: DataFrame) -> bool:
        """Fold one batch's counts in by rewriting the table; False if the batch is empty.

        A staging table left by an interrupted fold is folded back first, so a
        crash between statements leaves no split keys behind. A batch replayed
        after its own append still counts twice: only the ledger is idempotent.
        """
        self.create()
        self.finish_interrupted_fold()
        # the emptiness test and the insert both need the batch's counts:
        # keep the (small) aggregate instead of computing it twice
        counts = counts.persist()
        try:
            if counts.isEmpty():
                return False
            self.append(counts)
        finally:
            counts.unpersist()
        self.create_staging()
        self.append_staging(self.rollup())
        self.truncate()
        self.refill_from_staging()
        self.drop_staging()
        return True
