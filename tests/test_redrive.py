"""Rejected lines parsed again under a corrected spec."""

import pytest

from linefold.config import FieldSpec, LogSpec, SummarySpec
from linefold.operators.summary import summarize
from linefold.sinks.batch_table import BatchTable
from linefold.sinks.ledger import SummaryLedger
from linefold.sinks.tables import SummaryTable
from linefold.streaming.jobs import REJECT_SCHEMA, fold_batch, redrive_rejects

WRONG = LogSpec((FieldSpec("d", 1, (0, 2)), FieldSpec("a", 2), FieldSpec("x", 3, (0, 9))), "|", 3)  # asks too much of field 3
RIGHT = LogSpec((FieldSpec("d", 1, (0, 2)), FieldSpec("a", 2), FieldSpec("x", 3)), "|", 3)
SUM = SummarySpec(predicate="a <> 'skip'", keys=("d", "a"))
LONG = "long enough"
BATCHES = [
    ["d1|a|" + LONG, "d1|a|short", "d2|b|" + LONG],
    ["d1|a|x", "d3|c|x", "d3|skip|x", "z"],
    ["d2|b|" + LONG],
    ["d4|d|x", "d1|a|x", "d1|a|x"],
]


def lines(spark, rows):
    return spark.createDataFrame([(r,) for r in rows], "value string")


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def expected(spark, *accepted):
    """Counts of a first run in which the lines of the batches ``accepted`` were parsed under the right spec."""
    taken = [v for b, batch in enumerate(BATCHES) for v in batch if b in accepted or v.endswith(LONG)]
    return rows_of(summarize(lines(spark, taken), RIGHT, SUM))


@pytest.mark.parametrize("compact", [False, True])
def test_totals_are_those_of_a_first_run(spark, scratch, compact):
    ledger = SummaryLedger(spark, f"{scratch}/summary", SUM.keys, fanout=2)
    rejected, still = BatchTable(spark, f"{scratch}/rejects", REJECT_SCHEMA), BatchTable(spark, f"{scratch}/still", REJECT_SCHEMA)
    for b, batch in enumerate(BATCHES):
        fold_batch(lines(spark, batch), b, WRONG, SUM, ledger, reject_sink=rejected)
        if compact and b:
            for out in (ledger, rejected):
                out.compact(b - 1)
    assert rows_of(ledger.read()) == expected(spark)
    for _ in range(2):  # and again: nothing is counted twice
        assert redrive_rejects(ledger, rejected, RIGHT, SUM, batches=[1], still_rejected=still) == [1]
        assert rows_of(ledger.read()) == expected(spark, 1)
        assert [(r["batch_id"], r["value"], r["reason"]) for r in still.read().collect()] == [(1, "z", "short_field:d")]
    assert redrive_rejects(ledger, rejected, RIGHT, SUM, still_rejected=still) == [0, 1, 3]
    assert rows_of(ledger.read()) == expected(spark, 0, 1, 2, 3)
    assert rows_of(ledger.read(["d4"])) == [("d4", "d", 1)]
    # a worse spec takes back what the better one added
    redrive_rejects(ledger, rejected, WRONG, SUM, batches=[3])
    assert rows_of(ledger.read()) == expected(spark, 0, 1, 2)
    # later batches and compactions leave the revisions alone
    fold_batch(lines(spark, ["d9|z|" + LONG]), 4, WRONG, SUM, ledger, reject_sink=rejected)
    ledger.compact(3)
    assert rows_of(ledger.read()) == sorted([*expected(spark, 0, 1, 2), ("d9", "z", 1)])


def test_the_mirror_follows(spark, scratch):
    db = "lf_test_redrive"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{scratch}/wh'")
    table = SummaryTable(spark, f"{db}.s", ["d", "a"], by_day=True)
    ledger, rejected = SummaryLedger(spark, f"{scratch}/summary", SUM.keys), BatchTable(spark, f"{scratch}/rejects", REJECT_SCHEMA)
    mirrored = lambda: sorted((r["d"], r["a"], int(r["count"])) for r in table.read().collect())
    try:
        for b, batch in enumerate(BATCHES):
            fold_batch(lines(spark, batch), b, WRONG, SUM, ledger, reject_sink=rejected, mirror_table=table)
        assert mirrored() == expected(spark)
        redrive_rejects(ledger, rejected, RIGHT, SUM, mirror_table=table)
        assert mirrored() == expected(spark, 0, 1, 2, 3)
        redrive_rejects(ledger, rejected, WRONG, SUM, batches=[0], mirror_table=table)
        assert mirrored() == rows_of(ledger.read()) == expected(spark, 1, 2, 3)
    finally:
        table.drop()
        spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
