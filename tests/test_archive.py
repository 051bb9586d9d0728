"""Packing the raw-line archive: every line once at any moment, few files, nothing deleted too early."""

import pytest

from linefold.session import HadoopFS
from linefold.sinks.archive import DAY, LOG, Archive
from linefold.sources.lines import stream_lines, write_lines
from linefold.streaming.jobs import run_bounded, start_archive


def small_files(spark, scratch):
    fs = HadoopFS(spark)
    return [n for n in fs.list_files(f"{scratch}/archive") if n.startswith("part-")]


def packed_files(spark, archive):
    fs, out = HadoopFS(spark), []
    for s in archive.segments.manifest().segments:
        for day in fs.list_dirs_all(f"{archive.segments.folder}/{s.name}"):
            assert day.startswith(f"{DAY}=2")
            out += [n for n in fs.list_files(f"{archive.segments.folder}/{s.name}/{day}") if n.startswith("part-")]
    return out


def test_lines_stay_once_through_compactions(spark, scratch, monkeypatch):
    archive, lines = Archive(spark, f"{scratch}/archive", fanout=2), []
    read = lambda: sorted(r["value"] or "" for r in archive.read().collect())

    def land(k):
        new = [f"line {k}-{i}" for i in range(5)] + [""]
        lines.extend(new)
        write_lines(spark.createDataFrame([(v,) for v in new], "value string").repartition(3), f"{scratch}/in")
        run_bounded(start_archive(stream_lines(spark, f"{scratch}/in"), f"{scratch}/archive", f"{scratch}/ckpt", trigger={"availableNow": True}))

    land(0)
    assert read() == sorted(lines) and archive.compact() > 0
    assert read() == sorted(lines) and archive.compact() == 0
    assert small_files(spark, scratch)  # for who reads the listing of before
    for k in range(1, 4):
        land(k)
        assert read() == sorted(lines)
        held = archive.read()
        with monkeypatch.context() as m:  # a compaction that dies before its commit
            m.setattr(HadoopFS, "replace_text", lambda *a: (_ for _ in ()).throw(OSError("lost")))
            with pytest.raises(OSError):
                archive.compact()
        assert read() == sorted(lines)
        assert archive.compact() > 0
        assert read() == sorted(lines) == sorted(r["value"] or "" for r in held.collect())
    # what the compaction before packed is gone, and few files are left
    gone = {p for b, files in archive.committed().items() for p, _ in files}
    assert len(small_files(spark, scratch)) < len(gone)
    assert len(packed_files(spark, archive)) <= 3 * len(archive.segments.manifest().segments)
    assert archive.segments.leftovers() == []


def test_the_sinks_own_compacted_log_is_read(spark, scratch):
    """Every tenth batch Spark rewrites the log; files it names again are not archived twice."""
    archive, n = Archive(spark, f"{scratch}/archive"), 0
    for k in range(11):
        write_lines(spark.createDataFrame([(f"{k}",)], "value string"), f"{scratch}/in")
        run_bounded(start_archive(stream_lines(spark, f"{scratch}/in"), f"{scratch}/archive", f"{scratch}/ckpt", trigger={"availableNow": True}))
        if k in (3, 6, 9):
            n += archive.compact()
        assert sorted(int(r["value"]) for r in archive.read().collect()) == list(range(k + 1))
    assert any(x.endswith(".compact") for x in HadoopFS(spark).list_files(f"{scratch}/archive/{LOG}"))
    # after a while Spark drops the single logs that the compacted one covers
    for k in range(9):
        HadoopFS(spark).delete(f"{scratch}/archive/{LOG}/{k}")
    assert sorted(int(r["value"]) for r in archive.read().collect()) == list(range(11))
    n += archive.compact()
    assert n == 11 and sorted(int(r["value"]) for r in archive.read().collect()) == list(range(11))


def test_files_are_bounded_by_their_bytes(spark, scratch):
    rows = spark.range(40_000).selectExpr("sha2(CAST(id AS STRING), 512) AS value")
    write_lines(rows.repartition(20), f"{scratch}/in")
    run_bounded(start_archive(stream_lines(spark, f"{scratch}/in"), f"{scratch}/archive", f"{scratch}/ckpt", trigger={"availableNow": True}))
    total = sum(n for files in Archive(spark, f"{scratch}/archive").committed().values() for _, n in files)
    archive = Archive(spark, f"{scratch}/archive", target=total // 3)
    archive.compact()
    assert 3 <= len(packed_files(spark, archive)) <= 4
    assert archive.read().distinct().count() == archive.read().count() == 40_000
