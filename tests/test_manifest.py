"""Versioned Parquet target: atomic publish, concurrent writers, pruned reads."""

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from ledgerline.sinks import manifest
from ledgerline.sinks.manifest import Load, Snapshot, VersionTaken, newest, publish_version, sweep
from ledgerline.sinks.targets import EMPTY_TARGET_DATE, LoadFacts, ParquetTarget


def staged(spark, scratch, name, rows, stamp):
    path = f"{scratch}/stage-{name}"
    spark.range(rows).withColumn("FECHA_DATA", F.lit(stamp).cast("timestamp_ntz")).write.parquet(path)
    return path


def load(spark, scratch, target, name, rows, stamp, allowed=lambda last: True):
    return target.take_over(spark, staged(spark, scratch, name, rows, stamp), LoadFacts(stamp, rows), allowed)


DAYS = [dt.datetime(2024, 1, d, 9) for d in (1, 2, 3)]


def test_versions_and_pruned_reads(spark, scratch):
    target = ParquetTarget(f"{scratch}/T")
    assert target.read(spark) is None and target.last_load_date(spark) == EMPTY_TARGET_DATE
    for k, day in enumerate(DAYS):
        assert load(spark, scratch, target, f"s{k}", 10 * (k + 1), day)
    assert target.read(spark).count() == 60 and target.read(spark, 2).count() == 30
    found = target.snapshot(spark)
    assert found.version == 3 and [x.rows for x in found.loads] == [10, 20, 30] and all(x.files for x in found.loads)
    # one load's rows and the last date come from that load's files and from the version
    last = target.read_load(spark, DAYS[2])
    assert last.count() == 30 and all(found.loads[2].folder in f for f in last.inputFiles())
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("last-date", "no job may run")
    assert target.last_load_date(spark) == DAYS[2].date() and list(jobs.getJobIdsForGroup("last-date")) == []
    with pytest.raises(LookupError):
        target.read_load(spark, dt.datetime(2030, 1, 1))


class Stops(ParquetTarget):
    def _publish(self, spark, snapshot):
        raise ConnectionError("stopped")


def test_stop_half_way_shows_the_old_table(spark, scratch):
    target = ParquetTarget(f"{scratch}/T")
    load(spark, scratch, target, "a", 5, DAYS[0])
    with pytest.raises(ConnectionError):
        load(spark, scratch, Stops(target.path), "b", 7, DAYS[1])
    assert target.read(spark).count() == 5 and target.last_load_date(spark) == DAYS[0].date()
    assert load(spark, scratch, target, "c", 7, DAYS[1]) and target.read(spark).count() == 12
    assert sweep(spark, target.path, dt.datetime(2000, 1, 1)) == 0
    assert sweep(spark, target.path, dt.datetime(2100, 1, 1)) == 1 and target.read(spark).count() == 12


@pytest.mark.parametrize("local", [True, False])
def test_one_of_many_writers_gets_a_version(spark, scratch, local, monkeypatch):
    if not local:  # the way of file systems without links
        monkeypatch.setattr(manifest, "put_if_absent", renamed)
    table = f"{scratch}/T"
    first = Snapshot(1, (Load("loads/a", 1, 1),))
    publish_version(spark, table, first)
    with pytest.raises(VersionTaken):
        publish_version(spark, table, Snapshot(1, ()))
    assert newest(spark, table) == first
    assert [f.getPath().getName() for f in manifest.listed(spark, f"{table}/_versions") if not f.getPath().getName().endswith(".crc")] == ["0000000001.json"]


def renamed(spark, written, path):
    src, fs = manifest.file_system(spark, written)
    dst, _ = manifest.file_system(spark, path)
    try:
        manifest._rename_new(spark, fs, src, dst)
    except Exception as e:
        assert "FileAlreadyExists" in str(e)
        return False
    finally:
        fs.delete(src, False)
    return True


def test_threads_of_one_day(spark, scratch):
    """Eight loads at once, one of the day allowed: one is in, the others are refused and leave nothing."""
    target = ParquetTarget(f"{scratch}/T")
    paths = [staged(spark, scratch, str(k), 3 + k, DAYS[0]) for k in range(8)]
    go = lambda p: target.take_over(spark, p, LoadFacts(DAYS[0]), lambda last: last < DAYS[0].date())
    with ThreadPoolExecutor(8) as pool:
        done = list(pool.map(go, paths))
    assert sum(done) == 1 and target.read(spark).count() == 3 + done.index(True)
    assert len([f for f in manifest.listed(spark, f"{target.path}/loads")]) == 1


def test_threads_that_append(spark, scratch):
    target = ParquetTarget(f"{scratch}/T")
    paths = [staged(spark, scratch, str(k), 10 + k, DAYS[0]) for k in range(6)]
    with ThreadPoolExecutor(6) as pool:
        assert all(pool.map(lambda p: target.take_over(spark, p, LoadFacts(DAYS[0]), lambda last: True), paths))
    assert target.read(spark).count() == sum(range(10, 16)) and target.snapshot(spark).version == 6


def test_folder_of_bare_files_is_taken_up(spark, scratch):
    path = f"{scratch}/T"
    spark.range(4).withColumn("FECHA_DATA", F.lit(DAYS[0]).cast("timestamp_ntz")).write.parquet(path)
    target = ParquetTarget(path)
    assert target.last_load_date(spark) == DAYS[0].date() and target.read(spark).count() == 4
    assert load(spark, scratch, target, "n", 6, DAYS[1])
    assert target.read(spark).count() == 10 and target.snapshot(spark).loads[0].rows == 4
    assert target.read_load(spark, DAYS[0]).count() == 4 and target.read_load(spark, DAYS[1]).count() == 6
