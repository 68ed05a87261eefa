"""Report targets: a Parquet table folder or a JDBC table.

Both answer the date of the last load (1900-01-01 when empty), take over a staged
table unless the guard forbids it, and read one load back.  The Parquet target
moves the staged folder into its own, so rows are written once, and then publishes
the table's next version: a load is visible as a whole or not at all, and of
writers that saw the same version one publishes and the others are asked again.
Its last load date and one load's rows need no scan of other loads.  The JDBC
append has the database's own transactions per connection only; it writes from the executors over ``connections`` parallel connections in
batches of 5,000 rows.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.chunks import MIN_CHUNK
from ledgerline.sinks.manifest import (
    Load, Snapshot, VersionTaken, at_version, data_files, file_system, newest, publish_version,
)

EMPTY_TARGET_DATE = _dt.date(1900, 1, 1)
LOAD_STAMP = "FECHA_DATA"


def _as_date(v) -> _dt.date:
    if v is None:
        return EMPTY_TARGET_DATE
    return v.date() if isinstance(v, _dt.datetime) else v


def dt_of(day: _dt.date) -> _dt.datetime:
    return _dt.datetime.combine(day, _dt.time())


def remove(spark: SparkSession, path: str) -> None:
    """Remove a staged table."""
    p, fs = file_system(spark, path)
    fs.delete(p, True)


@dataclass(frozen=True)
class LoadFacts:
    """What a version records of a load."""

    stamp: _dt.datetime
    rows: int | None = None
    first_date: _dt.date | None = None
    last_date: _dt.date | None = None


@dataclass(frozen=True)
class ParquetTarget:
    """A versioned table folder (see :mod:`ledgerline.sinks.manifest`)."""

    path: str

    def snapshot(self, spark: SparkSession) -> Snapshot:
        return newest(spark, self.path.rstrip("/"))

    def _files(self, spark: SparkSession, loads: Sequence[Load]) -> DataFrame | None:
        home = self.path.rstrip("/")
        folders = [f"{home}/{x.folder}" if x.folder else f"{home}/part-*" for x in loads]
        return spark.read.parquet(*folders) if folders else None

    def read(self, spark: SparkSession, version: int | None = None) -> DataFrame | None:
        """The table's rows, at its newest version or at an older one; None if there is no load."""
        found = self.snapshot(spark) if version is None else at_version(spark, self.path.rstrip("/"), version)
        return self._files(spark, found.loads)

    def _stamped(self, spark: SparkSession, found: Snapshot) -> Snapshot:
        """With the stamp of files that were there before the first version; those of loads are in the version."""
        loads = []
        for x in found.loads:
            if x.stamp is None:
                top = self._files(spark, [x]).agg(F.max(LOAD_STAMP).alias("m"), F.count(F.lit(1)).alias("n")).first()
                x = replace(x, stamp=(top.m or dt_of(EMPTY_TARGET_DATE)).isoformat(), rows=top.n)
            loads.append(x)
        return Snapshot(found.version, tuple(loads))

    def last_load_date(self, spark: SparkSession) -> _dt.date:
        """Date of the newest stamp, from the version alone."""
        return self._last(self._stamped(spark, self.snapshot(spark)))

    @staticmethod
    def _last(found: Snapshot) -> _dt.date:
        return max((_as_date(_dt.datetime.fromisoformat(x.stamp)) for x in found.loads), default=EMPTY_TARGET_DATE)

    def read_load(self, spark: SparkSession, load_ts: _dt.datetime) -> DataFrame:
        """The rows of one load, from its own files (and from files older than the first version)."""
        found = [x for x in self.snapshot(spark).loads if x.stamp == load_ts.isoformat() or not x.folder]
        if not found:
            raise LookupError(f"no load of {load_ts} in {self.path}")
        return self._files(spark, found).where(F.col(LOAD_STAMP) == F.lit(load_ts).cast("timestamp_ntz"))

    def take_over(self, spark: SparkSession, staged_path: str, facts: LoadFacts, allowed: Callable[[_dt.date], bool]) -> bool:
        """Move a committed staged table in and publish it as the table's next version.

        ``allowed`` is asked with the last load date of the very version that
        the new one follows; if it says no, or anything fails before the
        version is there, readers see the table as it was.
        """
        home = self.path.rstrip("/")
        folder = f"loads/{facts.stamp:%Y%m%dT%H%M%S}-{uuid.uuid4().hex}"
        if not allowed(self.last_load_date(spark)):
            return False
        self._move(spark, staged_path, f"{home}/{folder}")
        files = data_files(spark, f"{home}/{folder}")
        text = lambda d: None if d is None else d.isoformat()
        load = Load(folder, len(files), sum(f.getLen() for f in files), facts.rows, facts.stamp.isoformat(),
                    text(facts.first_date), text(facts.last_date))
        while True:
            seen = self._stamped(spark, self.snapshot(spark))
            if not allowed(self._last(seen)):
                remove(spark, f"{home}/{folder}")
                return False
            try:
                self._publish(spark, Snapshot(seen.version + 1, (*seen.loads, load)))
                return True
            except VersionTaken:
                continue  # another load came first: ask again

    def _publish(self, spark: SparkSession, snapshot: Snapshot) -> None:
        publish_version(spark, self.path.rstrip("/"), snapshot)

    def _move(self, spark: SparkSession, staged_path: str, to: str) -> None:
        """One rename of the folder; a copy if the table is on another file system."""
        stage, fs = file_system(spark, staged_path)
        dst, home_fs = file_system(spark, to)
        if fs.getUri() != home_fs.getUri():
            spark.read.parquet(staged_path).write.parquet(to)
            remove(spark, staged_path)
            return
        home_fs.mkdirs(dst.getParent())
        if not fs.rename(stage, dst):
            raise OSError(f"could not move {staged_path} to {to}")


@dataclass(frozen=True)
class JdbcTarget:
    url: str
    table: str
    properties: dict = field(default_factory=dict)
    connections: int = 5

    def last_load_date(self, spark: SparkSession) -> _dt.date:
        q = f"SELECT MAX({LOAD_STAMP}) AS M FROM {self.table}"
        df = (spark.read.format("jdbc").option("url", self.url).option("query", q)
              .options(**self.properties).load())
        return _as_date(df.first()[0])

    def read_load(self, spark: SparkSession, load_ts: _dt.datetime) -> DataFrame:
        return spark.read.jdbc(self.url, self.table, properties=dict(self.properties)) \
            .where(F.col(LOAD_STAMP) == F.lit(load_ts).cast("timestamp_ntz"))

    def take_over(self, spark: SparkSession, staged_path: str, facts: LoadFacts, allowed: Callable[[_dt.date], bool]) -> bool:
        if not allowed(self.last_load_date(spark)):
            return False
        props = {"batchsize": str(MIN_CHUNK), "numPartitions": str(self.connections)} | dict(self.properties)
        spark.read.parquet(staged_path).repartition(self.connections) \
            .write.jdbc(self.url, self.table, mode="append", properties=props)
        remove(spark, staged_path)
        return True
