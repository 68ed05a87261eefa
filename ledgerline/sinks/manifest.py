"""Versions of a table folder: which loads are in it.

A table is ``<table>/loads/<load>/part-*`` and ``<table>/_versions/<n>.json``.
A version lists every load of the table with its files, bytes, rows, stamp and
date range; readers resolve the newest version and see its loads only.  Files of
a load that never got into a version are invisible, and :func:`sweep` removes them.

A version is put in place by one atomic step that fails if it is there already:
a hard link on a local file system, a rename without overwriting elsewhere
(atomic on HDFS and others with atomic renames).  So a writer that has seen
version n and publishes n + 1 knows that no other writer came between.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from dataclasses import asdict, dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class VersionTaken(RuntimeError):
    """Another writer published this version first."""


@dataclass(frozen=True)
class Load:
    """One load: its folder within the table, what it holds, and the run stamp (ISO text)."""

    folder: str
    files: int
    bytes: int
    rows: int | None = None
    stamp: str | None = None
    first_date: str | None = None
    last_date: str | None = None


@dataclass(frozen=True)
class Snapshot:
    version: int = 0
    loads: tuple[Load, ...] = ()


def file_system(spark: SparkSession, path: str):
    """(Hadoop path, its file system)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _missing(e: Py4JJavaError) -> bool:
    return e.java_exception.getClass().getSimpleName() in ("FileNotFoundException", "NoSuchFileException")


def listed(spark: SparkSession, path: str) -> list:
    """Statuses of a folder's entries; a missing folder has none."""
    p, fs = file_system(spark, path)
    try:
        return list(fs.listStatus(p))
    except Py4JJavaError as e:
        if _missing(e):
            return []
        raise


def data_files(spark: SparkSession, path: str) -> list:
    return [f for f in listed(spark, path) if f.isFile() and f.getPath().getName().startswith("part-")]


def put_if_absent(spark: SparkSession, written: str, path: str) -> bool:
    """Give the file ``written`` the name ``path`` in one step, unless that name exists."""
    src, fs = file_system(spark, written)
    dst, _ = file_system(spark, path)
    jvm = spark._jvm
    try:
        if fs.getUri().getScheme() == "file":
            there, here = (jvm.java.nio.file.Paths.get(fs.makeQualified(x).toUri()) for x in (dst, src))
            jvm.java.nio.file.Files.createLink(there, here)
        else:
            _rename_new(spark, fs, src, dst)
    except Py4JJavaError as e:
        if e.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return False
        raise
    finally:
        fs.delete(src, False)
    return True


def _rename_new(spark: SparkSession, fs, src, dst) -> None:
    jvm = spark._jvm
    kind = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(src), fs.makeQualified(dst), options)


def version_path(table: str, version: int) -> str:
    return f"{table}/_versions/{version:010d}.json"


def newest(spark: SparkSession, table: str) -> Snapshot:
    """The newest version of a table folder; version 0 is an empty one, or the bare files of an older folder."""
    names = [f.getPath().getName() for f in listed(spark, f"{table}/_versions")]
    versions = [int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()]
    if not versions:
        bare = data_files(spark, table)
        return Snapshot(0, (Load("", len(bare), sum(f.getLen() for f in bare)),) if bare else ())
    return at_version(spark, table, max(versions))


def at_version(spark: SparkSession, table: str, version: int) -> Snapshot:
    p, fs = file_system(spark, version_path(table, version))
    stream = fs.open(p)
    try:
        body = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return Snapshot(body["version"], tuple(Load(**x) for x in body["loads"]))


def publish_version(spark: SparkSession, table: str, snapshot: Snapshot) -> None:
    """Make ``snapshot`` the table's next version, or raise :class:`VersionTaken`."""
    draft = f"{table}/_versions/.draft-{uuid.uuid4().hex}"
    p, fs = file_system(spark, draft)
    out = fs.create(p, False)
    try:
        out.write(json.dumps({"version": snapshot.version, "loads": [asdict(x) for x in snapshot.loads]}).encode())
    finally:
        out.close()
    if not put_if_absent(spark, draft, version_path(table, snapshot.version)):
        raise VersionTaken(f"version {snapshot.version} of {table} was published by another writer")


def sweep(spark: SparkSession, table: str, before: _dt.datetime) -> int:
    """Remove load folders that no version lists and nobody touched since ``before`` (UTC); their number."""
    names = [f.getPath().getName() for f in listed(spark, f"{table}/_versions")]
    held = {x.folder for n in names if n.endswith(".json") for x in at_version(spark, table, int(n[:-5])).loads}
    limit, gone = before.replace(tzinfo=_dt.timezone.utc).timestamp() * 1000, 0
    for f in listed(spark, f"{table}/loads"):
        if f"loads/{f.getPath().getName()}" not in held and f.getModificationTime() < limit:
            p, fs = file_system(spark, f.getPath().toString())
            fs.delete(p, True)
            gone += 1
    return gone
