"""Session settings the load semantics depend on."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Strict parses and casts must raise, time zones must never move a day, and
# AQE re-plans shuffles (partition coalescing, skew splits) at run time.
REQUIRED_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # rows may hold whole files or texts, so batches to Python workers are bounded by bytes
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}


# Generated whole-stage methods of wide report rows exceed HotSpot's 8 KB
# JIT limit and would run interpreted; allow the JIT to compile them.
JIT_FLAG = "-XX:-DontCompileHugeMethods"


def build_session(master: str | None = None, app: str = "ledgerline",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings the loaders expect."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for k, v in REQUIRED_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    extra = dict(extra or {})
    for key in ("spark.driver.extraJavaOptions", "spark.executor.extraJavaOptions"):
        opts = extra.get(key, "")
        if JIT_FLAG not in opts:
            extra[key] = (opts + " " + JIT_FLAG).strip()
    for k, v in extra.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_required_conf(spark)
    return spark


def apply_required_conf(spark: SparkSession) -> None:
    """Pin the runtime settings on an existing session.

    When the JVM was started without the JIT flag, whole-stage code beyond
    the JIT limit is split back into per-operator code, which the JIT does
    compile.
    """
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    if JIT_FLAG not in (spark.conf.get("spark.driver.extraJavaOptions", "") or ""):
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must already be set to shared storage; a missing
    setting is an error there.  Only a local master, where driver and
    executors are one process, gets a private scratch folder.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if conf_dir:
        return conf_dir
    master = spark.sparkContext.master
    if not re.match(r"local(\[|$)", master):
        raise ValueError(f"spark.checkpoint.dir must name a shared folder when the master is {master}")
    path = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return spark.sparkContext.getCheckpointDir() or path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared folder, for staged tables."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/{name}-{os.getpid()}-{os.urandom(4).hex()}"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``ledgerline`` importable in Python workers (``mapInPandas`` and
    ``applyInPandas`` tasks), once per application, via ``addPyFile``."""
    import io
    import zipfile

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.join("ledgerline", os.path.relpath(full, pkg)))
    path = os.path.join(tempfile.mkdtemp(prefix="ledgerline-pyfiles-"), "ledgerline.zip")
    with open(path, "wb") as fh:
        fh.write(buf.getvalue())
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)
