"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import apply_required_conf, scratch_path, ship_package

# White space of every word rule here: space and U+0009 to U+000D.
SPACE_CHARS = " \t\n\x0b\x0c\r"


def prepare(spark: SparkSession) -> None:
    """Session settings (batches to Python workers bounded by bytes among them), and the package for the workers."""
    apply_required_conf(spark)
    ship_package(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_bpe() -> str:
    """Path of the public word-level BPE vocabulary."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def fresh(taken: Iterable[str], base: str) -> str:
    """A column name that clashes with none of ``taken`` (names are case-insensitive)."""
    used = {c.lower() for c in taken}
    name = base
    while name.lower() in used:
        name = "_" + name
    return name


def staged(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` to the shared folder and read it back, which cuts its lineage; also the folder written.

    The files survive lost executors.  What a result no longer reads is
    removed with :func:`unstage`; the rest is left to the folder's retention.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def unstage(spark: SparkSession, *paths: str) -> None:
    """Remove staged tables, through Spark's own file systems."""
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def col(name: str) -> Column:
    """Column by exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value`` computed once per row.

    A lambda variable holds the value, so the optimizer cannot copy its
    expression to every use, nor into a lambda that would then compute it
    once per element, when it pushes a filter or merges projections.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
