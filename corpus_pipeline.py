"""Corpus pipeline: quality rules, near-duplicate removal, decontamination, secret redaction, tokens.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written and read again as the next stage's ``docs``.  All but the last return
the columns of ``docs``.  A row without an id is kept or dropped like any other;
near-duplicate removal keeps it unless its group holds a row with an id, or
another row without one that it keeps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import bpe, decontaminate, ngram_join, quality, secrets
from ledgerline.llm.common import col, fresh, prepare, staged, table, word_bpe

#: Token ids are not expressible in SQL; tests compare the rows with a brute-force version.
ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the current quality policy."""
    prepare(spark)
    return quality.filter_quality(docs)


def keep_one_of_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, one row: that with the smallest id, or any if no row has one.

    Rows are told apart by two hashes of id and text, so rows that repeat both are one row."""
    prepare(spark)
    row = [F.xxhash64("doc_id", "text", F.lit(k)) for k in (1, 2)]
    found = ngram_join.join_groups(docs, marks=tuple(row))
    mine = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "mark_a", "mark_b")
    of_groups = found.where("grp is not null").groupBy("grp").agg(F.min(mine).alias("m")).select("m.mark_a", "m.mark_b")
    keep = of_groups.unionByName(found.where("grp is null").select("mark_a", "mark_b"))
    a, b = fresh(docs.columns, "mark_a"), fresh(docs.columns, "mark_b")
    marked = docs.withColumn(a, row[0]).withColumn(b, row[1])
    held = marked.join(keep, (marked[a] == keep["mark_a"]) & (marked[b] == keep["mark_b"]), "left_semi")
    return held.dropDuplicates([a, b]).select(*[col(c) for c in docs.columns])


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    prepare(spark)
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets replaced and ``n_chars`` set to the new length."""
    prepare(spark)
    out = secrets.redact(docs)
    return out.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else out


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digest of each document's token ids, and digest of the decoded text."""
    prepare(spark)
    out = bpe.encode(docs, word_bpe(), decoded=True)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", keep_one_of_group),
    ("decontamination", drop_benchmark),
    ("secrets", redact_secrets),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs, _ = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
